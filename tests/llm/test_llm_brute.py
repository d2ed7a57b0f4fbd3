"""The text operators held to brute-force versions, exact figures and held-out accuracy."""

from __future__ import annotations

import collections
import hashlib
import html
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from touchline.llm import decontamination, embedding_graph, near_duplicates, pii, queries, site_style, substring_dedup, toxicity, url_templates
from touchline.llm.common import table
from touchline.llm.components import components

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, FOLDER, "documents").collect()}


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_substring_windows(spark, texts):
    passage = " ".join(f"p{i}" for i in range(36))
    own = {
        1: f"start {passage} end", 2: passage, 3: "x " * 40, 4: f"{passage[:-1]}", 5: f"a {passage.replace('p20', 'q')} b",
        6: " ".join(f"p{i}" for i in range(1, 36)),
    }
    for corpus in (own, texts):
        seen = Counter(tuple(w[j : j + 35]) for w in map(split, corpus.values()) for j in range(len(w) - 34))
        df = spark.createDataFrame(list(corpus.items()), "doc_id long, text string")
        got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(df, unit_bytes=20_000, bucket_keys=5_000).collect()}
        for doc_id, text in corpus.items():
            w = split(text)
            gone = {k for j in range(len(w) - 34) if seen[tuple(w[j : j + 35])] > 1 for k in range(j, j + 35)}
            kept = " ".join(x for k, x in enumerate(w) if k not in gone)
            assert (got[doc_id]["n_words"], got[doc_id]["n_removed"], got[doc_id]["kept_text"]) == (len(w), len(gone), kept)


def test_substring_digest(spark, texts):
    got = {r["doc_id"]: r["kept_sha256"] for r in queries.op1_substring_dedup(spark, FOLDER).collect()}
    untouched = substring_dedup.remove_repeats(table(spark, FOLDER, "documents")).filter("n_removed = 0").collect()
    assert untouched
    for r in untouched:
        assert got[r["doc_id"]] == hashlib.sha256(" ".join(split(texts[r["doc_id"]])).encode()).hexdigest()


def shingle_set(text):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    return frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[j : j + 5]) for j in range(len(w) - 4)))


def linked(sets, top, bottom):
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and bottom * both >= top * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in ids}


def edited(n, seed):
    """A text, copies of it with one to many words changed, and unrelated texts."""
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 500, 120)]
    out = []
    for k in range(n):
        w = list(base)
        for at in rng.integers(0, len(w), k % 7):
            w[at] = f"z{rng.integers(0, 10**6)}"
        out.append(" ".join(w) if k % 5 else " ".join(f"u{x}" for x in rng.integers(0, 10**6, 80)))
    return out


@pytest.mark.parametrize(("leaf", "block"), [(1024, 512), (8, 6)])
def test_near_duplicate_components(spark, texts, monkeypatch, leaf, block):
    monkeypatch.setattr(near_duplicates, "LEAF", leaf)
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    corpus = {**texts, **{10_000 + k: t for k, t in enumerate(edited(40, 1) + edited(40, 2))}}
    df = spark.createDataFrame(list(corpus.items()), "doc_id long, text string")
    want = linked({i: shingle_set(t) for i, t in corpus.items()}, 85, 100)
    got = {r["doc_id"]: r for r in near_duplicates.find(df).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) and r["n_shingles"] == len(shingle_set(corpus[i])) for i, r in got.items())


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


def test_url_rules(spark):
    urls = [
        "https://Example.ORG/es/1", "http://www.example.org/en/12?x", "http://notexample.org/es/", "ftp://a.com/fr/x", "http://a.com/de/",
        "http://com/de/x", "http://example.org", "x://y.org/", "example.org/es/", "http://u@a.com:80/fr/", "http://a.net/fr/#http://b.org/",
    ]
    want = ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", "com/de/", None, "org/", None, None, None]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    host, path = url_templates.host_of(F.col("url")), url_templates.path_of(F.col("url"))
    rule, _ = url_templates.rule_for(host, path)
    got = df.select("page_id", host.alias("host"), path.alias("path"), rule.alias("rule")).orderBy("page_id").collect()
    assert [r["rule"] for r in got] == want
    assert (got[0]["host"], got[0]["path"]) == ("example.org", "/es/1") and (got[9]["host"], got[10]["path"]) == ("u@a.com:80", "/fr/")


def test_url_tree(spark):
    """A directory of bad pages among good ones is rejected, rare slugs share a wildcard, alike branches an estimate."""
    pages = [(i, f"http://h.net/good/{i}") for i in range(200)] + [(200 + i, f"http://h.net/spam/{200 + i}") for i in range(60)]
    pages += [(300 + i, f"http://h.net/s/slug-{chr(97 + i % 26)}{chr(97 + i // 26)}/{300 + i}") for i in range(300)]
    labels = [(i, int(i < 200 or i >= 300)) for i, _ in pages if i % 2]
    got = url_templates.judge(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int")
    ).collect()
    assert {r["verdict"] for r in got if "/spam/" in r["path"]} == {"block"}
    assert {r["verdict"] for r in got if "/spam/" not in r["path"]} == {"allow"}
    assert {r["template"] for r in got if "/s/" in r["path"]} == {"/s/*/{n}"}


def test_url_tree_keeps_rare_bad_directories(spark):
    """A bad directory with a small share of a host's pages is blocked, however many siblings it has, with many labels or few."""
    pages = [(i, f"http://h.net/good{chr(97 + i % 26)}{chr(97 + i // 26 % 4)}/{i}") for i in range(4000)]
    pages += [(5000 + i, f"http://h.net/spam/{5000 + i}") for i in range(50)] + [(6000 + i, f"http://h.net/scam/{6000 + i}") for i in range(20)]
    labels = [(i, int(i < 5000)) for i, _ in pages if i % 10 == 0 or i >= 5000]
    got = url_templates.judge(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int")
    ).collect()
    assert {r["verdict"] for r in got if r["page_id"] >= 5000} == {"block"}
    assert {r["verdict"] for r in got if r["page_id"] < 5000} == {"allow"}
    assert {r["template"] for r in got if r["page_id"] < 5000} == {"/*/{n}"}


def test_page_text(spark):
    """The article, whatever stands around it, against a plain cut at the article's tags."""
    got = {r["page_id"]: r["text"] for r in queries.op2_site_style(spark, FOLDER).collect()}
    for r in table(spark, FOLDER, "pages").collect():
        inside = re.search("<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", "", b))).strip() for b in re.split("</?(?:p|h1)>", inside)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


def test_style_tree_cuts_what_pages_share(spark):
    """Unnamed boilerplate, the same on every page of a host, goes; a passage that two articles share stays."""
    shell = "<body><div class=x0><p>Welcome to the site, dear reader</p></div><div class=body><p>{}</p><p>{}</p></div><section class=y><p>All rights</p></section>"
    pages = [(i, f"http://h.net/{i}", shell.format(f"Text number {i} of many", "shared" if i < 2 else f"more {i}")) for i in range(30)]
    got = {r["page_id"]: r["text"] for r in site_style.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[0] == "Text number 0 of many\nshared" and got[9] == "Text number 9 of many\nmore 9"


def plain_tree(pages):
    """host -> path -> (pages, importance), page by page in plain Python; no two pages of ``pages`` are alike."""
    seen = collections.defaultdict(lambda: collections.defaultdict(lambda: (collections.Counter(), {})))
    for host, page in pages:
        blocks, layouts = site_style.parse(page)
        for path, layout in set(layouts):
            seen[host][path][0][layout] += 1
        for path, text, links, noise, main in {(b[0], b[1]): b for b in reversed(blocks)}.values():
            if not noise:
                k, n, in_links, _ = seen[host][path][1].get(text, (0, 0, 0, False))
                seen[host][path][1][text] = (k + 1, n + len(text), in_links + links, main)
    out = {}

    def entropy(counts, total):
        return sum(-k / m * math.log(k / total) for k in counts) / math.log(total) if (m := sum(counts)) else 1.0

    for host, nodes in seen.items():
        size = {path: sum(layouts.values()) for path, (layouts, _) in nodes.items()}
        for path, (layouts, _) in nodes.items():
            below = [q for q in nodes if q == path or q.startswith(path + "/")]
            if path == "":
                continue
            weights, inside, chars, links = 0, 0.0, 0, 0
            for q in below:
                texts = nodes[q][1]
                k = [t[0] for t in texts.values()]
                own = max(0.0, entropy(k, size[q])) if size[q] >= site_style.MIN_PAGES and k else 1.0
                weights, inside = weights + sum(k), inside + sum(k) * own
                chars, links = chars + sum(t[1] for t in texts.values()), links + sum(t[2] for t in texts.values())
            kids = sum(q.count("/") == path.count("/") + 1 for q in below)
            presentation = entropy(layouts.values(), size[path]) if size[path] >= site_style.MIN_PAGES else 1.0
            decay = site_style.DECAY**kids
            mixed = (1 - decay) * presentation + decay * (inside / weights if weights else 1.0)
            main = any(t[3] for t in nodes[path][1].values())
            value = 1.0 if main or path.count("/") <= 2 else mixed
            out[host, path] = (size[path], 0.0 if not main and chars and links / chars > site_style.LINKS else value)
    return out


def test_style_tree_against_a_plain_one(spark):
    """Importances of generated hosts, and of the given pages without the tags that name their parts."""
    rng = random.Random(4)
    pages = []
    for i in range(60):
        parts = [f"<p>Text {i} {rng.random()}</p>", "<p>Share this</p>", f"<div class=m><ul><li><a href=/>Menu {rng.randrange(2)}</a></ul></div>"]
        body = "".join(rng.sample(parts, rng.randrange(1, 4)))
        pages.append((f"h{i % 3}.net", f"<body><div class=top><p>Welcome {rng.randrange(3)}</p></div><div class=t>{body}</div><section>{i}<p>All rights</section>"))
    names = (("<nav>", "<div class=a1>"), ('<div class="ad">', "<div class=b2>"), ("<article>", "<div class=c3>"), ("<footer>", "<div class=d4>"))
    given = table(spark, FOLDER, "pages").collect()
    bare = []
    for r in given:
        page = r["html"]
        for old, new in names:
            page = page.replace(old, new)
        bare.append((r["page_id"], r["url"], re.sub("</(nav|article|footer)>", "</div>", page)))
    pages += [(url.split("://")[1].split("/")[0], page) for page, url in {page: url for _, url, page in bare}.items()]
    rows = [(i, f"http://{host}/{i}", page) for i, (host, page) in enumerate(pages)]
    tree = site_style.style_tree(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {(r["host"], r["path"]): (r["pages"], r["importance"]) for r in tree.collect()}
    want = plain_tree([(host.lower(), page) for host, page in pages])
    assert {k: v for k, v in got.items() if k not in want} == {} and {k for k in want if k not in got} <= {k for k in want if not want[k][0]}
    for key, (n, importance) in got.items():
        assert want[key][0] == n and want[key][1] == pytest.approx(importance, abs=1e-9), key
    assert any(v[1] < site_style.LEAST for v in got.values()) and any(0 < v[1] < 1 for v in got.values())
    # Without names the tree and the link share decide: every article line stays, no menu does.
    texts = {r["page_id"]: r["text"] for r in site_style.extract(spark.createDataFrame(bare, "page_id long, url string, html string")).collect()}
    whole = {r["page_id"]: r["text"] for r in queries.op2_site_style(spark, FOLDER).collect()}
    for r in given:
        lines = set(texts[r["page_id"]].split("\n"))
        assert lines >= set(whole[r["page_id"]].split("\n")) and not lines & set(re.findall("<li><a[^>]*>(.*?)</a>", r["html"]))


def extracted(spark, pages):
    rows = [(i, f"http://h.net/{i}", page) for i, page in enumerate(pages)]
    return {r["page_id"]: r["text"] for r in site_style.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_noise_marks_hold_for_their_element_only(spark):
    """An id, a role or a hidden element goes; what has its path on this or another page of the host stays."""
    shell = "<body><div id=content><p>Text {0} outside</p></div><article><p>Text {0} inside</p>{1}</article><div id=footer>{2}</div>"
    extra = {0: "<p hidden>secret</p>", 1: "<div id=comments><p>me too</p></div>", 2: "<p style='display: none'>gone</p>"}
    foot = "".join(f"<p>Foot {k}</p>" for k in range(12))
    got = extracted(spark, [shell.format(i, extra.get(i, f"<div><p>more {i}</p></div>"), foot) for i in range(20)])
    for i in range(20):
        assert got[i] == f"Text {i} outside\nText {i} inside" + (f"\nmore {i}" if i > 2 else "")


def test_articles_are_not_cut_by_their_host(spark):
    """Text in an article stays though the host repeats it or has mostly links around it."""
    menu = "".join(f"<p><a href=/{k}>A long entry of the menu, number {k}</a></p>" for k in range(20))
    got = extracted(spark, [f"<body><div class=x>{menu}</div><article><p>The same text on every page</p></article>" for _ in range(12)])
    assert set(got.values()) == {"The same text on every page"}


def test_copies_of_a_page_count_once(spark):
    """A group of copies is no boilerplate, neither beside unique pages nor alone on its host."""
    shell = "<body><div class=top><p>Welcome to the site</p></div><div class=body><p>{}</p></div>"
    got = extracted(spark, [shell.format("The copied text" if i >= 20 else f"Text {i}") for i in range(220)])
    assert [got[i] for i in range(21)] == [*(f"Text {i}" for i in range(20)), "The copied text"]
    alone = extracted(spark, ["<body><div class=body><p>The copied text</p></div>"] * 30)
    assert set(alone.values()) == {"The copied text"}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a<p>b", "a\nb"), ("<p>a &amp; b&nbsp;&#65;", "a & b A"), ("<script>if(a<b)'</p>'</script>x<", "x<"), ("<!-- <p>no", ""),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "a\nb\nc"), ("<p title='a>b'>q</p><p clas", "q"), ("<nav>m</nav><header>h</header>t", "t"),
        ("<article><header><h1>T</h1></header>a<br>b<div id=comments>no</div></article><aside>s</aside>", "T\na b"),
        ("<div class='cookie-notice'>n</div><form>f</form><div class='side-ad'>x</div><p>y", "y"),
        ("<div class='footer-links'>n</div><div id=siteHeader>h</div><div class='with-sidebar'>t</div><div class=ad-slot-2>x</div>", "t"),
        ("<div id='notice-of-death'>a</div><article><p class='share-price'>b</p><div class='social-history'>c</div></article>", "a\nb\nc"),
        ("<article><p class=note>a</p><p class=notice>n</p><div class='cookie-notice'>c</div><aside>s</aside></article>", "a\nc"),
        ("x is <math><mi>a</mi><mo>+</mo>b<annotation>a+b</annotation></math> here <svg><text>no</text></svg>", "x is a+b here"),
    ],
)
def test_parse(page, text):
    assert site_style.main_text(page) == text


def contaminated(spark, item, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(77, item)], "item_id long, text string")
    got = decontamination.contamination(df, bench).collect()
    assert all(r["item_ids"] == [77] for r in got)
    return {r["doc_id"]: r["coverage"] for r in got}


def test_decontamination_slots(spark):
    item = "A train of Mario covers 120 km in 2 hours while the other train needs 5 hours for the same way to Rome"
    texts = [
        item, f"Before. {item.replace('120', '340').replace('Mario', 'Luigi')} and after", item.replace("5 hours", "2 hours"),
        "A train of Mario covers 7 km", " ".join("The 1 2 3 4 5 6 7 8 9 km" for _ in range(20)), "x " * 50 + item.lower() + " y" * 50,
    ]
    # The third gives two slots the same value, which re-parameterised questions may do; the last has the names as words.
    assert set(contaminated(spark, item, texts)) == {0, 1, 2, 5}


def test_decontamination_longer_slots(spark):
    """Slots filled with more tokens, values that differ from place to place, and items that are mostly slots."""
    item = "A train leaves Rome at noon and reaches the town of Genoa after 5 hours of travel through the hills"
    other = item.replace("Rome", "New York").replace("Genoa", "Los Angeles").replace("5", "17")
    got = contaminated(spark, item, [other, f"Well, {other.lower()}", item.replace("Rome", "the big old city of lights")])
    assert got[0] == 1.0 and 2 in got
    twice = "If a box holds 12 red balls and 12 blue balls then how many balls of all colours are there in the box"
    texts = [twice.replace("12", "40"), twice.replace("12", "40", 1).replace("12", "41")]
    got = contaminated(spark, twice, texts)
    assert got[0] == 1.0 and got.get(1, 0) < 1.0  # one value of the item cannot be two values
    for short in ("Compute 3 + 4 * 5", "12 7 9 4 15 22 31 8 45", "Anna Maria 5 km 6 kg 9"):
        assert set(contaminated(spark, short, [f"so. {short} it is", "Compute 7 + 1 * 2", "12 7 9 4 15 22 31 9 45", ""])) == {0}


def test_decontamination_part_of_a_long_item(spark):
    rng = np.random.default_rng(8)
    w = [f"w{chr(97 + a)}{chr(97 + b)}" for a, b in rng.integers(0, 26, (400, 2))]
    texts = [" ".join(["x"] * 30 + w[100:250] + ["y"] * 30), " ".join(["x"] * 30 + w[100:140] + ["y"] * 30), " ".join(w[:20] + w[200:260])]
    assert set(contaminated(spark, " ".join(w), texts)) == {0, 2}


def reworded(item, seed):
    """The item with every number and name replaced, each value by one other."""
    rng = np.random.default_rng(seed)
    new = {}
    out, at = [], 0
    for m in re.finditer(r"[0-9]+|(?<=[a-z] )[A-Z][a-z]+", item):
        value = new.setdefault(m[0], str(int(rng.integers(100, 10**6))) if m[0][0].isdigit() else "Zo" + "".join(rng.choice(list("abcd"), 5)))
        out += [item[at : m.start()], value]
        at = m.end()
    return "".join([*out, item[at:]])


def test_decontamination_reworded_items(spark, texts):
    """Every benchmark item with other values is found in the document that holds it, and in no clean one."""
    items = {r["item_id"]: r["text"] for r in table(spark, FOLDER, "benchmark").collect()}
    clean = [t for t in list(texts.values())[:150] if not any(x in t for x in items.values())]
    corpus = [(k, t) for k, t in enumerate(clean)] + [(1000 + i, f"So. {reworded(x, i)}\n{clean[i % len(clean)]}") for i, x in items.items()]
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontamination.contamination(df, table(spark, FOLDER, "benchmark")).collect()}
    assert set(got) == {1000 + i for i in items} and all(d - 1000 in ids for d, ids in got.items())


def test_decontamination_brute(spark, texts):
    items = {r["item_id"]: r["text"] for r in table(spark, FOLDER, "benchmark").collect()}
    want = {d for d, t in texts.items() for x in items.values() if x in t}
    one = {r["doc_id"] for r in queries.op6_decontamination(spark, FOLDER).collect()}
    blocks = decontamination.contamination(table(spark, FOLDER, "documents"), table(spark, FOLDER, "benchmark"), block=300)
    assert one == want == {r["doc_id"] for r in blocks.collect()}


def test_decontamination_fast_numbers(texts):
    block = decontamination.Block([(0, *w) for w in decontamination.item_windows(0, texts[4])], {})
    for t in [*list(texts.values())[:60], "Of 3 km. Then Anna, 4% Km? 5 Km X", "", "A", "to New York, Rome. New Town of Old Man Km 5 Km Xy Zz"]:
        slow = [block.ids.get(c, 0) for c, _ in decontamination.canonical(t)]
        assert block.numbers(t)[0].tolist() == slow


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP, CARD = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 12 <= len(re.sub("[^0-9]", "", m[0])) <= 19 and pii.luhn(re.sub("[^0-9]", "", m[0]))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_pii_base(texts):
    rng = np.random.default_rng(3)
    noise = ["".join(rng.choice(list("a1.@-+ ()2_b"), rng.integers(0, 30))) for _ in range(20_000)]
    for t in [*texts.values(), *noise, "1.2.3.4.5.6.7.8", "a@b.c@d.e", "+1 (456) 555-2186 4709559030084884", "4111 1111-1111 1111"]:
        assert pii.base_spans(t) == plain_spans(t)


def test_pii_long_texts_are_linear():
    for t in ("@" * 200_000, "1" * 200_000, "a" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000):
        pii.base_spans(t)


def test_pii_credentials_held_out():
    rng = np.random.default_rng(5)

    def hexa(n):
        return "".join(rng.choice(list("0123456789abcdef"), n))

    def line(k):
        words = " ".join(f"word{chr(97 + x)}" for x in rng.integers(0, 20, 8))
        extra = [f"password={hexa(18)}", f'token = "{hexa(40)}"', f"AKIA{''.join(rng.choice(list('ABCDEFGHIJ0123456789'), 16))}", "version 2.0", "in 1999"]
        return f"{words} {extra[k % 5]} {words}"

    weights = pii.train([line(k) for k in range(150)])
    for k in range(100):
        t = line(k)
        added = [s for s in pii.all_spans(t, weights) if s[0] in pii.ADDED]
        assert len(added) == (k % 5 < 3), (t, added)
        assert pii.mask(t, weights).count("<") == len(added)


@pytest.fixture(scope="module")
def field():
    return pii.train([f"word{k} password={k}abc99{k}f in 19{k % 90 + 10} a=b" for k in range(60)])


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("password: correcthorsebattery", "secret", "correcthorsebattery"), ("now token = abcdefghijklmnopqrs here", "secret", "abcdefghijklmnopqrs"),
        ("please call 212 555 0148 today", "phone", "212 555 0148"), ("phone (212) 555-0148.", "phone", "(212) 555-0148"),
        ("paid with 4539.1488.0343.6467 there", "card", "4539.1488.0343.6467"), ("card 4539  1488  0343  6467", "card", "4539  1488  0343  6467"),
        ("write to john [at] example [dot] com please", "email", "john [at] example [dot] com"),
    ],
)
def test_pii_what_the_patterns_miss(field, text, kind, value):
    assert [(k, text[a:b]) for k, a, b in pii.all_spans(text, field)] == [(kind, value)]
    assert pii.mask(text, field) == text.replace(value, f"<{kind.upper()}>")


@pytest.mark.parametrize("text", ["the secret garden was open", "password: required here", "order 212-555-0148 shipped", "on 2020-10-12 at 10:30 sharp", "4111 1111 1111 1112 is no card", "999.1.2.3"])
def test_pii_look_alikes(field, text):
    assert pii.all_spans(text, field) == []


def segmentations(n, most):
    """Every way to cut ``n`` tokens into segments of at most ``most``."""
    if n == 0:
        yield []
        return
    for k in range(1, min(n, most) + 1):
        for rest in segmentations(n - k, most):
            yield [*rest, (n - k, n)]


@pytest.mark.parametrize("seed", range(6))
def test_pii_decoder_against_all_segmentations(seed):
    rng = np.random.default_rng(seed)
    weights = rng.normal(size=(pii.BUCKETS, len(pii.TYPES))) * 0.5
    text = " ".join(rng.choice(["a", "1", "b2", "@", "=", "x9", "word"], 7))
    tokens = [m.span() for m in pii._TOKEN.finditer(text)]
    best = -np.inf
    for cut in segmentations(len(tokens), pii.MAX_TOKENS):
        total, types = 0.0, []
        for i, j in cut:
            score = weights[pii.features(text, tokens, i, j)].sum(0)
            score[1:] -= pii.MARGIN
            if j - i > 1:
                score[0] = -np.inf
                if not any(pii._TRIGGER.search(text, a, b) for a, b in tokens[i:j]):
                    score[:] = -np.inf
            total += score.max()
            types.append(int(score.argmax()))
        if total > best:
            best, want = total, [(i, j, t) for (i, j), t in zip(cut, types) if t]
    assert pii.decode(text, tokens, weights) == want


def test_toxicity_held_out(spark):
    rng = np.random.default_rng(11)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrs"]
    bad = ["idiot", "pathetic", "zorgat", "zorgun"]
    docs, labels = [], []
    for i in range(600):
        w = list(rng.choice(vocabulary, rng.integers(5, 80)))
        if i % 5 == 0:
            w.insert(int(rng.integers(0, len(w))), bad[(i // 5) % 4])
        docs.append((i, " ".join(w).capitalize() + "."))
        if i < 400:
            labels.append((i, int(i % 5 == 0)))
    got = toxicity.classify(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    held = got.filter("doc_id >= 400").collect()
    wrong = sum(r["toxic"] != (r["doc_id"] % 5 == 0) for r in held)
    assert wrong <= 2
    # The finer categories come before the whole and feed it.
    assert all(r["p_insult"] > 0.5 for r in held if (r["doc_id"] // 5) % 4 == 0 and r["doc_id"] % 5 == 0)


def test_chain_uses_earlier_links():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (800, 3)).astype(float)
    first = x[:, 0]
    links = toxicity.fit_chain(x, np.column_stack([first, first]), np.arange(800) % 5)
    assert links[1].shape == (5,) and links[1][4] > 0


def test_quality_shrinks_sparse_sites(spark):
    from touchline.llm import quality

    docs, pages, labels = [], [], []
    for i in range(900):
        host = "good.net" if i < 400 else "bad.net" if i < 800 else f"tiny{i}.net"
        good = i % 20 != 0 if i < 400 else i % 20 == 0 if i < 800 else i % 2 == 0
        docs.append((i, f"plain words number {i % 7} here"))
        pages.append((i, f"http://{host}/d/{i}"))
        if i % 3 and i != 899:
            labels.append((i, int(good)))
    frame = spark.createDataFrame
    got = {
        r["doc_id"]: r
        for r in quality.classify(
            frame(docs, "doc_id long, text string"), frame(pages, "page_id long, url string"), frame(labels, "doc_id long, quality int")
        ).collect()
    }
    assert got[3]["place_share"] > 0.85 and got[603]["place_share"] < 0.15
    assert 0.3 < got[801]["place_share"] < 0.7 and 0.3 < got[899]["place_share"] < 0.7
    assert got[3]["kept"] and not got[603]["kept"]


def test_quality_held_out(spark):
    got = {r["doc_id"]: r["evidence"] for r in queries.op4_quality(spark, "/root/testdata/sf0.01").collect()}
    truth = {r["doc_id"]: r["quality"] for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    good = np.array([got[i] for i, q in truth.items() if q == 1])
    bad = np.array([got[i] for i, q in truth.items() if q == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.9


@pytest.mark.parametrize(("per_cell", "cap"), [(500, 2048), (100, 60)])
def test_embedding_links(spark, per_cell, cap):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(30, 16))
    x = np.concatenate([c + 0.12 * rng.normal(size=(n, 16)) for c, n in zip(centre, [150] + [7] * 29)])
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    got = embedding_graph.find(df, per_cell=per_cell, cap=cap).orderBy("vec_id").collect()
    found, exact = np.array([r["n_links"] for r in got]), near.sum(1)
    assert (found <= exact).all() and found.sum() >= 0.98 * exact.sum()
    assert got[0]["audited_recall"] >= 0.95
    want = linked({i: frozenset([i]) for i in range(0)}, 1, 1)
    for i in range(len(x)):
        want[i] = i
    changed = True
    while changed:
        changed = False
        for i, j in np.argwhere(near):
            low = min(want[i], want[j])
            changed |= want[i] != low or want[j] != low
            want[i] = want[j] = low
    same = sum(r["component_id"] == want[r["vec_id"]] for r in got)
    assert same >= 0.99 * len(x)


def test_embedding_recall_outside_large_groups(spark, monkeypatch):
    """A search that finds the links of one large group only is not enough: all pairs are compared then."""
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(101, 24))
    x = np.concatenate([np.repeat(centre[:1], 700, 0), np.repeat(centre[1:], 4, 0)])
    x += 0.01 * rng.normal(size=x.shape)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    whole = embedding_graph._searched
    monkeypatch.setattr(embedding_graph, "_searched", lambda *a: whole(*a).filter("vec_id < 700 AND root < 700"))
    got = {r["vec_id"]: r for r in embedding_graph.find(df, per_cell=100, cap=200).collect()}
    assert [got[i]["n_links"] for i in range(len(x))] == [699] * 700 + [3] * 400
    assert [got[i]["component_id"] for i in range(len(x))] == [0] * 700 + [700 + 4 * (i // 4) for i in range(400)]
    assert got[0]["audited_recall"] == 1.0


def test_embedding_lengths_and_unmeasured_recall(spark):
    """Vectors of unlike lengths are not linked; without audited links, linked vectors are audited; without links nothing is known."""
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [0.99, 0.01]), (4, [0.99, 0.0, 0.01]), (5, [0.0, 1.0]), (6, [5.0]), (7, [3.0])]
    schema = "vec_id long, embedding array<double>"
    got = {r["vec_id"]: r for r in embedding_graph.find(spark.createDataFrame(rows, schema)).collect()}
    assert [(got[i]["n_links"], got[i]["component_id"]) for i in range(1, 8)] == [(1, 1), (1, 2), (1, 1), (1, 2), (0, 5), (1, 6), (1, 6)]
    assert {r["audited_recall"] for r in got.values()} == {1.0}
    apart = embedding_graph.find(spark.createDataFrame([(i, [float(i == k) for k in range(60)]) for i in range(60)], schema))
    assert {(r["n_links"], r["audited_recall"]) for r in apart.collect()} == {(0, None)}
    # All pairs of blocks compared keep to the same rule.
    usable = embedding_graph._valid(spark.createDataFrame(rows, schema))
    counts = {r["vec_id"]: r["n"] for r in embedding_graph._compared(usable, 0.9, 4).groupBy("vec_id").agg(F.sum("n").alias("n")).collect()}
    assert counts == {1: 1, 2: 1, 3: 1, 4: 1, 6: 1, 7: 1}


def test_pipeline(spark, texts):
    """Every stage against its own input."""
    docs = table(spark, FOLDER, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, FOLDER)
        after = {r["doc_id"]: r for r in docs.collect()}
        assert set(after) <= set(before)
        assert docs.columns == (columns if name != "mixing" else [*columns, "copies"])
        kept[name] = (before, after)
    before, after = kept["near_duplicates"]
    groups = linked({i: shingle_set(r["text"]) for i, r in before.items()}, 4, 5)
    assert set(after) == set(groups.values())
    before, after = kept["decontamination"]
    items = [r["text"] for r in table(spark, FOLDER, "benchmark").collect()]
    assert set(after) == {i for i, r in before.items() if not any(x in r["text"] for x in items)}
    before, after = kept["pii"]
    assert set(after) == set(before)
    assert all(not plain_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in after.values())
    assert all(r["text"] == before[i]["text"] for i, r in after.items() if not re.search("[0-9@=]|[A-Z]{16}", before[i]["text"]))
    before, after = kept["mixing"]
    size = {i: len(split(r["text"])) for i, r in before.items()}
    taken = sum(size[i] * r["copies"] for i, r in after.items())
    assert abs(taken - sum(size.values())) < 0.1 * sum(size.values())
    assert len(kept["toxicity"][1]) >= 0.7 * len(texts)
