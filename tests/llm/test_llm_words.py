"""Spelling groups, line rules and periodic runs against brute force, and their edge cases."""

from __future__ import annotations

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from test_llm_edges import ROWS, docs_of

from touchline.llm import line_rules, periodic_runs, spelling
from touchline.llm.windows import Coded


@pytest.fixture(scope="module")
def docs(spark):
    return docs_of(spark, ROWS)


def lyndon(w):
    """Longest Lyndon word at every place, from the definition."""
    n = len(w)
    fits = lambda x: all(x < x[k:] for k in range(1, len(x)))
    return [max(j - i for j in range(i + 1, n + 1) if fits(w[i:j])) for i in range(n)]


def test_lyndon_groups():
    rng = random.Random(1)
    for _ in range(600):
        w = [rng.randint(0, rng.choice([1, 2, 9])) for _ in range(rng.randint(1, 14))]
        length, group = periodic_runs.lyndon_groups(w)
        assert length == lyndon(w) and periodic_runs.lyndon_groups(w, False)[0] == lyndon([-x for x in w])
        content = {g: tuple(w[i : i + length[i]]) for i, g in enumerate(group)}
        assert all(content[g] == tuple(w[i : i + length[i]]) for i, g in enumerate(group))
        assert len(set(content.values())) == len(content)


def all_runs(w, least, power):
    found = {}
    for q in range(1, len(w) // power + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, power * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize(("least", "power"), [(24, 3), (3, 3), (12, 4)])
def test_runs(least, power):
    rng, texts = random.Random(least), []
    for _ in range(300):
        w = []
        while len(w) < rng.choice([30, 80, 200]):
            w += [rng.randint(0, rng.choice([1, 2, 30])) for _ in range(rng.choice([1, 2, 3, 5, 9, 20]))] * rng.randint(1, 6)
        texts.append(w)
    a, b = [0], [0, 1]
    while len(b) < 500:
        a, b = b, b + a
    texts += [b, [0] * 100, [], list(range(40)) * 3]
    got = periodic_runs.runs_of(Coded([" ".join(map(str, w)) for w in texts]), least, power)
    want = [all_runs(w, least, power) for w in texts]
    assert got == want and sum(map(len, want)) > 300


def test_runs_in_spark(spark, docs):
    found = {r["doc_id"]: r for r in periodic_runs.find(docs).collect()}
    assert len(found) == 8 and all(not r["runs"] for r in found.values())
    assert (found[1]["n_words"], found[1]["kept_text"]) == (0, "") and found[5]["kept_text"] == "one two"
    assert periodic_runs.find(docs.limit(0)).count() == 0
    made = {r["doc_id"]: r["text"] for r in periodic_runs.with_periods(docs).collect()}
    assert {i: made[i] for i in (1, 2, 3)} == {1: None, 2: "", 3: " \t\n "}
    for doc_id, text, _ in ROWS:
        w, h = (text or "").split(), crc32(b"%d" % doc_id) if doc_id else 1
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            assert made[doc_id] == " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(len(w)))
    none = periodic_runs.digest(periodic_runs.find(docs)).filter("doc_id = 2").first()
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert tuple(none) == (2, 0, None, None, None, None, empty, empty)
    with pytest.raises(ValueError):
        periodic_runs.find(docs, 24, 2)


def test_kept_words(spark):
    text = "start " + "a b c " * 10 + "end"
    row = periodic_runs.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 30, 3)] and row["kept_text"] == "start a b c end"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def grouped(vocab):
    """Form, root, count, near words and the form's count of every word, by comparing all pairs."""
    by = {w: [x for x in vocab if x != w and near(w, x)] for w in vocab}
    form = {}
    for w, others in by.items():
        best = min(others, key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best is not None and vocab[best] >= 2 * vocab[w] else None
    out = set()
    for w in vocab:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, vocab[w], len(by[w]), vocab[form[w]] if form[w] else None))
    return out


def some_words(seed):
    rng, words = random.Random(seed), {}
    for _ in range(60):
        w = "".join(rng.choice("abéÿz") for _ in range(rng.randint(5, 9)))
        for _ in range(8):
            words[w] = rng.randint(1, 40)
            k, kind = rng.randrange(len(w)), rng.randrange(3) if len(w) > 3 else 1
            w = w[:k] + ("" if kind == 0 else rng.choice("abéÿz")) + w[k + (kind != 1) :]
    return words


def test_spelling_groups(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SEGMENT_BLOCKS", 4)  # many segments
    for size, seed in ((64_000_000, 1), (100, 2)):  # one round, and many
        monkeypatch.setattr(spelling, "ROUND_BYTES", size)
        vocab = some_words(seed)
        df = spark.createDataFrame(list(vocab.items()), "word string, n long")
        got = [tuple(r) for r in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()]
        assert len(got) == len(vocab) and set(got) == grouped(vocab)


def test_long_words_in_pieces(monkeypatch):
    """Edits are probed a bounded number at a time, also those of one very long word."""
    monkeypatch.setattr(spelling, "EDITS", 500)
    word = "abcde" * 30
    other = [word[:70] + "z" + word[71:], word[:3] + word[4:], word[:140] + "ÿ" + word[141:]]
    totals = {149: 1, 150: 1}
    held = {149: np.zeros(1, np.uint64), 150: np.zeros(1, np.uint64)}
    for w in other:
        _, bits = spelling.place((spelling.matrix([w]) * spelling.powers(len(w))).sum(axis=1, dtype=np.uint64), 1)
        held[len(w)] |= bits
    filters = spelling.Filters(totals, [(n, 0, x.tobytes()) for n, x in held.items()])
    assert set(other) <= {x for _, x in spelling.edits(["x" * 150, word], 150, filters)}


def test_vocabulary(spark, docs):
    texts = {3: "Straße straße STRAßE naïve naïve Naïve x1y2 ×÷×÷× ×÷×÷× ×÷×÷× four four four", 97: "Straße other Other OTHER", 4: None}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    plain = {r["word"]: r["n"] for r in spelling.vocabulary(df).collect()}
    assert plain == {"straße": 4, "naïve": 3, "×÷×÷×": 3, "other": 3}
    big = spark.range(400).selectExpr("id AS doc_id", "'Banana banana bananas' AS text")
    seen = Counter()
    for i in range(400):
        for run in ("banana", "banana", "bananas"):
            h = crc32(f"{i}:{run}".encode())
            seen[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    assert {r["word"]: r["n"] for r in spelling.vocabulary(big, 97).collect()} == {w: n for w, n in seen.items() if n > 2 and len(w) > 4}
    assert spelling.vocabulary(docs, 97).count() == 0  # one, two, three ... too rare
    assert spelling.variants(spelling.vocabulary(docs, 97)).count() == 0
    assert spelling.variants(spelling.vocabulary(docs.limit(0), 97)).count() == 0


def test_chain_of_forms(spark):
    vocab = [("aaaaa" + "b" * k, 2**k) for k in range(40)]
    got = {r["word"]: r["root"] for r in spelling.variants(spark.createDataFrame(vocab, "word string, n long")).collect()}
    assert set(got.values()) == {vocab[-1][0]}


BASE = "The river ran past the old mill, and nobody there had seen it so high in years."


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        (BASE, None), ("A heading without a stop", None), ("### $$$ *** !!! done", "marks"), ("THESE WORDS ARE VERY LOUD INDEED.", "capitals"),
        ("one two three four five six seven eight nine ten eleven twelve", "unpunctuated"), ("Home | News | Sport here", "navigation"),
        ("Home About us Contact", "navigation"), ("homes about us contact", None), ("Copyright © 2020 all rights reserved.", "boilerplate"),
        ("हिन्दी में लिखा हुआ एक वाक्य यहाँ है।", None), ("这是一个句子。", None),
    ],
)
def test_line_rules(line, rule):
    assert line_rules.failed_rule(line, len(line.split())) == rule


def test_documents_that_lose_too_much(spark, docs):
    lines = [" ".join(f"{i}{c}word" for c in "abcdefghij") + "." for i in "pqrstu"]
    long = "\n".join(lines)
    texts = {
        1: long, 2: f"{long}\n\n{lines[0]}", 3: "\n".join(lines[:3]) + "\nHome | News | Sport | More | Food | Films | Books | Music | x | y | z",
        4: "too few words here", 5: None, 6: "one two three four five six seven eight. " * 9, 7: f"{long}\r\n \nx",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_rules.judge(df).collect()}
    assert {i for i, r in got.items() if r["kept"]} == {1, 2, 7}
    assert {i for i, r in got.items() if r["base_failed"]} == {4, 5, 6}
    assert got[2]["n_dup_lines"] == 1 and got[2]["kept_text"] == long + "\n" and got[1]["kept_text"] == long
    assert got[3]["n_marks"] == 1 and not got[3]["kept"]
    assert got[6]["n_repeat_words"] == 72 and got[1]["n_symbols"] == 0 and got[3]["n_symbols"] == 10
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        seen = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        inside = {k for j in range(len(w) - 7) if seen[tuple(w[j : j + 8])] > 1 for k in range(j, j + 8)}
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["n_repeat_words"]) == (len(w), sum(map(len, w)), len(inside))
    judged = line_rules.judge(docs)
    assert judged.count() == len(ROWS) and judged.filter("doc_id = 4 AND NOT base_failed AND n_words = 60000").count() == 1
    assert line_rules.judge(docs.limit(0)).count() == 0
