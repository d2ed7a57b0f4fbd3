"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree. A node of it is a path of block elements (tag and classes); it knows how
many pages have it, how differently its children are laid out there (presentation) and how differently its blocks read
(content). What is alike on every page carries no information: a node's importance is an entropy to the base of the
number of its pages, 1 for text that is new on each page, 0 for text that all of them share. The importance of a branch
mixes its own presentation with the content below it, and is scaled by the share of link text. Branches of low
importance are cut from each page. What an element says of itself (a ``nav``, a ``div id="footer"``, anything hidden)
holds for that element alone: it goes from its page and takes no part in the tree, where others may have its path.

Text inside an ``article`` or ``main`` element is cut only by what its elements say of themselves, because articles may
quote the same passage; there a class, id or role counts only if it is a whole word of the list (``notice``, not
``notice-of-death``). Elsewhere a compound goes by its last word that is not one of layout, as in ``cookie-notice`` or
``footer-links``. Formulas keep their text and lose their markup. Pages of a host with the same blocks count as one, so that copies do not look like boilerplate.
Statistics are grouped aggregations of hashes, first by page, then by node; page texts are never shuffled.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import BATCH_ROWS, batches, materialise, prepare
from touchline.llm.url_templates import host_of

LEAST = 0.2  # importance below which a branch is cut
DECAY = 0.9  # weight of the content below a node, per child
MIN_PAGES = 4  # pages a node needs for its entropy to count
LINKS = 0.6  # share of link text from which on a branch outside an article is a menu
DEEP = 32  # deeper nodes count as part of their ancestor at this depth

#: Fixed lists of HTML element names.
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody tfoot thead tr caption ul".split()
)
SPACE = frozenset("br td th wbr option".split())
RAW = frozenset("script style textarea title noscript iframe xmp template svg annotation annotation-xml object audio video canvas select button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an open element is closed by: a new one of these.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",),
    "tbody": ("tr", "tbody", "thead"), "thead": ("tr", "tbody"), "tfoot": ("tr", "tbody", "thead"),
}
#: Elements, and words of classes, ids and roles, that say a branch is not the article.
NOISE_TAGS = frozenset("nav aside footer form menu dialog search".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars menu navbar nav "
    "navigation breadcrumb breadcrumbs footer comment comments disqus replies cookie cookies consent gdpr notice notices alert popup "
    "modal newsletter subscribe subscription signup login share sharing social related recommended widget toolbar pagination pager "
    "complementary contentinfo search".split()
)
HEADER_WORDS = frozenset("header masthead topbar".split())
#: Words of layout, which do not tell what a compound names.
LAYOUT_WORDS = frozenset(
    "area bar block body bottom box center col column container content group inner item items left link links list main outer panel "
    "right row section slot text top wrap wrapper".split()
)
STATE_WORDS = frozenset("has is no with without".split())  # a compound that starts with one tells of what is inside

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>"
    r"|<(?=[/a-zA-Z])[^>]*\Z",
    re.DOTALL,
)
_MARK = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_SPACES = re.compile(r"\s+")


class Node:
    """An open element: its place in the style tree and whether it, or one it stands in, speaks against its text."""

    __slots__ = ("children", "main", "name", "noise", "path")

    def __init__(self, name: str, path: str, noise: bool, main: bool):
        self.name, self.path, self.noise, self.main, self.children = name, path, noise, main, []


def _named(token: str, inside_main: bool) -> bool:
    """Whether one class, id or role says that its element is not the article."""
    listed = NOISE_WORDS if inside_main else NOISE_WORDS | HEADER_WORDS
    if token.lower() in listed:
        return True
    if inside_main:
        return False
    words = [w.lower() for w in _WORD.findall(token)]
    if words and words[0] in STATE_WORDS:
        return False
    while len(words) > 1 and words[-1] in LAYOUT_WORDS:
        words.pop()
    return bool(words) and words[-1] in listed


def _marks(name: str, rest: str, inside_main: bool) -> tuple[str, bool]:
    """The node's label (tag, classes) and whether it names itself as noise."""
    noise = name in NOISE_TAGS or (name == "header" and not inside_main)
    label = name
    if rest:
        for m in _MARK.finditer(rest):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id", "role"):
                noise = noise or any(_named(token, inside_main) for token in value.split())
                if key == "class":
                    label += "".join(sorted(f".{re.sub('[0-9]+', '0', c)}" for c in value.split()))
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
                noise = True
        if name in ("html", "body", "article", "main"):
            noise = False
    return label, noise


def parse(page: str | None) -> tuple[list[tuple[str, str, int, bool, bool]], list[tuple[str, str]]]:
    """Blocks in page order (path, text, characters in links, noise by name, inside the article) and layouts of other nodes than noise.

    Missing end tags, stray end tags and cut-off markup are taken as browsers take them: a paragraph ends where a block
    begins, an end tag without its start is passed over, an unfinished tag at the end is dropped.
    """
    page = page or ""
    root = Node("", "", False, False)
    stack, blocks, layouts, parts = [root], [], [], []
    links, in_link, skipped = 0, False, 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = _SPACES.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                top = stack[-1]
                blocks.append((top.path, text, min(links, len(text)), top.noise, top.main))
            parts.clear()
        links = 0

    def close(depth: int) -> None:
        flush()
        while len(stack) > depth:
            node = stack.pop()
            if not node.noise:
                layouts.append((node.path, " ".join(node.children)))

    at = 0
    while True:
        m = _TAG.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece and not skipped:
            parts.append(piece)
            links += len(piece) * in_link
        if not m:
            break
        at = m.end()
        if m["name"] is None:
            continue
        name, ends = m["name"].lower(), bool(m["end"])
        if name in RAW and not ends:
            if not m["rest"].endswith("/") or name in ("script", "style"):
                over = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
                at = over.start() if over else len(page)
            parts.append(" " if name not in ("script", "style") else "")
        elif name == "head":
            skipped = 0 if ends else 1
        elif name == "body" and not ends:
            skipped = 0
        if name == "a":
            in_link = not ends
        elif name in SPACE:
            parts.append(" ")
        elif name in BLOCK:
            skipped = 0
            if ends:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name == name:
                        close(depth)
                        break
                else:
                    flush()
                continue
            if stack[-1].name == "p":
                close(len(stack) - 1)
            for closed in CLOSES.get(name, ()):
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name == closed:
                        close(depth)
                        break
                    if stack[depth].name in ("ul", "ol", "dl", "table", "div", "article", "section"):
                        break
            flush()
            top = stack[-1]
            label, noise = _marks(name, m["rest"], top.main)
            if len(stack) <= DEEP:
                top.children.append(label)
            if name in VOID:
                continue
            path = f"{top.path}/{label}" if len(stack) <= DEEP else top.path
            stack.append(Node(name, path, top.noise or noise, top.main or name in ("article", "main")))
    close(1)
    return blocks, layouts


def _key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


_SAID = pa.struct([
    ("path", pa.string()), ("kind", pa.string()), ("feature", pa.int64()), ("chars", pa.int64()), ("links", pa.int64()), ("main", pa.bool_()),
])
_PAGES = pa.schema([("host", pa.string()), ("page", pa.binary()), ("said", pa.list_(_SAID))])


def observations(page: str | None) -> tuple[bytes, list[tuple]]:
    """A hash of the page's blocks, and what it tells of its host's tree, noise by name left out.

    That is each layout and each block text of a node once: path, kind, feature, characters, those in links, in an article.
    """
    blocks, layouts = parse(page)
    blocks = [b for b in blocks if not b[3]]
    told = {("layout", path, layout): (path, "layout", _key(layout), 0, 0, False) for path, layout in layouts}
    for path, text, links, _, main in blocks:
        told.setdefault(("text", path, text), (path, "text", _key(text), len(text), links, main))
    whole = "\n".join(part for block in blocks for part in block[:2])  # neither paths nor texts have line breaks
    return xxhash.xxh3_128_digest(whole.encode("utf-8", "surrogatepass")), list(told.values())


def style_tree(pages: DataFrame) -> DataFrame:
    """``host, path, pages, importance``: the composite importance of every branch of every host's tree."""
    prepare(pages.sparkSession)

    def observe(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(
            ((host.as_py(), *observations(page.as_py())) for chunk in chunks for host, page in zip(chunk.column(0), chunk.column(1))),
            _PAGES,
            BATCH_ROWS,
        )

    told = "array<struct<path string, kind string, feature long, chars long, links long, main boolean>>"
    each = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(observe, f"host string, page binary, said {told}")
    # Copies of a page may differ in their layouts: the smallest stands for them, whatever the order of the tasks.
    distinct = each.groupBy("host", "page").agg(F.min("said").alias("said"))
    said = distinct.select("host", F.explode("said").alias("s")).select("host", "s.*")
    # Pages with a feature first, so that the text that all pages share is one row of each task.
    alike = said.groupBy("host", "path", "kind", "feature").agg(
        F.count(F.lit(1)).alias("k"), F.sum("chars").alias("chars"), F.sum("links").alias("links"),
        F.max("main").alias("main"),
    )
    layout, text = F.col("kind") == "layout", F.col("kind") == "text"
    k, k_log = F.col("k"), F.col("k") * F.log(F.col("k"))

    def total(value: Column, where: Column) -> Column:
        return F.sum(F.when(where, value).otherwise(0))

    nodes = alike.groupBy("host", "path").agg(
        total(k, layout).alias("pages"), total(k_log, layout).alias("layout_log"), total(k, text).alias("texts"),
        total(k_log, text).alias("text_log"), F.sum("chars").alias("chars"), F.sum("links").alias("links"),
        F.max("main").alias("main"),
    )
    many = F.col("pages") >= MIN_PAGES
    log_m = F.log(F.col("pages"))
    nodes = nodes.select(
        "*",
        F.when(many, 1 - F.try_divide(F.col("layout_log"), F.col("pages") * log_m)).otherwise(1.0).alias("presentation"),
        F.when(many & (F.col("texts") > 0), F.greatest(F.lit(0.0), 1 - F.try_divide(F.col("text_log"), F.col("texts") * log_m)))
        .otherwise(1.0).alias("content"),
    )
    nodes = materialise(nodes, "style-nodes")
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(2), F.greatest(F.size(steps), F.lit(2))), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    below = nodes.filter("path <> ''").select("host", F.explode(above).alias("branch"), "texts", "content", "chars", "links", "path")
    direct = F.size(F.split("path", "/")) == F.size(F.split("branch", "/")) + 1
    branches = below.groupBy("host", "branch").agg(
        F.try_divide(F.sum(F.col("texts") * F.col("content")), F.sum("texts")).alias("inside"),
        F.try_divide(F.sum("links"), F.sum("chars")).alias("linked"), F.sum(direct.cast("int")).alias("kids"),
    )
    own = nodes.select("host", F.col("path").alias("branch"), "pages", "presentation", "main")
    joined = branches.join(own, ["host", "branch"])
    decay = F.pow(F.lit(DECAY), F.col("kids"))
    mixed = (1 - decay) * F.col("presentation") + decay * F.coalesce(F.col("inside"), F.lit(1.0))
    menu = F.when(~F.col("main") & (F.coalesce(F.col("linked"), F.lit(0.0)) > LINKS), 0.0).otherwise(1.0)
    inside = F.when(F.col("main") | (F.size(F.split("branch", "/")) <= 3), 1.0).otherwise(mixed)
    return joined.select("host", F.col("branch").alias("path"), "pages", (inside * menu).alias("importance"))


def extract(pages: DataFrame, least: float = LEAST) -> DataFrame:
    """``page_id, url, text, n_chars``: one row per page, in the order of its blocks, one line a block.

    A null or empty page, or one without an article, has an empty text. Repeated rows give repeated results; pages
    without a host share the tree of the empty host. Columns other than page_id, url and html are not looked at.
    """
    prepare(pages.sparkSession)
    # One short list per host: Spark broadcasts it while it is small and else joins by host, splitting hot ones.
    cut = style_tree(pages).filter(F.col("importance") < least).groupBy("host").agg(F.collect_set("path").alias("cut"))
    cut = materialise(cut.withColumnRenamed("host", "site"), "style-cut")
    rows = pages.select("page_id", "url", "html").withColumn("site", host_of(F.col("url"))).join(cut, "site", "left")
    kinds = {f.name: f.dataType for f in pages.schema}
    schema = f"page_id {kinds['page_id'].simpleString()}, url string, text string, n_chars long"

    def read(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks:
            texts = [main_text(page.as_py(), paths.as_py() or ()) for page, paths in zip(chunk.column("html"), chunk.column("cut"))]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("page_id"), chunk.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.select("page_id", "url", "html", "cut").mapInArrow(read, schema)


def main_text(page: str | None, cut: list[str] | tuple[str, ...] = ()) -> str:
    """The blocks of a page that neither are noise by name nor, outside an article, stand in a branch to be cut."""
    known: dict[str, bool] = {}
    gone = set(cut)
    out = []
    for path, text, _, noise, main in parse(page)[0]:
        if path not in known:
            steps = path.split("/")
            known[path] = any("/".join(steps[:i]) in gone for i in range(2, len(steps) + 1))
        if not noise and (main or not known[path]):
            out.append(text)
    return "\n".join(out)
