"""URL filter: rules first, then a tree of path templates per host, judged by smoothed labelled purity.

Only DataFrame functions. Paths are cut into segments; numbers and hexadecimal ids become typed holes at once, so that
the table of templates is far smaller than the table of pages. Then the tree is built level by level: where a node has
many children, the rare ones are merged into one wildcard, but for those with enough labels of their own and those whose
share of good labels is not that of the wildcard's pool. A child whose share of good labels cannot be told from its
parent's is merged into the parent's estimate; any other gets its own, shrunk towards the parent's. A page is blocked if
the estimate of its deepest node is below ``MIN_PURITY``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import materialise, prepare

#: Fixed by the data contract.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DEPTH = 4  # levels of the tree; the last one holds the rest of a longer path as one segment
MANY = 16  # a node with more children than this has a wildcard
RARE = 1 / 64  # for its children with less than this share of its pages
ENOUGH = 30  # labels with which a child stays out of the wildcard, however rare it is
FEW = 5  # labels from which on its share of good ones is held against the wildcard's
ALIKE = 1.96  # standard errors within which a child counts as like its parent
WEIGHT = 10.0  # labels that the parent's estimate is worth
MIN_PURITY = 0.5
END = "$"  # stands for the segment after the last one


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null if none) and what it says."""
    name, says = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda x: len(x[1])):  # later ones go on top
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        name, says = F.when(fits, rule).otherwise(name), F.when(fits, verdict).otherwise(says)
    return name, says


def typed(segment: Column) -> Column:
    """A path segment with typed holes for ids."""
    hexadecimal = segment.rlike(r"(?i)^(?=.*[0-9])[0-9a-f]{8,}(-[0-9a-f]{4,})*$") & ~segment.rlike("^[0-9]+$")
    return F.when(hexadecimal, "{h}").otherwise(F.regexp_replace(segment, "[0-9]+", "{n}"))


def segments(path: Column, depth: int = DEPTH) -> list[Column]:
    """``depth`` columns: the typed segments, then the end mark; what is deeper stays with the last."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", depth)
    return [F.when(F.size(parts) > i, typed(F.get(parts, F.lit(i)))).otherwise(END).alias(f"s{i + 1}") for i in range(depth)]


def template_tree(
    urls: DataFrame, depth: int = DEPTH, many: int = MANY, rare: float = RARE, alike: float = ALIKE, weight: float = WEIGHT
) -> DataFrame:
    """From ``host, s1.. , good`` (1, 0 or null: no label) one row per template as typed, with its place in the tree.

    Returns ``host, s1.., template, purity, n, labelled``. A host without labels has the purity of all hosts; without
    any label at all it is 1 (nothing speaks against a page). The work after the first aggregation is on templates.
    """
    spark = prepare(urls.sparkSession)
    keys = [f"s{i + 1}" for i in range(depth)]
    known = F.col("good").isNotNull().cast("long")
    tree = urls.groupBy("host", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(known).alias("labelled"), F.sum(F.coalesce(F.col("good"), F.lit(0))).cast("long").alias("good")
    )
    tree = materialise(tree, "url-templates")
    totals = tree.agg(F.sum("labelled").alias("l"), F.sum("good").alias("g"))  # one row
    prior = F.when(F.col("l") > 0, F.col("g") / F.col("l")).otherwise(1.0)
    hosts = tree.groupBy("host").agg(F.sum("labelled").alias("l"), F.sum("good").alias("g"))
    hosts = hosts.crossJoin(F.broadcast(totals.select(prior.alias("prior"))))
    hosts = hosts.select("host", ((F.col("g") + weight * F.col("prior")) / (F.col("l") + weight)).alias("purity"))
    tree = materialise(tree.join(hosts, "host"), "url-hosts")
    for level in range(depth):
        up, key = ["host", *[f"t{i + 1}" for i in range(level)]], keys[level]
        sums = [F.sum(c).alias(c) for c in ("n", "labelled", "good")]
        child = tree.groupBy(*up, key).agg(*sums, F.first("purity").alias("above"))
        node = child.groupBy(*up).agg(
            F.count(F.lit(1)).alias("kids"), *[F.sum(c).alias(f"node_{c}") for c in ("n", "labelled", "good")]
        )
        wild = (F.col("kids") > many) & (F.col("n") < rare * F.col("node_n")) & (F.col(key) != END)
        wild &= F.col("labelled") < ENOUGH
        child = materialise(child.join(node, up).withColumn("wild", wild), "url-child")
        pool = child.filter("wild").groupBy(*up).agg(F.try_divide(F.sum("good"), F.sum("labelled")).alias("pool"))
        off = F.abs(F.try_divide("good", "labelled") - F.col("pool"))
        apart = (F.col("labelled") >= FEW) & (off > alike * F.sqrt(F.try_divide(F.col("pool") * (1 - F.col("pool")), F.col("labelled"))))
        child = child.join(pool, up, "left").withColumn(
            f"t{level + 1}", F.when(F.col("wild") & ~F.coalesce(apart, F.lit(False)), "*").otherwise(F.col(key))
        )
        child = materialise(child, "url-level")
        branch = child.groupBy(*up, f"t{level + 1}").agg(
            *sums, *[F.first(c).alias(c) for c in ("above", "node_labelled", "node_good")]
        )
        share, mean = F.try_divide("good", "labelled"), F.try_divide("node_good", "node_labelled")
        error = F.sqrt(F.try_divide(mean * (1 - mean), F.col("labelled")))
        merged = (F.col("labelled") == 0) | (F.abs(share - mean) <= alike * error)
        own = (F.col("good") + weight * F.col("above")) / (F.col("labelled") + weight)
        branch = branch.select(*up, f"t{level + 1}", F.when(merged, F.col("above")).otherwise(own).alias("purity"))
        places = child.select(*up, key, f"t{level + 1}").join(branch, [*up, f"t{level + 1}"])
        tree = materialise(tree.drop("purity").join(places, [*up, key]), "url-tree")
    parts = [F.when(F.col(f"t{i + 1}") != END, F.concat(F.lit("/"), f"t{i + 1}")).otherwise("") for i in range(depth)]
    return tree.select("host", *keys, F.concat(*parts).alias("template"), "purity", "n", "labelled")


def judge(
    pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES, min_purity: float = MIN_PURITY, **tree: float
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity``, one row per page.

    ``labels`` has ``doc_id, quality`` (1 good, 0 bad; the mean if an id has several); a url belongs to the document
    whose id is the last number of its path. A null url, or one without ``://``, has an empty host and path. Without
    any label every page that no rule blocks is allowed. Repeated pages are judged alike, other columns not looked at.
    """
    prepare(pages.sparkSession)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.select("*", *segments(F.col("path")))
    doc = F.expr("try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) AS bigint)")
    quality = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    quality = quality.agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    labelled = urls.withColumn("doc_id", doc).join(quality, "doc_id", "left")
    made = template_tree(labelled, **tree)
    keys = ["host", *[f"s{i + 1}" for i in range(DEPTH)]]
    rows = urls.join(made.select(*keys, "template", "purity"), keys)
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") < min_purity, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(says, method).alias("verdict"), "template", "purity")
