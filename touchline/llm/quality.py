"""Quality by hierarchical empirical Bayes.

A linear classifier on bounded features of the text gives the evidence of the document itself. The site adds its own: the
labelled documents of a host, and of a directory on it, have a share of good ones, and each level is shrunk towards the
one above by as much as the levels differ at all. The strength of the shrinkage is not set by hand: it is the
number of labels that the parent's share is worth, estimated over all hosts (all directories) from how far their shares
scatter beyond chance (the beta-binomial method of moments). A sparse site so falls back on the global prior, a large
one speaks for itself. The document's posterior odds are the classifier's likelihood ratio times the odds of its place.

All counts are grouped sums over all labels; a document's own label never enters its place's share.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import materialise, prepare
from touchline.llm.toxicity import _logistic
from touchline.llm.url_templates import host_of, path_of

PER_CLASS = 4000  # labelled documents per class that the classifier's fit sees, by hash of the id
KEEP = 0.5  # posterior from which on a document is kept
WEAKEST, STRONGEST = 1.0, 1000.0  # bounds of the number of labels a parent is worth

NAMES = (
    "log_words", "word_length", "upper", "digits", "marks", "bars", "stops", "capital_words", "distinct_words", "repeated_lines",
    "line_words", "odd_words", "non_ascii", "longest_word",
)
_MARKS = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_UPPER, _DIGITS, _HIGH = bytes(range(65, 91)), bytes(range(48, 58)), bytes(range(128, 256))


def features(text: str | None) -> np.ndarray:
    """Shares and means that describe the form of a whole text; zeros without words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.zeros(len(NAMES))
    n, size = len(words), len(raw)
    lengths = np.fromiter(map(len, words), dtype=float, count=n)
    lines = [x for x in raw.split(b"\n") if x]
    marks = size - len(raw.translate(None, _MARKS))
    ends = sum(raw.count(x) for x in (b". ", b".\n", b"? ", b"! "))
    return np.array([
        np.log1p(n), min(lengths.mean(), 30.0), (size - len(raw.translate(None, _UPPER))) / size,
        (size - len(raw.translate(None, _DIGITS))) / size, marks / n, raw.count(b"|") / n, ends / n, sum(map(bytes.isupper, words)) / n,
        len(set(words)) / n, 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), float((lengths > 20).mean()),
        (size - len(raw.translate(None, _HIGH))) / size,
        np.log1p(lengths.max()),
    ])


def evidence(weights: tuple[np.ndarray, np.ndarray, np.ndarray] | None):
    """A function of a text column: the log likelihood ratio of good against bad."""

    @F.pandas_udf("double")
    def ratio(text: pd.Series) -> pd.Series:
        if weights is None:
            return pd.Series(np.zeros(len(text)))
        w, mean, scale = weights
        x = (np.array([features(t) for t in text]).reshape(-1, len(NAMES)) - mean) / scale
        return pd.Series(np.clip(x @ w[1:] + w[0], -20, 20))

    return ratio


def train(docs: DataFrame, truth: DataFrame, per_class: int = PER_CLASS) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Weights of the classifier for balanced classes, with the features' means and scales, from ``id, good``.

    None unless there are labelled documents of both kinds.
    """
    picked = [truth.filter(F.col("good") == c).orderBy(F.xxhash64("id"), "id").limit(per_class) for c in (0, 1)]
    picked = materialise(picked[0].unionByName(picked[1]), "quality-sample")

    @F.pandas_udf("array<double>")
    def described(text: pd.Series) -> pd.Series:
        return text.map(lambda t: features(t).tolist())

    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("id"))  # 2 x per_class rows at most
    rows = rows.select("doc_id", "good", described("text").alias("x")).toPandas().sort_values(["doc_id", "good"])
    y = rows["good"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.array(rows["x"].tolist())
    mean, scale = x.mean(0), x.std(0) + 1e-9
    x = (x - mean) / scale
    w = _logistic(np.column_stack([np.ones(len(x)), x]), y)
    w[0] -= np.log(y.mean() / (1 - y.mean()))  # the prior comes from the place
    return w, mean, scale


def strength(groups: DataFrame, mean: Column) -> float:
    """Labels that the parent's share is worth for ``n, good`` groups with parent share ``mean``, by moments.

    With shares that scatter with variance v around the parent's m, a group's expected squared deviation is
    m (1 - m) (1 + (n - 1) r) / n with r = 1 / (strength + 1); solved for r over all groups with two labels or more.
    """
    some = groups.filter("n >= 2").select("n", "good", mean.alias("m")).filter("m > 0 AND m < 1")
    row = some.select(
        (F.pow(F.col("good") - F.col("n") * F.col("m"), 2) / (F.col("m") * (1 - F.col("m"))) - F.col("n")).alias("over"),
        (F.col("n") * (F.col("n") - 1)).alias("room"),
    ).agg(F.sum("over").alias("over"), F.sum("room").alias("room")).first()  # one row
    if not row["room"]:
        return STRONGEST
    r = min(max(row["over"] / row["room"], 1 / (STRONGEST + 1)), 1 / (WEAKEST + 1))
    return 1 / r - 1


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(/[^/]*)/", 1)


def classify(docs: DataFrame, pages: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """``doc_id, host, directory, evidence, host_share, place_share, posterior, kept``: one row per input row.

    ``labels`` has ``doc_id, quality``; a document's place is the url of ``pages`` whose last number is its id (the first
    by text if it has several). Without a page the place is the empty host, whose share is that of such documents. Null
    and empty texts have zero features; without labels of both kinds the evidence is 0 and the shares are 1 (nothing
    speaks against a document). Other columns are not looked at. Rows that repeat an id are judged alike but for
    their texts.
    """
    prepare(docs.sparkSession)
    truth = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
    truth = materialise(truth.agg((F.avg("quality") >= 0.5).cast("int").alias("good")), "quality-labels")
    weights = train(docs, truth)
    path = path_of(F.col("url"))
    number = F.expr("try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) AS bigint)")
    places = pages.select(host_of(F.col("url")).alias("host"), path.alias("path"))
    places = places.withColumn("id", number).filter("id IS NOT NULL").groupBy("id")
    places = places.agg(F.min(F.struct("host", _directory(F.col("path")).alias("directory"))).alias("place")).select("id", "place.*")
    # Evidence first, so that texts are not moved by the joins.
    rows = docs.select(F.col("doc_id"), F.col("doc_id").cast("long").alias("id"), evidence(weights)("text").alias("evidence"))
    rows = rows.join(places, "id", "left").join(truth, "id", "left").withColumn("host", F.coalesce("host", F.lit("")))
    rows = materialise(rows.withColumn("directory", F.coalesce("directory", F.lit(""))), "quality-rows")
    told = rows.filter("good IS NOT NULL").groupBy("host", "directory").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"))
    told = materialise(told, "quality-directories")
    hosts = told.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()  # one row
    prior = total["good"] / total["n"] if total["n"] else 1.0
    alpha = strength(hosts, F.lit(prior))
    host_share = (F.col("host_good") + alpha * prior) / (F.col("host_n") + alpha)
    hosts = hosts.select("host", F.col("n").alias("host_n"), F.col("good").alias("host_good"))
    directories = told.join(hosts, "host")
    beta = strength(directories, host_share)
    directories = directories.select("host", "directory", F.col("n").alias("dir_n"), F.col("good").alias("dir_good"))
    out = rows.join(hosts, "host", "left").join(directories, ["host", "directory"], "left")
    out = out.fillna(0, ["host_n", "host_good", "dir_n", "dir_good"])
    mine, well = F.col("good").isNotNull().cast("int"), F.coalesce(F.col("good"), F.lit(0))  # the document's own label is left out
    shared = (F.col("host_good") - well + alpha * prior) / (F.col("host_n") - mine + alpha)
    placed = (F.col("dir_good") - well + beta * F.col("host_share")) / (F.col("dir_n") - mine + beta)
    out = out.withColumn("host_share", shared).withColumn("place_share", placed)
    safe = F.least(F.greatest(F.col("place_share"), F.lit(1e-6)), F.lit(1 - 1e-6))
    posterior = 1 / (1 + F.exp(-(F.col("evidence") + F.log(safe / (1 - safe)))))
    return out.select(
        "doc_id", "host", "directory", "evidence", "host_share", "place_share", posterior.alias("posterior"), (posterior >= keep).alias("kept")
    )
