"""Toxicity by a classifier chain.

The categories are predicted one after the other. Each is a linear (logistic) model over the presence of the words, and
beginnings of words, that tell toxic from other documents, and every model after the first also sees the probabilities of the categories before
it. In training those come from folds the document was not part of, so that a later model learns how far an earlier one
can be trusted. The models are fitted on a bounded sample of labelled documents (``PER_CLASS``); the words are chosen
by Spark over that sample, the fit itself works on a small 0/1 matrix. Scoring covers every document.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import materialise, prepare

PER_CLASS = 4000  # labelled documents per class that the fit sees, by hash of the id
FEATURES, LEAST = 256, 3.0  # words with the strongest evidence, and the standard errors it has at least
STEM = 4  # bytes of a word's beginning
FOLDS = 5
RIDGE = 1.0
REJECT = 0.5  # probability of the last category from which on a document is toxic

#: Common English insults that mark the finer categories; a labelled toxic document with one of them is an example.
SEEDS = {
    "insult": ("idiot", "moron", "fool", "clown", "loser", "scum", "jerk", "imbecile"),
    "contempt": ("stupid", "dumb", "worthless", "pathetic", "disgusting", "trash", "garbage", "filthy"),
}

# ASCII letters in lower case, every other ASCII character a space, other bytes (letters of other scripts) as they are.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def distinct_words(text: str | None) -> set[bytes]:
    """The words of a whole text in lower case, and the first ``STEM`` bytes of longer ones as words of their own kind.

    Beginnings carry evidence from the inflected and compound forms of a word that are too rare to be chosen themselves.
    """
    words = set(text.encode("utf-8", "surrogatepass").translate(_FOLD).split()) if text else set()
    return words | {b"^" + w[:STEM] for w in words if len(w) > STEM}


@dataclass(frozen=True)
class Chain:
    """Words, and per category an intercept, a weight per word and a weight per earlier category."""

    words: tuple[bytes, ...]
    categories: tuple[str, ...]
    weights: tuple[np.ndarray, ...]

    def probabilities(self, present: np.ndarray) -> np.ndarray:
        out = np.empty((len(present), 0))
        for w in self.weights:
            out = np.column_stack([out, _sigmoid(np.column_stack([np.ones(len(present)), present, out]) @ w)])
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray | None = None, ridge: float = RIDGE, steps: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression (Newton steps); the first column, the intercept, is not shrunk."""
    w = np.zeros(x.shape[1]) if start is None else start.copy()
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, x.T @ (p - y) + penalty * w)
        w = w - move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-3:
            break
    return w


def fit_chain(present: np.ndarray, targets: np.ndarray, folds: np.ndarray, n_folds: int = FOLDS) -> list[np.ndarray]:
    """Weights of every link; earlier probabilities are out of fold."""
    links, earlier = [], np.empty((len(present), 0))
    for k in range(targets.shape[1]):
        x, y = np.column_stack([np.ones(len(present)), present, earlier]), targets[:, k]
        links.append(_logistic(x, y))
        outside = np.empty(len(y))
        for f in range(n_folds):
            held = folds == f
            if held.any():
                outside[held] = _sigmoid(x[held] @ (_logistic(x[~held], y[~held], links[-1]) if (~held).any() else links[-1]))
        earlier = np.column_stack([earlier, outside])
    return links


def train(
    docs: DataFrame, labels: DataFrame, seeds: Mapping[str, Sequence[str]] = SEEDS, per_class: int = PER_CLASS,
    features: int = FEATURES, folds: int = FOLDS,
) -> Chain | None:
    """The chain ``*seeds, toxic`` from ``labels`` (doc_id, toxic); None if there are not labelled documents of both kinds.

    Null ids and null labels are left out, an id with several labels counts as toxic if any of them says so.
    """
    prepare(docs.sparkSession)
    truth = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in truth.groupBy("toxic").count().collect()}  # two rows
    if not sizes.get(0) or not sizes.get(1):
        return None
    order = F.xxhash64("doc_id")
    picked = [truth.filter(F.col("toxic") == c).orderBy(order, "doc_id").limit(per_class) for c in (0, 1)]
    picked = materialise(picked[0].unionByName(picked[1]), "toxic-sample").withColumnRenamed("doc_id", "id")

    @F.pandas_udf("array<binary>")
    def bag(text: pd.Series) -> pd.Series:
        return text.map(lambda t: sorted(distinct_words(t)))

    # The sample has at most 2 x per_class rows, so it is broadcast and the documents are not moved.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("id"))
    rows = materialise(rows.select("doc_id", "toxic", bag("text").alias("words")), "toxic-bags")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return None
    seen = rows.select("toxic", F.explode("words").alias("word")).groupBy("word")
    seen = seen.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    bad, good = (F.col("a") + 0.5) / (n[1] + 1.0), (F.col("b") + 0.5) / (n[0] + 1.0)
    spread = F.sqrt(bad * (1 - bad) / n[1] + good * (1 - good) / n[0])
    evidence = F.abs(bad - good) / spread
    strongest = seen.filter(evidence >= LEAST).orderBy(evidence.desc(), "word").limit(features).collect()
    vocabulary = tuple(sorted(bytes(r["word"]) for r in strongest))
    kept = F.array_intersect("words", F.array(*[F.lit(w) for w in vocabulary]).cast("array<binary>"))
    marks = {name: F.arrays_overlap("words", F.array(*[F.lit(w.encode()) for w in some])) for name, some in seeds.items()}
    sample = rows.select(
        "doc_id", "toxic", kept.alias("words"), *[(m & (F.col("toxic") == 1)).cast("int").alias(f"is_{k}") for k, m in marks.items()]
    ).orderBy("doc_id", "toxic").toPandas()  # at most 2 x per_class short rows
    place = {w: i for i, w in enumerate(vocabulary)}
    present = np.zeros((len(sample), len(vocabulary)))
    for i, found in enumerate(sample["words"]):
        present[i, [place[bytes(w)] for w in found]] = 1.0
    targets = sample[[*[f"is_{k}" for k in seeds], "toxic"]].to_numpy(float)
    links = fit_chain(present, targets, np.arange(len(sample)) % folds, folds)
    links[-1][0] += np.log(sizes[1] / sizes[0]) - np.log(n[1] / n[0])  # back to the classes' share among all labels
    return Chain(vocabulary, (*seeds, "toxic"), tuple(links))


def score(chain: Chain | None, categories: Sequence[str] = (*SEEDS, "toxic")):
    """A function of a text column: a struct with the probability of every category (0 without a model)."""
    names = chain.categories if chain else tuple(categories)
    place = {w: i for i, w in enumerate(chain.words)} if chain else {}

    @F.pandas_udf(", ".join(f"{name} double" for name in names))
    def probabilities(text: pd.Series) -> pd.DataFrame:
        present = np.zeros((len(text), len(place)))
        vocabulary = place.keys()
        for i, t in enumerate(text):
            if found := distinct_words(t) & vocabulary:
                present[i, [place[w] for w in found]] = 1.0
        p = chain.probabilities(present) if chain else np.zeros((len(text), len(names)))
        return pd.DataFrame(p, columns=list(names))

    return probabilities


def is_toxic(p: Column, reject: float = REJECT) -> Column:
    return p.getField("toxic") >= reject


def classify(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """``doc_id, p_insult, p_contempt, p_toxic, toxic, kept``: one row per input row, repeated rows and null ids too.

    Null and empty texts have no words and get the base rate. Without labels of both kinds every probability is 0.
    Columns of ``docs`` other than doc_id and text are not looked at.
    """
    chain = train(docs, labels)
    rows = docs.select("doc_id", score(chain)("text").alias("p"))
    names = chain.categories if chain else (*SEEDS, "toxic")
    return rows.select(
        "doc_id", *[F.col(f"p.{name}").alias(f"p_{name}") for name in names],
        is_toxic(F.col("p"), reject).alias("toxic"), (~is_toxic(F.col("p"), reject)).alias("kept"),
    )


def remove_toxic(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their columns."""
    return docs.filter(~is_toxic(score(train(docs, labels))("text"), reject))
