"""The registered queries of the text operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    decontamination,
    embedding_graph,
    line_rules,
    mixing,
    near_duplicates,
    periodic_runs,
    pii,
    quality,
    site_style,
    spelling,
    substring_dedup,
    toxicity,
    url_templates,
)
from touchline.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that stand in repeated windows, as a digest."""
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return site_style.extract(table(spark, sf_dir, "pages"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of a similarity of 0.85 or more."""
    return near_duplicates.find(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posterior of every document and whether it is kept."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op5_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return url_templates.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark items."""
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.find(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of every document and whether it is rejected."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector under a cosine of 0.9 or more."""
    return embedding_graph.find(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document under the default weights."""
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every frequent word of the documents."""
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents"), spelling.TYPO))


def op12_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict on every document."""
    out = line_rules.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of them made periodic, as digests."""
    return periodic_runs.digest(periodic_runs.find(periodic_runs.with_periods(table(spark, sf_dir, "documents"))))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup, "op2_site_style": op2_site_style, "op3_near_duplicates": op3_near_duplicates,
    "op4_quality": op4_quality, "op5_url_templates": op5_url_templates, "op6_decontamination": op6_decontamination,
    "op7_pii": op7_pii, "op8_toxicity": op8_toxicity, "op9_embedding_graph": op9_embedding_graph, "op10_mixing": op10_mixing,
    "op11_spelling": op11_spelling, "op12_line_rules": op12_line_rules, "op13_periodic_runs": op13_periodic_runs,
}
SQL = {
    "op10_mixing": mixing.MIX_SQL, "op11_spelling": spelling.SPELLING_SQL, "op12_line_rules": line_rules.RULES_SQL,
    "op13_periodic_runs": periodic_runs.RUNS_SQL,
}
