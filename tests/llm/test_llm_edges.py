"""Every text operator on empty tables, nulls, empty and very long texts, repeated rows and clashing extra columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from touchline.llm import (
    decontamination,
    embedding_graph,
    mixing,
    near_duplicates,
    pii,
    quality,
    site_style,
    substring_dedup,
    toxicity,
    url_templates,
)

DOCS = "doc_id long, text string, source string, lang string, key string, n long, component string, unit string, rank int"
LONG = " ".join(f"w{i}" for i in range(60_000))
ROWS = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, LONG, "a"), (5, "one two", "b"), (5, "one two", "b"),
    (None, "one two", None), (6, "one two three four five six seven", "b"), (7, "one two three four five six seven", "b"),
]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "x", 0, "x", "x", 0) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return docs_of(spark, ROWS)


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(6, 1, 0), (5, 0, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, None, None), (2, "no scheme", ""), (3, "http://a.b/x/6", "<p>t"), (3, "http://a.b/x/6", "<p>t"), (None, "://", "<nav>x</nav>y"),
        (4, "http://A.b/x/5?q", "<p>" + LONG), (5, "http://a.b#f", "just text"),
    ]
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, host string, site string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_substring(docs, none):
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(docs).collect()}
    assert len(rows(substring_dedup.remove_repeats(docs))) == len(ROWS)
    assert (got[1]["n_words"], got[1]["kept_text"]) == (0, "") and got[3]["n_words"] == 0
    assert got[4]["n_words"] == 60_000 and got[4]["n_removed"] == 0 and got[4]["kept_text"] == LONG
    assert got[5]["kept_text"] == "one two" and None in got
    assert rows(substring_dedup.remove_repeats(none)) == []


def test_near_duplicates(docs, none):
    got = rows(near_duplicates.find(docs).select("doc_id", "n_shingles", "component_id", "kept"))
    assert sorted(got, key=str) == sorted(
        [
            (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 59_996, 4, True), (5, 1, 5, True), (5, 1, 5, True),
            (None, 1, None, True), (6, 3, 6, True), (7, 3, 6, False),
        ],
        key=str,
    )
    assert rows(near_duplicates.find(none)) == []
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 1
    assert near_duplicates.keep_one(none).count() == 0


def test_quality(docs, none, pages, labels):
    got = quality.classify(docs, pages, labels)
    assert got.count() == len(ROWS) and got.filter("posterior IS NULL OR kept IS NULL").count() == 0
    assert quality.classify(none, pages, labels).count() == 0
    alone = quality.classify(docs, pages.limit(0), labels.limit(0))
    assert alone.filter("kept AND evidence = 0 AND host = ''").count() == len(ROWS)


def test_urls(pages, labels):
    got = {r["page_id"]: r for r in url_templates.judge(pages, labels).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"]) == ("", "", None)
    assert (got[4]["host"], got[4]["path"]) == ("a.b", "/x/5") and (got[5]["host"], got[5]["path"]) == ("a.b", "")
    assert url_templates.judge(pages, labels).count() == 7
    assert url_templates.judge(pages, labels.limit(0)).filter("verdict = 'allow'").count() == 7
    assert url_templates.judge(pages.limit(0), labels).count() == 0


def test_pages(pages):
    got = site_style.extract(pages)
    assert got.count() == 7
    by = {r["page_id"]: r["text"] for r in got.collect()}
    assert by[1] == "" and by[2] == "" and by[3] == "t" and by[None] == "y" and by[4] == LONG and by[5] == "just text"
    assert got.filter("n_chars <> length(text)").count() == 0
    assert site_style.extract(pages.limit(0)).count() == 0


def test_decontamination(spark, docs, none):
    schema = "item_id long, text string, doc_id string"
    items = spark.createDataFrame([(9, "one two three four five six seven", ""), (8, "one two three four five six seven", ""), (None, None, ""), (1, "", "")], schema)
    got = decontamination.contamination(docs, items)
    assert [(r["doc_id"], r["item_ids"]) for r in got.orderBy("doc_id").collect()] == [(6, [8]), (7, [8])]
    kept = decontamination.remove_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 2
    assert decontamination.contamination(none, items).count() == 0
    assert decontamination.contamination(docs, items.limit(0)).count() == 0
    assert decontamination.remove_contaminated(docs, items.limit(0)).count() == len(ROWS)


def test_pii(docs, none):
    got = pii.find(docs)
    assert got.count() == len(ROWS) and got.filter("n_email + n_ip + n_card + n_phone > 0").count() == 0
    assert got.filter("doc_id = 1 AND spans = ''").count() == 1
    masked = pii.redact(docs)
    assert masked.columns == docs.columns and masked.filter("doc_id = 1 AND text IS NULL").count() == 1
    assert pii.find(none).count() == 0 and pii.redact(none).count() == 0


def test_toxicity(docs, none, labels):
    got = toxicity.classify(docs, labels)
    assert got.count() == len(ROWS) and got.filter("p_toxic IS NULL OR toxic = kept").count() == 0
    assert toxicity.classify(docs, labels.limit(0)).filter("kept AND p_toxic = 0").count() == len(ROWS)
    assert toxicity.classify(none, labels).count() == 0
    assert toxicity.remove_toxic(docs, labels.limit(0)).columns == docs.columns


def test_embeddings(spark):
    near = [1.0, 0.1]
    vectors = [
        (1, [1.0, 0.0]), (2, near), (2, near), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]),
        (None, [1.0, 0.0]), (8, [float("inf"), 0.0]), (9, [0.0, -1e200]),
    ]
    df = spark.createDataFrame([(*v, 0, "x") for v in vectors], "vec_id long, embedding array<double>, label int, shard string")
    got = rows(embedding_graph.find(df).select("vec_id", "n_links", "component_id", "kept"))
    want = [(1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False), (None, 0, None, True), (9, 0, 9, True)]
    want += [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8)]
    assert got == sorted(want, key=str)
    assert embedding_graph.find(df.limit(0)).count() == 0


def test_mixing(docs, none):
    got = mixing.mix(docs)
    assert got.count() == len(ROWS) and got.filter("taken > 3 * size OR (size = 0 AND taken > 0)").count() == 0
    assert mixing.mix(none).count() == 0
    out = mixing.mixed(docs)
    assert out.columns == [*docs.columns, "copies"] and out.filter("copies < 1").count() == 0
    assert mixing.mixed(none).count() == 0
    # Equal ranks: rows that repeat an id.
    assert got.filter("doc_id = 5").select("taken").distinct().count() <= 2
    assert got.agg(F.sum("size")).first()[0] == 60_000 + 2 * 3 + 14


CLASHES = ["gone_id", "gone", "mix_id", "mix_source", "mix_size", "mix_words", "words", "words_id", "copies", "item_ids", "windows", "found", "size", "node", "key", "class_id", "contaminated", "p_toxic", "toxic", "kept"]


@pytest.mark.parametrize("name", ["toxicity", "near_duplicates", "decontamination", "pii", "mixing"])
def test_pipeline_stages(spark, name):
    """Extra columns of any name, rows that repeat, and an empty table, in every stage."""
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = docs_of(spark, [*ROWS, *(ROWS[:5] * 2)]).select("doc_id", "text", "source", "lang").withColumn("n_chars", F.length("text").cast("long"))
    wide = docs.withColumns({c: F.lit("mine") for c in CLASHES})
    out = stage(spark, wide, folder)
    assert out.columns == [c for c in wide.columns if name != "mixing" or c != "copies"] + ["copies"] * (name == "mixing")
    got = out.collect()
    assert got and all(r[c] == "mine" for r in got for c in CLASHES if c != "copies" or name != "mixing")
    plain = stage(spark, docs, folder)
    assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(str(r["doc_id"]) for r in plain.collect())
    empty = stage(spark, docs.limit(0), folder)
    assert empty.columns == plain.columns and empty.count() == 0
