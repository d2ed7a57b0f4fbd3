"""Quality rules, line first: lines that fail a rule go, then documents that lost too much text.

Each text is judged by itself, in the task that reads it; nothing is shuffled.

A line (the text between two ``\\n``) without a word is no line. The others go when one of these holds:

* ``repeated``: an earlier line of the text is equal to it;
* ``marks``: more than ``MARKS_PERCENT`` of its non-space characters are punctuation or symbols;
* ``capitals``: at least ``CAPITALS`` upper-case letters, and more than half of its letters are;
* ``unpunctuated``: ``SENTENCE_WORDS`` words or more without any mark that ends or divides a sentence;
* ``navigation``: two or more menu separators with at most ``ITEM_WORDS`` words an item on average, or menu words alone;
* ``boilerplate``: at most ``NOTICE_WORDS`` words, one of the phrases of notices among them.

A document is kept if its base figures pass (enough words, few of them in repeated windows) and its lines lost no more
than ``LOSS_PERCENT`` of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import prepare, words
from touchline.llm.windows import Coded, covered, slices

LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30  # fixed by the contract, like the next line
SYMBOLS = "#*$%&|<>"

MARKS_PERCENT, CAPITALS, SENTENCE_WORDS, ITEM_WORDS, NOTICE_WORDS, LOSS_PERCENT = 15, 16, 12, 4, 40, 30
SEPARATORS = "|»›•·>"
SENTENCE_MARKS = ".!?…:;,。！？，、；：।؟،۔"
MENU = "home|about us|about|contact us|contact|menu|search|log ?in|sign in|sign up|register|next|previous|back to top|read more|share|skip to content|sitemap|help|faq"
NOTICE = (
    "all rights reserved|privacy policy|cookie policy|uses? cookies|terms of (?:use|service)|terms and conditions|lorem ipsum"
    "|click here|(?:enable|requires) javascript|subscribe to our|powered by|copyright ©|©|licensed under|permission is hereby granted"
)
_SPACE = "\x20\x09-\x0d"
_MENU_LINE = f"^[{_SPACE}]*(?:(?:{MENU})(?:[{_SPACE}{SEPARATORS}/,-]+|$))+$"
_MARKS, _UPPER, _LETTER = regex.compile(r"[\p{P}\p{S}]"), regex.compile(r"\p{Lu}"), regex.compile(r"\p{L}")
_STOP, _SPLIT = regex.compile(f"[{SENTENCE_MARKS}]"), regex.compile(f"[{regex.escape(SEPARATORS)}]")
_MENU, _NOTICE = regex.compile(_MENU_LINE, regex.I), regex.compile(NOTICE, regex.I)

RULES = ("repeated", "marks", "capitals", "unpunctuated", "navigation", "boilerplate")


def failed_rule(line: str, size: int) -> str | None:
    """The first rule, of those that look at a line alone, that a line of ``size`` words fails."""
    marks = len(_MARKS.findall(line))
    chars = len(line) - sum(map(line.count, " \t\n\x0b\x0c\r"))
    if 100 * marks > MARKS_PERCENT * chars:
        return "marks"
    upper = len(_UPPER.findall(line))
    if upper >= CAPITALS and 2 * upper > len(_LETTER.findall(line)):
        return "capitals"
    if size >= SENTENCE_WORDS and not _STOP.search(line):
        return "unpunctuated"
    cuts = len(_SPLIT.findall(line))
    if (cuts >= 2 and size - cuts <= ITEM_WORDS * (cuts + 1)) or _MENU.search(line):
        return "navigation"
    if size <= NOTICE_WORDS and _NOTICE.search(line):
        return "boilerplate"
    return None


def clean(text: str | None) -> tuple[list[str], list[int], int]:
    """The lines that stay, how many lines each rule removed, and the words of the lines that stay."""
    stay, gone, kept, seen = [], [0] * len(RULES), 0, set()
    for line in (text or "").split("\n"):
        size = len(words(line))
        if not size:
            stay.append(line)
            continue
        rule = "repeated" if line in seen else failed_rule(line, size)
        seen.add(line)
        if rule is None:
            stay.append(line)
            kept += size
        else:
            gone[RULES.index(rule)] += 1
    return stay, gone, kept


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_kept_words", *(f"n_{r}" for r in RULES))
_SCHEMA = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("kept_text", pa.string())])


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``, then ``n_kept_words``, the
    lines each rule removed and ``kept_text``, the lines that stay: one row per input row.

    A null or empty text, or one without words, has counts of 0 and fails the base rules. Lines without words stay, so
    that paragraphs stay apart. Equal rows have equal results. Columns other than doc_id and text are not looked at.
    """
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            coded = Coded(texts)
            again = np.flatnonzero(coded.repeats(REPEAT_WINDOW))
            inside = covered(len(coded.codes), again, again + REPEAT_WINDOW)
            repeat = np.diff(np.concatenate([[0], np.cumsum(inside)])[coded.starts])
            cleaned = [clean(t) for t in texts]
            columns = [
                coded.sizes,
                [len(t) - sum(map(t.count, " \t\n\x0b\x0c\r")) for t in texts],
                [sum(map(t.count, SYMBOLS)) for t in texts],
                [gone[0] for _, gone, _ in cleaned],
                repeat,
                [kept for *_, kept in cleaned],
                *zip(*(gone for _, gone, _ in cleaned)),
            ]
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in columns), pa.array(["\n".join(stay) for stay, *_ in cleaned], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(count, ", ".join(["doc_id long", *(f"{c} long" for c in _COUNTS), "kept_text string"]))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    enough = 100 * (F.col("n_words") - F.col("n_kept_words")) <= LOSS_PERCENT * F.col("n_words")
    return out.withColumns({"base_failed": failed, "kept": ~failed & enough}).select(
        "doc_id", *_COUNTS[:5], "base_failed", "kept", *_COUNTS[5:], "kept_text"
    )


def _sql() -> str:
    """The same judgement as SQL."""
    quoted = {k: v.replace("'", "''") for k, v in {"menu": _MENU_LINE, "notice": NOTICE, "cut": SEPARATORS, "stop": SENTENCE_MARKS}.items()}
    space = r"[\x20\x09-\x0D]"
    count = "length(regexp_replace(line, '[^{}]', '', 'g'))"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, k, line, count(*) OVER (PARTITION BY r, line ORDER BY k) > 1 AS repeated,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS size
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), ruled AS (
  SELECT r, size, repeated,
    repeated OR 100 * {count.format(r'\p{P}\p{S}')} > {MARKS_PERCENT} * length(regexp_replace(line, '{space}', '', 'g'))
    OR ({count.format(r'\p{Lu}')} >= {CAPITALS} AND 2 * {count.format(r'\p{Lu}')} > {count.format(r'\p{L}')})
    OR (size >= {SENTENCE_WORDS} AND NOT regexp_matches(line, '[{quoted['stop']}]'))
    OR ({count.format(quoted['cut'])} >= 2 AND size - {count.format(quoted['cut'])} <= {ITEM_WORDS} * ({count.format(quoted['cut'])} + 1))
    OR regexp_matches(line, '{quoted['menu']}', 'i') OR (size <= {NOTICE_WORDS} AND regexp_matches(line, '{quoted['notice']}', 'i')) AS gone
  FROM lines
), by_line AS (
  SELECT r, count(*) FILTER (repeated) AS n_dup_lines, sum(size) FILTER (NOT gone) AS kept_words FROM ruled GROUP BY r
), split AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs
), places AS (
  SELECT r, k, w[k : k + {REPEAT_WINDOW - 1}] AS g FROM (SELECT r, w, unnest(range(1, len(w) - {REPEAT_WINDOW - 2})) AS k FROM split)
), again AS (
  SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, g) AS n FROM places) WHERE n > 1
), inside AS (
  SELECT r, count(DISTINCT k + d) AS n FROM again, range({REPEAT_WINDOW}) AS t(d) GROUP BY r
), base AS (
  SELECT docs.r, doc_id, len(w) AS n_words, length(regexp_replace(text, '{space}', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(inside.n, 0) AS n_repeat_words
  FROM docs JOIN split USING (r) LEFT JOIN inside USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words)
    AND 100 * (n_words - coalesce(kept_words, 0)) <= {LOSS_PERCENT} * n_words AS kept
FROM base LEFT JOIN by_line USING (r)
"""


RULES_SQL = _sql()
