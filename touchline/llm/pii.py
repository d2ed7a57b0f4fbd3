"""Personal data: exact base patterns, and a semi-Markov conditional random field for what they do not cover.

The base kinds (email, ip, card, phone) follow fixed patterns and are found with expressions that read a text once. The
random field cuts the tokens around triggers (a digit, an at or equals sign, a long run of capitals, a credential word)
into segments and gives every segment a type. Its features describe whole segments (shape, length, share of digits,
checksum, distinct characters, the words before), and dynamic programming over segments of at most ``MAX_TOKENS`` tokens
chooses boundaries and types together. It is trained here by gradient steps on the likelihood of segmentations of a bounded
sample of lines (``TRAIN_LINES``), marked by the base patterns and a few credential patterns, and of as many lines made
by rule (:func:`cases`) that show what the patterns miss: cards and phones written otherwise, spelt-out addresses, secrets of
letters alone, and the same words and numbers where they are none of it. Spans of all kinds are added where they touch no
base span and hold what their kind has to (:func:`holds`); the base spans stay exactly those of the patterns.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import prepare

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "key")
KINDS = (*BASE, *ADDED)
TYPES = ("other", *KINDS)

TRAIN_DOCUMENTS, TRAIN_LINES = 20_000, 600  # documents, and of their lines with triggers, that the fit sees, by hash
MAX_TOKENS = 8  # longest segment
BUCKETS = 1 << 14  # hashed features
MADE_LINES = 840  # lines made by rule that the fit sees at least
EPOCHS, RATE, RIDGE = 3, 0.3, 1e-4
MARGIN = 0.9  # posterior odds are not kept; a segment must beat "other" by this much in log score
CONTEXT = 3  # tokens on either side of a trigger

Span = tuple[str, int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match never starts inside a run of digits, so the look-behind changes nothing but the number of trials.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORDS = "password|passwd|passphrase|pwd|token|secret|api_?key"  # fixed list: words that announce a credential
_TRIGGER = re.compile(rf"[0-9@=]|[A-Z]{{16}}|(?i:{_WORDS})|\[at\]")
_TOKEN = re.compile(r"\[(?:at|dot)\]|[\w@.%+/-]+|[^\s\w]")

#: Patterns that mark credentials in the training lines (group 1 is the value).
_SECRET = re.compile(rf"(?i)(?:{_WORDS})\s*[=:]\s*[\"']?([\w+/-]{{8,}})")
_KEY = re.compile(r"\b((?:AKIA|ASIA)[A-Z0-9]{16})\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Every at sign is looked at once: its local part starts after the last match or the last at sign."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        if at >= floor:
            before = text[floor:at]
            start = floor + len(before.rstrip(_LOCAL))
            found = _DOMAIN.match(text, at + 1) if start < at else None
            if found:
                out.append(("email", start, found.end()))
            floor = found.end() if found else at + 1
        at = text.find("@", at + 1)
    return out


def base_spans(text: str | None) -> list[Span]:
    """Spans of the base kinds by start, then kind; positions are code points, the end is exclusive."""
    out = _emails(text) if text else []
    if text and _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if 12 <= len(digits := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def regions(text: str) -> list[list[tuple[int, int]]]:
    """Runs of tokens (their places in the text) around triggers, each within a line."""
    out, hit = [], _TRIGGER.search(text)
    while hit:
        start, end = text.rfind("\n", 0, hit.start()) + 1, text.find("\n", hit.start())
        end = len(text) if end < 0 else end
        tokens = [m.span() for m in _TOKEN.finditer(text, start, end)]
        wanted, held = -1, []
        marks = [i for i, (a, b) in enumerate(tokens) if _TRIGGER.search(text, a, b)]
        for i in marks:
            if held and i - CONTEXT > wanted:
                out.append(held)
                held = []
            first = max(i - CONTEXT, wanted if held else 0, 0)
            last = min(i + CONTEXT + 1, len(tokens))
            held += tokens[first:last] if last > first else []
            wanted = max(last, wanted)
        if held:
            out.append(held)
        hit = _TRIGGER.search(text, end)
    return out


def _shape(s: str) -> str:
    out = []
    for c in s[:48]:
        k = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out[:10])


def features(text: str, tokens: Sequence[tuple[int, int]], i: int, j: int) -> list[int]:
    """Hashed features of the segment of tokens i .. j - 1."""
    s = text[tokens[i][0] : tokens[j - 1][1]]
    digits = re.sub("[^0-9]", "", s)
    before = [text[a:b].lower() for a, b in tokens[max(0, i - 2) : i]]
    share = round(4 * len(digits) / len(s))
    varied = len(set(s[:64]))
    names = [
        "bias", f"n{j - i}", f"shape{_shape(s)}", f"long{int(math.log2(len(s)) * 2)}", f"share{share}", f"varied{varied // 4}",
        f"digits{min(len(digits), 20)}", f"n{j - i}long{int(math.log2(len(s)) * 2)}", f"before{before[-1] if before else ''}",
        f"before2{'|'.join(before)}", f"hex{bool(re.fullmatch('[0-9a-f]{8,}', s))}", f"upper{bool(re.fullmatch('[0-9A-Z]{12,}', s))}",
        f"luhn{12 <= len(digits) <= 19 and luhn(digits)}", f"dots{min(s.count('.'), 4)}", f"at{s.count('@')}", f"start{s[:1]}",
        f"mixed{varied // 4}{share}{int(math.log2(len(s)))}",
    ]
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % BUCKETS for n in names]


def _scores(text: str, tokens: Sequence[tuple[int, int]], weights: np.ndarray):
    """Per start and length the features and the score of every type, None where no segment can be.

    "other" holds one token only, and a longer segment has a trigger in its first or last token or in between.
    """
    n = len(tokens)
    table = [[None] * (min(MAX_TOKENS, n - i) + 1) for i in range(n)]
    marked = [bool(_TRIGGER.search(text, a, b)) for a, b in tokens]
    for i in range(n):
        for length in range(1, len(table[i])):
            if length > 1 and not any(marked[i : i + length]):
                continue
            f = features(text, tokens, i, i + length)
            score = weights[f].sum(0)
            if length > 1:
                score[0] = -np.inf
            table[i][length] = (f, score)
    return table


def decode(text: str, tokens: Sequence[tuple[int, int]], weights: np.ndarray) -> list[tuple[int, int, int]]:
    """The best segmentation: (first token, end token, type), "other" left out."""
    n, table = len(tokens), _scores(text, tokens, weights)
    best, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
    for end in range(1, n + 1):
        for length in range(1, min(MAX_TOKENS, end) + 1):
            if table[end - length][length] is None:
                continue
            s = table[end - length][length][1].copy()
            s[1:] -= MARGIN
            t = int(s.argmax())
            if (v := best[end - length] + s[t]) > best[end]:
                best[end], back[end] = v, (end - length, t)
    out, end = [], n
    while end:
        start, t = back[end]
        if t:
            out.append((start, end, t))
        end = start
    return out[::-1]


def _step(text, tokens, gold: dict[tuple[int, int], int], weights: np.ndarray, rate: float) -> None:
    """One gradient step on the log likelihood of a segmentation: observed less expected features."""
    n, table = len(tokens), _scores(text, tokens, weights)
    sums = [[-np.inf if cell is None else np.logaddexp.reduce(cell[1]) for cell in row] for row in table]
    ahead, behind = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    ahead[0] = behind[n] = 0.0
    for end in range(1, n + 1):
        ahead[end] = np.logaddexp.reduce([ahead[end - k] + sums[end - k][k] for k in range(1, min(MAX_TOKENS, end) + 1)])
    for start in range(n - 1, -1, -1):
        behind[start] = np.logaddexp.reduce([sums[start][k] + behind[start + k] for k in range(1, len(table[start]))])
    moves = []
    for i in range(n):
        for length in range(1, len(table[i])):
            if table[i][length] is None:
                continue
            f, score = table[i][length]
            expected = np.exp(ahead[i] + score + behind[i + length] - ahead[n])
            if (t := gold.get((i, i + length))) is not None:
                expected[t] -= 1.0
            if np.abs(expected).max() > 1e-4:
                moves.append((f, expected))
    for f, expected in moves:
        weights[f] -= rate * (expected + RIDGE * weights[f]) / len(f) * 4


def _gold(text: str, tokens: Sequence[tuple[int, int]], spans: Sequence[Span]) -> dict[tuple[int, int], int]:
    """The segmentation that the patterns say; a span that cuts a token keeps the token whole."""
    out, i = {}, 0
    while i < len(tokens):
        a, b = tokens[i]
        found = next((s for s in spans if s[1] < b and a < s[2]), None)
        j = i + 1
        if found:
            while j < len(tokens) and tokens[j][0] < found[2] and j - i < MAX_TOKENS:
                j += 1
        out[i, j] = TYPES.index(found[0]) if found else 0
        i = j
    return out


def cases(n: int, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """``n`` lines by rule with their spans: what the patterns do not cover, and look-alikes that are nothing of the kind."""
    rng = np.random.default_rng(seed)

    def letters(a: int, b: int) -> str:
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(a, b))))

    def digits(k: int) -> str:
        return "".join(rng.choice(list("0123456789"), k))

    def card(k: int = 16) -> str:
        body = str(rng.integers(3, 7)) + digits(k - 2)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def cut(number: str, sizes: Sequence[int], sign: str) -> str:
        ends = np.cumsum(sizes)
        return sign.join(number[e - k : e] for k, e in zip(sizes, ends.tolist()))

    def wrong() -> str:
        number = card()
        return number[:-1] + str((int(number[-1]) + 1) % 10)

    word = lambda: letters(2, 11)
    made = [
        lambda: (f"{rng.choice(['password', 'passphrase', 'Password', 'pwd', 'secret', 'token'])}{rng.choice([': ', ' : ', '=', ' = '])}", letters(14, 26), "secret"),
        lambda: (f"{rng.choice(['password', 'pwd', 'token'])}{rng.choice([': ', '='])}", letters(2, 7) + digits(int(rng.integers(2, 5))) + letters(0, 4), "secret"),
        lambda: (f"{rng.choice(['call', 'phone', 'Tel', 'tel:', 'mobile', 'ring'])} ", cut(digits(10), (3, 3, 4), rng.choice([" ", "-", "."])), "phone"),
        lambda: (f"{rng.choice(['call', 'phone', 'Tel', 'phone:'])} ", f"({digits(3)}) {digits(3)}-{digits(4)}", "phone"),
        lambda: (f"{rng.choice(['card', 'Visa', 'paid with', 'card:'])} ", cut(card(), (4, 4, 4, 4), rng.choice([".", "  ", " - "])), "card"),
        lambda: (f"{word()} ", f"{letters(3, 9)} {rng.choice(['[at]', '[at]'])} {letters(3, 9)}{rng.choice([' [dot] ', '.'])}{rng.choice(['com', 'org', 'net'])}", "email"),
        lambda: (f"{rng.choice(['the', 'a', 'your'])} {rng.choice(['password', 'token', 'secret'])} {rng.choice(['is', 'of', 'for', 'was'])} {word()}", "", ""),
        lambda: (f"{rng.choice(['password', 'token', 'secret'])}: {rng.choice(['none', 'required', 'see', 'never', 'of', 'a'])} {word()}", "", ""),
        lambda: (f"{word()} {digits(int(rng.integers(1, 9)))} {word()} {digits(4)}", "", ""),
        lambda: (f"{rng.choice(['order', 'ref', 'invoice', 'no', word()])} {wrong()}", "", ""),
        lambda: (f"{rng.choice(['order', 'ref', 'invoice', 'isbn', word()])} {cut(digits(10), (3, 3, 4), rng.choice(['-', ' ', '.']))}", "", ""),
        lambda: (f"{word()} {rng.integers(1900, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)} {rng.integers(10, 24)}:{rng.integers(10, 60)}", "", ""),
        lambda: (f"version {rng.integers(1, 20)}.{rng.integers(0, 20)}.{rng.integers(0, 20)} x = {rng.integers(1, 999)}", "", ""),
        lambda: (f"{digits(3)}.{digits(3)}.{int(rng.integers(256, 999))}.{digits(2)}", "", ""),
    ]
    out = []
    for k in range(n):
        lead, value, kind = made[k % len(made)]()
        begin = " ".join(word() for _ in range(int(rng.integers(0, 6))))
        begin = f"{begin} {lead}" if begin else lead
        line = f"{begin}{value} {' '.join(word() for _ in range(int(rng.integers(0, 6))))}".rstrip()
        out.append((line, [(kind, len(begin), len(begin) + len(value))] if kind else []))
    return out


def train(lines: Sequence[str]) -> np.ndarray | None:
    """Weights (features x types) from lines with triggers and as many made by rule; None without lines."""
    marked = [
        (line, base_spans(line) + [("secret", *m.span(1)) for m in _SECRET.finditer(line)] + [("key", *m.span(1)) for m in _KEY.finditer(line)])
        for line in lines
    ]
    if not any(regions(line) for line in lines):
        return None
    made = cases(max(MADE_LINES, len(marked)))
    order = np.random.default_rng(3).permutation(len(marked) + len(made))
    steps = []
    for k in order.tolist():
        line, spans = (marked + made)[k]
        for tokens in regions(line):
            if len(tokens) <= 60:
                steps.append((line, tokens, _gold(line, tokens, spans)))
    weights = np.zeros((BUCKETS, len(TYPES)))
    for epoch in range(EPOCHS):
        for text, tokens, gold in steps:
            _step(text, tokens, gold, weights, RATE / (1 + epoch))
    return weights


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while end > start and not text[end - 1].isalnum():
        end -= 1
    while start < end and not text[start].isalnum():
        start += 1
    return start, end


def holds(kind: str, value: str) -> bool:
    """Whether a decoded value has what its kind cannot be without."""
    digits = re.sub("[^0-9]", "", value)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits) and not re.search("[A-Za-z]", value)
    if kind == "phone":
        return 9 <= len(digits) <= 15 and not re.search("[A-Za-z]", value)
    if kind == "ip":
        return len(parts := re.findall("[0-9]+", value)) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "email":
        return bool(re.search(r"@|\[at\]", value))
    return bool(value)


def all_spans(text: str | None, weights: np.ndarray | None) -> list[Span]:
    """Base spans, and spans of every kind from the random field where they touch no base span; by start, then kind."""
    base = base_spans(text)
    if not text or weights is None:
        return base
    added: list[Span] = []
    starts = [a for _, a, _ in base]
    longest = max((b - a for _, a, b in base), default=0)
    for tokens in regions(text):
        for i, j, t in decode(text, tokens, weights):
            kind = TYPES[t]
            start, end = _trimmed(text, tokens[i][0], tokens[j - 1][1])
            if kind == "phone" and text[start - 1 : start] in ("(", "+"):
                start -= 1
            if start < end and holds(kind, text[start:end]):
                near = base[bisect_left(starts, start - longest) : bisect_left(starts, end)]
                if not any(a < end and start < b for _, a, b in near + added[-1:]):
                    added.append((kind, start, end))
    return sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def fit(docs: DataFrame, documents: int = TRAIN_DOCUMENTS, lines: int = TRAIN_LINES) -> np.ndarray | None:
    """Weights from a bounded sample: about ``documents`` documents by a hash of the id, and ``lines`` of their lines.

    Documents are drawn by a threshold on the hash, so that tasks send lines of the sample only; null ids count too.
    """
    prepare(docs.sparkSession)
    share = min(1.0, documents / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("pii")), F.lit(1 << 30)) < int(share * (1 << 30))
    line = F.explode(F.split("text", "\n")).alias("line")
    some = docs.filter(drawn).select(line).filter(F.col("line").rlike(_TRIGGER.pattern) & (F.length("line") <= 4000))
    picked = some.orderBy(F.xxhash64("line"), "line").limit(lines).collect()  # bounded: lines x 4000 characters
    return train([r["line"] for r in picked])


def find(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, n_secret, n_key, base_sha256, spans``: one row per input row.

    The counts of the base kinds and ``base_sha256`` are those of the base patterns; ``spans`` has the added ones too. Null and empty texts have no spans
    (the hash of an empty string). Repeated rows give repeated results; columns other than doc_id and text are not
    looked at. ``weights`` come from ``fit``, by default on ``docs`` itself.
    """
    weights = fit(docs) if weights is None else weights
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2^14 x 7 numbers at most

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, n_secret long, n_key long, base_sha256 string, spans string")
    def scan(text: pd.Series) -> pd.DataFrame:
        rows = []
        for t in text:
            spans = all_spans(t, shared.value)
            kinds = [s[0] for s in spans]
            own = base_spans(t)
            base = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
            counts = [*([k for k, *_ in own].count(k) for k in BASE), *(kinds.count(k) for k in ADDED)]
            rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for k, a, b in spans)))
        return pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select("doc_id", scan("text").alias("found")).select("doc_id", "found.*")


def mask(text: str | None, weights: np.ndarray | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    if not text:
        return text
    out, at = [], 0
    for kind, start, end in all_spans(text, weights):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``docs`` with personal data masked in ``text``; the other columns stay as they are."""
    weights = fit(docs) if weights is None else weights
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("string")
    def masked(text: pd.Series) -> pd.Series:
        return pd.Series([mask(t, shared.value) for t in text], dtype=object)

    return docs.withColumn("text", masked("text"))
