"""Personal data: plain patterns, and identifiers discovered through the contexts of what they find.

The plain patterns give seeds, and so do long values with a digit that are assigned to names of secrets.
Each seed's two words on the left, or the name it is assigned to, are a lexical pattern. Patterns
also meet other tokens that look like identifiers. On the graph of patterns and values Spark
scores both in turns: a pattern is as good as the values it meets, a value as good as its best
pattern. Values met by patterns of high confidence become seeds themselves and give new patterns,
until no pattern and no value comes in. All counts are over distinct values of all documents, so
copies of a document add nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.base import aside, slices
from corpus_engine.session import settled

KINDS = ("email", "ip", "card", "phone", "id")
ROUNDS = 3
MIN_SEEDS = 5  # distinct seed values that a pattern must meet
MIN_CONFIDENCE = 0.9
PRIOR = 0.1  # values of unknown worth added to each pattern's count
RUN_CHARS = 34  # letters and digits of groups joined to one identifier, as the longest account numbers have
LONG_WORD = 80  # longer words stand in patterns by a digest
COMMON = 4  # values of so many letters and digits or fewer, as years, are often no identifiers

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits matches from its start or nowhere, so starts inside a run need no trial.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
EDGES = "\"'`.,;:!?()[]{}<>|*#$%&="


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(map(int, reversed(digits))):
        total += d if place % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ to both sides so that long words cost no more than their length."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """``kind, start, end`` of the plain patterns in code points, by start and then kind."""
    if not text:
        return []
    found = [("email", *span) for span in _emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        for m in PHONE.finditer(text):
            if 10 <= len(DIGIT.findall(m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


class _Left:
    """The words on the left of places in a text; long words are read once, however many places there are."""

    def __init__(self, text: str, tokens: list[tuple[int, int]]):
        self.text, self.tokens = text, tokens
        self.long: dict[int, str] = {}
        self.open = (-1, 0, False, hashlib.blake2b(digest_size=16))  # token, end, letters and digest of what was read of it

    def _prefix(self, at: int, end: int) -> str:
        """Lower case, digits as 0, of token ``at`` up to ``end``; a digest of it where it is long."""
        begin = self.tokens[at][0]
        if end - begin <= LONG_WORD:
            return DIGIT.sub("0", self.text[begin:end].lower())
        token, upto, letters, digest = self.open
        if token != at or upto > end:
            upto, letters, digest = begin, False, hashlib.blake2b(digest_size=16)
        more = DIGIT.sub("0", self.text[upto:end].lower())
        digest.update(more.encode("utf-8", "surrogatepass"))
        letters = letters or any(map(str.isalpha, more))
        self.open = at, end, letters, digest
        return f"{'a' if letters else ''}#{int(digest.hexdigest(), 16)}"

    def _word(self, at: int) -> str:
        a, b = self.tokens[at]
        if b - a <= LONG_WORD:
            return DIGIT.sub("0", self.text[a:b].lower())
        if at not in self.long:
            self.long[at] = self._prefix(at, b)
        return self.long[at]

    def context(self, at: int, start: int) -> str | None:
        """The two words left of ``start`` in token ``at``; None where there are fewer, or no letters."""
        words = [self._prefix(at, start)] if start > self.tokens[at][0] else []
        if at + len(words) < 2:
            return None
        words = [*map(self._word, range(at - 2 + len(words), at)), *words]
        shape = " ".join(words)
        return shape if any(map(str.isalpha, shape)) else None


def candidates(text: str | None, base: list[tuple[str, int, int]]) -> list[tuple[int, int, str | None, str, bool]]:
    """``start, end, pattern, value, is_seed`` of seeds, and of other tokens with an @ or a digit.

    Groups of letters and digits that single blanks separate are joined: digits, short words with
    digits, and between them up to four capitals. The joined groups have the pattern of their first
    one, unless they are longer than any identifier; parts of them are given without a pattern, for
    values that are known from elsewhere. The pattern is None too where there are not two words, or
    no letters, on the left.
    """
    if not text or not (base or "@" in text or DIGIT.search(text)):
        return []
    tokens = [m.span() for m in re.finditer(r"\S+", text)]
    left = _Left(text, tokens)
    out, at = [], 0
    for _, a, b in base:
        while tokens[at][1] <= a:
            at += 1
        out.append((a, b, left.context(at, a), text[a:b], True))
    ranges = sorted((a, b) for _, a, b in base)
    at = 0
    run: list[tuple[int, int, int]] = []  # start, end and token of groups that may belong together
    for k, (a, b) in enumerate(tokens):
        token = text[a:b]
        known = not token.isalpha() and ("@" in token or DIGIT.search(token) is not None)
        if not (known or run):
            continue
        core = token.strip(EDGES)
        start = a + len(token) - len(token.lstrip(EDGES))
        end = start + len(core)
        while at < len(ranges) and ranges[at][1] <= start:
            at += 1
        free = at == len(ranges) or ranges[at][0] >= end
        if not (core and free and (known or CAPITALS.fullmatch(token))):
            _close(left, run, out)
            continue
        grouped = not known or GROUP.fullmatch(core) is not None
        opened = token[: start - a] == "(" and token[end - a :] in (")", "")  # as in (555) 123
        last = run[-1] if run else None
        if last and not (grouped and a == tokens[last[2]][1] + 1 and text[a - 1] == " " and (a == start or opened)):
            _close(left, run, out)
        if known or run:
            run.append((start, end, k))
        if known and not (grouped and (end == b or opened)):
            _close(left, run, out)
    _close(left, run, out)
    return out


# What is assigned to the name of a secret is met by that name: ``token = "...``, ``api_key: ...``. Values with a
# digit and so many characters are seeds of the method's own kind; shorter ones are met by the words on their left.
ASSIGNED = re.compile(r"""(password|passwd|secret|token|api[_-]?key|access[_-]?key)["']?[ \t]{0,3}[:=][ \t]{0,3}["']?\Z""", re.I | re.A)
SECRET_NAME = "^(password|passwd|secret|token|api[_-]?key|access[_-]?key) =$"
SECRET_CHARS = 8

CAPITALS = re.compile(r"[A-Z]{1,4}")
GROUP = re.compile(r"[0-9]{1,19}|[A-Za-z0-9]{1,12}|[A-Za-z0-9]{1,12}(?:-[A-Za-z0-9]{1,12})+")


def _close(left: _Left, run: list[tuple[int, int, int]], out: list) -> None:
    """Candidates of a run of groups, which is emptied."""
    text = left.text
    while run and CAPITALS.fullmatch(text, run[-1][0], run[-1][1]):
        run.pop()  # capitals stand between groups only
    if not run:
        return
    chars = sum(end - start for start, end, _ in run)
    whole = len(run) == 1 or chars <= RUN_CHARS
    for i, (start, _, k) in enumerate(run):
        for j in range(i, len(run) if whole else i + 1):
            end = run[j][1]
            if CAPITALS.fullmatch(text, start, run[i][1]) or CAPITALS.fullmatch(text, run[j][0], end):
                continue
            own = j == len(run) - 1 and i == 0 if whole else True
            pattern = None
            if own:
                name = ASSIGNED.search(text, max(0, start - 48), start) if end - start >= SECRET_CHARS else None
                pattern = f"{name[1].lower()} =" if name else left.context(k, start)
            out.append((start, end, pattern, text[start:end], False))
    run.clear()


SPAN = "array<struct<kind: string, start: int, end: int>>"
SCANNED = (
    f"doc_id long, text_hash long, base {SPAN}, "
    "met array<struct<start: int, end: int, pattern: string, value: string, seed: boolean>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    kinds = [("start", pa.int32()), ("end", pa.int32()), ("pattern", pa.string()), ("value", pa.string()), ("seed", pa.bool_())]
    meeting = pa.list_(pa.struct(kinds))
    for batch in slices(batches, "text"):
        base, met = [], []
        for text in batch.column(2).to_pylist():
            spans = base_spans(text)
            base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans])
            met.append([dict(zip((k for k, _ in kinds), c, strict=True)) for c in candidates(text, spans)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(base, span), pa.array(met, meeting)],
            ["doc_id", "text_hash", "base", "met"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.withColumn("text_hash", F.xxhash64(F.coalesce(text, F.lit(""))))


def scan(docs: DataFrame) -> DataFrame:
    """Spans of the plain patterns and all candidates with their contexts, one row per row of ``docs``."""
    keyed = _keyed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    return settled(keyed.select("doc_id", "text_hash", "text").mapInArrow(_scan, SCANNED), "pii-scan")


def score(edges: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """``pattern, confidence`` after ``rounds`` turns over distinct edges ``pattern, value, seed``.

    A seed is worth one; another value as much as its best pattern. A pattern is worth the sum of
    its values over their count plus ``PRIOR``; patterns that meet fewer than ``min_seeds`` seeds
    stay out, and so do edges of values that are only met by such patterns.
    """
    strong = edges.groupBy("pattern").agg(F.sum(F.col("seed").cast("long")).alias("seeds"))
    strong = settled(strong.where(F.col("seeds") >= min_seeds).select("pattern"), "pii-strong")
    edges = settled(edges.join(strong, "pattern"), "pii-edges")
    worth = edges.select("value", F.col("seed").cast("double").alias("worth")).groupBy("value").agg(
        F.max("worth").alias("worth")
    )
    patterns = None
    for _ in range(rounds):
        patterns = settled(
            edges.join(worth, "value")
            .groupBy("pattern")
            .agg((F.sum("worth") / (F.count("*") + PRIOR)).alias("confidence")),
            "pii-patterns",
        )
        worth = settled(
            edges.join(patterns, "pattern")
            .groupBy("value")
            .agg(F.greatest(F.max(F.col("seed").cast("double")), F.max("confidence")).alias("worth")),
            "pii-values",
        )
    return patterns


def bootstrap(edges: DataFrame, min_confidence: float = MIN_CONFIDENCE, **bounds: int) -> tuple[DataFrame, DataFrame]:
    """``pattern`` of high confidence and ``value`` promoted, from edges ``pattern, value, seed``.

    Patterns are scored with the seeds, the values that good ones meet become seeds, and all are
    scored again until no value comes in. Seeds only grow, and so do all worths: it ends. A value
    of ``COMMON`` characters or fewer is promoted only if good patterns are half of those it stands
    in; else it is found where a good pattern meets it, and not elsewhere.
    """
    edges = settled(edges, "pii-graph")
    while True:
        scored = score(edges, **bounds)
        good = settled(scored.where(F.col("confidence") >= min_confidence).select("pattern"), "pii-good")
        met = edges.join(good.withColumn("good", F.lit(1)), "pattern", "left").groupBy("value").agg(
            F.max("seed").alias("seed"), F.count("good").alias("goods"), F.count("*").alias("patterns")
        )
        common = F.length(F.regexp_replace("value", "[^\\p{L}\\p{N}@]", "")) <= COMMON
        common = common & ~F.contains("value", F.lit("@")) & (2 * F.col("goods") < F.col("patterns"))
        new = settled(met.where(~F.col("seed") & (F.col("goods") > 0) & ~common).select("value"), "pii-new")
        if new.isEmpty():
            break
        flagged = edges.join(new.withColumn("new", F.lit(True)), "value", "left")
        edges = settled(
            flagged.select("pattern", "value", (F.col("seed") | F.col("new").isNotNull()).alias("seed"), "base"), "pii-graph"
        )
    return good, edges.where(F.col("seed") & ~F.col("base")).select("value").distinct()


def discover(scanned: DataFrame, min_confidence: float = MIN_CONFIDENCE, **bounds: int) -> DataFrame:
    """``doc_id, text_hash, added``: spans of kind ``id`` that patterns of high confidence find, and
    all other occurrences of the values promoted."""
    met = scanned.select("doc_id", "text_hash", F.inline("met"))
    secret = F.col("pattern").rlike(SECRET_NAME) & (F.length("value") >= SECRET_CHARS) & F.col("value").rlike("[0-9]")
    seeds = met.groupBy("value").agg(F.max("seed").alias("base"), F.max(F.coalesce(secret, F.lit(False))).alias("own"))
    seeds = settled(seeds.where(F.col("base") | F.col("own")), "pii-seeds")
    edges = met.where(F.col("pattern").isNotNull()).select("pattern", "value").distinct().join(seeds, "value", "left")
    none = F.lit(False)
    edges = edges.select(
        "pattern", "value", F.coalesce(F.col("base") | F.col("own"), none).alias("seed"), F.coalesce("base", none).alias("base")
    )
    good, promoted = bootstrap(edges, min_confidence, **bounds)
    rest = met.where(~F.col("seed"))
    promoted = settled(promoted, "pii-promoted")
    found = rest.join(good, "pattern", "left_semi").select("doc_id", "text_hash", "start", "end").unionByName(
        rest.join(promoted, "value", "left_semi").select("doc_id", "text_hash", "start", "end")
    )
    span = F.struct(F.lit("id").alias("kind"), "start", "end")
    added = found.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(span)).alias("added"))
    return settled(added, "pii-added")


def find(docs: DataFrame, min_confidence: float = MIN_CONFIDENCE, **bounds: int) -> DataFrame:
    """``doc_id, text_hash, base, added`` of every row of ``docs`` (``doc_id, text``).

    Spans are in code points, end exclusive. A null text counts as empty and has none. Rows with
    the same doc_id and text have the same spans, and stay apart. An empty table gives no rows.
    """
    scanned = scan(docs)
    added = discover(scanned, min_confidence, **bounds).withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    none = F.from_json(F.lit("[]"), SPAN)
    return scanned.join(added, same, "left").select(
        "doc_id", "text_hash", "base", F.coalesce("added", none).alias("added")
    )


def redact(docs: DataFrame, **bounds: int) -> DataFrame:
    """``docs`` with every span, plain or discovered, replaced by its kind in angle brackets.

    Overlapping spans become one mark, of the first of them. Null texts stay null.
    """
    added = discover(scan(docs), **bounds).withColumnsRenamed({"doc_id": "d", "text_hash": "h"})

    @F.pandas_udf("string")
    def marked(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_marked(t, s) for t, s in zip(text, spans, strict=True)], dtype=object)

    same = F.col("doc_id").cast("long").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    narrow, widen = aside(docs, "doc_id", "text")
    joined = _keyed(narrow).join(added, same, "left")
    return widen(joined.withColumn("text", marked(F.col("text").cast("string"), "added")))


def _marked(text: str | None, added) -> str | None:
    if not text:
        return text
    spans = base_spans(text) + [(s["kind"], s["start"], s["end"]) for s in (() if added is None else added)]
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
