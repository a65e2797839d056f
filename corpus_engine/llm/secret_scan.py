"""Secret scan in DataFrame functions alone: plain patterns, and strings of high entropy.

Beside the plain patterns, every long string of letters, digits and base64 marks is a candidate. A
candidate belongs to the narrowest character class that holds it; a window of that class's width
slides over it, one character at a time. A table of counts goes along: the entering character's
count rises, the leaving one's falls, and the window's entropy changes by those two counts only.
Where it reaches the class's threshold the window is a finding; windows that touch are one span.
An allow list takes out what looks random but is no secret, by the string and by what stands before it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

# The plain patterns, the length that counts, and the group that has it.
ASSIGN = (
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = {"assign": (ASSIGN, 2, 6), "access": ("AKIA[A-Z0-9]+", 0, 20), "hex": ("[0-9a-f]+", 0, 24)}

# Character classes from narrow to wide: name, characters, width of the window, least entropy in bits.
CLASSES = (
    ("hex", "^[0-9A-Fa-f]+$", 24, 3.0),
    ("alnum", "^[0-9A-Za-z]+$", 20, 3.7),
    ("base64", "^[0-9A-Za-z+/=_-]+$", 20, 3.8),
)
CANDIDATE = "[0-9A-Za-z+/=_-]{20,}"
BEFORE = 40  # characters in front of a candidate that the allow list sees

# What is no secret, by the candidate.
ALLOWED = {
    "uuid": "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    "no digit": "^[^0-9]+$",
    "no letter": "^[^A-Za-z]+$",
    "words and numbers": "^[+/=_-]*([A-Za-z]+|[0-9]+)([+/=_-]+([A-Za-z]+|[0-9]+))*[+/=_-]*$",
    "numbered name": "^[A-Za-z]+[0-9]{1,4}$",
    "placeholder": "[eE][xX][aA][mM][pP][lL][eE]|[sS][aA][mM][pP][lL][eE]|[pP][lL][aA][cC][eE][hH][oO][lL][dD][eE][rR]"
    "|[cC][hH][aA][nN][gG][eE][mM][eE]|[dD][uU][mM][mM][yY]|[xX]{6}|0{8}|12345678|[aA][bB][cC][dD][eE][fF][gG][hH]",
}
# What is no secret, by the text in front of it (its last ``BEFORE`` characters).
ALLOWED_BEFORE = {
    "digest": "([sS][hH][aA]-?[0-9]*|[mM][dD]5|[dD]igest|[cC]hecksum|[iI]ntegrity|[cC]ommit|[rR]evision|[eE][tT]ag)[\"']?[ :=-]*[\"']?$",
    "data address": ";base64,$",
    "web address": "://[^ \n]*$",
}

SCALE = 1_000_000_000
WIDEST = max(width for _, _, width, _ in CLASSES)


def share(count: int) -> int:
    """``count * log2(count)``, scaled to an integer so that sums in any order agree."""
    return round(SCALE * count * math.log2(count)) if count else 0


def limit(width: int, bits: float) -> int:
    """A window's entropy is at least ``bits`` where its shares add up to this at most."""
    return math.floor(SCALE * width * (math.log2(width) - bits))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(steps: Column, block: int = 256) -> Column:
    """Running totals of an array, by blocks, so that long arrays do not cost their square."""

    def scan(values: Column) -> Column:
        def step(out: Column, v: Column) -> Column:
            last = F.coalesce(F.get(out, F.size(out) - 1), F.lit(0))
            return F.concat(out, F.array(last + v))

        return F.aggregate(values, F.array().cast("array<int>"), step)

    def shifted(sums: Column) -> Column:
        def add(totals: Column) -> Column:
            return F.flatten(
                F.transform(
                    sums,
                    lambda s, k: F.transform(s, lambda x: x + F.coalesce(F.get(totals, k - 1), F.lit(0))),
                )
            )

        return _let(scan(F.transform(sums, lambda s: F.get(s, F.size(s) - 1))), add)

    last = F.floor((F.size(steps) - 1) / block).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(steps, k * block + 1, F.lit(block)))
    summed = _let(F.transform(blocks, scan), shifted)
    return F.when(F.size(steps) > 0, summed).otherwise(F.array().cast("array<int>"))


def _placed(hits: Column, gaps: Column) -> Column:
    """Where each hit starts, in code points: ``gaps`` are the lengths of the texts around the hits."""
    steps = F.transform(hits, lambda h, k: F.char_length(h) + F.get(gaps, k))
    return _let(_running(steps), lambda ends: F.transform(hits, lambda h, k: F.get(ends, k) - F.char_length(h)))


def _high_runs(letters: Column, width: Column, most: Column) -> Column:
    """``first, end`` of the parts of a candidate (its bytes) that windows of high entropy cover."""
    numbers = F.lit(bytes(range(128)))
    rise = F.array(*(F.lit(share(c + 1) - share(c)) for c in range(WIDEST + 1)))
    # the window's moves in order: ~p where place p leaves, p where place p enters
    moves = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.octet_length(letters) - 1),
            lambda p: F.when(p >= width, F.array(width - p - 1, p)).otherwise(F.array(p)),
        )
    )
    start = F.struct(
        F.lit(bytes(128)).alias("counts"), F.lit(0).cast("long").alias("total"),
        F.lit(-1).alias("first"), F.lit(-1).alias("end"),
        F.array().cast("array<struct<first: int, end: int>>").alias("runs"),
    )

    def number(table: Column, at: Column) -> Column:
        return F.ascii(F.substring(table, at + 1, F.lit(1)).cast("string"))

    def step(state: Column, move: Column) -> Column:
        enters = move >= 0
        code = number(letters, F.when(enters, move).otherwise(-move - 1))

        def counted(code: Column) -> Column:
            def changed(count: Column) -> Column:
                now = F.when(enters, count + 1).otherwise(count - 1)
                total = state["total"] + F.when(enters, F.get(rise, count)).otherwise(-F.get(rise, count - 1))
                table = F.overlay(state["counts"], F.substring(numbers, now + 1, F.lit(1)), code + 1, F.lit(1))
                return F.struct(table.alias("counts"), total.alias("total"))

            return _let(number(state["counts"], code), changed)

        def judged(new: Column) -> Column:
            begin = move - width + 1
            high = enters & (begin >= 0) & (new["total"] <= most)
            fresh = high & (begin > state["end"])
            done = F.array(F.struct(state["first"].alias("first"), state["end"].alias("end")))
            return F.struct(
                new["counts"].alias("counts"),
                new["total"].alias("total"),
                F.when(fresh, begin).otherwise(state["first"]).alias("first"),
                F.when(high, move + 1).otherwise(state["end"]).alias("end"),
                F.when(fresh & (state["first"] >= 0), F.concat(state["runs"], done)).otherwise(state["runs"]).alias("runs"),
            )

        return _let(_let(code, counted), judged)

    def finish(state: Column) -> Column:
        done = F.array(F.struct(state["first"].alias("first"), state["end"].alias("end")))
        return F.when(state["first"] >= 0, F.concat(state["runs"], done)).otherwise(state["runs"])

    return F.aggregate(moves, start, step, finish)


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), start.cast("int").alias("start"), end.cast("int").alias("end"))


def _by_class(values: list) -> Callable[[Column], Column]:
    return lambda k: F.get(F.array(*(F.lit(v) for v in values)), k)


def _entropy_spans(found: Column, starts: Column, contexts: Column) -> Column:
    """Spans of high entropy in the candidates ``found`` that no allow rule covers."""
    width, most = _by_class([c[2] for c in CLASSES]), _by_class([limit(c[2], c[3]) for c in CLASSES])

    def fields(value: Column, k: Column) -> Column:
        kind = F.lit(len(CLASSES) - 1)
        for n, (_, letters, _, _) in reversed(list(enumerate(CLASSES[:-1]))):
            kind = F.when(value.rlike(letters), n).otherwise(kind)
        return F.struct(
            value.alias("value"), kind.alias("class"), F.get(starts, k).alias("start"), F.get(contexts, k).alias("before")
        )

    def open_to_search(c: Column) -> Column:
        allowed = F.lit(False)
        for pattern in ALLOWED.values():
            allowed = allowed | c["value"].rlike(pattern)
        for pattern in ALLOWED_BEFORE.values():
            allowed = allowed | c["before"].rlike(pattern)
        return (F.char_length(c["value"]) >= width(c["class"])) & ~allowed

    def spans(c: Column) -> Column:
        runs = _let(
            F.struct(c["value"].cast("binary").alias("letters"), width(c["class"]).alias("width"), most(c["class"]).alias("most")),
            lambda x: _high_runs(x["letters"], x["width"], x["most"]),
        )
        return F.transform(runs, lambda r: _span("entropy", c["start"] + r["first"], c["start"] + r["end"]))

    return F.flatten(F.transform(F.filter(F.transform(found, fields), open_to_search), spans))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, base, added`` of every row of ``docs``: arrays of ``kind, start, end`` in code points.

    ``base`` has the plain patterns' spans, leftmost and non-overlapping for each kind; ``added`` the
    spans of high entropy that do not lie inside one of them. Both are sorted by start, then kind as
    listed in ``KINDS``. Every row is worked out by itself: nothing is shuffled, repeated rows stay
    apart, other columns of ``docs`` are not looked at. Null and empty texts have no spans, an empty
    table gives no rows. Time and memory for a text follow its length.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast("array<struct<kind: string, start: int, end: int>>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select(
        "doc_id", "text",
        *(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(k) for k, (p, _, _) in BASE.items()),
        *(F.regexp_extract_all("text", F.lit(p), F.lit(g)).alias(f"{k}_part") for k, (p, g, _) in BASE.items() if g),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("entropy"),
    )
    # runs of hex digits are everywhere: texts are cut only where one is long enough
    worth = F.exists("hex", lambda h: F.char_length(h) >= BASE["hex"][2])
    rows = rows.withColumn("hex", F.when(worth, F.col("hex")).otherwise(F.array().cast("array<string>")))

    def around(kind: str, pattern: str, measure: Callable[[Column], Column]) -> Column:
        return F.when(F.size(kind) > 0, F.transform(F.split("text", pattern, -1), measure)).alias(f"{kind}_gaps")

    end = F.lit(-BEFORE)
    rows = rows.select(
        "doc_id", *BASE, "assign_part", "entropy",
        *(around(k, p, F.char_length) for k, (p, _, _) in BASE.items()),
        around("entropy", CANDIDATE, lambda g: F.struct(F.char_length(g).alias("n"), F.substring(g, end, F.lit(BEFORE)).alias("end"))),
    )
    rows = rows.select(
        "doc_id", *BASE, "assign_part", "entropy", F.col("entropy_gaps.end").alias("contexts"),
        *(_placed(F.col(k), F.col(f"{k}_gaps")).alias(f"{k}_at") for k in BASE),
        _placed(F.col("entropy"), F.col("entropy_gaps.n")).alias("entropy_at"),
    )

    def plain(kind: str) -> Column:
        _, group, least = BASE[kind]
        part = F.col(f"{kind}_part" if group else kind)
        spans = F.transform(
            kind, lambda h, k: F.struct(
                _span(kind, F.get(f"{kind}_at", k), F.get(f"{kind}_at", k) + F.char_length(h)).alias("span"),
                (F.char_length(F.get(part, k)) >= least).alias("good"),
            ),
        )
        return F.coalesce(F.transform(F.filter(spans, lambda s: s["good"]), lambda s: s["span"]), none)

    more = F.when(F.size("entropy") > 0, _entropy_spans(F.col("entropy"), F.col("entropy_at"), F.col("contexts")))
    rows = rows.select("doc_id", *(plain(k).alias(k) for k in BASE), F.coalesce(more, none).alias("more"))

    def inside(spans: Column, s: Column) -> Column:
        return F.exists(spans, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))

    fresh = F.filter("more", lambda s: ~(inside(F.col("assign"), s) | inside(F.col("access"), s) | inside(F.col("hex"), s)))
    return rows.select("doc_id", in_order(F.concat(*BASE)).alias("base"), fresh.alias("added"))


def in_order(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    rank = F.array(*(F.lit(k) for k in KINDS))
    keyed = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(rank, s["kind"]), s["end"], s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda s: s["span"])


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
