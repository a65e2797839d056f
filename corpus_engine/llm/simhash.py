"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. If two fingerprints differ in at
most four bits, two of the three segments differ in at most two bits each. Every segment, padded
with zeros to 23 bits, is decoded with the perfect binary Golay code: its key is the index of the
codeword within distance three, and for words at distance three also the indices of the five
codewords at distance four. Two words at distance two or less always share one of these keys, so
equal pairs of keys for two segments find every link. Candidates are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.base import aside, slices
from corpus_engine.llm.components import connected
from corpus_engine.session import settled

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
SHORT_RUN = 64
BLOCK = 2048

GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift, width


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def _decoding() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits, and per remainder up to six error patterns."""
    low = np.array([_remainder(i) for i in range(1 << 12)], dtype=np.int32)
    high = np.array([_remainder(i << 12) for i in range(1 << 11)], dtype=np.int32)
    patterns: list[list[int]] = [[] for _ in range(1 << 11)]
    bits = [(1 << i, _remainder(1 << i)) for i in range(23)]
    for weight in range(5):
        for chosen in combinations(bits, weight):
            word = rest = 0
            for b, r in chosen:
                word ^= b
                rest ^= r
            if weight < 4 or patterns[rest][0].bit_count() == 3:
                patterns[rest].append(word)
    errors = np.full((1 << 11, 6), -1, dtype=np.int32)
    for rest, found in enumerate(patterns):
        errors[rest, : len(found)] = found
    return low, high, errors


LOW, HIGH, ERRORS = _decoding()


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """Six codeword indices for each word of up to 23 bits; -1 where there are fewer."""
    errors = ERRORS[LOW[words & 0xFFF] ^ HIGH[words >> 12]]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def segment_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``row, key`` of every pair of segments and every pair of their codeword indices."""
    unsigned = fingerprints.astype(np.int64).view(np.uint64)
    indices = [
        codeword_indices((unsigned >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int32)) for s, w in SEGMENTS
    ]
    rows, keys = [], []
    for number, (x, y) in enumerate(combinations(indices, 2)):
        key = (number << 24) | (x[:, :, None] << 12) | y[:, None, :]
        row, i, j = np.nonzero((x[:, :, None] >= 0) & (y[:, None, :] >= 0))
        rows.append(row)
        keys.append(key[row, i, j])
    return np.concatenate(rows), np.concatenate(keys).astype(np.int32)


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> bytes:
    """Eight bytes, most significant first: a bit is set if it is set in over half the hashes."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return bytes(8)
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(g, SEED) for g in grams]), dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[at : at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, fp`` (the 64 bits as a long) of every row. Null and wordless texts have
    fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = b"".join([fingerprint(t, shingle) for t in batch.column(2).to_pylist()])
            bits = np.frombuffer(found, dtype=">i8").astype(np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(bits)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    whole = F.col(text).cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(whole).alias("text_hash"), whole.alias("text")).mapInArrow(
        run, "doc_id long, text_hash long, fp long"
    )


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; counted on unsigned words, as signed ones count their absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the graph of all pairs within ``bits``."""
    left = np.arange(1, len(fps))
    frontier = np.zeros(1, dtype=np.int64)
    a, b = [], []
    while len(left):
        if not len(frontier):
            frontier, left = left[:1], left[1:]
            continue
        parent = np.full(len(left), -1)
        for at in range(0, len(frontier), 64):
            near = _distance(fps[frontier[at : at + 64], None], fps[None, left]) <= bits
            hit = near.any(axis=0) & (parent < 0)
            parent[hit] = frontier[at + near[:, hit].argmax(axis=0)]
        reached = parent >= 0
        a.append(parent[reached])
        b.append(left[reached])
        frontier, left = left[reached], left[~reached]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def _link(keys: np.ndarray, fps: np.ndarray, bits: int, most: int) -> Iterator[tuple]:
    """``key, a, b`` arrays: verified links within runs of equal keys; b is None for the members of
    runs of more than ``most`` rows, which are handed on."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    lengths = np.diff(np.append(starts, len(keys)))
    short = np.repeat(lengths <= SHORT_RUN, lengths)
    at = np.flatnonzero(short)
    for step in range(1, SHORT_RUN):
        at = at[at + step < len(keys)]
        at = at[keys[at + step] == keys[at]]
        if not len(at):
            break
        near = at[_distance(fps[at], fps[at + step]) <= bits]
        yield keys[near], fps[near], fps[near + step]
    for start, length in zip(starts[lengths > SHORT_RUN], lengths[lengths > SHORT_RUN], strict=True):
        own, group = fps[start : start + length], keys[start : start + length]
        if length > most:
            yield group, own, None
        else:
            a, b = _forest(own, bits)
            yield group[: len(a)], own[a], own[b]


EDGES = "key int, a long, b long"


def _edge_batch(key: np.ndarray, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
    other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
    return pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(a), other], ["key", "a", "b"])


def _runs(bits: int, most: int):
    """A function over rows sorted by key, with runs that may cross batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, hot = np.zeros(0, np.int32), np.zeros(0, np.int64), None
        for batch in batches:
            k, f = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            if hot is not None:
                end = np.searchsorted(k, hot, "right")
                if end:
                    yield _edge_batch(k[:end], f[:end], None)
                k, f = k[end:], f[end:]
            keys, fps = np.concatenate([keys, k]), np.concatenate([fps, f])
            if not len(keys):
                continue
            cut = np.searchsorted(keys, keys[-1], "left")
            if cut:
                for found in _link(keys[:cut], fps[:cut], bits, most):
                    yield _edge_batch(*found)
            keys, fps = keys[cut:], fps[cut:]
            if len(keys) > most:
                hot = keys[-1]
                yield _edge_batch(keys, fps, None)
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            for found in _link(keys, fps, bits, most):
                yield _edge_batch(*found)

    return run


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.asarray(batch.column(0))
        for at in range(0, len(fps), 4096):
            row, key = segment_keys(fps[at : at + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[at : at + 4096][row])], ["key", "fp"])


def links(distinct: DataFrame, bits: int = MAX_BITS, most: int = BLOCK) -> DataFrame:
    """``a, b``: edges between fingerprints (column ``fp``, each once) that join the same
    fingerprints as all pairs within ``bits`` (at most four) do.

    A group of up to 64 fingerprints with a common key yields its verified pairs, a larger one a
    spanning forest of them, never all pairs. Groups of more than ``most`` are dealt out as pairs of
    blocks over all tasks.
    """
    if bits > MAX_BITS:
        raise ValueError(f"the segment keys cover up to {MAX_BITS} differing bits")
    keyed = distinct.select("fp").mapInArrow(_keyed, "key int, fp long")
    found = settled(
        keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_runs(bits, most), EDGES), "simhash-links"
    )
    over = found.where(F.col("b").isNull()).select("key", F.col("a").alias("fp"))
    blocks = over.groupBy("key").agg(F.ceil(F.count("*") / F.lit(most / 2)).cast("int").alias("n"))
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    dealt = (
        over.join(blocks, "key")
        .select("fp", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
        .select("fp", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("pair"))
        .repartition("pair")
        .sortWithinPartitions("pair")
        .select("pair", "fp")
        .mapInArrow(_block_runs(bits), "key int, a long, b long")
    )
    return found.where(F.col("b").isNotNull()).select("a", "b").unionByName(dealt.select("a", "b"))


def _block_runs(bits: int):
    """As ``_runs`` for block pairs, whose size is bounded, under a wide key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def done(keys, fps):
            for _, a, b in _link(keys, fps, bits, len(keys)):
                yield _edge_batch(np.zeros(len(a), np.int32), a, b)

        for batch in batches:
            keys = np.concatenate([keys, np.asarray(batch.column(0))])
            fps = np.concatenate([fps, np.asarray(batch.column(1))])
            if len(keys):
                cut = np.searchsorted(keys, keys[-1], "left")
                if cut:
                    yield from done(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield from done(keys, fps)

    return run


def near_duplicates(
    docs: DataFrame, text: str = "text", bits: int = MAX_BITS, shingle: int = SHINGLE_WORDS
) -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` of every row of ``docs``.

    Rows with equal fingerprints count as linked; component_id is the smallest doc_id reachable.
    Equal fingerprints are collapsed before the search, so groups of copies cost one row. Repeated
    doc_ids keep a row each; a null doc_id is carried along and is never a component_id, unless
    the whole component has none. Other columns of ``docs`` are not looked at. An empty table gives
    an empty result.
    """
    prints = settled(fingerprints(docs, text, shingle), "simhash-prints")
    distinct = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = connected(links(distinct, bits))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = settled(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = settled(rooted.join(least, "root").select("fp", "component_id"), "simhash-classes")
    return prints.join(classes, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one(docs: DataFrame, text: str = "text", bits: int = MAX_BITS, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one row of each near-duplicate class, the one with the smallest doc_id.

    Of rows that repeat that doc_id, the text with the smallest hash stays, once. Classes without
    any doc_id keep one row as well.
    """
    narrow, widen = aside(docs, "doc_id", text)
    found = near_duplicates(narrow, text, bits, shingle)
    classes = found.withColumn("class", F.coalesce("component_id", "fp")).withColumn("nameless", F.isnull("component_id"))
    first = F.min_by(F.struct("doc_id", "text_hash"), F.struct(F.isnull("doc_id"), "doc_id", "text_hash"))
    kept = settled(classes.groupBy("nameless", "class").agg(first.alias("kept")).select("kept.*"), "simhash-kept")
    kept = kept.withColumnsRenamed({"doc_id": "kept_id", "text_hash": "kept_hash"})
    hashed = narrow.withColumn("kept_text", F.xxhash64(F.col(text).cast("string")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id")) & (F.col("kept_text") == F.col("kept_hash"))
    return widen(hashed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "kept_text"]))
