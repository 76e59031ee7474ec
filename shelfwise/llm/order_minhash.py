"""Document fingerprints by Order MinHash, sensitive to edit distance.

The k-mers of a text (windows of ``K`` code points) are numbered by occurrence,
so a repeated k-mer counts every time, and hashed to a circle. Coordinate j of
the fingerprint takes the ``L`` first of them from point j of ``COORDINATES``
evenly spread points on: the ``L`` minimal k-mers under the j-th rotation of
the hash order. They are put back into text order and hashed as a tuple, so a
coordinate agrees only where two texts share those k-mers in the same order.
The likeness of two fingerprints is the share of coordinates that agree.

Defined cases: a null text counts as the empty text; a text shorter than ``K``
has one k-mer, itself; a text with fewer than ``L`` k-mers uses them all. Equal
texts have equal fingerprints. Rows come in descending order of (id, hash of
the text), so equal ids have a fixed order; null ids come last.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import scratch

K = 12
L = 2
COORDINATES = 128
ROWS_PER_RANGE = 2000
MOST_RANGES = 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POSITION_BITS = 24


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _kmers(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` code points (of the whole text, if it is shorter)."""
    h = codes.astype(np.uint64) + np.uint64(1)
    if len(h) < k:
        out = np.full(1, len(h), np.uint64)
        for c in h:
            out = out * _ODD + c
        return _mix(out)
    powers, blocks = {1: _ODD}, {1: h}
    size = 1
    while size * 2 <= k:  # windows of 2, 4, 8 ... code points from two halves
        half = blocks[size]
        blocks[size * 2] = half[:-size] * powers[size] + half[size:]
        powers[size * 2] = np.uint64(int(powers[size]) ** 2 % 2**64)
        size *= 2
    out, done = None, 0
    n = len(h) - k + 1
    for size in sorted(blocks, reverse=True):
        if k - done >= size:
            part = blocks[size][done: done + n]
            out = part.copy() if out is None else out * powers[size] + part
            done += size
    return _mix(out)


def _sorted_with_place(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (their high bits) in order, and the place of each; ties by place."""
    if len(keys) < 1 << _POSITION_BITS:
        packed = (keys >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | np.arange(len(keys), dtype=np.uint64)
        packed.sort()
        return packed >> np.uint64(_POSITION_BITS), (packed & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    high = keys >> np.uint64(_POSITION_BITS)
    order = np.argsort(high, kind="stable")
    return high[order], order


def fingerprint(codes: np.ndarray, k: int = K, tuple_size: int = L, coordinates: int = COORDINATES) -> np.ndarray:
    """``coordinates`` 16-bit values of the code points ``codes``."""
    kmers = _kmers(codes, k)
    n = len(kmers)
    high, place = _sorted_with_place(kmers)
    at = np.arange(n)
    starts = np.maximum.accumulate(np.where(np.r_[True, high[1:] != high[:-1]], at, 0))
    numbered = np.empty(n, np.uint64)
    numbered[place] = _mix(high * _ODD + (at - starts).astype(np.uint64))
    circle, where = _sorted_with_place(numbered)
    points = (np.arange(coordinates, dtype=np.uint64) * np.uint64((1 << 64) // coordinates)) >> np.uint64(_POSITION_BITS)
    first = np.searchsorted(circle, points)
    chosen = np.sort(where[(first[:, None] + np.arange(min(tuple_size, n))) % n], axis=1)
    out = np.full(coordinates, tuple_size, np.uint64)
    for column in chosen.T:
        out = _mix(out * _ODD + numbered[column])
    return (out >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _longs(values: list) -> str:
    return ", ".join(f"{v}L" for v in values) or "cast(null as bigint)"


def in_descending_order(docs: DataFrame, id_col: str, text_col: str,
                        rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(range, id, text, ord, extra): whole ranges of ids, each followed by the next range's first row.

    Ranges are cut at approximate quantiles of the id (an aggregate with a fixed
    size for a given number of ranges, ``MOST_RANGES`` at most), so every row's
    successor is in its partition. Only one row a range is sent twice. The last
    range is followed by the first row of all.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = base.count()
    parts = max(1, min(n // rows_per_range, MOST_RANGES))
    cuts = base.where("id is not null").agg(
        F.percentile_approx("id", [i / parts for i in range(1, parts)], 10 * parts).alias("q")
    ).first()["q"] if parts > 1 else []
    cuts = sorted(set(cuts or []), reverse=True)
    # Range 0 holds the largest ids; null ids sort after all others. Two steps over the
    # cuts, first every ``step``-th and then those between, instead of one over them all.
    step = max(1, int(len(cuts) ** 0.5))
    coarse, fine = cuts[step - 1:: step], [cuts[i: i + step - 1] for i in range(0, len(cuts), step)]
    index: Column = F.lit(0)
    if cuts:
        base = base.withColumn("_coarse", F.expr(f"size(filter(array({_longs(coarse)}), b -> id <= b))"))
        inner = ", ".join(f"array({_longs(f)})" for f in [*fine, []])
        index = F.expr(f"_coarse * {step} + size(filter(get(array({inner}), _coarse), b -> id <= b))")
    index = F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(index)
    keyed = base.withColumn("range", index.cast("int")).select(
        "range", "id", "text", F.xxhash64("text").alias("ord"))
    rank = F.struct("id", "ord")
    tops = scratch(keyed.groupBy("range").agg(F.max(rank).alias("top")), "omh-tops")
    order = tops.orderBy("range").collect()  # one row a range
    ranges = [r["range"] for r in order]
    follow = {r: ranges[i - 1] for i, r in enumerate(ranges)}
    firsts = docs.sparkSession.createDataFrame(
        [(r, follow[r], r == ranges[0]) for r in ranges] or [(0, 0, True)], "range int, before int, wraps boolean")
    sent = (keyed.join(F.broadcast(tops.join(firsts, "range")), "range")
            .withColumn("is_top", rank.eqNullSafe(F.col("top"))))
    copies = sent.where("is_top").dropDuplicates(["range"]).select(
        F.col("before").alias("range"), "id", "text", "ord", F.lit(True).alias("extra"))
    return sent.select("range", "id", "text", "ord", F.lit(False).alias("extra")).unionByName(copies)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    A row's edited text is its own with the last half (rounded down) replaced by
    the first as many code points of the next row's text, in descending order
    of the id; the row after the last is the first.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = in_descending_order(docs, id_col, text_col)

    def run(batches):
        held = None  # the row whose successor is still to come: (range, id, codes, fingerprint)
        for batch in batches:
            out = []
            for part, doc, text, extra in zip(*(batch.column(i) for i in range(4))):
                part, doc, extra = part.as_py(), doc.as_py(), extra.as_py()
                codes = _codes(text.as_py())
                print_ = fingerprint(codes)
                if held is not None and held[0] == part:
                    _, before, own, own_print = held
                    half = len(own) // 2
                    edited = np.concatenate([own[: len(own) - half], codes[:half]])
                    after = fingerprint(edited)
                    sha = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass")
                                         .encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((before, len(own), sha, own_print.astype(">u2").tobytes().hex(),
                                after.astype(">u2").tobytes().hex(), likeness(own_print, after),
                                likeness(own_print, print_)))
                held = None if extra else (part, doc, codes, print_)
            columns = list(zip(*out)) if out else [[] for _ in range(7)]
            yield pa.record_batch([pa.array(columns[0], batch.schema.field(1).type), pa.array(columns[1], pa.int64()),
                                   *[pa.array(columns[i], pa.string()) for i in (2, 3, 4)],
                                   *[pa.array(columns[i], pa.float64()) for i in (5, 6)]],
                                  names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                         "near_edited", "near_next"])

    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartitionByRange(width, "range")
            .sortWithinPartitions("range", "extra", F.col("id").desc_nulls_last(), F.col("ord").desc())
            .select("range", "id", "text", "extra")
            .mapInArrow(run, f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string,"
                             " edited_fingerprint string, near_edited double, near_next double"))
