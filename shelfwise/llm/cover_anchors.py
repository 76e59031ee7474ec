"""Repeated word windows, found from difference-cover anchors.

A window is ``window`` consecutive words of one document. A word goes if a window
that covers it also starts in a document with a smaller id.

A difference cover D of a period v holds, for any two offsets, a shift below v
that brings both onto D. So two equal windows, wherever they start in their
documents, contain equal anchors of ``window - v + 1`` words that both begin at a
position in D modulo v. Only these positions are hashed: 6 of 31 at 50 words,
instead of every window.

1. One Arrow pass gives each document its number of words and the hashes of its
   anchors. Equal texts form one class, named by 128 bits.
2. An anchor that texts of two classes hold is shared (smallest and largest class
   an anchor, an aggregate with a map-side step: a passage that a third of all
   documents hold is a row a task after it).
3. Extension: shared anchors are widened to the up to v windows that contain
   them, of one document of each class, and these windows get 128-bit keys of all
   their words. The smallest id of each key, again with a map-side step, tells
   which windows start in a smaller document. Whether an occurrence in another
   document than the smallest matters need not be known: each key has one smallest
   id, so no pairs are made and no group is gathered.
4. The starts found are collected by class (as many as the document has words) and
   the words cut from the texts. A row whose class has a smaller id loses all its
   words if it has a window at all. Texts of classes without finds aren't
   shuffled while their number lets a bit filter tell them apart.

Joins that look up a shared anchor or window have one row a key on the other side,
so AQE can split a frequent one.

Defined cases: words are runs of anything but the six ASCII white spaces, unchanged.
A null text has no words and gives an empty text, as does an empty one. Texts
shorter than a window stay whole. Ids must be whole numbers; a null id counts as
larger than any other, and two null ids as equal. Rows with equal ids are no smaller
than each other, so they keep what they share. A repeated row gets the
same result each time. An empty table has no rows. A text's words are held in memory
one text at a time, whatever its length. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_filter, maybe_in, scratch, surely_not_in

WINDOW = 50
#: Perfect difference sets, period -> residues; every difference occurs exactly once.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LAST = 2 ** 63 - 1
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def period(window: int) -> int:
    """The largest period that leaves anchors of at least a third of the window."""
    return max(v for v in COVERS if v == 3 or window - v + 1 >= window / 3)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(b**i, b**-i) modulo 2**64 for i < n; grown by doubling and kept for the task."""
    if not _powers or len(_powers[0][0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        _powers[:] = [tuple(np.multiply.accumulate(np.array([1] + [b] * (size - 1), np.uint64))
                            for b in (base, pow(base, -1, 2 ** 64))) for base in _BASES]
    up, down = _powers[lane]
    return up[:n], down[:n]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """(2, words): 128 bits a word."""
    flat = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64)
    return np.ascontiguousarray(flat.reshape(-1, 2).T)


def run_hashes(h: np.ndarray, lane: int, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words: a polynomial in the words' hashes, from prefix sums."""
    up, down = _power(lane, len(h))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up)])
    return _mix((sums[length:] - sums[:-length]) * down[: len(sums) - length])


def anchor_places(n: int, window: int) -> np.ndarray:
    """Where the anchors of ``n`` words begin."""
    v = period(window)
    at = np.arange(0, max(0, n - (window - v)), dtype=np.int32)
    return at[np.isin(at % v, COVERS[v])] if n >= window else at[:0]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(own, id, c1, c2, text): the id as it is and with a null as the largest, and the class of the text."""
    text, own = F.col(text_col), F.col(id_col).cast("bigint")
    return docs.select(own.alias("own"), F.coalesce(own, F.lit(_LAST)).alias("id"), F.xxhash64(text).alias("c1"),
                       F.xxhash64(F.lit("class"), text).alias("c2"), text.alias("text"))


def _anchors(rows: DataFrame, window: int) -> DataFrame:
    """(id, c1, c2, anchors) of the rows with at least one window."""
    length = window - period(window) + 1

    def run(batches):
        for batch in (b.slice(i, 2000) for b in batches for i in range(0, b.num_rows, 2000)):
            keep, anchors = [], []
            for i, text in enumerate(batch.column("text")):
                words = _words(text.as_py())
                if len(words) >= window:
                    found = run_hashes(word_hashes(words)[0], 0, length)[anchor_places(len(words), window)]
                    keep.append(i), anchors.append(found.view(np.int64))
            part = batch.drop_columns(["text"]).take(pa.array(keep, pa.int64()))
            yield part.append_column("anchors", pa.array(anchors, pa.list_(pa.int64())))

    return rows.drop("own").mapInArrow(run, "id bigint, c1 bigint, c2 bigint, anchors array<bigint>")


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """(id, c1, c2, at, w1, w2): the windows around the anchors ``hits`` (their numbers) of each text."""
    v = period(window)

    def run(batches):
        for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            at, keys = [], ([], [])
            for text, hits in zip(batch.column("text"), batch.column("hits")):
                words = _words(text.as_py())
                places = anchor_places(len(words), window)[hits.values.to_numpy()]
                edges = np.zeros(len(words) + 2, np.int64)
                np.add.at(edges, np.maximum(places - v + 1, 0), 1)
                np.add.at(edges, places + 1, -1)
                starts = np.flatnonzero(np.cumsum(edges)[: len(words) - window + 1])
                h = word_hashes(words)
                at.append(starts.astype(np.int32))
                for lane in (0, 1):
                    keys[lane].append(run_hashes(h[lane], lane, window)[starts].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("id", "c1", "c2")] + [pa.array(at, pa.list_(pa.int32()))]
                + [pa.array(k, pa.list_(pa.int64())) for k in keys], names=["id", "c1", "c2", "at", "w1", "w2"])

    return rows.mapInArrow(run, "id bigint, c1 bigint, c2 bigint, at array<int>, w1 array<bigint>, w2 array<bigint>")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(c1, c2, id, starts) of every class of texts that loses words.

    ``id`` is the smallest id that has the text: rows with a larger one lose all
    their words. ``starts`` are the windows that a smaller document holds.
    """
    rows = _keyed(docs, id_col, text_col)
    signs = scratch(_anchors(rows, window), "cover-anchors")
    classes = scratch(signs.groupBy("c1", "c2").agg(F.min("id").alias("id"), F.max("id").alias("last")), "cover-classes")
    shared = (signs.select(F.explode("anchors").alias("anchor"), "c1").groupBy("anchor")
              .agg(F.min("c1").alias("lo"), F.max("c1").alias("hi")).where("lo < hi").select("anchor"))
    hits = (signs.select("c1", "c2", F.posexplode("anchors").alias("k", "anchor"))
            .join(scratch(shared, "cover-shared"), "anchor").groupBy("c1", "c2").agg(F.collect_set("k").alias("hits")))
    wanted = scratch(hits.join(classes.select("c1", "c2", "id"), ["c1", "c2"]), "cover-hits")
    place = F.xxhash64("c1", "c2", "id").alias("place")
    bits = scratch(bit_filter(wanted.select(place), "place"), "cover-bits")
    texts = maybe_in(rows.withColumn("place", place), "place", bits).drop("place").join(wanted, ["c1", "c2", "id"])
    found = scratch(_windows(texts.select("id", "c1", "c2", "text", "hits"), window), "cover-windows")
    each = found.select("id", "c1", "c2", F.explode(F.arrays_zip("at", "w1", "w2")).alias("w")) \
        .select("id", "c1", "c2", "w.at", "w.w1", "w.w2")
    least = (each.groupBy("w1", "w2").agg(F.min("id").alias("least"), F.max("id").alias("most"))
             .where("least < most").select("w1", "w2", "least"))
    starts = (each.join(scratch(least, "cover-least"), ["w1", "w2"]).where("least < id")
              .groupBy("c1", "c2").agg(F.collect_set("at").alias("starts")))
    return (classes.join(starts, ["c1", "c2"], "left").where("id < last or starts is not null")
            .select("c1", "c2", "id", "starts"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, spans, text) of every row: the words that stay, joined by one space.

    ``spans`` are the runs of removed words (begin, end exclusive).
    """
    verdicts = scratch(repeats(docs, id_col, text_col, window), "cover-verdicts") \
        .select("c1", "c2", F.col("id").alias("least"), "starts")
    rows = _keyed(docs, id_col, text_col)
    bits = scratch(bit_filter(verdicts, "c1"), "cover-verdict-bits")
    touched = maybe_in(rows, "c1", bits).join(verdicts, ["c1", "c2"], "left")
    others = surely_not_in(rows, "c1", bits).withColumn("least", F.lit(None).cast("bigint")) \
        .withColumn("starts", F.lit(None).cast("array<int>"))
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32())])
    kind = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(span)),
                      ("text", pa.string())])

    def run(batches):
        for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            out = []
            for own, i, text, least, starts in zip(*[batch.column(c) for c in ("own", "id", "text", "least", "starts")]):
                words = _words(text.as_py())
                gone = np.zeros(len(words) + 1, np.int64)
                if len(words) >= window and least.is_valid and least.as_py() < i.as_py():
                    gone[[0, len(words)]] = 1, -1
                elif starts.is_valid:
                    at = starts.values.to_numpy()
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + window, -1)
                gone = np.cumsum(gone[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                kept = words if not len(edges) else [words[k] for k in np.flatnonzero(~gone)]
                out.append({"id": own.as_py(), "n_words": len(words), "n_removed": int(gone.sum()),
                            "spans": [{"begin": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)],
                            "text": b" ".join(kept).decode("utf-8", "surrogatepass")})
            yield pa.RecordBatch.from_pylist(out, kind)

    cols = ("own", "id", "text", "least", "starts")
    return touched.select(*cols).unionByName(others.select(*cols)).mapInArrow(
        run, "id bigint, n_words bigint, n_removed bigint, spans array<struct<begin: int, end: int>>, text string")
