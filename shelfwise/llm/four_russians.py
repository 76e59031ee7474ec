"""Hard negatives by exact integer inner products, scored with the method of the Four Russians.

Components become whole numbers, ``floor(scale * x)``. For every anchor and every
group of eight dimensions a table holds the sums of all 256 subsets of the
anchor's eight components. A candidate is stored as bit planes in two's
complement: bit k of eight neighbouring components is one byte. That byte looks
up the plane's sum in the table of its group, and the planes are put together
by shifting and adding, the sign plane counting negative. The result is the
full inner product, exactly, with one lookup for eight products of one bit.

1. Candidates are dealt into shards by a hash of their id: no label, no cluster
   and no common vector makes a shard large. Anchors, a stated query set, go to
   every shard; candidates are moved once and are never copied for blocks of
   anchors. A task reads its shard's candidates, then streams the anchors past
   them ``BLOCK`` at a time, so it holds one shard (``SHARD`` rows at most, on
   average) and one block.
2. First pass: each shard's best rows of the anchor's own label; a window over the
   few finds of an anchor keeps the first ``positives``.
3. Second pass: the anchors bring the scores of their positives. Each shard gives,
   for each positive, its best rows of other labels whose score lies between
   ``low`` and ``high`` hundredths of the positive's. They are merged likewise.

Ids must be whole numbers. A row takes part if it has an id and a label, and its
vector has no null or non-finite component and the commonest length (of equally
common ones the shortest) above zero. A component beyond +-65536 after scaling
by 1/256 (2**24 in all) keeps its row out as well: its scores needn't fit 64 bits.
Zero vectors take part. Of rows that repeat an id one takes part, that with the
smallest (label, vector). Ties in score go to the smaller id. An anchor without
a positive, and a positive without a negative, have no rows; an empty table has
none. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import scratch

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
#: Rows of a shard: planes of about 20 MB at 64 dimensions.
SHARD = 262_144
LEAST_SHARD = 2_048
#: Anchors scored at once; a shard's scores for them take 64 MB at most.
BLOCK = 32
CHUNK = 8_192
LARGEST = 1 << 24


class Planes:
    """Candidates (sorted by id) as packed bit planes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, q = ids[order], labels[order], q[order]
        self.largest = int(max(q.max(initial=0), -q.min(initial=0)))
        self.width = max(int(q.max(initial=0)).bit_length(), int(~q.min(initial=0)).bit_length()) + 1
        self.planes = [np.ascontiguousarray(np.packbits(((q >> k) & 1).astype(np.uint8), axis=1, bitorder="little").T)
                       for k in range(self.width)]
        by_label = np.argsort(self.labels, kind="stable")
        kinds, starts = np.unique(self.labels[by_label], return_index=True)
        self.of_label = dict(zip(kinds.tolist(), np.split(by_label, starts[1:])))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """(anchors, candidates): the inner products."""
        tables = subset_sums(anchors, self.largest)
        out = np.empty((len(anchors), len(self.ids)), tables.dtype)
        for at in range(0, len(self.ids), CHUNK):
            total = None
            for k in range(self.width - 1, -1, -1):
                plane = self.planes[k][:, at:at + CHUNK]
                found = tables[0].take(plane[0], axis=0)
                for table, byte in zip(tables[1:], plane[1:]):
                    found += table.take(byte, axis=0)
                if total is None:
                    total = np.negative(found)
                else:
                    total <<= 1
                    total += found
            out[:, at:at + CHUNK] = total.T
        return out


def subset_sums(anchors: np.ndarray, largest: int) -> np.ndarray:
    """(groups of eight dimensions, 256, anchors): the sums of every subset of eight components."""
    a = np.pad(anchors, ((0, 0), (0, -anchors.shape[1] % 8)))
    most = a.shape[1] * int(np.abs(a).max(initial=0)) * 2 * (largest + 1)
    a = a.astype(np.int32 if most < 2 ** 31 else np.int64).T.reshape(-1, 8, len(anchors))
    tables = np.zeros((len(a), 256, len(anchors)), a.dtype)
    for bit in range(8):
        tables[:, 1 << bit: 2 << bit] = tables[:, : 1 << bit] + a[:, bit: bit + 1]
    return tables


def first(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of ``among`` (ascending) with the highest scores, ties in the order of ``among``."""
    s = scores[among]
    if len(s) > k:
        some = s >= np.partition(s, len(s) - k)[len(s) - k]
        among, s = among[some], s[some]
    return among[np.argsort(-s, kind="stable")[:k]]


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, q) of the rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                           F.col(vec_col).alias("v"), v.alias("q"))
            .where("id is not null and label is not null and size(v) > 0")
            .where(f"forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')"
                   f" and abs({SCALE}D * x) <= {LARGEST})"))
    one = rows.groupBy("id").agg(F.min(F.struct("label", "q")).alias("r")).select("id", "r.label", "r.q")
    return scratch(one.withColumn("q", F.col("q").cast("array<int>")), "negatives-rows")


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64)


def _meet(base: DataFrame, anchors: DataFrame, shards: int, select, schema: str) -> DataFrame:
    """Every anchor past every shard: ``select(planes, anchor row, scores)`` yields rows of ``schema``.

    Sorted by (shard, kind), a shard's candidates come before the anchors.
    """
    extra = [c for c in anchors.columns if c not in ("id", "label", "q")]
    left = base.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "id",
                       "label", "q", *[F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in extra])
    right = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"),
                           "id", "label", "q", *extra)
    rows = left.unionByName(right).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "id")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        shard, held, planes = None, [], None
        for batch in batches:
            edges = np.flatnonzero(np.diff(batch.column("shard").to_numpy() * 2 + batch.column("kind").to_numpy())) + 1
            for lo, hi in zip([0, *edges], [*edges, batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                if not part.num_rows:
                    continue
                if part.column("shard")[0].as_py() != shard:
                    shard, held, planes = part.column("shard")[0].as_py(), [], None
                if part.column("kind")[0].as_py() == 0:
                    held.append((part.column("id").to_numpy(), part.column("label").to_numpy(),
                                 _matrix(part.column("q")).astype(np.int32)))
                    continue
                if planes is None and held:
                    planes = Planes(*[np.concatenate(x) for x in zip(*held)])
                    held = []
                for at in range(0, part.num_rows if planes else 0, BLOCK):
                    some = part.slice(at, BLOCK)
                    scores = planes.scores(_matrix(some.column("q")))
                    found = [r for a, s in zip(some.drop_columns(["q"]).to_pylist(), scores) for r in select(planes, a, s)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in (zip(*found) if found else [[]] * len(names))], names=names)

    return rows.mapInArrow(run, schema)


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, shard: int = SHARD) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows for which ``anchors`` holds.

    ``anchors`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, id_col, vec_col, label_col)
    common = rows.groupBy(F.size("q").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint,"
                                         " positive_score bigint, negative_score bigint")
    base, n = rows.where(F.size("q") == common["d"]), common["count"]
    # shards of a bounded size, and enough of them to keep the executors busy
    shards = max(-(-n // shard), min(spark.sparkContext.defaultParallelism, -(-n // LEAST_SHARD)))
    asked = base.where(anchors)

    def same(planes, a, scores):
        among = planes.of_label.get(a["label"], np.zeros(0, np.int64))
        for i in first(scores, among[planes.ids[among] != a["id"]], positives):
            yield a["id"], planes.ids[i], scores[i]

    near = _meet(base, asked, shards, same, "id bigint, positive_id bigint, positive_score bigint")
    place = F.row_number().over(W.partitionBy("id").orderBy(F.desc("positive_score"), "positive_id"))
    chosen = scratch(near.withColumn("_n", place).where(F.col("_n") <= positives).drop("_n"), "negatives-positives")
    known = chosen.groupBy("id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("near"))

    def other(planes, a, scores):
        apart = planes.labels != a["label"]
        for p in a["near"]:
            least, most = -(-low * p["positive_score"] // 100), high * p["positive_score"] // 100
            among = np.flatnonzero(apart & (scores >= least) & (scores <= most))
            for i in first(scores, among, negatives):
                yield a["id"], p["positive_id"], planes.ids[i], p["positive_score"], scores[i]

    found = _meet(base, asked.join(known, "id"), shards, other,
                  "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint")
    rank = F.row_number().over(W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
