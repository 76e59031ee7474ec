"""Near-duplicate documents by MinHash, odd sketches and exact confirmation.

A document's set holds its distinct word shingles. Two documents are linked
when ``100 * intersection >= THRESHOLD * union``; the components of the links
are the groups of near copies.

1. One Arrow pass over the texts gives each document its set size, a 128-bit
   hash of the set, ``PERMUTATIONS`` MinHash samples folded into an odd sketch
   (a bitmap in which every sample flips one bit) and into ``BANDS`` band keys.
2. Documents with equal sets form one class, by an aggregate with a map-side
   step; copies cost nothing after it and are never expanded into pairs.
3. Classes that share a band key are paired with the bucket's hub (its
   smallest class), so a bucket of n classes gives n - 1 pairs. The bits in
   which two odd sketches differ tell how many samples differ; a pair whose
   estimate lies far below the threshold (``FLOOR``, five standard
   deviations of the samples) goes no further.
4. The rest are confirmed on the full shingle sets, derived again from the text
   of one document of each class concerned.
5. Union-find over the confirmed links. Buckets whose classes still lie in
   several components are compared in pairs of blocks of at most ``BLOCK``
   classes, again by odd sketch and then on full sets. So every pair that
   shares a band key is either in one component already or confirmed or
   refuted exactly. A pair at the threshold shares none of the 32 bands of
   four samples with a probability of 5e-6, less above it.

Defined cases: a null or blank text has the empty set and is linked with
nothing; a text with fewer words than a shingle has one shingle, its whole
word sequence. Rows with equal ids count as documents of their own and get the
component of their text. Null ids are never a component's id while another id
is there. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_filter, joined_components, maybe_in, min_label_components, scratch

WORDS = 5
THRESHOLD = 75
PERMUTATIONS = 128
BANDS = 32
SKETCH_LONGS = 16
FLOOR = 0.56
BLOCK = 512
SEED = 20240607


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.copy()
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles of ``text``.

    Letters A-Z count as a-z; words are split at the six ASCII white spaces.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    span = min(words, len(tokens))
    out = np.full(len(tokens) - span + 1, span, np.uint64)
    for i in range(span):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i: len(h) - span + 1 + i]
    return np.unique(_mix(out))


def _samples(grams: np.ndarray, xors: np.ndarray, factors: np.ndarray) -> np.ndarray:
    low = None
    for at in range(0, len(grams), 2048):
        part = ((grams[at: at + 2048] ^ xors) * factors).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return low


def _family(permutations: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = rng.integers(0, 2**63, size=(2, permutations, 1), dtype=np.uint64)
    return draw[0], draw[1] * np.uint64(2) + np.uint64(1)


def sketch(grams: np.ndarray, permutations: int = PERMUTATIONS, bands: int = BANDS,
           longs: int = SKETCH_LONGS, family=None) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, odd sketch as 64-bit words) of a set of at least one shingle."""
    xors, factors = family or _family(permutations)
    low = _mix(_samples(grams, xors, factors) + np.arange(permutations, dtype=np.uint64))
    keys = np.arange(bands, dtype=np.uint64)
    for row in low.reshape(bands, -1).T:
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    odd = np.bincount((low % np.uint64(64 * longs)).astype(np.int64), minlength=64 * longs) & 1
    return keys.view(np.int64), np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, n, cls, bands, odd) of every row; ``cls`` is the hash of the set, null if that is empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        family = _family(PERMUTATIONS)
        for batch in (b.slice(i, 2000) for b in batches for i in range(0, b.num_rows, 2000)):
            n, cls, bands, odd = [], [], [], []
            for text in batch.column(1):
                grams = shingle_set(text.as_py(), words)
                n.append(len(grams))
                cls.append(_class(grams))
                keys, bits = sketch(grams, family=family) if len(grams) else (None, None)
                bands.append(keys), odd.append(bits)
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                                   pa.array(bands, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))],
                                  names=["id", "n", "cls", "bands", "odd"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n bigint, cls binary, bands array<bigint>, odd array<bigint>")


def _class(grams: np.ndarray) -> bytes | None:
    """128 bits that stand for a set: two sums over its hashes; None for the empty set."""
    if not len(grams):
        return None
    return np.array([grams.sum(), _mix(grams ^ np.uint64(SEED)).sum()], np.uint64).tobytes()


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(cls, grams) for ``wanted`` (cls, wid): the full set of one document of each class."""

    def run(batches):
        for batch in batches:
            cls, sets = [], []
            for want, text in zip(batch.column(0), batch.column(1)):
                grams = shingle_set(text.as_py(), words)
                if _class(grams) == want.as_py():  # ids may repeat over different texts
                    cls.append(want.as_py()), sets.append(grams.view(np.int64))
            yield pa.record_batch([pa.array(cls, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                                  names=["cls", "grams"])

    # the bit filter keeps most texts out of the shuffle; the join decides
    bits = scratch(bit_filter(wanted.select(F.xxhash64("wid").alias("place")), "place"), "odd-bits")
    some = maybe_in(docs.withColumn("place", F.xxhash64("id")), "place", bits)
    texts = some.join(wanted, some["id"].eqNullSafe(wanted["wid"])).select("cls", "text")
    return texts.mapInArrow(run, "cls binary, grams array<bigint>").dropDuplicates(["cls"])


def _wanted(classes: DataFrame, some: DataFrame) -> DataFrame:
    return scratch(classes.join(some.distinct(), "cls").select("cls", F.col("id").alias("wid")), "odd-wanted")


def _hub_links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """Those of ``pairs`` (a, b: classes) that pass the odd sketch and then the exact comparison."""
    one = classes.select("cls", "n", "odd")
    left, right = (one.select(*[F.col(c).alias(f"{c}_{s}") for c in one.columns]) for s in "ab")
    rough = scratch(pairs.join(left, F.col("a") == F.col("cls_a")).join(right, F.col("b") == F.col("cls_b"))
                    .where(_close("a", "b", threshold)).select("a", "b", "n_a", "n_b"), "odd-rough")
    sets = scratch(_sets(docs, _wanted(classes, rough.select(F.explode(F.array("a", "b")).alias("cls"))), words), "odd-sets")
    return (rough.join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("grams_a")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("grams").alias("grams_b")), "b")
            .where(_similar("a", "b", threshold)).select("a", "b"))


def _similar(a: str, b: str, threshold: int) -> str:
    """SQL: the full sets are similar enough."""
    return (f"{100 + threshold} * cast(size(array_intersect(grams_{a}, grams_{b})) as bigint)"
            f" >= {threshold} * (n_{a} + n_{b})")


def _close(a: str, b: str, threshold: int):
    """Sizes allow the threshold, and the odd sketches don't rule it out."""
    bits = 64 * SKETCH_LONGS
    apart = 2 * PERMUTATIONS * (1 - FLOOR)  # samples that differ, both sides counted, at the floor
    most = int(bits / 2 * (1 - (1 - 2 / bits) ** apart)) + 1
    differ = " + ".join(f"bit_count(odd_{a}[{i}] ^ odd_{b}[{i}])" for i in range(SKETCH_LONGS))
    return F.expr(f"100 * least(n_{a}, n_{b}) >= {threshold} * greatest(n_{a}, n_{b}) and {differ} <= {most}")


def _rest_links(shared: DataFrame, classes: DataFrame, labels: DataFrame, docs: DataFrame, words: int,
                threshold: int) -> DataFrame:
    """Links between classes of one bucket in different components that aren't its hub.

    Pairs are compared where two blocks meet; first only the classes that have
    some partner by the odd sketch are kept, then only confirmed links leave.
    """
    members = scratch(shared.where("members > 2").join(
        labels.select(F.col("node").alias("cls"), "component"), "cls", "left")
        .select("key", "hub", "cls", F.coalesce("component", "cls").alias("component")), "odd-members")
    mixed = scratch(members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                               F.count("*").alias("members"))
                    .where("lo <> hi").select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")),
                    "odd-mixed")
    inside = scratch(members.where("cls <> hub").join(mixed, "key")
                     .withColumn("mine", F.expr("cast(pmod(xxhash64(cls, 7), blocks) as int)"))
                     .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
                     .select("key", "cls", "component", "mine", F.least("mine", "other").alias("lo"),
                             F.greatest("mine", "other").alias("hi"))
                     .join(classes.select("cls", "n", "odd"), "cls"), "odd-blocks")
    met = F.expr("key_a = key_b and lo_a = lo_b and hi_a = hi_b and component_a <> component_b"
                 " and (mine_a <> mine_b or lo_a = hi_a)") & _close("a", "b", threshold)
    left, right = (inside.select(*[F.col(c).alias(f"{c}_{s}") for c in inside.columns]) for s in "ab")
    active = scratch(left.join(right, met, "left_semi"), "odd-active")
    if active.isEmpty():
        return labels.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    sets = _sets(docs, _wanted(classes, active.select(F.col("cls_a").alias("cls"))), words)
    full = scratch(active.join(sets.select(F.col("cls").alias("cls_a"), F.col("grams").alias("grams_a")), "cls_a"),
                   "odd-full")
    other = full.select(*[F.col(c).alias(c[:-1] + "b") for c in full.columns])
    return (full.join(other, met & F.expr(f"cls_a < cls_b and {_similar('a', 'b', threshold)}"))
            .select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    threshold: int = THRESHOLD) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, the row's own id
    included; ``kept`` marks the rows whose id that is.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signs = scratch(signatures(docs, id_col, text_col, words), "odd-signatures")
    classes = scratch(signs.where("cls is not null").groupBy("cls").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.first("odd").alias("odd")), "odd-classes")
    keys = classes.select("cls", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("cls").alias("hub"), F.count("*").alias("members")).where("members > 1")
    shared = scratch(keys.join(scratch(buckets, "odd-buckets"), "key"), "odd-shared")
    pairs = shared.where("cls <> hub").select(F.col("cls").alias("a"), F.col("hub").alias("b")).distinct()
    links = scratch(_hub_links(pairs, classes, plain, words, threshold), "odd-links")
    labels = min_label_components(links, "odd")
    more = scratch(_rest_links(shared, classes, labels, plain, words, threshold), "odd-rest")
    if not more.isEmpty():
        labels = joined_components(labels, more, "odd")
    grouped = classes.select("cls", "id").join(labels.select(F.col("node").alias("cls"), "component"), "cls", "left") \
        .withColumn("component", F.coalesce("component", "cls"))
    smallest = grouped.groupBy("component").agg(F.min("id").alias("component_id"))
    ids = scratch(grouped.join(smallest, "component").select("cls", "component_id"), "odd-ids")
    return signs.select("id", "n", "cls").join(ids, "cls", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")) \
        .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
