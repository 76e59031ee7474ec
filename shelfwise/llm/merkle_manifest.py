"""Merkle manifest of a table: a content-addressed store of digests, and proofs by descent from the root.

Every row is a leaf, the SHA-256 of its fields. The leaves of a group, in order,
form a tree of runs of three: while several nodes remain, every three
consecutive ones (the last run may have fewer, even one) become the digest of
their hex digests. What remains is the group's subroot; the subroots, in the
order of their groups (null first), form a tree in the same way.

Store. Digest-to-children records, kept in pages: a page holds the records of
``levels`` levels below one node and is found by that node's digest. Building
groups the nodes of one level by page, at most ``3**levels`` a group, and goes
on with the pages' digests, so the number of shuffles grows with the number of
page levels (four for 10**11 leaves) and each is ``3**levels`` times smaller
than the one before. Positions come from ``distributed_rank``: a group that
holds a third of all rows is numbered in ranges, never in one task.

Descent. Requests that share a prefix of rank digits go down as one row: the
wanted leaves are folded into wanted pages, those into pages of pages, up to the
root. From there each step looks up the page of the digest it stands on, follows
the base-3 digits of every wanted slot from record to record and collects the
children it does not take. At the leaves the collected segments are reversed:
that is the proof, leaf to root.

Defined cases: a null field is ``-``, any other its UTF-8 byte count, ``:`` and
its text; an empty text is ``0:``. Null groups are one group, before all others.
Null ids come first in their group; rows with equal ids are ordered by their
digests, so repeated rows are leaves of their own and which is which doesn't
matter. A single leaf is its own subroot, a single subroot the root, with an
empty proof. An empty table has no root and no proofs. Very long texts are
hashed in the JVM, one at a time. Columns that aren't named are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ranking import distributed_rank
from .common import scratch

ARITY = 3
#: Levels of a page: 3**6 = 729 children and 364 records, about 90 KB.
PAGE_LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<place: int, others: array<string>>>"
_PATH_ARROW = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.list_(pa.string()))]))


def leaf_digest(fields: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields, each ``-`` or ``bytes:value``."""
    parts = []
    for c in fields:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to: each step puts the digest at its place among the others."""
    def step(h: Column, s: Column) -> Column:
        before = F.array_join(F.slice(s["others"], F.lit(1), s["place"]), "")
        after = F.array_join(F.slice(s["others"], s["place"] + 1, F.size(s["others"])), "")
        return F.sha2(F.concat(before, h, after).cast("binary"), 256)

    return F.aggregate(proof, leaf, step)


def _hash(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def _nodes_at(n: int, level: int, levels: int) -> int:
    return -(-n // ARITY ** (levels * level))


def _page_levels(n: int, levels: int) -> int:
    """Levels of pages above ``n`` leaves."""
    count = 1
    while _nodes_at(n, count, levels) > 1:
        count += 1
    return count


def _top_level(levels: int) -> Column:
    """The level whose single page is the root of a group of ``n`` leaves."""
    steps = [F.when(F.col("n") > ARITY ** (levels * k), 1).otherwise(0) for k in range(1, 40)
             if ARITY ** (levels * k) < 2 ** 62]
    return sum(steps[1:], steps[0])


@dataclass(frozen=True)
class Manifest:
    """``placed``: the rows with ``g`` (number of the group), ``at`` (position), ``n`` (leaves of the group), ``leaf``;
    ``store``: pages by digest; ``subroots``: (g, n, digest); ``groups``, ``largest``: numbers; ``root``: a digest."""

    placed: DataFrame
    store: DataFrame
    subroots: DataFrame
    groups: int
    largest: int
    root: str | None
    levels: int


def _pages(nodes: DataFrame, level: int, levels: int) -> DataFrame:
    """(g, page, n, digest, parents, children) of the pages above ``nodes`` (g, at, n, digest) of one level."""
    size = ARITY ** levels
    grouped = (nodes.groupBy("g", F.expr(f"at div {size}").alias("page"))
               .agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("nodes"))
               .select("g", "page", "n", F.col("nodes.digest").alias("nodes")))

    def build(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                line, parents, children = r.pop("nodes"), [], []
                for _ in range(min(levels, height(_nodes_at(r["n"], level, levels)))):
                    runs = [line[i:i + ARITY] for i in range(0, len(line), ARITY)]
                    line = [_hash(run) for run in runs]
                    parents += line
                    children += runs
                out.append(r | {"digest": line[0], "parents": parents, "children": children})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("g", pa.int64()), ("page", pa.int64()), ("n", pa.int64()), ("digest", pa.string()),
                ("parents", pa.list_(pa.string())), ("children", pa.list_(pa.list_(pa.string())))]))

    return grouped.mapInArrow(build, "g bigint, page bigint, n bigint, digest string, parents array<string>,"
                                     " children array<array<string>>")


def _forest(nodes: DataFrame, largest: int, levels: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """(pages of every level, roots (g, n, digest)) of the trees over ``nodes`` (g, at, n, digest)."""
    pages, roots = [], []
    for level in range(_page_levels(largest, levels)):
        made = scratch(_pages(nodes, level, levels), f"{label}-{level}")
        pages.append(made.select("digest", "parents", "children"))
        top = _top_level(levels) == level
        roots.append(made.where(top).select("g", "n", "digest"))
        nodes = made.where(~top).select("g", F.col("page").alias("at"), "n", "digest")
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return pages, found


def manifest(rows: DataFrame, group_col: str = "source", order_col: str = "doc_id", leaf_col: str = "leaf",
             levels: int = PAGE_LEVELS) -> Manifest:
    """The manifest of ``rows``, whose ``leaf_col`` holds their digests.

    Their other columns are carried along; ``g``, ``at`` and ``n`` are added, so none of them may have these names.
    """
    rows = scratch(rows, "merkle-leaves")
    sizes = scratch(rows.groupBy(F.col(group_col).alias("_g")).agg(F.count(F.lit(1)).alias("n")), "merkle-sizes")
    groups = scratch(distributed_rank(sizes, [("_g", False)], method="row_number", out="_at")
                     .select("_g", "n", (F.col("_at") - 1).alias("g")), "merkle-groups")
    whole = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    ranked = distributed_rank(rows, [(order_col, False), (leaf_col, False)], group=[group_col], method="row_number",
                              out="_at")
    placed = scratch(ranked.join(groups, F.col(group_col).eqNullSafe(F.col("_g")))
                     .select(*rows.columns, "g", (F.col("_at") - 1).alias("at"), "n"), "merkle-placed")
    pages, subroots = _forest(placed.select("g", "at", "n", F.col(leaf_col).alias("digest")), whole[1], levels,
                              "merkle-pages")
    over = subroots.select(F.lit(0).cast("bigint").alias("g"), F.col("g").alias("at"),
                           F.lit(whole[0]).cast("bigint").alias("n"), "digest")
    top, root = _forest(over, whole[0], levels, "merkle-top")
    store = pages[0]
    for more in pages[1:] + top:
        store = store.unionByName(more)
    store = scratch(store.where("size(parents) > 0").dropDuplicates(["digest"]), "merkle-store")
    first = root.first()
    return Manifest(placed, store, subroots, whole[0], whole[1], first and first["digest"], levels)


def walk(records: dict[str, list[str]], top: str, depth: int, slot: int) -> tuple[str, list[dict]]:
    """Follow the digits of ``slot`` down ``depth`` records: (digest reached, segments from the top)."""
    at, path = top, []
    for power in range(depth - 1, -1, -1):
        place = slot // ARITY ** power % ARITY
        children = records[at]
        path.append({"place": place, "others": children[:place] + children[place + 1:]})
        at = children[place]
    return at, path


def _descend(m: Manifest, starts: DataFrame, wanted: DataFrame, largest: int, label: str) -> DataFrame:
    """(g, at, n, digest, path, carry) of the ``wanted`` leaves (g, at, carry: a struct), path from the root down.

    ``starts`` has (g, n, digest, path) of the trees' roots.
    """
    size, levels = ARITY ** m.levels, m.levels
    slot, page = F.expr(f"cast(at % {size} as int)").alias("slot"), F.expr(f"at div {size}").alias("page")
    requests = [wanted.select("g", page, F.struct(slot, "carry").alias("w")).groupBy("g", "page")
                .agg(F.collect_list("w").alias("wanted"))]
    for _ in range(1, _page_levels(largest, levels)):
        above = requests[-1].select("g", F.col("page").alias("at"))
        requests.append(above.select("g", page, F.struct(slot, F.lit(None).cast("string").alias("carry")).alias("w"))
                        .groupBy("g", "page").agg(F.collect_list("w").alias("wanted")))
    found = None
    for level in reversed(range(len(requests))):
        here = starts.where(_top_level(levels) == level).withColumn("page", F.lit(0).cast("bigint"))
        if found is not None:
            here = here.unionByName(found.drop("carry").withColumnRenamed("at", "page"))
        rows = here.join(requests[level], ["g", "page"]).join(m.store, "digest", "left") \
            .select("g", "page", "n", "digest", "path", "wanted", "parents", "children")

        def step(batches, level=level):
            for batch in batches:
                carry = batch.schema.field("wanted").type.value_type.field("carry").type
                kind = pa.schema([("g", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("digest", pa.string()),
                                  ("path", _PATH_ARROW), ("carry", carry)])
                for i in range(batch.num_rows):
                    r = batch.slice(i, 1).to_pylist()[0]
                    records = dict(zip(r["parents"] or (), r["children"] or ()))
                    depth = min(levels, height(_nodes_at(r["n"], level, levels)))
                    out = []
                    for w in r["wanted"]:
                        digest, path = walk(records, r["digest"], depth, w["slot"])
                        out.append({"g": r["g"], "at": r["page"] * size + w["slot"], "n": r["n"], "digest": digest,
                                    "path": r["path"] + path, "carry": w["carry"]})
                    yield pa.RecordBatch.from_pylist(out, kind)

        carry = rows.schema["wanted"].dataType.elementType["carry"].dataType.simpleString()
        found = rows.mapInArrow(step, f"g bigint, at bigint, n bigint, digest string, path {_PATH}, carry {carry}")
        if level:
            found = scratch(found, f"{label}-{level}")
    return found


def proofs(m: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The columns of ``requests`` (rows of ``m.placed``, by default all), ``subroot``, ``root`` and ``proof``.

    ``proof`` goes from the leaf to the root: at each level the node's place in
    its run and the digests of the run's others, left to right.
    """
    requests = m.placed if requests is None else requests
    spark = requests.sparkSession
    start = spark.range(1 if m.root else 0).select(
        F.lit(0).cast("bigint").alias("g"), F.lit(m.groups).cast("bigint").alias("n"), F.lit(m.root).cast("string").alias("digest"),
        F.expr(f"cast(array() as {_PATH})").alias("path"))
    trees = requests.select(F.lit(0).cast("bigint").alias("g"), F.col("g").alias("at")).distinct() \
        .withColumn("carry", F.lit(None).cast("string"))
    tops = _descend(m, start, trees, m.groups, "merkle-down-top")
    starts = scratch(tops.select(F.col("at").alias("g"), "digest", "path"), "merkle-starts") \
        .join(m.subroots.select("g", "n"), "g").select("g", "n", "digest", "path")
    wanted = requests.select("g", "at", F.struct(*requests.columns).alias("carry"))
    found = _descend(m, starts, wanted, m.largest, "merkle-down")
    subroots = m.subroots.select("g", F.col("digest").alias("subroot"))
    return found.select("g", "path", "carry").join(subroots, "g").select(
        "carry.*", "subroot", F.lit(m.root).cast("string").alias("root"), F.reverse("path").alias("proof"))
