"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffles_cleaned, work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: later steps read files every executor sees, whichever
    executors are lost. The folder goes when the application ends, the shuffle
    files behind it as soon as it is written.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    with shuffles_cleaned(spark):
        df.write.parquet(path)
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def is_held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that no model may learn from."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % 5) == 0


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label 0.0 or 1.0) of at most ``rows`` labelled documents that aren't held out.

    The labelled ids with the smallest hashes, so the choice doesn't depend on
    the order of the rows. Labels of one id are averaged and rounded; null ids
    and labels don't count. Of texts that share an id the smallest counts, so
    there is one row an id. The list of chosen ids is bounded by ``rows`` and is
    therefore broadcast; the texts stay distributed.
    """
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("double").alias("label"))
              .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~is_held_out(F.col("id")))
              .groupBy("id").agg(F.round(F.avg("label")).alias("label"))
              .withColumn("_h", F.xxhash64("id")).orderBy("_h", "id").limit(rows).select("id", "label"))
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    return found.groupBy("id", "label").agg(F.min("text").alias("text")).select("id", "text", "label")


def hex_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def min_label_components(nodes_edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of an undirected graph, as (node, component).

    ``nodes_edges`` has columns ``a`` and ``b`` of one orderable type. The
    component is the smallest node reachable. Nodes without an edge don't
    appear. Distributed union-find: every round gives both ends of an edge the
    smaller of their labels (``min`` with a map-side partial step), then each
    label is replaced by the label of its label (pointer jumping), so the
    number of rounds grows with the logarithm of the longest chain. Edges and
    labels are read from files written in the shared folder, so every join is
    one AQE can split where a hub or a label holds most of the rows, and no
    group of nodes is ever gathered in one place. Null ends are ignored.
    """
    edges = nodes_edges.where("a is not null and b is not null and a <> b").select("a", "b").distinct()
    edges = scratch(edges, f"{label}-edges")
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    labels = scratch(ends.groupBy("node").agg(F.min("other").alias("m"))
                     .select("node", F.least("node", "m").alias("component")), f"{label}-labels")
    while True:
        la = labels.select(F.col("node").alias("a"), F.col("component").alias("la"))
        lb = labels.select(F.col("node").alias("b"), F.col("component").alias("lb"))
        low = edges.join(la, "a").join(lb, "b").where("la <> lb").withColumn("m", F.least("la", "lb"))
        # the old roots learn of the smaller label too, so whole trees move at once
        offers = low.select(F.explode(F.array("a", "b", "la", "lb")).alias("node"), "m") \
            .groupBy("node").agg(F.min("m").alias("m"))
        offers = scratch(offers, f"{label}-offers")
        if offers.isEmpty():
            return labels
        hooked = scratch(labels.join(offers, "node", "left")
                         .select("node", F.least("component", F.coalesce("m", "component")).alias("component")),
                         f"{label}-hooked")
        roots = hooked.select(F.col("node").alias("component"), F.col("component").alias("up"))
        labels = scratch(hooked.join(roots, "component", "left")
                         .select("node", F.least("component", F.coalesce("up", "component")).alias("component")),
                         f"{label}-labels")


def joined_components(labels: DataFrame, more: DataFrame, label: str = "components") -> DataFrame:
    """``labels`` (node, component) after further edges ``more`` (a, b), solved on the graph of components."""
    ends = more.select("a", "b")
    for side in ("a", "b"):
        known = labels.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
        ends = ends.join(known, side, "left")
    ends = ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    up = min_label_components(ends, label)
    moved = labels.join(up.select(F.col("node").alias("component"), F.col("component").alias("_up")), "component", "left") \
        .select("node", F.coalesce("_up", "component").alias("component"))
    return scratch(moved.unionByName(up.join(labels, "node", "left_anti")), f"{label}-joined")


def bit_filter(ids: DataFrame, column: str, bits: int = 26) -> DataFrame:
    """A one-hash Bloom filter of ``ids[column]`` (bigint) as rows (slot, bitmap).

    At most ``2**bits / 32768`` rows of 4 KB (8 MB at the default), whatever
    the number of ids, so it may be broadcast. Only a pre-filter: with many
    more ids than bits it lets everything through, and the exact join that
    follows does all the work.
    """
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1)).alias("at")
    return (ids.select(at).distinct()
            .select(F.bitmap_bucket_number("at").alias("slot"), F.bitmap_bit_position("at").alias("bit"))
            .repartition("slot").groupBy("slot").agg(F.bitmap_construct_agg("bit").alias("bitmap")))


def maybe_in(rows: DataFrame, column: str, bitmaps: DataFrame, bits: int = 26) -> DataFrame:
    """Rows whose ``column`` may be among the ids of :func:`bit_filter`."""
    keep = rows.columns
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    return (rows.withColumn("_slot", F.bitmap_bucket_number(at)).withColumn("_bit", F.bitmap_bit_position(at))
            .join(F.broadcast(bitmaps.withColumnRenamed("slot", "_slot")), "_slot")
            .where("shiftright(cast(conv(hex(substring(bitmap, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int),"
                   " cast(_bit % 8 as int)) & 1 = 1")
            .select(*keep))


def surely_not_in(rows: DataFrame, column: str, bitmaps: DataFrame, bits: int = 26) -> DataFrame:
    """The other rows: those whose ``column`` isn't among the ids of :func:`bit_filter`, or is null."""
    keep = rows.columns
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    return (rows.withColumn("_slot", F.bitmap_bucket_number(at)).withColumn("_bit", F.bitmap_bit_position(at))
            .join(F.broadcast(bitmaps.withColumnRenamed("slot", "_slot")), "_slot", "left")
            .where("bitmap is null or _bit is null or"
                   " shiftright(cast(conv(hex(substring(bitmap, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int),"
                   " cast(_bit % 8 as int)) & 1 = 0")
            .select(*keep))
