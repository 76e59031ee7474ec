"""Stage a POS frame as a folder of JSON-lines feed files.

Rows are range-partitioned on ``batch_id`` so each file holds whole batches in
ascending order, and file modification times are set in name order, because
the file source hands files to micro-batches by modification time.

Files are gzipped: JSON lines repeat every field's name and take about ten times
the disk otherwise. One task reads a gzipped file, so a feed is staged as many
files and a micro-batch takes several.

A frame is computed once, into the shared folder, and dealt to files in slices of
its batches, one after the other: the disk holds the shuffle files of a slice, not
those of the whole feed, nor those of the joins it was made by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.materialise import Spool
from ..session import shuffles_cleaned

BATCH = "batch_id"
#: Parts of a feed that are shuffled one after the other; 1: the feed as a whole, without a copy of it.
SLICES = 4
#: The batch id in the name of a file of :func:`stage_batch_files`.
BATCH_FILE = r"^batch-([0-9]+)"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, folder: str, suffix: str | tuple[str, ...] = (".json", ".json.gz")) -> list[str]:
    jvm, p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [s.getPath().toString() for s in fs.listStatus(p)]
    return sorted(n for n in names if n.endswith(suffix))


def _suffix(file: str) -> str:
    return ".json.gz" if file.endswith(".gz") else ".json"


def _ranges(pos: DataFrame, slices: int) -> list[DataFrame]:
    """``pos`` in at most ``slices`` parts of about as many rows each, of ascending batch ids; null ids come first."""
    tops = sorted(set(pos.approxQuantile(BATCH, [(i + 1) / slices for i in range(slices)], 0.01)))
    batch, parts = F.col(BATCH), []
    for i in range(max(1, len(tops))):
        above = batch > tops[i - 1] if i else F.lit(True)
        upto = F.coalesce(batch <= tops[i], F.lit(True)) if i + 1 < len(tops) else F.lit(True)
        parts.append(pos.where(above & upto))
    return parts


def stage_pos_feed(spark: SparkSession, pos: DataFrame, folder: str, files: int = 6, start_ms: int = 1_600_000_000_000,
                   compression: str = "gzip", slices: int = SLICES, held: bool = False,
                   rows_a_file: int | None = None) -> list[str]:
    """Write ``pos`` as about ``files`` JSON-lines files of whole, ordered batches.

    Written to fresh folders and then moved into ``folder``, so a stream
    watching ``folder`` never sees a half-written file. ``held``: ``pos`` reads a
    copy of the rows that the caller keeps, so none is made here. ``rows_a_file``:
    more files where one of ``files`` would hold more rows.
    """
    tmp = folder.rstrip("/") + f"_write_{start_ms}"
    spool, slices = Spool(), min(slices, files)
    try:
        rows = pos if held or slices == 1 else spool(pos)
        parts = _ranges(rows, slices) if slices > 1 else [rows]
        if rows_a_file:
            files = max(files, -(-rows.count() // rows_a_file))
        for n, part in enumerate(parts):
            many = files * (n + 1) // len(parts) - files * n // len(parts)
            with shuffles_cleaned(spark):
                part.repartitionByRange(many, BATCH).sortWithinPartitions(BATCH).write.mode("overwrite") \
                    .json(f"{tmp}/{n:03d}", compression=compression)
    finally:
        spool.drop()
    jvm, dst, fs = _fs(spark, folder)
    fs.mkdirs(dst)
    moved = []
    for i, f in enumerate([f for n in range(len(parts)) for f in list_files(spark, f"{tmp}/{n:03d}")]):
        src = jvm.org.apache.hadoop.fs.Path(f)
        target = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/feed-{start_ms}-{i:05d}{_suffix(f)}")
        fs.rename(src, target)
        fs.setTimes(target, start_ms + i * 10_000, -1)
        moved.append(target.toString())
    return moved


def stage_in_parts(spark: SparkSession, pos: DataFrame, parts: Sequence[Column], folder: str, files: int = 6,
                   start_ms: int = 1_600_000_000_000, apart_ms: int = 100_000_000_000, **kw) -> list[str]:
    """Stage the rows that meet each condition of ``parts`` by themselves, in folders beside ``folder``; the folders.

    ``pos`` is computed once for all. :func:`hand_over` puts a part into the feed. Each part's files are newer
    than those of the one before it; ``kw`` as for :func:`stage_pos_feed`.
    """
    spool = Spool()
    try:
        rows = spool(pos)
        for n, part in enumerate(parts):
            stage_pos_feed(spark, rows.where(part).select(*pos.columns), f"{folder.rstrip('/')}_part_{n}", files,
                           start_ms + n * apart_ms, held=True, **kw)
    finally:
        spool.drop()
    return [f"{folder.rstrip('/')}_part_{n}" for n in range(len(parts))]


def hand_over(spark: SparkSession, staged: str, folder: str) -> list[str]:
    """Move the files of a staged part into the feed ``folder``; they keep their names and times."""
    jvm, dst, fs = _fs(spark, folder)
    fs.mkdirs(dst)
    moved = []
    for f in list_files(spark, staged):
        src = jvm.org.apache.hadoop.fs.Path(f)
        target = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{src.getName()}")
        fs.rename(src, target)
        moved.append(target.toString())
    return moved


def stage_batch_files(spark: SparkSession, pos: DataFrame, folder: str, start_ms: int = 1_600_000_000_000,
                      order=sorted, slices: int = SLICES) -> list[str]:
    """Write ``pos`` as one JSON-lines file a batch, ``batch-<id>.json.gz``, without the batch id in the rows.

    Modification times ascend in the ``order`` of the batch ids.
    """
    tmp = folder.rstrip("/") + f"_write_{start_ms}"
    spool = Spool()
    try:
        held = spool(pos)
        for n in range(slices):
            with shuffles_cleaned(spark):
                held.where(F.pmod(F.xxhash64(BATCH), F.lit(slices)) == n).repartition(BATCH) \
                    .write.mode("append" if n else "overwrite").partitionBy(BATCH).json(tmp, compression="gzip")
    finally:
        spool.drop()
    jvm, dst, fs = _fs(spark, folder)
    fs.mkdirs(dst)
    jvm_path = jvm.org.apache.hadoop.fs.Path
    names = {s.getPath().getName().split("=", 1)[1]: s.getPath().toString() for s in fs.listStatus(jvm_path(tmp))
             if s.isDirectory()}
    staged = []
    for i, batch in enumerate(order(names, key=lambda b: int(b) if b.isdigit() else -1)):
        for part, f in enumerate(list_files(spark, names[batch])):
            target = jvm_path(f"{folder.rstrip('/')}/batch-{batch}{f'-{part}' if part else ''}{_suffix(f)}")
            fs.rename(jvm_path(f), target)
            fs.setTimes(target, start_ms + i * 10_000, -1)
            staged.append(target.toString())
    return staged
