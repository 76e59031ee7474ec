"""Compute a frame once, into the shared folder, where several branches of a plan read it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from ..session import shuffles_cleaned, work_dir
from ..sinks.log import hadoop_path


def _written(df: DataFrame, label: str) -> tuple[str, DataFrame]:
    """(folder, ``df`` read back from it); the shuffle files behind it are gone."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    with shuffles_cleaned(spark):
        df.write.parquet(path, compression="zstd")
    p, fs = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    return path, spark.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under the session's shared checkpoint folder and read back; the folder goes with the application.

    The files outlive any executor, and a plan that branches from them scans
    small columnar files instead of computing ``df`` again for each branch.
    """
    return _written(df, label)[1]


class Spool:
    """A function that writes frames to the shared folder and reads them back, until :meth:`drop`.

    Unlike a persisted frame, one that was written holds neither memory nor the shuffle files it was made from.
    """

    def __init__(self):
        self._held: list[tuple[str, DataFrame]] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        self._held.append(_written(df, "spool"))
        return self._held[-1][1]

    def drop(self) -> None:
        while self._held:
            path, df = self._held.pop()
            p, fs = hadoop_path(df.sparkSession, path)
            fs.delete(p, True)
            fs.cancelDeleteOnExit(p)


@contextmanager
def spooling() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A :class:`Spool` until the end of the block."""
    spool = Spool()
    try:
        yield spool
    finally:
        spool.drop()
