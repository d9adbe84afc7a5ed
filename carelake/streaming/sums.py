"""Sums that a stream maintains in a folder, exact over repeats and crashes.

Each micro-batch overwrites a folder of its own, so a repeated batch counts
once.  From time to time the finished batches are merged into one folder, named
after the last batch it covers.  A folder counts once its writer has finished it
(``_SUCCESS``), and readers take the latest merged folder and the batches after
it; so a crash between any two steps changes nothing that is read.

Sums may be signed: a row that is taken back adds what it had added before with
the opposite sign, in whatever batch and order it arrives.  A merge leaves out
keys all of whose sums have come to nothing.  ``cluster`` names a key that the
files are sorted by, so a read of a few of its values skips the other files' or
row groups' rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Finished batches that are merged at once.
BATCHES = 16


class Sums:
    """``keys`` and the columns to add up, below one folder."""

    def __init__(
        self, spark: SparkSession, target: str, schema: str, keys: list[str], *, cluster: str | None = None
    ) -> None:
        self.spark, self.target, self.schema, self.keys = spark, target.rstrip("/"), schema, keys
        self.cluster = cluster

    def _folders(self, kind: str) -> dict[int, str]:
        """Finished folders by batch id."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        path = hadoop.Path(f"{self.target}/{kind}=*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        parents = [str(f.getPath().getParent().toString()) for f in found]
        return {int(p.rsplit("=", 1)[1]): p for p in parents}

    def _parts(self, upto: int | None = None) -> tuple[int, list[str], list[str]]:
        merged = self._folders("upto")
        last = max(merged, default=-1)
        batches = {i: p for i, p in self._folders("batch").items() if i > last and (upto is None or i <= upto)}
        read = [merged[last]] if merged else []
        return max([last, *batches]), [*read, *batches.values()], list(batches.values())

    def store(self, sums: DataFrame, batch_id: int, *, merge: bool = True) -> None:
        """Keep a batch's sums, after merging earlier ones if there are many."""
        if merge:
            self.merge(least=BATCHES, before=batch_id)
        if self.cluster:
            sums = sums.sortWithinPartitions(self.cluster)
        sums.write.mode("overwrite").parquet(f"{self.target}/batch={batch_id}")

    def last(self) -> int:
        """The last finished batch; -1 if there is none."""
        return self._parts()[0]

    def read(self, where: Column | None = None, *, upto: int | None = None) -> DataFrame:
        """The sums over all stored batches, or those up to one; without any, an empty table."""
        return self._summed(self._parts(upto)[1], where)

    def since(self, batch_id: int, *, upto: int | None = None) -> DataFrame:
        """What the batches after ``batch_id`` have added; they must not be merged yet."""
        last, _, _ = self._parts(upto)
        folders = [p for i, p in self._folders("batch").items() if batch_id < i <= last]
        return self._summed(folders)

    def _summed(self, folders: list[str], where: Column | None = None) -> DataFrame:
        empty = self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*folders) if folders else empty
        if where is not None:
            rows = rows.where(where)
        added = [c for c in empty.columns if c not in self.keys]
        return rows.groupBy(*self.keys).agg(*(F.sum(c).alias(c) for c in added)).select(*empty.columns)

    def merge(self, least: int = 2, before: int | None = None, upto: int | None = None) -> None:
        """Merge finished batches, then remove what the merged folder covers.

        ``before`` is the batch in progress, which a repeat may still overwrite;
        batches after ``upto`` stay as they are.
        """
        last, read, batches = self._parts(upto)
        if len(batches) < least or (before is not None and last >= before):
            return
        merged = self._summed(read)
        added = [c for c in merged.columns if c not in self.keys]
        merged = merged.where(reduce(or_, (F.coalesce(F.col(c) != 0, F.lit(False)) for c in added)))
        if self.cluster:
            merged = merged.repartitionByRange(self.cluster).sortWithinPartitions(self.cluster)
        merged.write.mode("overwrite").parquet(f"{self.target}/upto={last}")
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for kind, keep in (("upto", last), ("batch", last + 1)):
            for i, folder in self._folders(kind).items():
                if i < keep:
                    path = hadoop.Path(folder)
                    path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
