"""Keyed tables as versions of plain files, replaced in one step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import keyed

#: A batch of a stream: the stream's id and the batch's number.
Batch = tuple[str, int]


class VersionedTable:
    """A table below root: version-<n>/ holds the files, an empty file CURRENT-<n> makes a version hold.

    A version is written whole and then made current by creating that file; a writer that dies before
    leaves the old one current. The file of a version that a stream's batch made is CURRENT-<n>@<stream>@<batch>,
    so a batch that is repeated is known by its stream, whatever the table's number, and another stream, or
    the same one with a new checkpoint, is not taken for it. The version before the current one stays for
    its readers; older ones are removed. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.root))

    def _marks(self) -> list[tuple[int, str, int]]:
        """Version, stream and batch of each mark; without a stream '' and -1."""
        found = []
        for status in self._fs.listStatus(self._path(self.root)):
            name = status.getPath().getName()
            if name.startswith("CURRENT-"):
                number, _, rest = name[len("CURRENT-") :].partition("@")
                stream, _, batch = rest.rpartition("@")
                found.append((int(number), stream, int(batch) if batch else -1))
        return found

    def version(self) -> int:
        return max((n for n, _, _ in self._marks()), default=-1)

    def applied(self, stream: str) -> int:
        """The last batch of the stream that is in the table, -1 for none."""
        return max((b for _, s, b in self._marks() if s == stream), default=-1)

    def read(self) -> DataFrame:
        at = self.version()
        return self.spark.createDataFrame([], self.schema) if at < 0 else self.spark.read.schema(self.schema).parquet(f"{self.root}/version-{at}")

    def replace(self, df: DataFrame, batch: Batch | None = None) -> int:
        """Makes df the table. A batch that is in the table already leaves it as it is."""
        last = self.version()
        if batch is not None and batch[1] <= self.applied(batch[0]):
            return last
        number = last + 1
        df.write.mode("overwrite").parquet(f"{self.root}/version-{number}")
        mark = f"CURRENT-{number}" if batch is None else f"CURRENT-{number}@{batch[0]}@{batch[1]}"
        self._fs.create(self._path(f"{self.root}/{mark}"), True).close()
        self._forget(number)
        return number

    def _forget(self, current: int) -> None:
        """Removes versions before the last, and marks that no later mark of their stream needs."""
        for n, stream, batch in self._marks():
            if n < current - 1:
                self._fs.delete(self._path(f"{self.root}/version-{n}"), True)
                if not stream or batch < self.applied(stream):
                    self._fs.delete(self._path(f"{self.root}/CURRENT-{n}" + (f"@{stream}@{batch}" if stream else "")), False)

    def upsert(self, new: DataFrame, keys: Sequence[str], batch: Batch | None = None) -> int:
        return self.replace(keyed.upsert(self.read(), new, keys), batch)

    def insert_ignore(self, new: DataFrame, keys: Sequence[str], batch: Batch | None = None) -> int:
        return self.replace(keyed.insert_ignore(self.read(), new, keys), batch)

    def delete(self, gone: DataFrame, keys: Sequence[str], batch: Batch | None = None) -> int:
        return self.replace(self.read().join(gone.select(*keys), list(keys), "left_anti"), batch)
