"""Stored tables: ORC with Snappy, one ``dt=...`` directory per data date.

Facts lie by month below their date. What loads remember of orders and customers
is bucketed by them: a load joins it bucket by bucket and never shuffles it.
"""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import uuid
from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import MONTH, Table


@dataclass(frozen=True)
class Store:
    """Tables under one shared folder. ``buckets``: parts of a table that is dealt by a column; a store keeps the number it began with."""

    spark: SparkSession
    root: str
    buckets: int = 16

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def _file(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._file(self.root).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _writer(self, rows: DataFrame):
        return rows.write.format("orc").option("compression", "snappy")

    def _swap(self, path: str, write: Callable[[str], None]) -> None:
        """Write beside ``path``, then take its place; what stood there stays until the new rows are complete.

        Readers see nothing at ``path`` between the two renames.
        """
        files, parent, mark = self._files(), path.rpartition("/")[0], uuid.uuid4().hex
        staged, old = f"{parent}/_staged-{mark}", f"{parent}/_old-{mark}"
        try:
            write(staged)
        except BaseException:
            files.delete(self._file(staged), True)
            raise
        if files.exists(self._file(path)):
            files.rename(self._file(path), self._file(old))
        files.rename(self._file(staged), self._file(path))
        files.delete(self._file(old), True)

    def has(self, table: Table) -> bool:
        return self._files().exists(self._file(self.path(table)))

    def overwrite(self, table: Table, rows: DataFrame, dt: str) -> None:
        """Replace one day; other days stay, and a load that fails leaves the day as it was."""
        if table.by_month:
            write = self._writer(self._monthly(table, rows)).partitionBy("month").save
        elif table.bucketed_by:
            write = self._bucketed(table, rows)
        else:
            write = self._writer(table.conform(rows)).save
        self._swap(f"{self.path(table)}/dt={dt}", write)

    def _bucketed(self, table: Table, rows: DataFrame) -> Callable[[str], None]:
        """As many tasks as buckets, dealt alike: each writes the one file of its bucket."""
        by = table.bucketed_by
        dealt = self._writer(table.conform(rows).repartition(self.buckets, by)).bucketBy(self.buckets, by).sortBy(by)

        def write(path: str) -> None:
            name = f"staged_{uuid.uuid4().hex}"  # buckets are written by way of a table; dropping it leaves its files
            dealt.option("path", path).saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")

        return write

    def append(self, table: Table, rows: DataFrame, dt: str) -> None:
        """Add to one day; running it twice adds the rows twice."""
        day = f"{self.path(table)}/dt={dt}"
        if table.by_month:
            self._writer(self._monthly(table, rows)).mode("append").partitionBy("month").save(day)
        else:
            self._writer(table.conform(rows)).mode("append").save(day)

    def replace(self, table: Table, rows: DataFrame) -> None:
        """Replace a table that has no days; a write that fails leaves the old rows."""
        self._swap(self.path(table), lambda path: self._writer(table.conform(rows)).save(path))

    def _monthly(self, table: Table, rows: DataFrame) -> DataFrame:
        return table.conform(rows).withColumn("month", F.substring("date_id", 1, 7))

    def _catalogued(self, table: Table) -> str:
        """The session's name of a bucketed table. Only its catalog knows buckets, so the folder is entered there."""
        name = f"{table.name}_{hashlib.md5(self.root.encode()).hexdigest()[:12]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.stored.fields)
        by = table.bucketed_by
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING orc PARTITIONED BY (dt)"
            f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path(table)}'"
        )
        self.spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")  # days written since
        self.spark.catalog.refreshTable(name)
        return name

    def read(self, table: Table, dt: str | None = None, months: Collection[str] | None = None) -> DataFrame:
        """All days, or one; of a table by month only the months named, where they are.

        The declared schema keeps ``dt`` text, which a plain read would infer as a date.
        """
        if table.bucketed_by:
            rows = self.spark.table(self._catalogued(table)) if self.has(table) else self.spark.createDataFrame([], table.stored)
        else:
            schema = T.StructType([*table.stored.fields, MONTH]) if table.by_month else table.stored
            rows = self.spark.read.schema(schema).orc(self.path(table))
        if table.by_month:
            if months is not None:
                rows = rows.where(F.col("month").isin(*months))
            rows = rows.drop("month")
        return rows if dt is None else rows.where(F.col("dt") == dt)

    def remove(self) -> None:
        """Delete the whole store."""
        with contextlib.suppress(Exception):  # at exit the session may be gone
            self._files().delete(self._file(self.root), True)

    def register(self, *tables: Table) -> None:
        """Make tables known to SQL under their names."""
        for table in tables:
            self.read(table).createOrReplaceTempView(table.name)


def scratch_store(spark: SparkSession) -> Store:
    """A new, empty store in the shared folder the cluster names, or in the warehouse where it names none.

    A warehouse on the driver's own disk serves a local session only. The store is removed when the process ends; results may read from it until then.
    """
    named, shared = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.sql.warehouse.dir")
    if not named and shared.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    shared = named or shared
    store = Store(spark, f"{shared.rstrip('/')}/orderloom-{uuid.uuid4().hex}")
    atexit.register(store.remove)
    return store
