"""Scratch tables in the shared folder, and small helpers the operators share."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of a text are runs of anything but these six bytes, which is what bytes.split() takes too.
WORD = r"[^\x20\x09-\x0D]+"


class Scratch:
    """A new folder for tables that cut lineage; every executor sees it.

    It lies in the folder named by ``spark.checkpoint.dir``, or in the warehouse
    where that is unset; a warehouse on the driver's own disk serves a local
    session only. A result may still read from it, so it stays until the process
    ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        named, root = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.sql.warehouse.dir")
        if not named and root.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        root = named or root
        self.path = f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"
        atexit.register(self._remove_at_exit)

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        """Write ``rows`` and read them back."""
        path = f"{self.path}/{name}"
        rows.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def remove(self, name: str = "") -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

    def _remove_at_exit(self) -> None:
        with contextlib.suppress(Exception):  # the session may be gone by now
            self.remove()


def free(name: str, columns: list[str]) -> str:
    """``name``, or where a column bears it the name with as many underscores after it as make it free."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def text_of(column: str) -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def offsets_by_part(totals: DataFrame) -> dict[int, int]:
    """Sum of all parts before each part, from one row (part, total) per part.

    There is one part per task that wrote them, so the driver holds as many numbers as it scheduled tasks.
    """
    before, out = 0, {}
    for part, total in sorted(map(tuple, totals.collect())):
        out[part] = before
        before += total
    return out
