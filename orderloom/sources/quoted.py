"""CSV whose quoted fields hold line breaks, read in parallel however large the file.

Whether a line begins inside a quoted field follows from the number of quotes
before it, doubled ones included, so it takes one number for each split of a
file: a first pass counts the quotes of every split, the driver adds them up in
order (one row a split, as many as the scan has), and a second pass knows where
it stands and puts lines together to records. A record that crosses splits
arrives as one fragment of each, and only these are gathered.

Quotes may only enclose fields, doubled inside them, as the published format
says: a quote inside an unquoted field is a wrong file.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.schemas import Table

_PIECES = "file string, chain long, block long, whole boolean, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in the order of the file, each with its split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text"))


def _inside(lines: DataFrame) -> dict[tuple[str, int], int]:
    """Of every split that begins within a record the split where that record begins."""
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))
    splits = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"), F.max(quotes % 2).alias("turns")).collect()
    found = {}
    for file, blocks in groupby(sorted(splits), key=lambda s: s.file):
        begun = None
        for _, block, odd, turns in blocks:
            if begun is not None:
                found[file, block] = begun
            if odd and begun is None or (begun is not None and turns and not odd):
                begun = block  # a record that begins here stays open
            elif begun is not None and turns:
                begun = None
    return found


def _records(begun: dict[tuple[str, int], int], header: list[str]):
    """Whole records, and the fragments of those that cross splits."""

    def of_split(file: str, block: int, lines: Iterator[str]) -> Iterator[tuple]:
        inside, held, first, chain = (file, block) in begun, [], True, begun.get((file, block), block)
        for line in lines:
            held.append(line)
            inside ^= line.count('"') % 2 == 1
            if inside:
                continue
            text, whole = "\n".join(held), not first or (file, block) not in begun
            if block == 0 and first:
                names = next(csv.reader([text.removesuffix("\r")]))
                if [n.lower() for n in names] != header:
                    raise ValueError(f"{file} has columns {names}, not {header}")
            elif not whole or text.strip():
                yield file, chain, block, whole, text
            held, first, chain = [], False, block
        if held:
            yield file, chain, block, False, "\n".join(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        found: list[tuple] = []
        for (file, block), mine in groupby(rows, key=lambda r: r[:2]):
            for piece in of_split(file, block, (line for _, _, line in mine)):
                found.append(piece)
                if len(found) == 5_000:
                    yield _batch(found)
                    found = []
        if found:
            yield _batch(found)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in _PIECES.split(", ")])


def read(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """A file with header, or a folder of such files."""
    lines = _lines(spark, path)
    begun = _inside(lines)
    pieces = lines.mapInArrow(_records(begun, [n.lower() for n in table.names]), _PIECES)
    texts = pieces.where("whole").select("text")
    if begun:
        parts = pieces.where(~F.col("whole")).groupBy("file", "chain").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"))
        texts = texts.unionByName(parts.select(F.array_join("parts.text", "\n").alias("text")))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    record = F.from_csv(F.regexp_replace("text", "\r$", ""), columns, {"escape": '"', "mode": "FAILFAST"})
    return texts.select(record.alias("record")).select("record.*")
