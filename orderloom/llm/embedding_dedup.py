"""Near-duplicate vectors: int8 tile products with rigorous error bounds.

Equal vectors fold into one class first. Each class vector x, scaled to length
1, is held as int8 codes with one scale, and the length e of what the codes
miss. For two of them |cos - codes' cos| <= e_x |y^| + e_y, so a tile of
integer products decides most pairs; only pairs whose bounds lie on both sides
of the limit are recomputed, in double precision. The integers are multiplied
as float32, which is exact for up to 1,040 components at a time.

Tiles are made within cells around pivots. A vector belongs to the cell of its
nearest pivot and also visits each lower-numbered cell that may hold a partner:
one to which its distance from the plane between both pivots is at most the
distance that vectors at the limit have. No pair is lost, and each is tried
once. Vectors in clusters visit few cells; where all vectors are spread evenly
in many dimensions no exact cell scheme prunes much, and the tiles of all cells
together come to all pairs. A cell is cut into blocks of ``BLOCK`` vectors, so a
group never holds more than two blocks, however full its cell.

A tile passes on sums of links per class and a spanning forest, not pairs.

Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing. Vectors of different lengths do not link. Each row counts by
itself, also rows that share an id. An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Scratch
from orderloom.llm.components import components, forest

BLOCK = 4096
STRIP = 256
#: Vectors the pivots are chosen from, and vectors a cell is meant to have.
SAMPLE, CELL = 2_000, 8_192
MOST_PIVOTS = 256
#: More than what rounding can add to any of the bounds.
SLACK = 1e-9
EXACT = 1_040


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale and length of the error of vectors of length 1."""
    scale = np.abs(units).max(axis=1) / 127
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    missed = units - codes * scale[:, None]
    return codes, scale, np.sqrt((missed * missed).sum(axis=1))


def pivots(units: np.ndarray, n: int) -> np.ndarray:
    """Means of ``n`` groups of the sample, by a few rounds of reassignment from far-apart starts."""
    chosen = [0]
    far = 1 - units @ units[0]
    while len(chosen) < min(n, len(units)) and far.max() > SLACK:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, 1 - units @ units[chosen[-1]])
    centres = units[chosen]
    for _ in range(5):
        near = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, units)
        sizes = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(sizes > SLACK, sums / np.maximum(sizes, SLACK), centres)
    return np.unique(centres, axis=0)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(-1, dim)


def _cells(centres: dict[int, np.ndarray], reach: float):
    schema = "cls long, n long, dim int, cell int, home boolean, vector binary, codes binary, scale double, err double"
    names = [x.split()[0] for x in schema.split(", ")]

    def of_dim(rows: pa.RecordBatch, dim: int) -> pa.RecordBatch:
        raw = _vectors(rows.column("v"), dim)
        units = unit(raw)
        codes, scale, err = quantise(units)
        at = centres.get(dim, np.zeros((1, dim)))
        apart = ((units[:, None, :] - at[None]) ** 2).sum(axis=2) if len(at) * units.size < 1 << 24 else np.stack([((units - c) ** 2).sum(axis=1) for c in at], axis=1)
        home = apart.argmin(axis=1)
        between = np.sqrt(((at[home][:, None, :] - at[None]) ** 2).sum(axis=2)) if len(at) * units.size < 1 << 24 else np.stack([np.sqrt(((at[home] - c) ** 2).sum(axis=1)) for c in at], axis=1)
        least = apart[np.arange(len(units)), home][:, None]
        visits = (apart - least <= 2 * between * (reach + SLACK) + SLACK) & (np.arange(len(at)) <= home[:, None])
        row, cell = np.nonzero(visits)
        pick = pa.array(row)
        binary = lambda x: pa.array([v.tobytes() for v in x], pa.binary()).take(pick)
        return pa.RecordBatch.from_arrays(
            [rows.column("cls").take(pick), rows.column("n").take(pick), pa.array(np.full(len(row), dim, np.int32)), pa.array(cell.astype(np.int32)), pa.array(cell == home[row]),
             binary(raw), binary(codes), pa.array(scale[row]), pa.array(err[row])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2_000):
                some = batch.slice(a, 2_000)
                dims = some.column("v").value_lengths().to_numpy()
                for dim in np.unique(dims).tolist():
                    yield of_dim(some.filter(pa.array(dims == dim)), dim)

    return run, schema


class _Side:
    def __init__(self, table: pa.Table):
        binary = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind).reshape(table.num_rows, -1)
        self.cls, self.n, self.scale, self.err = (table.column(c).to_numpy() for c in ("cls", "n", "scale", "err"))
        self.raw = binary("vector", np.float64) if table.num_rows else np.empty((0, 1))
        self.raw = self.raw / np.abs(self.raw).max(axis=1, keepdims=True) if table.num_rows else self.raw
        self.length = np.sqrt((self.raw * self.raw).sum(axis=1))
        self.codes = binary("codes", np.int8).astype(np.float32) if table.num_rows else np.empty((0, 1), np.float32)
        self.held = self.scale * np.sqrt((self.codes.astype(np.float64) ** 2).sum(axis=1))


def linked(x: _Side, y: _Side, limit: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (place in x, place in y), strip by strip; of one side with itself each pair once."""
    worst = float(x.err.max() * y.held.max() + y.err.max()) + 1e-4  # also more than float32 rounds
    for a in range(0, len(x.cls), STRIP):
        strip = slice(a, a + STRIP)
        products = np.zeros((len(x.cls[strip]), len(y.cls)), np.float32)
        exact = products.astype(np.float64) if x.codes.shape[1] > EXACT else products
        for c in range(0, x.codes.shape[1], EXACT):
            exact += x.codes[strip, c : c + EXACT] @ y.codes[:, c : c + EXACT].T
        rough = exact * np.outer(x.scale[strip], y.scale).astype(np.float32)
        i, j = np.nonzero(rough >= limit - worst)
        if same:
            later = j > i + a
            i, j = i[later], j[later]
        cosine = exact[i, j].astype(np.float64) * x.scale[i + a] * y.scale[j]
        i = i + a
        bound = x.err[i] * y.held[j] + y.err[j] + SLACK
        sure, maybe = cosine - bound >= limit, np.flatnonzero((cosine - bound < limit) & (cosine + bound >= limit))
        for k in range(0, len(maybe), 20_000):
            m = maybe[k : k + 20_000]
            full = np.einsum("ij,ij->i", x.raw[i[m]], y.raw[j[m]]) / (x.length[i[m]] * y.length[j[m]])
            sure[m] = full >= limit
        yield i[sure], j[sure]


def _tile(limit: float):
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        x, y = (_Side(table.filter(pa.array(side == s))) for s in (0, 1))
        same = table.column("j")[0].as_py() == table.column("i")[0].as_py() and table.column("what")[0].as_py() == "home"
        cls = x.cls if same else np.concatenate([x.cls, y.cls])
        links, label, shift = np.zeros(len(cls), np.int64), np.arange(len(cls)), 0 if same else len(x.cls)
        if len(x.cls) and (same or len(y.cls)):
            other = x if same else y
            for i, j in linked(x, other, limit, same):
                links += np.bincount(i, other.n[j], len(cls)).astype(np.int64) + np.bincount(j + shift, x.n[i], len(cls)).astype(np.int64)
                if len(i):
                    nodes = np.arange(len(cls))
                    label = forest(len(cls), np.concatenate([nodes, i]), np.concatenate([label, j + shift]))
        child, has = np.flatnonzero(label != np.arange(len(cls))), np.flatnonzero(links)
        return pa.table({"a": np.concatenate([cls[child], cls[has]]), "b": pa.array([*cls[label[child]].tolist(), *[None] * len(has)], pa.int64()), "n": np.concatenate([np.zeros(len(child), np.int64), links[has]])})

    return run


def _places(cells: DataFrame) -> DataFrame:
    """Every vector under each pair of blocks it takes part in: home with home, or home with visitors."""
    sizes = {(r.dim, r.cell): (-(-r.homes // BLOCK), -(-r.visitors // BLOCK)) for r in cells.groupBy("dim", "cell").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visitors")).collect()}
    blocks = cells.sparkSession.createDataFrame([(*k, *v) for k, v in sizes.items()], "dim int, cell int, homes int, visitors int")
    rows = cells.join(F.broadcast(blocks), ["dim", "cell"])
    own = F.pmod(F.xxhash64("cls"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("visitors")).cast("long")).cast("int")
    rows = rows.withColumn("own", own)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    at = lambda what, i, j, side: F.struct(F.lit(what).alias("what"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    mine = F.col("own")
    with_homes = F.transform(upto(F.col("homes")), lambda k: at("home", F.least(mine, k), F.greatest(mine, k), mine > k))
    with_visitors = F.transform(upto(F.col("visitors")), lambda k: at("visit", mine, k, F.lit(0)))
    to_homes = F.transform(upto(F.col("homes")), lambda k: at("visit", k, mine, F.lit(1)))
    places = F.when(F.col("home"), F.concat(with_homes, with_visitors)).otherwise(to_homes)
    kept = ["cls", "n", "dim", "cell", "vector", "codes", "scale", "err"]
    return rows.select(*kept, F.explode(places).alias("at")).select(*kept, "at.*")


def near_duplicates(vectors: DataFrame, limit: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, n_links and component_id of every row."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    v = F.col("v")
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).withColumn("sound", F.coalesce(sound, F.lit(False)))
    classes = rows.where("sound").groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    classes = scratch.keep(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")

    total = classes.count()
    sample: dict[int, list] = {}
    for r in classes.orderBy(F.xxhash64("v")).limit(SAMPLE).select("v").collect():
        sample.setdefault(len(r.v), []).append(r.v)
    wanted = min(MOST_PIVOTS, max(1, total // CELL))
    centres = {dim: pivots(unit(np.array(vs, np.float64)), wanted) for dim, vs in sample.items()}
    reach = float(np.sqrt(max(0.0, 2 - 2 * limit)))
    run, schema = _cells(centres, reach)
    cells = scratch.keep(classes.select("cls", "n", "v").mapInArrow(run, schema), "cells")
    tiles = _places(cells).groupBy("dim", "cell", "what", "i", "j").applyInArrow(_tile(limit), "a long, b long, n long")
    found = scratch.keep(tiles, "found")

    links = found.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"), scratch).select(F.col("node").alias("cls"), "component")
    named = classes.join(links, "cls", "left").join(roots, "cls", "left").select("v", "first", "n", "links", F.coalesce("component", "cls").alias("root"))
    named = scratch.keep(named, "named")
    named = named.join(named.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("v", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    single = rows.where(~F.col("sound")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return rows.where("sound").join(named, "v").select("id", F.col("n_links").cast("long"), "component_id").unionByName(single)
