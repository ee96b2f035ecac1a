"""Exact cosine range join of vectors with pivots.

Vectors are compared by angle, which is a metric. Each belongs to the cell of its nearest pivot. A vector also goes to every later cell
that could hold a partner: by the triangle inequality its angle to that cell's pivot is at most the cell's radius plus the
threshold angle, and it lies no further than that angle beyond the plane between both pivots. Cells are joined independently,
in blocks of bounded size on either side, each pair of blocks by one matrix product in double precision. The cosine is the double product of the two unit vectors.

A block gives each vector its number of links and a spanning forest of them, never the links themselves, so a dense cluster costs
rows, not pairs. Equal vectors are compared once, with their number.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of different lengths never link. A vector without an id links with nothing and is never kept.
Repeated rows count as separate vectors. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, components, map_batches

THRESHOLD = 0.95
#: Vectors of a cell's block, and foreign vectors that one task compares it with.
HOME_BLOCK, AWAY_BLOCK = 4096, 8192
#: There is a pivot for so many times the square root of the number of vectors, so that cells grow with the table as their number does.
ROOTS = 8
#: Angles between vectors and pivots that are held at a time.
ANGLES = 1 << 21
SLACK = 1e-9


@dataclass
class Cells:
    """Pivots of each length of vectors, the size and radius of their cells, and how many foreign vectors they get."""

    threshold: float
    pivots: dict[int, np.ndarray]
    first: dict[int, int]
    home: dict[int, int]
    radius: dict[int, float]
    away: dict[int, int]

    def own(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each unit vector, and the angles to all pivots of its length."""
        cos = np.clip(x @ self.pivots[x.shape[1]].T, -1, 1)
        return cos.argmax(1), np.arccos(cos)

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every later cell in which a vector may have a partner."""
        p = self.pivots[x.shape[1]]
        cell, angle = self.own(x)
        reach, base = math.acos(self.threshold), self.first[x.shape[1]]
        radius = np.array([self.radius.get(base + j, -10.0) for j in range(len(p))])
        cos = np.cos(angle)
        apart = np.sqrt(np.maximum(0, 2 - 2 * np.clip(p @ p.T, -1, 1)))
        ok = (angle <= radius + reach + SLACK) & (cos[np.arange(len(x)), cell][:, None] - cos <= math.sin(reach) * apart[cell] + SLACK)
        ok &= np.arange(len(p)) > cell[:, None]
        return np.nonzero(ok)


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)


def _units(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, unit) with unit as bytes of doubles; rows that cannot link are left out."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, units = [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) if v.is_valid and len(v.values) else np.zeros(0)
            if i is not None and len(x) and np.isfinite(x).all() and (most := np.abs(x).max()) > 0:
                x = x / most
                ids.append(i)
                units.append((x / np.linalg.norm(x)).tobytes())
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(units, pa.binary())], names=["id", "unit"])

    return map_batches(df.select(F.col(id_col).cast("long"), vector_col), run, "id long, unit binary")


def _by_length(batch: pa.RecordBatch, cells: Cells):
    """(length, rows, unit vectors) of a batch, as many rows at a time as their angles to all pivots allow."""
    units = batch.column("unit").to_pylist()
    lengths = np.array([len(u) // 8 for u in units])
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        step = max(1, ANGLES // len(cells.pivots[int(dim)]))
        for at in range(0, len(rows), step):
            yield int(dim), rows[at : at + step], _matrix([units[i] for i in rows[at : at + step]])


def _plan(vectors: DataFrame, threshold: float) -> Cells:
    counts = {r["dim"]: r["n"] for r in vectors.groupBy((F.octet_length("unit") / 8).cast("int").alias("dim")).agg(F.count("*").alias("n")).collect()}
    pivots, first, at = {}, {}, 0
    for dim, n in sorted(counts.items()):
        k = math.isqrt(n) // ROOTS + 1
        rows = vectors.where(F.octet_length("unit") == 8 * dim).orderBy(F.xxhash64("id"), "id").limit(k).collect()
        pivots[dim], first[dim] = _matrix([bytes(r["unit"]) for r in rows]), at
        at += len(rows)
    cells = Cells(threshold, pivots, first, {}, {}, {})

    def sizes(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: list[tuple[int, int, float]] = []
        for dim, _, x in _by_length(batch, cells):
            cell, angle = cells.own(x)
            own = angle[np.arange(len(x)), cell]
            found += [(cells.first[dim] + int(c), int((cell == c).sum()), float(own[cell == c].max())) for c in np.unique(cell)]
        c, n, r = map(list, zip(*found, strict=True))
        return pa.record_batch([pa.array(c, pa.int32()), pa.array(n, pa.int64()), pa.array(r, pa.float64())], names=["cell", "n", "radius"])

    for r in map_batches(vectors, sizes, "cell int, n long, radius double").groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect():
        cells.home[r["cell"]], cells.radius[r["cell"]] = r["n"], r["radius"]

    def visitors(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[int, int] = {}
        for dim, _, x in _by_length(batch, cells):
            for c, n in zip(*np.unique(cells.visits(x)[1], return_counts=True), strict=True):
                found[cells.first[dim] + int(c)] = found.get(cells.first[dim] + int(c), 0) + int(n)
        return pa.record_batch([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], names=["cell", "n"])

    for r in map_batches(vectors, visitors, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        cells.away[r["cell"]] = r["n"]
    return cells


def _dealt(vectors: DataFrame, cells: Cells) -> DataFrame:
    """(cell, block, against, foreign, id, n, unit): the copies of each vector for every pair of blocks that it is part of.

    against is the other block of the cell where negative (-1 - block), else the number of a chunk of foreign vectors."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("id").to_numpy()
        row, cell, block, against, foreign = [], [], [], [], []

        def put(i: int, c: int, b: int, a: int, f: bool) -> None:
            row.append(i), cell.append(c), block.append(b), against.append(a), foreign.append(f)

        for dim, rows, x in _by_length(batch, cells):
            base = cells.first[dim]
            spread = ((ids[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
            for i, c, h in zip(rows.tolist(), (cells.own(x)[0] + base).tolist(), spread.tolist(), strict=True):
                blocks, chunks = -(-cells.home[c] // HOME_BLOCK), -(-cells.away.get(c, 0) // AWAY_BLOCK)
                b = h % blocks
                for o in range(blocks):
                    put(i, c, min(b, o), -1 - max(b, o), False)
                for a in range(chunks):
                    put(i, c, b, a, False)
            for k, c in zip(*map(np.ndarray.tolist, cells.visits(x)), strict=True):
                c += base
                a = int(spread[k]) % -(-cells.away[c] // AWAY_BLOCK)
                for b in range(-(-cells.home[c] // HOME_BLOCK)):
                    put(int(rows[k]), c, b, a, True)
        take = pa.array(row, pa.int64())
        return pa.record_batch([pa.array(cell, pa.int32()), pa.array(block, pa.int32()), pa.array(against, pa.int32()), pa.array(foreign, pa.bool_()), *(batch.column(c).take(take) for c in ("id", "n", "unit"))], names=["cell", "block", "against", "foreign", "id", "n", "unit"])

    return map_batches(vectors, run, "cell int, block int, against int, foreign boolean, id long, n long, unit binary")


def _links_of(x: np.ndarray, y: np.ndarray, threshold: float, label: np.ndarray, at_x: np.ndarray, at_y: np.ndarray, weight: np.ndarray, links: np.ndarray, same: bool) -> None:
    """Adds the links between rows at_x and at_y of a block to the counts, and joins their labels."""
    for start in range(0, len(x), 512):
        near = x[start : start + 512] @ y.T >= threshold
        if same:
            near &= np.arange(len(y)) > np.arange(start, start + len(near))[:, None]
        links[at_x[start : start + 512]] += near @ weight[at_y]
        links[at_y] += weight[at_x[start : start + 512]] @ near
        for r in np.flatnonzero(near.any(1)):
            met = np.unique(np.append(label[at_y[near[r]]], label[at_x[start + r]]))
            if len(met) > 1:
                label[np.isin(label, met[1:])] = met[0]


def _joined(table: pa.Table, threshold: float) -> pa.Table:
    """(id, links, root) of the linked vectors of one pair of blocks."""
    ids, weight = table.column("id").to_numpy(), table.column("n").to_numpy().astype(np.float64)
    x, foreign = _matrix(table.column("unit").to_pylist()), np.array(table.column("foreign").to_pylist(), bool)
    block, against = table.column("block")[0].as_py(), table.column("against")[0].as_py()
    label, links = np.argsort(np.argsort(ids, kind="stable"), kind="stable"), np.zeros(len(ids))
    if against >= 0:
        a, b = np.flatnonzero(~foreign), np.flatnonzero(foreign)
    elif block == -1 - against:
        a = b = np.arange(len(ids))
    else:
        spread = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % table.column("blocks")[0].as_py()
        a, b = np.flatnonzero(spread == block), np.flatnonzero(spread != block)
    if len(a) and len(b):
        _links_of(x[a], x[b], threshold, label, a, b, weight, links, a is b)
    linked = np.flatnonzero(links > 0)
    order = np.sort(ids)
    return pa.table([pa.array(ids[linked]), pa.array(links[linked].round().astype(np.int64)), pa.array(order[label[linked]])], names=["id", "links", "root"])


def link(df: DataFrame, scratch: Scratch, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    units = scratch.cut(_units(df, id_col, vector_col).withColumns({"h": F.xxhash64("unit"), "g": F.xxhash64(F.lit(1), "unit")}))
    vectors = scratch.cut(units.groupBy("h", "g").agg(F.min(F.struct("id", "unit")).alias("least"), F.count("*").alias("n")).select("h", "g", "least.id", "n", "least.unit"))
    cells = _plan(vectors.select("id", "unit"), threshold)
    blocks = {c: -(-n // HOME_BLOCK) for c, n in cells.home.items()}

    def joined(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        return _joined(table.append_column("blocks", pa.array([blocks[cell]] * table.num_rows)), threshold)

    dealt = _dealt(vectors.select("id", "n", "unit"), cells)
    found = scratch.cut(dealt.groupBy("cell", "block", "against").applyInArrow(joined, "id long, links long, root long"))
    edges = found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    classes = components(edges, scratch).withColumnRenamed("node", "id")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    each = vectors.select("h", "g", "id", "n").join(counts, "id", "left").join(classes, "id", "left")
    each = scratch.cut(each.select("h", "g", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    linked = scratch.cut(units.select("id", "h", "g").join(each, ["h", "g"]).groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")))
    rows = df.select(F.col(id_col).cast("long").alias("id")).join(linked, "id", "left")
    component = F.coalesce("component_id", "id")
    return rows.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
