"""Approximate nearest neighbours by inner product (operator 10).

Inverted file of coarse centroids; each vector's residual is product-quantised. Cells are fitted
and assigned in one dimension more, which holds what a vector's norm lacks to the largest: there,
the largest inner product is the smallest distance. A query searches the ``probes`` nearest cells.

Search is two passes over tiles of about ``TILE_ROWS`` rows, each a few cells or a part of one.
The first adds up asymmetric distance tables over the codes (16 bytes a vector; no vector is
moved) and tells for each query the scores at ranks 1, 2, 4, ... of the tile. Together they give
one threshold a query: the largest that at least ``RERANK`` rows of all its tiles reach, and so
fewer than twice as many, ties aside. The second pass reranks the rows that reach it exactly, in
double precision, next to where their vectors lie, and returns the best of each tile.

The index is fitted on a bounded sample (``FIT_ROWS`` vectors by hash of the id) but holds every
vector. ``probes`` is read from brute force inside that sample, so that the cells hold ``COVER`` of
the true neighbours, and is a parameter of ``Index``. Of equal vectors only the ``top + 1``
smallest ids can be in a result, as ties go to the smaller id, so only those are searched. A query
that finds too few neighbours in its cells searches all cells.

Defined results: vectors that are null, of another length than most of the sample, zero, or hold a null
or non-finite component take no part, neither as query nor as candidate; null ids likewise; rows
that repeat id and vector count once; of other rows with one id each takes part. With fewer
candidates than ``top`` all are returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataforge.llm.shared import Scratch, stored

FIT_ROWS = 20_000
PARTS, CODES = 16, 256
TILE_ROWS, TILE_QUERIES = 2048, 4096
#: At least so many of a query's rows, by codes, are reranked exactly; fewer than twice as many but for ties.
RERANK = 300
COVER = 0.96


@dataclass
class Index:
    """Coarse centroids (cells x (dim + 1), scaled by ``norm``) and codebooks (parts x codes x width); ``dim`` is 0 without vectors."""

    dim: int
    norm: float
    cells: np.ndarray
    books: np.ndarray
    probes: int

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors over the largest norm, with the dimension that makes them all of length one."""
        y = x / self.norm
        return np.column_stack([y, np.sqrt(np.maximum(0.0, 1 - (y**2).sum(1)))])

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Cell of each vector: that of the nearest centroid."""
        return (self.lifted(x) @ self.cells.T - 0.5 * (self.cells**2).sum(1)).argmax(1)

    def near(self, q: np.ndarray) -> np.ndarray:
        """How near each query is to each cell: the query over its norm, with 0 as further dimension."""
        return (q / np.sqrt((q**2).sum(1))[:, None]) @ self.cells[:, : self.dim].T - 0.5 * (self.cells**2).sum(1)

    def searched(self, q: np.ndarray) -> np.ndarray:
        """Which cells each query searches: queries x cells."""
        out = np.zeros((len(q), len(self.cells)), bool)
        probes = min(self.probes, len(self.cells))
        np.put_along_axis(out, np.argpartition(-self.near(q), probes - 1, axis=1)[:, :probes], True, axis=1)
        return out

    def centre(self, cell: np.ndarray) -> np.ndarray:
        return self.cells[cell, : self.dim] * self.norm

    def encode(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        r = self._split(x - self.centre(cell))
        out = np.empty((len(x), len(self.books)), np.uint8)
        for m, book in enumerate(self.books):
            out[:, m] = (r[m] @ book.T - 0.5 * (book**2).sum(1)).argmax(1)
        return out

    def _split(self, x: np.ndarray) -> list[np.ndarray]:
        width, parts = self.books.shape[2], len(self.books)
        padded = np.zeros((len(x), parts * width), x.dtype)
        padded[:, : x.shape[1]] = x
        return [padded[:, m * width : (m + 1) * width] for m in range(parts)]

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """Inner products of every code with each query's part: for each part, codes x queries."""
        return [(book @ part.T).astype(np.float32) for part, book in zip(self._split(q), self.books, strict=True)]


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    r = np.random.default_rng(seed)
    centres = x[r.choice(len(x), k, replace=False)].astype(np.float64)
    for _ in range(rounds):
        near = (x @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
        order = np.argsort(near, kind="stable")
        cut = np.searchsorted(near[order], np.arange(k))
        counts = np.diff(np.append(cut, len(x)))
        full = np.flatnonzero(counts)
        centres[full] = np.add.reduceat(x[order], cut[full], axis=0) / counts[full][:, None]
        empty = np.flatnonzero(counts == 0)
        if len(empty):
            centres[empty] = x[r.choice(len(x), len(empty))]
    return centres


def _probes_for(x: np.ndarray, index: Index, n: int, queries: int = 400, top: int = 20) -> int:
    """Cells to search so that ``COVER`` of the true neighbours lie in them, by brute force over the sample.

    The ``top`` nearest of all ``n`` vectors are about the first ``top * len(x) / n`` of the sample.
    """
    asked = np.random.default_rng(5).choice(len(x), min(queries, len(x)), replace=False)
    sims = x[asked] @ x.T
    sims[np.arange(len(asked)), asked] = -np.inf
    take = max(1, min(top, round(top * len(x) / max(n, 1)), len(x) - 1))
    best = np.argsort(-sims, axis=1)[:, :take]
    home = index.assign(x)
    place = np.argsort(np.argsort(-index.near(x[asked]), axis=1), axis=1)
    ranks = np.take_along_axis(place, home[best], axis=1)
    return max(min(8, len(index.cells)), int(np.quantile(ranks, COVER)) + 1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part, but for their length."""
    v = F.col(vector_col)
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))) & F.exists(v, lambda x: x != 0)
    return vectors.filter(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def fit(rows: DataFrame, n: int, fit_rows: int = FIT_ROWS, probes: int | None = None) -> Index:
    """Fits on at most ``fit_rows`` of the ``n`` usable rows; cells grow with the root of ``n``, within what the sample can fit."""
    got = rows.orderBy(F.xxhash64("id"), "id").limit(fit_rows).select("v").toArrow().column(0).combine_chunks()
    sizes = np.diff(got.offsets.to_numpy()) if len(got) else np.zeros(0, int)
    dim = int(np.bincount(sizes).argmax()) if len(sizes) else 0
    if not dim:
        return Index(0, 1.0, np.zeros((1, 1)), np.zeros((1, 1, 1)), 1)
    x = np.unique(_matrix(got.filter(pa.array(sizes == dim)), dim), axis=0)
    x = x[np.random.default_rng(3).permutation(len(x))]
    parts = min(PARTS, dim)
    index = Index(dim, float(np.sqrt((x**2).sum(1).max())), np.zeros((1, dim + 1)), np.zeros((parts, 1, -(-dim // parts))), 1)
    index.cells = _kmeans(index.lifted(x), int(max(1, min(n**0.5, len(x) / 20, 4096))), 12, 11)
    index.probes = probes or _probes_for(x, index, n)
    residual = index._split(x - index.centre(index.assign(x)))
    index.books = np.stack([_kmeans(p, min(CODES, len(x)), 8, 100 + m) for m, p in enumerate(residual)])
    return index


def _matrix(column, dim: int) -> np.ndarray:
    """Arrow lists of equal length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _indexed(rows: DataFrame, index: Index) -> DataFrame:
    """(cell, id, v, code)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), index.dim)
            cell = index.assign(x)
            code = index.encode(x, cell)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), batch.column(0), batch.column(1), pa.array([c.tobytes() for c in code], pa.binary())], names=["cell", "id", "v", "code"])

    kind = rows.schema["v"].dataType.simpleString()
    return rows.select("id", "v").mapInArrow(run, f"cell int, id long, v {kind}, code binary")


@dataclass
class Tiles:
    """Which tile group holds each cell, and into how many row tiles each group is cut."""

    group: np.ndarray
    cuts: list[int]


def _tiles(base: DataFrame, index: Index) -> Tiles:
    """Cells in the order of their centroids' first axis, filled into groups of about ``TILE_ROWS`` rows; a larger cell is cut."""
    held = np.zeros(len(index.cells), np.int64)
    for cell, n in base.groupBy("cell").count().collect():  # at most one row a cell
        held[cell] = n
    axis = np.linalg.svd(index.cells - index.cells.mean(0), full_matrices=False)[2][0]
    group, cuts, filled = np.full(len(held), -1), [], 0
    for c in np.argsort(index.cells @ axis, kind="stable").tolist():
        if not held[c]:
            continue
        if not cuts or filled + held[c] > TILE_ROWS:
            cuts.append(1)
            filled = 0
        group[c] = len(cuts) - 1
        filled += int(held[c])
        cuts[-1] = -(-filled // TILE_ROWS)
    return Tiles(group, cuts)


def _asked(queries: DataFrame, index: Index, tiles: Tiles) -> DataFrame:
    """The queries' rows once for each tile group that holds a cell they search, as (grp, ...)."""
    names = queries.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                wanted = np.zeros((part.num_rows, len(tiles.cuts) + 1), bool)
                row, cell = np.nonzero(index.searched(_matrix(part.column(names.index("v")), index.dim)))
                wanted[row, tiles.group[cell]] = True  # cells without rows: the last column
                row, group = np.nonzero(wanted[:, :-1])
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(group.astype(np.int32)), *(c.take(take) for c in part.columns)], names=["grp", *names])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema.fields)
    return queries.mapInArrow(run, f"grp int, {kinds}")


def _dealt(rows: DataFrame, asks: DataFrame, tiles: Tiles) -> tuple[DataFrame, DataFrame]:
    """Both sides with a tile: rows cut by a hash of the id, queries likewise, every pair of parts meeting once."""
    spark = rows.sparkSession
    counts = dict(asks.groupBy("grp").count().collect())  # at most one row a group
    cuts = [(g, k, -(-counts[g] // TILE_QUERIES)) for g, k in enumerate(tiles.cuts) if g in counts]
    sizes = F.broadcast(spark.createDataFrame(cuts, "grp int, row_tiles int, query_tiles int"))
    part = lambda by, n: F.pmod(F.xxhash64(by), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(sizes, "grp").withColumn("rt", part("id", "row_tiles")).withColumn("qt", each("query_tiles")).drop("row_tiles", "query_tiles")
    right = asks.join(sizes, "grp").withColumn("qt", part("id", "query_tiles")).withColumn("rt", each("row_tiles")).drop("row_tiles", "query_tiles")
    return left, right


def _scores(index: Index, cell: np.ndarray, code: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Approximate inner products, rows x queries, by distance tables; minus infinity in cells that a query does not search."""
    cells, of = np.unique(cell, return_inverse=True)
    out = np.where(index.searched(q)[:, cells], q @ index.centre(cells).T, -np.inf).astype(np.float32).T[of]
    for m, table in enumerate(index.tables(q)):
        out += table[code[:, m]]
    return out


def _codes(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, cells and codes of a tile's rows, by id."""
    ids = table.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
    return ids[order], table.column("cell").to_numpy()[order], code[order]


AT_ONCE = 128  # queries


def _thresholds(rows: DataFrame, asks: DataFrame, index: Index) -> DataFrame:
    """(query, least): the largest score by codes that at least ``RERANK`` rows of all tiles are known to reach, if so many are."""
    kind = "query long, score array<float>"

    def ranks(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, scores = [], []
        if left.num_rows and right.num_rows:
            _, cell, code = _codes(left)
            q_ids, q = right.column("id").to_numpy(), _matrix(right.column("v"), index.dim)
            most = min(len(cell), RERANK)
            at = [2**k - 1 for k in range(most.bit_length())]
            for a in range(0, len(q), AT_ONCE):
                near = -_scores(index, cell, code, q[a : a + AT_ONCE])
                top = np.sort(np.partition(near, at, axis=0)[at], axis=0)
                ids.append(q_ids[a : a + AT_ONCE])
                scores += [-top[:, k] for k in range(top.shape[1])]
        return pa.table([np.concatenate(ids) if ids else np.zeros(0, np.int64), pa.array([s[np.isfinite(s)] for s in scores], pa.list_(pa.float32()))], names=["query", "score"])

    told = rows.drop("v").groupBy("grp", "rt", "qt").cogroup(asks.groupBy("grp", "rt", "qt")).applyInArrow(ranks, kind)
    # of a tile, the score at rank 2^k stands for 2^k rows: 2^(k-1) more than the one before
    step = F.transform("score", lambda s, k: F.struct((-s).alias("s"), F.when(k == 0, F.lit(1)).otherwise(F.pow(F.lit(2), k - 1).cast("int")).alias("n")))
    all_of = told.select("query", step.alias("x")).groupBy("query").agg(F.sort_array(F.flatten(F.collect_list("x"))).alias("x"))
    begin = F.struct(F.lit(0).alias("n"), F.lit(float("inf")).cast("float").alias("s"))
    walk = F.aggregate("x", begin, lambda a, x: F.when(a["n"] >= RERANK, a).otherwise(F.struct((a["n"] + x["n"]).alias("n"), x["s"].alias("s"))))
    found = all_of.select("query", walk.alias("w"))
    return found.select("query", F.when(F.col("w.n") >= RERANK, -F.col("w.s")).otherwise(F.lit(float("-inf")).cast("float")).alias("least"))


FOUND = "query long, id long, score double"


def _reranked(rows: DataFrame, asks: DataFrame, index: Index, top: int) -> DataFrame:
    """The best ``top`` of every tile for each of its queries, by exact score over the rows that reach ``least``, ties to the smaller id."""
    out = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        ids, cell, code = _codes(left)
        x = _matrix(left.column("v"), index.dim)[np.argsort(left.column("id").to_numpy(), kind="stable")]
        q_ids, q, least = right.column("id").to_numpy(), _matrix(right.column("v"), index.dim), right.column("least").to_numpy()
        got = [[], [], []]
        for a in range(0, len(q), AT_ONCE):
            part, floor = q[a : a + AT_ONCE], least[a : a + AT_ONCE]
            near = _scores(index, cell, code, part)
            slack = 1e-4 * index.norm * np.sqrt((part**2).sum(1))  # sums of floats differ a little between passes
            reach = (near >= (floor - slack)[None, :]) & np.isfinite(near)
            for k in range(len(part)):
                pick = np.flatnonzero(reach[:, k])
                exact = (x[pick] * part[k]).sum(axis=1)
                first = np.lexsort((ids[pick], -exact))[:top]
                got[0].append(np.full(len(first), q_ids[a + k]))
                got[1].append(ids[pick][first])
                got[2].append(exact[first])
        return pa.table([np.concatenate(c) for c in got], schema=out)

    return rows.groupBy("grp", "rt", "qt").cogroup(asks.groupBy("grp", "rt", "qt")).applyInArrow(best, FOUND)


def _best(found: DataFrame, top: int) -> DataFrame:
    by = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top).select("query", "id", "score")


def _search(base: DataFrame, asks: DataFrame, index: Index, tiles: Tiles, top: int, scratch: Scratch) -> DataFrame:
    """(query, id, score): the best ``top`` of each query (id, v) among the cells that it searches."""
    groups = F.from_json(F.lit(str(tiles.group.tolist())), "array<int>")
    rows = base.withColumn("grp", F.get(groups, F.col("cell")))
    wide = scratch.stored(_asked(asks, index, tiles), "asks")
    left, right = _dealt(rows, wide, tiles)
    least = scratch.stored(_thresholds(left, right, index), "least")
    left, right = _dealt(rows, wide.join(least, wide["id"] == least["query"]).drop("query"), tiles)
    return scratch.stored(_best(_reranked(left, right, index, top), top), "found")


def neighbours(vectors: DataFrame, is_query: F.Column, top: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", fit_rows: int = FIT_ROWS, probes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest of each query row, itself left out. ``is_query`` is a condition on ``id``."""
    with Scratch(vectors.sparkSession) as scratch:
        rows = usable(vectors, id_col, vector_col)
        index = fit(rows, rows.count(), fit_rows, probes)
        rows = rows.filter(F.size("v") == index.dim)
        same = Window.partitionBy("v").orderBy("id")
        base = scratch.stored(_indexed(rows.dropDuplicates(["id", "v"]).withColumn("k", F.row_number().over(same)).filter(F.col("k") <= top + 1).drop("k"), index), "ivf")
        tiles = _tiles(base, index)
        asking = rows.filter(is_query)
        groups = asking.groupBy("v").agg(F.min("id").alias("lead"))
        # equal vectors ask once, under their smallest id; an id with several vectors asks once for each
        leads = scratch.stored(groups.select("v", F.xxhash64("lead", "v").alias("key")), "leads")
        asks = leads.select(F.col("key").alias("id"), "v")
        found = _search(base, asks, index, tiles, top + 1, scratch)
        enough = min(top + 1, base.count())
        short = scratch.stored(asks.join(found.groupBy(F.col("query").alias("id")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= enough).select("id"), "id", "left_anti"), "short")
        if not short.isEmpty():
            whole = Index(index.dim, index.norm, index.cells, index.books, len(index.cells))
            more = _search(base, short, whole, tiles, top + 1, scratch)
            found = found.join(short.select(F.col("id").alias("query")), "query", "left_anti").unionByName(more)
        members = asking.join(leads, "v").select(F.col("id").alias("query_id"), F.col("key").alias("query")).distinct()
        mine = members.join(found, "query").filter(F.col("id") != F.col("query_id"))
        by = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        best = mine.select("query_id", "id", "score").distinct().withColumn("rank", F.row_number().over(by).cast("int")).filter(F.col("rank") <= top)
        return stored(best.select("query_id", "rank", F.col("id").alias("vec_id"), "score"), "neighbours")
