"""Exact top-k inner products by pivot tables.

Vectors become integers. Some vectors are pivots, and every vector gets its distances to all of them. A distance to a
pivot bounds the distance of two vectors from below (by the triangle inequality), the largest such bound over all
pivots is used, and as q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2, it bounds their inner product from above. Each query
evaluates candidates in the order of their bounds, in batches of doubling size, and stops for good when none that is
left can reach its k best.

Candidates lie in cells, those with the same nearest pivot, cut into blocks of bounded size. A query first meets the
blocks of its own cell, which gives a score to reach; then it is sent only to cells whose own bounds, from the ranges
of their distances, can still reach it. Queries travel in chunks, filled cell by cell, and a vector is copied only to
chunks that ask for its cell, in the smallest integers that hold the table. Chunks and blocks have a size in bytes.
Where no bound excludes anything, every chunk asks for every cell: all pairs are scored then, and copies are as many as
chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotledger.llm.common import stored

K = 20
SCALE = 64
EVERY = 20
PIVOTS = 32
SAMPLE_ROWS = 2048  # rows from which the pivots are chosen; no result depends on the choice
BLOCK_BYTES = 8 << 20  # of a block's vectors as doubles
QUERY_BYTES = 4 << 20
STEP = 256
_EXACT = float(1 << 53)
_ROUNDED = 2.0**-22  # distances are kept in single precision; more than both roundings of a difference
_VECTOR = "vec_id long, body binary, norm double, far binary, cell int"


def _integers(values: np.ndarray, scale: int) -> np.ndarray | None:
    """floor(scale * x); None for a vector that takes no part. Numbers that 64 bits cannot hold safely are refused."""
    x = np.asarray(values, np.float64)
    if not np.isfinite(x).all():
        return None
    whole = np.floor(x * scale)
    if len(whole) and np.abs(whole).max() >= 2.0**62:
        raise ValueError(f"a component times {scale} is beyond 62 bits")
    return whole.astype(np.int64)


def _as_bytes(scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bodies, tops = [], [], []
            for key, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if values.is_valid and values.values.null_count == 0 and key is not None:
                    body = _integers(values.values.to_numpy(), scale)
                    if body is not None:
                        ids.append(key)
                        bodies.append(body.tobytes())
                        tops.append(int(np.abs(body).max(initial=0)))
            columns = [pa.array(ids, pa.int64()), pa.array(bodies, pa.binary()), pa.array(tops, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "body", "top"])

    return run


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample that lie far from each other: each next one has the largest distance to those before it."""
    if not len(sample):
        return sample
    chosen, nearest = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        if nearest.max() <= 0:
            break
        chosen.append(int(nearest.argmax()))
    return sample[chosen]


def _matrix(bodies, width: int, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(b"".join(bodies), kind).reshape(-1, width)


def smallest_kind(top: int) -> type:
    """The smallest integers that hold all of -top to top."""
    return next(k for k in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(k).max)


def _measure(pivots: np.ndarray, kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the norm, the distances to all pivots and the nearest pivot; components become smaller integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = _matrix(batch.column(1).to_pylist(), pivots.shape[1])
            x = whole.astype(np.float64)
            far = np.sqrt(np.stack([((x - p) ** 2).sum(1) for p in pivots], 1)).astype(np.float32)
            columns = [
                batch.column(0),
                pa.array([row.tobytes() for row in whole.astype(kind)], pa.binary()),
                pa.array((x * x).sum(1)),
                pa.array([row.tobytes() for row in far], pa.binary()),
                pa.array(far.argmin(1).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "body", "norm", "far", "cell"])

    return run


def _distances(far: bytes) -> np.ndarray:
    return np.frombuffer(far, np.float32).astype(np.float64)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes, norms and the ranges of distances to each pivot, for each cell."""
    for batch in batches:
        if batch.num_rows:
            far = np.stack([_distances(b) for b in batch.column(3).to_pylist()])
            norm, cell = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            for c in np.unique(cell):
                own = cell == c
                rows = far.shape[1]
                columns = [
                    pa.array(np.full(rows, c, np.int32)),
                    pa.array(np.arange(rows, dtype=np.int32)),
                    pa.array(np.full(rows, own.sum())),
                    pa.array(np.full(rows, norm[own].max())),
                    pa.array(far[own].min(0)),
                    pa.array(far[own].max(0)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "pivot", "n", "norm", "low", "high"])


def _exact_scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where they hold every sum exactly, in Python integers, cut to a long, where not."""
    if len(rows) and float(np.abs(rows).max()) * float(np.abs(query).max(initial=0)) * rows.shape[1] < _EXACT:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    sums = rows.astype(object) @ query.astype(object)
    return np.array([max(-(1 << 63), min((1 << 63) - 1, int(v))) for v in sums], np.int64)


def _bound(query_norm: float, norms: np.ndarray, gaps: np.ndarray, farthest: np.ndarray) -> np.ndarray:
    """Upper bounds of inner products from differences of distances up to ``farthest``, with room for rounding."""
    scale = query_norm + norms
    gaps = np.maximum(0, gaps - _ROUNDED * farthest)
    return (scale - gaps * gaps) / 2 + 1e-9 * scale + 0.5


def exact_floats(top: int, width: int) -> type | None:
    """The smallest floating point numbers in which inner products of components up to ``top`` are exact."""
    return next((f for f, most in ((np.float32, 1 << 24), (np.float64, 1 << 53)) if top * top * width < most), None)


def _search(k: int, kind: type, floats: type | None) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        nothing = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
        if not len(queries) or not len(block):
            return nothing
        width = len(block["body"].iloc[0]) // np.dtype(kind).itemsize
        x, ids, norms = _matrix(block["body"], width, kind), block["vec_id"].to_numpy(), block["norm"].to_numpy()
        x = x.astype(floats or np.int64)
        table = np.ascontiguousarray(np.frombuffer(b"".join(block["far"]), np.float32).reshape(len(x), -1).T)
        farthest = table.max(0).astype(np.float64)
        gaps, other = np.empty_like(table[0]), np.empty_like(table[0])
        out = []
        for row in queries.itertuples():
            query, far = np.frombuffer(row.body, kind).astype(floats or np.int64), np.frombuffer(row.far, np.float32)
            gaps.fill(0)
            for p in range(len(table)):
                np.subtract(table[p], far[p], out=other)
                np.maximum(gaps, np.abs(other, out=other), out=gaps)
            bounds = _bound(row.norm, norms, gaps, farthest + far.max())
            reach = row.reach
            alive = np.flatnonzero((bounds >= reach) & (ids != row.vec_id))
            best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            step = STEP
            while len(alive):
                part, alive = highest(alive, bounds, step)
                scores = (x[part] @ query).astype(np.int64) if floats else _exact_scores(x[part], query)
                if len(best) == k:
                    some = scores >= best[-1]
                    part, scores = part[some], scores[some]
                best, best_ids = np.concatenate((best, scores)), np.concatenate((best_ids, ids[part]))
                order = np.lexsort((best_ids, ~best))[:k]  # ~ turns the order around without overflow
                best, best_ids = best[order], best_ids[order]
                if len(best) == k:
                    reach = max(reach, float(best[-1]))
                    alive = alive[bounds[alive] >= reach]  # the others' bounds are too low for good
                step *= 2
            keep = best >= row.reach
            out.append(pd.DataFrame({"query_id": row.vec_id, "vec_id": best_ids[keep], "score": best[keep]}))
        return pd.concat(out) if out else nothing

    return run


def highest(rows: np.ndarray, bounds: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` rows of highest bounds, and the others."""
    if len(rows) <= count:
        return rows, rows[:0]
    order = np.argpartition(bounds[rows], len(rows) - count)
    return rows[order[-count:]], rows[order[:-count]]


def _cells_to_visit(cells: list[tuple[int, float, np.ndarray, np.ndarray]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replaces a query's own cell by the list of other cells whose bound can reach its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, norms = np.array([c[0] for c in cells]), np.array([c[1] for c in cells])
        low, high = np.stack([c[2] for c in cells]), np.stack([c[3] for c in cells])
        for batch in batches:
            lists = []
            for norm, far, own, reach in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 6)), strict=True):
                far = _distances(far)
                gaps = np.maximum(0, np.maximum(low - far, far - high).max(1))
                bounds = _bound(norm, norms, gaps, high.max(1) + far.max())
                lists.append(numbers[(bounds >= reach) & (numbers != own)].tolist())
            columns = [*batch.columns[:4], batch.column(5), batch.column(6), pa.array(lists, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "body", "norm", "far", "chunk", "reach", "cells"])

    return run


def _met(queries: DataFrame, vectors: DataFrame, blocks: list[int], search: Callable) -> DataFrame:
    """Each query against all blocks of the cells in its column ``cells``: its k best of each block.

    ``queries`` is a stored table, as it is read twice: vectors go only to the chunks in which a query asks for their cell.
    """
    pieces = F.element_at(F.array(*map(F.lit, blocks)), F.col("cell") + 1)
    asked = queries.select("vec_id", "body", "norm", "far", "reach", "chunk", F.explode("cells").alias("cell"))
    # a row for each cell, so at most as many as pivots; Spark broadcasts it if it measures a small file
    asking = stored(asked.select("cell", "chunk").groupBy("cell").agg(F.collect_set("chunk").alias("chunks")), "asking")
    asked = asked.select("*", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("part"))
    given = vectors.join(asking, "cell").select(
        "vec_id", "body", "norm", "far", "cell", F.pmod(F.xxhash64("vec_id"), pieces).cast("int").alias("part"),
        F.explode("chunks").alias("chunk"),
    )
    keys = ["cell", "part", "chunk"]
    return asked.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")


def _chunked(queries: DataFrame, rows: int) -> DataFrame:
    """Adds the chunk: queries are dealt to chunks of about ``rows`` cell by cell, so that a chunk asks for few cells."""
    sizes = {r["cell"]: r["count"] for r in queries.groupBy("cell").count().collect()}  # at most as many as pivots
    before = F.lit(0).cast("long")
    total = 0
    for cell in sorted(sizes):
        place = F.pmod(F.xxhash64("vec_id", "body", F.lit(7)), F.lit(sizes[cell]))
        before = F.when(F.col("cell") == cell, F.lit(total) + place).otherwise(before)
        total += sizes[cell]
    return queries.withColumn("chunk", F.floor(before / rows).cast("int"))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, k: int = K, scale: int = SCALE, every: int = EVERY, block_rows: int | None = None, query_rows: int | None = None
) -> DataFrame:
    """The k highest inner products of every query: query_id, rank (from 1), vec_id, score; ties to smaller vec_id.

    Components become floor(scale * x). Queries are the rows whose vec_id is divisible by ``every``; candidates all
    rows of another id. Vectors that are null or hold null or non-finite components, and rows without an id, take no
    part. Rows that share an id are candidates each; as queries they share one list of the k best. Vectors of several
    lengths have no inner product, and are refused, as are numbers beyond 62 bits. A query with fewer candidates returns
    them all. Further columns are not read; an empty table gives an empty one. Blocks and chunks have as many rows as
    BLOCK_BYTES and QUERY_BYTES of doubles hold, if none are given; no result depends on it.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"))
    bodies = stored(rows.mapInArrow(_as_bytes(scale), "vec_id long, body binary, top long"), "integers")
    width = F.octet_length("body")
    widths = bodies.agg(F.min(width).alias("least"), F.max(width).alias("most"), F.max("top").alias("top")).first()
    if not widths["most"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if widths["least"] < widths["most"]:
        raise ValueError(f"vectors have from {widths['least'] // 8} to {widths['most'] // 8} components; all must have one length")
    components, kind = widths["most"] // 8, smallest_kind(widths["top"])
    search = _search(k, kind, exact_floats(widths["top"], components))
    block_rows = block_rows or max(256, BLOCK_BYTES // (8 * components))
    query_rows = query_rows or max(256, QUERY_BYTES // (8 * components))
    sample = bodies.orderBy(F.xxhash64("vec_id"), "vec_id", "body").limit(SAMPLE_ROWS).collect()
    pivots = choose_pivots(_matrix([bytes(r["body"]) for r in sample], components).astype(np.float64), PIVOTS)
    measured = stored(bodies.select("vec_id", "body").mapInArrow(_measure(pivots, kind), _VECTOR), "pivot-tables")
    ranges = (
        measured.mapInArrow(_summarise, "cell int, pivot int, n long, norm double, low double, high double")
        .groupBy("cell", "pivot")
        .agg(F.sum("n").alias("n"), F.max("norm").alias("norm"), F.min("low").alias("low"), F.max("high").alias("high"))
        .orderBy("cell", "pivot")
        .collect()  # as many rows as pairs of pivots
    )
    width = len(pivots)
    cells = [
        (own[0]["cell"], own[0]["norm"], np.array([r["low"] for r in own]), np.array([r["high"] for r in own]))
        for own in (ranges[i : i + width] for i in range(0, len(ranges), width))
    ]
    sizes = {r["cell"]: r["n"] for r in ranges}
    blocks = [max(1, -(-sizes.get(c, 0) // block_rows)) for c in range(width)]
    queries = _chunked(measured.filter(F.col("vec_id") % every == 0).distinct(), query_rows)  # equal rows ask the same
    home = stored(queries.select("*", F.lit(float("-inf")).alias("reach"), F.array("cell").alias("cells")), "queries")
    near = stored(_best(_met(home, measured, blocks, search), k).drop("rank"), "own-cells")
    reach = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.min("score").alias("least"), F.count("*").alias("n"))
    known = F.when(F.col("n") == k, F.col("least").cast("double")).otherwise(F.lit(float("-inf"))).alias("reach")
    columns = "vec_id long, body binary, norm double, far binary, chunk int, reach double, cells array<int>"
    onward = (
        home.join(reach, "vec_id", "left")
        .select("vec_id", "body", "norm", "far", "cell", "chunk", known)
        .mapInArrow(_cells_to_visit(cells), columns)
    )
    found = near.union(_met(stored(onward, "onward"), measured, blocks, search))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
