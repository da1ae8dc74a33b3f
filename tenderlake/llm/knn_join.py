"""Exact top-k by inner product as a Voronoi kNN join.

Inner products become distances by one more component: with M the largest
squared norm of the data, (x, sqrt(M - |x|^2)) and (q, 0) are the closer the
larger q.x is. Data and queries go to the nearest of a few pivots. From
summaries of the cells (counts, radii, smallest distances) each group of
queries gets a bound on the distance of its k-th neighbours, and a data row is
sent to those groups only whose bound it can meet. Groups are solved locally in
chunks of bounded size, and the chunks' best are merged.

Only pivots and summaries reach the driver: PIVOTS rows and PIVOTS * (k + 1)
distances at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

PIVOTS = 64
#: Queries that make a group of their own, and data rows of a chunk.
GROUP, CHUNK = 512, 20_000


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows; shorter ones are filled up with zeros, which change no inner product."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """From rows (x, extra) to pivots, all in the space with one more component."""
    full = np.hstack([x, extra[:, None]])
    square = (full**2).sum(1)[:, None] - 2 * full @ pivots.T + (pivots**2).sum(1)[None, :]
    return np.sqrt(np.maximum(square, 0))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "vector", pivots: int = PIVOTS, group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, key and score: for each query row its k best other rows by inner product.

    vectors holds key and vector (an array of whole numbers as doubles); rows
    whose vector is not usable, or whose key is null, take no part. Rows with the
    query's own key are not its candidates; ties go to the smaller key. Query
    rows that are alike are one query; those of one key with different vectors
    share the key's k places. Candidate rows count each for itself, also where
    they are alike. Vectors of different lengths are compared as if filled up
    with zeros. Scores beyond 63 bits are an error. Other columns do not matter.
    """
    spark = vectors.sparkSession
    data = written(vectors.where(usable(F.col(vector)) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("query")), "vectors")
    shape = data.agg(F.max(F.size("v")).alias("d"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m"), F.count_if("query").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))).alias("top")).first()
    out = "query_id long, rank int, vec_id long, score long"
    if not shape["n"]:
        return spark.createDataFrame([], out)
    width, most = max(1, shape["d"]), shape["m"]
    if width * shape["top"] ** 2 >= 2**63:
        raise ValueError("inner products of these vectors can exceed 63 bits")
    exact = width * shape["top"] ** 2 < 2**53  # whole numbers stay exact in doubles
    # a sample whose size is the parameter pivots; it steers the work, not the result
    chosen = data.select("v").orderBy(F.xxhash64("id"), "id").limit(pivots).toArrow()
    x = _matrix(chosen.column("v"), width)
    centres = np.unique(np.hstack([x, np.sqrt(np.maximum(most - (x**2).sum(1), 0))[:, None]]), axis=0)
    centres_of_queries = centres[: max(1, min(len(centres), -(-shape["n"] // group)))]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row's cell and distance; a query has those among the queries' pivots as well."""
        for b in batches:
            x = _matrix(b.column("v"), width)
            d = _distances(x, np.sqrt(np.maximum(most - (x**2).sum(1), 0)), centres)
            q = _distances(x, np.zeros(len(x)), centres_of_queries)
            cell, home = d.argmin(1), q.argmin(1)
            at = np.arange(len(x))
            arrays = [b.column("id"), b.column("v"), b.column("query"), pa.array(cell.astype(np.int32)), pa.array(d[at, cell]), pa.array(home.astype(np.int32)), pa.array(q[at, home])]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "v", "query", "cell", "d", "home", "r"])

    cells = written(data.mapInArrow(placed, "id long, v array<double>, query boolean, cell int, d double, home int, r double"), "cells")
    near = _smallest(cells, k + 1)
    extent = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("far"), F.min("d").alias("close")).collect()
    homes = cells.where("query").groupBy("home").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("r")).collect()
    closest = {r["cell"]: r["ds"] for r in near.collect()}
    sends = np.full((len(homes), len(centres)), np.nan)
    bounds, blocks, chunks = np.zeros(len(homes)), np.zeros(len(homes), int), np.zeros(len(homes), int)
    slack = 1e-6 * (1 + np.sqrt(most))
    for i, h in enumerate(homes):
        between = np.sqrt(((centres - centres_of_queries[h["home"]]) ** 2).sum(1))
        upper = sorted(h["r"] + between[c["cell"]] + d for c in extent for d in closest[c["cell"]])
        # one more than k: the query's own row may be among them
        bounds[i] = upper[k] if len(upper) > k else np.inf
        reached = [c for c in extent if max(between[c["cell"]] - h["r"] - c["far"], c["close"] - between[c["cell"]] - h["r"]) <= bounds[i] + slack]
        for c in reached:
            sends[i, c["cell"]] = between[c["cell"]]
        blocks[i] = max(1, -(-h["n"] // (4 * group)))
        chunks[i] = max(1, -(-sum(c["n"] for c in reached) // chunk))
    at_home = {h["home"]: i for i, h in enumerate(homes)}
    radius = np.array([h["r"] for h in homes])
    units = np.concatenate([[0], np.cumsum(blocks * chunks)])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Data rows to the chunk that their key picks in each block of the groups they can matter to."""
        for b in batches:
            cell, d, ids = b.column("cell").to_numpy(), b.column("d").to_numpy(), b.column("id").to_numpy()
            for i in range(len(homes)):
                between = sends[i, cell]
                hit = np.flatnonzero(np.abs(between - d) - radius[i] <= bounds[i] + slack)
                part = b.take(pa.array(hit)) if len(hit) < len(ids) else b
                pick = (ids[hit].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(chunks[i])
                for block in range(blocks[i]):
                    unit = units[i] + block * chunks[i] + pick.astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(unit), part.column("id"), part.column("v")], names=["unit", "id", "v"])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries to all chunks of the block that their key picks in their group."""
        for b in batches:
            home, ids = b.column("home").to_numpy(), b.column("id").to_numpy()
            i = np.array([at_home[h] for h in home], int)
            block = (ids.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(33)).astype(np.int64) % blocks[i] if len(i) else i
            n = chunks[i]
            row = np.repeat(np.arange(len(i)), n)
            unit = units[i][row] + block[row] * n[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            part = b.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(unit.astype(np.int64)), part.column("id"), part.column("v")], names=["unit", "id", "v"])

    def solved(queries: pa.Table, rows: pa.Table) -> pa.Table:
        qid, rid = queries.column("id").to_numpy(), rows.column("id").to_numpy()
        out: tuple[list, list, list] = ([], [], [])
        if len(qid) and len(rid):
            q, r = _matrix(queries.column("v"), width), _matrix(rows.column("v"), width)
            order = np.argsort(rid, kind="stable")
            rid, r = rid[order], r[order]
            if not exact:
                q, r = q.astype(np.int64), r.astype(np.int64)
            for at in range(0, len(qid), 128):
                score = q[at : at + 128] @ r.T
                for j, s in enumerate(score):
                    own = np.flatnonzero(rid != qid[at + j])
                    s = s[own]
                    if len(s) > k:
                        edge = np.partition(s, len(s) - k)[len(s) - k]
                        above, ties = np.flatnonzero(s > edge), np.flatnonzero(s == edge)
                        best = np.concatenate([above, ties[: k - len(above)]])  # ids ascend, so ties keep the smallest
                    else:
                        best = np.arange(len(s))
                    out[0].extend([int(qid[at + j])] * len(best))
                    out[1].extend(rid[own[best]].tolist())
                    out[2].extend(int(v) for v in s[best])
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.int64())})

    form = "unit long, id long, v array<double>"
    left = cells.where("query").dropDuplicates(["id", "v"]).mapInArrow(asked, form).groupBy("unit")
    best = left.cogroup(cells.mapInArrow(sent, form).groupBy("unit")).applyInArrow(solved, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _smallest(cells: DataFrame, k: int) -> DataFrame:
    """cell and ds: each cell's k smallest distances, found per task before they meet."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for b in batches:
            cell, d = b.column("cell").to_numpy(), b.column("d").to_numpy()
            for c in np.unique(cell):
                kept[c] = np.sort(np.concatenate([kept.get(c, np.zeros(0)), d[cell == c]]))[:k]
        rows = [(int(c), float(x)) for c, ds in kept.items() for x in ds]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64())], names=["cell", "d"])

    rank = F.row_number().over(Window.partitionBy("cell").orderBy("d"))
    found = cells.select("cell", "d").mapInArrow(smallest, "cell int, d double").withColumn("n", rank).where(F.col("n") <= k)
    return found.groupBy("cell").agg(F.array_sort(F.collect_list("d")).alias("ds"))
