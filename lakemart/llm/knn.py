"""Exact top-k search by inner product: a join over Voronoi cells.

Data and queries are grouped by their nearest pivot. Counts and radii of the cells bound the
score that any pair of groups can reach; a data cell meets a group of queries only if its
upper bound can still enter that group's best k. Pairs of blocks are then solved in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIVOTS = 64  # fixed: tables of cells and of pairs of cells are bounded by it
BLOCK_ROWS = 4096
QUERY_ROWS = 512
SCALE = 64


def integer_vector(column: str = "embedding", scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; null unless all are finite numbers."""
    good = F.forall(
        F.col(column),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.when(
        good, F.transform(F.col(column), lambda x: F.floor(F.lit(scale) * x.cast("double")))
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``width``."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    values = column.flatten().to_numpy(False)
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1], lengths)] = values
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: in floating point where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _packed(frame: DataFrame, width: int, kind: str) -> DataFrame:
    """One row per block: its ids, row numbers, and its vectors as one matrix of a kind."""

    def run(part: pa.Table) -> pa.Table:
        vectors = part.column("vector").combine_chunks()
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.chunk(0)
        return pa.table(
            {
                "cell": part.column("cell").slice(0, 1),
                "block": part.column("block").slice(0, 1),
                "ids": pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                "numbers": pa.array([part.column("number").to_pylist()], pa.list_(pa.int64())),
                "matrix": pa.array([_matrix(vectors, width).astype(kind).tobytes()]),
            }
        )

    return frame.groupBy("cell", "block").applyInArrow(
        run, "cell bigint, block bigint, ids array<bigint>, numbers array<bigint>, matrix binary"
    )


def assign_cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot (``cell``) and the distance to it; ties go to the first pivot."""
    names = vectors.columns
    at = names.index("vector")
    points = pivots.astype(np.float64)
    squares = (points**2).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(at), points.shape[1]).astype(np.float64)
            cell = (squares - 2 * (x @ points.T)).argmin(1)
            distance = np.sqrt(((x - points[cell]) ** 2).sum(1))
            columns = [*batch.columns, pa.array(cell.astype(np.int64)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "cell", "distance"])

    schema = T.StructType([*vectors.schema.fields])
    schema = schema.add("cell", "long").add("distance", "double")
    return vectors.mapInArrow(run, schema)


def needed_cells(
    pivots: np.ndarray, data: list[tuple], queries: list[tuple], k: int
) -> list[tuple[int, int, float]]:
    """Pairs of query group and data cell that can hold one of the best ``k``.

    ``data`` and ``queries`` are summaries (cell, rows, radius). For a query at most u from
    pivot a and a vector at most r from pivot b the score differs from a.b by at most
    u|b| + (|a| + u) r. A group's threshold is the score that at least k + 1 vectors are sure
    to reach (one of them may be the query itself). Returns query cell, data cell, threshold.
    """
    points = pivots.astype(np.float64)
    norms = np.sqrt((points**2).sum(1))
    cells = np.array([c for c, _, _ in data], np.int64)
    rows = np.array([n for _, n, _ in data], np.int64)
    radii = np.array([r for _, _, r in data], np.float64)
    out = []
    for a, _, u in queries:
        middle = points[cells] @ points[a]
        reach = u * norms[cells] + (norms[a] + u) * radii
        reach = reach * (1 + 1e-9) + 1e-6  # rounding
        order = np.argsort(-(middle - reach), kind="stable")
        enough = np.searchsorted(np.cumsum(rows[order]), k + 1)
        low = -np.inf
        if enough < len(order):
            low = float((middle - reach)[order[enough]])
        out += [(a, int(c), low) for c in cells[middle + reach >= low]]
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        chosen = np.flatnonzero(scores >= edge)
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))[:k]]


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    column: str = "embedding",
    pivots: int = PIVOTS,
) -> DataFrame:
    """The ``k`` best partners of each query by integer inner product.

    Output: ``query_id, rank`` (from 1), ``vec_id, score``; ties go to the smaller id. Every
    usable vector is a candidate of every query but its own id; fewer than ``k`` candidates
    are all returned. Vectors that are null, hold a null or non-finite component, or have no
    id take no part. Shorter vectors count as padded with zeros, so an empty vector scores 0.
    Rows with the same id are candidates each and one query each per row. An empty table
    gives no rows. Scores beyond 64 bits wrap around.
    """
    spark = vectors.sparkSession
    usable = vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        integer_vector(column).alias("vector"),
        is_query.alias("is_query"),
    ).filter("vector IS NOT NULL AND vec_id IS NOT NULL")
    largest = F.array_max(F.transform("vector", lambda x: F.greatest(x, F.bitwise_not(x))))
    width, most = usable.agg(F.max(F.size("vector")), F.max(largest)).first()
    kind = next((k for k in ("<i2", "<i4") if (most or 0) < 1 << (8 * int(k[2]) - 1)), "<i8")
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if width is None:
        return spark.createDataFrame([], schema)
    # distinct vectors spread best; a hash picks the same ones whatever the partitions are
    mark = F.xxhash64("vector")
    least = usable.select(mark.alias("mark")).distinct().orderBy("mark").limit(pivots).collect()
    picked = usable.filter(mark.isin([r.mark for r in least])).select("vector").distinct()
    chosen = sorted(picked.collect(), key=lambda r: r.vector)
    points = np.zeros((len(chosen), width), np.int64)
    for row, pivot in enumerate(chosen):
        points[row, : len(pivot.vector)] = pivot.vector
    placed = assign_cells(usable, points)
    summary = (
        placed.groupBy("cell")
        .agg(
            F.count("*").alias("rows"),
            F.max("distance").alias("radius"),
            F.count_if("is_query").alias("queries"),
            F.max(F.when(F.col("is_query"), F.col("distance"))).alias("query_radius"),
        )
        .collect()
    )
    data = [(s.cell, s.rows, s.radius) for s in summary]
    asking = [(s.cell, s.queries, s.query_radius) for s in summary if s.queries]
    pairs = needed_cells(points, data, asking, k)
    if not pairs:
        return spark.createDataFrame([], schema)

    def block(counts: dict[int, int]) -> Column:
        of_cell = F.create_map(
            *(F.lit(x).cast("bigint") for pair in counts.items() for x in pair)
        )
        return F.pmod(F.xxhash64("vec_id"), F.element_at(of_cell, F.col("cell")))

    blocks = {c: -(-n // BLOCK_ROWS) for c, n, _ in data}
    data_blocks = placed.withColumn("block", block(blocks)).withColumn(
        "number", F.lit(None).cast("bigint")
    )
    # each row that asks has a list of its own, also where ids repeat
    query_blocks = (
        placed.filter("is_query")
        .withColumn("number", F.monotonically_increasing_id())
        .withColumn("block", block({c: -(-n // QUERY_ROWS) for c, n, _ in asking}))
    )
    left = _packed(query_blocks, width, kind).select(
        F.col("cell").alias("query_cell"),
        F.col("ids").alias("query_ids"),
        F.col("numbers").alias("query_numbers"),
        F.col("matrix").alias("query_matrix"),
    )
    right = _packed(data_blocks, width, kind)
    # at most PIVOTS squared rows
    wanted = F.broadcast(
        spark.createDataFrame(
            [(a, c, low, blocks[c]) for a, c, low in pairs],
            "query_cell bigint, cell bigint, threshold double, blocks bigint",
        )
    )
    # the queries, the smaller side, go to each block of data; a task has about one block
    asked = left.join(wanted, "query_cell").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    )
    tasks = sum(blocks.values())
    met = (
        asked.repartition(tasks, "cell", "block")
        .join(right.repartition(tasks, "cell", "block"), ["cell", "block"])
        .select("query_ids", "query_numbers", "query_matrix", "threshold", "ids", "matrix")
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                queries = np.array(row["query_ids"], np.int64)
                ids = np.array(row["ids"], np.int64)
                a = np.frombuffer(row["query_matrix"], kind).reshape(len(queries), -1)
                b = np.frombuffer(row["matrix"], kind).reshape(len(ids), -1)
                scores = _products(a.astype(np.int64), b.astype(np.int64))
                out: list[tuple[np.ndarray, ...]] = []
                for query, number, line in zip(queries, row["query_numbers"], scores):
                    kept = np.flatnonzero((ids != query) & (line >= row["threshold"]))
                    best = kept[_best(line[kept], ids[kept], k)]
                    who = np.full(len(best), number), np.full(len(best), query)
                    out.append((*who, ids[best], line[best]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*out)],
                    names=["number", "query_id", "vec_id", "score"],
                )

    found = met.mapInArrow(
        solve, "number bigint, query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
