"""Nearest neighbours by cross-polytope hashing.

A vector's bucket in a table is the nearest signed axis after three rounds of random signs and
a fast Hadamard transform.  Every vector is indexed in every table; a query probes the axes
nearest to it, and all rows met are ranked by their exact inner product.  Buckets are searched
in blocks of bounded size, so a vector shared by a third of all rows splits like any other.

Vectors null, empty, zero or with null or non-finite components take no part, nor do null
ids.  Vectors of different lengths are never compared.  Repeated rows count each.  Queries
that meet fewer than ``k`` rows are searched again over all axes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

K = 20
TABLES = 4
#: Share of the signed axes that a query probes in each table.
PROBED = 0.375
#: Axes searched together, and the rows and queries of one block.  Every row is sent once per block
#: of queries and every query once per block of rows, so both are as large as a task holds.
AXES = 16
ROWS = 8192
QUERIES = 16_384
SEED = 7


def rotate(vectors: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """The vectors, padded to a power of two, after the table's pseudo-rotation."""
    n, dim = vectors.shape
    size = 1 << max(0, dim - 1).bit_length()
    out = np.zeros((n, size))
    out[:, :dim] = vectors
    signs = np.random.default_rng([seed, table, dim]).choice([-1.0, 1.0], (3, size))
    for round_ in signs:
        out = out * round_
        step = 1
        while step < size:
            pairs = out.reshape(n, -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2)
            out = out.reshape(n, size)
            step *= 2
    return out


def nearest_axis(rotated: np.ndarray) -> np.ndarray:
    """Number of the nearest signed axis: axis i is 2i, its opposite 2i + 1."""
    axis = np.abs(rotated).argmax(axis=1)
    return 2 * axis + (rotated[np.arange(len(rotated)), axis] < 0)


def probes(rotated: np.ndarray, share: float) -> np.ndarray:
    """Which signed axes are among the nearest ``share`` of each vector."""
    signed = np.stack([rotated, -rotated], 2).reshape(len(rotated), -1)
    count = max(1, int(np.ceil(signed.shape[1] * share)))
    chosen = np.zeros(signed.shape, bool)
    order = np.argsort(-signed, axis=1, kind="stable")[:, :count]
    np.put_along_axis(chosen, order, True, axis=1)
    return chosen


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(
        F.col(id_col).isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    ).select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the batch, vectors) for each length of vector."""
    lists = common.column(batch, "vector")
    sizes = np.asarray(lists.value_lengths())
    values = np.asarray(lists.flatten())
    begin = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield at, values[begin[at, None] + np.arange(dim)]


def index(vectors: DataFrame, tables: int = TABLES) -> DataFrame:
    """(vec_id, dim, data, codes): every vector's bucket in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(common.column(batch, "vec_id"))
            for at, block in _vectors(batch):
                codes = np.stack([nearest_axis(rotate(block, t)) for t in range(tables)], 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(np.full(len(at), block.shape[1], np.int32)),
                     pa.array([x.tobytes() for x in block], pa.binary()),
                     pa.array(codes.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                    ["vec_id", "dim", "data", "codes"])

    return vectors.mapInArrow(run, "vec_id long, dim int, data binary, codes array<int>")


def _query_rows(indexed: DataFrame, tables: int, share: float) -> DataFrame:
    """One row per query, table and group of axes in which the query probes any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, data = (batch.column(i).to_pylist() for i in range(3))
            out: list[tuple] = []
            for dim in sorted(set(dims)):
                own = [i for i, d in enumerate(dims) if d == dim]
                block = np.frombuffer(b"".join(data[i] for i in own)).reshape(len(own), dim)
                for table in range(tables):
                    chosen = probes(rotate(block, table), share)
                    for begin in range(0, chosen.shape[1], AXES):
                        part = chosen[:, begin : begin + AXES]
                        mask = part @ (1 << np.arange(part.shape[1]))
                        for j in np.flatnonzero(mask):
                            i = own[j]
                            out.append((ids[i], dim, table, begin // AXES, int(mask[j]), data[i]))
            names = ["vec_id", "dim", "t", "axes", "mask", "data"]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            columns = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    schema = "vec_id long, dim int, t int, axes int, mask int, data binary"
    return indexed.select("vec_id", "dim", "data").mapInArrow(run, schema)


def _matrix(table: pa.Table) -> np.ndarray:
    data = table.column("data").to_pylist()
    return np.frombuffer(b"".join(data)).reshape(len(data), -1)


def _search(k: int):
    names = ["query_id", "vec_id", "score"]

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not (queries.num_rows and rows.num_rows):
            return pa.table({"query_id": pa.array([], pa.int64()),
                             "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        q, c = _matrix(queries), _matrix(rows)
        q_id, c_id = (np.asarray(x.column("vec_id").combine_chunks()) for x in (queries, rows))
        mask = np.asarray(queries.column("mask").combine_chunks())
        code = np.asarray(rows.column("code").combine_chunks()) % AXES
        out: list[list[np.ndarray]] = [[], [], []]
        size = np.abs(c).max() * np.abs(q).max() * q.shape[1]
        for begin in range(0, len(q), 256):
            part = slice(begin, begin + 256)
            rough = q[part] @ c.T
            met = ((mask[part, None] >> code) & 1).astype(bool) & (q_id[part, None] != c_id)
            rough[~met] = -np.inf
            at = max(0, rough.shape[1] - k)
            least = np.partition(rough, at, axis=1)[:, at]
            # Products of a matrix may differ in the last digits; what is near the limit stays in.
            row, col = np.nonzero(met & (rough >= least[:, None] - 1e-12 * size))
            for cut in range(0, len(row), 1 << 16):
                r, s = row[cut : cut + (1 << 16)] + begin, col[cut : cut + (1 << 16)]
                score = (q[r] * c[s]).sum(axis=1)
                order = np.lexsort((c_id[s], -score, r))
                r, s, score = r[order], s[order], score[order]
                place = np.arange(len(r)) - np.searchsorted(r, r)
                for target, values in zip(out, (q_id[r], c_id[s], score)):
                    target.append(values[place < k])
        return pa.table(dict(zip(names, (np.concatenate(x) for x in out))))

    return run


def _blocks(counts: DataFrame, rows: int, queries: int) -> DataFrame:
    blocks = lambda n, most: F.greatest(F.lit(1), F.ceil(F.col(n) / most)).cast("int")
    return counts.select("dim", "t", "axes", blocks("n", rows).alias("blocks"),
                         blocks("m", queries).alias("q_blocks"))


def _found(indexed: DataFrame, asked: DataFrame, k: int, tables: int) -> DataFrame:
    """The ``k`` nearest rows of every query in each block it meets."""
    at: list[Column] = [
        F.struct(F.lit(t).alias("t"), F.col("codes")[t].alias("code")) for t in range(tables)
    ]
    rows = indexed.select("vec_id", "dim", "data", F.inline(F.array(*at))).withColumn(
        "axes", F.floor(F.col("code") / AXES).cast("int"))
    key = ["dim", "t", "axes"]
    counts = indexed.select("dim", F.inline(F.array(*at))).groupBy(
        "dim", "t", F.floor(F.col("code") / AXES).cast("int").alias("axes")).agg(
        F.count("*").alias("n"))
    counts = counts.join(asked.groupBy(*key).agg(F.count("*").alias("m")), key)
    # A row per table and group of axes.
    blocks = common.materialize(_blocks(counts, ROWS, QUERIES), "blocks")
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    placed = rows.join(F.broadcast(blocks), key).withColumn("block", spread("blocks")).withColumn(
        "q_block", every("q_blocks")).drop("blocks", "q_blocks")
    wanted = asked.join(F.broadcast(blocks), key).withColumn(
        "q_block", spread("q_blocks")).withColumn("block", every("blocks")).drop("blocks", "q_blocks")
    group = [*key, "block", "q_block"]
    return wanted.groupBy(*group).cogroup(placed.groupBy(*group)).applyInArrow(
        _search(k), "query_id long, vec_id long, score double")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    tables: int = TABLES,
    share: float = PROBED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of every query but itself.

    ``is_query`` tells by ``vec_id`` which rows are queries.
    """
    common.python_batches(vectors.sparkSession)
    indexed = common.materialize(index(usable(vectors, id_col, vector_col), tables), "index")
    queries = indexed.where(is_query)
    asked = common.materialize(_query_rows(queries, tables, share), "queries")
    found = common.materialize(_found(indexed, asked, k, tables).distinct(), "found")
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = queries.join(full, queries.vec_id == full.query_id, "left_anti")
    again = common.materialize(_query_rows(short, 1, 1.0), "queries")
    if not again.isEmpty():
        found = found.union(_found(indexed, again, k, 1)).distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
