"""Exact top-k inner products by the threshold algorithm of Fagin, Lotem and Naor.

Vectors are packed into blocks of bounded size where they are read. A block keeps, for every dimension, its
vectors in the order of that component. A query walks all lists downwards together (upwards where its own
component is negative); vectors seen for the first time are scored in full; and it stops as soon as the bound - the
score of a vector with the components at the current depth of all lists - is below the k-th score so far. Ties are
safe: at equality it goes on. Depths are doubled, so that a step is a few vectorised operations.

Queries are packed into chunks the same way, which are small next to blocks: every chunk is sent to every block of its
length, and the best k of each block are merged per query at the end. Only counts reach the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipquarry.llm.common import small_side, store

K = 20
SCALE = 64
BLOCK_ROWS = 16_384
CHUNK_ROWS = 256
TASKS_PER_CORE = 8
FIRST_DEPTH = 16
EXACT, EXACT_SINGLE = float(1 << 53), float(1 << 24)
LONG = (-(1 << 63), (1 << 63) - 1)


def pack(vectors: DataFrame, rows: int, *, scale: int, vec_id: str, vector: str, sort: bool) -> DataFrame:
    """Vectors in blocks of at most ``rows``: ``part`` and ``number`` (of the block), ``dims``, ``ids``, ``values``
    (float64, whole numbers), and with ``sort`` also ``lists``: per dimension the rows by falling component.
    Vectors of different lengths come in different blocks. Null ids, null vectors and vectors with a
    null or non-finite component take no part."""
    valid = F.col(vec_id).isNotNull() & F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)
    )
    rows_in = vectors.where(valid).select(
        F.col(vec_id).cast("long").alias("i"), F.col(vector).cast("array<double>").alias("v")
    )
    schema = "part long, number long, dims int, ids binary, values binary, lists binary"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, {}

        def close(dims: int) -> pa.RecordBatch:
            nonlocal number
            pieces = held.pop(dims)
            ids = np.concatenate([p[0] for p in pieces])
            values = np.floor(np.concatenate([p[1] for p in pieces]) * scale)
            lists = np.argsort(-values, axis=0, kind="stable").T.astype(np.int32) if sort else np.zeros(0, np.int32)
            row = [part, number, dims, ids.tobytes(), values.tobytes(), np.ascontiguousarray(lists).tobytes()]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], schema_names)

        for batch in batches:
            lists = batch.column(1)
            lengths = np.asarray(lists.value_lengths())
            flat = np.asarray(lists.flatten()).astype(np.float64, copy=False)
            ends = np.cumsum(lengths)
            ids = np.asarray(batch.column(0))
            for dims in np.unique(lengths).tolist():
                pick = np.flatnonzero(lengths == dims)
                own = flat[(ends[pick] - dims)[:, None] + np.arange(dims)].reshape(len(pick), dims)
                for a in range(0, len(pick), rows):
                    have = sum(len(p[0]) for p in held.get(dims, []))
                    take = pick[a:a + rows]
                    cut = rows - have
                    for lo, hi in ((0, min(cut, len(take))), (min(cut, len(take)), len(take))):
                        if hi > lo:
                            held.setdefault(dims, []).append((ids[take[lo:hi]], own[a + lo:a + hi]))
                            if sum(len(p[0]) for p in held[dims]) >= rows:
                                yield close(dims)
        for dims in list(held):
            yield close(dims)

    schema_names = ["part", "number", "dims", "ids", "values", "lists"]
    return rows_in.mapInArrow(packed, schema)


def threshold_search(
    ids: np.ndarray, values: np.ndarray, lists: np.ndarray, own: int, query: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """The rows of the block with the best ``k`` scores against ``query``, ties to smaller ids, without rows whose
    id is ``own``; the scores; and how many entries of the lists were read. Lists are read from the end that
    raises the score, all to the same depth; nothing below it is looked at."""
    n = len(values)
    down, up = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    seen = ids == own
    rows, scores, read = np.zeros(0, np.int64), np.zeros(0, values.dtype), 0
    done, depth = 0, min(FIRST_DEPTH, n) if down.size + up.size else n
    while True:
        met = np.zeros(n, bool)
        if down.size + up.size:
            met[lists[down, done:depth]] = True
            met[lists[up, n - depth:n - done]] = True
            read += (down.size + up.size) * (depth - done)
        else:  # a zero query scores zero everywhere
            met[:] = True
        found = np.flatnonzero(met & ~seen)
        seen |= met
        if found.size:
            rows = np.concatenate((rows, found))
            scores = np.concatenate((scores, values[found] @ query))
            if len(rows) > k:  # all that reach the k-th score, then the best of them
                top = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
                best = top[np.lexsort((ids[rows[top]], -scores[top]))[:k]]
                rows, scores = rows[best], scores[best]
        if depth >= n:
            break
        bound = (values[lists[down, depth - 1], down] * query[down]).sum() + (values[lists[up, n - depth], up] * query[up]).sum()
        if len(rows) == k and bound < scores.min():
            break
        done, depth = depth, min(depth * 2, n)
    best = np.lexsort((ids[rows], -scores))[:k]
    return rows[best], scores[best], read


def _kind(values: np.ndarray, queries: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Both as numbers that add these products exactly: single or double ones, or whole ones of any size."""
    most = lambda x: float(np.abs(x).max()) if x.size else 0.0
    largest = most(values) * most(queries) * max(dims, 1)
    if largest >= EXACT:
        whole = np.frompyfunc(int, 1, 1)
        return whole(values), whole(queries)
    if largest < EXACT_SINGLE:
        return values.astype(np.float32), queries.astype(np.float32)
    return values, queries


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = K,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row of ``queries`` the ``k`` rows of ``vectors``
    with the largest inner products of floor(scale * component), without rows of the query's own id; all of
    them where there are fewer. Ties go to the smaller id.

    Null ids, null vectors and vectors with null or non-finite components take no part. A query meets vectors of
    its own length only. Empty vectors score 0. Every row is a candidate of its own, also one that repeats another;
    a query id that stands on several rows gets the best of what all of them find, each find counted. Scores are
    exact; beyond 64 bits they stop at the largest 64-bit number. Empty tables give an empty result."""
    options = {"scale": scale, "vec_id": vec_id, "vector": vector}
    blocks = store(pack(vectors, block_rows, sort=True, **options), "vector_blocks")
    chunks = store(pack(queries, chunk_rows, sort=False, **options), "query_chunks")
    keys = store(blocks.select("part", "number", "dims"), "block_keys")
    n_blocks = keys.count()
    # few blocks are sent to several tasks, each of which gets a share of the chunks
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    shares = max(1, min(chunks.count(), -(-TASKS_PER_CORE * cores // max(1, n_blocks))))
    share = F.pmod(F.xxhash64("part", "number"), F.lit(shares)).cast("int").alias("share")
    asked = chunks.select("dims", share, "ids", "values", F.lit(b"").alias("lists"), F.lit(1).alias("kind"))
    columns = ["part", "number", "share", "kind", "dims", "ids", "values", "lists"]
    given = blocks.withColumns({"share": F.explode(F.sequence(F.lit(0), F.lit(shares - 1))), "kind": F.lit(0)})
    rows = given.select(columns).unionByName(asked.join(small_side(keys), "dims").select(columns))
    # the chunks go to the blocks: a block is read once and stands before them
    pairs = rows.repartition(max(1, 2 * n_blocks * shares), "part", "number", "share")
    pairs = pairs.sortWithinPartitions("part", "number", "share", "kind").select("kind", "dims", "ids", "values", "lists")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        for batch in batches:
            for kind, dims, ids, values, lists in zip(*batch.columns):
                dims = dims.as_py()
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                values = np.frombuffer(values.as_buffer(), np.float64).reshape(len(ids), dims)
                if kind.as_py() == 0:
                    lists = np.frombuffer(lists.as_buffer(), np.int32).reshape(dims, len(ids))
                    block = (ids.copy(), values.copy(), lists.copy())
                    continue
                out: list[list] = [[], [], []]
                held, queries = _kind(block[1], values, dims)
                for own, query in zip(ids.tolist(), queries):
                    rows, scores, _ = threshold_search(block[0], held, block[2], own, query, k)
                    out[0] += [own] * len(rows)
                    out[1] += block[0][rows].tolist()
                    out[2] += [min(max(int(s), LONG[0]), LONG[1]) for s in scores]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

    best = pairs.mapInArrow(searched, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
