"""Exact top-k inner products by Fagin's threshold algorithm.

Rows are dealt into candidate blocks, whose sorted lists (one a dimension) are built once and
staged; the blocks stay where they are. The queries go to them, in chunks of a bounded size
that are broadcast one after the other: each chunk reads the staged blocks once, and a
task carries the k-th score of each query from block to block as the bound to beat. For one query the lists are walked in step, from the end that
the sign of the query's component favours; each newly met candidate is scored
in full, and the walk stops when the score of a candidate that stood at the
present depth of every list, the most that an unseen one can reach, is below
the k-th best score (an equal bound goes on: an unseen tie may have a smaller
id). The k best of each task are merged by another grouping.

Blocks hold a bounded number of rows (``block_rows``) and chunks of queries a bounded
number of bytes (``query_bytes``), so neither a task's memory nor a broadcast grows with
the table; the query set meets all rows in blocks.

Defined results: vectors that are NULL or hold a NULL or non-finite component,
and rows without an id, take no part; vectors of unequal length are compared as
if padded with zeros; a row repeated exactly (id and vector) counts once; a
query never meets rows of its own id; ties go to the smaller id; fewer than k
candidates give fewer rows; an empty table gives an empty result; extra
columns are ignored. Scores beyond 64 bits are set to the nearest bound.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import by_value
from contrail.session import materialize

SCHEMA = "query_id bigint, vec_id bigint, score bigint, query_key bigint"
LONG = (-(1 << 63), (1 << 63) - 1)


def quantise(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(
        finite(x.cast("double")), F.lit(False))), F.lit(False))


def threshold_topk(ids, vectors, query_id: int, query, k: int, order, ranked, step: int = 8,
                   least=None):
    """The k best (score, id) of one block for one query, by the threshold algorithm.

    ``order[d]`` lists the rows by component d, ascending, ``ranked[d]`` those
    components. ``least``: the score that k rows of other blocks reach; rows below it are left
    out. Returns (scores, ids, depth reached).
    """
    import numpy as np

    n = len(ids)
    up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    seen = ids == query_id
    if not len(up) and not len(down):  # every score is zero: ties, by id
        if least is not None and least > 0:
            return np.zeros(0, dtype=np.int64), ids[:0], 0
        best = np.sort(ids[~seen])[:k]
        return np.zeros(len(best), dtype=np.int64), best, 0
    scores, best, depth = np.empty(0, dtype=vectors.dtype), np.empty(0, dtype=np.int64), 0
    while depth < n:
        after = min(n, depth + step)
        met = np.zeros(n, dtype=bool)
        met[order[up, n - after:n - depth].ravel()] = True
        met[order[down, depth:after].ravel()] = True
        met &= ~seen
        seen |= met
        new = np.flatnonzero(met)
        got = vectors[new] @ query
        floor = scores[-1] if len(best) == k else least
        if floor is not None:
            near = got >= (floor if least is None else max(floor, least))
            new, got = new[near], got[near]
        scores, best = np.concatenate([scores, got]), np.concatenate([best, ids[new]])
        top = np.lexsort((best, -scores))[:k]
        scores, best, depth, step = scores[top], best[top], after, step * 2
        bound = ranked[up, n - depth] @ query[up] + ranked[down, depth - 1] @ query[down]
        if (len(best) == k and bound < scores[-1]) or (least is not None and bound < least):
            break
    return scores, best, depth


def _matrix(column, width: int):
    """An Arrow list column as an integer matrix, short rows padded with zeros."""
    import numpy as np

    column = column.combine_chunks()
    lengths = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = np.asarray(column.flatten())
    return out


def _build(table):
    """One block: its ids, vectors and, by dimension, the rows in ascending order."""
    import numpy as np
    import pyarrow as pa

    column = table["v"].combine_chunks()
    width = max(1, int(np.diff(np.asarray(column.offsets)).max()))
    vectors = _matrix(table["v"], width)
    top = max(abs(int(vectors.min())), abs(int(vectors.max())))
    kind = np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64
    order = np.argsort(vectors.T, axis=1, kind="stable").astype(np.int32)
    blob = lambda x: pa.array([x.tobytes()], pa.large_binary()).cast(
        pa.binary()) if x.nbytes < 1 << 31 else pa.array([x.tobytes()], pa.large_binary())
    return pa.table({
        "block": pa.array([table["block"][0].as_py()], pa.int32()),
        "width": pa.array([width], pa.int32()), "kind": pa.array([np.dtype(kind).str]),
        "ids": blob(np.asarray(table["vec_id"]).astype(np.int64)),
        "vectors": blob(vectors.astype(kind)), "order": blob(order)})


def _search(shared, k: int):
    """The best k rows of a task's blocks for each query of the chunk."""

    def search(batches):
        import numpy as np
        import pyarrow as pa

        ids_of, keys, queries = shared.value
        best: list = [None] * len(ids_of)
        for batch in batches:
            for row in range(batch.num_rows):
                cell = lambda name: batch.column(name)[row]  # noqa: B023, E731
                width, kind = cell("width").as_py(), cell("kind").as_py()
                ids = np.frombuffer(cell("ids").as_buffer(), np.int64)
                vectors = np.frombuffer(cell("vectors").as_buffer(), kind).reshape(-1, width)
                order = np.frombuffer(cell("order").as_buffer(), np.int32).reshape(width, -1)
                both = max(width, queries.shape[1])
                reach = both * max(1, *(max(abs(int(m.min())), abs(int(m.max())))
                                        for m in (vectors, queries))) ** 2
                exact = (np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53
                         else object)
                vectors = (vectors.astype(np.int64) if exact is object else vectors).astype(exact)
                # A component that one side lacks is zero.
                mine = np.zeros((len(queries), width), dtype=np.int64)
                shared_width = min(width, queries.shape[1])
                mine[:, :shared_width] = queries[:, :shared_width]
                mine = mine.astype(exact)
                ranked = np.take_along_axis(vectors.T, order, axis=1)
                for q, query in enumerate(mine):
                    old = best[q]
                    least = old[0][-1] if old is not None and len(old[0]) == k else None
                    scores, found, _ = threshold_topk(ids, vectors, ids_of[q], query, k, order,
                                                      ranked, least=least)
                    scores = np.array([int(x) for x in scores], dtype=object)
                    if old is not None:
                        scores = np.concatenate([old[0], scores])
                        found = np.concatenate([old[1], found])
                    top = sorted(range(len(scores)), key=lambda i: (-scores[i], found[i]))[:k]  # noqa: B023
                    best[q] = scores[top], found[top]
        rows = {"query_id": [], "vec_id": [], "score": [], "query_key": []}
        for q, held in enumerate(best):
            if held is not None:
                n = len(held[0])
                rows["query_id"] += [int(ids_of[q])] * n
                rows["query_key"] += [int(keys[q])] * n
                rows["vec_id"] += held[1].tolist()
                rows["score"] += [min(max(int(s), LONG[0]), LONG[1]) for s in held[0]]
        yield pa.RecordBatch.from_arrays([pa.array(rows[n], pa.int64()) for n in rows],
                                         names=list(rows))

    return search


def top_k(vectors: DataFrame, k: int = 5, query_every: int = 50, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 256, block_rows: int = 16_384,
          query_bytes: int = 32 << 20) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products.

    Queries are the rows whose id is divisible by ``query_every``; candidates
    are all rows.
    """
    import numpy as np

    spark = vectors.sparkSession
    ready = materialize(
        vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
        .select(F.col(id_col).cast("bigint").alias("vec_id"),
                quantise(F.col(vector_col), scale).alias("v")).distinct(), "vectors")
    is_query = F.pmod(F.col("vec_id"), F.lit(query_every)) == 0
    n, n_queries, width = ready.agg(F.count("*"), F.count_if(is_query), F.max(F.size("v"))).first()
    deal = lambda m, seed: F.pmod(F.xxhash64(
        F.lit(seed), "vec_id", "v"), F.lit(m)).cast("int")
    blocks = materialize(
        ready.withColumn("block", deal(max(1, -(-n // block_rows)), 1)).groupBy("block").applyInArrow(
            _build, "block int, width int, kind string, ids binary, vectors binary, order binary"),
        "topk-blocks")
    chunks = max(1, -(-n_queries * 8 * max(1, width or 1) // query_bytes))
    asked = materialize(ready.filter(is_query).select(
        "vec_id", "v", F.xxhash64("v").alias("key"), deal(chunks, 2).alias("chunk")), "topk-queries")
    found = []
    for chunk in range(chunks):
        part = asked.filter(F.col("chunk") == chunk).toArrow()
        if not part.num_rows:
            continue
        columns = max(1, int(np.diff(np.asarray(part["v"].combine_chunks().offsets)).max()))
        shared = spark.sparkContext.broadcast(
            (np.asarray(part["vec_id"]), np.asarray(part["key"]), _matrix(part["v"], columns)))
        found.append(materialize(blocks.mapInArrow(_search(shared, k), SCHEMA), "topk-found"))
        shared.unpersist()
    found = reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], SCHEMA)
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key")
                               .orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


by_value(__name__)
