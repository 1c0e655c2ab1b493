"""Exact top-k inner product search, score at a time over impact-ordered postings.

Vectors become integers, ``floor(256 * x)``.  The index is a table of blocks.  A block holds
the postings (vector, dimension, impact) of some thousand vectors, ordered by the quantised size of the
impact (its bit length), largest first, and cut into one segment per size.  Queries
run against a block in rounds: a round adds one segment's contributions to the scores of all
queries still open.  What later segments can add to a score is at most the query's length times the
length of the vector's unread part (Cauchy-Schwarz); both are in the index.  A query closes
when the vectors whose upper bound reaches the k-th best lower bound of an id, which are the only possible
members, are few; the proof is that every other vector's best case is below the worst case of k other ids'
best vectors.  Otherwise it reads on, at the latest to the end.  Possible members are rescored exactly.

Scale: index blocks and query packs form a grid; a cell holds one block and one pack, both of
bounded size, so every task has bounded memory whatever the table.  Blocks are written once.  A cell
returns k rows a query; a rank over those keeps the best k.  Blocks are dealt by the
hash of id and vector after removing repeated rows, so neither equal vectors nor the vectors of one id
meet in one block; the last rank takes the best score of each id over all blocks.

Defined results: rows whose vector is null, or holds a null, NaN or infinite component, or
whose ``vec_id`` is null take no part; shorter vectors count as padded with zeros; a row equal to
another in id and vector counts once, and all rows of a query's own id are no
candidates for it; several vectors of one id count with their best score; ties go to the smaller id;
fewer than k candidates are all returned; an empty table gives no rows.  Scores outside 64 bits are
clipped to its limits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlab.llm.common import cut

SCALE = 256.0
BLOCK, PACK = 4096, 1024
FEW = 64  # a query closes at so many possible members (a cost choice; results do not depend on it)
EXACT = float(1 << 53)


def quantised(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, q``: integer vectors as arrays of double, invalid rows left out, equal rows once."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    q = F.transform(x, lambda v: F.nanvl(F.greatest(F.least(v * SCALE, F.lit(1e300)), F.lit(-1e300)), F.lit(0.0)))
    valid = rows.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull()).filter(ok)
    return valid.select(F.col(id_col).cast("long").alias("vec_id"), q.alias("q")).distinct()


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of floor(256 x), padded with zeros."""
    arr = column.combine_chunks()
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.chunk(0) if arr.num_chunks else pa.array([], arr.type)
    sizes = np.diff(arr.offsets.to_numpy())
    out = np.zeros((len(arr), max(int(sizes.max(initial=0)), 1)))
    where = np.arange(out.shape[1])[None, :] < sizes[:, None]
    out[where] = np.floor(arr.flatten().to_numpy(zero_copy_only=False))
    return out


def _index(table: pa.Table) -> pa.Table:
    """One block: ids, and postings ordered by impact size with the segments' bounds."""
    table = table.sort_by("vec_id")  # the vectors of an id stand together
    ids, m = table.column("vec_id").to_numpy(), _matrix(table.column("q"))
    row, dim = np.nonzero(m)
    impact = m[row, dim]
    level = np.frexp(np.abs(impact))[1]  # bit length of the impact
    order = np.argsort(-level, kind="stable")
    bounds = np.append(np.flatnonzero(np.append(True, np.diff(level[order]) != 0)), len(order)) if len(order) else np.zeros(1, int)
    parts = [ids.astype("<i8"), row[order].astype("<i4"), dim[order].astype("<i4"), impact[order].astype("<f8"), bounds.astype("<i8")]
    return pa.table({"block": [table.column("block")[0].as_py()], "width": pa.array([m.shape[1]], pa.int32()),
                     **{n: pa.array([p.tobytes()], pa.binary()) for n, p in zip(("ids", "rows", "dims", "impacts", "bounds"), parts, strict=True)}})


INDEX_SCHEMA = "block long, width int, ids binary, rows binary, dims binary, impacts binary, bounds binary"


def build_index(vectors: DataFrame, n: int) -> DataFrame:
    blocks = max(1, math.ceil(n / BLOCK))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "q"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(_index, INDEX_SCHEMA)


def search_block(index: dict, qids: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k of one block for a pack of queries: (query, vec_id, score) arrays, best first per query."""
    ids = np.frombuffer(index["ids"], "<i8")
    rows, dims = np.frombuffer(index["rows"], "<i4"), np.frombuffer(index["dims"], "<i4")
    impacts, bounds = np.frombuffer(index["impacts"], "<f8"), np.frombuffer(index["bounds"], "<i8")
    width = max(index["width"], w.shape[1])
    w = np.pad(w, ((0, 0), (0, width - w.shape[1])))
    firsts = np.flatnonzero(np.append(True, np.diff(ids) != 0))  # ids are sorted
    n, norms = len(ids), np.sqrt((w * w).sum(1))
    left = np.bincount(rows, impacts * impacts, n)  # squared length of what is unread
    size = np.sqrt(left)
    score = np.zeros((len(w), n))
    score[qids[:, None] == ids[None, :]] = -np.inf
    open_, closed, start = np.arange(len(w)), {}, 0
    for end in [*bounds[1:].tolist(), len(rows)]:
        segment = np.zeros((n, width))
        seg = slice(start, end)
        segment[rows[seg], dims[seg]] = impacts[seg]
        score[open_] += w[open_] @ segment.T
        left = np.maximum(left - np.bincount(rows[seg], impacts[seg] ** 2, n), 0)
        start, last = end, end == len(rows)
        # Rounding is covered by a share of the product of the lengths; exact integers need none of it.
        rest = np.zeros(n) if last else np.sqrt(left)
        slack = norms[open_, None] * (rest + (size * 1e-9 if norms.max(initial=0) * size.max(initial=0) * width >= EXACT or not last else 0))[None, :]
        got = score[open_]
        if len(firsts) > k:
            least = np.maximum.reduceat(got - slack, firsts, axis=1)  # of the best vector of each id
            floor_ = np.partition(least, len(firsts) - k, axis=1)[:, len(firsts) - k]
            possible = got + slack >= floor_[:, None]
        else:
            possible = np.ones(got.shape, bool)
        possible &= np.isfinite(got)
        ready = (possible.sum(1) <= FEW) | last
        for i in np.flatnonzero(ready):
            closed[int(open_[i])] = np.flatnonzero(possible[i])
        open_ = open_[~ready]
        if not len(open_):
            break
    full = np.zeros((n, width))
    full[rows, dims] = impacts
    out: list[tuple[int, int, int]] = []
    for i, members in closed.items():
        best: dict[int, int] = {}
        for vec, s in zip(ids[members].tolist(), _exact(full[members], w[i]), strict=True):
            best[vec] = max(s, best.get(vec, s))
        out += [(int(qids[i]), v, s) for v, s in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]]
    cols = np.array(out, np.int64).reshape(-1, 3)
    return cols[:, 0], cols[:, 1], cols[:, 2]


def _exact(m: np.ndarray, w: np.ndarray) -> list[int]:
    """Integer inner products."""
    if np.abs(m).max(initial=0) * np.abs(w).max(initial=0) * m.shape[1] < EXACT:
        return (m @ w).astype(np.int64).tolist()
    wide = [int(x) for x in w]
    return [min(max(sum(int(a) * b for a, b in zip(r, wide, strict=True)), -(1 << 63)), (1 << 63) - 1) for r in m.tolist()]


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``queries`` against all ``vectors`` (both rows ``vec_id, q``, best read from tables)."""
    n, n_queries = vectors.count(), queries.count()
    packs, blocks = max(1, math.ceil(n_queries / PACK)), max(1, math.ceil(n / BLOCK))
    index = cut(build_index(vectors, n), "topk-index")
    grid = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))).alias("pack"))
    asked = queries.withColumn("pack", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(packs)).cast("int")).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def cell(block: pa.Table, pack: pa.Table) -> pa.Table:
        parts = [search_block(b, ids, w, k) for b in block.to_pylist() for ids, w in _packs(pack)]
        cols = [np.concatenate(c) if parts else np.zeros(0, np.int64) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 3
        return pa.table({n_: pa.array(c, pa.int64()) for n_, c in zip(("query_id", "vec_id", "score"), cols, strict=True)})

    found = grid.groupBy("block", "pack").cogroup(asked.groupBy("block", "pack")).applyInArrow(
        cell, "query_id long, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _packs(pack: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if pack.num_rows:
        ids, w = pack.column("vec_id").to_numpy(), _matrix(pack.column("q"))
        for a in range(0, len(ids), PACK):
            yield ids[a:a + PACK], w[a:a + PACK]


def nearest(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    vectors = cut(quantised(embeddings), "topk-quantised")
    return search(vectors, vectors.filter(F.col("vec_id") % every == 0), k)


TOPK_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, max(CAST(list_dot_product(a.q, b.q) AS BIGINT)) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
