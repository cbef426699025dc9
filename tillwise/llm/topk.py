"""Exact top-k inner-product search by three phases with a uniform threshold.

Vectors are split into ``LISTS`` runs of components; run j of a query and a candidate gives
the partial score of list j, and a score is the sum over lists.  Candidates are dealt to splits and
queries to groups, both of bounded size, and each phase is one job over the grid of their cells: however
many queries there are, the table is read once a phase.

1. Each cell ranks its candidates per list, keeps the k best of every list, scores those
   exactly and returns its k best of each query.  Spark merges these to k per query row; the k-th
   score is a safe cutoff: the true k-th score cannot be lower.
2. The cutoffs go with the queries to every cell.  A candidate whose score
   reaches cutoff t exceeds its list's minimum by at least (t - sum of minima) / LISTS in
   some list, so each cell collects only entries over that uniform threshold and drops those
   whose upper bound (known partial scores, threshold elsewhere) stays below t.
3. What is left is scored exactly; scores of at least t are returned, at most k a cell and
   query row, ties to the smaller id, and Spark ranks them.

Scores are integers: component x counts as floor(256 * x).  While they fit, float64 matrix
products are exact; larger ones are summed in Python's integers, and a score beyond 64 bits
is clamped to the largest or smallest long.

Defined cases: vectors that are null, empty, or that hold null or non-finite components take no
part; neither do null ids; vectors meet those of their own length only.  An id names a query: rows of
equal id are all searched for and their entries ranked together, a candidate once for each
of them; rows of equal id count as one candidate each, and none is a candidate of its own id.
Without queries or candidates the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import ship_package, shuffle_partitions, stored

#: Lists a vector is split into; most queries and candidates of a cell; queries and candidates scored at once.
LISTS, GROUP, SPLIT, QUERY_BLOCK, CANDIDATE_BLOCK = 4, 1 << 14, 1 << 16, 512, 2048
_SAFE = float(1 << 53)
_LONG = (1 << 63) - 1


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, dim, v): integer components as doubles, rows that take part only."""
    x = F.transform(F.col(embedding), lambda e: F.floor(F.lit(256.0) * e.cast("double")).cast("double"))
    finite = F.forall(F.col(embedding), lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & (F.size(embedding) > 0) & finite)
    return rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.size(embedding).alias("dim"), x.alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores of paired rows."""
    bound = np.abs(q).max(initial=0.0) * np.abs(c).max(initial=0.0) * q.shape[-1]
    if bound < _SAFE:
        return np.einsum("ij,ij->i", q, c).astype(np.int64)
    sums = (sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for x, y in zip(q, c, strict=True))
    return np.array([max(-_LONG - 1, min(_LONG, s)) for s in sums], dtype=np.int64)


class _Block:
    """A block of queries of one dimension and, from the second phase on, their cutoffs."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, lists: int, cutoff: np.ndarray | None = None):
        self.ids, self.vectors, self.k, self.cutoff_int = ids, vectors, k, cutoff
        # the least long also stands for all scores below it, and for "no cutoff yet": everything passes
        self.cutoff = None if cutoff is None else np.where(cutoff == -_LONG - 1, -np.inf, cutoff.astype(np.float64))
        edges = np.linspace(0, vectors.shape[1], min(lists, vectors.shape[1]) + 1).astype(int)
        self.runs = list(zip(edges[:-1], edges[1:], strict=True))

    def _partial(self, cand: np.ndarray) -> np.ndarray:
        """(lists, queries, candidates)"""
        return np.stack([self.vectors[:, a:b] @ cand[:, a:b].T for a, b in self.runs])

    def _best(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best entries a query, ties to the smaller id."""
        order = np.lexsort((ids, -score.astype(object) if score.dtype == object else ~score, q))
        q, ids, score = q[order], ids[order], score[order]
        first = np.searchsorted(q, q, side="left")
        keep = np.arange(len(q)) - first < self.k
        return q[keep], ids[keep], score[keep]

    def scan(self, ids: np.ndarray, cand: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        partial = self._partial(cand)
        if self.cutoff is None:
            chosen = np.zeros(partial.shape[1:], dtype=bool)
            top = min(self.k + 1, len(ids))  # one more, for the query itself
            for scores in partial:
                at = np.argpartition(-scores, top - 1, axis=1)[:, :top]
                np.put_along_axis(chosen, at, True, axis=1)
        else:
            # float sums of huge values may round; the slack keeps every bound safe
            slack = 1e-9 * (1.0 + np.abs(partial).sum(axis=0).max(axis=1))
            low = partial.min(axis=2)
            over = (self.cutoff - low.sum(axis=0) - slack) / len(partial)
            listed = partial - low[:, :, None] >= over[None, :, None]
            bound = np.where(listed, partial, low[:, :, None] + np.maximum(over, 0)[None, :, None]).sum(axis=0)
            chosen = listed.any(axis=0) & (bound >= (self.cutoff - slack)[:, None])
        chosen &= self.ids[:, None] != ids[None, :]
        q, c = np.nonzero(chosen)
        parts = []
        for at in range(0, len(q), 1 << 16):
            one = slice(at, at + (1 << 16))
            score = _exact(self.vectors[q[one]], cand[c[one]])
            keep = slice(None) if self.cutoff is None else score >= self.cutoff_int[q[one]]
            parts.append((q[one][keep], ids[c[one]][keep], score[keep]))
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return self._best(*(np.concatenate(x) for x in zip(*parts, strict=True)))


ENTRIES = "number bigint, query_id bigint, vec_id bigint, score bigint"


def _scan(candidates: DataFrame, asked: DataFrame, k: int, lists: int, splits: int, groups: int) -> DataFrame:
    """(number, query_id, vec_id, score) of every cell; with a column ``cutoff`` only entries that reach it."""
    final = "cutoff" in asked.columns
    names = ["number", "query_id", "vec_id", "score"]

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[list] = [[] for _ in names]
        if left.num_rows and right.num_rows:
            dim = right.column("dim")[0].as_py()
            for at in range(0, right.num_rows, QUERY_BLOCK):
                part = right.slice(at, QUERY_BLOCK).combine_chunks()
                number, ids = (part.column(c).to_numpy() for c in ("number", "vec_id"))
                block = _Block(ids, _matrix(part.column("v").combine_chunks(), dim), k, lists, part.column("cutoff").to_numpy() if final else None)
                best = None
                for first in range(0, left.num_rows, CANDIDATE_BLOCK):
                    some = left.slice(first, CANDIDATE_BLOCK).combine_chunks()
                    more = block.scan(some.column("vec_id").to_numpy(), _matrix(some.column("v").combine_chunks(), dim))
                    best = more if best is None else block._best(*(np.concatenate(x) for x in zip(best, more, strict=True)))
                q, vec_id, score = best
                for own, values in zip(found, (number[q], ids[q], vec_id, score), strict=True):
                    own.append(values)
        return pa.table({n: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for n, v in zip(names, found, strict=True)})

    ship_package(candidates.sparkSession)
    deal = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = candidates.withColumn("split", deal(splits)).withColumn("group", every(groups))
    right = asked.withColumn("group", deal(groups)).withColumn("split", every(splits))
    key = ["dim", "group", "split"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(cell, ENTRIES)


def _ranked(entries: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), "vec_id")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, lists: int = LISTS, group: int = GROUP, split: int = SPLIT) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` candidates of highest score for each query.

    Both frames hold ``vec_id`` and ``embedding``.  A task holds ``group`` queries and ``split`` candidates at most.
    """
    candidates = stored(usable(vectors))
    # numbered once, so that both phases speak of the same query rows
    asked = stored(usable(queries).withColumn("number", F.monotonically_increasing_id()))
    # at least two cells a task of the session, at most so many rows in one (about, as they are dealt by hash)
    splits = max(2 * shuffle_partitions(vectors.sparkSession), -(-candidates.count() // split))
    groups = max(1, -(-asked.count() // group))
    first = _ranked(_scan(candidates, asked, k, lists, splits, groups), "number", k)
    cutoffs = first.groupBy("number").agg(F.count("*").alias("n"), F.min("score").alias("t")).where(F.col("n") == k).select("number", F.col("t").alias("cutoff"))
    # a query row with fewer than k entries so far has no cutoff yet
    bounded = stored(asked.join(cutoffs, "number", "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(-_LONG - 1))))
    found = _scan(candidates, bounded, k, lists, splits, groups)
    return _ranked(found, "query_id", k).select("query_id", "rank", "vec_id", "score")
