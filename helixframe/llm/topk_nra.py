"""Exact top-k inner products by no-random-access aggregation.

Every dimension is a list of the candidates sorted by what they can contribute to a query: falling for a
positive query component, rising for a negative one. Lists are read in step, from the front only, a block of
entries at a time. A candidate has a lower bound (its contributions read, and the end of the lists it was not
met in) and an upper bound (the last entry read of those instead). After every block the candidates whose upper
bound is below the k-th best lower bound are out, met or not. Once hardly more than k are left, no outsider can
qualify: the query stops comparing bounds, and the lists are read on for the ones left alone, until their
scores are final. No score is computed from a vector.

Candidates and queries are dealt into blocks, and a pair of blocks is a unit of work. Lists are sorted once per
unit. Queries go through them a chunk at a time, so that what a block of entries adds to the bounds of all of
them is one matrix product; a task's memory is bounded by the block and chunk sizes. Every unit returns the
best k of its candidates per query, and a window over those partial lists gives the final ranks.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import written


class Settings(NamedTuple):
    scale: int = 64             # a component x counts as floor(scale * x)
    candidates: int = 16384     # rows in a candidate block, about
    queries: int = 1024         # rows in a query block, about
    chunk: int = 256            # queries that read their lists together
    # Shares of the lists up to which they are read before bounds are compared; the rest is read last.
    depths: tuple[float, ...] = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 7 / 8)
    left: int = 4               # a query compares bounds until at most this many times k candidates are left


class Lists:
    """The sorted lists of a block of candidates: where each candidate stands in each (by rising value), and the values."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.n, dims = vectors.shape
        order = np.argsort(vectors, axis=0, kind="stable")
        self.places = np.empty((self.n, dims), np.int32)
        np.put_along_axis(self.places, order, np.arange(self.n, dtype=np.int32)[:, None].repeat(dims, axis=1), axis=0)
        self.values = np.take_along_axis(vectors, order, axis=0)

    def ends(self, falling: bool) -> np.ndarray:
        return self.values[0 if falling else -1]

    def read(self, columns: np.ndarray, falling: bool, at: int, to: int) -> np.ndarray:
        """Entries ``at`` to ``to`` of every list, those of ``columns``: how far they lie above the end (else zero)."""
        place = self.places[columns]
        seen = (place >= self.n - to) & (place < self.n - at) if falling else (place >= at) & (place < to)
        return np.where(seen, self.vectors[columns] - self.ends(falling), 0)

    def unread(self, columns: np.ndarray, falling: bool, to: int) -> np.ndarray:
        """For lists read up to ``to`` that have not shown a candidate: how far the last entry lies above the end."""
        place = self.places[columns]
        unseen, last = (place < self.n - to, self.values[self.n - to]) if falling else (place >= to, self.values[to - 1])
        return np.where(unseen, last - self.ends(falling), 0)


def exact_type(queries: np.ndarray, vectors: np.ndarray) -> type:
    """The cheapest type in which all bounds are exact: floats of sufficient width, else Python's integers."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, vectors.shape[1])
    return np.float32 if largest < 2**22 else np.float64 if largest < 2**51 else object


def read_lists(queries: np.ndarray, lists: Lists, own: list[np.ndarray], k: int,
               settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Read the lists of a chunk of queries until no outsider is among the best ``k`` of any, then on for those inside.

    ``own`` are per query the numbers of candidates that do not count. Returns the numbers of the candidates that
    are inside for some query, their final scores, where they are inside, and per query the entries of a list
    that had been read when it stopped comparing bounds.
    """
    n = lists.n
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    columns = np.arange(n)
    low = np.repeat((up @ lists.ends(True) + down @ lists.ends(False))[:, None], n, axis=1)
    inside = np.ones((len(queries), n), bool)
    for row, numbers in enumerate(own):
        inside[row, numbers] = False
    depth = np.full(len(queries), n)
    comparing = inside.sum(axis=1) > settings.left * k
    depth[~comparing] = 0
    at = 0
    for to in [*sorted({d for d in (int(n * share) for share in settings.depths) if 0 < d < n}), n]:
        low += up @ lists.read(columns, True, at, to).T + down @ lists.read(columns, False, at, to).T
        at = to
        if at == n or not comparing.any():
            continue
        rows = np.flatnonzero(comparing)
        mine = low[rows]
        bounds = np.where(inside[rows], mine, mine.min())
        kth = np.partition(bounds, len(columns) - k, axis=1)[:, len(columns) - k]
        upper = mine + up[rows] @ lists.unread(columns, True, at).T + down[rows] @ lists.unread(columns, False, at).T
        inside[rows] &= upper >= kth[:, None]
        stopped = rows[inside[rows].sum(axis=1) <= settings.left * k]
        depth[stopped], comparing[stopped] = at, False
        held = inside.any(axis=0)
        if np.count_nonzero(held) < 0.9 * len(columns):  # the lists are read on for these alone
            columns, low, inside = columns[held], low[:, held], inside[:, held]
    return columns, low, inside, depth


def best_of_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int,
                  settings: Settings = Settings(), query_copies: np.ndarray | None = None,
                  copies: np.ndarray | None = None) -> pd.DataFrame:
    """Per query its best ``k`` of the block's candidates, ties to the smaller id.

    Columns ``query`` (its number), ``vec_id``, ``score`` and ``depth``. The candidate of the query's id, vector
    and copy number is the query itself and does not count.
    """
    kind = exact_type(queries, vectors)
    if kind is object:
        to_int = np.vectorize(int, otypes=[object])
        queries, vectors = (to_int(x) if x.size else x.astype(object) for x in (queries, vectors))
    else:
        queries, vectors = queries.astype(kind), vectors.astype(kind)
    query_copies = np.zeros(len(query_ids), np.int64) if query_copies is None else query_copies
    copies = np.zeros(len(ids), np.int64) if copies is None else copies
    order = np.argsort(ids, kind="stable")
    ids, copies, vectors = ids[order], copies[order], vectors[order]  # so that the first of equal scores is the smaller id
    lists = Lists(vectors)
    out = []
    for start in range(0, len(queries), settings.chunk):
        chunk = range(start, min(start + settings.chunk, len(queries)))
        own = []
        for i in chunk:
            a, b = np.searchsorted(ids, [query_ids[i], query_ids[i] + 1])
            own.append(a + np.flatnonzero((copies[a:b] == query_copies[i]) & (vectors[a:b] == queries[i]).all(axis=1)))
        columns, scores, inside, depth = read_lists(queries[chunk.start:chunk.stop], lists, own, k, settings)
        for row, i in enumerate(chunk):
            numbers = np.flatnonzero(inside[row])
            best = numbers[_best(scores[row, numbers], k)]
            out.append(pd.DataFrame({"query": i, "vec_id": ids[columns[best]].astype(np.int64),
                                     "score": scores[row, best].astype(np.int64), "depth": depth[row]}))
    return pd.concat(out, ignore_index=True)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Where the ``k`` largest are, falling, the first of equal ones first."""
    if len(scores) > 4 * k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        large = np.flatnonzero(scores >= kth)
        return large[np.argsort(-scores[large], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")[:k]


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id``, ``v`` (doubles), ``dims`` and ``copy`` of vectors without null, infinite or not-a-number components.

    Rows of one id and equal vectors are told apart by their copy number, from 0.
    """
    value = F.transform(F.col(embedding), lambda x: x.cast("double"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), value.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    counted = rows.where(whole).groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("vec_id", "v", F.size("v").alias("dims"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))


def top_k(vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding",
          settings: Settings = Settings(), with_depth: bool = False) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of every query's best ``k`` other rows.

    ``is_query`` maps the id column to a condition. Scores are inner products of floor(scale * component),
    whole numbers that must fit 64 bits; ties go to the smaller id. Only vectors of as many dimensions are
    compared. Vectors (or ids) that are null, or hold null or non-finite components, take no part. Repeated
    ids are rows of their own: each is a candidate of the others, and each query row has its own ranks. With
    fewer than ``k`` other rows, all are returned; an empty table gives no rows. Other columns are not read.

    ``with_depth`` adds ``depth``: the share of the lists (of the candidate's block) that the query had read
    when no outsider could qualify any more.
    """
    rows = written(usable(vectors, vec_id, embedding))
    n = rows.groupBy().agg(F.count(F.lit(1)).alias("all"), F.count_if(is_query(F.col("vec_id"))).alias("asked")).first()
    n_blocks, n_query_blocks = (max(1, math.ceil(a / b)) for a, b in ((n["all"], settings.candidates), (n["asked"], settings.queries)))

    def dealt(blocks: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "v", "copy"), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    row = ["vec_id", "copy", "v"]
    asked = rows.where(is_query(F.col("vec_id"))).select("dims", every(n_blocks).alias("block"), dealt(n_query_blocks).alias("query_block"), *row)
    # Columns of their own: grouped beside ``asked``, shared ones would be lost.
    held = rows.select(F.col("dims").alias("dims"), dealt(n_blocks).alias("block"), every(n_query_blocks).alias("query_block"),
                       *[F.col(c).alias(c) for c in row])
    unit = ["dims", "block", "query_block"]
    result = "query_id long, query_row long, vec_id long, score long, depth double"

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c.split()[0]: [] for c in result.split(", ")}, dtype="int64").astype({"depth": "float64"})
        # The same queries meet every block of candidates in the same order, so their places name them.
        left = left.assign(key=left["v"].map(tuple)).sort_values(["vec_id", "key", "copy"], ignore_index=True)
        q, c = (np.floor(settings.scale * np.stack(side["v"].to_list()).astype(np.float64)) for side in (left, right))
        q_ids = left["vec_id"].to_numpy(np.int64)
        found = best_of_block(q_ids, q, right["vec_id"].to_numpy(np.int64), c, k, settings,
                              left["copy"].to_numpy(np.int64), right["copy"].to_numpy(np.int64))
        number = found["query"].to_numpy(np.int64)
        return pd.DataFrame({"query_id": q_ids[number], "query_row": number, "vec_id": found["vec_id"],
                             "score": found["score"], "depth": found["depth"] / len(right)})

    partial = asked.groupBy(*unit).cogroup(held.groupBy(*unit)).applyInPandas(
        lambda key, left, right: solve(left, right).assign(dims=key[0], query_block=key[2]), f"{result}, dims int, query_block int")
    best = Window.partitionBy("query_id", "query_row", "dims", "query_block").orderBy(F.desc("score"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", *(["depth"] if with_depth else []))
