"""Exact top-k inner-product search with a three-phase uniform threshold.

A score is a sum over lists: each list holds the candidates' partial scores on one group of dimensions.
Phase 1 gathers each list's best k and its least partial score. A candidate seen so has at least the sum of what was
seen and of the other lists' least scores; the k-th best of these bounds is a safe cutoff for the query.
Phase 2: whoever reaches the cutoff has a list with at least cutoff / lists (a uniform threshold), as not all parts of
a sum can be below its mean. Candidates with such an entry are collected, and those whose entries, with the threshold
for what wasn't collected, stay below the cutoff are dropped.
Phase 3 computes the scores of those that remain from all their components, exactly.

Queries are broadcast in rounds of at most QUERY_ROWS, whatever their number; candidates stay where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, pick, store

SCALE, LISTS, QUERY_ROWS, BLOCK = 1024, 4, 4096, 1024
#: Queries that meet a block of candidates at a time: scores are a table of QUERY_BLOCK * BLOCK numbers for each list.
QUERY_BLOCK = 512


def _vectors(b: pa.RecordBatch, dim: int | None, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and floor(scale * component) of the rows that take part, as doubles: products and sums below 2**53 are exact."""
    col = b.column(1)
    length = np.array(col.value_lengths().fill_null(-1))
    flat = col.flatten()
    values, valid = np.array(flat.fill_null(0.0), np.float64), np.array(flat.is_valid())
    out, ids, at = [], [], 0
    for i, n in zip(b.column(0).to_pylist(), length.tolist(), strict=True):
        if n < 0:
            continue
        v, ok = values[at : at + n], valid[at : at + n]
        at += n
        if i is not None and n and (dim is None or n == dim) and ok.all() and np.isfinite(v).all():
            out.append(np.floor(scale * v))
            ids.append(i)
    return np.array(ids, np.int64), np.stack(out) if out else np.empty((0, dim or 0))


def _groups(dim: int, lists: int) -> list[slice]:
    cuts = np.linspace(0, dim, min(lists, dim) + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """The places of each row's k highest, in no order."""
    return np.argpartition(-scores, k - 1, axis=1)[:, :k] if scores.shape[1] > k else np.broadcast_to(np.arange(scores.shape[1]), scores.shape)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE, lists: int = LISTS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, id, score): each query's k highest scores among ``vectors``, its own id excepted; ties to smaller ids.

    Components are floor(scale * x). Vectors that are null, empty or hold null or non-finite components take no part,
    nor do those of another dimension than the query's. A query without candidates, and an empty table, give no rows.
    Repeated ids are candidates of their own.
    """
    spark = vectors.sparkSession
    rows, asked = pick(vectors, id=id_col, v=vector), pick(queries, id=id_col, v=vector)
    # a bounded round at a time: ids are dealt to rounds by hash, by as many rounds as the count asks for
    n = asked.count()
    rounds = max(1, -(-n // query_rows))
    out = None
    for r in range(rounds):
        part = asked if rounds == 1 else asked.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == r)
        by_dim: dict[int, list[tuple[int, np.ndarray]]] = {}
        for row in part.toLocalIterator():
            if row["v"] is not None and row["id"] is not None and len(row["v"]) and all(x is not None and np.isfinite(x) for x in row["v"]):
                by_dim.setdefault(len(row["v"]), []).append((row["id"], np.floor(scale * np.array(row["v"], np.float64))))
        for dim, found in sorted(by_dim.items()):
            got = _round(spark, rows, np.array([i for i, _ in found], np.int64), np.stack([v for _, v in found]), dim, k, scale, lists)
            # a round's result is written, so that the plan doesn't grow with the rounds
            got = store(got, "round") if rounds > 1 else got
            out = got if out is None else out.unionByName(got)
    if out is None:
        out = spark.createDataFrame([], "query_id long, rank int, id long, score long")
    return out.withColumnRenamed("id", id_col)


def _round(spark, rows: DataFrame, qid: np.ndarray, q: np.ndarray, dim: int, k: int, scale: int, lists: int) -> DataFrame:
    groups, asked = _groups(dim, lists), spark.sparkContext.broadcast((qid, q))

    def blocks(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for b in it:
            for i in range(0, b.num_rows, BLOCK):
                ids, v = _vectors(b.slice(i, BLOCK), dim, scale)
                if len(ids):
                    yield ids, v

    def best(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, q = asked.value
        found = _lists(blocks(it), qid, q, groups, k)
        if found is None:
            return
        ids, scores, least = found
        for j in range(len(groups)):
            # each query's entries, then the list's least score
            i = np.concatenate([ids[j], np.full((len(qid), 1), -1)], 1)
            s = np.concatenate([scores[j], least[j][:, None]], 1)
            keep = np.isfinite(s)
            a = np.nonzero(keep)[0]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(np.full(len(a), j)), pa.array(i[keep]), pa.array(s[keep].astype(np.int64))], ["q", "l", "id", "s"])

    # id -1 carries a list's least score; ids of real entries come apart by their sign flag
    local = store(rows.mapInArrow(_flagged(best), "q long, l int, id long, s long, least boolean"), "lists")
    floor_ = local.where("least").groupBy("q", "l").agg(F.min("s").alias("m"))
    total = floor_.groupBy("q").agg(F.sum("m").alias("m"))
    # repeated ids would add up to a candidate that isn't there: of equal (list, id) only the largest entry counts once, and such ids only in one list
    entry = local.where("not least").groupBy("q", "l", "id").agg(F.max("s").alias("s"), F.count("*").alias("n"))
    above = entry.join(floor_, ["q", "l"]).groupBy("q", "id").agg(F.sum(F.col("s") - F.col("m")).alias("gain"), F.max(F.col("s") - F.col("m")).alias("one"), F.max("n").alias("n"))
    bound = above.join(total, "q").select("q", (F.when(F.col("n") > 1, F.col("one")).otherwise(F.col("gain")) + F.col("m")).alias("bound"))
    kth = bound.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bound")))).where(F.col("r") == k)
    cut = np.full(len(qid), -np.inf)
    for row in kth.select("q", "bound").collect():  # a number for each query of the round
        cut[row["q"]] = row["bound"]
    discard(local)
    cutoff = spark.sparkContext.broadcast(cut)

    def resolve(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, q = asked.value
        a, i, s = _resolved(blocks(it), qid, q, cutoff.value, groups, k)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(qid[a]), pa.array(i), pa.array(s.astype(np.int64))], ["query_id", "id", "score"])

    sent = rows.mapInArrow(resolve, "query_id long, id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return sent.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def _lists(blocks: Iterator[tuple[np.ndarray, np.ndarray]], qid: np.ndarray, q: np.ndarray, groups: list[slice], k: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray] | None:
    """Phase 1 of a task: (ids, scores, least) with each list's best k of each query (-inf: none) and its least score; None without rows.

    An entry comes with the candidate's id, so that its entries in several lists meet. Lists are merged block by block:
    memory follows the queries, not the task's rows.
    """
    ids = [np.full((len(qid), k), -1) for _ in groups]
    scores = [np.full((len(qid), k), -np.inf) for _ in groups]
    least = np.full((len(groups), len(qid)), np.inf)
    some = False
    for at, v in blocks:
        some = True
        for lo in range(0, len(qid), QUERY_BLOCK):
            here = slice(lo, lo + QUERY_BLOCK)
            own = qid[here, None] == at[None]
            for j, g in enumerate(groups):
                s = q[here, g] @ v[:, g].T
                least[j, here] = np.minimum(least[j, here], s.min(1))
                s[own] = -np.inf
                better = lo + np.flatnonzero(s.max(1) > scores[j][here].min(1))  # who has a new entry
                if not len(better):
                    continue
                all_s = np.concatenate([scores[j][better], s[better - lo]], 1)
                top = _top(all_s, k)
                held = np.take_along_axis(ids[j][better], np.minimum(top, k - 1), 1)
                ids[j][better] = np.where(top < k, held, at[np.maximum(top - k, 0)])
                scores[j][better] = np.take_along_axis(all_s, top, 1)
    return (ids, scores, least) if some else None


def _resolved(blocks: Iterator[tuple[np.ndarray, np.ndarray]], qid: np.ndarray, q: np.ndarray, cutoff: np.ndarray, groups: list[slice], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phases 2 and 3 of a task, whose candidates have all their components at hand: (query's place, id, score) of each query's best k.

    No candidate of a block can have more of a query than, over the lists, the product of the query's norm and the
    block's greatest: queries whose cutoff is above that don't meet the block. A cutoff rises to the k-th best score that
    the task has seen. What is held at a time follows the queries and the size of a block, whatever passes the cutoff.
    """
    cut = cutoff.copy()
    norms = np.stack([np.linalg.norm(q[:, g], axis=1) for g in groups], 1)
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0
    for ids, v in blocks:
        most = np.array([np.linalg.norm(v[:, g], axis=1).max() for g in groups])
        meets = np.flatnonzero(norms @ most * (1 + 1e-9) + 1e-6 >= cut)
        for lo in range(0, len(meets), QUERY_BLOCK):
            here = meets[lo : lo + QUERY_BLOCK]
            c = cut[here]
            share = c[:, None] / len(groups)
            parts = [q[here, g] @ v[:, g].T for g in groups]
            known, missing = np.zeros(parts[0].shape), np.zeros(parts[0].shape, np.int16)
            for s in parts:
                sent = s >= share
                known += np.where(sent, s, 0.0)
                missing += ~sent
            least = np.where(missing > 0, np.where(np.isfinite(share), share, 0.0) * missing, 0.0)
            a, i = np.nonzero((missing < len(groups)) & (known + least >= c[:, None]) & (qid[here, None] != ids[None]))
            # what wasn't collected is looked up for those that remain
            score = sum(s[a, i] for s in parts)
            ok = score >= c[a]
            kept.append((here[a[ok]], ids[i[ok]], score[ok]))
            held += len(kept[-1][0])
            if held > 4 * k * len(qid) + 100_000:
                kept = [_best(*(np.concatenate(x) for x in zip(*kept, strict=True)), k)]
                a, _, score = kept[0]
                held = len(a)
                last = np.flatnonzero(np.bincount(a, minlength=len(qid))[a] == k)[k - 1 :: k]  # each full query's k-th
                cut[a[last]] = np.maximum(cut[a[last]], score[last])
    return _best(*(np.concatenate(x) for x in zip(*kept, strict=True)), k) if kept else (np.empty(0, np.int64),) * 3


def _flagged(f):
    """``f`` with a last column that tells the rows of a list's least score, which follow each list's entries."""

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in f(it):
            q, l = b.column(0).to_numpy(), b.column(1).to_numpy()
            last = np.concatenate([(q[1:] != q[:-1]) | (l[1:] != l[:-1]), [True]])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(l.astype(np.int32)), *b.columns[2:], pa.array(last)], ["q", "l", "id", "s", "least"])

    return go


def _best(a: np.ndarray, i: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best of these, ties to smaller ids."""
    order = np.lexsort((i, -s, a))
    a, i, s = a[order], i[order], s[order]
    first = np.searchsorted(a, a, "left")
    keep = np.arange(len(a)) - first < k
    return a[keep], i[keep], s[keep]
