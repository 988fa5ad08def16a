"""k-mer sketches: minimizers, their index, occurrence caps and the seed join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_CODE = np.full(256, 4, np.uint8)
for _i, _b in enumerate("ACGT"):
    _CODE[[ord(_b), ord(_b.lower())]] = _i
_CODE[[ord("U"), ord("u")]] = 3


def word_ngrams(texts: DataFrame, id_col: str, text: str, n: int) -> DataFrame:
    """(id, gram): the distinct word n-grams of each text, white space single. Spark ML's own transformer makes them, in the JVM."""
    from pyspark.ml.feature import NGram

    words = texts.select(F.col(id_col).alias("id"), F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda x: x != "").alias("w"))
    return NGram(n=n, inputCol="w", outputCol="g").transform(words).select("id", F.explode(F.array_distinct("g")).alias("gram"))


def occurrence_threshold(grams: DataFrame, fraction: float, key: str = "gram") -> DataFrame:
    """(limit): one more than the (1 - fraction) quantile of how often keys occur. One row."""
    return grams.groupBy(key).agg(F.count("*").alias("n")).agg((F.expr(f"percentile_disc({1 - fraction}) within group (order by n)") + 1).alias("limit"))


def seed_join(query: DataFrame, index: DataFrame, key: str = "gram", most: int | None = None) -> DataFrame:
    """Equi-join on the key, keys that occur more than ``most`` times in the index left out before it."""
    kept = index
    if most is not None:
        rare = index.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") <= most).drop("_n")
        kept = index.join(rare, key, "left_semi")
    return query.join(kept, key)


def index_stats(index: DataFrame, key: str = "gram") -> DataFrame:
    """(distinct, singletons, mean occurrence) of an index."""
    by = index.groupBy(key).agg(F.count("*").alias("n"))
    return by.agg(F.count("*").alias("distinct_keys"), F.count_if(F.col("n") == 1).alias("singletons"), F.avg("n").alias("mean_n"))


def _hash(x: np.ndarray, bits: int) -> np.ndarray:
    """``numeric.hash64`` on arrays."""
    m = np.uint64((1 << bits) - 1)
    s = lambda v, n: (v << np.uint64(n)) & m
    with np.errstate(over="ignore"):
        x = (((~x) & m) + s(x, 21)) & m
        x ^= x >> np.uint64(24)
        x = (x + s(x, 3) + s(x, 8)) & m
        x ^= x >> np.uint64(14)
        x = (x + s(x, 2) + s(x, 4)) & m
        x ^= x >> np.uint64(28)
        return (x + s(x, 31)) & m


def kmers(seq: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, end, strand) of the canonical k-mers: the lesser of both strands' codes; k-mers with other letters, or equal to their own complement, are left out."""
    c = _CODE[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)].astype(np.uint64)
    n = len(c) - k + 1
    if n <= 0:
        return (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int8))
    fwd, rev = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for i in range(k):
        fwd |= (c[i : i + n] & np.uint64(3)) << np.uint64(2 * (k - 1 - i))
        rev |= (np.uint64(3) - (c[i : i + n] & np.uint64(3))) << np.uint64(2 * i)
    other = np.concatenate([[0], np.cumsum(c > 3)])
    ok = (other[k:] == other[:n]) & (fwd != rev)
    strand = (rev < fwd).astype(np.int8)
    return _hash(np.minimum(fwd, rev), 2 * k)[ok], (np.arange(n) + k - 1)[ok], strand[ok]


def minimizers_of(seqs: list[str], k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(which sequence, hash, end, strand) of k-mers that are least among some ``w`` consecutive ones of their sequence; equal ones all count.

    The sequences are worked on as one, with a letter between them that no k-mer may hold.
    """
    h, end, strand = kmers("N".join(seqs), k)
    begin = np.cumsum([0] + [len(s) + 1 for s in seqs])
    of = np.searchsorted(begin, end, "right") - 1
    keep = np.zeros(len(h), bool)
    if len(h):
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        size = np.diff(np.append(first, len(h)))
        # a sequence with fewer k-mers than a window has is one window
        keep |= (h == np.repeat(np.minimum.reduceat(h, first), size)) & np.repeat(size < w, size)
    if len(h) >= w:
        n = len(h) - w + 1
        least = h[:n].copy()
        for i in range(1, w):
            np.minimum(least, h[i : i + n], out=least)
        inside = of[:n] == of[w - 1 :]
        for i in range(w):
            keep[i : i + n] |= inside & (h[i : i + n] == least)
    return of[keep], h[keep], (end - begin[of])[keep], strand[keep]


def minimizers(seq: str, k: int, w: int) -> list[tuple[int, int, int]]:
    """(hash, end, strand) of one sequence's minimizers."""
    return list(zip(*(x.tolist() for x in minimizers_of([seq], k, w)[1:]), strict=True))


def sketch(seqs: DataFrame, id_col: str, seq: str, k: int = 15, w: int = 10) -> DataFrame:
    """(rid, hash, pos, strand): the minimizers of every sequence, of a canonical k of at most 28 bases."""
    assert 0 < k <= 28 and w > 0

    def go(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            of, h, end, strand = minimizers_of(pdf.s.fillna("").tolist(), k, w)
            yield pd.DataFrame({"rid": pdf.rid.to_numpy()[of], "hash": h.astype(np.int64), "pos": end.astype(np.int32), "strand": strand.astype(np.int32)})

    rows = seqs.select(F.col(id_col).alias("rid"), F.col(seq).alias("s"))
    kind = rows.schema["rid"].dataType.simpleString()
    return rows.mapInPandas(go, f"rid {kind}, hash long, pos int, strand int")


def window_minima(keys: DataFrame, on: list[str], at: str, key: str, w: int) -> DataFrame:
    """Keys that are least among ``w`` consecutive ones, by window functions alone."""
    back = Window.partitionBy(*on).orderBy(at).rowsBetween(1 - w, 0)
    full = keys.withColumn("_min", F.when(F.count("*").over(back) == w, F.min(key).over(back)))
    ahead = Window.partitionBy(*on).orderBy(at).rowsBetween(0, w - 1)
    # the minimum of some full window that holds the row: of those that end here or later, one equals the row's key
    best = full.withColumn("_mins", F.collect_list("_min").over(ahead))
    return best.where(F.array_contains("_mins", F.col(key))).drop("_min", "_mins")
