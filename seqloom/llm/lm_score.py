"""Cross-entropy difference of two matched n-gram models, a target's and a background's.

Both models are of the same order over the same vocabulary: every lower-cased code point of the corpus, and one symbol
for a text's edge. Both are smoothed alike (Witten and Bell's interpolation down to the uniform distribution) from exact
counts over all rows. A token is a character; a document's score is its mean loss under the target model less its mean
loss under the background model, in nats: lower is more like the target.

The models are one table with a row for each n-gram that occurs, partitioned by hash, so they grow with the corpus. The
most frequent n-grams, of fixed number, are broadcast; what a document has of others is joined with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import exactly, pick, store

#: SYMBOLS is the least number of symbols that the uniform distribution is over; a corpus with more has as many as it needs.
ORDER, SYMBOLS = 4, 48
HOT = 1 << 20
_EDGE, _BITS, _HELD = 0x110000, 21, 1 << 20
#: Characters that are worked on at once: of several texts, or a stretch of one that is longer.
_PIECE = 1 << 18
#: Losses are summed as whole multiples of this, so that sums don't depend on their order.
_UNIT = 1e-8


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' lower-cased code points, one after another, and the texts' lengths in them."""
    low = [(t or "").lower() for t in texts]
    return np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32), np.array([len(t) for t in low], np.int64)


def _batches(it: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts, in column ``text``, have about _PIECE characters together, or are one text."""
    for b in it:
        size = np.array(pc.utf8_length(b.column(text)).fill_null(0).to_numpy(zero_copy_only=False), np.int64) + ORDER
        group = np.cumsum(size) // _PIECE
        cuts = np.flatnonzero(np.diff(group, prepend=-1))
        for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), b.num_rows], strict=True):
            yield b.slice(a, z - a)


def _padded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' code points, each text after ``ORDER`` - 1 edges; which of them are the texts' own; the texts' lengths."""
    codes, n = _codes(texts)
    ends = np.cumsum(n + ORDER - 1)
    padded = np.full(int(ends[-1]) if len(ends) else 0, _EDGE, np.int32)
    inside = np.ones(len(padded), bool)
    for i in range(ORDER - 1):  # each text follows its edges
        inside[ends - n - 1 - i] = False
    padded[inside] = codes
    return padded, inside, n


def _grams(padded: np.ndarray, inside: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The n-grams that end at ``inside``: by piece, (the ``ORDER`` - 1 symbols before, last symbol, where the distinct
    n-grams begin among the sorted ones, positions sorted by n-gram)."""
    todo = [(a, min(a + _PIECE, len(padded))) for a in range(ORDER - 1, len(padded), _PIECE)]
    while todo:
        a, z = todo.pop()
        piece = padded[a - ORDER + 1 : z]
        at = np.flatnonzero(inside[a:z]) + a
        if not len(at):
            continue
        # a piece's own numbers for its code points, in their order: an n-gram is then a word of 64 bits
        seen = np.zeros(_EDGE + 1, bool)
        seen[piece] = True
        own = np.flatnonzero(seen)
        bits = max(1, int(len(own) - 1).bit_length())
        if bits * ORDER > 63:
            todo += [(a, (a + z) // 2), ((a + z) // 2, z)]
            continue
        number = np.zeros(_EDGE + 1, np.int32)
        number[own] = np.arange(len(own))
        numbered, key = number[piece], np.zeros(len(at), np.int64)
        for i in range(ORDER):
            key <<= bits
            key |= numbered[at - a + i]
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key, low = key[first], (1 << bits) - 1
        before = np.zeros(len(key), np.int64)
        for i in range(ORDER - 1, 0, -1):
            before = (before << _BITS) | own[(key >> (bits * i)) & low]
        yield before, own[key & low], first, at[order]


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    before, last, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((last, before))
    before, last = before[order], last[order]
    first = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | (last[1:] != last[:-1])]))
    return before[first], last[first], np.add.reduceat(n[order], first)


def _count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(before, last, n) of a task's texts; a task holds at most about _HELD n-grams, so one may come out more than once."""

    def out(before: np.ndarray, last: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(n), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 100_000]) for x in (before, last, n)], ["before", "last", "n"])

    held: list[tuple[np.ndarray, ...]] = []
    for c in _batches(it, 1):
        padded, inside, _ = _padded(c.column(1).to_pylist())
        for before, last, first, at in _grams(padded, inside):
            held.append((before, last, np.diff(np.append(first, len(at)))))
        if sum(len(x[0]) for x in held) > _HELD:
            held = [_summed(held)]
            if len(held[0][0]) > _HELD // 2:
                yield from out(*held.pop())
    if held:
        yield from out(*_summed(held))


def counts(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(before, last, back, aim): how often each n-gram occurs in all ``rows`` (id, text), and in those among ``ids`` (id)."""
    schema = "before long, last long, n long"
    every = rows.mapInArrow(_count, schema).select("before", "last", F.col("n").alias("back"), F.lit(0).cast("long").alias("aim"))
    aimed = exactly(rows, ids, _count, schema).select("before", "last", F.lit(0).cast("long").alias("back"), F.col("n").alias("aim"))
    return every.unionByName(aimed).groupBy("before", "last").agg(F.sum("back").alias("back"), F.sum("aim").alias("aim"))


def losses(grams: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``grams`` (before, last, back, aim) with -log p of each n-gram's last symbol after the others, ``back_loss`` and ``aim_loss``, in units of _UNIT.

    Without any counts of a model, all symbols are alike.
    """
    models = ("back", "aim")

    def total(by: list[str], of: DataFrame) -> DataFrame:
        return of.groupBy(*by).agg(*(F.sum(m).alias(f"{m}_total") for m in models), *(F.sum((F.col(m) > 0).cast("long")).alias(f"{m}_kinds") for m in models))

    def p(m: str, lower: Column) -> Column:
        all_, kinds = F.col(f"{m}_total"), F.col(f"{m}_kinds")
        return F.when(all_ > 0, (F.col(m) + kinds * lower) / (all_ + kinds)).otherwise(lower)

    one = grams.groupBy("last").agg(*(F.sum(m).alias(m) for m in models))
    # one row: the totals, and how many symbols there are, with the edge and one for what doesn't occur
    all_ = total([], one).crossJoin(one.agg(F.greatest(F.lit(symbols), F.count("*") + 2).alias("symbols")))
    at = one.crossJoin(F.broadcast(all_)).select(F.lit(0).cast("long").alias("before"), "last", *(p(m, 1.0 / F.col("symbols")).alias(f"{m}_p") for m in models))
    for k in range(2, ORDER + 1):
        # of an n-gram's last k symbols; the last k - 2 of those before give the shorter one
        some = grams.withColumn("before", F.col("before").bitwiseAND(F.lit((1 << (_BITS * (k - 1))) - 1))).groupBy("before", "last").agg(*(F.sum(m).alias(m) for m in models)) if k < ORDER else grams
        some = some.join(total(["before"], some), "before").withColumn("shorter", F.col("before").bitwiseAND(F.lit((1 << (_BITS * (k - 2))) - 1)))
        lower = at.withColumnRenamed("before", "shorter")
        at = some.join(lower.select("shorter", "last", *(F.col(f"{m}_p").alias(f"{m}_l") for m in models)), ["shorter", "last"]).select("before", "last", *models, *(p(m, F.col(f"{m}_l")).alias(f"{m}_p") for m in models))
    return at.select("before", "last", *models, *(F.round(-F.log(f"{m}_p") / _UNIT).cast("long").alias(f"{m}_loss") for m in models))


class _Table:
    """N-grams' losses, looked up. Made on the driver and broadcast: three sorted arrays."""

    def __init__(self, before: np.ndarray, last: np.ndarray, aim: np.ndarray, back: np.ndarray):
        order = np.lexsort((last, before))
        self.before, number = np.unique(before, return_inverse=True)
        self.key, self.loss = (number[order] << _BITS) | last[order], np.stack([aim[order], back[order]])

    def __call__(self, before: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which are here, the two losses of those, 0 for others)."""
        if not len(self.key):
            return np.zeros(len(last), bool), np.zeros((2, len(last)), np.int64)
        i = np.minimum(np.searchsorted(self.before, before), len(self.before) - 1)
        key = (i << _BITS) | last
        j = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        here = (self.before[i] == before) & (self.key[j] == key)
        return here, np.where(here, self.loss[:, j], 0)


def score(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text: str = "text", symbols: int = SYMBOLS, hot: int = HOT) -> DataFrame:
    """(id_col, n_tokens, target_loss, background_loss, score) for every row.

    The target model counts the rows whose id is in ``target_ids`` (its first column), the background model all rows.
    A null or empty text has no tokens and null losses and score. An empty target gives the uniform model. Repeated rows
    count as often as they occur; extra columns take no part; an empty table gives no rows. ``hot``, how many n-grams are
    broadcast, changes no result.
    """
    rows = pick(docs, id=id_col, text=text)
    ids = target_ids.select(F.col(target_ids.columns[0]).alias("id")).distinct()
    grams = store(counts(rows, ids), "grams")
    table = store(losses(grams, symbols), "losses")
    top = table.orderBy(F.desc("back"), "before", "last").limit(hot).toArrow() if (cold := table.count() > hot) else table.toArrow()
    model = docs.sparkSession.sparkContext.broadcast(_Table(*(top[c].to_numpy() for c in ("before", "last", "aim_loss", "back_loss"))))
    kind = next(f.dataType.simpleString() for f in rows.schema.fields if f.name == "id")

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text, with the sums over the n-grams that the table has, and one for each other n-gram of it."""
        table = model.value
        names = ["row", "id", "n_tokens", "aim_loss", "back_loss", "before", "last"]
        for b in _batches(it, 2):
            padded, inside, n = _padded(b.column(2).to_pylist())
            loss, ends, missing = np.zeros((2, len(n)), np.int64), np.cumsum(n + ORDER - 1), []
            for before, last, first, at in _grams(padded, inside):
                here, found = table(before, last)
                which, doc = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at)))), np.searchsorted(ends, at, "right")
                for m in range(2):  # whole numbers well below 2**53, so that their sums as doubles are exact
                    loss[m] += np.bincount(doc, found[m][which], len(n)).astype(np.int64)
                if not here.all():
                    other = ~here[which]
                    missing.append((doc[other], before[which[other]], last[which[other]]))
            aim, back = loss
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), pa.array(aim), pa.array(back), none, none], names)
            for doc, before, last in missing:
                for i in range(0, len(doc), 100_000):
                    d = pa.array(doc[i : i + 100_000])
                    nil = pa.nulls(len(d), pa.int64())
                    yield pa.RecordBatch.from_arrays([b.column(0).take(d), pa.nulls(len(d), b.column(1).type), nil, nil, nil, pa.array(before[i : i + 100_000]), pa.array(last[i : i + 100_000])], names)

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "id", "text")
    parts = numbered.mapInArrow(go, f"row long, id {kind}, n_tokens long, aim_loss long, back_loss long, before long, last long")
    if cold:
        parts = store(parts, "parts")
        rest = parts.where("before is not null").groupBy("row", "before", "last").agg(F.count("*").alias("n")).join(table.select("before", "last", F.col("aim_loss").alias("_a"), F.col("back_loss").alias("_b")), ["before", "last"])
        rest = rest.groupBy("row").agg(F.sum(F.col("n") * F.col("_a")).alias("_a"), F.sum(F.col("n") * F.col("_b")).alias("_b"))
        parts = parts.where("before is null").join(rest, "row", "left").withColumn("aim_loss", F.col("aim_loss") + F.coalesce("_a", F.lit(0))).withColumn("back_loss", F.col("back_loss") + F.coalesce("_b", F.lit(0)))
    mean = lambda c: F.when(F.col("n_tokens") > 0, F.round(F.col(c) * _UNIT / F.col("n_tokens"), 6))
    return parts.select("id", "n_tokens", mean("aim_loss").alias("target_loss"), mean("back_loss").alias("background_loss")).withColumn("score", F.round(F.col("target_loss") - F.col("background_loss"), 6)).withColumnRenamed("id", id_col)
