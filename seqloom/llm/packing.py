"""Best-fit packing of tokenised documents into sequences of a fixed length, with a matching of large items.

Lengths are whole numbers up to the capacity, so the packing is decided on their histogram, which is bounded by the
capacity whatever the input's size: groups of equal bins, made by the method's rules. The pieces then take their
places by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, pick, store

CAPACITY, END = 1024, 2
_SALT_ROWS = 20_000  # about so many pieces of one length are ranked in one task


@lru_cache(maxsize=2)
def _encoding(path: str):
    """The vocabulary of a byte-level BPE file of the tokenizers library, run by tiktoken's faster code for the same ids."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    keep = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(keep)]
    byte = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}  # the printable form of bytes that byte-level BPE files use
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[ch] for ch in tok): i for tok, i in spec["model"]["vocab"].items() if tok not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def encode(texts: list[str | None], path: str) -> list[np.ndarray]:
    """Token ids of each text, as ``tokenizers`` gives them with add_special_tokens=False; null is empty."""
    enc = _encoding(path)
    return [np.array(enc.encode(t or "", allowed_special="all"), np.uint32) for t in texts]


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32[, ids]): each document's ids and the end id, cut only if longer than ``capacity``.

    Of a document that is cut, all pieces but the first have ``capacity`` ids. A null or empty text is the end id alone.
    """
    rows = pick(docs, id=id_col, text=text)
    kind = next(f.dataType.simpleString() for f in rows.schema.fields if f.name == "id")

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, 500):
            at, out = [], ([], [], [], [], [])
            for i, ids in enumerate(encode(b.column(1).to_pylist(), path)):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                start = 0
                for k in range(-(-len(ids) // capacity)):
                    stop = (len(ids) - 1) % capacity + 1 + k * capacity
                    at.append(i)
                    for c, v in zip(out, (k, start, stop - start, zlib.crc32(ids[start:stop].tobytes()), ids[start:stop].tolist() if keep_ids else None), strict=True):
                        c.append(v)
                    start = stop
            cols = [b.column(0).take(pa.array(at, pa.int64())), pa.array(out[0], pa.int32()), *(pa.array(c, pa.int64()) for c in out[1:4])]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                cols, names = [*cols, pa.array(out[4], pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(cut, f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids).withColumnRenamed("id", id_col)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Bins for a histogram of lengths: (how many, the lengths in each).

    Lengths above a third of the capacity are matched first, the largest with the largest that still fits, so that a
    bin has one or two of them. The others, from the longest, go where they leave the least room. The work, and the
    number of groups, depend on the capacity, not on how many pieces there are.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    assert all(0 < n <= capacity for n in left)
    open_: dict[int, list[list]] = {}  # room left -> groups of (how many, lengths)
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)

    def put(room: int, many: int, lengths: tuple[int, ...]) -> None:
        if many:
            open_.setdefault(room, []).append([many, lengths])

    for n in large:
        while c := left.get(n, 0):
            mate = next((m for m in large if m <= capacity - n and left.get(m, 0) and (m != n or c > 1)), None)
            if mate is None:
                put(capacity - n, c, (n,))
                left[n] = 0
            elif mate == n:
                put(capacity - 2 * n, c // 2, (n, n))
                left[n] = c % 2
            else:
                many = min(c, left[mate])
                put(capacity - n - mate, many, (n, mate))
                left[n] -= many
                left[mate] -= many
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while c := left[n]:
            room = min((r for r in open_ if r >= n), default=None)
            if room is None:
                each = capacity // n
                many, rest = divmod(c, each)
                put(capacity - each * n, many, (n,) * each)
                put(capacity - rest * n, rest > 0, (n,) * rest)
                left[n] = 0
                continue
            groups = open_[room]
            many, lengths = groups.pop()
            if not groups:
                del open_[room]
            each = min(room // n, c)  # once it has one, a bin is the tightest for the next
            used = min(many, c // each)
            put(room - each * n, used, lengths + (n,) * each)
            put(room, many - used, lengths)
            left[n] -= used * each
    return sorted(((int(many), lengths) for gs in open_.values() for many, lengths in gs), key=lambda g: (g[1], g[0]))


def _slots(groups: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, offset) in the order of ranks."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for many, lengths in groups:
        offset = 0
        for n in lengths:
            rows.setdefault(n, []).append((rank.get(n, 0), sequence, offset))
            rank[n] = rank.get(n, 0) + many
            offset += n
        sequence += many
    return {n: np.array(r, np.int64) for n, r in rows.items()}


def place(cut: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """``cut``, as ``pieces`` gives it and stored, with sequence_id and offset."""
    spark = cut.sparkSession
    # the histogram has at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    salts = max(8, -(-sum(counts.values()) // _SALT_ROWS))
    slots = spark.sparkContext.broadcast(_slots(plan(counts, capacity)))

    # a piece's rank among those of its length: within a salt, plus those in the salts before it
    salted = cut.withColumn("_s", F.pmod(F.xxhash64(id_col, "piece"), F.lit(salts)).cast("int"))
    before = salted.groupBy("length", "_s").count().withColumn("_b", F.sum("count").over(Window.partitionBy("length").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1))).drop("count")
    ranked = salted.withColumn("_r", F.row_number().over(Window.partitionBy("length", "_s").orderBy(id_col, "piece", "start", "ids_crc32")) - 1).join(before, ["length", "_s"])
    ranked = ranked.select(F.col(id_col).alias("id"), "piece", "start", "length", "ids_crc32", *(["ids"] if "ids" in cut.columns else []), (F.col("_r") + F.coalesce("_b", F.lit(0))).alias("rank"))

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            length, rank = b.column(3).to_numpy(), b.column(b.num_columns - 1).to_numpy()
            seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                s = slots.value[int(n)]
                k = np.searchsorted(s[:, 0], rank[at], "right") - 1
                seq[at], off[at] = s[k, 1] + rank[at] - s[k, 0], s[k, 2]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(seq), pa.array(off)], [*b.schema.names[:-1], "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1]) + ", sequence_id long, offset long"
    return ranked.mapInArrow(go, schema).withColumnRenamed("id", id_col)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """A row for each piece of every document: id_col, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    ``path`` is the tokenizer's file, which every executor has. Null and empty texts are one id long. Repeated rows
    give pieces of their own; extra columns take no part; an empty table gives no rows. Reruns agree.
    """
    return place(store(pieces(docs, path, id_col, text, capacity, end, keep_ids), "pieces"), id_col, capacity)
