"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters. ``bytes.split()`` splits at just these.
WORD = r"[^\x20\x09-\x0D]+"


#: Of the filter that spares most rows a shuffle: 16 bits for each id, but 128 KB at least and 32 MB at most. Beyond
#: 2^24 ids it lets more and more rows through that aren't among them; these are shuffled, and results stay the same.
LEAST_BITS, MOST_BITS, BITS_PER_ID = 1 << 20, 1 << 28, 16
#: A key with more rows than a hundred-thousandth of all, and than this, is joined in pieces.
HOT_ROWS, HOT_KEYS = 4096, 100_000

_OWN: list[str] = []


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """The named columns only, under new names: ``pick(df, id="doc_id")``.

    Other columns take no part, so theirs may clash with any name an operator uses, in any case or twice.
    A column that isn't there becomes null.
    """
    names = df.columns
    flat = df.toDF(*(f"_{i}" for i in range(len(names))))
    return flat.select(*(F.col(f"_{names.index(c)}").alias(a) if c in names else F.lit(None).cast("string").alias(a) for a, c in cols.items()))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or a temporary one where it is unset."""
    if d := spark.conf.get("spark.checkpoint.dir", None):
        return d
    if (found := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        return found.get()
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="seqloom-"))
    return _OWN[0]


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: lost executors cost no more than the next step."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``store`` wrote, once nothing is to read them again."""
    for t in tables:
        spark, path = t.sparkSession, t._stored_at
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def join_hot(left: DataFrame, right: DataFrame, on: list[str], rows: str, total: int, by: str = "id") -> DataFrame:
    """``left`` joined with ``right``, which has a row for each key and, in ``rows``, how many rows of ``left`` have it.

    A key with many rows is dealt over pieces by a hash of ``by``, each of about the limit below. At most HOT_KEYS keys
    can be above a HOT_KEYS-th of ``total`` rows, which bounds both what is broadcast and what is repeated.
    """
    limit = max(HOT_ROWS, total // HOT_KEYS)
    pieces = F.ceil(F.col(rows) / limit).cast("int")
    hot = right.where(F.col(rows) > limit).select(*on, pieces.alias("_pieces"))
    l = left.join(F.broadcast(hot), on, "left").withColumn("_piece", F.when(F.col("_pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64(by), F.col("_pieces")).cast("int"))).drop("_pieces")
    r = right.withColumn("_piece", F.explode(F.when(F.col(rows) > limit, F.sequence(F.lit(0), pieces - 1)).otherwise(F.array(F.lit(0)))))
    return l.join(r, [*on, "_piece"]).drop("_piece")


def _mask(ids: DataFrame, bits: int | None = None) -> np.ndarray:
    """Bits of ``ids`` (id), by their number; at most MOST_BITS."""
    bits = bits or min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_ID * ids.count()).bit_length()))
    bit = F.pmod(F.xxhash64("id"), F.lit(bits)) + 1  # places count from 1
    found = ids.select(bit.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m"))
    mask = np.zeros(bits // 8, np.uint8)
    for r in found.toLocalIterator():
        at = (r["k"] - 1) * 4096
        mask[at : at + 4096] |= np.frombuffer(bytes(r["m"]), np.uint8)
    return mask


def _sieved(rows: DataFrame, masks: list[tuple[np.ndarray, bool]]) -> DataFrame:
    """The ``rows`` (id, ...) whose bit is as wanted in each of ``masks``. Whole rows stay in Spark: a batch of wide ones, copied to a Python worker and back, takes memory by their width."""
    out = rows
    for mask, want in masks:
        words = pa.array(mask.view("<i8"))
        parts = pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, 512, dtype=np.int32)), words)
        table = rows.sparkSession.createDataFrame(pa.table({"_part": pa.array(np.arange(len(parts)), pa.int64()), "_words": parts}))
        bit = F.xxhash64("id").bitwiseAND(F.lit(8 * len(mask) - 1))
        word = F.get("_words", F.shiftright(bit, 6).bitwiseAND(F.lit(511)).cast("int"))
        found = F.call_function("shiftright", word, bit.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
        out = out.withColumn("_part", F.shiftright(bit, 15)).join(F.broadcast(table), "_part").where(found if want else ~found).drop("_part", "_words")
    return out.select(*(f"`{c}`" for c in rows.columns))


def among(rows: DataFrame, ids: DataFrame | np.ndarray, other: bool = False, then: Callable[[Iterator], Iterator] | None = None, schema: str | None = None, also: tuple[tuple[DataFrame | np.ndarray, bool], ...] = ()) -> DataFrame:
    """The ``rows`` (id, ...) that may be among ``ids`` (id, or their bits): all that are, and few others; with ``other``, the rest, which surely aren't.

    A filter of a bounded size is broadcast, so that most rows need no shuffle to be told apart. ``also`` has further ids,
    and whether rows are to be among them. What is left goes through ``then``, which gives batches of ``schema``, in the
    same Python worker; without it, no row goes to Python.
    """
    masks = [(x if isinstance(x, np.ndarray) else _mask(x), want) for x, want in ((ids, not other), *also)]
    if then is None:
        return _sieved(rows, masks)
    sent = rows.sparkSession.sparkContext.broadcast(masks)

    def passed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            h = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            keep = np.ones(len(h), bool)
            for mask, want in sent.value:
                k = h & (8 * len(mask) - 1)
                keep &= (mask[k >> 3] >> (k & 7).astype(np.uint8) & 1).astype(bool) == want
            if keep.any():
                yield b.filter(pa.array(keep)).select(b.schema.names[:-1])

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return then(passed(it))

    return rows.withColumn("_hash", F.xxhash64("id")).mapInArrow(go, schema)


def exactly(rows: DataFrame, ids: DataFrame, then: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``then`` over just the ``rows`` (id, ...) that are among ``ids`` (id): of these, only what a filter takes for members by mistake, and its like, is shuffled whole."""
    bits = _mask(ids)
    wrong = _mask(among(rows.select("id"), bits).join(ids, "id", "left_anti"))
    sure = among(rows, bits, False, then, schema, ((wrong, False),))
    return sure.unionByName(among(rows, bits, False, None, None, ((wrong, True),)).join(ids, "id", "left_semi").select(*rows.columns).mapInArrow(then, schema))


def n_words(text: Column) -> Column:
    """How many words ``text`` has; null has none. Linear, and without an array of the words."""
    one = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.translate(one, " \t\n\x0b\x0c\r", "")).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit words (the finaliser of splitmix64)."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(it: Iterator, rows: int) -> Iterator:
    """Arrow batches cut to at most ``rows`` rows, so that memory does not follow the batch size."""
    for b in it:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
