"""Join of texts whose sets of word n-grams have a Jaccard similarity of at least a threshold: prefix trees.

1. Each text becomes its set of n-gram hashes (64 bits). Texts with equal sets form a class; one text stands for it.
2. The n-grams have one global order: a fixed fraction of them, chosen by hash, comes first, the rare ones among these
   leading; the others follow by hash. Sets that are similar enough share an n-gram among the first few of each (the
   prefix filter), whose number follows from the threshold. Counting needs the chosen fraction only.
3. Sets that share such an n-gram, and have sizes that allow the similarity, are joined to one hub for each n-gram and
   range of sizes: as many edges as entries, never pairs. The components of this graph are bundles: similar sets are
   in one bundle, and most sets are in none.
4. A bundle's sets meet in one task, or, if they are many, in a task for each pair of blocks of bounded size, to which
   only those sets go that share an n-gram of a prefix with one of the other block. A task
   stores one block in a prefix tree and traverses it once for all sets of the other: sets with a common beginning
   share its overlaps, and a subtree is left as soon as its longest rest can't make up for what is missing.
5. The links that join something new are kept; their components are the result.

Nothing is sampled or capped: a very large bundle costs more tasks of the same size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import among, chunks, discard, join_hot, mix64, pick, store
from .graph import components

WORDS, PERCENT = 5, 80
BLOCK_SETS, BLOCK_GRAMS = 512, 400_000  # of one side of a task
FEW_BLOCKS = 32  # an n-gram of more blocks sends its sets by pairs of blocks


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of a text's distinct word n-grams, A-Z lower-cased; of all its words if they are fewer; empty without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    total = np.zeros(len(h) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            total = mix64(total + h[i : len(h) - n + 1 + i] + np.uint64(i + 1))
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def prefix_length(size: int, percent: int) -> int:
    """How many of a set's first elements one must share with it: if none of them, the rest is too few."""
    return size - -(-percent * size // 100) + 1


def linked(inter, a, b, percent: int):
    """100 * intersection >= percent * union, in whole numbers."""
    return inter * (100 + percent) >= percent * (a + b)


def _sampled(percent: int) -> float:
    """The fraction of n-grams that comes first: enough for twice a prefix; short texts' prefixes reach beyond it."""
    return min(1.0, max(0.1, 2 * (100 - percent) / 100))


def _limit(percent: int) -> int:
    """The mixed hash below which an n-gram is of that fraction."""
    return min((1 << 64) - 1, int(_sampled(percent) * (1 << 64)))


def _first(s: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A set's n-grams of the leading fraction, what its prefix has beyond these, and the prefix's length."""
    want = prefix_length(len(s), percent)
    lead = mix64(s ^ np.uint64(0x5BD1E995)) < np.uint64(_limit(percent))
    head, rest = s[lead], s[~lead]
    return head, rest[: max(0, want - len(head))], want


def _profile(rows: DataFrame, n: int) -> DataFrame:
    kind = next(f.dataType.simpleString() for f in rows.schema.fields if f.name == "id")

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, 2000):
            size, digest = [], []
            for t in b.column(1).to_pylist():
                s = shingles(t, n)
                size.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(digest, pa.binary())], ["id", "n", "d"])

    return rows.mapInArrow(go, f"id {kind}, n long, d binary")


def _grams(rows: DataFrame, reps: DataFrame, copied: DataFrame, n: int, percent: int) -> DataFrame:
    """(id, n, lead, want, grams) of each class's representative. Only what may be a copy is shuffled, to be told apart."""

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, 2000):
            out = ([], [], [], [], [])
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = shingles(t, n)
                if i is not None and len(s):
                    head, rest, want = _first(s, percent)
                    for c, v in zip(out, (i, len(s), len(head), want, np.concatenate([head, rest]).view(np.int64).tobytes()), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary() if k == 4 else pa.int64()) for k, x in enumerate(out)], ["id", "n", "lead", "want", "grams"])

    schema = "id long, n long, lead long, want long, grams binary"
    sure = among(rows, copied, True, go, schema)
    maybe = among(rows, copied, False, go, schema).join(reps.select("id"), "id", "left_semi")
    return sure.unionByName(maybe)


def _explode(grams: DataFrame, percent: int) -> DataFrame:
    """(t, id, k, over): a row for each n-gram kept, with its set's class of sizes and how many leading n-grams the prefix has no need of."""

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = math.log(100 / percent) * 1.001 or 1.0
        for b in chunks(it, 4000):
            blobs = b.column(4).to_pylist()
            ids, n, lead, want = (b.column(i).to_numpy() for i in range(4))
            many = [len(x) // 8 for x in blobs]
            k, over = (np.log(n) / width).astype(np.int32), np.maximum(lead - want, 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(blobs), np.int64)), *(pa.array(np.repeat(x, many)) for x in (ids, k, over))], ["t", "id", "k", "over"])

    return grams.select("id", "n", "lead", "want", "grams").mapInArrow(go, "t long, id long, k int, over long")


def _entries(grams: DataFrame, percent: int) -> DataFrame:
    """(t, bucket, id): each set's prefix without what no other set's prefix can have; sizes in two buckets each.

    Sizes whose ratio is within the threshold are in the same bucket or in adjacent ones, so two such sets have a bucket in common.
    A set's n-grams of no other set count as its first; of the leading ones that it shares, the prefix has the rarest.
    """
    each = _explode(grams, percent)
    df = each.groupBy("t").count().where("count > 1")
    total = grams.agg(F.sum(F.length("grams") / 8)).first()[0] or 0
    shared = join_hot(each, df, ["t"], "count", int(total)).select("id", "t", "count", "k", "over")
    limit = np.uint64(_limit(percent))

    def use(ids: np.ndarray, t: np.ndarray, count: np.ndarray, k: np.ndarray, over: np.ndarray) -> pa.RecordBatch:
        """The entries of whole sets, whose rows lie side by side."""
        row = np.cumsum(np.concatenate([[False], ids[1:] != ids[:-1]]))
        order = np.lexsort((t, count, row))  # rare first
        ids, t, k, over = ids[order], t[order], k[order], over[order]
        head = mix64(t.view(np.uint64) ^ np.uint64(0x5BD1E995)) < limit
        heads = np.bincount(row, head).astype(np.int64)  # of each set
        before = np.cumsum(head) - head - (np.cumsum(heads) - heads)[row]  # of the same set, before each of its own
        keep = ~head | (before < (heads[row] - over))
        ids, t, k = ids[keep], t[keep], k[keep].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ((t, t), (k, k + 1), (ids, ids))], ["t", "bucket", "id"])

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # batches of one set, which may go on
        for b in it:
            cols = [c.to_numpy() for c in b.columns]
            if not b.num_rows:
                continue
            if held and held[-1][0][-1] != cols[0][-1]:  # another set begins here
                at = int(np.searchsorted(cols[0], cols[0][-1]))
                yield use(*(np.concatenate(x) for x in zip(*held, [c[:at] for c in cols], strict=True)))
                held, cols = [], [c[at:] for c in cols]
            held.append(cols)
        if held:
            yield use(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return shared.repartition("id").sortWithinPartitions("id").mapInArrow(go, "t long, bucket long, id long")


def _bundles(entries: DataFrame) -> DataFrame:
    """(id, root): sets that may be similar have one root. As many edges as entries."""
    hub = entries.groupBy("t", "bucket").agg(F.min("id").alias("hub"), F.max("id").alias("last"), F.count("*").alias("many")).where("hub < last").drop("last")
    edges = join_hot(entries, hub, ["t", "bucket"], "many", entries.count()).where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    return components(edges, "bundles").withColumnRenamed("v", "id")


class Trie:
    """A block of sets in a prefix tree, traversed for all sets of another block at once.

    The sets are sorted sequences of n-grams, those that most have first; equal beginnings lie side by side, so that a
    range of the sorted block is a subtree. Overlaps are a number for each probe.
    """

    def __init__(self, sets: list[np.ndarray], probes: list[np.ndarray], percent: int):
        self.percent = percent
        grams, n = np.unique(np.concatenate([*sets, *probes]), return_counts=True)
        grams, n = grams[n > 1], n[n > 1]
        order = np.lexsort((grams, -n))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))

        def ranks(s: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(grams, s), max(0, len(grams) - 1))
            return np.sort(rank[at[grams[at] == s]]) if len(grams) else np.empty(0, np.int64)

        self.seq = [ranks(s) for s in sets]
        self.size = np.array([len(s) for s in sets])
        self.sizes = np.array([len(p) for p in probes])
        mine = [ranks(p) for p in probes]
        flat = np.concatenate(mine) if mine else np.empty(0, np.int64)
        by = np.argsort(flat, kind="stable")
        self.holders = np.repeat(np.arange(len(mine)), [len(x) for x in mine])[by]  # of each n-gram, by rank
        self.starts = np.searchsorted(flat[by], np.arange(len(grams) + 1))

    def add(self, overlap: np.ndarray, run: np.ndarray) -> np.ndarray:
        if not len(run):
            return overlap
        who = np.concatenate([self.holders[self.starts[r] : self.starts[r + 1]] for r in run])
        return overlap + np.bincount(who, minlength=len(overlap))

    def links(self) -> Iterator[tuple[int, np.ndarray]]:
        """(place in the block, places of the probes that are similar), for each set of the block that has any."""
        order = sorted(range(len(self.seq)), key=lambda i: self.seq[i].tolist())
        seq = [self.seq[i] for i in order]
        lcp = [0] * len(seq)
        for i in range(1, len(seq)):
            a, b = seq[i - 1], seq[i]
            m = min(len(a), len(b))
            d = np.flatnonzero(a[:m] != b[:m])
            lcp[i] = int(d[0]) if len(d) else m
        longest, p = np.array([len(s) for s in seq]), self.percent
        lcp = np.array(lcp)
        stack = [(0, len(seq), 0, np.zeros(len(self.sizes), np.int64))]
        while stack:
            lo, hi, depth, overlap = stack.pop()
            common = int(lcp[lo + 1 : hi].min()) if hi - lo > 1 else len(seq[lo])
            overlap = self.add(overlap, seq[lo][depth:common])
            need = -(-p * (self.size[order[lo:hi]].min() + self.sizes) // (100 + p))  # the least overlap of anything below
            if not (overlap + longest[lo:hi].max() - common >= need).any():
                continue
            at = lo
            while at < hi and len(seq[at]) == common:  # sets that end here
                x = order[at]
                if len(found := np.flatnonzero(linked(overlap, self.size[x], self.sizes, p))):
                    yield x, found
                at += 1
            cuts = [at, *(at + 1 + np.flatnonzero(lcp[at + 1 : hi] == common)).tolist(), hi] if at < hi else []
            stack.extend((a, b, common, overlap) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b)


class _Union(dict):
    def root(self, x: int) -> int:
        while (up := self.setdefault(x, x)) != x:
            self[x] = x = self.setdefault(up, up)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self[max(a, b)] = min(a, b)
        return a != b


def _join_unit(rows: list[tuple[int, bool, bool, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links of a task's unit, those only that join something new. Rows: (id, whether in the tree, whether a probe, set)."""
    tree = [(i, s) for i, t, _, s in rows if t]
    probes = [(i, s) for i, _, p, s in rows if p]
    if not tree or not probes:
        return []
    union, out = _Union(), []
    for x, found in Trie([s for _, s in tree], [s for _, s in probes], percent).links():
        a = tree[x][0]
        out += [(a, b) for b in (probes[y][0] for y in found.tolist()) if a != b and union.join(a, b)]
    return out


def _units(member: DataFrame, entries: DataFrame) -> DataFrame:
    """(id, root, block, o): to which blocks ``o`` of its bundle a set is sent, its own one included.

    A bundle of many sets is cut into blocks of bounded size, like sets side by side: a set's block follows from the
    least of its entries' n-grams. A set goes where a set is with which it shares an entry, as similar sets do. For
    n-grams that are in many blocks, those blocks are paired once for all of them, not for each n-gram.
    """
    whole = member.groupBy("root").agg(F.count("*").alias("g"), F.sum("n").alias("grams"))
    whole = whole.select("root", F.ceil(F.greatest(F.col("g") / BLOCK_SETS, F.col("grams") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    cut = store(member.join(whole, "root"), "cut")
    alone = cut.where("blocks = 1").select("id", "root", F.lit(0).alias("block"), F.lit(0).alias("o"))
    large = cut.where("blocks > 1")
    keyed = store(large.join(entries.groupBy("id").agg(F.min("t").alias("key")), "id"), "keyed")
    half = keyed.groupBy("root", "key").agg(F.count("*").alias("many"), F.ceil(F.greatest(2 * F.count("*") / BLOCK_SETS, 2 * F.sum("n") / BLOCK_GRAMS)).alias("parts"))
    placed = join_hot(keyed, half, ["root", "key"], "many", cut.count())
    placed = store(placed.select("id", "root", F.pmod(F.xxhash64("key", F.pmod(F.xxhash64("id"), "parts")), "blocks").cast("int").alias("block")), "placed")
    seen = store(entries.join(placed, "id"), "seen")
    # an n-gram's sets of one bucket are of one bundle
    spread = seen.groupBy("t", "bucket", "root", "block").agg(F.count("*").alias("n")).groupBy("t", "bucket", "root").agg(F.sum("n").alias("many"), F.collect_list("block").alias("os"))
    spread = store(spread.where(F.size("os") > 1), "spread")
    total = seen.count()
    few, many = spread.where(F.size("os") <= FEW_BLOCKS), spread.where(F.size("os") > FEW_BLOCKS)
    cold = join_hot(seen, few.drop("root"), ["t", "bucket"], "many", total).select("id", "root", "block", F.explode("os").alias("o"))
    pairs = many.select("root", F.explode("os").alias("block"), "os").select("root", "block", F.explode("os").alias("o")).distinct()
    hot = join_hot(seen, many.select("t", "bucket", "many"), ["t", "bucket"], "many", total).select("id", "root", "block").distinct().join(pairs, ["root", "block"])
    own = placed.select("id", "root", "block", F.col("block").alias("o"))
    sent = store(alone.unionByName(cold.unionByName(hot.select("id", "root", "block", "o")).unionByName(own).distinct()), "sent")
    discard(cut, keyed, placed, seen, spread)
    return sent


def _links(rows: DataFrame, reps: DataFrame, bundles: DataFrame, entries: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): links between sets of a bundle, enough of them to join all that are joined."""
    member = _units(bundles.join(reps.select("id", "n"), "id"), entries)
    discard(entries)

    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, 500):
            made = [shingles(t, n).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], ["id", "s"])

    got = among(rows, member.select("id").distinct(), False, sets, "id long, s binary").dropDuplicates(["id"]).join(member, "id")
    # the unit of blocks i <= j: block i is in the tree, block j probes it
    unit = got.select("root", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "id", "s")
    parts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    unit = unit.repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j", "id")

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []
        for b in it:
            for *k, block, i, s in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k != key:
                    out += _join_unit(held, percent)
                    key, held = k, []
                held.append((i, block == k[1], block == k[2], np.frombuffer(s, np.uint64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])
                out = []
        if out := _join_unit(held, percent):
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])

    return unit.mapInArrow(go, "a long, b long")


def similar(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id_col, n_shingles, component_id) for every row: the size of its set and the least id it reaches by links.

    Texts link if 100 * intersection >= percent * union of their sets of ``words``-grams. A text with fewer words has
    one n-gram, all its words; one without words, or a null text, has none, links with nothing and is its own
    component. Rows of one id are one document. A row with a null id has a null component. An empty table gives no
    rows; extra columns take no part.
    """
    rows = pick(docs, id=id_col, text=text).withColumn("id", F.col("id").cast("long"))
    profile = store(_profile(rows, words), "profile")
    classes = profile.where("n > 0 and id is not null").groupBy("d", "n").agg(F.min("id").alias("rep"), F.count("*").alias("many"))
    classes = store(classes, "classes")
    reps = classes.select(F.col("rep").alias("id"), "n")
    member = store(join_hot(profile.where("n > 0 and id is not null"), classes, ["d", "n"], "many", profile.count()).select("id", "n", "rep", "many"), "member")
    # rows of classes with copies: those of classes of one row have no need to be told apart
    grams = store(_grams(rows.where("id is not null"), reps, member.where("many > 1").select("id"), words, percent), "grams")
    entries = store(_entries(grams, percent), "entries")
    discard(grams)
    links = _links(rows.where("id is not null"), reps, _bundles(entries), entries, words, percent)
    # several texts of one id join their classes
    same = member.where("id <> rep").groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")
    root = components(links.unionByName(same))
    named = classes.join(root, classes["rep"] == root["v"], "left").select("rep", "many", F.coalesce("root", "rep").alias("component"))
    # an id may represent several classes, whose rows are then of one component
    named = named.groupBy("rep").agg(F.min("component").alias("component"), F.sum("many").alias("many"))
    done = join_hot(member.drop("many"), named, ["rep"], "many", profile.count()).select("id", "n", "component")
    bare = profile.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
    return done.unionByName(bare).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def distinct(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, without those of a component's documents that haven't its least id.

    Of rows that share an id one stays, the least by its text's hash; rows with a null id all stay. Only rows that may
    have to go are shuffled.
    """
    names = docs.columns
    flat = docs.toDF(*(f"_{i}" for i in range(len(names))))
    found = store(similar(docs, id_col, text, words, percent).select(F.col(id_col).alias("id"), "component_id"), "similar")
    gone = found.where("component_id <> id").select("id").distinct()
    twice = found.groupBy("id").count().where("count > 1 and id is not null").select("id")
    keyed = flat.select(F.col(f"_{names.index(id_col)}").cast("long").alias("id"), F.struct(*flat.columns).alias("row"))
    doubtful = gone.unionByName(twice)
    sure = among(keyed, doubtful, other=True)
    maybe = among(keyed, doubtful).join(gone, "id", "left_anti")
    alone = maybe.join(twice, "id", "left_anti")
    one = maybe.join(twice, "id", "left_semi").groupBy("id").agg(F.min_by("row", F.xxhash64(f"row._{names.index(text)}")).alias("row"))
    return sure.unionByName(alone).unionByName(one).select("row.*").toDF(*names)
