"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame functions only.

Each source's documents are permuted by a hash and cut into blocks. Its target gives its quota of blocks: whole passes
over all blocks, the blocks of a last, partial pass that fit what is left, and one block of single documents that fill
the rest. A binary tree over the output shards splits the exact quotas: at each node the left half gets a
multivariate-hypergeometric share of every source's quota. A shard draws its quota from each source's permuted blocks,
which no other shard draws, and shuffles what it has. What the mix takes of a document are the draws of its block.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, n_words, pick, store

WEIGHTS, CAP = (5, 2, 1), 3
#: A source has a block for every BLOCK_ROWS documents, LEAST_BLOCKS at least if it has four documents for each.
BLOCK_ROWS, LEAST_BLOCKS, SEED = 256, 64, 11
#: A multiple of SHARDS shards, so that each holds about SHARD_WORDS words; fewer where the table of quotas would exceed MAX_QUOTAS.
SHARDS, SHARD_WORDS, MAX_QUOTAS = 16, 1 << 27, 4_000_000
MAX_SOURCES = 100_000  # what the tree's table of quotas may hold; more is an error, not a sample
#: Tables of single documents that fill a source's rest are broadcast up to this many rows, and shuffled beyond it.
FEW = 1_000_000


def _u(*cols: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sizes`` (source, source_size) with weight and target.

    Weights go to the sources by code point, null last, over and over. Targets are in proportion to the weights and sum
    to all sizes; none exceeds ``cap`` times its source's size, what is above being shared again by weight. That is the
    level L at which the sum of min(weight * L, cap * size) is the whole: found by one pass over the sources in the
    order in which they reach their caps. There is a row for each source here, not for each document.
    """
    assert cap >= 1 and all(w > 0 for w in weights)
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.withColumn("weight", w).withColumn("_cap", cap * F.col("source_size").cast("double"))
    reach = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").isNull(), "source")
    until = reach.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    t = t.withColumn("_level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(until), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(until), F.lit(0.0))))
    # the first source that isn't full at the level that those before it leave gives the level of all
    t = t.withColumn("_turn", F.row_number().over(reach)).withColumn("_level", F.min(F.when(F.col("_cap") >= F.col("_level") * F.col("weight"), F.struct("_turn", "_level"))).over(everything)["_level"])
    return t.withColumn("target", F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("weight"), F.col("_cap")))).drop("_cap", "_level", "_turn")


def hypergeometric(rng: np.random.Generator, good: int, bad: int, take: int) -> int:
    """How many of ``take`` draws without replacement from ``good`` + ``bad`` are good: by the distribution's own terms, at any size.

    Terms are summed from the mode outwards over 40 standard deviations; what is beyond is below a double's precision.
    """
    lo, hi = max(0, take - bad), min(good, take)
    if lo == hi:
        return lo
    n = good + bad
    mode = min(max((good + 1) * (take + 1) // (n + 2), lo), hi)
    reach = 40 * (1 + math.isqrt(int(take * (good / n) * (bad / n) * ((n - take) / max(1, n - 1))) + 1))
    lo, hi = max(lo, mode - reach), min(hi, mode + reach)
    x = np.arange(lo, hi, dtype=np.float64)
    step = np.log((good - x) * (take - x)) - np.log((x + 1) * (bad - take + x + 1))
    weight = np.concatenate([[0.0], np.cumsum(step)])
    upto = np.cumsum(np.exp(weight - weight.max()))
    return lo + int(np.searchsorted(upto, rng.random() * upto[-1], "right"))


def split(quotas: dict[str, int], shards: int, seed: int = SEED) -> list[dict[str, int]]:
    """Each shard's number of blocks of each source; they sum to the quotas, and the shards' totals differ by one at most."""

    def draw(have: list[int], take: int, rng: np.random.Generator) -> list[int]:
        out, left = [0] * len(have), sum(have)
        for i, h in enumerate(have):
            if h and take:
                left -= h
                out[i] = hypergeometric(rng, h, left, take)
                take -= out[i]
        return out

    def down(have: list[int], a: int, b: int) -> list[list[int]]:
        if b - a == 1:
            return [have]
        mid = (a + b) // 2
        # the shards' totals are set before the draw: cut at whole numbers of the node's blocks, evenly by shard
        take = total * mid // shards - total * a // shards
        rng = np.random.default_rng(int.from_bytes(hashlib.sha256(f"{seed}:{a}:{b}".encode()).digest()[:8], "big"))
        left = draw(have, take, rng)
        return down(left, a, mid) + down([h - x for h, x in zip(have, left, strict=True)], mid, b)

    names = sorted(quotas)
    total = sum(quotas.values())
    return [dict(zip(names, x, strict=True)) for x in down([quotas[k] for k in names], 0, shards)]


@dataclass
class _Plan:
    """Of each source: ``info`` (k, blocks, whole, last, quota, source_size, target, tops, ends); and ``single`` (k, id, _h, copies), the documents that fill the rests."""

    size: DataFrame
    info: DataFrame
    single: DataFrame
    few: bool


def _key(source: str) -> Column:
    """Stands for the source, so that null joins too."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("~"))


def _block(seed: int) -> Column:
    return F.pmod(_u(F.col("id"), F.col("_h"), seed=seed), F.col("blocks"))


def _plan(rows: DataFrame, weights: tuple[int, ...], cap: int, shards: int | None, block_rows: int, seed: int) -> _Plan:
    size = store(rows.select("id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_h")).withColumn("k", _key("source")), "sizes")
    total = size.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")).withColumn("k", _key("source"))
    goal = targets(total, weights, cap).withColumn("blocks", F.greatest(F.ceil(F.col("rows") / block_rows), F.least(F.lit(LEAST_BLOCKS), F.ceil(F.col("rows") / 4))))
    goal = store(goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    sources = goal.limit(MAX_SOURCES + 1).count()
    if sources > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")

    # tables of a row for each source are broadcast: MAX_SOURCES, checked above, bounds them, and a join by source would
    # gather a large source in one task. Blocks are numbered in their permuted order, as a hash deals them; their words are
    # summed in two steps, first over the square root of a source's blocks, so that no task sees all of them
    dealt = size.join(F.broadcast(goal.select("k", "blocks", "rest")), "k").withColumn("block", _block(seed))
    block = dealt.groupBy("k", "block").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("blocks").alias("blocks"))
    block = store(block.withColumn("part", F.floor(F.col("block") / F.ceil(F.sqrt("blocks")))), "blocks")
    earlier = lambda *by: Window.partitionBy(*by).orderBy("part" if len(by) == 1 else "block").rowsBetween(Window.unboundedPreceding, -1)
    parts = block.groupBy("k", "part").agg(F.sum("words").alias("_w")).withColumn("_before", F.coalesce(F.sum("_w").over(earlier("k")), F.lit(0))).drop("_w")
    upto = block.join(parts, ["k", "part"]).withColumn("upto", F.col("_before") + F.coalesce(F.sum("words").over(earlier("k", "part")), F.lit(0)) + F.col("words"))
    # the last pass draws the blocks before the first that doesn't fit
    cut = upto.groupBy("k").agg(F.min(F.when(F.col("upto") > F.col("rest"), F.col("block"))).alias("_over"), F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))).alias("_drawn"))
    goal = goal.join(F.broadcast(cut), "k").withColumn("last", F.when(F.col("rest") > 0, F.coalesce("_over", "blocks")).otherwise(0)).withColumn("gap", F.when(F.col("rest") > 0, F.col("rest") - F.coalesce("_drawn", F.lit(0))).otherwise(0.0))
    goal = store(goal.drop("_over", "_drawn"), "goals")

    single, taken = _fill(size, goal, seed)
    quota = goal.join(F.broadcast(taken), "k", "left").select("k", (F.col("whole") * F.col("blocks") + F.col("last") + F.coalesce("any", F.lit(0))).alias("quota"), F.col("target"))
    found = {r["k"]: (int(r["quota"]), r["target"]) for r in quota.collect()}  # a row for each source
    if shards is None:
        words = sum(t for _, t in found.values())
        shards = max(SHARDS, min(SHARDS * math.ceil(words / (SHARDS * SHARD_WORDS)), MAX_QUOTAS // max(1, sources)))
    shard_of = rows.sparkSession.sql("select inline(from_json('" + json.dumps(_ends(split({k: q for k, (q, _) in found.items()}, shards, seed))).replace("\\", "\\\\").replace("'", "\\'") + "', 'array<struct<k:string,tops:array<bigint>,ends:array<array<bigint>>>>'))")
    info = goal.select("k", "blocks", "whole", "last", "source_size", "target").join(F.broadcast(shard_of), "k")
    few = single.limit(FEW + 1).count() <= FEW
    return _Plan(size, store(info, "quotas"), single, few)


def _fill(size: DataFrame, goal: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Documents of undrawn blocks that fill what the last pass leaves of the target: (k, id, _h, copies), and (k, any).

    One pass over a source's histogram of sizes, from the longest that fits down, taking of each as many as still fit;
    afterwards no unused document fits. Then the shortest unused one may exceed the target, if that is nearer.
    """
    near = F.broadcast(goal.where("gap > 0").select("k", "blocks", "last", "gap"))
    free = size.where("size > 0").join(near, "k").withColumn("block", _block(seed)).where((F.col("block") >= F.col("last")) & (F.col("size") < 2 * F.col("gap")))
    counts = free.groupBy("k", "size").agg(F.count("*").alias("n"), F.first("gap").alias("gap"))
    each = counts.groupBy("k").agg(F.first("gap").alias("gap"), F.sort_array(F.collect_list(F.struct("size", "n")), False).alias("sizes"))
    empty = F.expr("cast(array() as array<struct<size:bigint,take:bigint>>)")

    def step(a: Column, x: Column) -> Column:
        take = F.least(x["n"], F.floor(a["gap"] / x["size"]))
        return F.struct(
            (a["gap"] - take * x["size"]).alias("gap"),
            F.when(take > 0, F.concat(a["picks"], F.array(F.struct(x["size"].alias("size"), take.alias("take"))))).otherwise(a["picks"]).alias("picks"),
            F.when(take < x["n"], x["size"]).otherwise(a["least"]).alias("least"),
        )

    def end(a: Column) -> Column:
        over = F.coalesce(a["least"] - a["gap"] < a["gap"], F.lit(False))
        return F.when(over, F.concat(a["picks"], F.array(F.struct(a["least"].alias("size"), F.lit(1).cast("long").alias("take"))))).otherwise(a["picks"])

    picks = each.select("k", F.explode(F.aggregate("sizes", F.struct(F.col("gap").alias("gap"), empty.alias("picks"), F.lit(None).cast("long").alias("least")), step, end)).alias("p"))
    picks = store(picks.groupBy("k", F.col("p.size").alias("size")).agg(F.sum("p.take").alias("take")), "picks")
    few = picks.limit(FEW + 1).count() <= FEW
    # the first by hash of each size: among those of a block, of a part of the blocks, and of the source
    nth = lambda *by: F.row_number().over(Window.partitionBy("k", "size", *by).orderBy("order", "id", "_h")) <= F.col("take")
    free = free.join(F.broadcast(picks) if few else picks, ["k", "size"]).withColumn("order", _u(F.col("id"), F.col("_h"), seed=seed + 1)).withColumn("part", F.floor(F.col("block") / F.ceil(F.sqrt("blocks"))))
    for by in (("block",), ("part",), ()):
        free = free.withColumn("_in", nth(*by)).where("_in")
    single = store(free.groupBy("k", "id", "_h").agg(F.count("*").alias("copies")), "single")
    return single, store(picks.groupBy("k").agg(F.lit(1).alias("any")), "filled")


def _ends(by_shard: list[dict[str, int]]) -> list[dict]:
    """Of each source, the numbers at which its shards' draws end, in groups of about the root of their number, and the groups' last ones."""
    width = math.isqrt(len(by_shard)) or 1
    out = []
    for k in by_shard[0]:
        ends = np.cumsum([s[k] for s in by_shard]).tolist()
        groups = [ends[i : i + width] for i in range(0, len(ends), width)]
        out.append({"k": k, "tops": [g[-1] for g in groups], "ends": groups})
    return out


def _draws(extra: Column, seed: int) -> Column:
    """The (shard, position) of each time that a row with its source's ``info``, block and place among the documents that fill the rest is drawn.

    A draw's number in its source: passes in turn, blocks by their permuted number in each, turned from pass to pass, then
    the last pass's blocks and the filling block: the numbers below the quota, each once. The tree's ends give the shard.
    """
    c = F.col
    numbers = F.transform(
        F.when(c("whole") > 0, F.sequence(F.lit(0).cast("long"), c("whole") - 1)).otherwise(F.expr("cast(array() as array<bigint>)")),
        lambda p: p * c("blocks") + F.pmod(c("block") + p * 7919, c("blocks")),
    )
    last = F.when(c("block") < c("last"), c("whole") * c("blocks") + c("block")).when(extra, c("whole") * c("blocks") + c("last"))
    numbers = F.concat(numbers, F.when(last.isNotNull(), F.array(last.cast("long"))).otherwise(F.expr("cast(array() as array<bigint>)")))

    def shard(n: Column) -> Column:
        group = F.size(F.filter("tops", lambda e: e <= n))
        return group * F.size(c("ends")[0]) + F.size(F.filter(F.get("ends", group), lambda e: e <= n))

    return F.transform(numbers, lambda n: F.struct(shard(n).alias("shard"), F.xxhash64(F.lit(seed + 3), c("id"), c("_h"), n).alias("position")))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, shards: int | None = None, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """A row for every row of ``docs``: id, source, size, source_size, target, passes, taken, draws.

    ``size`` is the number of words (null text: 0), ``draws`` the (shard, position) of each time that the tree's quotas
    draw the document, ``passes`` their number, ``taken`` the words that they take. A source's taken words differ from its
    target by what no unused document can better. A null source is a source of its own, the last. Repeated rows are mixed
    like others; rows without words come with their blocks; an empty table gives no rows; extra columns take no part.
    ``shards``: by default 16, or so many that each holds about SHARD_WORDS words. Reruns agree.
    """
    rows = pick(docs, id=id_col, text=text, source=source)
    plan = _plan(rows, weights, cap, shards, block_rows, seed)
    at = plan.size.join(F.broadcast(plan.info), "k").withColumn("block", _block(seed))
    out = [at.withColumn("_extra", F.lit(False))]
    if not plan.single.isEmpty():
        single = F.broadcast(plan.single) if plan.few else plan.single
        # most rows are like none of those that fill a rest; of rows that are alike, as many as were taken
        mine = at["k"].eqNullSafe(plan.single["k"]) & at["id"].eqNullSafe(plan.single["id"]) & (at["_h"] == plan.single["_h"])
        out = [at.join(single, mine, "left_anti").withColumn("_extra", F.lit(False))]
        some = at.join(single.select(F.col("k").alias("_k"), F.col("id").alias("_id"), F.col("_h").alias("_t"), "copies"), F.col("k").eqNullSafe(F.col("_k")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_t")))
        out.append(some.withColumn("_extra", F.row_number().over(Window.partitionBy("k", "id", "_h").orderBy("size")) <= F.col("copies")).select(*out[0].columns))
    at = out[0] if len(out) == 1 else out[0].unionByName(out[1])
    at = at.withColumn("draws", _draws(F.col("_extra"), seed)).withColumn("passes", F.size("draws"))
    return at.select(F.col("id").alias(id_col), F.col("source").alias(source), "size", "source_size", "target", "passes", (F.col("size") * F.col("passes")).cast("long").alias("taken"), "draws")


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, shards: int | None = None, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, with all their columns, once for each draw, by shard and by position in it.

    A task holds a slice of a shard's positions, sorted; whole shards are no task's. Otherwise as ``mix``.
    """
    names = docs.columns
    flat = docs.toDF(*(f"_{i}" for i in range(len(names))))  # so that names that clash do no harm
    own = lambda c: F.col(f"_{names.index(c)}") if c in names else F.lit(None).cast("string")
    plan = _plan(pick(docs, id=id_col, text=text, source=source), weights, cap, shards, block_rows, seed)
    at = flat.withColumn("id", own(id_col)).withColumn("_h", F.xxhash64(own(text))).withColumn("_src", own(source)).withColumn("k", _key("_src"))
    at = at.join(F.broadcast(plan.info), "k").withColumn("block", _block(seed))
    drawn = at.withColumn("_d", F.explode(_draws(F.lit(False), seed)))
    if not plan.single.isEmpty():
        single = (F.broadcast(plan.single) if plan.few else plan.single).select(F.col("k").alias("_k"), F.col("id").alias("_id"), F.col("_h").alias("_t"), "copies")
        some = at.join(single, F.col("k").eqNullSafe(F.col("_k")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_t")))
        first = F.row_number().over(Window.partitionBy("k", "id", "_h").orderBy(F.xxhash64(*flat.columns))) <= F.col("copies")
        some = some.withColumn("_first", first).where("_first").withColumn("_d", F.element_at(_draws(F.lit(True), seed), -1))
        drawn = drawn.unionByName(some.select(*drawn.columns))
    parts = drawn.select(*flat.columns, F.col("_d.shard").alias("_shard"), F.col("_d.position").alias("_position")).withColumn("_slice", F.shiftrightunsigned("_position", 60))
    return parts.repartition("_shard", "_slice").sortWithinPartitions("_shard", "_slice", "_position").select(*flat.columns).toDF(*names)
