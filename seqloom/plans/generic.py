"""The operators on ordinary tables: orders, line items, events, texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric
from ..operators import filters, intervals, merge, ordered
from .registry import query, table

EPOCH = "1970-01-01"


def _day(c: str):
    return F.datediff(c, F.lit(EPOCH)).cast("long")


def _micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


D_DAY = "date_diff('day', DATE '1970-01-01', CAST({} AS DATE))"


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").withColumn("day", _day("o_orderdate"))


@query(
    "depth_prefix_sum",
    f"""
WITH o AS (SELECT o_orderstatus AS k, {D_DAY.format('o_orderdate')} AS s FROM orders),
e AS (SELECT k, s AS p, 1 AS d FROM o UNION ALL SELECT k, s + 7, -1 FROM o),
g AS (SELECT k, p, sum(d) AS d FROM e GROUP BY k, p),
r AS (SELECT k, p, sum(d) OVER (PARTITION BY k ORDER BY p) AS depth, lead(p) OVER (PARTITION BY k ORDER BY p) AS q FROM g)
SELECT k, p AS start, q AS "end", CAST(depth AS BIGINT) AS depth FROM r WHERE depth > 0""",
)
def depth_prefix_sum(spark, d):
    return intervals.depth(_orders(spark, d).select(F.col("o_orderstatus").alias("k"), F.col("day").alias("start"), (F.col("day") + 7).alias("end")), ["k"])


@query(
    "depth_per_position",
    f"""
WITH o AS (SELECT o_orderpriority AS k, {D_DAY.format('o_orderdate')} AS s FROM orders),
p AS (SELECT k, unnest(range(s, s + 3)) AS pos FROM o)
SELECT k, pos, count(*) AS depth FROM p GROUP BY k, pos""",
)
def depth_per_position(spark, d):
    o = _orders(spark, d).select(F.col("o_orderpriority").alias("k"), F.col("day").alias("start"), (F.col("day") + 3).alias("end"))
    return intervals.depth_per_position(o, ["k"])


@query(
    "gaps_islands",
    f"""
WITH e AS (SELECT DISTINCT user_id, {D_DAY.format('ts')} AS pos FROM events),
g AS (SELECT user_id, pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS g FROM e)
SELECT user_id, min(pos) AS "first", max(pos) AS "last", count(*) AS n FROM g GROUP BY user_id, g""",
)
def gaps_islands(spark, d):
    return intervals.islands(table(spark, d, "events").select("user_id", _day("ts").alias("pos")), ["user_id"])


_COALESCE = """
WITH e AS (SELECT user_id, epoch_us(ts) AS s, epoch_us(ts) + 900000000 AS t FROM events),
m AS (SELECT *, max(t) OVER (PARTITION BY user_id ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM e),
i AS (SELECT *, sum(CASE WHEN seen IS NULL OR s > seen + {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, t ROWS UNBOUNDED PRECEDING) AS isl FROM m)
SELECT user_id, min(s) AS start, max(t) AS "end", count(*) AS n FROM i GROUP BY user_id, isl"""


def _spans(spark, d):
    return table(spark, d, "events").select("user_id", _micros("ts").alias("start")).withColumn("end", F.col("start") + 900_000_000)


@query("interval_coalesce", _COALESCE.format(gap=0))
def interval_coalesce(spark, d):
    return intervals.coalesce(_spans(spark, d), ["user_id"])


@query("interval_coalesce_gap", _COALESCE.format(gap=7_200_000_000))
def interval_coalesce_gap(spark, d):
    return intervals.coalesce(_spans(spark, d), ["user_id"], gap=7_200_000_000)


_WINDOWS = f"o AS (SELECT o_orderkey AS l_orderkey, {D_DAY.format('o_orderdate')} + 30 AS s, {D_DAY.format('o_orderdate')} + 60 AS t FROM orders)"
_POINTS = f"l AS (SELECT l_orderkey, l_linenumber, l_linestatus, {D_DAY.format('l_shipdate')} AS pos FROM lineitem)"


def _points(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", _day("l_shipdate").alias("pos"))


def _windows(spark, d):
    return _orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), (F.col("day") + 30).alias("begin"), (F.col("day") + 60).alias("end"))


@query("interval_semi_join", f"WITH {_WINDOWS}, {_POINTS} SELECT * FROM l WHERE EXISTS (SELECT 1 FROM o WHERE o.l_orderkey = l.l_orderkey AND l.pos BETWEEN o.s AND o.t)")
def interval_semi_join(spark, d):
    return intervals.point_in_intervals(_points(spark, d), _windows(spark, d), ["l_orderkey"])


@query("interval_anti_join", f"WITH {_WINDOWS}, {_POINTS} SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.l_orderkey = l.l_orderkey AND l.pos BETWEEN o.s AND o.t)")
def interval_anti_join(spark, d):
    return intervals.point_in_intervals(_points(spark, d), _windows(spark, d), ["l_orderkey"], inside=False)


_PAIRS = """
WITH a AS (SELECT event_id, user_id, epoch_us(ts) AS s, epoch_us(ts) + 1800000000 AS t FROM events WHERE event_type = 'purchase'),
b AS (SELECT event_id AS r_id, user_id, epoch_us(ts) AS r_start, epoch_us(ts) + 3600000000 AS r_end FROM events WHERE event_type = 'click')
"""


def _halves(spark, d):
    e = table(spark, d, "events").withColumn("start", _micros("ts"))
    a = e.where("event_type = 'purchase'").select("event_id", "user_id", "start", (F.col("start") + 1_800_000_000).alias("end"))
    b = e.where("event_type = 'click'").select(F.col("event_id").alias("r_id"), "user_id", F.col("start").alias("r_start"), (F.col("start") + 3_600_000_000).alias("r_end"))
    return a, b


@query("interval_join", _PAIRS + "SELECT event_id, r_id FROM a JOIN b ON a.user_id = b.user_id AND a.s < b.r_end AND b.r_start < a.t")
def interval_join(spark, d):
    a, b = _halves(spark, d)
    return intervals.interval_join(a, b, ["user_id"], width=3_600_000_000).select("event_id", "r_id")


@query("interval_join_semi", _PAIRS + "SELECT event_id FROM a WHERE EXISTS (SELECT 1 FROM b WHERE a.user_id = b.user_id AND a.s < b.r_end AND b.r_start < a.t)")
def interval_join_semi(spark, d):
    a, b = _halves(spark, d)
    return intervals.interval_join(a, b, ["user_id"], width=3_600_000_000, how="left_semi").select("event_id")


@query("interval_join_anti", _PAIRS + "SELECT event_id FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.user_id = b.user_id AND a.s < b.r_end AND b.r_start < a.t)")
def interval_join_anti(spark, d):
    a, b = _halves(spark, d)
    return intervals.interval_join(a, b, ["user_id"], width=3_600_000_000, how="left_anti").select("event_id")


@query(
    "asof_forward_tol",
    """
WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS tm FROM events),
p AS (SELECT DISTINCT user_id, epoch_us(ts) AS q FROM events WHERE event_type = 'purchase'),
j AS (SELECT e.event_id, e.user_id, e.tm, min(p.q) AS next_at FROM e JOIN p ON e.user_id = p.user_id AND p.q >= e.tm GROUP BY ALL)
SELECT * FROM j WHERE next_at - tm < 22000000000""",
)
def asof_forward_tol(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", _micros("ts").alias("tm"), "event_type")
    return intervals.asof_forward(e.drop("event_type"), e.where("event_type = 'purchase'"), ["user_id"], "tm", 22_000_000_000)


@query(
    "mean_span_depth",
    f"""
WITH o AS (SELECT o_custkey AS k, {D_DAY.format('o_orderdate')} AS s, {D_DAY.format('o_orderdate')} + 5 AS t FROM orders),
m AS (SELECT *, max(t) OVER (PARTITION BY k ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM o),
i AS (SELECT *, sum(CASE WHEN seen IS NULL OR s > seen + 3 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY s, t ROWS UNBOUNDED PRECEDING) AS isl FROM m),
c AS (SELECT k, max(t) - min(s) AS span, sum(t - s) AS bases FROM i GROUP BY k, isl)
SELECT k, CAST(sum(bases) AS DOUBLE) / sum(span) AS depth FROM c GROUP BY k""",
)
def mean_span_depth(spark, d):
    o = _orders(spark, d).select(F.col("o_custkey").alias("k"), F.col("day").alias("start"), (F.col("day") + 5).alias("end"))
    return intervals.mean_span_depth(o, ["k"], gap=3)


@query(
    "fill_gaps",
    f"""
WITH e AS (SELECT DISTINCT user_id, {D_DAY.format('ts')} AS pos FROM events),
r AS (SELECT user_id, unnest(range(min(pos), max(pos) + 1)) AS pos FROM e GROUP BY user_id)
SELECT r.user_id, r.pos FROM r ANTI JOIN e ON r.user_id = e.user_id AND r.pos = e.pos""",
)
def fill_gaps(spark, d):
    return intervals.fill_gaps(table(spark, d, "events").select("user_id", _day("ts").alias("pos")), ["user_id"])


@query(
    "session_gap",
    """
WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS tm FROM events),
f AS (SELECT *, CASE WHEN tm - lag(tm) OVER (PARTITION BY user_id ORDER BY tm) > 10800000000 THEN 1 ELSE 0 END AS n FROM e)
SELECT event_id, user_id, CAST(1 + sum(n) OVER (PARTITION BY user_id ORDER BY tm RANGE UNBOUNDED PRECEDING) AS BIGINT) AS session FROM f""",
)
def session_gap(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", _micros("ts").alias("at"))
    return intervals.sessions(e, ["user_id"], "at", 10_800_000_000).select("event_id", "user_id", "session")


@query(
    "priority_merge",
    """
WITH a AS (SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000),
b AS (SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders WHERE o_orderstatus = 'O')
SELECT o_custkey, o_orderkey, o_orderpriority, 1 AS source FROM a WHERE n = 1
UNION ALL SELECT o_custkey, o_orderkey, o_orderpriority, 2 FROM b WHERE n = 1 AND o_custkey NOT IN (SELECT o_custkey FROM a)""",
)
def priority_merge(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    got = merge.priority_merge(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_totalprice") > 250000)
    return got.select("o_custkey", "o_orderkey", "o_orderpriority", "source")


@query(
    "equi_depth_cuts",
    f"""
WITH c AS (SELECT l_returnflag, {D_DAY.format('l_shipdate')} AS cut, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, sum(n) OVER (PARTITION BY l_returnflag ORDER BY cut) AS upto FROM c)
SELECT l_returnflag, cut, CAST(upto AS BIGINT) AS upto FROM r WHERE upto > 1000 AND floor((upto - 1) / 1000) > floor((greatest(upto - n, 1) - 1) / 1000)""",
)
def equi_depth_cuts(spark, d):
    return ordered.equi_depth_cuts(table(spark, d, "lineitem").select("l_returnflag", _day("l_shipdate").alias("at")), ["l_returnflag"], "at", 1000).select("l_returnflag", F.col("cut"), "upto")


@query("range_chunks", "WITH m AS (SELECT max(p_partkey) AS m FROM part) SELECT (p_partkey - 1) // (m // 16) AS segment, count(*) AS n, min(p_partkey) AS least, max(p_partkey) AS most FROM part, m WHERE p_partkey >= 1 GROUP BY 1")
def range_chunks(spark, d):
    part = table(spark, d, "part")
    longest = part.agg(F.max("p_partkey")).first()[0]
    # halvings from one chunk: 32 wanted gives 32 or more, doubled once
    size = longest // 16
    return part.where("p_partkey >= 1").groupBy(F.floor((F.col("p_partkey") - 1) / size).alias("segment")).agg(F.count("*").alias("n"), F.min("p_partkey").alias("least"), F.max("p_partkey").alias("most"))


@query(
    "median_nonzero",
    f"""
WITH days AS (SELECT user_id, {D_DAY.format('ts')} AS day, count(*) FILTER (event_type = 'purchase') AS n FROM events GROUP BY 1, 2)
SELECT user_id, median(n) AS median FROM days WHERE n <> 0 GROUP BY user_id""",
)
def median_nonzero(spark, d):
    days = table(spark, d, "events").groupBy("user_id", _day("ts").alias("day")).agg(F.count_if(F.col("event_type") == "purchase").alias("n"))
    return ordered.median_nonzero(days, ["user_id"], "n")


@query(
    "summary_stats",
    """
SELECT l_returnflag, l_linestatus, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(var_samp(l_quantity), 6) AS variance, round(stddev_samp(l_quantity), 6) AS sd, round(stddev_samp(l_quantity) / sqrt(count(l_quantity)), 6) AS stderr,
  min(l_quantity) AS least, max(l_quantity) AS most, round(sqrt(avg(l_quantity * l_quantity)), 6) AS rms, round(avg(CAST(l_quantity = 0 AS INT)), 6) AS zero_fraction
FROM lineitem GROUP BY 1, 2""",
)
def summary_stats(spark, d):
    s = ordered.summary(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")
    return s.withColumns({c: F.round(c, 6) for c in ("mean", "variance", "sd", "stderr", "rms", "zero_fraction")})


@query(
    "ranksum_z",
    """
WITH e AS (SELECT user_id, value, event_type = 'purchase' AS b FROM events WHERE event_type IN ('purchase', 'view')),
r AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY user_id, value) - 1) / 2.0 AS r FROM e WINDOW w AS (PARTITION BY user_id ORDER BY value)),
s AS (SELECT user_id, count(*) FILTER (NOT b) AS n1, count(*) FILTER (b) AS n2, coalesce(sum(r) FILTER (NOT b), 0) AS ra, coalesce(sum(r) FILTER (b), 0) AS rb FROM r GROUP BY user_id)
SELECT user_id, n1, n2, round(CASE WHEN n1 * n2 = 0 THEN 0 WHEN ra < rb THEN (ra - n1 * (n1 + n2 + 1) / 2.0) / sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0) ELSE (rb - n2 * (n1 + n2 + 1) / 2.0) / sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0) END, 6) AS z FROM s""",
)
def ranksum_z(spark, d):
    e = table(spark, d, "events").where("event_type in ('purchase', 'view')")
    return ordered.rank_sum(e, ["user_id"], "value", F.col("event_type") == "purchase").withColumn("z", F.round("z", 6))


@query(
    "moving_avg_nulls",
    """
WITH e AS (SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
SELECT event_id, round(avg(v) OVER w, 6) AS avg, count(v) OVER w AS avg_n, count(*) FILTER (v > 50) OVER w AS recent FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS 2 PRECEDING)""",
)
def moving_avg_nulls(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    m = ordered.moving_average(e, ["user_id"], ["event_id"], "v", 3)
    return ordered.recent_true(m, ["user_id"], ["event_id"], F.col("v") > 50, 3).select("event_id", F.round("avg", 6).alias("avg"), "avg_n", "recent")


@query(
    "cluster_flag",
    "SELECT event_id, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 3600000000 THEN 1 ELSE 0 END AS cls FROM events",
)
def cluster_flag(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", _micros("ts").alias("at"))
    return ordered.cluster_flag(e, ["user_id"], "at", 3_600_000_000).select("event_id", "cls")


@query(
    "dedup_best",
    "SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY (o_orderpriority = '1-URGENT') DESC, o_totalprice DESC, o_orderkey) = 1",
)
def dedup_best(spark, d):
    got = merge.best_of_equal(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"], [(F.col("o_orderpriority") == "1-URGENT").desc(), F.desc("o_totalprice"), F.col("o_orderkey")])
    return got.select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")


@query(
    "topk_ratio",
    """
WITH s AS (SELECT p_brand, l_suppkey, round(sum(l_quantity), 2) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY q DESC, l_suppkey) AS rank, max(q) OVER (PARTITION BY p_brand) AS best FROM s)
SELECT p_brand, l_suppkey, q, rank FROM r WHERE rank = 1 OR (rank <= 5 AND q >= best * 0.9)""",
)
def topk_ratio(spark, d):
    s = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "l_suppkey").agg(F.round(F.sum("l_quantity"), 2).alias("q"))
    return ordered.top_by_ratio(s, ["p_brand"], "q", 5, 0.9, ["l_suppkey"])


@query(
    "filter_labels",
    """
SELECT l_orderkey, l_linenumber, CASE WHEN len(f) = 0 THEN 'PASS' ELSE array_to_string(f, ';') END AS filter FROM (
  SELECT l_orderkey, l_linenumber, list_filter([CASE WHEN l_quantity < 5 THEN 'LowQ' END, CASE WHEN l_discount > 0.08 THEN 'HighDisc' END, CASE WHEN l_tax = 0 THEN 'NoTax' END], lambda x: x IS NOT NULL) AS f FROM lineitem)""",
)
def filter_labels(spark, d):
    f = filters.labels(LowQ=F.col("l_quantity") < 5, HighDisc=F.col("l_discount") > 0.08, NoTax=F.col("l_tax") == 0)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", filters.filter_text(f).alias("filter"))


@query(
    "shared_filters",
    """
WITH f AS (SELECT DISTINCT l_orderkey, l_linenumber, unnest(list_filter([CASE WHEN l_quantity < 25 THEN 'LowQ' END, CASE WHEN l_discount > 0.04 THEN 'HighDisc' END], lambda x: x IS NOT NULL)) AS f FROM lineitem),
n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1), k AS (SELECT l_orderkey, f, count(*) AS k FROM (SELECT l_orderkey, unnest(list_filter([CASE WHEN l_quantity < 25 THEN 'LowQ' END, CASE WHEN l_discount > 0.04 THEN 'HighDisc' END], lambda x: x IS NOT NULL)) AS f FROM lineitem) GROUP BY 1, 2)
SELECT n.l_orderkey, coalesce(array_to_string(list_sort(list(f) FILTER (k = n)), ';'), '') AS filter FROM n LEFT JOIN k USING (l_orderkey) GROUP BY 1""",
)
def shared_filters(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", filters.labels(LowQ=F.col("l_quantity") < 25, HighDisc=F.col("l_discount") > 0.04).alias("filters"))
    return filters.shared_filters(rows, ["l_orderkey"]).select("l_orderkey", F.array_join("filters", ";").alias("filter"))


@query(
    "pr_curve",
    """
WITH s AS (SELECT floor(n_chars / 100) AS score, quality = 1 AS t FROM documents JOIN labels USING (doc_id)),
g AS (SELECT score, count(*) FILTER (t) AS t, count(*) FILTER (NOT t) AS f FROM s GROUP BY score),
c AS (SELECT score, sum(t) OVER w AS tp, sum(f) OVER w AS fp, sum(t) OVER () AS n FROM g WINDOW w AS (ORDER BY score DESC))
SELECT CAST(score AS BIGINT) AS score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / (tp + fp), 9) AS precision, round(tp / n, 9) AS recall FROM c""",
)
def pr_curve(spark, d):
    s = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select(F.floor(F.col("n_chars") / 100).alias("score"), "quality")
    return ordered.precision_recall(s, "score", F.col("quality") == 1).withColumns({c: F.round(c, 9) for c in ("precision", "recall")})


@query("calibration_bins", "SELECT least(CAST(floor(l_discount * 10 * 10) AS BIGINT), 9) AS bin, count(*) AS n, round(avg(l_discount * 10), 6) AS mean_score, round(avg(CAST(l_returnflag = 'R' AS INT)), 6) AS observed FROM lineitem GROUP BY 1")
def calibration_bins(spark, d):
    rows = table(spark, d, "lineitem").withColumn("score", F.col("l_discount") * 10)
    return ordered.calibration(rows, "score", F.col("l_returnflag") == "R").withColumns({c: F.round(c, 6) for c in ("mean_score", "observed")})


@query(
    "log_compress",
    "WITH v AS (SELECT CAST(l_extendedprice AS BIGINT) AS x FROM lineitem), u AS (SELECT x, CAST(pow(2, greatest(length(bin(x)) - 3, 0)) AS BIGINT) AS u FROM v) SELECT CASE WHEN u > 1 THEN x // u * u + u // 2 ELSE x END AS value, count(*) AS n FROM u GROUP BY 1",
)
def log_compress(spark, d):
    # both engines round halves of doubles to longs differently; floor first, then cast
    return ordered.compressed_histogram(table(spark, d, "lineitem").select(F.round("l_extendedprice").cast("long").alias("x")), "x", 3)


@query(
    "phred_math",
    """
WITH p AS (SELECT l_orderkey, l_linenumber, l_discount + l_tax / 10 + 0.0001 AS p, CAST(l_quantity AS INT) AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(floor(-10 * log10(greatest(p, 1e-307)) + 0.5) AS INT) AS q_of_p, round(pow(10, -q / 10.0), 9) AS p_of_q, round(ln(exp(p) + exp(2 * p)), 9) AS ls,
  round(CASE WHEN q <= 80 THEN (1 - pow(10, -greatest(q, 5) / 10.0)) * p + 0.75 * pow(10, -greatest(q, 5) / 10.0) ELSE p END, 9) AS adjusted FROM p""",
)
def phred_math(spark, d):
    p = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") + F.col("l_tax") / 10 + 0.0001).alias("p"), F.col("l_quantity").cast("int").alias("q"))
    c = F.col
    return p.select("l_orderkey", "l_linenumber", numeric.phred_int(c("p")).alias("q_of_p"), F.round(numeric.error_prob(c("q")), 9).alias("p_of_q"), F.round(numeric.log_sum(c("p"), 2 * c("p")), 9).alias("ls"), F.round(numeric.mapping_adjusted_error(c("p"), c("q")), 9).alias("adjusted"))


@query(
    "alt_argmax",
    """
WITH g AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS c, count(*) FILTER (l_returnflag = 'R') AS t, count(*) FILTER (l_linestatus = 'O') // 2 AS g, substr('ACGT', 1 + CAST(l_suppkey % 4 AS INT), 1) AS ref FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, ref, CASE ref
  WHEN 'A' THEN CASE WHEN t > greatest(c, g) THEN 'T' WHEN c > g THEN 'C' ELSE 'G' END
  WHEN 'C' THEN CASE WHEN t > greatest(a, g) THEN 'T' WHEN a > g THEN 'A' ELSE 'G' END
  WHEN 'T' THEN CASE WHEN g > greatest(a, c) THEN 'G' WHEN a > c THEN 'A' ELSE 'C' END
  ELSE CASE WHEN t > greatest(a, c) THEN 'T' WHEN a > c THEN 'A' ELSE 'C' END END AS alt FROM g""",
)
def alt_argmax(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_suppkey").agg(*(F.count_if(F.col("l_returnflag") == v).alias(k) for k, v in (("a", "A"), ("c", "N"), ("t", "R"))), F.floor(F.count_if(F.col("l_linestatus") == "O") / 2).alias("g"))
    g = g.withColumn("ref", F.substr(F.lit("ACGT"), (F.col("l_suppkey") % 4 + 1).cast("int"), F.lit(1)))
    return g.select("l_suppkey", "ref", numeric.best_alt(*(F.col(k) for k in ("ref", "a", "c", "t", "g"))).alias("alt"))


@query("most_frequent", "SELECT o_custkey, o_orderpriority, n FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1")
def most_frequent(spark, d):
    return ordered.most_frequent(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority")


@query(
    "best_of_k_per_group",
    "SELECT c_nationkey, c_custkey, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer QUALIFY rank <= 3",
)
def best_of_k_per_group(spark, d):
    return ordered.top_by_ratio(table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], "c_acctbal", 3, -1e9, ["c_custkey"])


@query("adaptive_take", "WITH o AS (SELECT o_orderkey, o_totalprice, coalesce(sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM orders) SELECT o_orderkey FROM o WHERE b < 50000000.5")
def adaptive_take(spark, d):
    return ordered.adaptive_take(table(spark, d, "orders"), ["o_orderdate", "o_orderkey"], "o_totalprice", 50_000_000.5).select("o_orderkey")


@query("sequential_ids", "SELECT p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS id FROM (SELECT DISTINCT p_brand FROM part)")
def sequential_ids(spark, d):
    return ordered.sequential_ids(table(spark, d, "part"), "p_brand")


@query("set_difference", "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def set_difference(spark, d):
    o = table(spark, d, "orders")
    return o.where("o_orderstatus = 'F'").select("o_custkey").subtract(o.where("o_orderstatus = 'O'").select("o_custkey"))


@query("ordered_union", "SELECT o_orderkey AS k, o_orderdate AS at, 0 AS _stream FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT l_orderkey, l_shipdate, 1 FROM lineitem WHERE l_returnflag = 'R'")
def ordered_union(spark, d):
    a = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("at"))
    b = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("at"))
    return merge.ordered_union([a, b], ["k"], ["at"])
