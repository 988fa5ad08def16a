from pyspark.sql import functions as F

from seqloom.streaming import streams


def test_windows_of_a_stream_equal_the_batch(spark, sf, tmp_path):
    batch = spark.read.parquet(f"{sf}/events.parquet")
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    s = streams.source(spark, str(tmp_path / "in"), batch.schema)
    aggs = [F.count("*").alias("n")]
    got = streams.run_once(streams.tumbling(s, "ts", "1 day", ["event_type"], aggs), "tumbling", "complete")
    want = streams.tumbling(batch, "ts", "1 day", ["event_type"], aggs)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    got = streams.run_once(streams.sessions(s, "ts", "3 hours", ["user_id"], aggs), "sessions", "complete")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, streams.sessions(batch, "ts", "3 hours", ["user_id"], aggs).collect()))


def test_depth_of_a_stream(spark, tmp_path):
    rows = [(0, p, p + 5) for p in range(1, 60)] + [(0, 2000, 2001)]
    spark.createDataFrame(rows, "contig_id int, start long, end long").coalesce(1).write.parquet(str(tmp_path / "in"))
    s = streams.source(spark, str(tmp_path / "in"), "contig_id int, start long, end long")
    got = {r.pos: r.depth for r in streams.run_once(streams.position_depth(s), "depth").collect()}
    assert got == {p: sum(a <= p < b for _, a, b in rows) for p in range(1, 64)}
