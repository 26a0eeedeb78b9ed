"""Streaming results equal the batch results on the same files."""

from __future__ import annotations

from pyspark.sql import functions as F

from telequal.operators import features
from telequal.operators.panel import measure
from telequal.plans import views
from telequal.streaming import jobs

DIR = "/root/testdata/sf0.001"


def _stream(spark, tmp_path, name="events"):
    """The events as three files, in time order."""
    src = str(tmp_path / name)
    raw = views.tele(spark, DIR)
    for i in range(3):
        raw.where(F.pmod(F.dayofyear("ts"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(src)
    return raw, jobs.event_time(spark.readStream.schema(raw.schema).parquet(src))


def _run(df, name, tmp_path, mode="append"):
    q = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / f"ck-{name}")).trigger(availableNow=True).start()
    )
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def test_dedup_keeps_one_row_per_key(spark, tmp_path):
    raw, _ = _stream(spark, tmp_path)
    src = str(tmp_path / "twice")
    raw.unionByName(raw).coalesce(1).write.parquet(src)
    stream = jobs.event_time(spark.readStream.schema(raw.schema).parquet(src))
    got = _run(jobs.stream_dedup(stream, "entity", "ts", "40 days"), "dedup", tmp_path)
    assert got.count() == raw.select("entity", "ts").distinct().count()


def test_rollup_equals_batch_for_closed_hours(spark, tmp_path):
    raw = views.tele(spark, DIR)
    src = str(tmp_path / "one")
    raw.coalesce(1).write.parquet(src)
    stream = jobs.event_time(spark.readStream.schema(raw.schema).parquet(src))
    got = _run(jobs.stream_hourly_rollup(stream, "entity", "ts", "signal"), "rollup", tmp_path)
    want = raw.groupBy("entity", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count("signal").alias("n"), F.min("signal").alias("low"), F.max("signal").alias("high")
    )
    last = raw.agg(F.max("ts")).first()[0]
    closed = want.where(F.col("hour") + F.expr("interval 3 hours") <= F.lit(last))
    have = got.select("entity", "hour", "n", "low", "high")
    assert 0 < closed.count() == have.count()
    assert have.exceptAll(closed).count() == 0


def test_sliding_windows_overlap(spark, tmp_path):
    raw, stream = _stream(spark, tmp_path)
    got = _run(
        jobs.stream_hourly_rollup(stream, "entity", "ts", "signal", "40 days", "30 minutes"), "slide", tmp_path, "complete"
    )
    assert got.agg(F.sum("n")).first()[0] == 2 * raw.count()


def test_breach_scoring_equals_batch(spark, tmp_path):
    raw, stream = _stream(spark, tmp_path)
    scored = features.rolling_baseline(raw, measure(raw, "entity", ("ts", "seq")), "signal")
    base = jobs.latest_baseline(scored, "entity", ["ts", "seq"])
    out = str(tmp_path / "out")
    score = lambda b: jobs.stream_breaches(b, base, "entity", "signal", 1.0).select("seq", "breach")
    q = jobs.start_scoring(stream, score, out, str(tmp_path / "ck")).start()
    q.awaitTermination(180)
    assert q.exception() is None
    have = spark.read.parquet(out).select("seq", "breach")
    want = jobs.stream_breaches(raw, base, "entity", "signal", 1.0).select("seq", "breach")
    assert have.count() == raw.count()
    assert have.exceptAll(want).count() == 0
    assert want.agg(F.sum("breach")).first()[0] > 0
