"""Stateful streams equal the batch operators, in any order of arrival within the lateness, and over restarts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from telequal.operators import dedup, features
from telequal.operators.panel import measure
from telequal.plans import views
from telequal.streaming import jobs, stateful

DIR = "/root/testdata/sf0.001"
LATE = "3 days"


@pytest.fixture(scope="module")
def readings(spark):
    """Twenty days of six entities with nulls; the first file holds what the second and third overtake."""
    raw = views.tele_nulled(spark, DIR).withColumn("entity", F.col("entity") % 6)
    return raw.withColumn("part", F.floor((F.unix_seconds("ts") + F.pmod(F.col("seq"), F.lit(2)) * 86_400) / (5 * 86_400))).cache()


def _arrive(df, path, part):
    rows = df.where(F.col("part") == part).drop("part")
    rows.orderBy(F.col("seq").desc()).coalesce(1).write.mode("append").parquet(path)


def _drain(stream, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
    q = writer.outputMode("append").trigger(availableNow=True).start()
    assert q.awaitTermination(240) and q.exception() is None
    return stream.sparkSession.read.parquet(out)


def _closed(df):
    last = df.agg(F.max("ts")).first()[0]
    return F.col("ts") <= F.lit(last) - F.expr(f"interval {LATE}")


def test_rolling_baseline_equals_batch_over_a_restart(spark, readings, tmp_path):
    src = str(tmp_path / "src")
    parts = sorted(r[0] for r in readings.select("part").distinct().collect())
    scored = lambda: stateful.stream_sigma_breach(
        jobs.event_time(spark.readStream.schema(readings.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(src)),
        "entity", ["ts", "seq"], "signal", LATE, 1.0,
    )
    for p in parts[:-2]:
        _arrive(readings, src, p)
    first = _drain(scored(), tmp_path).count()
    for p in parts[-2:]:
        _arrive(readings, src, p)
    got = _drain(scored(), tmp_path).toPandas().set_index("seq").sort_index()
    raw = readings.drop("part")
    base = features.rolling_baseline(raw, measure(raw, "entity", ("ts", "seq")), "signal")
    want = features.sigma_breach(base, "signal", sigmas=1.0).where(_closed(raw)).toPandas().set_index("seq").sort_index()
    assert 0 < first < len(got) and got.index.equals(want.index) and got["breach"].sum() > 0
    for c in ("base_mean", "base_std", "lower_bound"):
        assert ((got[c] - want[c]).abs().fillna(0) < 1e-9).all() and got[c].isna().equals(want[c].isna())
    assert got["breach"].tolist() == want["breach"].tolist()


def test_keep_last_equals_batch(spark, readings, tmp_path):
    src = str(tmp_path / "src")
    copies = readings.withColumn("copy", F.explode(F.array(F.lit(2), F.lit(None), F.lit(1))))
    copies = copies.withColumn("signal", F.col("signal") + F.coalesce("copy", F.lit(0)))
    for p in sorted(r[0] for r in readings.select("part").distinct().collect()):
        _arrive(copies, src, p)
    stream = jobs.event_time(spark.readStream.schema(copies.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(src))
    got = _drain(stateful.stream_keep_last(stream, "entity", "ts", ["copy", "seq"], LATE), tmp_path)
    order = [F.struct(F.col("copy").isNotNull(), "copy", "seq")]
    want = dedup.keep_last(copies.drop("part"), ["entity", "ts"], order).where(_closed(copies))
    cols = ["entity", "ts", "seq", "copy", "signal"]
    assert got.count() == want.count() > 0
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0


def test_silent_entities_are_forgotten(spark, tmp_path):
    src = str(tmp_path / "src")
    day = "timestamp'2024-01-01 00:00:00'"
    rows = spark.range(30).selectExpr("'a' AS entity", f"{day} + make_dt_interval(0, id) AS ts", "id AS seq", "double(id) AS v")
    later = spark.range(30).selectExpr("'b' AS entity", f"{day} + make_dt_interval(40, id) AS ts", "id AS seq", "double(id) AS v")
    back = spark.range(2).selectExpr("'a' AS entity", f"{day} + make_dt_interval(60, id) AS ts", "id AS seq", "100D AS v")
    end = back.selectExpr("'c' AS entity", "ts + interval 30 day AS ts", "seq", "v")
    stream = lambda: stateful.stream_rolling_baseline(
        spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src), "entity", ["ts", "seq"], "v", "1 hour", "10 days", 168, 2
    )
    for part in (rows, later, back, end):
        part.coalesce(1).write.mode("append").parquet(src)
        got = _drain(stream(), tmp_path)
    again = got.where("entity = 'a' AND v = 100").orderBy("seq").collect()
    assert [r["base_mean"] for r in again] == [100.0, 100.0] and [r["base_std"] for r in again] == [1.0, 0.0]
