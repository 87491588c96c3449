import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapehouse.operators.quality import _range_number, sequence_gaps, session_ids

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "product_id string, sequence long, time timestamp, off long"


@pytest.fixture(autouse=True)
def several_tasks(spark):
    """Small inputs stay spread over tasks, so that runs cross their borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def stream(spark, seqs, product="A", step_s=1):
    return spark.createDataFrame(
        [(product, s, T0 + dt.timedelta(seconds=i * step_s), i) for i, s in enumerate(seqs)], SCHEMA)


def gaps(df, **kw):
    out = sequence_gaps(df, order=["time", "off"], **kw)
    return sorted((r["sequence"], r["expected"], r["missing"]) for r in out.collect())


def test_backward_step_is_no_gap(spark):
    assert gaps(stream(spark, [5, 3, 4])) == []


def test_backward_then_jump(spark):
    assert gaps(stream(spark, [5, 3, 5])) == [(5, 4, 1)]


def test_simple_gap_and_null_rows_skipped(spark):
    df = stream(spark, [1, 2, None, 5, 6]).unionByName(
        spark.createDataFrame([(None, 99, T0, 100)], SCHEMA))
    assert gaps(df) == [(5, 3, 2)]


def test_gap_across_task_borders(spark):
    assert gaps(stream(spark, [1, 2, 4, 5, 9, 10, 11, 20], step_s=50)) == [(4, 3, 1), (9, 6, 3), (20, 12, 8)]


def test_gap_across_sessions_not_reported(spark):
    df = stream(spark, [1, 2, 10, 11]).withColumn("session_id", F.when(F.col("off") >= 2, 1).otherwise(0))
    assert gaps(df, session="session_id") == []
    assert gaps(df) == [(10, 3, 7)]


def _brute_gaps(df, part, order):
    w = Window.partitionBy(*part).orderBy(*order)
    b = df.where(F.col("product_id").isNotNull() & F.col("sequence").isNotNull()).withColumn(
        "prev", F.lag("sequence").over(w))
    return sorted((r["product_id"], r["off"], r["sequence"], r["prev"] + 1)
                  for r in b.where(F.col("sequence") > F.col("prev") + 1).collect())


def test_equals_single_window_with_hot_key(spark):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        p = "HOT" if rnd.random() < 0.6 else rnd.choice(["B", "C", None])
        s = None if rnd.random() < 0.05 else i + rnd.choice([0, 0, 0, 1, 2, -3])
        data.append((p, s, T0 + dt.timedelta(seconds=rnd.randint(0, 7200)), i))
    df = spark.createDataFrame(data, SCHEMA)
    for order in (["time", "off"], ["off"]):
        got = sequence_gaps(df, order=order)
        got = sorted((r["off"], r["sequence"], r["expected"]) for r in got.select(
            "off", "sequence", "expected").collect())
        assert got == sorted(x[1:] for x in _brute_gaps(df, ["product_id"], order))


def test_one_arrival_time_spreads_over_tasks(spark):
    """A backfill: one key, one ingest time. No task gets more than its share of the rows."""
    df = spark.range(40000).select(
        F.lit("A").alias("product_id"), (F.col("id") + F.floor(F.col("id") / 1000)).alias("sequence"),
        F.lit(T0).alias("time"), F.col("id").alias("off"))
    out = sequence_gaps(df, order=["time", "off"])
    assert sorted(r["off"] for r in out.collect()) == list(range(1000, 40000, 1000))
    sizes = df.groupBy(_range_number(df, ["product_id", "time", "off"]).alias("r")).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 20000


def test_many_keys_over_few_batches(spark):
    """5000 keys in small batches: runs end inside, at and across batches and tasks."""
    df = spark.range(20000).select(
        F.concat(F.lit("K"), (F.col("id") % 5000).cast("string")).alias("product_id"),
        (F.col("id") + F.when(F.col("id") % 7 == 0, 3).otherwise(0)).alias("sequence"),
        F.lit(T0).alias("time"), F.col("id").alias("off"), (F.col("id") % 11 == 0).alias("mark"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = sequence_gaps(df, order=["time", "off"], reset=F.col("mark")).select("off", "session_id", "expected")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(tuple(r) for r in got.collect()) == _brute_sessions(df, ["time", "off"])


def _brute_sessions(df, order):
    run = Window.partitionBy("product_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    s = df.withColumn("s", F.sum(F.col("mark").cast("long")).over(run)).where("sequence IS NOT NULL")
    prev = F.lag("sequence").over(Window.partitionBy("product_id", "s").orderBy(*order))
    b = s.withColumn("prev", prev).where("sequence > prev + 1 AND product_id IS NOT NULL")
    return sorted((r["off"], r["s"], r["prev"] + 1) for r in b.collect())


@pytest.mark.parametrize("seed", range(4))
def test_reset_numbers_sessions_in_the_same_pass(spark, seed):
    rnd = random.Random(seed)
    data = []
    for i in range(600):
        p = rnd.choice(["HOT"] * 6 + ["B", "C", "D", None])
        s = None if rnd.random() < 0.4 else i * 2 + rnd.choice([0, -1, -2])
        data.append((p, s, T0 + dt.timedelta(seconds=rnd.randint(0, 20)), i, rnd.random() < (0.02, 0.3)[seed % 2]))
    df = spark.createDataFrame(data, SCHEMA + ", mark boolean").repartition(3)
    order = ["time", "off"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str((2, 7, 50, 10000)[seed]))
    try:
        got = sequence_gaps(df, order=order, reset=F.col("mark"))
        numbers = {k: session_ids(df, F.col("mark"), order, key=k) for k in ("product_id", None)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["off"], r["session_id"], r["expected"]) for r in got.collect()) == _brute_sessions(df, order)
    for key, out in numbers.items():
        w = Window.partitionBy(*([key] if key else [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        expect = df.withColumn("session_id", F.sum(F.col("mark").cast("long")).over(w))
        assert out.columns == expect.columns
        assert sorted(out.collect(), key=lambda r: r["off"]) == sorted(expect.collect(), key=lambda r: r["off"])


def test_empty_feed(spark):
    df = stream(spark, [1]).where("off > 5")
    assert sequence_gaps(df, order=["time"]).count() == 0
    assert sequence_gaps(df, order=["time"], reset=F.col("off") == 0).columns == [
        "product_id", "session_id", "time", "sequence", "expected", "missing"]
    assert session_ids(df, F.col("off") == 0, ["time"]).count() == 0


def test_numeric_order_column(spark):
    df = stream(spark, [1, 2, 4, 5, 9]).drop("time")
    out = sequence_gaps(df, order=["off"])
    assert sorted((r["sequence"], r["missing"]) for r in out.collect()) == [(4, 1), (9, 3)]


def test_session_ids_match_running_sum(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["A", "B"]), i, T0 + dt.timedelta(seconds=rnd.randint(0, 3600)), i,
             "snapshot" if rnd.random() < 0.05 else "l2update") for i in range(2000)]
    df = spark.createDataFrame(data, SCHEMA + ", type string")
    w = Window.partitionBy("product_id").orderBy("time", "off").rowsBetween(Window.unboundedPreceding, 0)
    expect = sorted((r["off"], r["s"]) for r in df.withColumn(
        "s", F.sum(F.when(F.col("type") == "snapshot", 1).otherwise(0)).over(w)).collect())
    got = session_ids(df, F.col("type") == "snapshot", ["time", "off"], key="product_id")
    assert sorted((r["off"], r["session_id"]) for r in got.collect()) == expect
    glob = session_ids(df, F.col("type") == "snapshot", ["time", "off"])
    assert glob.agg(F.max("session_id")).first()[0] == df.where("type = 'snapshot'").count()


@pytest.mark.parametrize("compiled", [0, 255])
def test_range_numbers_follow_the_order(spark, monkeypatch, compiled):
    from tapehouse.operators import quality

    monkeypatch.setattr(quality, "COMPILED", compiled)
    rnd = random.Random(1)
    data = [(rnd.choice(["A", "B", None, "\u00e9"]), i, T0 + dt.timedelta(microseconds=rnd.randint(0, 50)), i) for i in range(500)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("ntz", F.col("time").cast("timestamp_ntz"))
    order = ["product_id", "ntz", "time", "off"]
    numbered = df.withColumn("r", _range_number(df, order)).orderBy(*order).select("r").collect()
    got = [r[0] for r in numbered]
    assert got == sorted(got) and set(got) == {0, 1, 2, 3}


@pytest.mark.parametrize("seed", range(3))
def test_reset_of_all_keys_equals_sessions_of_the_stream(spark, seed):
    rnd = random.Random(seed)
    data = []
    for i in range(500):
        p = rnd.choice(["HOT"] * 6 + ["B", "C", None])
        s = None if rnd.random() < 0.2 else i + rnd.choice([0, 0, 1, 3, -2])
        data.append((p, s, T0 + dt.timedelta(seconds=rnd.randint(0, (0, 20, 2000)[seed])), i, rnd.random() < (0.0, 0.02, 0.2)[seed]))
    df = spark.createDataFrame(data, SCHEMA + ", mark boolean").repartition(3)
    order = ["time", "off"]
    got = sequence_gaps(df, order=order, reset_all=F.col("mark"))
    numbered = session_ids(df, F.col("mark"), order)
    expected = sequence_gaps(numbered, order=order, session="session_id")
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    run = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    alone = df.withColumn("s", F.sum(F.col("mark").cast("long")).over(run))
    assert sorted((r["off"], r["expected"]) for r in got.collect()) == sorted(
        (x[1], x[3]) for x in _brute_gaps(alone, ["product_id", "s"], order))
