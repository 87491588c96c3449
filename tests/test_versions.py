import pytest
from pyspark.sql import functions as F

from tapehouse.plans.fixtures import events
from tapehouse.plans.layers import Lake, run_all, run_gold, run_silver_trades
from tapehouse.operators import gold
from tapehouse.sources import versions
from tapehouse.sources.lease import Busy, Lease, Lost
from tapehouse.sources.tables import scan, upsert_parquet
from tapehouse.sources.versions import Conflict, Table
from tests.test_layers import _write_bronze

CUT = "2024-01-15 00:00:00"
DDL = "k long, v string, day string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


class Died(RuntimeError):
    pass


@pytest.fixture()
def dies(monkeypatch):
    """Until ``dies.end()`` every change dies after its files are written, before it is published."""

    class Switch:
        def start(self, only=""):
            real = Table.publish

            def publish(table, base, new):
                if only in table.path:
                    raise Died(table.path)
                return real(table, base, new)

            monkeypatch.setattr(Table, "publish", publish)

        def end(self):
            monkeypatch.undo()

    return Switch()


def test_interrupted_first_loads_lose_nothing(spark, tmp_dir, dies):
    lake, ev = Lake(tmp_dir), events(spark, "/root/testdata/sf0.001")
    _write_bronze(spark, lake, ev)
    for layer in ("silver/stg_trades", "gold/gold_ohlcv"):
        dies.start(layer)
        with pytest.raises(Died):
            run_all(spark, lake)
        dies.end()
    assert Table(spark, lake.gold_ohlcv).current() is None
    run_all(spark, lake)
    assert scan(spark, lake.silver_trades).count() == ev.count()
    assert scan(spark, lake.gold_ohlcv).agg(F.sum("trade_count")).first()[0] == ev.count()


def test_interrupted_runs_between_silver_and_gold(spark, tmp_dir, dies):
    """Gold misses no day of silver versions that it never saw."""
    lake, ev = Lake(tmp_dir), events(spark, "/root/testdata/sf0.001")
    _write_bronze(spark, lake, ev.where(F.col("ts") < CUT))
    run_all(spark, lake)
    old = rows(scan(spark, lake.gold_ohlcv))
    for low, high in ((CUT, "2024-01-20"), ("2024-01-20", "2030-01-01")):
        _write_bronze(spark, lake, ev.where((F.col("ts") >= low) & (F.col("ts") < high)))
        run_silver_trades(spark, lake)
    dies.start("gold/gold_ohlcv")
    with pytest.raises(Died):
        run_gold(spark, lake)
    assert rows(scan(spark, lake.gold_ohlcv)) == old  # a reader sees the whole old version
    dies.end()
    run_gold(spark, lake)
    full = gold.ohlcv(scan(spark, lake.silver_trades), "1 minute")
    cols = ["product_id", "bucket", "open", "close", "volume", "trade_count"]
    assert rows(scan(spark, lake.gold_ohlcv).select(cols)) == rows(full.select(cols))


def test_readers_during_a_change_see_one_version(spark, tmp_dir, dies):
    path = f"{tmp_dir}/t"
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", None)], DDL)
    upsert_parquet(spark, path, first, ["k"], "day")
    reader = scan(spark, path)
    change = spark.createDataFrame([(1, "A", "y"), (2, "B", "z"), (3, "C", None), (4, "d", "x'%+ /")], DDL)
    dies.start()
    with pytest.raises(Died):
        upsert_parquet(spark, path, change, ["k"], "day")
    dies.end()
    assert rows(scan(spark, path)) == rows(first)
    upsert_parquet(spark, path, change, ["k"], "day")
    assert rows(reader) == rows(first)  # a reader that began before still has its version
    assert rows(scan(spark, path)) == rows(change)
    table = Table(spark, path)
    assert sorted(table.current().folders) == sorted(table.partition_names("day", ["y", "z", None, "x'%+ /"]))
    assert table.vacuum(keep=1) > 0 and table.vacuum(keep=1) == 0
    assert rows(scan(spark, path)) == rows(change)
    assert table.io.names(f"{path}/{versions.STAGE}") == []


def test_the_later_of_two_writers_is_refused(spark, tmp_dir):
    table = Table(spark, f"{tmp_dir}/t")
    df = spark.createDataFrame([(1, "a", "x")], DDL)
    base = table.write(df, "day")
    table.write(df.withColumn("v", F.lit("first")), "day", base)
    with pytest.raises(Conflict):
        table.write(df.withColumn("v", F.lit("second")), "day", base)
    assert [r["v"] for r in table.read().collect()] == ["first"]
    with pytest.raises(Conflict):
        table.write(df, "day")  # as a first load


def test_lease(spark, tmp_dir):
    lake = Lake(f"{tmp_dir}/lake")
    with Lease(spark, lake.root) as held:
        with pytest.raises(Busy):
            run_all(spark, lake)
        held.renew()
        held.check()
    assert run_all(spark, lake) == {}  # nothing in bronze, nothing to do
    dead = Lease(spark, lake.root, seconds=0.0)
    dead.acquire()
    with Lease(spark, lake.root):  # its time is over
        with pytest.raises(Lost):
            dead.check()
        with pytest.raises(Lost):
            dead.renew()
        dead.release()  # not its own any more
        with pytest.raises(Busy):
            Lease(spark, lake.root).acquire()
    with Lease(spark, lake.root, seconds=0.3) as kept:
        import time

        time.sleep(1.0)
        kept.check()  # renewed meanwhile
        with pytest.raises(Busy):
            Lease(spark, lake.root).acquire()


def test_a_run_that_lost_its_lease_publishes_nothing(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    lost = Lease(spark, tmp_dir, seconds=0.0)
    lost.acquire()
    df = spark.createDataFrame([(1, "a", "x")], DDL)
    with Lease(spark, tmp_dir), pytest.raises(Lost):
        upsert_parquet(spark, path, df, ["k"], "day", before=lost.check)
    assert Table(spark, path).current() is None


@pytest.fixture()
def opened(monkeypatch):
    """Partitions that were read, a list for every read."""
    found, real = [], Table.read

    def read(table, version=None, partitions=None):
        found.append(sorted(partitions) if partitions is not None else None)
        return real(table, version, partitions)

    monkeypatch.setattr(Table, "read", read)
    return found


def test_late_keys_open_their_days_only(spark, tmp_dir, opened):
    path = f"{tmp_dir}/t"
    n = versions.KEY_BLOCK
    days = [(i * n // 2 + j - 3 * n, "a", f"d{i:02d}") for i in range(12) for j in (0, 5, 11)]
    upsert_parquet(spark, path, spark.createDataFrame(days, DDL), ["k"], "day")
    opened.clear()
    # a correction that moves a stored key to another day, a late key of an old day, and a new one
    moved, late, new = days[9][0], days[12][0] + 1, 10 * n
    change = spark.createDataFrame([(moved, "m", "d07"), (late, "l", "d04"), (new, "n", "d12"), (None, "null", "d12")], DDL)
    res = upsert_parquet(spark, path, change, ["k"], "day")
    assert res.touched and set(res.touched) == {"day=d03", "day=d04", "day=d07", "day=d12"}
    looked, rewritten = opened
    assert set(looked) <= {"day=d02", "day=d03", "day=d04", "day=d05"} and len(looked) <= 4
    assert rewritten == sorted(res.touched)
    expected = [r for r in days if r[0] != moved] + [(moved, "m", "d07"), (late, "l", "d04"), (new, "n", "d12"), (None, "null", "d12")]
    assert rows(scan(spark, path)) == sorted(expected, key=str)


@pytest.mark.parametrize("key", ["k", "v"])
def test_many_upserts_equal_one_merge(spark, tmp_dir, monkeypatch, key):
    """Random corrections over several versions, with the index written anew in between; integer and text keys."""
    import random

    monkeypatch.setattr(versions, "INDEX_FOLDERS", 3)
    rnd, stored, path = random.Random(5), {}, f"{tmp_dir}/t"
    for _ in range(7):
        batch = {k: (k, f"key{k}", f"d{rnd.randrange(6)}") for k in rnd.sample(range(-200_000, 200_000, 9001), 12)}
        stored |= batch
        upsert_parquet(spark, path, spark.createDataFrame(list(batch.values()), DDL), [key], "day", cluster_by=["k"])
        assert rows(scan(spark, path)) == sorted(stored.values(), key=str)
    assert len(Table(spark, path).current().keys) <= 3 and len(Table(spark, path).current().files) <= 3


def test_a_scan_of_ranges_opens_few_files(spark, tmp_dir):
    table = Table(spark, f"{tmp_dir}/t")
    ddl = "product string, time long, day string"
    data = [(f"P{i % 20:02d}", i, f"d{i % 3} +%") for i in range(6000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    base = table.write(spark.createDataFrame(data, ddl), "day", cluster_by=["product", "time"])
    more = [("P03", 10_000, "d1 +%"), ("P04", 10_001, None)]
    table.write(
        table.read(base, table.partition_names("day", ["d1 +%"])).unionByName(spark.createDataFrame(more, ddl)), "day", base,
        table.partition_names("day", ["d1 +%", None]), cluster_by=["product", "time"],
    )
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    every = data + more
    for ranges in ({"product": ("P03", "P03")}, {"product": ("P04", "P04"), "time": (3000, None)}, {"time": (None, 5)}, {"day": ("d2", None)}, {"product": ("Z", None)}):
        got = table.scan(ranges)
        place = {"product": 0, "time": 1, "day": 2}
        fits = lambda r: all(
            r[place[c]] is not None and (low is None or r[place[c]] >= low) and (high is None or r[place[c]] <= high)
            for c, (low, high) in ranges.items()  # noqa: B023
        )
        assert rows(got) == sorted(filter(fits, every), key=str)
    files = len(table.read().inputFiles())
    assert len(table.scan({"product": ("P03", "P03")}).inputFiles()) <= files // 2


def test_a_lake_with_trades_alone(spark, tmp_dir):
    lake, ev = Lake(tmp_dir), events(spark, "/root/testdata/sf0.001")
    _write_bronze(spark, Lake(f"{tmp_dir}/both"), ev)
    spark.read.parquet(Lake(f"{tmp_dir}/both").bronze_trades).write.parquet(lake.bronze_trades)
    assert run_all(spark, lake) == {"silver_trades": ev.count()}
    assert scan(spark, lake.gold_ohlcv).agg(F.sum("trade_count")).first()[0] == ev.count()
