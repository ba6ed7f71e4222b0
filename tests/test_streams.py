"""Streams to their end: merged tables, neighbour elimination with timers, windows and sessions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rollcall.operators import dedupe
from rollcall.streaming import merge, stateful

T0 = datetime(2024, 1, 1)


def rows_at(spark, rows):
    return spark.createDataFrame([(k, T0 + timedelta(seconds=s), float(v), o) for k, s, v, o in rows], "k string, at timestamp, v double, o long")


def put(spark, folder, rows):
    rows_at(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema("k string, at timestamp, v double, o long").option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, tmp_path, form, close=False):
    df = form(stateful.with_end(stream(spark, str(tmp_path / "in")), str(tmp_path / "marks"), "at", "60 seconds"))
    if close:
        stateful.mark_end(spark, str(tmp_path / "marks"), "at")
    with stateful.rocks(spark):
        query = stateful.drain(df, str(tmp_path / "out"), str(tmp_path / "state"))
    return query, sorted(tuple(r) for r in spark.read.schema(df.schema).parquet(str(tmp_path / "out")).collect())


def test_neighbours_equal_the_batch_fold_on_all_rows(spark, tmp_path):
    rng = random.Random(8)
    rows = sorted(((rng.choice("ab"), rng.randint(0, 900) / 2, rng.randint(0, 5), o) for o in range(250)), key=lambda r: r[1])
    form = lambda df: stateful.neighbours(df, "k", "at", "v", "o", 5)
    for at in range(0, 240, 80):  # rows of a file come in any order
        put(spark, str(tmp_path / "in"), rng.sample(rows[at : at + 80], 80))
    run(spark, tmp_path, form)
    put(spark, str(tmp_path / "in"), rows[240:])
    query, before = run(spark, tmp_path, form)  # a restart from the checkpoint
    assert stateful.late_rows(query) == 0
    put(spark, str(tmp_path / "in"), [("a", 0, 1, 900), ("b", 1, 1, 901)])
    query, _ = run(spark, tmp_path, form)
    assert stateful.late_rows(query) == 2
    query, got = run(spark, tmp_path, form, close=True)
    flat = rows_at(spark, rows).withColumn("us", F.unix_micros("at"))
    want = sorted((r.k, r.o) for r in dedupe.adjacent_fold(flat, ["k"], "us", "v", "o", 5_000_000).collect())
    assert got == want and len(before) < len(want)


def test_rows_of_a_key_are_dealt_by_time(spark, tmp_path):
    """Chains that run on through all buckets, broken ones, and a bucket that comes in several files, part of it after the others."""
    rng = random.Random(3)
    rows = [("same", 3 * k, 1, k) for k in range(1000)] + [("falls", 4 * k, -k, 1000 + k) for k in range(700)] + [("pairs", 299 + 300 * k + s, k % 3, 1700 + 2 * k + s) for k in range(8) for s in (0, 2)]
    rows += [("any", rng.choice([rng.randint(0, 6000) / 2, 300 * rng.randint(0, 9)]), rng.randint(0, 2), 2000 + k) for k in range(900)]
    rows += [("far", 300 * stateful.SLOTS * k + s, 1, 3000 + 2 * k + s) for k in range(2) for s in (0, 1)]  # of one slot
    form = lambda df: stateful.neighbours(df, "k", "at", "v", "o", 5)
    place = {r[3]: at for at, r in enumerate(sorted(rows, key=lambda r: r[1] + rng.randint(0, 59)))}
    timers = lambda q: max(s["customMetrics"].get("numRegisteredTimers", 0) for p in q.recentProgress for s in p["stateOperators"])
    for at in (0, 1400):  # the second run finds open buckets
        put(spark, str(tmp_path / "in"), [r for r in rows if (place[r[3]] < 1400) == (at == 0)])
        query, _ = run(spark, tmp_path, form)
        assert stateful.late_rows(query) == 0 and timers(query) > 12  # a key's rows wait in several groups
    _, got = run(spark, tmp_path, form, close=True)
    flat = rows_at(spark, rows).withColumn("us", F.unix_micros("at"))
    want = sorted((r.k, r.o) for r in dedupe.adjacent_fold(flat, ["k"], "us", "v", "o", 5_000_000).collect())
    assert got == want and ("same", 998) in got and ("same", 999) not in got


def test_many_small_stores_set_no_disk_aside(spark):
    name = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
    with stateful.rocks(spark):
        assert spark.conf.get(name) == "false" and spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
    assert spark.conf.get(name, None) is None


def test_sessions_and_windows_are_all_closed(spark, tmp_path):
    rows = [("a", 0, 1, 1), ("a", 50, 1, 2), ("a", 200, 1, 3), ("b", 10, 1, 4), ("a", 70, 1, 5)]
    put(spark, str(tmp_path / "in"), rows[:4])
    put(spark, str(tmp_path / "in"), [("b", 260, 1, 6), *rows[4:]])
    form = lambda df: stateful.sessions(df, "at", "60 seconds", "k")
    _, before = run(spark, tmp_path, form)
    _, got = run(spark, tmp_path, form, close=True)
    at = lambda s: T0 + timedelta(seconds=s)
    kept = [("a", at(0), at(130), 3), ("a", at(200), at(260), 1), ("b", at(10), at(70), 1), ("b", at(260), at(320), 1)]
    late = [("a", at(0), at(110), 2), *kept[1:]]  # row 5 may come after its time, as files have no order
    assert got in (kept, late) and len(before) < 4


@pytest.fixture
def table(spark, tmp_path):
    return merge.MergedTable(spark, str(tmp_path / "t"), ["k"], "o", 4)


def held(table):
    return sorted((r.k, r.v, r.o) for r in table.read().collect())


def test_merge_keeps_the_greatest_order_and_is_idempotent(spark, table):
    make = lambda *rows: spark.createDataFrame(rows, "k string, v string, o double")
    assert table.read() is None
    one, two, three = make(("a", "old", 1.0), ("a", "new", 9.0), ("b", "x", 2.0)), make(("a", "late", 5.0), ("c", "y", 1.0), ("b", "z", 2.0)), make(("c", "w", 3.0))
    table.merge(one, 0)
    assert held(table) == [("a", "new", 9.0), ("b", "x", 2.0)]
    table.merge(one, 0)
    assert held(table) == [("a", "new", 9.0), ("b", "x", 2.0)]
    table.merge(two, 1)
    want = [("a", "new", 9.0), ("b", "z", 2.0), ("c", "y", 1.0)]  # of equal orders the later batch's
    assert held(table) == want
    for _ in range(2):  # a replayed batch
        table.merge(two, 1)
        assert held(table) == want
    table.merge(make(), 2)
    table.merge(three, 3)
    assert held(table) == [*want[:2], ("c", "w", 3.0)]


def test_a_batch_that_broke_off_is_not_seen(spark, table, monkeypatch):
    make = lambda *rows: spark.createDataFrame(rows, "k string, v string, o double")
    table.merge(make(("a", "x", 1.0)), 0)
    monkeypatch.setattr(table, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.merge(make(("a", "y", 2.0), ("b", "y", 2.0)), 1)
    assert held(table) == [("a", "x", 1.0)]
    monkeypatch.undo()
    table.merge(make(("a", "y", 2.0), ("b", "y", 2.0)), 1)
    assert held(table) == [("a", "y", 2.0), ("b", "y", 2.0)]


def test_merge_follows_a_stream(spark, tmp_path, table):
    path = str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema("k string, v string, o double").option("maxFilesPerTrigger", 1).parquet(path)
    for k in range(3):
        spark.createDataFrame([("a", f"v{k}", float(k % 2)), (f"b{k}", "x", 0.0)], "k string, v string, o double").coalesce(1).write.mode("append").parquet(path)
        table.follow(source, str(tmp_path / "state"))
    assert held(table) == [("a", "v1", 1.0), ("b0", "x", 0.0), ("b1", "x", 0.0), ("b2", "x", 0.0)]


def test_rows_of_a_key_wait_a_batch_at_a_time():
    import pandas as pd

    calls = []
    fold = stateful.Neighbours(5)
    fold.waiting = type("Waiting", (), {"appendList": lambda self, rows: calls.append(rows)})()
    fold.handle = type("Handle", (), {"registerTimer": lambda self, at: calls.append(at)})()
    batches = (pd.DataFrame({"us": [k * 1000, 500], "ord": [k, 9], "score": [0.5, 1.5]}) for k in (3, 1, 2))
    assert list(fold.handleInputRows(("a",), batches, None)) == []
    assert calls == [[(3000, 3, 0.5), (500, 9, 1.5)], [(1000, 1, 0.5), (500, 9, 1.5)], [(2000, 2, 0.5), (500, 9, 1.5)], 4]
