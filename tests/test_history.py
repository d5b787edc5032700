import datetime as dt

import pytest
from pyspark.sql import functions as F

from plaintlens.operators import history
from plaintlens.streaming import upserts

D = dt.date
SCHEMA = "k string, name string, holder string, note string"


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture()
def versions(spark):
    first = spark.createDataFrame([("a", "A", "h", "x"), ("b", "B", None, "x"), ("c", "C", "h", "x")], SCHEMA)
    second = spark.createDataFrame([("a", "A2", "h", "x"), ("b", "B", "h", "x"), ("c", "C", "h", "edited"),
                                    ("d", "D", None, "x")], SCHEMA)
    opened = history.scd2_merge(None, first, "k", ["name", "holder"], "2020-01-01")
    return opened, history.scd2_merge(opened, second, "k", ["name", "holder"], "2021-01-01"), second


def test_scd2_versions_only_checked_columns(versions):
    _, merged, _ = versions
    rows = sorted((r.k, r.name, r.holder, r.note, str(r.valid_from)[:4], str(r.valid_to)[:4]) for r in merged.select(
        "k", "name", F.coalesce("holder", F.lit("-")).alias("holder"), "note", "valid_from", "valid_to").collect())
    assert rows == [
        ("a", "A", "h", "x", "2020", "2021"), ("a", "A2", "h", "x", "2021", "None"),
        ("b", "B", "-", "x", "2020", "2021"), ("b", "B", "h", "x", "2021", "None"),
        ("c", "C", "h", "x", "2020", "None"), ("d", "D", "-", "x", "2021", "None")]


def test_scd2_repeat_changes_nothing_and_missing_keys_stay(versions):
    opened, merged, second = versions
    assert same(history.scd2_merge(merged, second, "k", ["name", "holder"], "2022-01-01"), merged)
    without = history.scd2_merge(merged, second.where("k <> 'a'"), "k", ["name", "holder"], "2022-01-01")
    assert same(without, merged)


def test_scd2_leaves_out_null_keys_and_keeps_new_columns(versions, spark):
    opened, _, second = versions
    null_key = spark.createDataFrame([(None, "N", "h", "x")], SCHEMA)
    merged = history.scd2_merge(opened, second.unionByName(null_key), "k", ["name", "holder"], "2021-01-01")
    assert same(merged, versions[1])
    assert history.scd2_merge(None, null_key, "k", ["name"], "2020-01-01").isEmpty()

    wider = second.drop("note").withColumn("extra", F.lit("new"))
    merged = history.scd2_merge(opened, wider, "k", ["name", "holder", "extra"], "2021-01-01")
    rows = {(r.k, str(r.valid_from)[:4]): (r.note, r.extra) for r in merged.collect()}
    assert rows[("a", "2020")] == ("x", None) and rows[("a", "2021")] == (None, "new") and len(rows) == 7


def test_scd2_as_of(versions):
    _, merged, _ = versions
    assert sorted(r.name for r in history.scd2_as_of(merged, "2020-06-01").collect()) == ["A", "B", "C"]
    assert sorted(r.name for r in history.scd2_as_of(merged, "2021-01-01").collect()) == ["A2", "B", "C", "D"]


EVENTS = "id string, day date, v int, version int"
STORED = [("1", D(2020, 1, 1), 1, 1), ("2", D(2020, 1, 20), 2, 1), ("3", D(2020, 2, 1), 3, 1)]
DELTA = [("2", D(2020, 1, 28), 20, 2), ("2", D(2020, 1, 29), 21, 3), ("4", D(2020, 2, 3), 4, 1),
         ("1", D(2020, 1, 2), 99, 9), ("3", D(2020, 2, 1), 30, 2)]


def expected():
    return {("1", 1), ("2", 21), ("3", 30), ("4", 4)}


def test_upsert_lookback_is_idempotent(spark):
    stored, delta = spark.createDataFrame(STORED, EVENTS), spark.createDataFrame(DELTA, EVENTS)
    once = history.upsert_lookback(stored, delta, "id", "day", 7, "version")
    assert {(r.id, r.v) for r in once.collect()} == expected()
    assert same(history.upsert_lookback(once, delta, "id", "day", 7, "version"), once)
    empty = history.upsert_lookback(stored.limit(0), delta, "id", "day", 7, "version")
    assert empty.count() == 4


def test_latest_version_with_hot_key(spark):
    """A third of all copies share one key; ties between equal versions are decided the same way every time."""
    copies = spark.range(30000).selectExpr("if(id % 3 = 0, 0, id) as k", "cast(id % 7 as int) as version", "id as v")
    first, again = (history.latest_per_key(df, "k", "version") for df in (copies, copies.repartition(7, "v")))
    assert same(first, again) and first.count() == 20001
    assert first.where("k = 0").first().version == 6


def test_stored_upsert_rewrites_touched_months_only(spark, tmp_path):
    upserts.create_table(spark.createDataFrame(STORED, EVENTS), "upsert_batch", "day")
    delta = spark.createDataFrame([(*r, "new") for r in DELTA], EVENTS + ", extra string")
    for _ in range(2):
        upserts.upsert_table(delta, "upsert_batch", "id", "day", 7, "version")
        rows = spark.table("upsert_batch").collect()
        assert {(r.id, r.v) for r in rows} == expected()
        assert {r.id: r.extra for r in rows} == {"1": None, "2": "new", "3": "new", "4": "new"}


def test_stored_upsert_empties_a_month(spark):
    rows = [("1", D(2020, 1, 31), 1, 1), ("2", D(2020, 2, 2), 2, 1)]
    upserts.create_table(spark.createDataFrame(rows, EVENTS), "upsert_moved", "day")
    moved = spark.createDataFrame([("1", D(2020, 2, 3), 10, 2)], EVENTS)
    upserts.upsert_table(moved, "upsert_moved", "id", "day", 7, "version")
    assert {(r.id, r.v) for r in spark.table("upsert_moved").collect()} == {("1", 10), ("2", 2)}


def test_stored_upsert_of_rows_without_a_date(spark):
    rows = [("1", None, 1, 1), ("2", D(2020, 2, 2), 2, 1), ("3", None, 3, 1)]
    upserts.create_table(spark.createDataFrame(rows, EVENTS), "upsert_undated", "day")
    dated = spark.createDataFrame([("1", D(2020, 2, 3), 10, 2)], EVENTS)
    upserts.upsert_table(dated, "upsert_undated", "id", "day", 7, "version")
    found = lambda: sorted((r.id, r.v) for r in spark.table("upsert_undated").collect())
    assert found() == [("1", 10), ("2", 2), ("3", 3)]
    last = spark.createDataFrame([("3", D(2020, 2, 4), 30, 2)], EVENTS)
    upserts.upsert_table(last, "upsert_undated", "id", "day", 7, "version")
    assert found() == [("1", 10), ("2", 2), ("3", 30)]


def test_stored_upsert_again_after_a_failure_before_the_drop(spark, monkeypatch):
    rows = [("1", D(2020, 1, 31), 1, 1), ("2", D(2020, 2, 2), 2, 1)]
    upserts.create_table(spark.createDataFrame(rows, EVENTS), "upsert_broken", "day")
    moved = spark.createDataFrame([("1", D(2020, 2, 3), 10, 2)], EVENTS)
    plain = type(spark).sql

    def failing(self, text, *args, **kwargs):
        if "DROP IF EXISTS PARTITION" in text:
            raise RuntimeError("lost")
        return plain(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        upserts.upsert_table(moved, "upsert_broken", "id", "day", 7, "version")
    monkeypatch.undo()
    upserts.upsert_table(moved, "upsert_broken", "id", "day", 7, "version")
    assert sorted((r.id, r.v) for r in spark.table("upsert_broken").collect()) == [("1", 10), ("2", 2)]


def test_stream_of_changes(spark, tmp_path):
    upserts.create_table(spark.createDataFrame(STORED, EVENTS), "upsert_stream", "day")
    spark.createDataFrame(DELTA, EVENTS).write.parquet(str(tmp_path / "in"))
    changes = spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in"))
    for _ in range(2):
        q = upserts.stream_upserts(changes, "upsert_stream", "id", "day", 7, "version", str(tmp_path / "ck"))
        q.awaitTermination(120)
        assert {(r.id, r.v) for r in spark.table("upsert_stream").collect()} == expected()


def test_append_and_freshness(spark):
    a, b = spark.sql("select 1 x"), spark.sql("select 2 x, 'y' y")
    assert [tuple(r) for r in history.append_columns(a, b).orderBy("x").collect()] == [(1, None), (2, "y")]
    df = spark.createDataFrame([(D(2020, 1, 1),)], "d date")
    for as_of, status in (("2020-01-08", "pass"), ("2020-01-09", "warn"), ("2020-01-16", "error")):
        assert history.freshness(df, "d", as_of, 7, 14).first().status == status
    assert history.freshness(df.limit(0), "d", "2020-01-01", 7, 14).first().status == "error"
