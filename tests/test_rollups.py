"""Orders of all rows, sketched components, many grains and stored history, on small fixtures."""

import random
from pathlib import Path

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plaintlens.operators import grains, history, maintain, ordered, sketches
from plaintlens.streaming import versions


def as_sets(df):
    return sorted(map(str, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))


@pytest.fixture(scope="module")
def skewed(spark):
    """Two rows of five tie, some have no key, some no value."""
    pick = random.Random(3)
    rows = [(i, 7 if i % 5 < 2 else pick.choice([None, *range(40)]), pick.choice("abc"), pick.choice([None, 1, 2, 9])) for i in range(600)]
    return spark.createDataFrame(rows, "id int, a int, b string, v int").repartition(5)


@pytest.mark.parametrize("order", [{"a": True}, {"a": False}, {"a": True, "b": False}, {"id": True}])
@pytest.mark.parametrize("parts", [1, 7])
def test_ranked_equals_windows(skewed, order, parts):
    w = W.orderBy(*[F.asc_nulls_first(c) if up else F.desc_nulls_last(c) for c, up in order.items()])
    wanted = skewed.select("*", F.rank().over(w).cast("long").alias("rank"), F.percent_rank().over(w).alias("percent_rank"),
                           F.cume_dist().over(w).alias("cume_dist"), F.sum("v").over(w).alias("running_v"))
    assert as_sets(ordered.ranked(skewed, order, ["v"], parts)) == as_sets(wanted)


def test_ranked_of_few_rows(skewed):
    none, one = skewed.where("id < 0"), skewed.where("id = 1")
    assert ordered.ranked(none, {"a": True}, ["v"]).count() == 0
    r = ordered.ranked(one, {"a": True}).first()
    assert (r["rank"], r["percent_rank"], r["cume_dist"]) == (1, 0.0, 1.0)
    assert not any(c.startswith("__") for c in ordered.ranked(one, {"a": True}).columns)


def test_ranked_has_no_window_over_the_rows(spark, skewed):
    plan = ordered.ranked(skewed, {"id": True}, ["v"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window " in line]
    assert windows and all("__part" in line for line in windows)


def feed(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, note string")


def files(path, part=None):
    return {(f.name, f.stat().st_mtime_ns) for f in Path(path).glob(f"{part or 'closed_in=*'}/*.parquet")}


def test_stored_history_follows_merges(spark, tmp_path):
    feeds = [
        (feed(spark, [(1, "a", "x"), (2, "b", "x"), (3, None, "x"), (None, "q", "x")]), "2020-01-01 00:00:00"),
        (feed(spark, [(1, "a", "y"), (2, "c", "y"), (4, "d", "y")]), "2020-06-01 00:00:00"),
        (feed(spark, [(1, "z", "y"), (2, None, "y"), (3, "e", "y")]), "2021-02-01 00:00:00"),
        (feed(spark, [(1, "a", "y"), (4, "d", "n")]).withColumn("extra", F.lit(5)), "2022-02-01 00:00:00"),
    ]
    path, wanted = str(tmp_path / "h"), None
    for step, (rows, at) in enumerate(feeds):
        before = {y: files(path, f"closed_in={y}") for y in (2020, 2021)}
        if step:
            versions.merge_history(rows, path, "k", ["v"], at)
        else:
            versions.create_history(rows, path, "k", ["v"], at)
        wanted = history.scd2_merge(wanted, rows, "k", ["v"], at)
        assert as_sets(versions.read_history(spark, path)) == as_sets(wanted)
        # what an earlier year closed stays as it was written
        assert all(before[y] <= files(path, f"closed_in={y}") for y in before)
    for again in (feeds[-1], feeds[-1]):
        versions.merge_history(again[0], path, "k", ["v"], again[1])
        assert as_sets(versions.read_history(spark, path)) == as_sets(wanted)


def test_stored_history_goes_on_after_a_stop(spark, tmp_path, monkeypatch):
    first, second = feed(spark, [(1, "a", "x"), (2, "b", "x")]), feed(spark, [(1, "c", "x"), (5, "e", "x")])
    path, at = str(tmp_path / "h"), "2021-01-01 00:00:00"
    versions.create_history(first, path, "k", ["v"], "2020-01-01 00:00:00")
    wanted = history.scd2_merge(history.scd2_merge(None, first, "k", ["v"], "2020-01-01 00:00:00"), second, "k", ["v"], at)
    # as a run leaves it that ended between its two writes
    closed = wanted.where("valid_to is not null")
    versions._parts(closed).write.mode("append").partitionBy(versions.CLOSED).parquet(path)
    versions.merge_history(second, path, "k", ["v"], at)
    assert as_sets(versions.read_history(spark, path)) == as_sets(wanted)


def test_stored_history_rests_on_rows_in_force(spark, tmp_path):
    path = str(tmp_path / "h")
    versions.create_history(feed(spark, [(1, "a", "x")]), path, "k", ["v"], "2020-01-01 00:00:00")
    versions.merge_history(feed(spark, [(1, "b", "x")]), path, "k", ["v"], "2021-01-01 00:00:00")
    assert versions._in_force(spark, path).count() == 1
    assert {p.name for p in Path(path).glob("closed_in=*")} == {"closed_in=0", "closed_in=2021"}


def test_sketched_quantiles_merge(spark):
    pick = random.Random(8)
    rows = [(k % 3, k % 50, None if k % 17 == 0 else int(pick.expovariate(0.01))) for k in range(30_000)]
    df = spark.createDataFrame(rows, "g int, cell int, days int").replace({2: None}, subset=["g"])
    cells = sketches.lag_cells(df, ["g", "cell"], "days")
    found = sketches.judged(sketches.quantiles(cells, ["g"]), df, ["g"], "days").collect()
    assert len(found) == 3 and all(r.p50_within and r.p90_within and r.p99_within for r in found)
    whole = {r.g: r for r in found}
    for g in (0, 1, None):
        values = sorted(d for a, _, d in rows if (None if a == 2 else a) == g and d is not None)
        assert whole[g].values_count == len(values)
        assert whole[g].p90_exact == values[-(-len(values) * 90 // 100) - 1]
    off = sketches.quantiles(cells, ["g"]).withColumn("p50", F.col("p50") * 3)
    assert not any(r.p50_within for r in sketches.judged(off, df, ["g"], "days").collect())


def test_sketched_distinct_counts(spark):
    rows = [(m, c, f"n{(m * 31 + k * (3 if c == 'a' else 2)) % 900}") for m in range(6) for c in "ab" for k in range(120)]
    df = spark.createDataFrame([*rows, (1, "a", None)], "m int, c string, name string")
    cells = sketches.distinct_cells(df, "name", ["m", "c"])
    names = {c: {n for _, d, n in rows if d == c} for c in "ab"}
    assert {r.c: r.distinct_count for r in sketches.distinct(cells, ["c"]).collect()} == {c: len(v) for c, v in names.items()}
    r = sketches.common(cells, "c", [("a", "b"), ("a", "missing")]).collect()
    assert [(x.in_both, x.in_first_only) for x in r] == [(len(names["a"] & names["b"]), len(names["a"] - names["b"]))]
    many = spark.range(200_000).select(F.lit(1).alias("m"), F.col("id").cast("string").alias("name"))
    close = sketches.distinct(sketches.distinct_cells(many, "name", ["m"]), ["m"]).first().distinct_count
    assert abs(close / 200_000 - 1) < 0.04


def test_grains_tell_null_from_all(spark):
    rows = [("2020-01-01", "a", None), ("2020-01-09", None, "s"), ("2020-04-01", "a", "s"), (None, "a", "s")]
    df = spark.createDataFrame(rows, "day string, product_category string, state string").select(
        F.col("day").cast("date").alias("date_received"), "product_category", "state",
        F.lit(True).alias("timely_response"), F.lit(3).alias("days_to_company"), F.lit(False).alias("is_dispute_era"),
        F.lit(True).alias("is_narrative_era"), F.lit(True).alias("consumer_disputed"), F.lit(False).alias("has_narrative"))
    found = grains.many_grains(df, [("quarter", []), ("all", ["product_category"]), ("all", [])])
    got = {(r.grain, str(r.period_start), r.product_category, r.all_product_category): r.complaint_count for r in found.collect()}
    assert got == {
        ("quarter", "2020-01-01", None, True): 2, ("quarter", "2020-04-01", None, True): 1, ("quarter", "None", None, True): 1,
        ("all", "None", "a", False): 3, ("all", "None", None, False): 1, ("all", "None", None, True): 4,
    }
    assert {(r.disputed_count, r.dispute_rate, r.narrative_rate) for r in found.collect()} == {(None, None, 0.0)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and set(maintain.MEASURES) - {"days_known_count"} <= set(found.columns)
