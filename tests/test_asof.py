import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plaintlens.operators.asof import as_of_join, heavy_ranges

T = dt.datetime
VERSIONS = "k string, name string, valid_from timestamp, valid_to timestamp"


def in_force(versions, key, at):
    """The key's latest-started version, if it has not ended."""
    if key is None or at is None:
        return None
    started = [v for v in versions if v[0] == key and v[2] is not None and v[2] <= at]
    last = max(started, key=lambda v: (v[2], v[1]), default=None)
    return None if last is None or (last[3] is not None and at >= last[3]) else last[1]


@pytest.fixture(scope="module")
def case():
    pick = random.Random(2)
    day = lambda: T(2020, 1, 1) + dt.timedelta(hours=pick.randrange(24 * 300))
    versions = [(None, "nobody", T(2019, 1, 1), None), ("hot", "no start", None, None)]
    for key in ["hot", "warm", *(f"k{j}" for j in range(20))]:
        for j in range(pick.randint(0, 12) if key != "hot" else 15):
            start = day()
            end = pick.choice([None, start + dt.timedelta(days=pick.randint(0, 60))])
            versions.append((key, f"{key}-{j:02}", start, end))
    versions.append(("k1", "k1-99", versions[-1][2], None))
    starts = [v[2] for v in versions if v[2]]
    fact = []
    for j in range(3000):
        key = "hot" if j % 3 == 0 else pick.choice(["warm", None, "unknown", *(f"k{i}" for i in range(20))])
        at = T(2020, 5, 5) if key == "hot" and j % 2 else pick.choice([day(), day(), pick.choice(starts), None])
        fact.append((j, key, at))
    return fact, versions


@pytest.mark.parametrize("heavy", [3000, 8, 1])
def test_each_row_gets_the_version_in_force(spark, case, heavy):
    fact, versions = case
    rows = spark.createDataFrame(fact, "id long, k string, at timestamp").repartition(6)
    history = spark.createDataFrame(versions, VERSIONS)
    got = {r.id: r.name for r in as_of_join(rows, history, "k", "at", ["name"], heavy=heavy, ranges=8).collect()}
    assert got == {j: in_force(versions, key, at) for j, key, at in fact}


def test_a_heavy_key_is_cut_into_ranges(spark, case):
    fact, versions = case
    rows = spark.createDataFrame(fact, "id long, k string, at timestamp")
    known = rows.where("k is not null and at is not null")
    starts = {r["k"]: r["__starts"] for r in heavy_ranges(known, "k", "at", 8, 16).collect()}
    assert set(starts) == {"hot"} and len(starts["hot"]) == 15
    # half of its rows have one time, at which half of its ranges start
    assert 6 <= starts["hot"].count(T(2020, 5, 5)) <= 9
    plan = as_of_join(rows, spark.createDataFrame(versions, VERSIONS), "k", "at", ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_empty_sides_and_clashes(spark, case):
    fact, versions = case
    rows = spark.createDataFrame(fact[:5], "id long, k string, at timestamp")
    history = spark.createDataFrame(versions, VERSIONS)
    assert as_of_join(rows.limit(0), history, "k", "at", ["name"]).count() == 0
    assert {r.name for r in as_of_join(rows, history.limit(0), "k", "at", ["name"]).collect()} == {None}
    with pytest.raises(ValueError, match="at"):
        as_of_join(rows, history.withColumn("at", F.lit(1)), "k", "at", ["at"])
    dates = rows.withColumn("at", F.col("at").cast("date"))
    assert as_of_join(dates, history, "k", "at", ["name"]).count() == 5
