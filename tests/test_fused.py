"""Fused rules give what the single checks give, from one read of each table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plaintlens.operators import checks, fused

ROWS = "id string, grp string, day date, flag boolean, parent long, n long"


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(None if k % 50 == 0 else str(k % 90), "abcx"[k % 4] if k % 7 else None, dt.date(2020, 1, 1 + k % 20),
             None if k % 11 == 0 else k % 3 > 0, k % 9 if k % 3 else None, k) for k in range(200)]
    child = spark.createDataFrame(rows, ROWS)
    parent = spark.createDataFrame([(k, k % 2 == 0) for k in (0, 1, 2, 4, 5)] + [(None, True), (2, True)], "parent long, kept boolean")
    return {"child": child, "parent": parent, "empty": child.limit(0)}


RULES = [
    fused.not_null("null", "child", "grp"),
    fused.not_null("null where", "child", "grp", "flag"),
    fused.rows("late", "child", "day > date'2020-01-15' and not flag", "warn"),
    fused.unique("one", "child", ["id"]),
    fused.unique("two", "child", ["id", "grp"]),
    fused.unique("fine", "child", ["n"]),
    fused.accepted("listed", "child", "grp", ["a", "b"], "flag"),
    fused.relationship("child of", "child", "parent", "parent", "parent"),
    fused.relationship("none of", "empty", "parent", "parent", "parent"),
    fused.floor("high", "child", "flag", 90.0),
    fused.floor("low", "child", "flag", 10.0),
    fused.floor("nothing", "empty", "flag", 10.0),
    fused.same_count("differ", "child", "parent"),
    fused.same_count("same", "empty", "empty"),
    fused.same_total("total", "child", "n", "child", "parent", "parent", "kept"),
    fused.same_total("no total", "empty", "n", "empty", "parent", "parent", "kept"),
]


def single(t):
    c, p, e = t["child"], t["parent"], t["empty"]
    late = c.where("day > date'2020-01-15' and not flag")
    return [
        checks.Check("null", checks.not_null(c, "grp")),
        checks.Check("null where", checks.not_null(c, "grp", "flag")),
        checks.Check("late", late, "warn"),
        checks.Check("one", checks.unique(c, ["id"])),
        checks.Check("two", checks.unique(c, ["id", "grp"])),
        checks.Check("fine", checks.unique(c, ["n"])),
        checks.Check("listed", checks.accepted(c, "grp", ["a", "b"], "flag")),
        checks.Check("child of", checks.relationship(c, "parent", p, "parent")),
        checks.Check("none of", checks.relationship(e, "parent", p, "parent")),
        checks.Check("high", checks.coverage(c, "flag", 90.0)),
        checks.Check("low", checks.coverage(c, "flag", 10.0)),
        checks.Check("nothing", checks.coverage(e, "flag", 10.0)),
        checks.Check("differ", checks.same_count(c, p)),
        checks.Check("same", checks.same_count(e, e)),
        checks.Check("total", checks.same_total(
            c, F.sum("n"), c.join(p.where("kept").distinct(), "parent", "left_semi"), F.count("*"))),
        checks.Check("no total", checks.same_total(e, F.sum("n"), e, F.count("*"))),
    ]


def rows(frame):
    return sorted(tuple(r) for r in frame.select("name", "severity", "n_failed", "status").collect())


def test_fused_equals_single(tables):
    found = rows(fused.evaluate(tables, RULES))
    assert found == rows(checks.run_checks(single(tables)))
    assert {r[3] for r in found} == {"pass", "warn", "fail"}


def test_each_table_is_read_once(tables, spark, tmp_path):
    stored = {}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    plan = fused.evaluate(stored, RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == len(stored)


def test_sums_taken_while_writing(tables, spark, tmp_path):
    watched = {name: fused.Watched(df, name, RULES) for name, df in tables.items()}
    stored = {}
    for name, one in watched.items():
        one.table.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    summary = fused.evaluate(stored, RULES, watched)
    assert rows(summary) == rows(fused.evaluate(tables, RULES))
    # columns that only rules without a key look at are not read again
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema") == 3 and "day:" not in plan and "id:string" in plan
