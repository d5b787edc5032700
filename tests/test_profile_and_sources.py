import datetime as dt
import hashlib
import random
from collections import Counter

import pytest

from plaintlens.operators import checks, entity, profile
from plaintlens.operators.lookup import apply_mapping
from plaintlens.plans.build import Models
from plaintlens.sources import schemas, tables


def test_pareto_matches_brute_force(spark):
    rng = random.Random(7)
    keys = [f"k{rng.randint(0, 400)}" for _ in range(1500)] + ["hot"] * 800 + [None] * 3
    got = profile.pareto(spark.createDataFrame([(k,) for k in keys], "k string"), "k").collect()
    ranked = sorted(Counter(keys).items(),
                    key=lambda kv: (-kv[1], hashlib.md5((kv[0] or "").encode()).hexdigest()))
    running, want = 0, {}
    for rank, (k, n) in enumerate(ranked, start=1):
        running += n
        want[k] = (rank, n, running)
    assert {r.k: (r.rnk, r.n, r.cum_n) for r in got} == want


def test_column_profile_and_value_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "x int, y string")
    assert {r.column_name: (r.n_rows, r.n_nulls, r.n_distinct) for r in profile.column_profile(df).collect()} == {
        "x": (3, 0, 2), "y": (3, 1, 2)}
    assert {(r.field, r.value): r.n for r in profile.value_counts(df, ["y"]).collect()} == {
        ("y", "a"): 1, ("y", "b"): 1, ("y", "(null)"): 1}


def test_shape_with_sketches(spark):
    row = profile.shape(spark.range(1000), distinct={"ids": "id"}, approx=0.01).first()
    assert row.total_rows == 1000 and abs(row.ids - 1000) < 50


def test_mapping_null_equals_blank(spark):
    df = spark.createDataFrame([("p", None), ("p", ""), ("p", "z"), (None, None)], "a string, b string")
    mapping = tables.inline_rows(spark, "a string, b string, v string", [("p", None, "hit")])
    got = apply_mapping(df, mapping, {"a": "a", "b": "b"}, "v", "out", default="miss", null_as_blank=["b"])
    assert sorted(r.out for r in got.collect()) == ["hit", "hit", "miss", "miss"]


def test_mapping_larger_than_broadcast_keeps_all_rows_of_a_hot_key(spark):
    """Without a broadcast the join shuffles; a key with a third of the rows loses none of them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(30000).selectExpr("if(id % 3 = 0, 0, id) as k")
        mapping = spark.range(30000).selectExpr("id as k", "id * 2 as v").where("k % 2 = 0")
        got = apply_mapping(df, mapping, {"k": "k"}, "v", "out")
        assert got.count() == 30000
        assert got.where("k = 0 and out = 0").count() == 10000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_checks_on_edge_cases(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", None)], "k string, v int")
    assert [r.k for r in checks.unique(df, ["k"]).collect()] == ["a"]
    assert checks.not_null(df, "v").count() == 1 and checks.not_null(df, "v", "k = 'a'").isEmpty()
    assert [(r.value, r.n_rows) for r in checks.accepted(df, "k", ["a"]).collect()] == [("b", 1)]
    parent = spark.createDataFrame([("a",)], "id string")
    assert [r.k for r in checks.relationship(df, "k", parent, "id").collect()] == ["b"]
    share = spark.range(10000).selectExpr("id < 7395 as f")
    assert checks.coverage(share, "f", 74).isEmpty()
    assert checks.coverage(spark.range(10000).selectExpr("id < 7394 as f"), "f", 74).first()[0] == 73.9
    empty = df.limit(0)
    assert not checks.same_total(empty, profile.F.sum("v"), df, profile.F.sum("v")).isEmpty()
    summary = checks.run_checks([checks.Check("a", df, "warn"), checks.Check("b", df), checks.Check("c", empty)])
    assert {r.name: r.status for r in summary.collect()} == {"a": "warn", "b": "fail", "c": "pass"}


def test_unmatched_and_match_rate(spark):
    left = spark.createDataFrame([(" x ",), ("x",), ("y",), ("Z",), (None,)], "n string")
    ref = spark.createDataFrame([("X",), (None,)], "r string")
    assert [(r.n, r.complaints) for r in entity.unmatched(left, [(ref, "r")], "n", 5).collect()] == [("Z", 1), ("y", 1)]
    row = entity.match_rate(left, {"ref": (ref, "r")}, "n").first()
    assert (row.distinct_names, row.matched_ref, row.complaints_matched_ref) == (4, 2, 2)


def test_seed_csv_round_trip(spark, tmp_path):
    path = tmp_path / "crosswalk.csv"
    path.write_text('raw_company_name,canonical_name,category,fdic_top_holder,parent_as_of\n'
                    '"EQUIFAX, INC",Equifax,credit_bureau,,\n"SAYS ""HI""",Truist,bank,H,2019-12-01\n')
    rows = tables.read_seed(spark, str(path), schemas.CROSSWALK).collect()
    assert rows[0].raw_company_name == "EQUIFAX, INC" and rows[0].fdic_top_holder is None
    assert rows[1].raw_company_name == 'SAYS "HI"' and rows[1].parent_as_of == dt.date(2019, 12, 1)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_raw_tables_round_trip(spark, tmp_path, fmt):
    row = ("1", dt.date(2020, 1, 1), None, "Mortgage", None, "i", None, "c", "CA", "1", None, "Web", None, None, True,
           None, None, False)
    spark.createDataFrame([row], schemas.COMPLAINTS).write.option("header", True).format(fmt).save(str(tmp_path / "c"))
    assert [tuple(r) for r in tables.read_complaints(spark, str(tmp_path / "c"), fmt).collect()] == [row]
    banks = spark.createDataFrame([], schemas.BANKS)
    assert len(banks.columns) == 95
    banks.write.option("header", True).format(fmt).save(str(tmp_path / "b"))
    if fmt == "parquet":
        assert tables.read_banks(spark, str(tmp_path / "b")).schema == banks.schema


def test_save_views_and_partitions(spark, tmp_path):
    df = spark.sql("select 1 a, 'x' p union all select 2, 'y'")
    tables.save(df, "some_view")
    assert spark.table("some_view").count() == 2
    stored = tables.save(df, str(tmp_path / "t"), "overwrite", ["p"])
    assert stored.columns == ["a", "p"] and stored.count() == 2


def test_lean_copy_keeps_presence(spark):
    df = spark.createDataFrame([(1, "text"), (2, None)], "id int, body string")
    lean = tables.materialize_lean(df, ["body"], {"has_body": "body"})
    assert [tuple(r) for r in lean.orderBy("id").collect()] == [(1, True), (2, False)]


def test_default_date_dimension(spark):
    assert Models(spark, None).dates.count() == 4748


def test_schema_listing(spark):
    rows = tables.describe_schema({"t": spark.sql("select 1 a, 'x' b")}).orderBy("ordinal_position").collect()
    assert [(r.table_name, r.ordinal_position, r.column_name, r.data_type) for r in rows] == [
        ("t", 1, "a", "int"), ("t", 2, "b", "string")]


def test_sketched_profile_and_pareto_width(spark):
    df = spark.range(2000).selectExpr("id as k", "if(id % 4 = 0, null, id % 10) as v")
    exact = {r.column_name: r for r in profile.column_profile(df).collect()}
    for r in profile.column_profile(df, approx=0.02).collect():
        assert (r.n_rows, r.n_nulls) == (exact[r.column_name].n_rows, exact[r.column_name].n_nulls)
        assert abs(r.n_distinct - exact[r.column_name].n_distinct) <= 0.1 * exact[r.column_name].n_distinct
    narrow, wide = (profile.pareto(df, "v", prefix=p) for p in (1, 5))
    assert narrow.exceptAll(wide).isEmpty() and wide.exceptAll(narrow).isEmpty()
