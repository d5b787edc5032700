import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plaintlens.operators import maintain, marts
from plaintlens.operators.history import upsert_lookback
from plaintlens.streaming import mart, upserts

SCHEMA = ("complaint_id string, date_received date, company_sk long, product_category string, timely_response boolean, "
          "days_to_company int, is_dispute_era boolean, consumer_disputed boolean, is_narrative_era boolean, "
          "has_narrative boolean, version int")
KEY = ("complaint_id", "date_received", 40, "version")


def complaint(pick, number, version, month):
    day = None if pick.random() < 0.03 else dt.date(2020, month, pick.randint(1, 28))
    late, early = month >= 4, month <= 5
    return (
        str(number), day, None if pick.random() < 0.1 else (1 if pick.random() < 0.4 else pick.randint(2, 5)),
        pick.choice(["card", "mortgage", None]), pick.choice([True, False, None]), pick.choice([None, None, 0, 1, 30]),
        early, pick.choice([True, False, None]) if early else None, late, pick.choice([True, False]) if late else False, version)


def feeds(seed):
    """A first load of months 1 to 5, then batches of new, moved, changed and repeated complaints."""
    pick = random.Random(seed)
    loaded = [complaint(pick, k, 0, 1 + k % 5) for k in range(120)]
    batches = []
    for b in range(3):
        rows = [complaint(pick, pick.randrange(160), 10 * b + v, pick.randint(3, 7)) for v in range(1, 9) for _ in range(5)]
        batches.append(rows)
    batches.append([r[:10] + (99,) for r in loaded if r[1] and r[1].month == 5])
    return loaded, batches


def same(a, b):
    a = a.select(*sorted(a.columns))
    b = b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def shown(cells):
    return maintain.defined(cells)


@pytest.fixture(scope="module")
def banks(spark):
    rows = [(k, f"Bank {k}", None if k == 4 else 10**9 * k) for k in range(1, 6)]
    frame = spark.createDataFrame(rows, "company_sk long, canonical_name string, total_assets_usd long")
    return frame.withColumns({"bank_size_bucket": F.lit("x"), "bank_size_rank": F.lit(1), "is_branchless": F.lit(False),
                              "primary_specialization": F.lit(None).cast("string"), "is_supervised_cfpb": F.lit(True)})


def test_changes_lead_where_a_rebuild_does(spark, banks):
    loaded, batches = feeds(1)
    fact = spark.createDataFrame(loaded, SCHEMA)
    cells = maintain.component_cells(fact)
    for rows in batches:
        delta = spark.createDataFrame(rows, SCHEMA)
        cells = maintain.apply_changes(cells, maintain.upsert_changes(fact, delta, *KEY)).checkpoint()
        fact = upsert_lookback(fact, delta, *KEY).checkpoint()
        assert same(cells, maintain.component_cells(fact))
        assert same(marts.components_of(cells, banks), marts.component_mart(fact, banks))
        # the same delta again takes back what it adds
        assert maintain.upsert_changes(fact, delta, *KEY).isEmpty()


@pytest.fixture(autouse=True, scope="module")
def checkpoints(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def test_undefined_measures(spark, banks):
    rows = [("1", dt.date(2020, 1, 1), 1, "card", True, None, True, None, False, False, 0)]
    cells = maintain.component_cells(spark.createDataFrame(rows, SCHEMA))
    row = marts.components_of(cells, banks).first()
    assert (row.sum_days_to_company, row.disputed_count, row.narrative_count) == (None, 0, None)
    assert row.timely_response_count == 1 and row.complaint_count_narrative_era == 0


def stored(spark, name, loaded):
    fact = spark.createDataFrame(loaded, SCHEMA)
    upserts.create_table(fact, f"{name}_fact", "date_received")
    mart.create_cells(fact, f"{name}_cells")
    return f"{name}_fact", f"{name}_cells"


def agrees(spark, fact, cells):
    for table in (fact, cells):  # a stream writes in a session of its own
        spark.catalog.refreshTable(table)
    return same(mart.read_cells(spark, cells), maintain.component_cells(spark.table(fact).drop("month_start")))


def test_stored_cells_keep_step(spark):
    loaded, batches = feeds(3)
    fact, cells = stored(spark, "kept", loaded)
    for number, rows in enumerate(batches):
        delta = spark.createDataFrame(rows, SCHEMA)
        for _ in range(2):
            mart.apply_batch(delta, fact, cells, number, *KEY)
            assert agrees(spark, fact, cells)
    # the last delta once more, as a batch of its own
    mart.apply_batch(delta, fact, cells, len(batches), *KEY)
    assert agrees(spark, fact, cells)


@pytest.mark.parametrize("step", ["upsert_table", "add_changes"])
def test_a_run_that_stopped_is_finished_by_the_next(spark, monkeypatch, step):
    loaded, batches = feeds(4)
    fact, cells = stored(spark, f"stopped_{step}", loaded)
    plain = getattr(mart, step)
    for number, rows in enumerate(batches[:1]):
        delta = spark.createDataFrame(rows, SCHEMA)

        def stop(*args, **kwargs):
            raise RuntimeError("lost")

        monkeypatch.setattr(mart, step, stop)
        with pytest.raises(RuntimeError):
            mart.apply_batch(delta, fact, cells, number, *KEY)
        monkeypatch.setattr(mart, step, plain)
        mart.apply_batch(delta, fact, cells, number, *KEY)
        assert agrees(spark, fact, cells)


def test_other_months_stay_as_they_are(spark):
    day = lambda m: dt.date(2020, m, 10)
    row = lambda k, m, v: (str(k), day(m), 1, "card", True, 1, True, False, False, False, v)
    fact, cells = stored(spark, "touched", [row(1, 3, 0), row(2, 4, 0), row(3, 5, 0)])
    files = lambda: {f: Path(f).parent.name for f in spark.table(cells).inputFiles()}
    before = files()
    moved = spark.createDataFrame([row(2, 5, 1)], SCHEMA)
    mart.apply_batch(moved, fact, cells, 0, *KEY)
    after = files()
    kept = {f for f, month in before.items() if month == "month_start=2020-03-01"}
    assert kept and kept <= set(after)
    assert not {f for f, month in before.items() if month != "month_start=2020-03-01"} & set(after)
    assert [(r.month_start.month, r.complaint_count) for r in mart.read_cells(spark, cells).orderBy("month_start").collect()] == [(3, 1), (5, 2)]
    assert agrees(spark, fact, cells)


def test_stream_of_batches(spark, tmp_path):
    loaded, batches = feeds(5)
    fact, cells = stored(spark, "streamed", loaded)
    for rows in batches[:2]:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        changes = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        query = mart.stream_batches(changes, fact, cells, *KEY, checkpoint=str(tmp_path / "checkpoint"))
        assert query.awaitTermination(300)
        assert agrees(spark, fact, cells)
