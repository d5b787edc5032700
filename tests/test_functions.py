import datetime as dt

import pytest
from pyspark.sql import functions as F

from plaintlens import defaults as D
from plaintlens.functions import flags, keys, rates, text


def apply(spark, values, fn, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_normalize_name(spark):
    names = ["  Equifax,  Inc.", "ABC.\n", "a\tb \xa0", "U.S. Bancorp.,;", "", None, "X:", "A .", "　wide "]
    assert apply(spark, names, text.normalize_name) == [
        "EQUIFAX, INC", "ABC", "A B", "U.S. BANCORP", "", None, "X:", "A ", "WIDE"]
    assert apply(spark, ["X:.", "Y;:"], lambda c: text.normalize_name(c, ".,;:")) == ["X", "Y"]


def test_clean_code(spark):
    states = [None, " ca ", "united states minor outlying islands", "Federated States", "", "NY"]
    got = apply(spark, states, lambda c: text.clean_code(c, D.STATE_ALIASES, 2, D.NOT_PROVIDED))
    assert got == ["not-provided", "CA", "UM", "not-provided", "", "NY"]


ZIPS = ["30349.0", "3008-", "17.0", "303491234", "30349-1234", "-5", "ABCDE", "", None, " 12345 ", "1.5", "+7",
        "99999999999999999999", "3008-.0", "3008.0-"]


def test_clean_zip(spark):
    assert apply(spark, ZIPS, text.clean_zip) == [
        "30349", "03008", "00017", "30349", "30349-1234", "000-5", "ABCDE", "", None, "12345", "1.5", "00007",
        "99999999999999999999", "03008", "3008.0-"]
    kept = apply(spark, ["17.0", "5", "1000", "0"], lambda c: text.clean_zip(c, keep_privacy_prefix=True))
    assert kept == ["017", "005", "01000", "00000"]


def test_zip_validity_and_pattern(spark):
    assert apply(spark, ["12345", "1234", None, "12345\n"], text.zip_is_valid) == [True, False, False, False]
    shapes = [None, "", "12345", "1234", "123XX", "12345-6789", "123456789", "abc"]
    assert apply(spark, shapes, lambda c: text.zip_pattern(c, D.ZIP_PATTERNS)) == [
        "null", "empty_string", "valid_5digit", "4digit_leading_zero_dropped", "masked_5char", "zip_plus4_dash",
        "zip_plus4_nodash", "other"]


def test_labels_and_tags(spark):
    assert apply(spark, [None, "Older American, Servicemember", "x"],
                 lambda c: text.tag_flag(c, "Servicemember")) == [False, True, False]
    verbose = next(iter(D.PUBLIC_RESPONSE_LABELS))
    got = apply(spark, [None, verbose + " ", " Other ", ""],
                lambda c: text.relabel(c, D.PUBLIC_RESPONSE_LABELS, D.NOT_PROVIDED))
    assert got == ["not-provided", "Company chooses not to provide a public response", "Other", ""]
    assert apply(spark, [None, " a ", ""], lambda c: text.fill_missing(c, "gone")) == ["gone", "a", ""]


def test_display_name_keeps_the_order_of_replacements(spark):
    names = ["a&b corp", "A & B", "U S BCORP", "PNC FINL SERVICES", "GOLDMAN GROUP INC THE", "THE"]
    got = apply(spark, names, lambda c: text.display_name(c, D.HOLDER_REPLACEMENTS, D.HOLDER_SUFFIX))
    assert got == ["A & B CORP", "A  &  B", "U S BANCORP", "PNC FINANCIAL SERVICES", "GOLDMAN GROUP INC", "THE"]


def test_strip_legal_suffixes(spark):
    names = ["Wells Fargo & Co", "ABC Holdings, Inc.", "Citibank, N.A.", "X Corp LLC", "Plain"]
    assert apply(spark, names, lambda c: text.strip_legal_suffixes(c, D.LEGAL_SUFFIXES)) == [
        "WELLS FARGO", "ABC", "CITIBANK", "X", "PLAIN"]


def test_classify_first_match_wins(spark):
    names = ["WESTLAKE SERVICES", "N.A", "PAYPAL BANK", "FSBX", "ACME"]
    assert apply(spark, names, lambda c: text.classify_regex(c, D.IMPLIED_CATEGORIES, "other")) == [
        "debt_collector", "bank", "fintech", "other", "other"]


def test_era_flags_and_buckets(spark):
    days = [dt.date(2017, 4, 23), dt.date(2017, 4, 24), dt.date(2015, 5, 31), dt.date(2015, 6, 1), None]
    assert apply(spark, days, lambda c: flags.era_flag(c, D.DISPUTE_ERA), "date") == [True, False, True, True, None]
    assert apply(spark, days, lambda c: flags.era_flag(c, D.NARRATIVE_ERA), "date") == [True, True, False, True, None]
    lags = [0, 1, 3, 4, 14, 15, None]
    assert apply(spark, lags, lambda c: flags.bucketize(c, D.LAG_CUTS, D.LAG_LABELS), "int") == [
        "0_same_day", "1_to_3", "1_to_3", "4_to_14", "4_to_14", "15_plus", "15_plus"]
    assets = [1_000_000_000, 999_999_999, 400_000_000, 175_000_000, 174_999_999, None]
    tier = apply(spark, assets, lambda c: flags.bucketize(c, D.ASSET_CUTS, D.ASSET_LABELS, ">="), "bigint")
    assert [t.split()[0] for t in tier] == ["mega", "large", "large", "mid", "smaller", "smaller"]
    with pytest.raises(ValueError):
        flags.bucketize(F.lit(1), [1, 2], ["a", "b"])


def test_clamped_days_keep_null(spark):
    df = spark.sql("select date'2020-01-02' a, date'2020-01-01' b union all select date'2020-01-02', null "
                   "union all select date'2020-01-02', date'2020-01-05'")
    got = {r[0] for r in df.select(flags.days_between_clamped(F.col("a"), F.col("b"))).collect()}
    assert got == {0, None, 3}


def test_week_of_year_matches_sunday_weeks(spark):
    rows = spark.sql("select explode(sequence(date'2011-01-01', date'2023-12-31', interval 1 day)) d") \
        .select("d", flags.week_of_year_sunday(F.col("d")).alias("w")).collect()
    assert all(r.w == int(r.d.strftime("%U")) for r in rows)


def test_surrogate_key(spark):
    assert apply(spark, ["Truist", None], keys.surrogate_key) == [359436154788614867, None]
    df = spark.sql("select * from values ('ab', 'c'), ('a', 'bc'), (null, 'c'), ('', 'c') as t(a, b)")
    got = [r[0] for r in df.select(keys.surrogate_key(F.col("a"), F.col("b"))).collect()]
    assert len(set(got)) == 4 and None not in got


def test_rates_are_null_when_undefined(spark):
    df = spark.sql("select true hit, false era union all select false, false")
    row = df.agg(rates.era_rate(F.col("hit"), F.col("era")).alias("r"),
                 rates.era_count(F.col("hit"), F.col("era")).alias("c")).first()
    assert row.r is None and row.c is None
