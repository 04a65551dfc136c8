import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from argent.functions import exprs as fn


def one_col(spark, values, type_):
    return spark.createDataFrame([(v,) for v in values], f"v {type_}")


def test_clean_upper_keeps_tab(spark):
    df = one_col(spark, [" ab\t ", "", None], "string")
    assert [r[0] for r in df.select(fn.clean_upper("v")).collect()] == ["AB\t", "", None]


def test_money_and_whole(spark):
    df = one_col(spark, ["12.345"], "string")
    assert df.select(fn.money("v")).first()[0] == Decimal("12.35")
    nums = one_col(spark, [2.5, -2.5], "double")
    assert [r[0] for r in nums.select(fn.whole("v")).collect()] == [Decimal(3), Decimal(-3)]


def test_money_bad_text_raises(spark):
    df = one_col(spark, ["abc"], "string")
    with pytest.raises(Exception):
        df.select(fn.money("v")).collect()


def test_try_ts(spark):
    df = one_col(spark, ["2024-01-02 03:04:05", "2024-01-02", "bad", None], "string")
    got = [r[0] for r in df.select(fn.try_ts("v")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2), None, None]


def test_try_ts_epoch_branch(spark):
    df = one_col(spark, ["86400"], "string")
    assert df.select(fn.try_ts("v", epoch_digits=True)).first()[0] == dt.datetime(1970, 1, 2)


EMAILS = ["a.b+c@x-y.co.uk", "o'n@x.co", "a@b", "x y@z.com", None]


def test_email_patterns(spark):
    df = one_col(spark, EMAILS, "string")
    v = F.col("v")
    got = df.select(fn.is_email("v").alias("f10"),
                    v.rlike(fn.full_match(fn.EMAIL_PATTERN_TEST)).alias("d8"),
                    v.rlike(fn.full_match(fn.EMAIL_PATTERN_COLUMN)).alias("d5")).collect()
    assert [r.f10 for r in got] == [True, True, False, False, False]
    assert [r.d8 for r in got] == [True, False, False, False, None]
    assert [r.d5 for r in got] == [True, False, False, False, None]


def test_full_match_rejects_trailing_newline(spark):
    df = one_col(spark, ["a@b.co\n"], "string")
    assert df.select(fn.is_email("v")).first()[0] is False


def test_masks(spark):
    df = spark.createDataFrame([("x", dt.date(2024, 5, 6)), (None, None)], "s string, d date")
    masked = df.select(fn.mask_string("s").alias("s"), fn.mask_date("d").alias("d")).collect()
    assert [(r.s, r.d) for r in masked] == [("***MASKED***", dt.date(2024, 1, 1)), ("***MASKED***", None)]
    plain = df.select(fn.mask_string("s", ["compliance_role"]).alias("s"),
                      fn.mask_date("d", ["ADMIN_ROLE"]).alias("d")).collect()
    assert [(r.s, r.d) for r in plain] == [("x", dt.date(2024, 5, 6)), (None, None)]


def test_scd_id_stable_and_distinct(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 5)), (1, dt.datetime(2024, 1, 15))], "k long, t timestamp_ntz")
    ids = [r[0] for r in df.select(fn.scd_id("k", "t")).collect()]
    assert len(set(ids)) == 2 and all(len(i) == 32 for i in ids)
