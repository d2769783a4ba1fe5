import datetime as dt
import math
from decimal import Decimal as D
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rentledger.functions import formulas as fx
from rentledger.functions import money as mo
from rentledger.functions import scalar as sc
from rentledger.functions import timefmt as tf

c = F.col


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "x, cents",
    [(1.005, "1.01"), (2.675, "2.68"), (-2.675, "-2.68"), (0.1 + 0.2, "0.30"), (1.0049999, "1.00"), (123456.005, "123456.01"), (1e9 + 0.125, "1000000000.13"), (0.0, "0.00")],
)
def test_double_to_cents(spark, x, cents):
    assert one(spark, mo.money_from_double(F.lit(x))) == D(cents)


def test_numeric_of_amounts_needs_no_text(spark):
    """Amounts of up to four decimals take the short way; both ways agree on odd doubles and next to each border."""
    long_way = F.format_string("%.14e", c("x")).cast(mo.NUMERIC)
    near = [v * s for v in (0.0, 0.1, 0.0001, 0.00005, 12.34, 1234567.8901, 0.1 + 0.2, 1 / 3, 9999999999.9999, 1e10, 1e10 + 0.5, 123456789012.345, 1e-9) for s in (1.0, -1.0)]
    near += [math.nextafter(v, math.inf) for v in near] + [k / 10000 for k in range(-20000, 20000, 7)] + [k * 0.01 * 1.1 for k in range(500)]
    df = spark.createDataFrame([(x,) for x in near], "x double")
    assert df.where(~mo.numeric(c("x")).eqNullSafe(long_way)).collect() == []
    assert "rint" in df.select(mo.numeric(c("x")))._jdf.queryExecution().optimizedPlan().toString().lower()


def test_zones_are_not_looked_up_in_every_row(spark):
    """``convert_timezone`` parses its zone names for each row."""
    t = at(spark, "2024-08-01 19:00:00")
    dates = t.select(tf.local_date(c("t")), tf.local_time(c("t")), tf.double_shift(c("t")))
    assert "convert_timezone" not in dates._jdf.queryExecution().optimizedPlan().toString()
    assert t.select(tf.wall_time(c("t")).alias("w")).dtypes == [("w", "timestamp_ntz")]


def test_double_shift_into_a_gap(spark):
    """20:40 UTC is 02:10 in Kolkata, a time that Chicago skipped on that day; it counts as an hour later."""
    long_way = F.convert_timezone(F.lit("America/Chicago"), F.lit("America/Chicago"), F.convert_timezone(F.lit("UTC"), F.lit("Asia/Kolkata"), c("t")))
    for instant in ("2024-03-09 20:40:00", "2024-11-02 20:10:00", "1875-01-01 20:40:00", "0001-01-01 00:00:00"):
        got = at(spark, instant).select(tf.double_shift(c("t"), fmt="yyyy-MM-dd HH:mm:ss"), F.date_format(long_way, "yyyy-MM-dd HH:mm:ss")).first()
        assert got[0] == got[1]


def test_flag_text_is_a_choice(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean").select(sc.flag_text(c("f")).alias("t"))
    assert [r.t for r in df.collect()] == ["TRUE", "FALSE", None]
    assert "upper" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_numeric_keeps_fifteen_digits(spark):
    assert one(spark, mo.numeric(F.lit(0.1) + F.lit(0.2))) == D("0.3")
    assert one(spark, mo.numeric(F.lit(None).cast("double"))) is None


def test_decimal_rounding_is_half_away_from_zero(spark):
    for x, want in (("2.345", "2.35"), ("-2.345", "-2.35"), ("2.3449", "2.34")):
        assert one(spark, mo.money(F.lit(D(x)))) == D(want)


def test_decimal_amounts_converts_doubles_only(spark):
    df = spark.createDataFrame([(0.1 + 0.2, D("1.50"), "x")], "a double, b decimal(12,2), t string")
    out = mo.decimal_amounts(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["decimal(24,10)", "decimal(12,2)", "string"]
    assert out.first()["a"] == D("0.3")


def half_up(x: Fraction) -> D:
    cents = (2 * x * 100 + 1) // 2
    return D(int(cents)) / 100


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(*[st.integers(0, 5_000_000)] * 3), min_size=20, max_size=60))
def test_share_is_exact(spark, rows):
    data = [(i, D(a) / 100, D(b) / 100, D(p) / 100) for i, (a, b, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, a decimal(12,2), b decimal(12,2), p decimal(12,2)")
    got = {r["i"]: r["v"] for r in df.select("i", mo.share(c("a"), c("b"), c("p")).alias("v")).collect()}
    for i, (a, b, p) in enumerate(rows):
        want = None if p == 0 else half_up(Fraction(a * b, p * 100))
        assert got[i] == want, rows[i]


def test_fees_without_a_total(spark):
    m = lambda x: F.lit(D(x)).cast(mo.MONEY)
    assert one(spark, fx.create_fee(m("1.00"), m("2.00"), m("0"))) is None
    assert one(spark, fx.refund_fee(m("0"), m("5"), F.lit(None).cast(mo.MONEY))) == D("0.00")
    assert one(spark, fx.refund_fee(m("1"), m("5"), m("0"))) is None
    assert one(spark, fx.refund_fee(m("1.00"), m("1.00"), m("3.00"))) == D("0.33")
    assert one(spark, fx.refund_fee_signed(m("1.00"), m("1.00"), m("3.00"))) == D("-0.33")


def test_greatest_skips_null(spark):
    assert one(spark, mo.at_least(F.lit(None).cast("double"), 0.0)) == 0.0
    assert one(spark, fx.final_subtotal(F.lit(5.0), F.lit(3.0), F.lit(4.0), floor=0.0)) == 0.0


def test_text_helpers(spark):
    null = F.lit(None).cast("string")
    assert one(spark, sc.full_name(null, null)) == " "
    assert one(spark, sc.full_name(null, F.lit("Roe"))) == " Roe"
    assert one(spark, sc.mask_user(F.lit("Consumer Web"), F.lit("A B"))) == ""
    assert one(spark, sc.mask_user(null, F.lit("A B"))) == "A B"
    assert [one(spark, sc.partner_text(F.lit(v).cast("int"))) for v in (0, None, 7)] == ["", "", "7"]
    assert one(spark, sc.text(F.lit(D("0")).cast(mo.MONEY))) == "0.00"
    assert one(spark, sc.uuid(F.lit(" 977F485C-02c8-4f59-a03d-ad1feb371889"))) == "977f485c-02c8-4f59-a03d-ad1feb371889"
    assert one(spark, sc.uuid(F.lit("977f485c"))) is None
    assert one(spark, sc.clean_name(F.lit('a "b" c'))) == "a b c"
    assert one(spark, sc.flag_text(F.lit(True))) == "TRUE"
    assert one(spark, sc.as_long(F.lit("x1"), strict=False)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, sc.as_long(F.concat(F.lit("x"), c("id").cast("string"))))


def test_three_valued_flag(spark):
    df = spark.createDataFrame([(D("1.00"), None), (D("0.00"), None), (D("0.00"), True)], f"r {mo.MONEY}, f boolean")
    assert [r[0] for r in df.select(sc.refunded_flag(c("r"), c("f"))).collect()] == [True, None, True]


def at(spark, text, kind="timestamp_ntz"):
    return spark.range(1).select(F.lit(text).cast(kind).alias("t"))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_dates_around_daylight_saving(spark, kind):
    cases = {
        "2024-03-10 07:59:59": ("10/03/2024", "01:59:59 AM"),
        "2024-03-10 08:00:00": ("10/03/2024", "03:00:00 AM"),
        "2024-11-03 06:30:00": ("03/11/2024", "01:30:00 AM"),
        "2024-11-03 07:30:00": ("03/11/2024", "01:30:00 AM"),
        "2024-07-01 04:59:00": ("30/06/2024", "11:59:00 PM"),
    }
    for utc, want in cases.items():
        assert at(spark, utc, kind).select(tf.local_date(c("t")), tf.local_time(c("t"))).first() == want


def test_double_shift(spark):
    row = at(spark, "2024-08-01 19:00:00").select(
        tf.double_shift(c("t")), tf.double_shift(c("t"), session_zone="UTC"), tf.double_shift(c("t"), fmt=tf.MONTH_FIRST)
    )
    # 19:00 UTC is 00:30 of the next day in Kolkata; read as Chicago time that is 05:30 UTC.
    assert tuple(row.first()) == ("02/08/2024", "02/08/2024", "08/02/2024")
    assert dt.date(2024, 8, 2).strftime("%d/%m/%Y") == "02/08/2024"
