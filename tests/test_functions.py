"""Scalar rules: casing, padding, numbers, dates, maps."""

import datetime as dt
import math

from pyspark.sql import functions as F

from midyear.functions import dates, numbers, recode, text
from midyear.operators.events import repaired_year
from midyear.operators.shape import derive

D = dt.date


def test_title_case_keeps_other_letters(values):
    got = values([("SAN JUAN",), ("san  juan",), ("éa b-c",), ("",), (None,)], "x string",
                 text.title_case(F.col("x")))
    assert got == ["SAN JUAN", "San  Juan", "éa B-c", "", None]


def test_ascii_and_names(values):
    got = values([("Garífuna ß Æ 日",)], "x string", text.to_ascii(F.col("x")))
    assert got == ["Garifuna ss AE ?"]
    assert text.ascii_text("Garífuna ß Æ 日") == "Garifuna ss AE ?"
    got = values([("  SAN JOSÉ   Pinula ",), ("\tx ",)], "x string",
                 text.standard_name(F.col("x")), text.header_name(F.col("x")))
    assert got == [("San Jose   Pinula", "_san_jose_pinula_"), ("\tx", "\tx_")]


def test_pad_never_truncates(values):
    got = values([("2009",), ("9",), ("",), (None,)], "x string", text.pad_left(F.col("x")))
    assert got == ["2009", "09", "00", None]


def test_safe_numbers(values):
    data = [("5.7",), ("-5.7",), ("80+",), (" 12 ",), ("5d",), ("1e3",), ("",), ("NaN",),
            ("99999999999",), (None,)]
    got = values(data, "x string", numbers.safe_int(F.col("x")))
    assert got == [5, -5, None, 12, None, 1000, None, None, None, None]


def test_strict_sum(spark, rows):
    df = rows([("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0)], "k string, v double")
    got = dict(df.groupBy("k").agg(numbers.strict_sum(F.col("v"))).collect())
    assert got == {"a": None, "b": 5.0}


def test_share_of_zero_total(values):
    got = values([(0.0, 0.0), (1.0, 0.0), (-1.0, 0.0), (None, 0.0), (1.0, 4.0), (1.0, None)],
                 "x double, t double", numbers.share(F.col("x"), F.col("t")))
    assert math.isnan(got[0]) and got[1:] == [math.inf, -math.inf, None, 0.25, None]


def test_kilograms(values):
    got = values([("6", "8"), ("99", "1"), ("6", "99"), ("6", None), (None, "99"), ("x", "1")],
                 "lb string, oz string", numbers.kilograms(F.col("lb"), F.col("oz")))
    assert abs(got[0] - 6.5 / 2.20462) < 1e-12 and got[1:] == [None] * 5


def test_parse_ymd(values):
    data = [("2009", "3", "5"), ("9", "03", "05"), ("68", "1", "1"), ("69", "1", "1"),
            ("2009", "2", "30"), ("2009", "13", "1"), ("201", "1", "1"), (None, "1", "1"),
            ("+9", "1", "1"), ("2009", "1", "5T"), ("2009", None, "1"), ("2012", "2", "29")]
    got = values(data, "y string, m string, d string",
                 dates.parse_ymd(F.col("y"), F.col("m"), F.col("d")))
    assert got == [D(2009, 3, 5), D(2009, 3, 5), D(2068, 1, 1), D(1969, 1, 1), None, None, None,
                   None, None, None, None, D(2012, 2, 29)]


def test_next_boundary(values):
    data = [(D(2010, 6, 30),), (D(2010, 7, 1),), (D(2010, 12, 31),), (D(2012, 2, 29),), (None,)]
    got = values(data, "d date", dates.next_boundary(F.col("d")),
                 dates.next_boundary(F.col("d"), 1), dates.next_boundary(F.col("d"), 12))
    assert got == [
        (D(2010, 7, 1), D(2011, 1, 1), D(2010, 12, 1)),
        (D(2011, 7, 1), D(2011, 1, 1), D(2010, 12, 1)),
        (D(2011, 7, 1), D(2011, 1, 1), D(2011, 12, 1)),
        (D(2012, 7, 1), D(2013, 1, 1), D(2012, 12, 1)),
        (None, None, None),
    ]


def test_next_boundary_of_every_day(spark):
    days = spark.sql("SELECT explode(sequence(date'1999-12-25', date'2005-01-05')) AS d")
    boundary = dates.next_boundary(F.col("d"))
    wrong = days.filter((boundary <= F.col("d")) | (F.date_sub(boundary, 366) > F.col("d"))
                        | (F.date_format(boundary, "MM-dd") != "07-01")
                        | (F.add_months(boundary, -12) > F.col("d")))
    assert wrong.count() == 0


def test_shift_back(values):
    data = [(D(2015, 3, 31), 1, "months"), (D(2015, 3, 30), 1, "months"),
            (D(2015, 3, 31), 2, "months"), (D(2015, 3, 1), 1, "days"),
            (D(2016, 2, 29), 1, "years"), (D(2015, 3, 1), 1, None), (D(2015, 3, 1), None, "days")]
    got = values(data, "d date, n int, u string",
                 dates.shift_back(F.col("d"), F.col("n"), F.col("u")))
    assert got == [None, None, D(2015, 1, 31), D(2015, 2, 28), None, None, None]


def test_year_repair(values):
    data = [(None, "9"), ("9", "2010"), ("10", None), ("2012", "2013"), (None, None), ("x", "1")]
    got = values(data, "e string, r string", repaired_year(F.col("e"), F.col("r")))
    assert got == [9, 2009, 2010, 2012, None, None]


def test_maps_and_conditions(values):
    x = F.col("x")
    got = values([("a",), ("z",), (None,)], "x string", recode.recode(x, {"a": "b"}),
                 recode.recode(x, {"a": "b"}, F.lit("d")), recode.recode_known(x, {"a": "b"}),
                 recode.ordinal(x, ["q", "a"]), recode.in_domain(x, ["q", "a"]),
                 recode.if_else(x == "a", F.lit(1), F.lit(0)))
    assert got == [("b", "b", "b", 2, "a", 1), ("z", "d", None, None, None, 0),
                   (None, "d", None, None, None, None)]


def test_derive_sees_replaced_columns(rows):
    df = derive(rows([(1,)], "a int"), a=F.col("a") + 1, b=F.col("a") * 10)
    assert df.first() == (2, 20)


def test_empty_value_maps(values):
    from midyear.functions.recode import ordinal, recode, recode_known

    c = F.col("c")
    assert values([("x",), (None,)], "c string", recode(c, {}), recode(c, {}, default=F.lit("d")),
                  recode_known(c, {}), ordinal(c, [])) == [("x", "d", None, None), (None, "d", None, None)]
