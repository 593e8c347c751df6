"""Scalar parsing and rendering on inline edge rows (FIXTURES §5)."""
from datetime import date

from pyspark.sql import functions as F

from vitrine.functions import formatting as Fm
from vitrine.functions import parsing as P


def test_money_br_text(spark):
    rows = [("29,9",), ("1.500,00",), ("2093",), (" 29,9 ",), ("-1,5",), ("",), ("abc",),
            ("R$ 10,00",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    got = [r[0] for r in df.select(P.money_br(df, "v")).collect()]
    assert got == [29.9, 1500.0, 2093.0, 29.9, -1.5, None, None, None, None]


def test_money_br_numeric_passthrough(spark):
    """A typed column is not re-parsed (1500.5 must not become 15005)."""
    df = spark.createDataFrame([(1500.5,)], "v double")
    assert df.select(P.money_br(df, "v")).first()[0] == 1500.5


def test_rating_keeps_dot(spark):
    df = spark.createDataFrame([("4,8",), ("4.8",), (" 5,00 ",)], "v string")
    assert [r[0] for r in df.select(P.rating_br(df, "v")).collect()] == [4.8, 4.8, 5.0]


def test_booleans_and_ints(spark):
    df = spark.createDataFrame([(0, "3"), (1, "x"), (2, None), (None, "12")], "b long, i string")
    got = df.select(P.to_boolean("b"), P.to_int("i")).collect()
    assert [tuple(r) for r in got] == [(False, 3), (True, None), (True, None), (None, 12)]


def test_currency_text(spark):
    df = spark.createDataFrame([(1234567.891,), (0.125,), (2.5,)], "x double")
    got = df.select(Fm.br_number_text("x", 2), Fm.br_number_text("x", 0), Fm.format_brl("x")).collect()
    assert got[0][0] == "1.234.567,89" and got[0][2] == "R$ 1.234.567,89"
    assert got[1][0] == "0,12"
    assert got[2][1] == "2"


def test_date_br_and_markup(spark):
    df = spark.createDataFrame([(date(2026, 9, 18), "*Oi* _[x]_ `y`")], "d date, s string")
    r = df.select(Fm.format_date_br("d"), Fm.strip_markup("s")).first()
    assert r[0] == "18/09/2026" and r[1] == "Oi x y"


def test_sanitize_and_titles(spark):
    df = spark.createDataFrame([("a;b\r\nc",), (None,)], "s string")
    assert [r[0] for r in df.select(Fm.sanitize_text("s")).collect()] == ["a,b  c", ""]
    assert Fm.column_title("faturamento_total") == "Faturamento Total"


def test_word_match_accents(spark):
    df = spark.createDataFrame([("quanto vendeu móveis hoje",), ("automóveis",), ("móveis",)],
                               "t string")
    got = [r[0] for r in df.select(Fm.word_match("t", "móveis")).collect()]
    assert got == [True, False, True]
