"""Property: Brazilian money text -> number round trip (format then parse)."""
from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.functions import formatting as Fm
from vitrine.functions import parsing as P


def br_text(cents: int) -> str:
    """Reference rendering: thousands '.', decimal ','."""
    sign = "-" if cents < 0 else ""
    whole, frac = divmod(abs(cents), 100)
    return f"{sign}{whole:,}".replace(",", ".") + f",{frac:02d}"


@settings(max_examples=1, deadline=None)
@given(st.lists(st.integers(min_value=-10**13, max_value=10**13), min_size=50, max_size=200))
def test_parse_br_text(spark, values):
    df = spark.createDataFrame([(br_text(v), v) for v in values], "s string, cents long")
    for r in df.select(P.money_br(df, "s").alias("x"), "cents").collect():
        assert r["x"] == float(Decimal(r["cents"]) / 100)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.floats(min_value=-1e9, max_value=1e9, allow_nan=False), min_size=50,
                max_size=200))
def test_render_then_parse(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    out = df.select("x", Fm.br_number_text("x", 2).alias("s"))
    back = out.select("x", "s", P.money_br(out, "s").alias("y")).collect()
    for r in back:
        expect = float(Decimal(r["x"]).quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN))
        assert r["y"] == expect, (r["x"], r["s"], r["y"])
