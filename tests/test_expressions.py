from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimflow.functions import expressions as x
from claimflow.functions import vocabulary as v
from claimflow.session import compiled
from claimflow.sources.adapters import _commas, _day, _dmy


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(expression(F.col("c")).alias("r")).first()["r"]


def test_missing_markers(spark):
    for value, expected in ((None, True), ("", True), ("-", True), (" - ", True), ("0", False), ("a-b", False)):
        assert one(spark, value, x.is_missing) is expected
    assert one(spark, None, x.is_missing, "decimal(15,2)") is True


def test_money(spark):
    cases = {
        "1,234,000": Decimal("1234000.00"),
        "0": Decimal("0.00"),
        " 12.5 ": Decimal("12.50"),
        "-": None,
        "": None,
        None: None,
        "12x": None,
    }
    for text, expected in cases.items():
        assert one(spark, text, x.parse_money) == expected
    assert one(spark, "-", x.money_or_zero) == Decimal("0.00")


def test_dates_in_four_patterns(spark):
    from claimflow.sources.contracts import DMY, DMY_DASH, ISO, STAMP

    good = {DMY: "31/12/2021", DMY_DASH: "31-12-2021", ISO: "2021-12-31", STAMP: "Dec 31, 2021 @ 11:51:38.000"}
    for fmt, text in good.items():
        assert one(spark, text, lambda c, fmt=fmt: x.parse_date(c, fmt)) == date(2021, 12, 31)
        assert one(spark, "-", lambda c, fmt=fmt: x.parse_date(c, fmt)) is None
        assert one(spark, "2021/31/12", lambda c, fmt=fmt: x.parse_date(c, fmt)) is None


def test_both_spellings_of_cancelled(spark):
    for text in ("Đã hủy", "Đã huỷ", " đã HUỶ"):
        assert one(spark, text, lambda c: x.map_value(c, v.HISTORY_STATUS)) == "cancelled"
    assert one(spark, "2", lambda c: x.map_value(c, v.HISTORY_STATUS)) is None
    assert one(spark, "2", lambda c: x.map_value(c, v.HISTORY_STATUS, keep=True)) == "2"
    assert one(spark, "2", lambda c: x.map_value(c, v.HISTORY_STATUS, "Unknown")) == "Unknown"


def test_full_months_follow_the_day_of_month(spark):
    pairs = {
        (date(2022, 1, 31), date(2022, 2, 28)): 0,
        (date(2022, 1, 31), date(2022, 3, 31)): 2,
        (date(2022, 1, 20), date(2022, 3, 10)): 1,
        (date(2022, 1, 1), date(2022, 1, 31)): 0,
        (date(2022, 3, 10), date(2022, 1, 20)): -1,
    }
    for (a, b), months in pairs.items():
        df = spark.createDataFrame([(a, b)], "a date, b date")
        assert df.select(x.full_months("a", "b").alias("r")).first()["r"] == months
        assert df.selectExpr("timestampdiff(MONTH, a, b) as r").first()["r"] == months


def test_phrases_are_literal_and_case_blind(spark):
    def has(text, *phrases):
        return one(spark, text, lambda c: x.any_phrase(c, phrases))

    assert has("Lái xe BỊ THƯƠNG nặng", *v.INJURY_PHRASES)
    assert not has("Xe va quệt nhẹ", *v.INJURY_PHRASES)
    assert has("sum a+b (x)", "a+b (x)") and not has("aab x", "a+b (x)")
    assert has(None, "a") is False
    assert has("x" * 300_000 + " tử vong", *v.INJURY_PHRASES)  # whole text, not a prefix


def test_safe_ratio(spark):
    assert one(spark, 0, lambda c: x.ratio(F.lit(1.0), c), "int") is None
    assert one(spark, 4, lambda c: x.ratio(F.lit(1.0), c), "int") == 0.25


def test_text_is_folded_to_one_form(spark):
    import unicodedata

    from claimflow.functions import vocabulary as v
    from claimflow.functions.expressions import any_phrase, bare, bare_text, map_value

    raw = [*v.HISTORY_STATUS, *v.COVERAGE_BY_NAME, *v.HISTORY_DAMAGE, "ĐÃ HUỶ", "hoá đơn", "Thuỷ kích", "ngước ậm ữ"]
    forms = [(x, f(x)) for x in raw for f in (lambda t: t, str.upper, lambda t: unicodedata.normalize("NFD", t))]
    df = spark.createDataFrame(forms, "x string, y string")
    got = df.select("x", bare("y").alias("f")).collect()
    assert all(r["f"] == bare_text(r["x"]) and r["f"].isascii() for r in got)
    named = df.where(F.col("x").isin(*v.HISTORY_STATUS)).select("x", map_value("y", v.HISTORY_STATUS).alias("m"))
    assert all(r["m"] == v.HISTORY_STATUS[r["x"]] for r in named.collect())
    texts = [unicodedata.normalize(f, t) for f in ("NFC", "NFD") for t in ("Lái xe BỊ THƯƠNG nhẹ", "đưa đi Cấp Cứu")]
    flags = spark.createDataFrame([(t,) for t in [*texts, "xe bị xước", None]], "t string").select(any_phrase("t", v.INJURY_PHRASES))
    assert [r[0] for r in flags.collect()] == [True] * 4 + [False] * 2


ODD_DATES = (
    "01/02/2000", "31/12/1999", "31/02/2000", "29/02/2000", "29/02/1900", "1 /02/2000", "1T/02/2000", " 1/02/2000", "01/02/200 ", "01/02/0000",
    "01/02/0001", "-1/02/2000", "01/-2/2000", "01/02/-200", "01/02/+200", "01-02-2000", "01/02-2000", "1/2/2000", "01/02/2000 ", "2000/02/01", "00/01/2000",
    "01/13/2000", "à1/2/2000", "0\n/02/2000", "", "-", " ", None, "text text ", "2000-02-01", "2000-2-001", "2000-02-1 ", "10-11-2012", "9999-12-31", "31/12/9999",
)


@pytest.mark.parametrize("fmt", ["dd/MM/yyyy", "dd-MM-yyyy", "yyyy-MM-dd"])
def test_the_short_way_to_dates_reads_what_the_parser_reads(spark, fmt):
    df = spark.createDataFrame([(d,) for d in ODD_DATES], "d string")
    parser = F.try_to_timestamp(x.blank_to_null("d"), F.lit(fmt)).cast("date")
    rows = df.select("d", x.parse_date("d", fmt).cast("string").alias("got"), parser.cast("string").alias("want")).collect()
    assert [(r["d"], r["got"]) for r in rows] == [(r["d"], r["want"]) for r in rows]
    assert sum(r["got"] is not None for r in rows) >= 2
    plan = df.select(x.parse_date("d", fmt))._jdf.queryExecution().optimizedPlan().toString()
    assert "concat(" in plan and "try_cast" in plan


def test_wide_projections_are_compiled_unless_the_session_says_otherwise(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        compiled(spark)
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "9000")
        compiled(spark)
        assert spark.conf.get(key) == "9000"
    finally:
        spark.conf.set(key, before)


def test_days_put_together_are_those_of_the_formatter(spark):
    days = spark.sql("select explode(sequence(date'1995-12-25', date'2000-03-05')) as base")
    pairs = [(_day("base"), _dmy("base")), (_day("base", "-"), _dmy("base", "dd-MM-yyyy")), (_day("base", "-", "year"), _dmy("base", "yyyy-MM-dd"))]
    assert days.selectExpr(*[f"count_if({a} = {b}) = count(*)" for a, b in pairs]).first() == (True, True, True)


ODD_MONEY = (
    "0", "12", "1,234,567", "1,2,3", "007", "12.5", "1,234.567", "-5", "-", "", " ", " 12", "12 ", "12\t", "12\x7f", "1\x7f2", "1e3", "1E-1", "+7", "abc", "1a", "1 2",
    "9999999999999", "9999999999999.99", "10000000000000", "99999999999999999999", "9223372036854775808", "1-", ",1", "1,", "\u0661\u0662", "1\u0662", ":", None,
)


@pytest.mark.parametrize("money", ["decimal(15,2)", "decimal(5,0)"])
def test_the_short_way_to_money_reads_what_the_decimal_parser_reads(spark, money):
    df = spark.createDataFrame([(t,) for t in ODD_MONEY], "t string")
    text = F.trim("t")
    parser = F.when(~text.isin("", "-"), F.replace(text, F.lit(","), F.lit("")).try_cast(money))
    rows = df.select("t", x.parse_money("t", money).alias("got"), parser.alias("want")).collect()
    assert [(r["t"], r["got"]) for r in rows] == [(r["t"], r["want"]) for r in rows]
    assert sum(r["got"] is not None for r in rows) >= 10
    plan = df.select(x.parse_money("t", money))._jdf.queryExecution().optimizedPlan().toString()
    assert "as bigint" in plan  # whole numbers do not go through the decimal parser


def test_names_found_as_written_need_no_change_of_letters(spark):
    mapping = {"Đã hủy": "a", "ĐÃ HỦY": "b", "Mới": "c"}
    texts = ["Đã hủy", "ĐÃ HỦY", " đã huỷ ", "Mới", "mới", "moi", "da huy", "", "khác", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(x.map_value("t", mapping).alias("m"))
    assert [r["m"] for r in rows.collect()] == ["a", "a", "a", "c", "c", "c", None, None, None, None]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "keys: [Đã hủy,ĐÃ HỦY,Mới]" in plan


def test_thousands_put_together_are_those_of_the_formatter(spark):
    edges = [n * s for n in (0, 1, 9, 10, 999, 1000, 1001, 10007, 999999, 1000000, 1002003, 999999999, 1000000000, 2**53) for s in (1, -1)]
    numbers = spark.createDataFrame([(n,) for n in [*edges, None]], "n bigint")
    rows = numbers.selectExpr("n", f"{_commas('n')} as got", "format_number(n, 0) as want", f"{_commas('n - n div 10')} as less", "format_number(n - n div 10, 0) as want_less").collect()
    assert [(r["n"], r["got"], r["less"]) for r in rows] == [(r["n"], r["want"], r["want_less"]) for r in rows]
