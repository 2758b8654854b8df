from datetime import date
from decimal import Decimal

import pytest
from helpers import as_dicts
from pyspark.sql import functions as F

from claimflow.functions.expressions import is_missing
from claimflow.operators import checks, cleaning, grouping, picking, relational, shaping
from claimflow.sources import tables


def test_fill_rules_differ(spark):
    df = spark.createDataFrame([("", "5"), ("-", "0"), ("7", None), ("1,000", "2")], "a string, b string")
    each = [tuple(r) for r in cleaning.zero_if_missing(df, ["a", "b"]).collect()]
    assert each == [(0, 5), (0, 0), (7, 0), (1000, 2)]
    joint = [tuple(r) for r in cleaning.zero_if_any_missing(df, ["a", "b"]).collect()]
    assert joint == [(0, 0), (0, 0), (0, 0), (1000, 2)]
    assert cleaning.rows_missing(df, ["a", "b"]).count() == 3
    assert [r["a"] for r in cleaning.null_if_missing(df, ["a"]).collect()] == [None, None, "7", "1,000"]
    assert [r["a"] for r in cleaning.label_if_missing(df, "a", "Unknown").collect()] == ["Unknown", "Unknown", "7", "1,000"]


def test_patches_overwrite_single_cells(spark, tiny_splits):
    df = spark.createDataFrame(
        [("C1", date(2022, 1, 1), "x", i) for i in range(30)] + [("C2", None, "y", 0)],
        "claimnumber string, d date, s string, i int",
    )
    patches = spark.createDataFrame(
        [("C1", "d", "2022-08-06"), ("C2", "s", "fixed"), ("C9", "s", "nobody")],
        "claimnumber string, column_name string, new_value string",
    )
    got = cleaning.apply_patches(df, patches, "claimnumber", ["d", "s"])
    assert {(r["d"], r["s"]) for r in got.where("claimnumber = 'C1'").collect()} == {(date(2022, 8, 6), "x")}
    assert tuple(got.where("claimnumber = 'C2'").select("d", "s").first()) == (None, "fixed")
    twice = patches.union(patches)
    with pytest.raises(Exception, match="several patch values"):
        cleaning.apply_patches(df, twice, "claimnumber", ["d", "s"]).collect()


def test_gross_up_and_costs(spark):
    df = spark.createDataFrame([("92593", "", "500", "")], "net string, a string, b string, t string")
    row = cleaning.derive_total_cost(df, "a", "b", "t").select(
        "t", cleaning.gross_up(F.col("net").cast("decimal(15,2)")).alias("g")
    ).first()
    assert (row["t"], row["g"]) == (Decimal("500.00"), Decimal("100000.00"))


def test_contract_projection_prunes_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("1,000", "31/01/2022", "x")], "ubt string, day string, unused string").write.parquet(path)
    contract = (shaping.Field("ubt", "estimate", "money"), shaping.Field("day", "updateddate", "date", "dd/MM/yyyy"))
    out = shaping.project(spark.read.parquet(path), contract)
    assert tuple(out.first()) == (Decimal("1000.00"), date(2022, 1, 31))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan
    with pytest.raises(ValueError):
        shaping.Field("a", "b", "other").expression()


def test_profile_and_schema_diff(spark):
    a = spark.createDataFrame([("x", None), ("-", 3)], "k string, n int")
    b = spark.createDataFrame([("x", "y")], "k string, other string")
    got = {r["column_name"]: r for r in as_dicts(shaping.profile(a, distinct=True))}
    assert (got["k"]["markers"], got["n"]["nulls"], got["k"]["approx_distinct"]) == (1, 1, 2)
    diff = {r["column_name"]: r["presence"] for r in as_dicts(shaping.schema_diff(a, b))}
    assert diff == {"k": "both", "n": "only a", "other": "only b"}


def test_small_shaping_tools(spark):
    df = spark.createDataFrame([("é", 0, 1), ("ab", 0, -2)], "t string, z int, n int")
    assert shaping.max_length(df, "t").first()[0] == 2
    assert {r["column_name"] for r in as_dicts(shaping.zero_columns(df, ["z", "n"])) if r["all_zero"]} == {"z"}
    assert dict(shaping.add_empty(df, {"d": "date"}).dtypes)["d"] == "date"
    indexed = shaping.with_row_index(df)
    again = shaping.with_row_index(df.repartition(3))
    assert {r["row_index"] for r in indexed.collect()} == {r["row_index"] for r in again.collect()}
    assert shaping.cast_columns(df, {"t": "int"}).where("t is null").count() == 2


def test_row_index_tells_swapped_nulls_apart(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (None, None), (1, 1)], "a int, b int")
    indexed = shaping.with_row_index(df)
    assert indexed.select("row_index").distinct().count() == 4
    again = {tuple(r) for r in shaping.with_row_index(df.repartition(7)).collect()}
    assert again == {tuple(r) for r in indexed.collect()}


def test_unreadable_values_are_counted(spark):
    contract = (
        shaping.Field("m", "money", "money0"),
        shaping.Field("d", "day", "date", "dd/MM/yyyy"),
        shaping.Field("t", "text"),
    )
    raw = spark.createDataFrame([("1,000", "31/01/2022", "x"), ("abc", "2022-01-31", "x"), ("-", "", "x"), (None, None, None)], "m string, d string, t string")
    got = sorted(map(tuple, checks.unreadable_report(raw, contract).collect()))
    assert got == [("day", 2, 1), ("money", 2, 1)]


def test_distinct_counts_of_all_sources(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), (None, 2)], "k string, n int")
    got = sorted(map(tuple, shaping.distinct_counts({"a": a, "b": a.limit(0).union(a.where("n = 1"))}, ["k", "n"]).collect()))
    assert got == [("a", 3, 1, 2), ("b", 1, 1, 1)]


def test_months_are_bounded_before_they_are_spread(spark):
    df = spark.sql("select date'2022-01-31' as a, date'9999-03-01' as b union all select date'1000-05-02', date'1000-05-03'")
    out = relational.expand_months(df, "a", "b", since="2022-02-01", until="2022-04-15")
    assert sorted(str(r["calendar_month"]) for r in out.collect()) == ["2022-02-01", "2022-03-01", "2022-04-01"]
    assert relational.keys_only_in(df, df.where("a > date'2000-01-01'"), ["a"]).count() == 1


def test_value_lists(spark):
    df = spark.createDataFrame([("C", "b"), ("C", "a"), ("C", "b"), ("C", None), ("D", "x")], "k string, v string")
    distinct = {r["k"]: r["values"] for r in as_dicts(grouping.concat_distinct(df, ["k"], "v"))}
    assert distinct == {"C": "a, b", "D": "x"}
    every = {r["k"]: r["values"] for r in as_dicts(grouping.concat_all(df, ["k"], "v"))}
    assert {k: [tuple(x) for x in v] for k, v in every.items()} == {"C": [("a", 1), ("b", 2)], "D": [("x", 1)]}
    spelled = grouping.concat_all(df, ["k"], "v").withColumn("values", grouping.spelled(F.col("values")))
    assert {r["k"]: (r["values"], r["n_values"]) for r in as_dicts(spelled)} == {"C": ("a,b,b", 3), "D": ("x", 1)}


def test_copies_are_removed(spark):
    df = spark.createDataFrame([("C", "s", 1, 5), ("C", "s", 1, 3), ("C", "t", 1, 4)] * 3, "c string, s string, a int, i int")
    kept = picking.dedupe(df, ["c", "s", "a"], [F.asc("i")])
    assert sorted(map(tuple, kept.collect())) == [("C", "s", 1, 3), ("C", "t", 1, 4)]
    sizes = picking.keep_last(df, ["c", "s"], ["i"])
    assert sorted((r["s"], r["i"], r["group_size"]) for r in sizes.collect()) == [("s", 5, 6), ("t", 4, 3)]
    pairs = grouping.having_distinct(df, ["c"], "s", F.col("n_distinct") > 1)
    assert tuple(pairs.first()) == ("C", 9, 2)


def test_imputation_takes_the_first_of_tied_modes(spark, tiny_splits):
    rows = [("h", "B"), ("h", "A"), ("h", ""), ("g", "-"), ("f", "Z"), ("f", "Z"), ("f", "A"), ("f", "")]
    df = spark.createDataFrame(rows, "who string, unit string")
    got = sorted(map(tuple, grouping.impute_by_mode(df, "who", "unit", is_missing("unit")).collect()))
    assert got == sorted([("h", "B"), ("h", "A"), ("h", "A"), ("g", "-"), ("f", "Z"), ("f", "Z"), ("f", "A"), ("f", "Z")])


def test_deletes_keep_rows_with_unknown_predicates(spark):
    df = spark.createDataFrame([("a", 0), ("b", None), ("c", 1)], "k string, v int")
    assert sorted(r["k"] for r in relational.delete_where(df, F.col("v") == 0).collect()) == ["b", "c"]
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    assert sorted(r["k"] for r in relational.delete_matching(df, keys, ["k"], F.col("v") == 0).collect()) == ["b", "c"]
    assert [r["k"] for r in relational.delete_matching(df, keys, ["k"]).collect()] == ["c"]


def test_date_rules_and_reports(spark):
    df = spark.sql(
        "select * from values ('C1', date'2022-01-05', date'2022-01-03', date'2022-01-09', date'2022-01-04', ''), "
        "('C2', date'2022-01-01', null, date'2022-01-01', date'2022-01-04', 'x') "
        "as t(claimnumber, claim_submitted_date, claim_opened_date, claim_accident_date, updateddate, unit)"
    )
    broken = sorted(map(tuple, checks.check_order(df, ["claimnumber"]).collect()))
    assert broken == [("C1", r) for r in sorted(("submitted after opened", "accident after submitted", "accident after opened", "accident after updated"))]
    report = {r["column_name"]: r["missing_rows"] for r in as_dicts(checks.missing_report(df, ["unit", "claim_opened_date"], "claimnumber"))}
    assert report == {"unit": 1, "claim_opened_date": 1}
    whole = checks.missing_report(df, ["unit", "claimnumber"], "claimnumber")
    assert sorted(map(tuple, whole.collect())) == [("claimnumber", 0, 0), ("unit", 1, 1)]
    reached = checks.milestone_coverage(df, ["claim_opened_date", "updateddate"])
    assert sorted(map(tuple, reached.collect())) == [("claim_opened_date", 1, 1), ("updateddate", 2, 0)]
    assert checks.check_future(df, "updateddate").count() == 0
    assert checks.assert_unique(df, ["claimnumber"]).count() == 0
    assert checks.assert_none(df, F.col("unit") == "").first()[0] == 1


def test_reconciliation(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", None)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("z", 5), ("y", 3)], "k string, v int")
    assert dict(map(tuple, checks.reconcile_keys(a, b, "k").collect())) == {"x": "both", "y": "both", "z": "only b"}
    assert sorted(map(tuple, checks.reconcile_values(a, b, ["k"], ["v"]).collect())) == [("x", 2, 1), ("y", None, 3)]
    assert [r["k"] for r in checks.recoverable(a, b, "k", "v").collect()] == ["y"]


def test_stages_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "s string, n int")
    path = str(tmp_path / "stage")
    saved = tables.save_stage(df, path, ["s"])
    assert sorted(map(tuple, saved.select("s", "n").collect())) == [("a", 1), ("b", 2)]
    plain = str(tmp_path / "plain")
    tables.save_stage(df, plain)
    tables.append_stage(df, plain)
    assert spark.read.parquet(plain).count() == 4
    text = str(tmp_path / "text.csv")
    with open(text, "w") as f:
        f.write('claim,amount\nC1,"1,000"\nC2,-\n')
    read = tables.load_text(spark, text, "claim string, amount string")
    assert [tuple(r) for r in read.collect()] == [("C1", "1,000"), ("C2", "-")]
    tables.register_views(spark, {"v_small": lambda: df})
    assert spark.sql("select count(*) from v_small").first()[0] == 2


def test_month_expansion_is_no_range_join(spark):
    df = spark.sql("select date'2022-01-31' as a, date'2022-03-01' as b union all select date'2022-05-02', date'2022-05-01'")
    out = relational.expand_months(df, "a", "b")
    assert [str(r["calendar_month"]) for r in out.orderBy("calendar_month").collect()] == ["2022-01-01", "2022-02-01", "2022-03-01"]
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
