import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from claimflow.operators import picking
from claimflow.operators.relational import missing_in, rows_of, unique_source, update_from
from claimflow.operators.skew import join_facts, with_facts


def rows(spark, hot=400, cold=200):
    rng = random.Random(3)
    data = [("hot", i, rng.randint(0, 3)) for i in range(hot)]
    data += [("hot", 7, 1)] * 50  # copies of one row
    data += [(f"k{rng.randint(0, 40)}", i, rng.randint(0, 3)) for i in range(cold)]
    return spark.createDataFrame(data, "k string, i int, v int").repartition(6)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    order = sorted(a.columns)
    assert sorted(map(tuple, a.select(order).collect()), key=repr) == sorted(map(tuple, b.select(order).collect()), key=repr)


def test_joins_with_facts_equal_plain_joins(spark, tiny_splits):
    df = rows(spark)
    facts = df.where("k <> 'k3'").groupBy("k").agg(F.max("v").alias("m"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        same(join_facts(df, facts, ["k"], how), df.join(facts, "k", how))


def test_a_heavy_key_is_split_by_adaptive_execution(spark, tiny_splits):
    df = rows(spark, hot=6000)
    for joined in (
        join_facts(df, df.groupBy("k").agg(F.max("v").alias("m")), ["k"], "inner"),
        with_facts(df, ["k"], m=F.max("v")),
        picking.at_latest(df, ["k"], "v"),
        missing_in(df, df.where("v = 9"), ["k"]),
    ):
        got = joined.withColumn("__p", F.spark_partition_id()).collect()
        sizes = Counter(r["__p"] for r in got if r["k"] == "hot")
        assert len(sizes) >= 3 and max(sizes.values()) < 0.6 * sum(sizes.values())


def test_no_plan_samples_or_salts(spark):
    df = rows(spark)
    plan = with_facts(df, ["k"], m=F.max("v"))._jdf.queryExecution().toString()
    assert "approx_top_k" not in plan and "SinglePartition" not in plan


def test_write_back_equals_window(spark, tiny_splits):
    df = rows(spark)
    w = Window.partitionBy("k")
    same(with_facts(df, ["k"], s=F.sum("v"), n=F.count(F.lit(1))), df.withColumns({"s": F.sum("v").over(w), "n": F.count("*").over(w)}))


def test_choices_equal_windows(spark, tiny_splits):
    df = rows(spark)
    w = Window.partitionBy("k")
    same(picking.at_latest(df, ["k"], "v"), df.withColumn("m", F.max("v").over(w)).where("v = m").drop("m"))
    same(picking.duplicated_rows(df, ["k", "i"]), df.withColumn("n", F.count("*").over(Window.partitionBy("k", "i"))).where("n > 1").drop("n"))
    ranked = df.withColumn("r", F.rank().over(w.orderBy(F.desc("v"), F.desc("i")))).where("r = 1").drop("r")
    same(picking.best_per(df, ["k"], [F.col("v"), F.col("i")]), ranked)


def test_null_keys_do_not_empty_the_anti_join(spark):
    a = spark.createDataFrame([("x",), ("y",)], "k string")
    b = spark.createDataFrame([("x",), (None,)], "k string")
    assert [r["k"] for r in missing_in(a, b, ["k"]).collect()] == ["y"]
    assert [r["k"] for r in rows_of(a, b, ["k"]).collect()] == ["x"]


def test_rows_without_a_key_are_kept(spark, tiny_splits):
    df = spark.createDataFrame([(None, i % 3) for i in range(20)] + [("a", 1), ("a", 2), ("b", 0)], "k string, v int")
    w = Window.partitionBy("k")
    same(with_facts(df, ["k"], m=F.max("v")), df.withColumn("m", F.max("v").over(w)))
    same(picking.at_latest(df, ["k"], "v"), df.withColumn("m", F.max("v").over(w)).where("v = m").drop("m"))
    assert picking.duplicated_rows(df, ["k"]).count() == 22
    assert picking.best_per(df, ["k"], [F.col("v")]).where("k is null").count() == 6
    sizes = {r["k"]: r["group_size"] for r in picking.keep_last(df, ["k"], ["v"]).collect()}
    assert sizes == {None: 20, "a": 2, "b": 1}


def test_update_source_with_two_rows_per_key_is_rejected(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    good = spark.createDataFrame([("x", 9)], "k string, v int")
    bad = spark.createDataFrame([("x", 9), ("x", 8)], "k string, v int")
    assert sorted(map(tuple, update_from(a, good, ["k"], ["v"]).collect())) == [("x", 9), ("y", 2)]
    guarded = update_from(a, good, ["k"], ["v"], F.col("v") > 5)
    assert sorted(map(tuple, guarded.collect())) == [("x", 1), ("y", 2)]
    with pytest.raises(Exception, match="several rows for one key"):
        update_from(a, bad, ["k"], ["v"]).collect()
    assert unique_source(good, ["k"], ["v"]).count() == 1


def test_one_row_choice_is_cut_on_the_map_side(spark):
    df = rows(spark)
    picked = picking.pick(df, ["k"], [F.asc("i"), F.asc("v")])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert picked.count() == df.select("k").distinct().count()


def test_results_do_not_depend_on_partitioning(spark, tiny_splits):
    df = rows(spark)
    for change in (df.repartition(7), df.coalesce(1), df.orderBy(F.desc("i"))):
        same(picking.at_latest(change, ["k"], "v"), picking.at_latest(df, ["k"], "v"))
        same(picking.dedupe(change, ["k", "v"], [F.asc("i")]), picking.dedupe(df, ["k", "v"], [F.asc("i")]))
