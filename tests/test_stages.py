"""Stages checked while written, changed by partitions and removed; rejected lines; distinct counts that add up."""

import random
import time
from pathlib import Path

import oracle
import pytest
from pyspark.sql import functions as F

from claimflow.operators import distinct
from claimflow.operators.shaping import Field
from claimflow.sources import stages, tables


def files_of(path):
    return {f: f.read_bytes() for f in Path(path.removeprefix("file://")).rglob("*.parquet")}


def a_stage(spark, rows):
    path = tables.new_path(spark, "stage")
    tables.save_stage(spark.createDataFrame(rows, "k string, v int, year int"), path, ["year"])
    return path


def test_only_touched_partitions_are_rewritten(spark):
    rows = [(f"K{k}", k % 5, 2000 + k % 4) for k in range(200)]
    path = a_stage(spark, rows)
    before = files_of(path)
    changes = spark.createDataFrame([("K1", 90, 2001), ("K5", None, 2001), ("K3", 91, 2003), ("no", 92, 2003)], "k string, v int, year int")
    run = lambda: stages.rewrite_partitions(path, changes, "year", ["k"], ["v"])
    read = lambda: sorted(map(tuple, spark.read.parquet(path).select("k", "v", "year").collect()), key=str)
    assert run() == [2001, 2003]
    want = sorted([(k, {"K1": 90, "K5": None, "K3": 91}.get(k, v), y) for k, v, y in rows], key=str)
    assert read() == want
    after = files_of(path)
    assert {f for f in after if "year=2000" in str(f) or "year=2002" in str(f)} == {f for f in before if "year=2000" in str(f) or "year=2002" in str(f)}
    assert not any(f in after for f in before if "year=2001" in str(f) or "year=2003" in str(f))
    rows_of = lambda found: sorted(Path(f).parent.name for f in found)
    assert run() == [2001, 2003] and read() == want and rows_of(files_of(path)) == rows_of(after)


def test_a_change_of_nothing(spark):
    path = a_stage(spark, [("K", 1, 2000)])
    before = files_of(path)
    none = spark.createDataFrame([], "k string, v int, year int")
    assert stages.rewrite_partitions(path, none, "year", ["k"], ["v"]) == [] and files_of(path) == before
    guarded = spark.createDataFrame([("K", 5, 2000)], none.schema)
    stages.rewrite_partitions(path, guarded, "year", ["k"], ["v"], F.col("v") > 1)
    assert spark.read.parquet(path).first()["v"] == 1


def test_two_changes_of_one_key_fail(spark):
    path = a_stage(spark, [("K", 1, 2000)])
    twice = spark.createDataFrame([("K", 5, 2000), ("K", 6, 2000)], "k string, v int, year int")
    with pytest.raises(Exception, match="(?i)key|source|unique|row"):
        stages.rewrite_partitions(path, twice, "year", ["k"], ["v"])
    assert spark.read.parquet(path).first()["v"] == 1


def test_stages_are_removed_from_the_shared_folder_alone(spark, tmp_path):
    path = a_stage(spark, [("K", 1, 2000)])
    assert stages.drop_stage(spark, path) and not Path(path.removeprefix("file://")).exists()
    assert not stages.drop_stage(spark, path)
    for other in (str(tmp_path), f"{tables.shared_folder(spark)}/../x", tables.shared_folder(spark)):
        with pytest.raises(ValueError, match="does not lie"):
            stages.drop_stage(spark, other)
    assert tmp_path.exists()


def test_violations_come_from_the_writing_job(spark):
    rows = [(f"K{k}", None if k % 7 == 0 else k, 2000) for k in range(100)]
    df = spark.createDataFrame(rows, "k string, v int, year int").repartition(6)
    rules = {"large": F.col("v") > 90, "even": F.col("v") % 2 == 0, "never": F.lit(False)}
    tracker, before = spark.sparkContext.statusTracker(), None
    spark.sparkContext.setJobGroup("checked", "write")
    written, found = stages.save_checked(df, tables.new_path(spark, "checked"), rules)
    before = len(tracker.getJobIdsForGroup("checked"))
    got = {r["rule"]: (r["violations"], r["checked"]) for r in found.collect()}
    values = [v for _, v, _ in rows if v is not None]
    assert got == {"large": (sum(v > 90 for v in values), 100), "even": (sum(v % 2 == 0 for v in values), 100), "never": (0, 100)}
    assert written.count() == 100 and before <= 2  # with adaptive execution the shuffle is a job of its own


def test_lines_that_cannot_be_read_are_kept(spark, tmp_path):
    lines = ["k,day,amount", 'A,01/02/2024,"1,234.50"', "B,-,", "C,31/02/2024,7", "D,01/02/2024", "E,01/02/2024,5,more", 'F,x,"y,z"', "", "G,,12.00"]
    for n in (1, 2):
        (tmp_path / f"{n}.csv").write_text("\n".join(lines) + "\n")
    contract = (Field("k", "k"), Field("day", "day", "date", "dd/MM/yyyy"), Field("amount", "amount", "money"))
    read, rejected = tables.load_text_checked(spark, str(tmp_path), "k string, day string, amount string", contract)
    assert read.columns == ["k", "day", "amount"] and sorted(r["k"] for r in read.collect()) == ["A", "A", "B", "B", "G", "G"]
    got = sorted((r["record"], tuple(r["reasons"])) for r in rejected.collect())
    one = [
        ("C,31/02/2024,7", ("unreadable day",)),
        ("D,01/02/2024", ("columns",)),
        ("E,01/02/2024,5,more", ("columns",)),
        ('F,x,"y,z"', ("unreadable day", "unreadable amount")),
    ]
    assert got == sorted(one * 2)
    assert read.count() + rejected.count() == 2 * (len(lines) - 2)
    amounts = [r["amount"] for r in read.select("amount").collect()]  # whatever columns are asked for
    assert sorted(a or "" for a in amounts) == ["", "", "1,234.50", "1,234.50", "12.00", "12.00"]


def test_sketches_add_up(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randint(1, 4), rng.choice([None, *range(60_000)])) for _ in range(60_000)]
    df = spark.createDataFrame(rows, "source string, month int, k int").repartition(5)
    kept = distinct.sketches(df, ["source", "month"], "k")
    sets = {s: {k for x, _, k in rows if x == s and k is not None} for s in "ab"}
    per_source = distinct.unite(kept, ["source"])
    got = {r["source"]: r["n"] for r in distinct.counted(per_source).collect()}
    for s in "ab":
        assert abs(got[s] - len(sets[s])) <= 4 * distinct.error() * len(sets[s])
    a, b = (per_source.where(F.col("source") == s).withColumn("one", F.lit(1)) for s in "ab")
    both = distinct.shared(a, b, ["one"]).first()["n_shared"]
    assert abs(both - len(sets["a"] & sets["b"])) <= 4 * distinct.error() * len(sets["a"] | sets["b"])


def test_small_groups_are_counted_exactly(spark):
    df = spark.createDataFrame([("a", k % 300) for k in range(900)] + [("b", None)], "g string, k int").repartition(4)
    assert {r["g"]: r["n"] for r in distinct.counted(distinct.sketches(df, ["g"], "k")).collect()} == {"a": 300, "b": 0}


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}


def test_work_by_slices_is_that_on_all_rows_and_leaves_no_shuffles(spark):
    rows = spark.createDataFrame([(None if k % 50 == 0 else f"K{k % 90}", k) for k in range(1000)], "k string, v int")
    work = lambda df: df.groupBy("k").agg(F.count("v").alias("n"), F.max("v").alias("last")).join(df.where("v < 300"), "k", "left")
    want = sorted(map(tuple, work(rows).collect()), key=str)
    own = spark.conf.get(stages.CLEANUP_CONF)
    for slices in (1, 3, 40):
        before = shuffle_files(spark)
        got = stages.by_slices(rows.repartition(5, "v"), ["k"], work, slices, "sliced")
        until = time.time() + 20
        while shuffle_files(spark) - before and time.time() < until:  # files go a moment after the job ends
            time.sleep(0.2)
        assert not shuffle_files(spark) - before
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert spark.conf.get(stages.CLEANUP_CONF) == own


def test_a_slice_holds_as_many_rows_for_every_core(spark):
    cores = spark.sparkContext.defaultParallelism
    most = stages.ROWS_A_CORE * cores
    assert [stages.slices_for(spark, n) for n in (0, 1, most, most + 1, 10 * most)] == [1, 1, 1, 2, 10]


def test_the_chain_of_reductions_by_slices(spark, monkeypatch):
    from claimflow.plans.queries import ORACLE, QUERIES

    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(stages, "ROWS_A_CORE", 250)
    seen = []
    real = stages.save_stage
    monkeypatch.setattr(stages, "save_stage", lambda df, *more: seen.append(df.columns) or real(df, *more))
    ok, text = oracle.compare(QUERIES["j_chain_reduced_claims"](spark, folder), oracle.connect(folder), ORACLE["j_chain_reduced_claims"])
    assert ok, text
    assert len(seen) == 1 and stages.SLICE in seen[0]
