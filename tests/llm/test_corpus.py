"""The registered queries beside their SQL, and the pipeline against brute force."""

import zlib
from collections import defaultdict

import corpus_pipeline
import oracle
import pytest
from test_dedup import brute_stays, lowered
from test_packing import check_mix, check_packing

from claimflow.llm import queries as corpus
from claimflow.llm.common import save
from claimflow.llm.packing import CAPACITIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(corpus.oracle_sql()))
def test_query_equals_sql(spark, name):
    df = corpus.queries()[name](spark, FOLDER)
    flags = [c for c, kind in df.dtypes if kind == "boolean"]
    sql = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS INTEGER) AS {c}' for c in flags)}) FROM ({corpus.oracle_sql()[name]})" if flags else corpus.oracle_sql()[name]
    ok, text = oracle.compare(df.withColumns({c: df[c].cast("int") for c in flags}), oracle.connect(FOLDER), sql)
    assert ok, text


def stages(spark, docs):
    """Rows after each stage."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = save(stage(spark, docs, FOLDER), f"test-{name}")
        out.append(docs)
    return out


def check_stages(before, after):
    language, exact, near, mixed, packed = [[tuple(r) for r in df.collect()] for df in after]
    assert all(df.columns == ["doc_id", "text", "lang", "source", "n_chars"] for df in after[:-1])
    assert {r[0] for r in language} == {r[0] for r in before if any(c.isalpha() for c in r[1] or "")}
    groups = defaultdict(list)
    for r in language:
        groups[lowered(r[1])].append(r[0])
    assert sorted(r[0] for r in exact) == sorted(max(ids) for ids in groups.values())
    assert sorted(r[0] for r in near) == sorted(brute_stays([(r[0], r[1]) for r in exact]))
    times = defaultdict(int)
    for r in mixed:
        times[r[0]] += 1
    words = {r[0]: len(r[1].encode().split()) for r in near}
    sizes = defaultdict(int)
    for r in near:
        sizes[r[3]] += words[r[0]]
    from test_packing import brute_targets, in_turn

    targets = brute_targets(sizes, in_turn(sizes))
    rows = [{"doc_id": r[0], "source": r[3], "size": words[r[0]], "times": times[r[0]], "taken": times[r[0]] * words[r[0]], "target": targets[r[3]], "source_size": sizes[r[3]]} for r in near]
    check_mix([(r[0], r[1], r[3]) for r in near], rows)
    assert {r[0] for r in mixed} <= {r[0] for r in near}
    check_packing([(r[0], r[1]) for r in mixed], after[-1].collect(), CAPACITIES)


def test_stages_call_the_operators_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "best_fit_packing"]


def test_pipeline_over_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    check_stages([tuple(r) for r in docs.collect()], stages(spark, docs))


def test_pipeline_with_every_case(spark):
    data = [
        (1, "alpha beta gamma delta", "en", "a", 1),
        (2, "ALPHA beta gamma delta", "en", "a", 1),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, "12 34", "en", "b", 5),
        (6, "der Hund und die Katze", "de", None, 5),
        (7, "der Hund und die Katze im Haus", None, "b", 5),
        (8, "word " * 50_000, "en", "b", 5),
    ]
    docs = spark.createDataFrame(data, COLUMNS)
    after = stages(spark, docs)
    check_stages(data, after)
    assert {r["lang"] for r in after[0].where("doc_id = 7").collect()} <= {"de", "en"}
    assert all(df.collect() == [] for df in stages(spark, docs.limit(0)))
    unlabelled = spark.createDataFrame([(1, "a b", None, "s", 3), (2, "9", None, "s", 1)], COLUMNS)
    assert [r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, unlabelled, FOLDER).collect()] == [1]


def test_the_text_decides_the_language(spark):
    """Documents with a label are classified as those without: a wrong label does not stay, that of a language not learned does."""
    data = [(i, f"the cat sat on the mat with number {i} and the dog", "en", "s", 1) for i in range(120)]
    data += [(1000 + i, f"der Hund und die Katze sind nicht {i} über dem Haus", "de", "s", 1) for i in range(120)]
    wrong = [(5000, "der Hund und die Katze sind über dem Haus", "en", "s", 1), (5001, "the dog and the cat sat on the mat", "de", "s", 1)]
    other = [(5002, "the dog and the cat", None, "s", 1), (5003, "12 34", "en", "s", 1), (5004, None, "en", "s", 1)]
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, spark.createDataFrame([*data, *wrong, *other], COLUMNS), FOLDER).collect()}
    assert got == {**{r[0]: r[2] for r in data}, 5000: "de", 5001: "en", 5002: "en"}


def test_every_label_is_learned_from(spark):
    """Labels of documents that op1 holds out are learned from in the pipeline, which measures nothing on them."""
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == corpus.HELD_OUT]
    data = [(i, f"the cat sat on the mat with number {i}", "en", "s", 1) for i in range(400) if i not in held]
    data += [(i, f"der Hund und die Katze {i} über dem Haus", "de", "s", 1) for i in held]
    data += [(5000, "die Katze über dem Haus", None, "s", 1)]
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, spark.createDataFrame(data, COLUMNS), FOLDER).collect()}
    assert got == {**{r[0]: r[2] for r in data}, 5000: "de"}


def test_run_is_the_registered_query(spark):
    a = corpus.queries()["pipeline"](spark, FOLDER)
    assert sorted(map(str, a.collect())) == sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect()))
