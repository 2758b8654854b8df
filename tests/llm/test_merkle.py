"""The manifest against a plain reading of its definition."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from claimflow.llm import merkle
from claimflow.llm.queries import MANIFEST_SQL

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree string, position int, digest int"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, arity):
    """All levels, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([h(*level[k : k + arity]) for k in range(0, len(level), arity)])
    return levels


def fold_up(levels, at, digest, arity):
    """(siblings, root) with the node `at` replaced by `digest`."""
    siblings = []
    for level in levels[:-1]:
        begin = at // arity * arity
        run = level[begin : begin + arity]
        siblings += run[: at - begin] + run[at - begin + 1 :]
        digest = h(*run[: at - begin], digest, *run[at - begin + 1 :])
        at //= arity
    return siblings, digest


def tampers(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None


def brute(rows, arity=2):
    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    whole = {}
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        whole[lang] = climb([leaf_of(r) for r in trees[lang]], arity)
    tops = climb([whole[lang][-1][0] for lang in langs], arity) if langs else None
    out = []
    for k, lang in enumerate(langs):
        for at, r in enumerate(trees[lang]):
            changed = (*r[:3], r[3] + 1, r[4]) if tampers(r) else r
            inner, sub = fold_up(whole[lang], at, leaf_of(changed), arity)
            outer, root = fold_up(tops, k, sub, arity)
            out.append((r[0], leaf_of(r), whole[lang][-1][0], tops[-1][0], h(*inner, *outer), root, root == tops[-1][0]))
    return out


def manifest(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "t", 2, 3) for r in rows], SCHEMA)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = merkle.manifest(docs, {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}, tampered, **options)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r) for r in found.collect()]


def some_rows(rng, n, langs):
    text = lambda: rng.choice([None, "", "x", "é\n", "word " * rng.randint(1, 50)])
    ids = rng.sample(range(10 * n), n)
    return [(i, rng.choice([None, "s", "sö"]), rng.choice(langs), rng.choice([None, 0, 7, 10**6]), text()) for i in ids]


@pytest.mark.parametrize("n, langs, arity, levels", [(400, ["en", "de", None], 2, 3), (97, ["a"], 2, 12), (300, ["b", "", "ü", None, "a"], 3, 2), (7, [None], 2, 1)])
def test_equals_the_definition(spark, n, langs, arity, levels):
    rows = some_rows(random.Random(n), n, langs)
    got = manifest(spark, rows, arity=arity, levels=levels)
    assert sorted(got) == sorted(brute(rows, arity))
    assert {d for d, *_, ok in got if not ok} == {r[0] for r in rows if tampers(r)} != set()


def test_one_tree_holds_nearly_all_rows(spark):
    rng = random.Random(3)
    rows = [(k, "s", "en", 5, str(rng.random())) for k in range(3000)] + [(3000, "s", "fr", 5, "x")]
    assert sorted(manifest(spark, rows, levels=4)) == sorted(brute(rows))


def test_every_case(spark):
    long = "long text " * 300_000
    rows = [
        (None, None, None, None, None),
        (None, "a", "en", 1, "no id"),
        (1, "a", "en", 1, "copy"),
        (1, "a", "en", 1, "copy"),
        (1, "a", "en", 1, "copy"),
        (1, "a", "en", 2, "same id, another text"),
        (2, "a", "en", None, long),
        (7, "", "", 2**63 - 1, ""),
        *[(k, "a", "fr", 3, "-") for k in range(8, 40)],
    ]
    assert sorted(map(str, manifest(spark, rows))) == sorted(map(str, brute(rows)))
    for n in (0, 1, 2):
        assert sorted(map(str, manifest(spark, rows[2 : 2 + n]))) == sorted(map(str, brute(rows[2 : 2 + n])))


def test_a_slot_resumes_its_parents_state():
    children = [h(str(k)).encode() for k in range(5)]
    digest, slots = merkle.parent(children)
    assert digest == hashlib.sha256(b"".join(children)).hexdigest().encode()
    for k, slot in enumerate(slots):
        assert slot.fold(children[k]) == digest
        changed = [*children[:k], b"0" * 64, *children[k + 1 :]]
        assert slot.fold(b"0" * 64) == hashlib.sha256(b"".join(changed)).hexdigest().encode() != digest
        (again,) = merkle.read_path(merkle.write_path([slot]))
        assert again.fold(children[k]) == digest


def test_nothing_to_change(spark):
    rows = some_rows(random.Random(5), 50, ["en", "de"])
    docs = spark.createDataFrame([(*r, 1, "t", 2, 3) for r in rows], SCHEMA)
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in merkle.manifest(docs).collect())


def test_sql_equals_the_definition():
    rows = some_rows(random.Random(11), 120, ["en", None, "de"])
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert sorted(con.execute(MANIFEST_SQL).fetchall()) == sorted(brute(rows))
