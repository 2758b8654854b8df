"""Exact and near duplicates against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from claimflow.llm import exact_dedup, simhash
from claimflow.llm.components import connected_components

DOCS = "doc_id long, text string, keep_id string, fingerprint int, low int"  # clashing names must not matter
LONG = "Word " * 60_000
EDGE = [
    (1, "Alpha beta gamma", "x", 1, 1),
    (2, "ALPHA beta gamma", "x", 1, 1),
    (3, "alpha  beta gamma", "x", 1, 1),
    (4, "É là", None, None, None),
    (5, "é là", None, None, None),
    (6, None, None, None, None),
    (7, "", None, None, None),
    (8, " \t\n", None, None, None),
    (9, LONG, None, None, None),
    (10, LONG.lower(), None, None, None),
    (2, "ALPHA beta gamma", "x", 1, 1),
    (None, "alpha beta GAMMA", None, None, None),
    (None, "only here", None, None, None),
    (None, "only HERE", None, None, None),
]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_groups(spark):
    rows = exact_dedup.exact_groups(spark.createDataFrame(EDGE, DOCS)).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in EDGE:
        groups[hashlib.sha256(lowered(text).encode()).hexdigest()].append(doc_id)
    assert len(rows) == len(EDGE)
    for digest, ids in groups.items():
        mine = [r for r in rows if r["text_sha256"] == digest]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        assert sorted(map(str, (r["doc_id"] for r in mine))) == sorted(map(str, ids))
        assert {r["keep_id"] for r in mine} == {keep} and {r["group_size"] for r in mine} == {len(ids)}
        assert [r["doc_id"] for r in mine if r["kept"]] == [keep]


def test_exact_rows_that_stay(spark):
    docs = spark.createDataFrame(EDGE, DOCS)
    stay = exact_dedup.drop_copies(docs)
    assert stay.columns == docs.columns
    texts = [lowered(r["text"]) for r in stay.collect()]
    assert sorted(texts) == sorted({lowered(r[1]) for r in EDGE})


def test_exact_empty(spark):
    empty = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_groups(empty).collect() == []
    assert exact_dedup.drop_copies(empty).collect() == []


@pytest.mark.parametrize("bits", [1, 6, 20])
def test_quotient_filters_merge_without_loss(bits):
    rng = np.random.default_rng(bits)
    values = rng.integers(0, 2**64, 400, dtype=np.uint64)
    values = np.concatenate([values, values[:150], values[:20]])
    rng.shuffle(values)
    merged = defaultdict(lambda: ([], []))
    for part in np.array_split(values, 7):
        for block, rest, n in exact_dedup.filter_of(part, np.ones(len(part)), 64 - bits):
            assert (np.diff(rest.astype(object)) > 0).all()
            merged[block][0].append(rest)
            merged[block][1].append(n)
    counts = {}
    for block, (rests, ns) in merged.items():
        for _, rest, n in exact_dedup.filter_of(np.concatenate(rests), np.concatenate(ns), 64):
            counts |= {(block << (64 - bits)) | int(r): int(k) for r, k in zip(rest, n, strict=True)}
    expected = defaultdict(int)
    for v in values:
        expected[int(v)] += 1
    assert counts == dict(expected)


def brute_simhash(text, words=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints, budget=2):
    """prints: [(doc_id, fingerprint)]; the smallest known id reachable from each."""
    distinct = sorted({f for _, f in prints})
    label = {f: f for f in distinct}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= budget:
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    least = {}
    for doc, f in prints:
        r = find(f)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return {f: least.get(find(f)) for f in distinct}


def test_simhash_of_texts():
    rng = random.Random(3)
    vocabulary = [f"w{i}É" for i in range(40)]
    texts = [None, "", " \n", "one", "One TWO", "a b c d", "É\x0bx\x0cy\x1cz a", LONG]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(60)]
    for t in texts:
        assert simhash.simhash(t or "") == brute_simhash(t)


def near_rows():
    rng = random.Random(5)
    rows = []
    for k in range(120):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.choice([5, 40, 400]))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(words)
            copy[rng.randrange(len(copy))] = f"v{rng.randint(0, 5000)}"
            rows.append((len(rows), " ".join(copy)))
    return rows + [(900, None), (901, ""), (902, "one"), (903, "ONE"), (None, rows[0][1]), (None, "alone here now"), (3, rows[3][1])]


def test_near_groups(spark):
    rows = near_rows()
    got = simhash.near_groups(spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, root int, a string"))
    prints = [(d, brute_simhash(t)) for d, t in rows]
    component = brute_components(prints)
    want = sorted((str(d), f"{f:016x}", str(component[f])) for d, f in prints)
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got.collect()) == want


def brute_stays(rows):
    """rows: [(doc_id, text)] of distinct ids; those that stay: the smallest of each component."""
    prints = [(d, brute_simhash(t)) for d, t in rows]
    component = brute_components(prints)
    return {d for d, f in prints if component[f] == d}


def test_near_rows_that_stay(spark):
    rows = [r for r in dict(near_rows()).items() if r[0] is not None]
    docs = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], "doc_id long, text string, root int, first string, digest int")
    stay = simhash.drop_near_copies(docs)
    assert stay.columns == docs.columns
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(brute_stays(rows))


def test_near_rows_of_every_case(spark):
    rows = [
        (5, "alpha beta gamma delta epsilon zeta"),
        (5, "alpha beta gamma delta epsilon zeta"),
        (4, "ALPHA beta  gamma delta epsilon zeta"),
        (None, "alpha beta gamma delta epsilon zeta"),
        (None, "nothing like any of the others here"),
        (None, "nothing like any of the others here"),
        (7, None),
        (6, ""),
        (8, " \n"),
        (9, "Word and more of it " * 20_000),
        (9, "Word and more of it " * 20_000),
        (5, "one id may have a text that differs from its other"),
    ]
    docs = spark.createDataFrame([(*r, None, None) for r in rows], "doc_id long, text string, root string, digest int")
    got = [(r["doc_id"], len(r["text"] or "")) for r in simhash.drop_near_copies(docs).collect()]
    assert sorted(got, key=str) == sorted([(4, 36), (None, 35), (6, 0), (9, 400_000), (5, 50)], key=str)
    tied = docs.where("doc_id is null or doc_id = 9")
    assert sorted(r["text"][:3] for r in simhash.drop_near_copies(tied).collect()) == ["Wor", "alp", "not"]
    assert simhash.drop_near_copies(docs.limit(0)).collect() == []


def test_near_query_against_brute_force(spark):
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r["doc_id"], brute_simhash(r["text"])) for r in docs]
    component = brute_components(prints)
    got = entry.queries()["op2_simhash_near_dedup"](spark, folder).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == sorted(
        (d, f"{f:016x}", component[f]) for d, f in prints
    )


def test_near_groups_of_an_empty_table(spark):
    assert simhash.near_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("prefix", [1, 4])
def test_trie_walk_finds_every_pair(prefix):
    rng = np.random.default_rng(prefix)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    near = base[:30] ^ np.uint64(1) ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64))
    values = np.unique(np.concatenate([base, near, np.array([0, 2**64 - 1], np.uint64)]))
    trees = [values[values >> np.uint64(64 - prefix) == np.uint64(p)] for p in range(1 << prefix)]
    found = set()
    for p, a in enumerate(trees):
        for q in range(p, len(trees)):
            spent = (p ^ q).bit_count()
            if spent > 2 or not len(a) or not len(trees[q]):
                continue
            for i, j in simhash.walk_together(a, trees[q], prefix, spent, 2, p == q):
                pairs = list(zip(a[i].tolist(), trees[q][j].tolist(), strict=True))
                assert not found.intersection(pairs)
                found.update(pairs)
    want = {(int(a), int(b)) for k, a in enumerate(values) for b in values[k + 1 :] if int(a ^ b).bit_count() <= 2}
    assert {tuple(sorted(p)) for p in found} == want


def test_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(1)
    flips = rng.integers(0, 64, (3000, 2))
    centre = 0x0123456789ABCDEF
    values = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in flips} | {centre ^ 0xFFFF})
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    links = simhash.trie_links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), len(signed))
    assert links.count() < 4 * len(values)
    roots = connected_components(links).groupBy("root").count().collect()
    assert len(roots) == 1 and roots[0]["count"] == len(values) - 1


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7)]
    label = {x: x for pair in links for x in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: label[x] for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_hot_group_of_copies(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same Text")).otherwise(F.concat(F.lit("t "), "id")).alias("text"))
    row = exact_dedup.exact_groups(docs).where("group_size > 1").agg(F.count("*"), F.sum(F.col("kept").cast("int")), F.max("keep_id")).first()
    assert tuple(row) == (1000, 1, 2997)
