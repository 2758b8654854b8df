"""Mixing, packing and token output against brute force and exact round trips."""

import re
from collections import defaultdict

import numpy as np
import pytest

from claimflow.llm import mixing, packing, token_output

DOCS = "doc_id long, text string, source string, size int, draw int, weight string"  # clashing names must not matter


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def rows(n=240):
    out = []
    for i in range(n):
        size = (i * 37) % 90 + (900 if i % 41 == 0 else 0)
        source = None if i % 10 == 9 else ["hot", "hot", "hot", "b", "c", "É", "zz"][i % 7]
        out.append((i, " \t".join(f"w{i}" for _ in range(size)), source, 1, 1, "x"))
    out += [(500, None, "hot", 1, 1, "x"), (501, "", "blank", 1, 1, "x"), (502, "w " * 30_000, "b", 1, 1, "x")]
    return out + [(3, out[3][1], out[3][2], 1, 1, "x"), (None, "a b c", "b", 1, 1, "x")]


def brute_targets(sizes, weights, epochs=3, budget=None):
    """Share the budget by weight, clamp, and share the excess again, one round after the other."""
    budget = sum(sizes.values()) if budget is None else budget
    clamped = {s for s in sizes if weights[s] and not sizes[s]}
    while True:
        free = [s for s in sizes if s not in clamped and weights[s]]
        left = budget - sum(epochs * sizes[s] for s in clamped)
        total = sum(weights[s] for s in free)
        over = {s for s in free if weights[s] * left > epochs * sizes[s] * total}
        if not over:
            return {s: epochs * sizes[s] if s in clamped else weights[s] * left / total if s in free else 0.0 for s in sizes}
        clamped |= over


def in_turn(sources):
    order = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    return {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}


def check_mix(data, got, epochs=3, budget=None):
    sizes = defaultdict(int)
    for r in data:
        sizes[r[2]] += len(words_of(r[1]))
    want = brute_targets(sizes, in_turn(sizes), epochs, budget)
    taken, largest = defaultdict(int), defaultdict(int)
    assert len(got) == len(data)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["size"] * r["times"] <= epochs * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    return want


def test_mixing_with_every_case(spark):
    data = rows()
    docs = spark.createDataFrame(data, DOCS)
    got = mixing.repetitions(docs).collect()
    check_mix(data, got)
    assert sorted(map(str, mixing.repetitions(docs.repartition(5)).collect())) == sorted(map(str, got))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["times"] for r in got)
    assert mixing.repetitions(docs.limit(0)).collect() == [] and mixing.mix(docs.limit(0)).collect() == []


def test_mixing_clamps_and_reshares(spark):
    data = [(i, "w " * 10, s, 1, 1, "x") for i, s in enumerate(["a"] * 100 + ["b"] * 2 + ["c"] * 1 + ["d"] * 8)]
    got = mixing.repetitions(spark.createDataFrame(data, DOCS), budget=900).collect()
    want = check_mix(data, got, budget=900)
    assert want["b"] == 60 and want["c"] == 30 and want["a"] > 100


def test_mixing_all_sources_clamped(spark):
    data = [(1, "a b", "x", 1, 1, "x"), (2, "c", "y", 1, 1, "x")]
    got = mixing.repetitions(spark.createDataFrame(data, DOCS), budget=1000).collect()
    assert sorted((r["doc_id"], r["taken"], r["target"]) for r in got) == [(1, 6, 6.0), (2, 3, 3.0)]


def test_mixing_with_given_weights(spark):
    data = [(i, "w " * 10, "ab"[i % 2], 1, 1, "x") for i in range(200)]
    weights = spark.createDataFrame([("a", 3), ("b", 1)], "source string, weight long")
    got = mixing.repetitions(spark.createDataFrame(data, DOCS), weights).collect()
    taken = {s: sum(r["taken"] for r in got if r["source"] == s) for s in "ab"}
    assert taken == {"a": 1500, "b": 500}


@pytest.mark.parametrize("seed", range(4))
def test_a_long_text_at_the_cut(spark, seed):
    """3,000 texts of 20 words and one of 30,000: wherever that one is drawn, the short ones fill the target."""
    data = [(i, "w " * 20, "a", 1, 1, "x") for i in range(3000)] + [(3000, "w " * 30_000, "a", 1, 1, "x")]
    data += [(4000 + i, "w " * 60, "b", 1, 1, "x") for i in range(1000)]
    got = mixing.repetitions(spark.createDataFrame(data, DOCS), seed=seed).collect()
    want = check_mix(data, got)
    assert want == {"a": 50_000, "b": 100_000}
    for s, target in want.items():
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - target) <= 60


def test_mixing_of_halving_lengths(spark):
    """Every cut ends in a text that is too long for what is missing; repeats of one row are taken alike."""
    data = [(i, "w " * (1 << 15 - i % 16), "a", 1, 1, "x") for i in range(48)] + [(99, "w " * 700, "a", 1, 1, "x")] * 40
    data += [(200 + i, "w " * 100, "b", 1, 1, "x") for i in range(1000)]
    docs = spark.createDataFrame(data, DOCS)
    got = mixing.repetitions(docs).collect()
    want = check_mix(data, got)
    ordinary = sum(r["size"] for r in got if r["source"] == "a") / 88
    assert abs(sum(r["taken"] for r in got if r["source"] == "a") - want["a"]) <= ordinary
    assert len({r["times"] for r in got if r["doc_id"] == 99}) == 1
    assert mixing.mix(docs).count() == sum(r["times"] for r in got)


def test_mix_query(spark):
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
    source = {r[0]: r[2] for r in docs}
    got = [r.asDict() | {"source": source[r["doc_id"]]} for r in entry.queries()["op3_mix_sources"](spark, folder).collect()]
    want = check_mix(docs, got)
    taken = defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - t) <= 0.03 * t for s, t in want.items())


def test_best_fit_by_hand():
    # one sequence of 8 is the least cost for 7 + 1; what is left needs 4 only
    bins, capacity = packing.best_fit([7, 3, 1], (4, 8), cost=lambda c: c + 1.0)
    assert bins == [0, 1, 0] and capacity == [8, 4]
    # the least room that fits is used
    bins, capacity = packing.best_fit([6, 5, 3, 2], (8,))
    assert bins == [0, 1, 1, 0] and capacity == [8, 8]
    assert packing.best_fit([], (8,)) == ([], [])


def packing_cost(lengths, bins, capacity, cost):
    held = defaultdict(int)
    for n, b in zip(lengths, bins, strict=True):
        held[b] += n
    assert all(held[b] <= c for b, c in enumerate(capacity)) and sorted(held) == list(range(len(capacity)))
    return sum(map(cost, capacity))


def least_cost(lengths, capacities, cost):
    """Every way to share the pieces out."""

    def go(k, loads):
        if k == len(lengths):
            return sum(cost(min(c for c in capacities if c >= n)) for n in loads)
        best = go(k + 1, [*loads, lengths[k]])
        for i, n in enumerate(loads):
            if n + lengths[k] <= max(capacities):
                best = min(best, go(k + 1, [*loads[:i], n + lengths[k], *loads[i + 1 :]]))
        return best

    return go(0, [])


def longest_only(lengths, capacities):
    """Best fit into the longest sequence alone, each shrunk at the end."""
    loads = []
    for n in lengths:
        fits = [i for i, held in enumerate(loads) if held + n <= max(capacities)]
        if fits:
            loads[max(fits, key=lambda i: loads[i])] += n
        else:
            loads.append(n)
    return [min(c for c in capacities if c >= n) for n in loads]


def test_lengths_are_chosen_jointly():
    rng = np.random.default_rng(8)
    capacities, better, optimal, mixed = (4, 8, 16), 0, 0, 0
    cost = lambda c: c + 1.0
    for _ in range(300):
        lengths = sorted(rng.integers(1, 17, rng.integers(1, 8)).tolist(), reverse=True)
        bins, capacity = packing.best_fit(lengths, capacities, cost)
        total = packing_cost(lengths, bins, capacity, cost)
        least, plain = least_cost(lengths, capacities, cost), sum(map(cost, longest_only(lengths, capacities)))
        assert least <= total <= plain
        better += total < plain
        optimal += total == least
        mixed += len(set(capacity)) > 1
    assert better >= 10 and optimal >= 250 and mixed >= 50, (better, optimal, mixed)


@pytest.mark.parametrize("low, high", [(1, 8192), (1, 400), (3000, 6000), (900, 1100)])
def test_joint_choice_on_large_groups(low, high):
    lengths = sorted(np.random.default_rng(low).integers(low, high, 600).tolist(), reverse=True)
    bins, capacity = packing.best_fit(lengths)
    plain = sum(map(packing.sequence_cost, longest_only(lengths, packing.CAPACITIES)))
    assert packing_cost(lengths, bins, capacity, packing.sequence_cost) <= plain


def test_many_copies_of_one_row(spark):
    data = [(1, "a b c", "s", 1, 1, "x")] * 9000
    got = packing.pack_documents(spark.createDataFrame(data, DOCS).coalesce(1), (64, 128)).collect()
    assert sorted(r["copy"] for r in got) == list(range(9000))
    check_packing(data, got, (64, 128))


def check_packing(data, got, capacities):
    bins, docs = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r["doc_id"], r["size"], r["copy"]].append(r)
        if r["bin_id"] is not None:
            bins[r["bin_id"]].append(r)
    expected = defaultdict(int)
    for r in data:
        expected[r[0], len(words_of(r[1]))] += 1
    assert {k: len({c for d, s, c in docs if (d, s) == k}) for k in expected} == dict(expected)
    for (_, size, _), pieces in docs.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["piece"]):
            assert p["start"] == at and p["length"] <= max(capacities)
            at += p["length"]
        assert at == size and (size > 0 or pieces[0]["bin_id"] is None)
    for held in bins.values():
        at = 0
        for p in sorted(held, key=lambda p: p["bin_offset"]):
            assert p["bin_offset"] == at
            at += p["length"]
        assert {p["bin_used"] for p in held} == {at}
        assert {p["bin_capacity"] for p in held} == {min(c for c in capacities if c >= at)}
    used = sum(len(words_of(r[1])) for r in data)
    return used / max(1, sum(held[0]["bin_capacity"] for held in bins.values()))


def test_packing_with_every_case(spark):
    data = rows()
    docs = spark.createDataFrame(data, DOCS)
    got = packing.pack_documents(docs, (64, 128, 256), group_words=20_000).collect()
    assert check_packing(data, got, (64, 128, 256)) > 0.95
    again = packing.pack_documents(docs.repartition(7), (64, 128, 256), group_words=20_000).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert packing.pack_documents(docs.limit(0)).collect() == []
    blank = packing.pack_documents(docs.where("doc_id in (500, 501)")).collect()
    assert [(r["length"], r["bin_id"]) for r in blank] == [(0, None)] * 2


def test_pack_query(spark):
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op4_best_fit_packing"](spark, folder).collect()
    assert check_packing(docs, got, packing.CAPACITIES) > 0.97


def test_rooms_find_the_least_that_fits():
    rng = np.random.default_rng(4)
    rooms, held = token_output.Rooms(50), []
    for k in range(2000):
        if rng.random() < 0.5:
            room = int(rng.integers(1, 51))
            rooms.put(room, k)
            held.append(room)
        else:
            needed = int(rng.integers(1, 51))
            fits = [r for r in held if r >= needed]
            got = rooms.take(needed)
            assert (got[0] if got else None) == (min(fits) if fits else None)
            if fits:
                held.remove(min(fits))


def test_tokens_come_back(spark):
    data = [(1, "Hello world. " * 40), (2, None), (3, ""), (4, "É là <|endoftext|> 你好"), (4, "twice"), (4, "twice"), (None, "no id"), (5, "x y z " * 30_000)]
    docs = spark.createDataFrame([(*r, "n", 1) for r in data], "doc_id long, text string, input_ids string, pieces int")
    packed = token_output.pack_tokens(docs, sequence=32, buffer=5000)
    encode = token_output.tokenizer(token_output.VOCABULARY)
    lines = packed.collect()
    whole = [r for r in lines if r["sequence_id"] is not None]
    assert len({r["sequence_id"] for r in whole}) == len(whole)
    ids, positions = token_output.matrix(whole, 32)
    assert ids.shape == positions.shape == (len(whole), 32)
    pieces = []
    for line, at, r in zip(ids, positions, whole, strict=True):
        assert r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] <= 32
        assert (line[r["n_tokens"] :] == token_output.PAD).all()
        for k, (a, b) in enumerate(zip(r["cu_seqlens"], r["cu_seqlens"][1:], strict=False)):
            assert at[a:b].tolist() == list(range(b - a)) and r["position_resets"][k] == a
            pieces.append((r["doc_ids"][k], r["starts"][k], line[a:b].tolist()))
    got = defaultdict(list)
    for doc, start, part in pieces:
        got[doc].append((start, part))
    texts = defaultdict(list)
    for doc, text in data:
        if text:
            texts[doc].append(text)
    for doc, wanted in texts.items():
        if len(wanted) == 1:
            tokens = [t for _, part in sorted(got[doc]) for t in part]
            assert encode.decode(tokens) == wanted[0]
    assert sorted(encode.decode(p) for _, p in got[4]) == sorted(texts[4])
    assert sorted(d for r in lines if r["sequence_id"] is None for d in r["doc_ids"]) == [2, 3]
    assert token_output.pack_tokens(docs.limit(0)).collect() == []


def test_token_query(spark):
    import hashlib

    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.001"
    encode = token_output.tokenizer(token_output.VOCABULARY)
    want = []
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = encode.encode_ordinary(r["text"])
        for k, at in enumerate(range(0, len(ids), token_output.SEQUENCE)):
            part = np.array(ids[at : at + token_output.SEQUENCE], "<u2")
            want.append((r["doc_id"], k, at, len(part), hashlib.sha256(part.tobytes()).hexdigest()))
    got = entry.queries()["op5_token_output"](spark, folder).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["n_tokens"], r["ids_sha256"]) for r in got) == sorted(want)
    held = defaultdict(int)
    for r in got:
        held[r["sequence_id"]] += r["n_tokens"]
    assert all(held[r["sequence_id"]] == r["sequence_tokens"] <= token_output.SEQUENCE for r in got)
    assert sum(held.values()) / len(held) / token_output.SEQUENCE > 0.9
