"""Phrase search against a plain search for every phrase at every place."""

import random

import pytest
from pyspark.sql import functions as F

from claimflow.operators.phrases import _by_words, automaton, find_phrases, phrase_counts

WORDS = ["a", "ab", "b", "knee", "injury", "gãy", "xương", "đau"]


def brute(rows, phrases, between=None):
    out = []
    for key, text in rows:
        low = (text or "").lower()
        for phrase in set(phrases) - {""}:
            for at in range(len(low)):
                end = at + len(phrase)
                if low.startswith(phrase, at) and (
                    between is None or ((at == 0 or low[at - 1] in between) and (end == len(low) or low[end] in between))
                ):
                    out.append((key, phrase, at))
    return sorted(out, key=str)


def some(rng, n):
    return [(k, rng.choice([" ", "", ", "]).join(rng.choices([*WORDS, "Knee", "A"], k=rng.randint(0, 12)))) for k in range(n)]


@pytest.mark.parametrize("between", [None, " ", " ,"])
def test_every_place_is_found(spark, between):
    rng = random.Random(3)
    rows = [*some(rng, 200), (None, "a b a"), (7, None), (8, "")]
    phrases = ["a", "ab", "a b", "a b a", "knee injury", "gãy xương", "b a", "xương, đau", "", "a"]
    df = spark.createDataFrame(rows, "id int, note string").repartition(5)
    found = find_phrases(df.withColumn("phrase", F.lit(1)), "note", phrases, ["id"], between)
    assert found.columns == ["id", "phrase", "position"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, phrases, between)


def test_thousands_of_phrases_in_one_pass(spark):
    rng = random.Random(4)
    phrases = [" ".join(rng.choices([f"w{k}" for k in range(300)], k=2)) for _ in range(20_000)]
    rows = [(k, " ".join(f"w{rng.randint(0, 320)}" for _ in range(60))) for k in range(50)]
    df = spark.createDataFrame(rows, "id int, note string")
    wanted = set(phrases)
    pairs = {}
    for key, text in rows:
        words = text.split(" ")
        for pair in map(" ".join, zip(words, words[1:], strict=False)):
            if pair in wanted:
                pairs.setdefault(pair, []).append(key)
    got = {r["phrase"]: (r["occurrences"], r["found_in"]) for r in phrase_counts(find_phrases(df, "note", phrases, ["id"], " "), "id").collect()}
    assert got == {p: (len(keys), len(set(keys))) for p, keys in pairs.items()} and len(got) > 300


def test_nothing_to_find(spark):
    df = spark.createDataFrame([(1, "text")], "id int, note string")
    assert find_phrases(df, "note", [], ["id"]).collect() == find_phrases(df.limit(0), "note", ["t"], ["id"]).collect() == []


def test_the_size_of_what_is_sent_is_checked():
    with pytest.raises(ValueError, match="more than 10 characters"):
        automaton(["123456", "78901"], most=10)


def test_words_are_searched_without_a_node_per_character(spark):
    rng = random.Random(5)
    rows = some(rng, 100)
    phrases = {" ".join(rng.choices(WORDS, k=rng.randint(1, 4))) for _ in range(400)} | {" a", "b ", "a  b", "  "}
    wanted, sizes, parted = _by_words(phrases, " ,")
    assert wanted == phrases and sizes == [1, 2, 3, 4] and parted.findall("a, b") == [",", " "]
    df = spark.createDataFrame([*rows, (101, " a  b "), (102, "  "), (103, ",a")], "id int, note string")
    for between in (" ", ", ", "", "]^-"):
        found = find_phrases(df, "note", phrases, ["id"], between)
        assert sorted(map(tuple, found.collect()), key=str) == brute(map(tuple, df.collect()), phrases, between)


def test_the_size_of_words_is_checked_as_well(spark):
    with pytest.raises(ValueError, match="more than 10 characters"):
        find_phrases(spark.createDataFrame([(1, "a")], "id int, note string"), "note", ["123456", "78901"], ["id"], " ", most=10)
