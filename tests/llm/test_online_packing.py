"""Online packing: the choice against the sum of squares itself, round trips through the tokenizer, no padding."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimflow.llm import online_packing as op

SCHEMA = "doc_id long, text string, ids int, pieces string, offset int"


def sum_of_squares(fills, size):
    return sum(n * n for fill, n in Counter(fills).items() if 0 < fill < size)


@pytest.mark.parametrize("seed, size", [(1, 16), (2, 64), (3, 10), (4, 1024)])
def test_every_choice_is_the_least(seed, size):
    """Each document is put where the sum of squares over all open windows is least, the fullest level of equals."""
    rng, levels = random.Random(seed), op.Levels(size)
    for k in range(400):
        n = rng.choice([1, size, rng.randint(1, size), rng.randint(1, max(1, size // 3))])
        fills = [w.fill for level in levels.held for w in level]
        options = [(sum_of_squares([*fills, n], size), 0, 0)]
        for fill in set(fills):
            if fill + n <= size:
                others = list(fills)
                others.remove(fill)
                options.append((sum_of_squares([*others, fill + n], size), -fill, fill))
        best = min(options)[2]
        assert levels.choose(n) == best
        full = levels.place(op.Piece(k, 0, np.zeros(n, "<u4"), n))
        assert (full is not None) == (best + n == size)
        assert levels.count.tolist() == [len(held) for held in levels.held]
        assert levels.open == sum(map(len, levels.held))


ODD = " \n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u2003\u2028\u3000\u200b" + "aAéß1٣漢!'<|🙂\u0301\u0120"


@pytest.mark.parametrize("vocabulary", [op.VOCABULARY, "word_bpe_49k.json"])
def test_remembered_ids_are_the_tokenizers(vocabulary):
    rng, encoder = random.Random(6), op.Encoder(vocabulary)
    model = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    texts = ["", " ", "\n", "a<|endoftext|>b <|endoftext|> c", "we'll we'd", "x" * 300 + " " + "y " * 90]
    texts += ["".join(rng.choices(ODD, k=rng.randint(1, 40))) for _ in range(3000)]
    texts += [" ".join(rng.choices(["one", "Zwei", "trés", "4,5", "it's", "\u3000x", "y\x1c"], k=30)) for _ in range(300)]
    for at in range(0, len(texts), 50):
        for text, ids in zip(texts[at : at + 50], encoder.encode(texts[at : at + 50]), strict=True):
            assert ids.tolist() == model.encode(text, add_special_tokens=False).ids


def test_usual_texts_are_cut_without_a_pattern(monkeypatch):
    """Texts without runs of white space are cut at spaces and ends of lines; the pattern is for the others."""
    encoder = op.Encoder(op.VOCABULARY)
    texts = ["one two\nthree four\n\nfive six\n", " one", "one ", "two\tone  two x", "\none two", "x" * 70 + " " + "y" * 70 + "\n" + "z" * 70, ""]
    monkeypatch.setattr(op, "PART", None)
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == encoder.model.encode(text, add_special_tokens=False).ids
    monkeypatch.undo()
    others = ["one  ", "one \n two", "  two", "one   two", "one\n\n two \n ", " \n", "one \ntwo", "   ", "\n one\n  two", "one\r\n\ttwo\n\n\nx"]
    for text, ids in zip(others, encoder.encode(others), strict=True):
        assert ids.tolist() == encoder.model.encode(text, add_special_tokens=False).ids


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(op, "MEMO", 20)
    encoder, rng = op.Encoder(op.VOCABULARY), random.Random(5)
    for _ in range(50):
        texts = [" ".join(f"w{rng.randint(0, 60)}" for _ in range(8)) for _ in range(3)]
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == encoder.model.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) <= 20 + 24


def check(rows, sequences, size=op.WINDOW, vocabulary=op.VOCABULARY, end=op.END):
    """rows: (doc_id, text). Every id lies in one piece, sequences are gapless and need no padding."""
    model = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    want = Counter((d, tuple([*model.encode(t or "", add_special_tokens=False).ids, end])) for d, t in rows)
    pieces = defaultdict(list)
    for r in sequences:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["n_tokens"] and 1 <= len(ids) <= size and r["n_padding"] == 0
        assert len(ids) == size or len(ids).bit_count() == 1
        at = 0
        for p in r["pieces"]:
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
            pieces[p["doc_id"], p["doc_tokens"]].append((p["start"], tuple(ids[p["offset"] : at].tolist())))
        assert at == len(ids)
    assert len({r["sequence_id"] for r in sequences}) == len(sequences)
    got = Counter()
    for (doc, total), parts in pieces.items():
        copies, rest = 0, sorted(parts)
        while rest:  # documents repeated under one id come apart by the place of their pieces
            ids, begin = (), 0
            while begin < total:
                match = next(p for p in rest if p[0] == begin and any(w[: begin + len(p[1])] == ids + p[1] for d, w in want if d == doc))
                rest.remove(match)
                ids, begin = ids + match[1], begin + len(match[1])
            got[doc, ids] += 1
            copies += 1
    assert got == want


def test_round_trip(spark):
    rng = random.Random(7)
    rows = [(k, " ".join(rng.choices(["alpha", "Beta", "naïve", "x1", "\n", "ß"], k=rng.choice([3, 40, 300, 1500])))) for k in range(300)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(4)
    sequences = op.pack_online(docs).collect()
    check(rows, sequences)
    tokens = sum(r["n_tokens"] for r in sequences)
    assert len(sequences) <= tokens / op.WINDOW + 4 * 11  # a task leaves no more than the bits of one window


@pytest.mark.parametrize("most_open", [0, 1, 5])
def test_few_open_windows(spark, most_open):
    rng = random.Random(8)
    rows = [(k, "word " * rng.randint(0, 60)) for k in range(200)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).coalesce(1)
    check(rows, op.pack_online(docs, size=32, most_open=most_open).collect(), size=32)


def test_every_case(spark):
    rows = [
        (1, None),
        (2, ""),
        (None, "no id"),
        (3, "copy of it"),
        (3, "copy of it"),
        (3, "same id, another and longer text"),
        (4, "very long " * 60_000),
        (5, "x" * 200_000),
        (6, " \n\t "),
    ]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    sequences = op.pack_online(docs)
    check(rows, sequences.collect())
    assert op.pieces(op.pack_online(docs.limit(0))).collect() == []


def test_pieces_carry_checksums(spark):
    rng = random.Random(9)
    rows = [(k, "some words of it " * rng.randint(0, 700)) for k in range(40)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    found = op.pieces(op.pack_online(docs))
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    model, texts, seen = Tokenizer.from_file(public_tokenizers.path(op.VOCABULARY)), dict(rows), defaultdict(int)
    for r in found.collect():
        ids = np.array([*model.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0], "<u4")
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        seen[r["doc_id"]] += r["length"]
    assert seen == {d: len(model.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows}


def test_fewer_windows_than_documents_in_turn():
    """On sizes of up to three eighths of a window few windows are open before any is cut."""
    rng, levels, full = random.Random(10), op.Levels(128), 0
    total = 0
    for k in range(5000):
        n = rng.randint(1, 48)
        total += n
        full += levels.place(op.Piece(k, 0, np.zeros(n, "<u4"), n)) is not None
    assert full + levels.open <= 1.02 * total / 128 + 10
