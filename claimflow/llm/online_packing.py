"""Sum-of-squares online packing of token ids into windows.

Documents are placed as they come. A level array counts the partially filled windows by their fill; a document goes to
the level, or into a new window, that leaves the least sum of squared counts, which keeps fills spread and few
windows open. What a full window would leave of a longer document fills windows of its own. When a task ends, the
emptiest open windows are cut up to fill the fullest, and the one left over is cut into powers of two, which need
no padding. A task packs its own rows, so no token is shuffled.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
VOCABULARY = "byte_bpe_50k.json"
END = 0  # the id that ends a document
OPEN = 8192  # open windows that a task holds before it closes all but one of them
BYTES = 1 << 20  # of text that is tokenised at once
MEMO = 1 << 20  # pieces of text whose ids a task remembers
JOINED = 512  # of them that are tokenised as one text
LONGEST = 64  # characters of such a piece
# From a white space that follows something else up to the next such place
PART = re.compile(r"\s*\S+(?:[^\S \n\t\r]\s*\S*)*|\s+")
PLAIN = re.compile(r" \S+")
LINE = re.compile(r"\n(?<=\S\n)")  # the end of a line, where a text is cut as well
# A space between white space, or white space and the end, where no text may be cut, or one before the end of a line
UNCUT = re.compile(r" (?:(?!\S)(?<=\s )|(?=\n))")
WRITTEN = 256  # sequences handed on at once
PIECE = "struct<doc_id:long,start:long,length:long,doc_tokens:long,offset:long>"
SEQUENCES = f"sequence_id long, n_tokens int, n_padding int, ids binary, pieces array<{PIECE}>"


def written(word: str) -> str:
    """A word of a text cut at spaces and ends of lines, with what it was cut at."""
    return word if word[:1] == "\n" else f" {word}"


class Encoder:
    """Ids of texts by a tokenizer, given by the path of its file or by its name among the public ones.

    Where the tokenizer splits texts at white space by the byte-level rule, a piece of text from one white space to the
    next always has the same ids. Then the ids of short pieces are remembered, and only new ones are tokenised. Texts are cut at
    spaces and ends of lines, those with longer runs of white space by a pattern.
    """

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task a core
        from tokenizers import Tokenizer

        if not os.path.isabs(vocabulary):
            import public_tokenizers

            vocabulary = public_tokenizers.path(vocabulary)
        self.model = Tokenizer.from_file(str(vocabulary))
        setup = json.loads(self.model.to_str())
        split = setup.get("pre_tokenizer") or {}
        own_space = any(t["lstrip"] or t["rstrip"] for t in setup["added_tokens"])
        self.local = (
            split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
            and setup["normalizer"] is None and not own_space
        )
        self.known: dict[str, bytes] = {}  # of words, each with the space or the end of line before it
        self.others: dict[str, bytes] = {}  # of other parts, as the first word of a text
        self.spaced = np.zeros(self.model.get_vocab_size(), bool)  # ids of tokens that begin with a space
        self.spaced[[i for token, i in self.model.get_vocab().items() if token[0] == "\u0120"]] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, words: set[str], parts: set[str]) -> dict[str, bytes]:
        """Ids of words and other parts of text: remembered, but for those of long ones, which are given back."""
        if len(self.known) + len(self.others) + len(words) + len(parts) > MEMO:
            self.known.clear()
            self.others.clear()
        plain, long = [], {}
        for word in words.difference(self.known):
            part = written(word)
            if len(part) > LONGEST:
                long[part] = self._ids(part).tobytes()
            elif PLAIN.fullmatch(part):
                plain.append(word)
            else:
                self.known[word] = self._ids(part).tobytes()
        for part in parts.difference(self.others):
            (self.others if len(part) <= LONGEST else long)[part] = self._ids(part).tobytes()
        if plain:  # one after the other they are a text, and each begins where a token begins with a space
            texts = [" " + " ".join(plain[k : k + JOINED]) for k in range(0, len(plain), JOINED)]
            ids = np.concatenate([np.array(x.ids, "<u4") for x in self.model.encode_batch_fast(texts, add_special_tokens=False)])
            begins = (4 * np.flatnonzero(self.spaced[ids])).tolist()
            data = ids.tobytes()
            self.known.update(zip(plain, map(data.__getitem__, map(slice, begins, [*begins[1:], len(data)])), strict=True))
        return long

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if not self.local:
            yield from map(self._ids, texts)
            return
        cuts, new, parts = [], set(), set()
        for text in texts:
            if UNCUT.search(text):
                pieces, words = PART.findall(text), []
            else:
                first, *words = LINE.sub(" \n", text).split(" ")
                pieces = [first]
            ids = list(map(self.known.get, words))
            if not all(ids):
                new.update(compress(words, map(not_, ids)))
            new.update(p[1:] for p in pieces if PLAIN.fullmatch(p))
            parts.update(p for p in pieces if not PLAIN.fullmatch(p))
            cuts.append((pieces, words, ids))
        long = self._learn(new, parts)
        for pieces, words, ids in cuts:
            begin = [self.known.get(p[1:]) or long[p] if PLAIN.fullmatch(p) else self.others.get(p) or long.get(p, b"") for p in pieces]
            if not all(ids):
                ids = [known or self.known.get(w) or long[written(w)] for w, known in zip(words, ids, strict=True)]
            yield np.frombuffer(b"".join([*begin, *ids]), "<u4")


@functools.cache
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:n], self.doc_tokens),
            Piece(self.doc_id, self.start + n, self.ids[n:], self.doc_tokens),
        )


@dataclass
class Window:
    pieces: list[Piece] = field(default_factory=list)
    fill: int = 0

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece.ids)

    def take(self) -> Piece:
        piece = self.pieces.pop()
        self.fill -= len(piece.ids)
        return piece


class Levels:
    """Open windows by their fill. `count` is the level array: how many windows are filled to each level."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.held: list[deque[Window]] = [deque() for _ in range(size + 1)]
        self.open = 0

    def choose(self, n: int) -> int:
        """The level to put `n` tokens on, 0 being a new window: the least sum of squared counts, the fullest of equals."""
        top = self.size - n
        if not top:
            return 0
        at, to = self.count[1 : top + 1], self.count[n + 1 :]
        change = 2 * (to - at) + 2  # one window less on a level, one more on another
        change[-1] -= 1  # a full window is on none
        change[at == 0] = np.iinfo(np.int64).max
        best = top - 1 - int(np.argmin(change[::-1]))
        return best + 1 if change[best] <= 2 * self.count[n] + 1 else 0

    def place(self, piece: Piece) -> Window | None:
        """Put a piece; gives back its window if that is now full."""
        level = self.choose(len(piece.ids))
        if level:
            window = self.held[level].popleft()
            self.count[level] -= 1
            self.open -= 1
        else:
            window = Window()
        window.put(piece)
        if window.fill == self.size:
            return window
        self.held[window.fill].append(window)
        self.count[window.fill] += 1
        self.open += 1
        return None

    def close(self) -> Iterator[Window]:
        """All open windows as full ones, and at last one that may not be: the emptiest are cut up to fill the fullest."""
        left = deque(w for level in reversed(self.held) for w in level)
        self.__init__(self.size)
        while left:
            window = left.popleft()
            while left and window.fill < self.size:
                piece = left[-1].take()
                room = self.size - window.fill
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    left[-1].put(rest)
                elif not left[-1].fill:
                    left.pop()
                window.put(piece)
            yield window


def powers_of_two(window: Window) -> Iterator[Window]:
    """The window cut into ones whose fills are the powers of two that its own is the sum of."""
    pieces = deque(window.pieces)
    for bit in reversed(range(window.fill.bit_length())):
        if window.fill >> bit & 1:
            part = Window()
            while part.fill < 1 << bit:
                piece, room = pieces.popleft(), (1 << bit) - part.fill
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    pieces.appendleft(rest)
                part.put(piece)
            yield part


def pack_pieces(pieces: Iterable[Piece], size: int, most_open: int) -> Iterator[Window]:
    """Windows of documents that come one by one, each whole."""
    levels = Levels(size)
    for piece in pieces:
        while len(piece.ids) > size:
            whole, piece = piece.cut(size)
            yield Window([whole], size)
        if (window := levels.place(piece)) is not None:
            yield window
        if levels.open > most_open:
            for window in levels.close():
                if window.fill == size:
                    yield window
                else:
                    levels.held[window.fill].append(window)
                    levels.count[window.fill] += 1
                    levels.open += 1
    for window in levels.close():
        if window.fill == size:
            yield window
        else:
            yield from powers_of_two(window)


def _tokenised(batches: Iterator[pa.RecordBatch], vocabulary: str, end: int, most: int) -> Iterator[Piece]:
    encode, last = encoder(vocabulary).encode, np.array([end], "<u4")

    def encoded(ids: list, texts: list[str]) -> Iterator[Piece]:
        for doc_id, found in zip(ids, encode(texts), strict=True):
            yield Piece(doc_id, 0, np.concatenate([found, last]), len(found) + 1)

    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            ids.append(doc_id.as_py())
            texts.append(text.as_py() or "")
            held += len(texts[-1]) + 64
            if held >= most:
                yield from encoded(ids, texts)
                ids, texts, held = [], [], 0
    if ids:
        yield from encoded(ids, texts)


def _padding(fill: int, size: int) -> int:
    return 0 if fill & (fill - 1) == 0 else size - fill


def _pack(vocabulary: str, size: int, end: int, most_open: int):
    kinds = [("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("n_padding", pa.int32()), ("ids", pa.binary())]
    piece = pa.struct([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "offset")])
    schema = pa.schema([*kinds, ("pieces", pa.list_(piece))])

    def row(sequence_id: int, window: Window) -> dict:
        offsets = np.cumsum([0, *(len(p.ids) for p in window.pieces)]).tolist()
        spans = [
            {"doc_id": p.doc_id, "start": p.start, "length": len(p.ids), "doc_tokens": p.doc_tokens, "offset": at}
            for p, at in zip(window.pieces, offsets, strict=False)
        ]
        ids = np.concatenate([p.ids for p in window.pieces]).tobytes()
        return {"sequence_id": sequence_id, "n_tokens": window.fill, "n_padding": _padding(window.fill, size), "ids": ids, "pieces": spans}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence_id, rows = TaskContext.get().partitionId() << 33, []
        for window in pack_pieces(_tokenised(batches, vocabulary, end, BYTES), size, most_open):
            rows.append(row(sequence_id, window))
            sequence_id += 1
            if len(rows) == WRITTEN:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return pack


def pack_online(
    docs: DataFrame,
    size: int = WINDOW,
    vocabulary: str = VOCABULARY,
    end: int = END,
    most_open: int = OPEN,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Sequences of at most `size` ids: sequence_id, n_tokens, n_padding, ids (4 little-endian bytes each), pieces.

    A document is its ids and then `end`. pieces lists doc_id, start (ids of the document before the piece), length,
    doc_tokens and offset, gapless from 0. Every id lies in one piece. n_padding is what fills the sequence up to `size`;
    a sequence of a power of two needs none. sequence_id names the task and the sequence in it.

    Null texts count as empty: they are the id `end` alone. A null doc_id is kept; repeated rows are packed each
    by itself; special tokens in a text are read as the tokenizer reads them. An empty table gives no rows. Other columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_pack(vocabulary, size, end, most_open), SEQUENCES)


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    each = sequences.select("sequence_id", "ids", F.explode("pieces").alias("piece")).select("sequence_id", "ids", "piece.*")
    ids = F.expr("substring(ids, cast(offset * 4 + 1 as int), cast(length * 4 as int))")
    return each.select("doc_id", "start", "length", F.crc32(ids).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
