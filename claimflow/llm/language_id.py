"""Language identification with string kernels.

Two texts are as alike as the n-grams (all lengths of a blended spectrum) that are present in both, whatever their
counts, over the roots of how many each has. A text is described by its kernel with some landmark texts (Nystrom),
and each language has a ridge regression of its own on that (one against the rest). A batch of texts is scored by
two matrix products: presence by landmarks, then kernels by weights.

N-grams are letters in lower case, every other run of characters as one blank, hashed to a fixed number of columns.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
ORDERS = (1, 2, 3)  # lengths of the n-grams
COLUMNS = 1 << 13
TRAIN_ROWS = 1600  # bound of the labelled sample, shared out evenly among the languages
LANDMARKS = 192
RIDGE = 1e-2
BATCH = 256  # texts scored together
CHUNK = 1 << 20  # characters whose n-grams are looked at together


@functools.cache
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def plain(text: str) -> np.ndarray:
    """Code points of the lower-case letters, every run of anything else as one blank; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return codes[:0]
    codes = np.where(letter, codes, 32).astype(np.uint32)
    blank = ~letter
    codes = codes[~(blank & np.concatenate(([False], blank[:-1])))]
    return np.concatenate(([32], codes, [32])).astype(np.uint32)


def presence(text: str, columns: int = COLUMNS, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """Which columns the n-grams of the whole text fall into."""
    out, codes = np.zeros(columns, bool), plain(text)
    shift = np.uint32(32 - (columns - 1).bit_length())
    for at in range(0, len(codes), CHUNK):
        part = codes[at : at + CHUNK + max(orders) - 1]
        for n in orders:
            if len(part) < n:
                continue
            mixed = np.full(len(part) - n + 1, 0x811C9DC5 + n, np.uint32)
            for k in range(n):
                mixed = (mixed ^ part[k : len(part) - n + 1 + k]) * np.uint32(0x9E3779B1)
                mixed ^= mixed >> np.uint32(15)
            out[(mixed * np.uint32(0x85EBCA6B)) >> shift] = True
    return out


def _rows(found: np.ndarray) -> np.ndarray:
    """Presence rows as floats of length one; a row without n-grams stays zero."""
    norm = np.sqrt(found.sum(axis=1, dtype=np.float32))
    return found.astype(np.float32) / np.maximum(norm, 1)[:, None]


@dataclass
class Model:
    """Languages, landmarks (columns by landmarks) and weights (landmarks by languages)."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def scores(self, found: np.ndarray) -> np.ndarray:
        return _rows(found) @ self.landmarks @ self.weights


def train(found: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression of every language against the rest on the Nystrom features of the landmarks.

    Landmarks are taken from the languages in turn, in the order of the rows.
    """
    languages = sorted(set(labels))
    x = _rows(found)
    at = {lang: [i for i, y in enumerate(labels) if y == lang] for lang in languages}
    turns = sorted((turn, lang, i) for lang in languages for turn, i in enumerate(at[lang]))
    marks = x[[i for _, _, i in turns[:landmarks]]]
    within, across = (marks @ marks.T).astype(np.float64), (x @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(within)
    held = values > 1e-6 * values.max()
    root = vectors[:, held] / np.sqrt(values[held])  # inverse square root of the kernel among the landmarks
    features = across @ root
    target = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # languages count alike, however many rows of each there are
    share = np.array([1.0 / len(at[y]) for y in labels])[:, None]
    gram = features.T @ (share * features) + ridge * np.eye(features.shape[1])
    weights = root @ np.linalg.solve(gram, features.T @ (share * target))
    return Model(languages, np.ascontiguousarray(marks.T), weights.astype(np.float32))


def _packed_presence(columns: int, orders: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(presence(x.as_py() or "", columns, orders)).tobytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], names=["draw", "lang", "bits"])

    return run


def fit(
    labelled: DataFrame,
    train_rows: int = TRAIN_ROWS,
    columns: int = COLUMNS,
    orders: tuple[int, ...] = ORDERS,
    landmarks: int = LANDMARKS,
    ridge: float = RIDGE,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Model | None:
    """Fit on a sample of `labelled` of at most `train_rows` rows; None if it has no labelled text with letters.

    Every language gives the rows with its lowest seeded draws, as many as its even share. The draws are cut by the
    languages' counts, so no language is sorted or gathered. The sample's presence bits (not its texts) go to the
    driver: train_rows * columns / 8 bytes.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return None
    quota = max(1, train_rows // len(counts))
    unit = F.pmod(F.xxhash64(F.lit(7), F.col(key), F.xxhash64(text)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    # a little more than the quota is drawn, and the lowest draws of that are used
    share = {k: min(1.0, (1.2 * quota + 20) / n) for k, n in counts.items()}
    table = F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, v)])
    drawn = rows.select(unit.alias("draw"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    drawn = drawn.where(F.col("draw") < F.try_element_at(table, F.col("lang")))
    sample = drawn.mapInArrow(_packed_presence(columns, orders), "draw double, lang string, bits binary").collect()
    used: dict[str, int] = {}
    found, labels = [], []
    for _, y, bits in sorted((r["draw"], r["lang"], bytes(r["bits"])) for r in sample):
        used[y] = used.get(y, 0) + 1
        if used[y] <= quota:
            found.append(np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)[:columns])
            labels.append(y)
    return train(np.stack(found), labels, landmarks, ridge) if found else None


def classifier(model: Model | None, columns: int = COLUMNS, orders: tuple[int, ...] = ORDERS, spark=None):
    """A column function text -> struct(lang_pred, score). Score: (value of the best language + 1) / 2, within 0 and 1."""
    shared = spark.sparkContext.broadcast(model)  # landmarks and weights: their size is set by parameters

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def classify(texts: pa.Array) -> pa.Array:
        model = shared.value
        names, scores = [], []
        for at in range(0, len(texts), BATCH):
            found = np.stack([presence(x.as_py() or "", columns, orders) for x in texts[at : at + BATCH]])
            known = found.any(axis=1)
            if model is None:
                names += [UNKNOWN] * len(found)
                scores += [0.0] * len(found)
                continue
            values = model.scores(found)
            best = values.argmax(axis=1)
            names += [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)]
            top = np.clip((values[np.arange(len(best)), best].astype(np.float64) + 1) / 2, 0, 1)
            scores += np.where(known, top, 0.0).tolist()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return classify


def identify(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, lang_pred, score; only the text decides.

    A text that is null or has no letters is `und` with score 0, as is every text where there is no model. Whole texts
    are read. Repeated rows stay rows of their own, a null doc_id is kept, an empty table gives no rows.
    """
    classify = classifier(model, spark=docs.sparkSession)
    return docs.select(F.col(doc_id).alias("doc_id"), classify(F.col(text)).alias("__guess")).select("doc_id", "__guess.*")
