"""Search for very many phrases at once: one lookup that is built once and sent to the tasks, one pass over a text."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_CHARACTERS = 20_000_000  # of all phrases together: what the lookup that is sent to the tasks may hold
MOST_PLACES = 50_000  # of a batch of results: places leave a task while its texts are searched


def _different(phrases: Iterable[str], most: int) -> Iterator[str]:
    """The phrases, each once. More than `most` characters are refused: split the phrases then."""
    seen, characters = set(), 0
    for phrase in phrases:
        if not phrase or phrase in seen:
            continue
        characters += len(phrase)
        if characters > most:
            raise ValueError(f"the phrases hold more than {most} characters")
        seen.add(phrase)
        yield phrase


def automaton(phrases: Iterable[str], most: int = MOST_CHARACTERS) -> ahocorasick.Automaton:
    """The automaton over the different phrases. More than `most` characters are refused: split the phrases then."""
    found = ahocorasick.Automaton()
    for phrase in _different(phrases, most):
        found.add_word(phrase, phrase)
    if len(found):
        found.make_automaton()
    return found


def _by_words(phrases: Iterable[str], between: str, most: int = MOST_CHARACTERS) -> tuple[frozenset[str], list[int], re.Pattern | None]:
    """The phrases as a set, the numbers of words they have, and what parts words.

    An occurrence runs from the start of a word to the end of a word, over as many words as the phrase has. So a set
    serves in a small part of the memory of the automaton, which has a node for every character.
    """
    parted = re.compile(f"[{re.escape(between)}]") if between else None
    wanted = frozenset(_different(phrases, most))
    return wanted, sorted({1 + (len(parted.findall(p)) if parted else 0) for p in wanted}), parted


def find_phrases(
    df: DataFrame, text: str, phrases: Iterable[str], keep: Sequence[str], between: str | None = None, most: int = MOST_CHARACTERS
) -> DataFrame:
    """Every place where one of the phrases occurs in a text: the kept columns, phrase and position (from 0).

    Texts are lower-cased first and positions are characters of the lower-cased text; phrases are taken as they are. Phrases
    may overlap and lie inside each other. With `between`, an occurrence counts only if it begins at the start of
    the text or after one of these characters, and ends at its end or before one of them. NULL texts have no rows, and
    neither has anything where there are no phrases.
    """
    spark = df.sparkSession
    searched = automaton(phrases, most) if between is None else _by_words(phrases, between, most)
    kept = df.select(*keep, F.lower(F.col(text)).alias("__text"))
    schema = T.StructType(
        [*[kept.schema[c] for c in keep], T.StructField("phrase", T.StringType()), T.StructField("position", T.IntegerType())]
    )
    if not len(searched if between is None else searched[0]):
        return spark.createDataFrame([], schema)
    sent = spark.sparkContext.broadcast(pickle.dumps(searched))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # nested, as the package may be missing on the executors
        found = pickle.loads(sent.value)

        def by_automaton(text: str) -> Iterator[tuple[str, int]]:
            for last, phrase in found.iter(text):
                yield phrase, last + 1 - len(phrase)

        def by_words(text: str) -> Iterator[tuple[str, int]]:
            wanted, sizes, parted = found
            stops = [m.start() for m in parted.finditer(text)] if parted else []
            firsts, lasts = [0, *[k + 1 for k in stops]], [*stops, len(text)]
            for size in sizes:
                for first, last in zip(firsts, lasts[size - 1 :], strict=False):
                    phrase = text[first:last]
                    if phrase in wanted:
                        yield phrase, first

        def rows_of(batch: pa.RecordBatch, rows: list[int], names: list[str], places: list[int]) -> pa.RecordBatch:
            taken = batch.select(batch.schema.names[:-1]).take(pa.array(rows, pa.int64()))
            arrays = [*taken.columns, pa.array(names, pa.string()), pa.array(places, pa.int32())]
            return pa.RecordBatch.from_arrays(arrays, names=[*taken.schema.names, "phrase", "position"])

        places_of = by_automaton if between is None else by_words
        for batch in batches:
            rows, names, places = [], [], []
            for row, whole in enumerate(batch.column(batch.num_columns - 1)):
                for phrase, first in places_of(whole.as_py() or ""):
                    rows.append(row)
                    names.append(phrase)
                    places.append(first)
                if len(rows) >= MOST_PLACES:
                    yield rows_of(batch, rows, names, places)
                    rows, names, places = [], [], []
            yield rows_of(batch, rows, names, places)

    return kept.mapInArrow(search, schema)


def phrase_counts(found: DataFrame, key: str) -> DataFrame:
    """Per phrase: its occurrences and the different keys it occurs in."""
    per_key = found.groupBy("phrase", key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("phrase").agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("found_in"))
