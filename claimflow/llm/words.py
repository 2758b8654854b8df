"""Words are runs of bytes other than space and \\x09-\\x0D; counted on whole Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

GAP = np.zeros(256, bool)
GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All text bytes of a column and the row offsets into them; null as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def count_words(texts: pa.Array) -> pa.Array:
    if not len(texts):
        return pa.array([], pa.int64())
    data, offsets = bytes_of(texts)
    word = ~GAP[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # a row's first byte begins a word whatever the row before ends with
    begins = word & (first[:-1] | ~np.concatenate(([False], word[:-1])))
    return pa.array(np.diff(np.searchsorted(np.flatnonzero(begins), offsets)), pa.int64())


word_count = F.arrow_udf(count_words, T.LongType())
