"""Words and shingles inside tasks: numpy over one document at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_LIMIT = 100_000          # entries of a task's word cache (memory only, results do not depend on it)
_P = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered for the most part of a task's words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < _LIMIT:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes.split() separates at x20 and x09-x0D, nothing else."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words`` of many texts in one array, and where those of each text begin, with the end of the last."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat, edges = found.flatten().cast(pa.binary()), found.offsets.to_numpy()
    some = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not some.all():                          # space at the ends of a text
        edges = np.append(0, np.cumsum(some))[edges]
        flat = flat.filter(some)
    return flat, edges


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k entries; with fewer, the whole sequence is one; none for none."""
    n = len(h)
    if not n:
        return h
    salt, k = (np.uint64(n), n) if n < k else (np.uint64(0), k)
    acc = h[: n - k + 1] + salt
    for j in range(1, k):
        acc = mix(acc) * _P + h[j: n - k + 1 + j]
    return mix(acc)


def give_back() -> None:
    """Freed memory goes back to the system; a worker serves task after task and would hold it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pieces(batches: Iterator[pd.DataFrame], rows: int = 500) -> Iterator[pd.DataFrame]:
    """The same rows in smaller frames, so what a task holds of its results at once stays small."""
    for batch in batches:
        for i in range(0, len(batch), rows):
            yield batch.iloc[i:i + rows]
        del batch
        give_back()


def map_pieces(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str,
               rows: int = 500) -> DataFrame:
    """``mapInPandas`` of frames of ``rows`` rows: a batch stays Arrow, and only so many of its texts are Python strings at a time."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                # ids with nulls stay whole numbers
                yield whole.slice(start, rows).to_pandas(integer_object_nulls=True)
            del whole
            give_back()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(frames(batches)):
            yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

    return df.mapInArrow(mapped, schema)
