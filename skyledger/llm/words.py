"""Words and their hashes in Arrow batches: small helpers for code that runs inside tasks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 3 << 20


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cuts a batch so that the texts of a part have about ``most`` bytes; a longer text is a part of its own.

    With each part come its texts as UTF-8 bytes, null as None; only one part's are held.
    """
    at = batch.schema.get_field_index(text)
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate([*sizes, most + 1]):
        if i > start and held + size > most:
            part = batch.slice(start, i - start)
            yield part, part.column(at).cast(pa.binary()).to_pylist()
            start, held = i, 0
        held += size


def over_slices(
    docs: DataFrame, work: Callable, schema: str | T.StructType, text: str = "text", most: int = SLICE_BYTES, **given,
) -> DataFrame:
    """``work(part, texts, **given)`` on every slice; it returns the columns of ``schema`` as a dict."""
    names = [field.split()[0] for field in schema.split(", ")] if isinstance(schema, str) else schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text, most):
                out = work(part, texts, **given)
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x) for x in (out[n] for n in names)], names=names
                )

    return docs.mapInArrow(run, schema)


def split_words(texts: list) -> tuple[list[list[bytes]], np.ndarray]:
    """Words of each text between ASCII white space, and where each text's words start in all of them."""
    lists = [x.split() if x else [] for x in texts]
    starts = np.zeros(len(lists) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    return lists, starts


def coded(lists: list[list[bytes]], total: int) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of all texts, and every word as its place among them."""
    place = defaultdict(count().__next__)
    codes = np.fromiter(map(place.__getitem__, chain.from_iterable(lists)), dtype=np.int64, count=total)
    return list(place), codes


def hashes(words: Iterable[bytes] | Iterable[str], n: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes; a text is hashed by its UTF-8 bytes."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words, repeat(seed)), dtype=np.uint64, count=n)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(values: np.ndarray, length: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each ``length`` values in a row; one per start, over the whole array."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    if length <= 8:
        h = np.zeros(n, dtype=np.uint64)
        for i in range(length):
            h = mixed(h * np.uint64(base) + values[i:n + i]) if i else values[:n] * np.uint64(base)
        return h
    # sums of value * base^place; dividing by base^start makes them independent of the place
    mod = 1 << 64
    up = np.full(len(values), base, dtype=np.uint64)
    up[0] = 1
    up = np.cumprod(up)
    down = np.full(n, pow(base, -1, mod), dtype=np.uint64)
    down[0] = 1
    down = np.cumprod(down)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(mixed(values) * up, out=sums[1:])
    return mixed((sums[length:] - sums[:n]) * down)


def owners(starts: np.ndarray) -> np.ndarray:
    """For each word the number of its text."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def fitting(starts: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` words from each word on lie in one text; one entry per window of the whole array."""
    total = int(starts[-1])
    if total < length:
        return np.zeros(0, dtype=bool)
    ends = np.repeat(starts[1:], np.diff(starts))
    return np.arange(total - length + 1) + length <= ends[: total - length + 1]


def sums_per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each text's words; 0 for texts without words."""
    total = np.concatenate([np.zeros(1, dtype=values.dtype), np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def id_or_lowest(doc_id: str = "doc_id"):
    """The id, or the lowest number for a null one, so that joins match it."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)))
