"""Helpers of the operators: table readers, a cache of the Python worker, and hashing of whole batches of text."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_BYTES = np.zeros(256, dtype=bool)  # bytes of a word: all but [\x20\x09-\x0D]
WORD_BYTES[:] = True
WORD_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_POWER = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only id and text, whatever other columns there are; null text counts as empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def unused(docs: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``docs`` does not have (Spark does not tell upper and lower case apart)."""
    taken, found = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def worker_cache(key: Any, make: Callable[[], Any]) -> Any:
    """A value kept for the life of the Python worker, which serves many tasks."""
    store = sys.modules.setdefault("_saltmarsh_worker", types.ModuleType("_saltmarsh_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512, text: str = "text", size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows and about ``size`` bytes of ``text``; one row is never cut."""
    for batch in batches:
        lengths = np.array(batch.column(text).cast(pa.large_string()).to_pandas().str.len().fillna(0), dtype=np.int64) \
            if batch.num_rows else np.zeros(0, np.int64)
        start = held = 0
        for i, n in enumerate(lengths.tolist()):
            if i > start and (i - start >= rows or held + n > size):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd constant and of its inverse, modulo 2**64."""

    def table(base: int, size: int) -> np.ndarray:
        out = np.empty(size, np.uint64)
        out[0], filled = 1, 1
        while filled < size:
            step = min(filled, size - filled)
            out[filled:filled + step] = out[:step] * np.uint64(pow(base, filled, 1 << 64))
            filled += step
        return out

    size = max(1 << 20, n + 1)
    known = worker_cache("powers", lambda: [np.zeros(0, np.uint64)] * 2)
    if len(known[0]) < size:
        known[0], known[1] = table(_POWER, size), table(pow(_POWER, -1, 1 << 64), size)
    return known[0], known[1]


def word_hashes(
    values: list[str | None], lower: bool | None
) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts joined, and the words ``[^\\x20\\x09-\\x0D]+`` in them: their number before each text, hashes, starts and ends.

    The 64-bit hash of a word is a polynomial in its bytes, read off running
    sums, so a batch takes a few array operations.  Two given words get the
    same value with a chance of about 2**-64.  ``lower`` maps A-Z to a-z first;
    None does so only where all characters are below U+0100.
    """
    raw = [(v or "").encode("utf-8", "replace") for v in values]
    joined = b"\n".join(raw) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    if lower or lower is None and data.max() < 0xC4:
        joined = joined.lower()  # of bytes: only A-Z
        data = np.frombuffer(joined, np.uint8)
    inside = WORD_BYTES[data]
    edges = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    power, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts])
    limits = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    before = np.concatenate([[0], np.searchsorted(starts, limits)])
    return joined, before, hashes, starts, ends


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Order-dependent hashes of all runs of ``size`` words; shorter input gives none."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i:i + n]
    return mixed(out)
