"""Packing of documents into training sequences: best-fit decreasing with a segment tree over remaining capacity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.common import texts
from saltmarsh.llm.encoding import crc, encoded
from saltmarsh.session import stored

CAPACITY = 2048
GROUP_PIECES = 100_000
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class OpenWindows:
    """Open windows by remaining capacity.

    Leaf ``r`` of a complete binary tree holds the windows with ``r`` free
    places; an inner node counts the windows below it, so the tightest window
    that still takes a piece is found on one path up and one down.
    """

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _step(self, free: int, by: int) -> None:
        node = self.leaves + free
        while node:
            self.count[node] += by
            node //= 2

    def add(self, window: int, free: int) -> None:
        if free:
            self.windows[free].append(window)
            self._step(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes and returns a window with the least free places that are enough, and their number."""
        node = self.leaves + need
        if not self.count[node]:
            while node > 1 and (node % 2 or not self.count[node + 1]):
                node //= 2
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        free = node - self.leaves
        self._step(free, -1)
        return self.windows[free].pop(), free


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; the pieces must come in decreasing length."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened, n = OpenWindows(capacity), 0
    for i, need in enumerate(lengths.tolist()):
        found = opened.take(need)
        if found is None:
            found, n = (n, capacity), n + 1
        window[i], offset[i] = found[0], capacity - found[1]
        opened.add(found[0], found[1] - need)
    return window, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    Pieces are dealt evenly, by their place in the written table, to groups of
    about ``group_pieces``; each group is packed by itself, so no task grows
    with the corpus and no id, however frequent, makes a group larger.  What a
    group leaves open at its end is small against its size.  In a group, ties
    go by all columns.  ``sequence_id`` is the group's number times 2**32 plus
    the sequence's number in it.  An empty table gives no rows.
    """
    pieces = stored(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    columns = pieces.columns

    def pack_group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", *columns], ascending=[False] + [True] * len(columns), kind="stable")
        window, offset = best_fit(frame["length"].to_numpy(), capacity)
        return frame.assign(sequence_id=(frame["group"].to_numpy() << 32) + window, offset=offset)[[*columns, "sequence_id", "offset"]]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.groupBy("group").applyInPandas(pack_group, f"{schema}, sequence_id long, offset long")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of full windows, then of the rest if there is one."""
    return [(i, min(capacity, n - i)) for i in range(0, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document's ids; overlong documents are cut into full windows and a rest.

    Null text counts as empty: one piece with the end id alone.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, ids in encoded(batches, tokenizer):
            rows = [(name, i, n, crc(found[i:i + n]), len(found)) for name, found in zip(names, ids) for i, n in cut(len(found), capacity)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in zip(*rows)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return texts(docs).mapInArrow(pieces, PIECE_SCHEMA)


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Every id of every document in exactly one piece, each piece in a sequence of at most ``capacity`` ids."""
    return pack(token_pieces(docs, tokenizer, capacity), capacity)
