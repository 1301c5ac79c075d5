"""Token ids in directly addressable codes: any token can be read without decoding the tokens before it.

File format
-----------
A corpus is a Parquet table of segments.  Each row is one segment: ``shard``
(number of the range partition that wrote it), ``shard_start`` (ids of the
shard before the segment), ``n_ids``, ``doc_ids`` and ``doc_sizes`` (its whole
documents in order, with their number of ids), and ``codes``, the bytes

    "DAC1", number of levels (1 byte), then for each level
    number of chunks (8 bytes), number of directory entries (8 bytes),
    directory (8-byte running number of ones before each block of 512 bits),
    continuation bitmap (bit i at bit i % 8 of byte i // 8), chunks (1 byte each).

All numbers are little-endian.  Level 0 has the lowest 8 bits of every id.  A
set continuation bit says that the next 8 bits are on the next level, at the
position given by the number of set bits before it: directory entry plus a
count within one block.  So one id takes at most four such steps, wherever it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saltmarsh.llm.common import texts
from saltmarsh.llm.encoding import crc, encoded
from saltmarsh.session import shared_folder

MAGIC = b"DAC1"
BLOCK = 512
SEGMENT_IDS = 1 << 18
SEGMENT_SCHEMA = (
    "shard int, shard_start long, n_ids long, doc_ids array<bigint>, doc_sizes array<bigint>, codes binary"
)
ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def pack(ids: np.ndarray) -> bytes:
    """The codes of a sequence of ids below 2**32."""
    out, rest, levels = [], np.asarray(ids, np.uint32), 0
    while levels == 0 or len(rest):
        more = rest > 255
        bitmap = np.packbits(more, bitorder="little")
        bitmap = np.pad(bitmap, (0, -len(bitmap) % (BLOCK // 8)))
        per_block = ONES[bitmap].reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint64)
        directory = np.concatenate([np.zeros(1, np.uint64), np.cumsum(per_block, dtype=np.uint64)])
        out += [np.array([len(rest), len(directory)], "<u8").tobytes(), directory.astype("<u8").tobytes(),
                bitmap.tobytes(), (rest & 255).astype(np.uint8).tobytes()]
        rest = rest[more] >> np.uint32(8)
        levels += 1
    return MAGIC + bytes([levels]) + b"".join(out)


class Codes:
    """Reads ids out of the codes of one segment."""

    def __init__(self, raw: bytes) -> None:
        if raw[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.levels, at = [], 5
        for _ in range(raw[4]):
            n, entries = np.frombuffer(raw, "<u8", 2, at).tolist()
            at += 16
            directory = np.frombuffer(raw, "<u8", entries, at)
            at += 8 * entries
            size = (entries - 1) * BLOCK // 8
            bitmap = np.frombuffer(raw, np.uint8, size, at)
            at += size
            self.levels.append((directory, bitmap, np.frombuffer(raw, np.uint8, n, at)))
            at += n

    def __len__(self) -> int:
        return len(self.levels[0][2])

    def _rank(self, level: int, i: int) -> int:
        """Set continuation bits before position ``i``."""
        directory, bitmap, _ = self.levels[level]
        block, byte = i // BLOCK, i // 8
        before = int(directory[block]) + int(ONES[bitmap[block * BLOCK // 8:byte]].sum())
        return before + (int(ONES[bitmap[byte] & ((1 << i % 8) - 1)]) if i % 8 else 0)

    def __getitem__(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        found, level = 0, 0
        while True:
            _, bitmap, chunks = self.levels[level]
            found |= int(chunks[i]) << 8 * level
            if not bitmap[i // 8] >> i % 8 & 1:
                return found
            i, level = self._rank(level, i), level + 1

    def read(self, start: int, size: int, level: int = 0) -> np.ndarray:
        """``size`` ids from ``start`` on; on each level only the chunks of these ids are touched."""
        _, bitmap, chunks = self.levels[level]
        found = chunks[start:start + size].astype(np.uint32)
        bits = np.unpackbits(bitmap[start // 8:(start + size + 7) // 8], bitorder="little")
        more = np.flatnonzero(bits[start % 8:start % 8 + size])
        if len(more):
            found[more] |= self.read(self._rank(level, start), len(more), level + 1) << np.uint32(8)
        return found


def _segments(path: str, segment_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        names, parts, held = [], [], 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "shard_start": pa.array([before], pa.int64()),
                "n_ids": pa.array([held], pa.int64()), "doc_ids": pa.array([names], pa.list_(pa.int64())),
                "doc_sizes": pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                "codes": pa.array([pack(np.concatenate(parts))], pa.binary()),
            })

        for docs, ids in encoded(batches, path):
            for name, found in zip(docs, ids):
                names.append(name)
                parts.append(found)
                held += len(found)
                if held >= segment_ids:
                    yield segment()
                    before += held
                    names, parts, held = [], [], 0
        if parts:
            yield segment()

    return write


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, partitions: int | None = None,
                 segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every whole text, append the end id, and write the segments in ascending ``doc_id`` order.

    Null text is an empty text, so only the end id; null ids come first.  Rows
    with the same id are ordered by a hash of the text, then by the text.  An
    empty table gives an empty corpus.  Columns other than ``doc_id`` and
    ``text`` are not read.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        texts(docs).withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(partitions, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(_segments(tokenizer, segment_ids), SEGMENT_SCHEMA).write.parquet(folder)


def open_tokens(spark, folder: str) -> DataFrame:
    """The segments of a corpus, with ``start``: ids of the whole corpus before the segment."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(folder)
    # One row per shard, so as many as the writing job had partitions: small enough for a window and a broadcast.
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    bases = shards.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("base"))
    return segments.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("shard_start"))


def read_tokens(spark, folder: str) -> DataFrame:
    """One row per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (4 bytes each)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                codes = Codes(row["codes"])
                sizes = np.array(row["doc_sizes"], np.int64)
                starts = np.cumsum(sizes) - sizes
                step = 1000
                for k in range(0, len(sizes), step):
                    spans = list(zip(starts[k:k + step].tolist(), sizes[k:k + step].tolist()))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(row["doc_ids"][k:k + step], pa.int64()),
                        "start": pa.array(row["start"] + starts[k:k + step], pa.int64()),
                        "n_tokens": pa.array(sizes[k:k + step], pa.int64()),
                        "ids": pa.array([codes.read(i, n).astype("<u4").tobytes() for i, n in spans], pa.binary()),
                    })

    opened = open_tokens(spark, folder).select("start", "doc_ids", "doc_sizes", "codes")
    return opened.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def tokens_at(spark, folder: str, positions: DataFrame) -> DataFrame:
    """``position`` and ``token`` for positions in the corpus; those outside give null.

    Positions meet their segment by the number of their block of ``SEGMENT_IDS``
    ids; only the chunks of the wanted ids are read out of the codes.
    """
    segments = open_tokens(spark, folder).withColumn("end", F.col("start") + F.col("n_ids"))
    blocks = F.sequence(F.floor(F.col("start") / SEGMENT_IDS), F.floor((F.col("end") - 1) / SEGMENT_IDS))
    segments = segments.select("start", "end", "codes", F.explode(blocks).alias("block"))
    wanted = positions.select("position").distinct().withColumn("block", F.floor(F.col("position") / SEGMENT_IDS))
    met = segments.join(wanted, "block").where("position >= start AND position < end")
    grouped = met.groupBy("start", "block").agg(F.first("codes").alias("codes"), F.collect_list("position").alias("positions"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["codes"])
                yield pa.RecordBatch.from_pydict({
                    "position": pa.array(row["positions"], pa.int64()),
                    "token": pa.array([codes[p - row["start"]] for p in row["positions"]], pa.int64()),
                })

    found = grouped.mapInArrow(pick, "position long, token long")
    return positions.join(found, "position", "left").select("position", "token")


def token_table(docs: DataFrame, tokenizer: str, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Write the corpus below the shared folder, read it back, and check sums of the ids of each document."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-codes")
    write_tokens(docs, tokenizer, folder, segment_ids=segment_ids)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [crc(np.frombuffer(raw, "<u4")) for raw in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_tokens(spark, folder).mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
