"""Language-model scores by stupid backoff over tokens of a public vocabulary.

The score of a token after its context is count(n-gram) / count(context) if the
n-gram occurs at least ``MIN_COUNT`` times in the corpus, else ``BACKOFF`` times
the score after the context without its first token; without context it is the
share of the token among all tokens.  The order is the number of tokens of an
n-gram.  N-grams are counted over all documents into a table that is
partitioned by a hash of the n-gram, and each gets its score there: a rare one
joins the pair it ends in, a frequent one the pair it starts with.  Then the
n-grams of all documents are dealt by the same hash and meet the table there;
partial sums of log scores go back to their documents.

The texts are encoded once: their token ids are written to the shared folder,
and both the counting and the scoring step read them there.
N-grams travel as sorted arrays, one row per slice of documents and hash bucket,
so a frequent n-gram is one entry per slice in the counting step.  Slices grow
with the number of buckets, up to ``MOST_HELD`` n-grams, so that rows stay long.  The most
frequent ones, at most ``HEAVY`` whatever the corpus, are known to all tasks and
are not sent in the scoring step.  Both steps stream over their rows: memory
holds the distinct n-grams of one bucket, never the rows of a frequent one.
What else is sent to all tasks is one number per token of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.common import mixed, slices, texts
from saltmarsh.llm.encoding import encoder
from saltmarsh.session import stored

BACKOFF = 0.4
MIN_COUNT = 2
HEAVY = 1 << 21
SLICE_BYTES = 1 << 20
SLICE_ROWS = 4096
SLICE_GRAMS = 1 << 18
OWNER_BITS = 14  # documents whose n-grams are sent together are numbered in so many bits
LEAST_HELD, MOST_HELD, ROW_GRAMS = 1 << 19, 1 << 21, 2048


def _packed(x: np.ndarray) -> bytes:
    """64-bit numbers as all first bytes, then all second bytes and so on as far as any number has one; before them the count of these."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :raw[0]] = planes.T
    return out.view(np.uint64).ravel()


def _planes(x: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as packed differences."""
    return _packed(np.diff(x, prepend=x.dtype.type(0)))


def _unplanes(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw), dtype=np.uint64)


def _id_type(size: int) -> np.dtype:
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def token_ids(plain: DataFrame, tokenizer: str, size: int) -> DataFrame:
    """The token ids of each text, as numbers of two bytes if the vocabulary allows, else of four."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _id_type(size)
        for part in slices(batches, rows=SLICE_ROWS, size=SLICE_BYTES):
            ids, before = encoder(tokenizer).encode(part.column("text").to_pylist())
            buffers = [None, pa.py_buffer((before * kind.itemsize).astype(np.int64)), pa.py_buffer(ids.astype(kind))]
            column = pa.Array.from_buffers(pa.large_binary(), part.num_rows, buffers).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), column], names=["doc_id", "ids"])

    return plain.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, ids binary")


def _grams(batches: Iterator[pa.RecordBatch], size: int, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Slices of the batches: keys of the n-grams of all texts in a row, the number of tokens per text, and the rows.

    There is one n-gram per token, the token and the ``order - 1`` before it, as digits of a number of base
    ``size + 1``.  ``size`` is the number of tokens; before the first token the context is the number ``size`` itself.
    """
    base, kind = np.uint64(size + 1), _id_type(size)
    for batch in batches:
        column = batch.column("ids").cast(pa.large_binary())
        before = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        every = np.frombuffer(column.buffers()[2] or b"", np.uint8)[:before[-1]].view(kind)
        before = before // kind.itemsize
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(before, before[start] + SLICE_GRAMS, "right")) - 1
            stop = min(max(stop, start + 1), start + SLICE_ROWS, batch.num_rows)
            ids, lengths = every[before[start]:before[stop]].astype(np.uint64), np.diff(before[start:stop + 1])
            place = np.arange(len(ids)) - np.repeat(before[start:stop] - before[start], lengths)
            keys = np.zeros(len(ids), np.uint64)
            for back in range(order - 1, -1, -1):
                token = np.full(len(ids), size, np.uint64)
                token[back:] = ids[:len(ids) - back]
                token[place < back] = size
                keys = keys * base + token
            yield keys, lengths, batch.slice(start, stop - start)
            start = stop


def _held(buckets: int) -> int:
    """N-grams that a task gathers before it sends them, about ``ROW_GRAMS`` to each bucket, within bounds of memory."""
    return min(max(LEAST_HELD, ROW_GRAMS * buckets), MOST_HELD)


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of the keys of each bucket, in their order."""
    which = (mixed(keys) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    which = which.astype(np.uint16 if buckets <= 1 << 16 else np.int64)  # numpy sorts 16-bit numbers by radix
    order = np.argsort(which, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=buckets))])
    for bucket in range(buckets):
        if cuts[bucket + 1] > cuts[bucket]:
            yield bucket, order[cuts[bucket]:cuts[bucket + 1]]


def _by_key(keys: np.ndarray, owner: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys below ``top`` and their owners, sorted by both: as one number each, which sorts much faster, wherever 64 bits hold it."""
    if top <= 1 << (64 - OWNER_BITS):
        both = keys << np.uint64(OWNER_BITS) | owner.astype(np.uint64)
        both.sort()
        return both >> np.uint64(OWNER_BITS), (both & np.uint64((1 << OWNER_BITS) - 1)).astype(np.uint16)
    by_key = np.lexsort((owner, keys))
    return keys[by_key], owner[by_key].astype(np.uint16)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys start."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts; fast on sorted runs one after the other."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = _starts(keys)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and how often each occurs."""
    keys = np.sort(keys)  # without places, which is much faster than the sort of ``_merge`` on keys in no order
    starts = _starts(keys)
    return keys[starts], np.diff(starts, append=len(keys))


def _rows(items: list[tuple]) -> pa.RecordBatch:
    bucket, keys, counts = zip(*items)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], names=["bucket", "keys", "counts"])


def _dealt(rows: DataFrame, partitions: int, bucket: str | Column = "bucket") -> DataFrame:
    """Buckets are hash values already: dealt by turns, each partition gets as many of them."""
    return rows.repartitionById(partitions, F.pmod(bucket, F.lit(partitions)))


def gram_counts(plain: DataFrame, tokenizer: str, size: int, order: int, buckets: int, partitions: int) -> DataFrame:
    """The count table of texts."""
    return id_counts(token_ids(plain, tokenizer, size), size, order, buckets, partitions)


def id_counts(ids: DataFrame, size: int, order: int, buckets: int, partitions: int) -> DataFrame:
    """The count table: one row per bucket with its distinct n-grams, sorted, and their counts over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return _rows([(b, _planes(held[at]), _packed(held_counts[at])) for b, at in _by_bucket(held, buckets)])

        for grams, _, _ in _grams(batches, size, order):
            held, held_counts = _merge(*map(np.concatenate, zip((held, held_counts), _counted(grams))))
            if len(held) > _held(buckets):
                yield out()
                held, held_counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(held):
            yield out()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: int | None = None  # rows come bucket by bucket, so one bucket is held at a time
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def out() -> pa.RecordBatch:
            return _rows([(at, _planes(keys), _packed(counts))])

        for batch in batches:
            for i in range(batch.num_rows):
                bucket = batch.column("bucket")[i].as_py()
                if waiting and (n > max(len(keys) // 2, 1 << 16) or bucket != at):
                    keys, counts = _merge(*map(np.concatenate, zip((keys, counts), *waiting)))
                    waiting.clear()
                    n = 0
                if at is not None and bucket != at:
                    yield out()
                    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                at = bucket
                waiting.append((_unplanes(batch.column("keys")[i].as_py()), _unpacked(batch.column("counts")[i].as_py()).view(np.int64)))
                n += len(waiting[-1][0])
        if at is not None:
            keys, counts = _merge(*map(np.concatenate, zip((keys, counts), *waiting)))
            yield out()

    schema = "bucket int, keys binary, counts binary"
    return _dealt(ids.select("ids").mapInArrow(count, schema), partitions).sortWithinPartitions("bucket").mapInArrow(total, schema)


def token_counts(table: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each token (and the start) is the last of a context, and how often each token occurs; as many numbers as the vocabulary has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, token = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
        base = np.uint64(size + 1)
        for batch in batches:
            for i in range(batch.num_rows):
                keys, counts = _unplanes(batch.column("keys")[i].as_py()), _unpacked(batch.column("counts")[i].as_py()).view(np.int64)
                np.add.at(context, (keys // base % base).astype(np.int64), counts)
                np.add.at(token, (keys % base).astype(np.int64), counts)
        seen = np.flatnonzero(context + token)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(context[seen]), pa.array(token[seen])], names=["token", "context", "n"])

    sums = table.mapInArrow(count, "token long, context long, n long").groupBy("token").agg(F.sum("context"), F.sum("n"))
    context, token = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
    for row in sums.collect():  # at most one row per token of the vocabulary
        context[row[0]], token[row[0]] = row[1], row[2]
    return context, token


def _pair_value(keys: np.ndarray, counts: np.ndarray, size: int, numbers: tuple[np.ndarray, np.ndarray], min_count: int) -> np.ndarray:
    """Log scores of pairs; ``numbers`` are logs of context counts, and of the shares of tokens after one step of backoff."""
    contexts, tokens = numbers
    base = np.uint64(size + 1)
    return np.where(counts >= min_count, np.log(counts) - contexts[(keys // base).astype(np.int64)], tokens[(keys % base).astype(np.int64)])


def _pair_scores(table: DataFrame, size: int, numbers, min_count: int) -> DataFrame:
    """The count table of pairs with a log score and a mark of backoff for each pair."""

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw, counts = batch.column("keys")[i].as_py(), _unpacked(batch.column("counts")[i].as_py()).view(np.int64)
                found = _pair_value(_unplanes(raw), counts, size, numbers.value, min_count)
                yield _rows([(batch.column("bucket")[i].as_py(), raw, found.tobytes() + (counts < min_count).tobytes())])

    return table.mapInArrow(value, "bucket int, keys binary, counts binary").withColumnRenamed("counts", "scores")


def _triple_scores(table: DataFrame, size: int, numbers, min_count: int, backoff: float, buckets: int, partitions: int) -> DataFrame:
    """The count table of triples with a log score and a mark of backoff for each triple.

    A triple of at least ``min_count`` joins the count of its first two tokens as a context, any other one
    joins the score of its last two, so each is in one join row.  A pair has at most as many triples as
    the vocabulary has tokens.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.uint64(size + 1)
        for batch in batches:
            for i in range(batch.num_rows):
                keys, counts = _unplanes(batch.column("keys")[i].as_py()), _unpacked(batch.column("counts")[i].as_py()).view(np.int64)
                for first, pair in ((True, keys // base), (False, keys % (base * base))):
                    pair, n = _merge(pair, counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(pair), first)), pa.array(pair.astype(np.int64)), pa.array(n)], names=["first", "pair", "n"])

    def lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, pair, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            value = np.log(backoff) + _pair_value(pair.astype(np.uint64), n, size, numbers.value, min_count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first), pa.array(pair), pa.array(np.where(first, -np.log(n), value))], names=["first", "pair", "part"])

    def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.uint64(size + 1)
        for batch in batches:
            for i in range(batch.num_rows):
                keys, counts = _unplanes(batch.column("keys")[i].as_py()), _unpacked(batch.column("counts")[i].as_py()).view(np.int64)
                first = counts >= min_count
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first), pa.array(np.where(first, keys // base, keys % (base * base)).astype(np.int64)),
                     pa.array(np.full(len(keys), batch.column("bucket")[i].as_py(), np.int32)), pa.array(keys.astype(np.int64)), pa.array(counts)],
                    names=["first", "pair", "bucket", "key", "n"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def out(rows: pa.Table) -> pa.RecordBatch:
            keys, value = rows.column("key").to_numpy().astype(np.uint64), rows.column("value").to_numpy()
            missed = ~rows.column("first").to_numpy()
            return _rows([(rows.column("bucket")[0].as_py(), _planes(keys), value.tobytes() + missed.tobytes())])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            bucket = rows.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            for i, j in zip(cuts[:-2], cuts[1:-1]):
                yield out(rows.slice(i, j - i))
            held = rows.slice(cuts[-2]) if len(bucket) else None
        if held is not None:
            yield out(held)

    sums = table.mapInArrow(pairs, "first boolean, pair long, n long").groupBy("first", "pair").agg(F.sum("n").alias("n"))
    known = sums.mapInArrow(lower, "first boolean, pair long, part double")
    rows = table.mapInArrow(triples, "first boolean, pair long, bucket int, key long, n long").join(known, ["first", "pair"])
    value = F.when(F.col("first"), F.ln("n") + F.col("part")).otherwise(F.col("part"))
    dealt = _dealt(rows.select("bucket", "key", value.alias("value"), "first"), partitions)
    return dealt.sortWithinPartitions("bucket", "key").mapInArrow(pack, "bucket int, keys binary, counts binary").withColumnRenamed("counts", "scores")


def heavy_scores(counts: DataFrame, scored: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of at least ``least`` occurrences: sorted keys, log scores and marks of backoff."""

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, n = _unplanes(batch.column("keys")[i].as_py()), _unpacked(batch.column("counts")[i].as_py()).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([keys[n >= least].tobytes()], pa.binary())], names=["keys"])

    # at most HEAVY keys in all
    wanted = np.frombuffer(b"".join(r[0] for r in counts.mapInArrow(often, "keys binary").collect()), np.uint64)
    wanted = counts.sparkSession.sparkContext.broadcast(np.sort(wanted))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, scores = _unplanes(batch.column("keys")[i].as_py()), batch.column("scores")[i].as_py()
                value, missed = np.frombuffer(scores, "<f8", len(keys)), np.frombuffer(scores, "?", len(keys), 8 * len(keys))
                at = np.flatnonzero(np.isin(keys, wanted.value))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()], pa.binary()) for x in (keys[at], value[at], missed[at])], names=["keys", "value", "missed"])

    found = scored.mapInArrow(pick, "keys binary, value binary, missed binary").collect()
    keys, value, missed = (np.frombuffer(b"".join(r[k] for r in found), kind) for k, kind in enumerate((np.uint64, "<f8", "?")))
    by_key = np.argsort(keys)
    return keys[by_key], value[by_key], missed[by_key]


def score(docs: DataFrame, tokenizer: str, backoff: float = BACKOFF, min_count: int = MIN_COUNT, order: int = 2) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``n_backed_off``, ``log_prob`` (sum of natural logs) and ``mean_log_prob``.

    The counts are those of all documents.  ``order`` is 2 or 3; ``n_backed_off`` are the tokens whose
    whole n-gram is too rare.  Texts without a token (null, empty)
    have the sum 0 and a null mean.  Equal texts get equal scores, rows with
    the same id are documents of their own, an empty table gives no rows, and
    other columns are not read.
    """
    if order not in (2, 3):
        raise ValueError(f"order {order} is neither 2 nor 3")
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 2 * partitions
    size = encoder(tokenizer).library.get_vocab_size()
    ids = stored(token_ids(texts(docs), tokenizer, size), "gram-ids", "zstd")
    counts = stored(id_counts(ids, size, order, buckets, partitions), "gram-counts")
    context, token = token_counts(counts, size)
    total = int(token.sum())
    log_context = np.log(np.maximum(context, 1))
    log_token = np.log(backoff) + np.log(np.maximum(token, 1)) - np.log(max(total, 1))
    numbers = spark.sparkContext.broadcast((log_context, log_token))
    if order == 2:
        table = _pair_scores(counts, size, numbers, min_count)
    else:
        table = _triple_scores(counts, size, numbers, min_count, backoff, buckets, partitions)
    table = stored(table, "gram-scores")
    heavy = spark.sparkContext.broadcast(heavy_scores(counts, table, max(min_count, total // HEAVY + 1)))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_value, known_missed = heavy.value
        waiting: list[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]] = []

        def out() -> pa.RecordBatch:
            lengths = np.concatenate([n for _, n, _, _ in waiting])
            owner = np.repeat(np.arange(len(lengths), dtype=np.uint16), lengths)
            keys, owner = _by_key(np.concatenate([k for k, _, _, _ in waiting]), owner, (size + 1) ** order)
            sums, missed = np.zeros(len(lengths)), np.zeros(len(lengths), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)  # fast, as the keys are sorted
                here = known[at] == keys
                sums += np.bincount(owner[here], known_value[at[here]], len(lengths))
                missed += np.bincount(owner[here], known_missed[at[here]], len(lengths)).astype(np.int64)
                keys, owner = keys[~here], owner[~here]
            slice_id = waiting[0][3][0].as_py()
            doc_id = pa.concat_arrays([d for _, _, d, _ in waiting])
            rows = [(b, slice_id, _planes(keys[at]), owner[at].tobytes()) for b, at in _by_bucket(keys, buckets)]
            # The documents themselves, with their number of tokens and the sums of their most frequent n-grams.
            rows.append((-1, slice_id, np.array(doc_id.fill_null(0), "<i8").tobytes() + np.array(doc_id.is_null()).astype("u1").tobytes(),
                         lengths.astype("<i8").tobytes() + sums.astype("<f8").tobytes() + missed.astype("<i8").tobytes()))
            bucket, slice_ids, keys_, owners = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), pa.array(slice_ids, pa.int64()), pa.array(keys_, pa.binary()), pa.array(owners, pa.binary())],
                names=["bucket", "slice", "keys", "values"])

        for keys, lengths, part in _grams(batches, size, order):
            waiting.append((keys, lengths, part.column("doc_id"), part.column("row")))
            if sum(len(k) for k, _, _, _ in waiting) > _held(buckets) or sum(len(n) for _, n, _, _ in waiting) > (1 << OWNER_BITS) - SLICE_ROWS:
                yield out()
                waiting.clear()
        if waiting:
            yield out()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, value, missing = None, None, None
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                bucket, slice_id, raw, values = (batch.column(c)[i].as_py() for c in ("bucket", "slice", "keys", "values"))
                if bucket < 0:
                    out.append((slice_id, None, raw, values))
                elif slice_id is None:  # the table of the bucket comes first
                    here = _unplanes(raw)
                    value, missing = np.frombuffer(values, "<f8", len(here)), np.frombuffer(values, "?", len(here), 8 * len(here))
                else:
                    at = np.searchsorted(here, _unplanes(raw))
                    owner = np.frombuffer(values, np.uint16)
                    docs_here = np.flatnonzero(np.bincount(owner)).astype(np.uint16)
                    sums = np.bincount(owner, value[at])[docs_here]
                    missed = np.bincount(owner, missing[at])[docs_here].astype("<i8")
                    out.append((slice_id, docs_here.tobytes(), sums.astype("<f8").tobytes(), missed.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                    names=["slice", "docs", "sums", "missed"])

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        """All partial sums of one slice of documents."""
        head = frame[frame["docs"].isnull()].iloc[0]
        n = len(head["missed"]) // 24
        lengths = np.frombuffer(head["missed"], "<i8", n)
        total, missed = np.frombuffer(head["missed"], "<f8", n, 8 * n).copy(), np.frombuffer(head["missed"], "<i8", n, 16 * n).copy()
        for row in frame[frame["docs"].notnull()].sort_values(["docs", "sums"]).itertuples():
            docs_here = np.frombuffer(row.docs, np.uint16)
            total[docs_here] += np.frombuffer(row.sums, "<f8")
            missed[docs_here] += np.frombuffer(row.missed, "<i8")
        ids = pd.array(np.frombuffer(head["sums"][:8 * n], "<i8"), dtype="Int64")
        ids[np.frombuffer(head["sums"][8 * n:], "u1") > 0] = pd.NA
        return pd.DataFrame({"doc_id": ids, "n_tokens": lengths, "n_backed_off": missed, "log_prob": total})

    tables = table.select("bucket", F.lit(None).cast("long").alias("slice"), "keys", F.col("scores").alias("values"))
    exploded = ids.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        explode, "bucket int, slice long, keys binary, values binary")
    met = (
        _dealt(tables.unionByName(exploded), partitions, F.when(F.col("bucket") < 0, F.hash("slice")).otherwise(F.col("bucket")))
        .sortWithinPartitions("bucket", F.col("slice").asc_nulls_first())
        .mapInArrow(meet, "slice long, docs binary, sums binary, missed binary")
    )
    found = met.groupBy("slice").applyInPandas(gather, "doc_id long, n_tokens long, n_backed_off long, log_prob double")
    return found.select(
        "doc_id", "n_tokens", "n_backed_off", F.round("log_prob", 6).alias("log_prob"),
        F.when(F.col("n_tokens") > 0, F.round(F.col("log_prob") / F.col("n_tokens"), 6)).alias("mean_log_prob"))
