"""Quality rules in a short-circuit cascade ordered by rejection per cost.

Every rule looks at the whole text.  The order is estimated on a sample: the
time a rule takes and the share of texts it rejects.  A text that one rule
rejects is not shown to the later ones, so the order changes the cost, never
the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.common import slices, texts, windows, word_hashes

SAMPLE_ROWS = 400
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent of the words
SYMBOLS = b"#*$%&|<>"
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


class Text:
    """One text with what several rules need, computed once when first asked for."""

    def __init__(self, raw: bytes, words: np.ndarray, base: tuple[int, ...]) -> None:
        self.raw, self.words = raw, words
        self.n_words, self.word_chars, self.n_symbols, self.n_dup_lines, self.n_repeat_words = base


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Text], bool]


def _upper(t: Text) -> bool:
    """More than half of all letters A-Z, a-z are capitals."""
    letters = sum(t.raw.count(bytes([b])) for b in range(97, 123))
    capitals = sum(t.raw.count(bytes([b])) for b in range(65, 91))
    return capitals > letters


def _lines(t: Text) -> bool:
    """More than 30 % of the lines with a word equal an earlier line, and at least four of them do."""
    lines = sum(1 for line in t.raw.split(b"\n") if line.strip(SPACE))
    return t.n_dup_lines >= 4 and 100 * t.n_dup_lines > 30 * lines


def _runs(t: Text) -> bool:
    """More than 20 % of the words equal the word before."""
    return len(t.words) > 1 and 100 * int((t.words[1:] == t.words[:-1]).sum()) > 20 * len(t.words)


def _length(t: Text) -> bool:
    """The mean word is shorter than 2 or longer than 25 characters."""
    return t.word_chars < 2 * t.n_words or t.word_chars > 25 * t.n_words


RULES = [
    Rule("symbols", lambda t: 100 * t.n_symbols > 4 * t.word_chars),
    Rule("shouting", lambda t: 100 * t.raw.count(b"!!") > 20 * t.n_words),
    Rule("capitals", _upper),
    Rule("repeated_lines", _lines),
    Rule("word_runs", _runs),
    Rule("word_length", _length),
]


def repeated(words: np.ndarray, size: int) -> int:
    """Words inside windows of ``size`` words that occur twice or more in the text."""
    found = windows(words, size)
    if not len(found):
        return 0
    order = np.argsort(found, kind="stable")
    same = found[order][1:] == found[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(found), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + size, -1)
    return int((np.cumsum(cover) > 0).sum())


def measured(values: list[str | None]) -> Iterator[Text]:
    """The texts of one batch with their base figures; null counts as empty."""
    _, before, hashes, _, _ = word_hashes(values, lower=False)
    for k, value in enumerate(values):
        raw = (value or "").encode("utf-8", "replace")
        words = hashes[before[k]:before[k + 1]]
        lines = [line for line in raw.split(b"\n") if line.strip(SPACE)]
        chars = len(value or "") - (len(raw) - len(raw.translate(None, SPACE)))
        symbols = len(raw) - len(raw.translate(None, SYMBOLS))
        yield Text(raw, words, (len(words), chars, symbols, len(lines) - len(set(lines)), repeated(words, WINDOW)))


def base_fails(t: Text) -> bool:
    return t.n_words < MIN_WORDS or 100 * t.n_repeat_words > MAX_REPEATED * t.n_words


def order_rules(plain: DataFrame, rules: list[Rule], rows: int) -> list[Rule]:
    """The rules by rejected texts per second on ``rows`` whole texts, highest first; an empty sample leaves the order.

    The texts are those with the smallest hashes of the number of the row.  The
    rules are timed inside the tasks that hold the texts, so only sums, one row
    per rule, come to the driver.  The order never changes a verdict.
    """
    keyed = plain.select("text", F.xxhash64(F.monotonically_increasing_id()).alias("key"))
    last = keyed.select("key").orderBy("key").limit(rows).agg(F.max("key")).first()[0]
    if last is None:
        return list(rules)

    def timed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rejected, seconds, seen = [0] * len(rules), [0.0] * len(rules), 0
        for part in slices(batches):
            texts_left = [t for t in measured(part.column("text").to_pylist()) if not base_fails(t)]
            seen += len(texts_left)
            for k, rule in enumerate(rules):
                start = time.perf_counter()
                rejected[k] += sum(rule.rejects(t) for t in texts_left)
                seconds[k] += time.perf_counter() - start
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rules)), pa.int32()), pa.array(rejected, pa.int64()), pa.array(seconds, pa.float64()),
             pa.array([seen] * len(rules), pa.int64())], names=["rule", "rejected", "seconds", "seen"])

    sample = keyed.where(F.col("key") <= last).select("text")
    sums = sample.mapInArrow(timed, "rule int, rejected long, seconds double, seen long").groupBy("rule").agg(
        F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds"), F.sum("seen").alias("seen")).collect()
    if not any(r["seen"] for r in sums):
        return list(rules)
    rate = {rules[r["rule"]].name: (r["rejected"] + 0.5) / (r["seconds"] + 1e-9) for r in sums}
    return sorted(rules, key=lambda r: -rate[r.name])


def judge(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: ``doc_id``, the base figures, ``base_failed`` and ``kept``.

    The cost sample of ``sample_rows`` whole texts sets the order of the rules only.  Null and empty texts have no word
    and fail the base rule.  Equal rows give equal results, an empty table
    gives no rows, and other columns are not read.
    """
    plain = texts(docs)
    ordered = order_rules(plain, rules or RULES, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for t in measured(part.column("text").to_pylist()):
                failed = base_fails(t)
                kept = not failed and not any(rule.rejects(t) for rule in ordered)
                out.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, kept))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:5]], *[pa.array(c, pa.bool_()) for c in columns[5:]]],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])

    return plain.mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that pass the base rule and all rules of the cascade, with all their columns."""
    ordered = order_rules(texts(docs), rules or RULES, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            kept = [not base_fails(t) and not any(rule.rejects(t) for rule in ordered)
                    for t in measured(part.column("text").to_pylist())]
            yield part.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
