"""Quality classifier: the evidence of a document joined with shrunken posteriors of its host and path.

A logistic regression on figures of the whole text gives the odds of a good
document.  The labelled outcomes of the host (``source``) and of the path
below it (``source`` and ``lang``) are shrunk by empirical Bayes: the global
share of good documents is the prior of a host, the host's posterior mean the
prior of its paths.  The strength of each prior is a moment estimate from all
groups of that level, so sparse sites stay near their parent.  The path's log
odds, less the global ones that the regression already holds, are added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from saltmarsh.llm.common import slices, texts, unused, word_hashes
from saltmarsh.llm.shrinkage import strength
from saltmarsh.session import stored

TRAIN_ROWS = 8_000
THRESHOLD = 0.5
SYMBOLS = b"#*$%&|<>"
FEATURES = ["bias", "symbols", "pipes", "capitals", "shouting", "word_runs", "distinct_words", "word_length", "digits", "short"]
MODEL_SCHEMA = "doc_id long, p_text double"


def figures(values: list[str | None]) -> np.ndarray:
    """One row of ``FEATURES`` per text; null counts as empty.  All are shares of the whole text, so its length does not matter."""
    _, before, hashes, _, _ = word_hashes(values, lower=False)
    out = np.zeros((len(values), len(FEATURES)))
    for k, value in enumerate(values):
        raw = (value or "").encode("utf-8", "replace")
        words = hashes[before[k]:before[k + 1]]
        n = max(len(words), 1)
        chars = max(len(raw) - raw.count(b" ") - raw.count(b"\n"), 1)
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        capitals, small = int(counts[65:91].sum()), int(counts[97:123].sum())
        symbols = sum(int(counts[b]) for b in SYMBOLS)
        runs = int((words[1:] == words[:-1]).sum()) if len(words) > 1 else 0
        out[k] = [
            1, min(5 * symbols / chars, 1), min(5 * int(counts[124]) / n, 1), capitals / max(capitals + small, 1),
            min(3 * raw.count(b"!!") / n, 1), runs / n, len(np.unique(words)) / n, min(chars / n, 20) / 20,
            int(counts[48:58].sum()) / chars, 1 / (1 + n / 10),
        ]
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression by Newton steps; without rows of both kinds only a bias."""
    weights = np.zeros(x.shape[1])
    if len(y) == 0 or y.min() == y.max():
        weights[0] = 0.0 if len(y) == 0 else np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        return weights
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + penalty * weights
        hessian = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights fitted on the ``train_rows`` labelled rows with the smallest hash of the id (a bounded sample)."""
    some = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("good"))
        .orderBy(F.xxhash64("doc_id")).limit(train_rows)
    )
    schema = f"good int, {', '.join(f'{f} double' for f in FEATURES)}"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            x = figures(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("good").cast(pa.int32()), *map(pa.array, x.T)], names=["good", *FEATURES])

    # A label row and a figure row are a few numbers; at most ``train_rows`` of them reach the driver.
    sample = texts(docs).join(F.broadcast(some), "doc_id").select("doc_id", "text", "good").mapInArrow(measure, schema)
    rows = np.array([tuple(r) for r in sample.limit(2 * train_rows).collect()], dtype=float).reshape(-1, len(FEATURES) + 1)
    return fit(rows[:, 1:], rows[:, 0])


def posteriors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``host``, ``path``, ``prior``: the shrunken share of good documents of every path of every host in ``docs``.

    Outcomes are summed map-side, so a host with a third of all rows is one
    partial sum per task.  Null host or path is a group of its own.
    """
    outcome = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("good"))
    placed = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("host"), F.coalesce("lang", F.lit("")).alias("path"))
    paths = (
        placed.join(outcome, "doc_id", "left").groupBy("host", "path")
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    )
    total = paths.agg(((F.coalesce(F.sum("good"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("prior"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).join(F.broadcast(total))
    hosts = hosts.join(F.broadcast(strength(hosts.where("n > 0"))))
    mean = (F.col("good") + F.col("strength") * F.col("prior")) / (F.col("n") + F.col("strength"))
    hosts = hosts.select("host", mean.alias("prior"), F.col("prior").alias("total"))
    paths = paths.join(hosts, "host")
    paths = paths.join(F.broadcast(strength(paths.where("n > 0"))))
    return paths.select("host", "path", mean.alias("prior"), "total")


def _log_odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(p / (1 - p))


def judge(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id``, ``p_text`` (document alone), ``p_site`` (path posterior), ``p_good`` (both), ``kept``.

    Null text counts as empty.  Labels of unknown documents are ignored, of
    several labels of a document the best one counts.  Without labels every
    document has even odds and is kept.  An empty table gives no rows; columns
    other than ``doc_id``, ``text``, ``source`` and ``lang`` are not read.
    """
    sites = stored(posteriors(docs, labels), "site-posteriors")
    scored = _scored(docs.select("doc_id", "text", "source", "lang"), train(docs, labels, train_rows))
    keyed = scored.select(
        "doc_id", "p_text", F.coalesce("source", F.lit("")).alias("host"), F.coalesce("lang", F.lit("")).alias("path"))
    odds = _log_odds(F.col("p_text")) + _log_odds(F.col("prior")) - _log_odds(F.col("total"))
    p_good = 1 / (1 + F.exp(-odds))
    return keyed.join(sites, ["host", "path"]).select(
        "doc_id", "p_text", F.col("prior").alias("p_site"), p_good.alias("p_good"), (p_good >= threshold).alias("kept"))


def _scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id``, ``source``, ``lang`` and ``p_text``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            p = 1 / (1 + np.exp(-np.clip(figures(part.column("text").to_pylist()) @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("source"), part.column("lang"), pa.array(p)],
                names=["doc_id", "source", "lang", "p_text"])

    plain = docs.withColumn("text", F.coalesce("text", F.lit("")))
    return plain.mapInArrow(score, "doc_id long, source string, lang string, p_text double")


def keep_good(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose posterior is at least ``threshold``, with all their columns, whatever their names."""
    sites = stored(posteriors(docs, labels), "site-posteriors")
    weights = train(docs, labels, train_rows)
    fields = list(docs.columns)
    own, host, path, prior, total = unused(docs, "_p_text", "_host", "_path", "_prior", "_total")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            p = 1 / (1 + np.exp(-np.clip(figures(part.column("text").to_pylist()) @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], names=[*fields, own])

    schema = StructType([*docs.schema.fields]).add(own, DoubleType())
    marked = docs.mapInArrow(score, schema)
    site = sites.select(*[F.col(old).alias(new) for old, new in (("host", host), ("path", path), ("prior", prior), ("total", total))])
    met = marked.join(site, (F.coalesce("source", F.lit("")) == F.col(host)) & (F.coalesce("lang", F.lit("")) == F.col(path)))
    odds = _log_odds(F.col(own)) + _log_odds(F.col(prior)) - _log_odds(F.col(total))
    return met.where(1 / (1 + F.exp(-odds)) >= threshold).select(*[F.col(f"`{c}`") for c in fields])
