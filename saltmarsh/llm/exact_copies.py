"""Exact de-duplication with a split of the most frequent texts; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saltmarsh.llm.common import unused
from saltmarsh.session import stored

HEAVY_SHARE = 0.001


def digest() -> Column:
    """The sha256 of the text with each run of ``[\\x20\\x09-\\x0D]`` as one space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, a number of the row, and its digest."""
    return docs.select("doc_id", digest().alias("text_sha256"), F.monotonically_increasing_id().alias("row"))


def _split(rows: DataFrame, heavy_share: float) -> tuple[DataFrame, DataFrame]:
    """Winners of the frequent digests, a table of bounded size to broadcast, and the rows of all other digests with their winner."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("row")]
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")))
    named = rows.freqItems(["text_sha256"], heavy_share).select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    heavy = F.broadcast(stored(named.distinct(), "heavy"))  # at most 1 / heavy_share rows
    winners = (
        rows.join(heavy, "text_sha256", "left_semi").groupBy("text_sha256")
        .agg(first.alias("first"), F.count("*").alias("group_size"))
        .select("text_sha256", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")
    )
    winners = F.broadcast(stored(winners, "winners"))  # as many rows as ``heavy``
    by_digest = Window.partitionBy("text_sha256")
    others = (
        rows.join(heavy, "text_sha256", "left_anti")
        .withColumn("keep_id", F.first("doc_id").over(by_digest.orderBy(*order)))
        .withColumn("keep_row", F.first("row").over(by_digest.orderBy(*order)))
        .withColumn("group_size", F.count("*").over(by_digest))
    )
    return winners, others


def label_copies(docs: DataFrame, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Misra-Gries counters (``freqItems``) name at most ``1 / heavy_share``
    digests, among them every digest with more than that share of all rows.
    Their exact winners and sizes are counted with map-side sums, and their
    rows are labelled without a shuffle from this table of bounded size.  All
    other rows are dealt by digest, so no group there has more than
    ``heavy_share`` of the rows.

    Null text counts as empty.  The smallest id of a group stays, null ids
    last; of rows with the same id and text the first one stays.  An empty
    table gives no rows; other columns are not read.
    """
    rows = stored(digests(docs), "digests")
    winners, others = _split(rows, heavy_share)
    frequent = rows.join(winners, "text_sha256")
    return frequent.unionByName(others).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The rows are written once with a number and their digest.  Copies of
    frequent texts go by the broadcast winners, before anything is shuffled; of
    the others only the numbers of the rows that go are joined, so texts move
    at most once, and not at all where these numbers are few enough to broadcast.
    Of rows that agree in id and text the first one stays.  Columns of ``docs``
    may have any name; nulls and empty tables are as in :func:`label_copies`.
    """
    row, mark, keep = unused(docs, "_row", "_digest", "_keep_row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(mark, digest()), "rows")
    winners, others = _split(rows.select("doc_id", F.col(mark).alias("text_sha256"), F.col(row).alias("row")), heavy_share)
    winners = F.broadcast(winners.select(F.col("text_sha256").alias(mark), F.col("keep_row").alias(keep)))
    stay = rows.join(winners, mark, "left").where(F.col(keep).isNull() | (F.col(keep) == F.col(row)))
    gone = others.where("row <> keep_row").select(F.col("row").alias(row))
    return stay.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
