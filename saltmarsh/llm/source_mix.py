"""Mixing sources to target weights by a low-discrepancy schedule over blocks of equally many words.

The documents of a source, in an order shuffled by a hash, are one stream of
words, cut into blocks.  A source needs so many slots as blocks reach its
target, going round its stream again where the target is above its size.  The
slots of all sources share the points of a van der Corput sequence: cumulated
slot numbers map the points ``0, 1/M, 2/M, ...`` to sources, and bit reversal
gives each point its place in the schedule.  So every source gets exactly its
number of slots and is spread evenly over any stretch of the schedule.  The
slots of a source, ranked by place, take its blocks one after the other.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.operators.ranking import ordered_positions
from saltmarsh.session import stored

BLOCK_WORDS = 2048
WEIGHTS = (1, 2, 3)
MOST_TIMES = 3
CHUNK = 4096  # slots made by one row


class Mix(NamedTuple):
    """``sources``: source, size, weight, target, quota.  ``slots``: slot, source, block, take (words of the block).

    ``documents``: row, doc_id, source, size, start (in the stream of the source), source_size, target.
    """

    sources: DataFrame
    slots: DataFrame
    documents: DataFrame


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def with_targets(sources: DataFrame, most_times: int = MOST_TIMES) -> DataFrame:
    """Adds ``target`` to ``size`` and ``weight`` per source: shares of the sum of all sizes by weight, at most ``most_times`` the size.

    What a stopped source leaves over goes to the others by weight, until no
    target is above its stop.  Each round is one aggregate over the sources and
    stops one of them at least; the test of a source is exact, in integers.
    """
    one, big = F.lit(1).cast("decimal(38,0)"), "decimal(38,0)"
    cap = (F.col("size") * most_times).cast("decimal(20,0)")
    words = sources.agg(F.sum(F.col("size").cast(big))).first()[0] or 0
    stopped: Column = F.lit(False)
    known, rest, weights = -1, 0, 0
    while True:
        found = sources.agg(
            F.count(F.when(stopped, one)), F.coalesce(F.sum(F.when(stopped, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight").cast("long"))), F.lit(0))).first()
        rest, weights = int(words - found[1]), int(found[2])
        if found[0] == known or not weights:
            break
        known = found[0]
        share = F.col("weight").cast("decimal(10,0)") * F.lit(rest).cast("decimal(25,0)")
        stopped = cap * F.lit(weights).cast("decimal(17,0)") < share
    open_share = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(weights or 1))
    return sources.withColumn("target", F.when(stopped, cap.cast("double")).otherwise(open_share))


def bit_reversed(value: Column, bits: int) -> Column:
    if not bits:
        return value
    return F.conv(F.reverse(F.lpad(F.bin(value), bits, "0")), 2, 10).cast("long")


def _slots(sources: DataFrame, block_words: int) -> DataFrame:
    blocks = F.ceil(F.col("size") / block_words).cast("long")
    over = F.col("quota") - F.expr("quota DIV size") * F.col("size")
    n = F.when(F.col("size") > 0, F.expr("quota DIV size") * blocks + F.ceil(over / block_words)).otherwise(0).cast("long")
    sources = sources.withColumn("blocks", blocks).withColumn("slots", n)
    owned = ordered_positions(sources, [], [F.col("rank")], "_at", sums={"first_point": "slots"})
    needed = sources.agg(F.sum("slots")).first()[0] or 0
    bits = max(int(needed) - 1, 0).bit_length()
    chunks = owned.where("slots > 0").select(
        "tree", "size", "quota", "blocks", "slots", "first_point",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(CHUNK).cast("long"))).alias("chunk"))
    own = F.explode(F.sequence(F.col("chunk"), F.least(F.col("chunk") + CHUNK, F.col("slots")) - 1))
    points = chunks.repartition("tree", "chunk").select("tree", "size", "quota", "blocks", "first_point", own.alias("point"))
    point = F.col("first_point") + F.col("point")
    placed = points.select("tree", "size", "quota", "blocks", bit_reversed(point, bits).alias("slot"))
    ranked = ordered_positions(placed, ["tree"], [F.col("slot")], "turn")
    block, cycle = F.col("turn") % F.col("blocks"), F.expr("turn DIV blocks")
    before = cycle * F.col("size") + block * block_words
    take = F.least(F.lit(block_words), F.col("size") - block * block_words, F.col("quota") - before)
    return ranked.select("slot", "tree", block.alias("block"), cycle.alias("cycle"), take.alias("take"))


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_times: int = MOST_TIMES, block_words: int = BLOCK_WORDS) -> Mix:
    """Targets, schedule and shuffled documents.

    Sources by code point, null last, get the ``weights`` in turn.  Documents of
    a source go by the md5 of their decimal id (null ids first), then id, size
    and a hash of the text, so reruns agree.  A source is named in ``tree``:
    ``=`` and its name, or nothing for null.  Quotas are targets rounded to words.
    """
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree")
    rows = stored(docs.select(
        "doc_id", named, word_count(F.col("text")).alias("size"), F.md5(F.col("doc_id").cast("string")).alias("shuffle"),
        F.xxhash64("text").alias("tie")), "mix-sizes")
    sources = stored(rows.groupBy("tree").agg(F.sum("size").alias("size")), "mix-sources")
    turn = ordered_positions(sources, [], [(F.col("tree") == "").asc(), F.col("tree").asc()], "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stored(turn.withColumn("weight", weight), "mix-weights")
    quota = F.least(F.round("target").cast("long"), F.col("size") * most_times)
    sources = stored(with_targets(sources, most_times).withColumn("quota", quota), "mix-targets")
    slots = stored(_slots(sources, block_words), "mix-slots")
    order = [F.col("shuffle").asc_nulls_first(), F.col("doc_id"), F.col("size"), F.col("tie")]
    about = sources.select("tree", F.col("size").alias("source_size"), "target")
    documents = ordered_positions(rows, ["tree"], order, "_at", sums={"start": "size"}, about=about)
    documents = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "tree", "size", "start", "source_size", "target")
    return Mix(sources, slots, stored(documents, "mix-documents"))


def pieces(mix: Mix, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: per slot, in the order of ``slot`` and ``offset``, words ``first_word`` to ``first_word + words`` of documents.

    A document meets slots by the blocks it lies in.  A block has at most
    ``block_words`` documents with words and, from its cycles, a few slots, so
    no join key is frequent however large a source is.
    """
    docs = mix.documents.where("size > 0")
    spans = F.sequence(F.expr(f"start DIV {block_words}"), F.expr(f"(start + size - 1) DIV {block_words}"))
    cut = docs.select("row", "doc_id", "tree", "start", "size", F.explode(spans).alias("block"))
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    cut = cut.select("row", "doc_id", "tree", "block", (begin - F.col("start")).alias("first_word"),
                     (begin - F.col("block") * block_words).alias("offset"), (end - begin).alias("n"))
    met = cut.join(mix.slots, ["tree", "block"]).withColumn("words", F.least(F.col("n"), F.col("take") - F.col("offset")))
    return met.where("words > 0").select("slot", "offset", "row", "doc_id", "tree", "cycle", "first_word", "words")


def taken(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_times: int = MOST_TIMES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target`` (of its source) and ``taken`` (words in the mix).

    Null and empty texts have no words and are taken 0 times; a null source is a
    source.  Repeated rows are documents of their own.  Without any word all
    targets are 0; an empty table gives no rows; columns other than ``doc_id``,
    ``source`` and ``text`` are not read.
    """
    mix = plan(docs, weights, most_times, block_words)
    whole = mix.documents.select("row", "doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("words"))
    nothing = [F.lit(None).cast(t).alias(n) for n, t in [("doc_id", "long"), ("size", "long"), ("source_size", "long"), ("target", "double")]]
    parts = pieces(mix, block_words).select("row", *nothing, "words")
    both = whole.unionByName(parts).groupBy("row").agg(
        *[F.max(c).alias(c) for c in ("doc_id", "size", "source_size", "target")], F.sum("words").alias("taken"))
    return both.drop("row")
