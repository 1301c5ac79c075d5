"""Comment moderation against a word list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.text import last_token
from saltmarsh.operators.ranking import first_per_key


def found_words(text: Column, words: Sequence[str]) -> Column:
    """Listed words that occur in the text, in list order.

    The list is configuration of the job (about a thousand words), so it travels
    as one array literal in the plan; the whole text is searched in the JVM.
    """
    listed = F.array(*[F.lit(w) for w in words])
    return F.filter(listed, lambda w: F.contains(text, w))


def moderate(comments: DataFrame, words: Sequence[str], column: str = "comment_txt", separator: str = ",") -> DataFrame:
    """Grade P0 if the last token is listed, P1 if any listed word occurs inside.

    Adds ``is_violation``, ``violation_grade`` and ``violation_msg``; works on
    batch and streaming frames.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    token = last_token(text, separator)
    hit = token.isin(*words) & (token != "")
    inside = F.when(~hit, found_words(text, words))
    step = comments.withColumn("_token", F.when(hit, token)).withColumn("_inside", inside)
    any_inside = F.coalesce(F.size("_inside"), F.lit(0)) > 0
    return step.select(
        *comments.columns,
        F.when(F.col("_token").isNotNull() | any_inside, 1).otherwise(0).alias("is_violation"),
        F.when(F.col("_token").isNotNull(), "P0").when(any_inside, "P1").otherwise("").alias("violation_grade"),
        F.coalesce("_token", F.when(any_inside, F.array_join("_inside", ", ")), F.lit("")).alias("violation_msg"),
    )


def moderate_once(comments: DataFrame, words: Sequence[str], keys: Sequence[str], order: Sequence[str], column: str = "comment_txt", separator: str = ",") -> DataFrame:
    """First comment per key, moderated."""
    once = first_per_key(comments, keys, [F.col(c) for c in order])
    return moderate(once, words, column, separator)
