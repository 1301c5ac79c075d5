"""A stored table played as a stream in several ordered micro-batches.

Every slice is one run of the same query over the same checkpoint: its rows are
added to the input folder, then the query takes all new files and ends.  So the
order of micro-batches does not hang on file times, watermarks and state move on
between slices, and each slice but the first is a restart.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from saltmarsh.streaming.inputs import table_files


def replay(df: DataFrame, folder: str, at: str, bounds: Sequence[object], start: Callable[[DataFrame, int], StreamingQuery]) -> list[dict]:
    """Play ``df`` in slices ``at < bounds[0]``, ``bounds[0] <= at < bounds[1]``, ..., ``at >= bounds[-1]``.

    ``start`` gets the stream and the number of the slice and starts the query.
    Returns per slice the last progress that read rows, as Spark reports it.
    A null in ``at`` belongs to the first slice.
    """
    spark, found = df.sparkSession, []
    for n in range(len(bounds) + 1):
        inside: Column = F.lit(True)
        if n:
            inside = inside & (F.col(at) >= F.lit(bounds[n - 1]))
        if n < len(bounds):
            below = F.col(at) < F.lit(bounds[n])
            inside = inside & (below if n else below | F.col(at).isNull())
        df.filter(inside).write.mode("overwrite").parquet(f"{folder}/input/slice-{n:05d}")
        handle = start(table_files(spark, f"{folder}/input/slice-*", df.schema), n)
        handle.awaitTermination()
        reports = [json.loads(p.json) for p in handle.recentProgress]
        found.append(next((p for p in reversed(reports) if p["numInputRows"]), {}))
    return found


def watermark_before(df: DataFrame, ts: str, at: str, bound: object, delay: str) -> object:
    """The watermark that a slice starting at ``bound`` works with: the greatest time of all earlier slices less the delay."""
    top = F.max(F.col(ts)) - F.expr(f"INTERVAL {delay}")
    return df.filter(F.col(at) < F.lit(bound)).agg(F.date_trunc("millisecond", top).alias("w")).first()["w"]
