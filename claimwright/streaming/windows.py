"""Event-time windows and duplicates on streams, with state that the watermark bounds.

Each function takes a stream or a table. On a stream, rows more than ``late`` behind the latest event
time seen are dropped, and a window is given out once, when the watermark has passed its end; on a
table every window is given out and nothing is late.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions import exact_sum, mean_of_flag


def measures(flag: Column | None = None, value: Column | None = None) -> dict[str, Column]:
    """Count of rows, and where given the count and rate of ``flag`` and the exact sum of ``value``."""
    found = {"rows": F.count(F.lit(1))}
    if flag is not None:
        found |= {"flagged": F.count_if(flag), "rate": mean_of_flag(flag)}
    if value is not None:
        found["total"] = exact_sum(value)
    return found


def _watched(frame: DataFrame, time: str, late: str) -> DataFrame:
    """Rows with an event time, as the instants that watermarks need."""
    timed = frame.withColumn(time, F.col(time).cast("timestamp")).filter(F.col(time).isNotNull())
    return timed.withWatermark(time, late) if timed.isStreaming else timed


def _per_window(frame: DataFrame, window: Column, keys: Sequence[str], what: Mapping[str, Column]) -> DataFrame:
    grouped = frame.groupBy(*keys, window.alias("_window")).agg(*[c.alias(n) for n, c in what.items()])
    return grouped.select(
        *keys,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *what,
    )


def tumbling(
    frame: DataFrame, time: str, length: str, what: Mapping[str, Column], keys: Sequence[str] = (), late: str = "1 hour"
) -> DataFrame:
    """Measures per key and window of ``length``; windows follow each other and start at the epoch."""
    return _per_window(_watched(frame, time, late), F.window(time, length), keys, what)


def sliding(
    frame: DataFrame,
    time: str,
    length: str,
    step: str,
    what: Mapping[str, Column],
    keys: Sequence[str] = (),
    late: str = "1 hour",
) -> DataFrame:
    """Measures per key and window of ``length``, a new one every ``step``.

    A row is in length / step windows; rows are combined before they are shuffled.
    """
    return _per_window(_watched(frame, time, late), F.window(time, length, step), keys, what)


def sessions(
    frame: DataFrame, time: str, gap: str, what: Mapping[str, Column], keys: Sequence[str], late: str = "1 hour"
) -> DataFrame:
    """Measures per key and session: rows no further apart than ``gap``. A session ends ``gap`` after its last row."""
    if not keys:
        raise ValueError("sessions need a key")
    return _per_window(_watched(frame, time, late), F.session_window(time, gap), keys, what)


def first_within(frame: DataFrame, keys: Sequence[str], time: str, late: str) -> DataFrame:
    """The first row of each key that arrives; repeats within ``late`` of it are dropped.

    A key is forgotten when the watermark is past its first row by ``late``, so state follows the rows
    of that time and not all keys. On a table one row of each key is kept, whichever it is.
    """
    watched = _watched(frame, time, late)
    return watched.dropDuplicatesWithinWatermark(list(keys)) if watched.isStreaming else watched.dropDuplicates(list(keys))
