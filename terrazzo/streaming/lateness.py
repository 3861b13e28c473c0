"""Event time in `foreachBatch`: a watermark that survives restarts, and the messages that come behind it.

Spark's own watermark drops late rows in silence. Here the greatest event time of all earlier batches is kept beside the side
table, and a batch is cut in two by it: a batch that is run again is cut at the same place, for it reads what the batches before it left.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.sources import store
from terrazzo.streaming.changes import writer_of

#: marks of earlier batches that stay, for a batch that is run again
KEPT = 3


def _marks(path: str, writer: str) -> str:
    return f"{path}/_watermarks/{writer}"


def greatest(spark: SparkSession, path: str, batch: int) -> int | None:
    """The greatest event time, in microseconds, of the batches before `batch` of the stream that is running; None before the first."""
    folder = _marks(path, writer_of(spark))
    earlier = [int(n) for n in store.names(spark, folder) if n.isdigit() and int(n) < batch]
    return int(store.get_text(spark, f"{folder}/{max(earlier)}")) if earlier else None


def is_late(event_time: Column, mark: int | None, delay: dt.timedelta) -> Column:
    """The event lies more than `delay` behind the mark. An event without a time is never late, nor any before there is a mark."""
    if mark is None:
        return F.lit(False)
    return F.coalesce(F.unix_micros(event_time) < F.lit(mark - delay // dt.timedelta(microseconds=1)), F.lit(False))


def advance(rows: DataFrame, event_time: Column, path: str, batch: int, mark: int | None) -> int | None:
    """Keep the greatest event time up to and with this batch, for the batches that follow."""
    spark = rows.sparkSession
    top = rows.agg(F.max(F.unix_micros(event_time)).alias("top")).first()["top"]
    known = [x for x in (mark, top) if x is not None]
    if not known:
        return None
    folder = _marks(path, writer_of(spark))
    store.put_text(spark, f"{folder}/{batch}", str(max(known)), replace=True)
    for name in store.names(spark, folder):
        if name.isdigit() and int(name) < batch - KEPT:
            store.remove(spark, f"{folder}/{name}")
    return max(known)


def write_late(rows: DataFrame, path: str, batch: int) -> None:
    """The late messages of a batch to the side table; a batch that is run again replaces its own."""
    rows.write.mode("overwrite").parquet(f"{path}/writer={writer_of(rows.sparkSession)}/batch={batch}")
