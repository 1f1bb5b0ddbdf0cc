"""Incremental resolution: each micro-batch of pool records is matched against the S1 table by keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def resolve_stream(records: DataFrame, resolve: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Run ``resolve`` on every micro-batch of a streaming table of records and write its result under ``path``.

    A batch is written to a folder of its number, so one that is run again after a failure replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        resolve(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
