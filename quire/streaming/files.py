"""Parsed files as a stream: every micro-batch is packed and appended; documents are independent of each other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quire.options import Options
from quire.plans.pipeline import Packed, pack


def packed_stream(spark: SparkSession, source: str, schema, sink: Callable[[Packed, int], None], checkpoint: str, opts: Options = Options(), files_per_batch: int = 64) -> StreamingQuery:
    """Pack parquet files as they arrive in `source`; `sink` gets each batch's result and its number.

    A batch that is run again gets the same number, so a sink that overwrites by number is exactly-once.
    """

    def batch(df: DataFrame, number: int) -> None:
        if not df.isEmpty():
            sink(pack(df, opts=opts), number)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
