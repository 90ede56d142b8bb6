"""The batch pipeline over files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_on_new(spark: SparkSession, source: str, schema: str, plan: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str):
    """Applies plan to each batch of new Parquet files and appends its result; returns the query."""

    def step(batch: DataFrame, number: int) -> None:
        plan(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")  # a repeated batch replaces itself

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
