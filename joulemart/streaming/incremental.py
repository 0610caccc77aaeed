"""Latest state per property, kept up as certificates arrive.

Each micro-batch is reduced to its latest row per property and written as its
own partition of a log. "Latest" is a maximum, so the state is the maximum over
the log: the order of batches does not matter, a late row with an older date
cannot overwrite newer state, and a batch that runs again replaces its own
partition. No batch reads or rewrites the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from joulemart.operators.latest import latest_per_key
from joulemart.plans.marts import PROPERTY_STATE

ORDER = ["inspection_at", "lodgement_at", "certificate_id"]
_STATE = [*PROPERTY_STATE, *ORDER]


def merge_batch(batch: DataFrame, batch_id: int, log: str) -> None:
    latest = latest_per_key(batch, "uprn", ORDER, _STATE)
    latest.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")


def merge_available(staged: DataFrame, log: str, checkpoint: str) -> None:
    """Merge every staged certificate that has arrived, then stop."""
    query = (
        staged.writeStream.foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, log))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_state(spark: SparkSession, log: str) -> DataFrame:
    """The current state: one row per property."""
    return latest_per_key(spark.read.parquet(log), "uprn", ORDER, PROPERTY_STATE)


def compact(spark: SparkSession, log: str, compacted: str) -> None:
    """Write the state as the first batch of a new, shorter log."""
    state = latest_per_key(spark.read.parquet(log), "uprn", ORDER, _STATE)
    state.write.mode("overwrite").parquet(f"{compacted}/batch_id=-1")
