"""The yearly aggregate per county and property kind, kept up by differences as certificates arrive.

A certificate counts under the latest kind of its property and under every location of its postcode. A
batch can therefore move rows that came long before it: a property's newer certificate changes the kind
that all its years count under, and a postcode's second location repeats all its certificates. Each batch
takes back what the rows concerned counted for, and adds what they and its own count for now.

The state are logs of small rows, one folder a batch and log: certificates summed per property, postcode
and year; latest kinds; locations; and the differences. A batch is visible by one commit, with all four.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart.functions.numbers import mean_of, rounded
from joulemart.operators.latest import latest_per_key
from joulemart.plans.marts import LOCATION, year_start
from joulemart.session import sent_if_few, written
from joulemart.sources.versions import Versions
from joulemart.streaming.incremental import ORDER

KIND = ["property_type", "tenure", "construction_age_band"]
_CELL = ["county", *KIND, "inspection_year"]
_SUMS = ["n", "rating_sum", "rating_n", "co2_sum", "co2_n"]
_ROW = ["uprn", "postcode", "inspection_year"]
#: Logs by property are kept in so many buckets, so that a batch reads those of its properties.
BUCKETS = 64
#: Up to so many keys of a batch are sent to every task.
BROADCAST_KEYS = 500_000


def _bucket():
    return F.pmod(F.xxhash64("uprn"), F.lit(BUCKETS)).cast("int")


def _merged(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class AggregateState:
    """The logs below a root, as of one version."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.tables = spark, Versions(spark, root)
        self._view = self.tables.pin()

    def batches(self) -> set[int]:
        return {int(name.split("/")[0]) for name in self._view.tables()}

    def log(self, name: str, schema: str, buckets: list[int] | None = None) -> DataFrame:
        """All rows of a log; with buckets, only the folders of those are read."""
        folders = [f for key, f in self._view.tables().items() if key.endswith(f"/{name}")]
        parts = [self.spark.read.schema(schema).parquet(f"{self.tables.root}/{f}") for f in folders]
        if not parts:
            return self.spark.createDataFrame([], schema)
        rows = _merged(*parts)
        return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))


def _schemas(rows: DataFrame) -> dict[str, str]:
    """Columns of the logs, of the types that staged rows have."""
    kinds = dict(rows.dtypes)
    typed = lambda names: ", ".join(f"{c} {kinds[c]}" for c in names)
    sums = "n bigint, rating_sum bigint, rating_n bigint, co2_sum decimal(38,2), co2_n bigint"
    return {
        "sums": f"{typed(['uprn', 'postcode'])}, inspection_year timestamp_ntz, {sums}, bucket int",
        "kinds": f"{typed(['uprn', *KIND, *ORDER])}, bucket int",
        "places": typed(LOCATION),
        "differences": f"county {kinds['county']}, {typed(KIND)}, inspection_year timestamp_ntz, {sums}",
    }


def _totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])


def _counted(rows: DataFrame, kinds: DataFrame, places: DataFrame, sign: int) -> DataFrame:
    """What summed rows count for in every cell, times the sign."""
    known = rows.join(kinds.select("uprn", *KIND), "uprn", "left").join(places.select("postcode", "county"), "postcode", "left")
    signed = known.select(*_CELL, *[(F.col(c) * sign).alias(c) for c in _SUMS])
    return _totals(signed, _CELL)


def _of_keys(rows: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    return rows.join(sent_if_few(keys.select(key).distinct(), BROADCAST_KEYS), key, how)


def merge_aggregates(batch: DataFrame, batch_id: int, root: str) -> None:
    """Count one batch of staged certificates; a batch that was committed already changes nothing."""
    spark = batch.sparkSession
    state = AggregateState(spark, root)
    if batch_id in state.batches():
        return
    columns = list(dict.fromkeys(["certificate_id", "uprn", *LOCATION, *KIND, *ORDER, "energy_efficiency_current", "co2_emissions_current_tonnes_per_year"]))
    rows = written(batch.select(*columns), "batch")
    schemas = _schemas(rows)

    counted = rows.filter(F.col("certificate_id").isNotNull()).withColumn("inspection_year", year_start(F.col("inspection_at")))
    co2 = F.col("co2_emissions_current_tonnes_per_year")
    sums = counted.groupBy(*_ROW).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("energy_efficiency_current").cast("bigint"), F.lit(0)).alias("rating_sum"),
        F.count("energy_efficiency_current").alias("rating_n"),
        F.coalesce(F.sum(co2), F.lit(0)).cast("decimal(38,2)").alias("co2_sum"), F.count(co2).alias("co2_n"),
    )
    sums = written(sums.withColumn("bucket", _bucket()), "batch-sums")
    latest = written(latest_per_key(rows, "uprn", ORDER, [*KIND, *ORDER]).withColumn("bucket", _bucket()), "batch-kinds")
    tuples = rows.filter(F.col("postcode").isNotNull()).select(*LOCATION).distinct()

    held_places = state.log("places", schemas["places"])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LOCATION])
    near = _of_keys(held_places, tuples, "postcode").withColumnsRenamed({c: f"_{c}" for c in LOCATION})
    new_places = written(tuples.join(near, same, "left_anti"), "batch-places")

    # Kinds that this batch changes; a late certificate changes none.
    buckets = [r.bucket for r in latest.select("bucket").distinct().collect()]  # at most BUCKETS
    kinds_log = state.log("kinds", schemas["kinds"], buckets)
    held_kinds = latest_per_key(_of_keys(kinds_log, latest, "uprn"), "uprn", ORDER, [*KIND, *ORDER])
    before = held_kinds.select("uprn", F.struct(*KIND).alias("old"), F.struct(*ORDER).alias("old_order"))
    moved = latest.join(before, "uprn").filter((F.struct(*ORDER) > F.col("old_order")) & ~F.struct(*KIND).eqNullSafe(F.col("old")))
    moved = written(moved.select("uprn", "bucket"), "moved")
    repeated = written(_of_keys(new_places, held_places, "postcode").select("postcode").distinct(), "repeated")

    # Earlier rows of those properties and postcodes.
    moved_buckets = [r.bucket for r in moved.select("bucket").distinct().collect()]
    concerned = _of_keys(state.log("sums", schemas["sums"], moved_buckets), moved, "uprn")
    if repeated.limit(1).count():
        by_place = _of_keys(state.log("sums", schemas["sums"]), repeated, "postcode")
        keys = moved.select(F.col("uprn").alias("_moved"))
        concerned = concerned.unionByName(by_place.join(sent_if_few(keys, BROADCAST_KEYS), F.col("uprn") == F.col("_moved"), "left_anti"))
    concerned = written(_totals(concerned, _ROW), "concerned")

    both = written(_merged(concerned.select("uprn", "postcode"), sums.select("uprn", "postcode")).distinct(), "keys")
    old_kinds = latest_per_key(_of_keys(state.log("kinds", schemas["kinds"]), both, "uprn"), "uprn", ORDER, [*KIND, *ORDER])
    old_kinds = written(old_kinds, "old-kinds")
    new_kinds = latest_per_key(_merged(old_kinds, latest.drop("bucket")), "uprn", ORDER, KIND)
    old_places = written(_of_keys(held_places, both, "postcode"), "old-places")
    taken = _counted(concerned, old_kinds, old_places, -1)
    added = _counted(_totals(_merged(concerned, sums.drop("bucket")), _ROW), new_kinds, _merged(old_places, new_places), 1)
    differences = _totals(_merged(taken, added), _CELL).filter(" or ".join(f"{c} <> 0" for c in _SUMS))

    folders = {}
    for name, part in (("sums", sums), ("kinds", latest), ("places", new_places), ("differences", differences)):
        folder = state.tables.new_folder(f"{batch_id}/{name}")
        writer = part.write.partitionBy("bucket") if "bucket" in part.columns else part.write
        writer.parquet(f"{root}/{folder}")
        folders[f"{batch_id}/{name}"] = folder
    state.tables.commit(folders)


def merge_available_aggregates(staged: DataFrame, root: str, checkpoint: str) -> None:
    """Count every staged certificate that has arrived, then stop."""
    query = (
        staged.writeStream.foreachBatch(lambda batch, batch_id: merge_aggregates(batch, batch_id, root))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_aggregates(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """The aggregate as ``marts.fct_property_aggregations`` builds it, from the differences alone.

    ``like`` are staged rows, of which only the types count.
    """
    cells = _totals(AggregateState(spark, root).log("differences", _schemas(like)["differences"]), _CELL).filter("n <> 0")
    return cells.select(
        *_CELL, F.col("n").alias("certificate_count"), rounded(mean_of(F.col("rating_sum"), F.col("rating_n")), 2).alias("avg_energy_efficiency"),
        F.when(F.col("co2_n") > 0, F.col("co2_sum")).cast("decimal(38,2)").alias("total_co2_emissions"),
    )
