"""Files that keep arriving, appended to a table exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart.sources.csv_landing import CSV_FILES, CSV_OPTIONS, LINEAGE, read_csv_by_name, text_schema
from joulemart.sources.versions import Versions


def csv_stream(
    spark: SparkSession, landing: str, columns: list[str], files_per_batch: int = 1000, multi_line: bool = True
) -> DataFrame:
    """New CSV files below ``landing`` as text rows with their file name.

    A file whose header differs from ``columns`` stops the stream instead of
    being read by position. Line breaks inside quotes are kept, as the batch reader does.
    """
    return (
        spark.readStream.options(**CSV_OPTIONS)
        .option("multiLine", multi_line)
        .option("enforceSchema", "false")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", CSV_FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .schema(text_schema(columns))
        .csv(landing)
        .withColumn(LINEAGE, F.col("_metadata.file_path"))
    )


def append_available(rows: DataFrame, table: str, checkpoint: str) -> None:
    """Append everything that has arrived since the last run, then stop.

    The checkpoint remembers which files are done, and the file sink's log
    makes each batch visible once, also after a failed run.
    """
    query = (
        rows.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def land_batch(files: DataFrame, batch_id: int, table: str) -> None:
    """Land the files of one batch, whatever their headers, as one version of the table.

    Their rows are aligned by column name among themselves; columns that the table does not have yet are
    added to it. The batch's number is its name in the table: a batch that runs again replaces itself.
    """
    spark = files.sparkSession
    paths = [r.path for r in files.select("path").collect()]  # at most the files of a batch
    tables = Versions(spark, table)
    try:
        rows = read_csv_by_name(spark, paths) if paths else None
    except FileNotFoundError:  # empty files, without even a header
        rows = None
    if rows is None:
        return
    folder = tables.new_folder(f"batch-{batch_id}")
    rows.write.parquet(f"{table}/{folder}")
    tables.commit({f"batch-{batch_id}": folder}, rows.columns)


def land_available(spark: SparkSession, landing: str, table: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Land every CSV file that has arrived since the last run, then stop.

    The stream is over files, not rows, so a changed header does not stop it; the checkpoint remembers
    which files are done, and a batch that ran but was not noted lands once more under the same name.
    """
    arrived = (
        spark.readStream.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", CSV_FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .schema("path string, modificationTime timestamp, length long, content binary")
        .load(landing)
        .select("path")
    )
    query = (
        arrived.writeStream.foreachBatch(lambda files, batch_id: land_batch(files, batch_id, table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_landed(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """All landed rows as of a version (the last one); columns that a batch lacked are NULL in its rows."""
    view = Versions(spark, table, version).pin()
    names = view.columns()
    ordered = [c for c in names if c != LINEAGE] + [c for c in names if c == LINEAGE]
    paths = [f"{table}/{folder}" for folder in view.tables().values()]
    schema = text_schema(ordered)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
