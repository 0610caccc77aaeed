"""All-text CSV landing: align files by column name, keep their lineage."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joulemart.session import new_work_dir
from joulemart.sources.csv_blocks import csv_records

# RFC 4180 quoting: doubled quotes inside quoted fields.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}
LINEAGE = "filename"
#: Files that are CSV by name, in either case, compressed or not; batches and streams read the same.
CSV_FILES = "*.[cC][sS][vV]{,.*}"
#: A file with line breaks in quotes is read by one task up to this size, larger ones by blocks.
WHOLE_FILE_BYTES = 128 << 20
#: Up to so many files, the table of file headers is sent to every task.
BROADCAST_FILES = 100_000
#: The columns of the table of file headers.
HEADERS = "path string, header array<string>"


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _first_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first CSV record of every file in a run of (path, line) rows.

    A record goes on while a quote is open. Lines of one file come in order and together.
    """
    path, lines = None, None
    for batch in batches:
        paths, headers = [], []
        for name, line in zip(batch["path"], batch["line"]):
            if name != path:
                path, lines = name, []
            if lines is None:
                continue
            lines.append(line)
            if sum(x.count('"') for x in lines) % 2 == 0:
                record = "\n".join(lines).removeprefix("\ufeff")
                paths.append(path)
                headers.append(next(csv.reader(io.StringIO(record, newline="")), []))
                lines = None
        if paths:
            yield pd.DataFrame({"path": paths, "header": headers})


def file_headers(spark: SparkSession, path: str | list[str], files: str = CSV_FILES) -> DataFrame:
    """(path, header) of every file below ``path`` that is not empty, read by Spark's own file access."""
    lines = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", files).text(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"), "_metadata.file_block_start")
        .filter("file_block_start = 0").select("path", "line")
    )
    return lines.mapInPandas(_first_records, HEADERS)


def read_csv_by_name(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, files: str = CSV_FILES, whole_file_bytes: int | None = None
) -> DataFrame:
    """All CSV files below ``path`` as text columns plus ``filename``.

    ``path`` may be a glob, or several; ``files`` is one over file names. Spark's reader aligns files by position, so rows are read by position once, meet the
    header of their file, and take each column from where that header has it; a column a file lacks
    is NULL. Only the distinct headers reach the driver. ``multi_line`` keeps line breaks inside
    quotes: files up to ``whole_file_bytes`` (WHOLE_FILE_BYTES) are read by one task each, larger ones by
    blocks (see csv_blocks). Turn it off for files without them, and Spark's reader splits them by itself.
    """
    folder = new_work_dir(spark, "headers")
    file_headers(spark, path, files).write.parquet(folder)
    headers = spark.read.schema(HEADERS).parquet(folder)
    files_of = {tuple(r.header): r.n for r in headers.groupBy("header").agg(F.count("*").alias("n")).collect()}
    distinct = list(files_of)
    if not distinct:
        raise FileNotFoundError(f"no CSV files below {path}")
    distinct.sort()
    places = [f"_c{i}" for i in range(max(map(len, distinct)))]
    limit = WHOLE_FILE_BYTES if whole_file_bytes is None else whole_file_bytes
    rows = _by_position(spark, path, files, places, multi_line, limit)
    few = sum(files_of.values()) <= BROADCAST_FILES
    known = headers.withColumnRenamed("path", LINEAGE)
    rows = rows.join(F.broadcast(known) if few else known, LINEAGE)
    names = list(dict.fromkeys(n for header in distinct for n in header))

    def column(name: str):
        having = [(h, h.index(name)) for h in distinct if name in h]
        if len(having) == len(distinct) and len({i for _, i in having}) == 1:
            return F.col(places[having[0][1]]).alias(name)
        cases = reduce(
            lambda chain, case: chain.when(F.col("_header") == case[0], F.col(places[case[1]])),
            [(distinct.index(h), i) for h, i in having], F,
        )
        return cases.alias(name)

    numbered = F.array_position(F.array(*[F.array(*map(F.lit, h)) for h in distinct]), F.col("header")) - 1
    rows = rows.withColumn("_header", numbered)
    return rows.select(*[column(n) for n in names], LINEAGE)


def _by_position(
    spark: SparkSession, path: str | list[str], files: str, places: list[str], multi_line: bool, whole_file_bytes: int
) -> DataFrame:
    """All rows but headers, as columns by position and the name of the file."""
    schema = text_schema(places)
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).schema(schema)

    def whole(paths: str | list[str]) -> DataFrame:
        found = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", files).csv(paths)
        return found.select("*", F.col("_metadata.file_path").alias(LINEAGE))

    if not multi_line:
        return whole(path)
    # Listed, not read. Compressed files cannot be cut.
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", files).load(path).select("path", "length")
    is_large = (F.col("length") > whole_file_bytes) & F.lower("path").endswith(".csv")
    large = [r.path for r in sizes.filter(is_large).collect()]
    if not large:
        return whole(path)
    records = csv_records(spark, large)
    ddl = ", ".join(f"{p} string" for p in places)
    parsed = F.from_csv("record", ddl, {**CSV_OPTIONS, "header": "false", "multiLine": "true"})
    rows = records.select(parsed.alias("row"), F.col("path").alias(LINEAGE)).select("row.*", LINEAGE)
    small = [r.path for r in sizes.filter(~is_large).collect()]
    return rows.union(whole(small)) if small else rows


def append_chunk(chunk: DataFrame, path: str, first: bool) -> None:
    """Land one chunk: the first replaces the table, later ones add to it."""
    chunk.write.mode("overwrite" if first else "append").parquet(path)


def write_csv_folders(rows: DataFrame, path: str, folder: str, files: int = 2) -> None:
    """Write rows as CSV files, one folder per value of the ``folder`` column, with up to so many files in each.

    Otherwise every task would leave a file in every folder, and what reads a few files at a time would take the longer the more tasks wrote.
    """
    dealt = rows.repartition(folder, F.pmod(F.xxhash64(*rows.columns), F.lit(files)))
    dealt.write.mode("overwrite").options(**CSV_OPTIONS).partitionBy(folder).csv(path)
