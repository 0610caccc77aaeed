"""CSV records of large files with line breaks inside quotes, read by many tasks.

Spark splits a text file at line ends, wherever those stand. Whether a block of a file begins inside
quotes depends on all blocks before it, but a block only has two possible effects: where it ends if it
begins outside, and where if it begins inside. So every block is read once for both, the effects are
chained along the file (one row a block), and a second pass cuts each block into records. What is left
at a block's ends is joined with its neighbours'.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from joulemart.session import new_work_dir

#: Up to so many blocks, their states are sent to every task.
BROADCAST_BLOCKS = 100_000
_RECORD, _HEADER, _OPEN, _INSIDE, _CLOSE = range(5)


def ends_quoted(line: str, quoted: bool) -> bool:
    """Whether a quoted field is open after a line that begins outside quotes, or inside.

    A quote opens a field only as its first character; inside, two quotes stand for one.
    """
    at = 0
    while True:
        if not quoted and line.startswith('"', at):
            quoted, at = True, at + 1
        while quoted:
            at = line.find('"', at) + 1
            if not at:
                return True
            if line.startswith('"', at):
                at += 1
            else:
                quoted = False
        at = line.find(",", at) + 1
        if not at:
            return False


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, start, line) in file order within each block; a line keeps its carriage return."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _effects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path, start, outside, inside): of each block, whether it ends in quotes if it begins outside or inside."""
    block, state = None, (False, True)
    for batch in batches:
        out = []
        for path, start, line in zip(batch["path"], batch["start"], batch["line"]):
            if (path, start) != block:
                if block is not None:
                    out.append((*block, *state))
                block, state = (path, start), (False, True)
            if '"' in line:
                state = tuple(ends_quoted(line, quoted) for quoted in state)
        if out:
            yield pd.DataFrame(out, columns=["path", "start", "outside", "inside"])
    if block is not None:
        yield pd.DataFrame([(*block, *state)], columns=["path", "start", "outside", "inside"])


def block_states(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, start, quoted): whether a block begins inside quotes; one row a block, written.

    A block's effect is to set the state to open or closed, to keep it, or to turn it. What a block begins
    with is what the last setting block before it left, turned as often as blocks between them turn it.
    """
    effects = _lines(spark, paths).mapInPandas(_effects, "path string, start long, outside boolean, inside boolean")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("outside") & ~F.col("inside")
    sets = F.col("outside") == F.col("inside")
    marked = effects.select(
        "path", "start", F.coalesce(F.sum(turns.cast("long")).over(before), F.lit(0)).alias("turned"),
        F.max(F.when(sets, F.struct("start", "outside"))).over(before).alias("set"), turns.alias("turns"), sets.alias("sets"),
    )
    upto = marked.withColumn("set_turned", F.max(F.when(F.col("sets"), F.struct("start", "turned"))).over(before)["turned"])
    open_ = F.coalesce(F.col("set.outside"), F.lit(False)).cast("long") + F.col("turned") - F.coalesce("set_turned", F.lit(0))
    folder = new_work_dir(spark, "blocks")
    upto.select("path", "start", (open_ % 2 == 1).alias("quoted")).write.parquet(folder)
    return spark.read.parquet(folder)


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path, start, kind, text): whole records of each block, and what is left at its ends."""
    block, quoted, held, whole = None, False, [], False

    def left() -> list[tuple]:
        """What the block that ends leaves: the begin of a record, or lines inside one."""
        return [(*block, _OPEN if whole else _INSIDE, "\n".join(held))] if held else []

    for batch in batches:
        out = []
        for path, start, line, begins in zip(batch["path"], batch["start"], batch["line"], batch["quoted"]):
            if (path, start) != block:
                out += left()
                block, quoted, held, whole = (path, start), begins, [], not begins
            held.append(line)
            if '"' in line:
                quoted = ends_quoted(line, quoted)
            if not quoted:
                out.append((*block, _RECORD if whole else _CLOSE, "\n".join(held)))
                held, whole = [], True
        if out:
            yield pd.DataFrame(out, columns=["path", "start", "kind", "text"])
    if block is not None and left():
        yield pd.DataFrame(left(), columns=["path", "start", "kind", "text"])


def csv_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, record) of all records but each file's first, its header.

    Equal to reading every file whole, for files whose records end with a line feed. Where a record ends
    with a carriage return before it, so do the lines inside its quotes, and they lose theirs too, as
    they do when Spark reads the file whole. A record is held by one task, and so is a block; a file is not. Empty lines outside
    quotes are no records.
    """
    states = block_states(spark, paths)
    few = states.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS
    numbered = _lines(spark, paths).withColumn("row", F.monotonically_increasing_id())
    lines = numbered.join(F.broadcast(states) if few else states, ["path", "start"])
    if not few:
        lines = lines.repartition("path", "start").sortWithinPartitions("path", "start", "row")
    folder = new_work_dir(spark, "pieces")
    pieces = lines.select("path", "start", "line", "quoted").mapInPandas(_cut, "path string, start long, kind int, text string")
    # The first record of a file is its header, whole or begun in the first block.
    pieces.withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    pieces = spark.read.parquet(folder)
    whole = pieces.filter(F.col("kind") == _RECORD)
    first = pieces.filter("start = 0").groupBy("path").agg(F.min("row").alias("row"))
    whole = whole.join(first.select(F.col("row").alias("header_row"), F.col("path").alias("of")), (F.col("path") == F.col("of")) & (F.col("row") == F.col("header_row")), "left_anti")
    # At most two pieces a block: the end of a record and the begin of another, or lines inside of one.
    ends = pieces.filter(F.col("kind") != _RECORD)
    order = Window.partitionBy("path").orderBy("start", "row")
    number = F.sum((F.col("kind") == _OPEN).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    joined = ends.join(first.withColumnRenamed("row", "first_row"), "path").withColumn("number", number).groupBy("path", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "row", "text"))), lambda p: p["text"]), "\n").alias("text"),
        F.min("row").alias("row"), F.min("first_row").alias("first_row"),
    )
    joined = joined.filter("row <> first_row")
    records = whole.select("path", "text").union(joined.select("path", "text"))
    text = F.when(F.col("text").endswith("\r"), F.replace(F.expr("left(text, length(text) - 1)"), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("text"))
    return records.select("path", text.alias("record")).filter("record <> ''")
