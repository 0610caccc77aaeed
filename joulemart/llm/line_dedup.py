"""Lines that several documents share, kept in one of them only, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joulemart.llm.components import written

#: What is stripped from both ends of a line: space and the control characters from tab to carriage return.
BLANK = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to so many shared lines (of 24 bytes) are sent to every task; with more, they are joined by a shuffle.
BROADCAST_LINES = 100_000


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case and every other character as it is."""
    return _lowered(F.btrim(line, F.lit(BLANK)))


def _lowered(bare: Column) -> Column:
    is_ascii = F.octet_length(bare) == F.char_length(bare)
    return F.when(is_ascii, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _hashes(value: Column) -> list[Column]:
    """128 bits of a value, as two numbers."""
    return [F.xxhash64(value), F.xxhash64(F.lit(1), value)]


def _documents(docs: DataFrame, key: str) -> DataFrame:
    """doc, its text's hash (rows of one key may have different texts) and its lines."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    t1, t2 = _hashes(F.col("text"))
    return docs.select(F.col(key).alias("doc"), text.alias("text")).select("doc", t1.alias("t1"), t2.alias("t2"), F.split("text", "\n").alias("lines"))


def _keyed_lines(documents: DataFrame, least_chars: int) -> DataFrame:
    """One row a line of which the key is long enough, with its place and the key's hash."""
    # An outer explode, as Spark would split all texts once more to look for empty arrays.
    lines = documents.select("doc", "t1", "t2", F.posexplode_outer("lines").alias("place", "line"))
    bare = lines.filter(F.char_length("line") >= least_chars).withColumn("line", F.btrim("line", F.lit(BLANK)))
    h1, h2 = _hashes(_lowered(F.col("line")))
    return bare.filter(F.char_length("line") >= least_chars).select("doc", "t1", "t2", "place", h1.alias("h1"), h2.alias("h2"))


def shared_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, key: str = "doc_id") -> DataFrame:
    """(h1, h2, n_docs, keeper): hashes of the line keys found in least_docs documents or more, and the largest doc."""
    pairs = _keyed_lines(_documents(docs, key), least_chars).select("h1", "h2", "doc").distinct()
    counted = pairs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper"))
    return counted.filter(F.col("n_docs") >= least_docs)


def drop_shared_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, key: str = "doc_id") -> DataFrame:
    """Drop lines that many documents share from all of them but the one with the largest key.

    Gives key, n_lines (long, before dropping), n_dropped (long) and kept (string: the lines left, in
    their order, joined by line feeds), one row a row of docs; other columns are left out. A line's key is
    the line without white space (space, tab to carriage return) at its ends and with A-Z in lower case.
    Keys of at least least_chars code points that are found in at least least_docs documents lose all
    their lines, repeated ones too, except in the document with the largest key; there all stay.

    Rows with one doc_id are one document, however often it is there; rows without doc_id are one document
    too, smaller than all others. A null or empty text is one empty line, and so has no key. Keys are told
    apart by 128 bits of hash. An empty table gives no rows.

    Only hashes are shuffled to find the lines; each text is shuffled once, to meet the places of its lines to
    drop. A line that all documents hold is one row a document when its documents are counted, and one row a
    task when the hashes are; joined back, its documents are split by adaptive execution.
    """
    documents = _documents(docs, key)
    shared = written(shared_lines(docs, least_chars, least_docs, key).select("h1", "h2", "keeper"), "shared-lines")
    few = shared.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES
    found = _keyed_lines(documents, least_chars).join(F.broadcast(shared) if few else shared, ["h1", "h2"])
    dropped = found.filter(~F.col("doc").eqNullSafe(F.col("keeper")))
    places = dropped.groupBy(F.col("doc").alias("of"), F.col("t1").alias("of1"), F.col("t2").alias("of2"))
    # Equal rows name their places several times.
    places = places.agg(F.collect_set("place").alias("gone"))
    same = F.col("doc").eqNullSafe(F.col("of")) & (F.col("t1") == F.col("of1")) & (F.col("t2") == F.col("of2"))
    judged = documents.join(places, same, "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda place: F.get("lines", place)))
    return judged.select(
        F.col("doc").alias(key),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
    )
