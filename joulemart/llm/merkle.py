"""Hash trees over the rows of groups, with proofs, built from levels kept as one string a block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joulemart.llm.components import written
from joulemart.llm.places import numbered

#: Nodes that are hashed together.
ARITY = 3
#: Levels within a block: 729 leaves, of which the lowest level is 46 kB.
BLOCK_LEVELS = 6
_BLOCK = ARITY**BLOCK_LEVELS
_DIGEST = 64  # characters
_POWERS = ", ".join(str(ARITY**j) for j in range(BLOCK_LEVELS))

_STEPS = f"size(filter(array({_POWERS}), p -> p < total))"
#: All levels of a block, lowest first; a level is the hex text of its digests, one after the other.
_LEVELS = f"""aggregate(sequence(1, steps + 1), array(cast(lowest as binary)), (levels, j) -> if(j > steps, levels, concat(levels, array(cast(array_join(
    transform(sequence(0, (octet_length(element_at(levels, -1)) - 1) div {ARITY * _DIGEST}),
        run -> sha2(substring(element_at(levels, -1), cast(run * {ARITY * _DIGEST} + 1 as int), {ARITY * _DIGEST}), 256)), '') as binary)))))"""
#: What stands before and after the i-th leaf's node in its run, on every level of the block.
_PATH = f"""transform(slice(array({_POWERS}), 1, steps), (p, j) -> struct(
    cast(substring(levels[j], cast({ARITY * _DIGEST} * (i div (p * {ARITY})) + 1 as int), cast({_DIGEST} * (i div p % {ARITY}) as int)) as string) as before,
    cast(substring(levels[j], cast({_DIGEST} * (i div p + 1) + 1 as int), cast({_DIGEST} * ({ARITY - 1} - i div p % {ARITY}) as int)) as string) as after))"""
_NO_PATH = "cast(array() as array<struct<before: string, after: string>>)"


def field(value: Column) -> Column:
    """A value for hashing: - if it is null, else the number of its UTF-8 bytes, a colon, and its text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """The digest of a row: lowercase hex SHA-256 of its fields."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def siblings(path: Column) -> Column:
    """All siblings on a path, lowest level first, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of nodes (group_, place, total, digest, rest), of their tops, and so on; and each group's top."""
    rounds = []
    while (nodes.agg(F.max("total")).first()[0] or 0) > 1:
        member = F.struct("place", "digest", "rest")
        blocks = nodes.groupBy("group_", F.expr(f"place div {_BLOCK}").alias("block")).agg(
            F.array_sort(F.collect_list(member)).alias("members"), F.first("total").alias("total")
        )
        blocks = blocks.withColumn("steps", F.expr(_STEPS)).withColumn("lowest", F.array_join("members.digest", ""))
        rounds.append(written(blocks.withColumn("levels", F.expr(_LEVELS)).drop("lowest"), "hash-blocks"))
        nodes = rounds[-1].select(
            "group_", F.col("block").alias("place"), F.expr(f"(total + {_BLOCK - 1}) div {_BLOCK}").alias("total"),
            F.element_at("levels", -1).cast("string").alias("digest"), F.lit(None).cast("string").alias("rest"),
        )
    return rounds, nodes


def _descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """From what is known of the tops (group_, place, path, ...) to the lowest nodes with whole paths and their rest."""
    known = [c for c in tops.columns if c not in ("group_", "place", "rest", "path")]
    for blocks in reversed(rounds):
        above = tops.select(F.col("group_").alias("of"), F.col("place").alias("at"), F.col("path").alias("further"), *known)
        joined = blocks.join(above, F.col("group_").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
        members = F.expr(f"inline(transform(members, (m, i) -> struct(m.place as place, m.rest as rest, {_PATH} as path)))")
        tops = joined.select("group_", "further", *known, members).select("group_", "place", "rest", F.concat("path", "further").alias("path"), *known)
    return tops


def manifest(leaves: DataFrame, group: str = "source", key: str = "doc_id", digest: str = "leaf") -> DataFrame:
    """Hash trees of all groups, and over their tops, with every row's proof.

    A group's leaves ascend by key, nulls first and ties by digest. While several nodes remain, every three
    consecutive ones (of the last run what there is, even one) become the digest of their joined hex texts;
    what remains is the group's subroot. Subroots, ordered by group (null first, by UTF-8 bytes), make the
    root in the same way. A null group is a group; equal rows are leaves of their own.

    Gives the columns of leaves with place, total (in the group), subroot, root and path: an array of what
    stands before and after the row's node in its run, level by level up to the root; see folded and
    siblings. Columns of leaves with these names are replaced. An empty table gives no rows.

    Rows are put in order without a task that holds a group, then grouped to blocks of 729 whose levels are
    strings; the blocks' tops are nodes of the next round, of which there are as many as a group's size has
    digits to base 729. What is known of the tops goes down the same way: only blocks are joined, never rows.
    """
    names = [c for c in leaves.columns if c not in ("place", "total", "subroot", "root", "path")]
    kept = leaves.select(F.col(group).alias("group_"), F.col(key).alias("key_"), F.col(digest).alias("digest"), F.struct(*names).alias("rest"))
    nodes = numbered(kept, "group_", ["key_", "digest"])
    nodes = nodes.withColumn("rest", F.struct(F.col("rest").alias("row"), "total"))
    within, subroots = _climb(nodes)
    # One row a group; they all make one tree.
    subroots = written(subroots.select("group_", "digest", "rest"), "subroots")
    ordered = numbered(subroots.withColumn("all", F.lit(0)), "all", ["group_"])
    tree = ordered.select(F.lit(0).alias("group_"), "place", "total", "digest", F.struct("group_", F.col("digest").alias("subroot"), "rest").alias("rest"))
    over, root = _climb(tree)
    root = root.select("group_", "place", "rest", F.expr(_NO_PATH).alias("path"), F.col("digest").alias("root"))
    tops = _descend(over, root).select(F.col("rest.group_").alias("group_"), F.lit(0).alias("place"), F.col("rest.rest").alias("rest"), "path", F.col("rest.subroot").alias("subroot"), "root")
    whole = _descend(within, written(tops, "subroot-paths"))
    return whole.select("rest.row.*", "place", "rest.total", "subroot", "root", "path")
