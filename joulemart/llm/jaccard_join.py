"""Exact Jaccard join of documents on word n-grams: prefixes in order of frequency, grouped, then verified.

1. Documents become sets of shingle hashes. Sets meet by hash range, where the documents that have each
   shingle are counted, and return to their block without the shingles that only one document has:
   such a shingle takes part in no overlap, so that it is enough to know how many there are. Shingles
   that a large share of all documents has are found by a pass before; they stay with their block, so
   that no range has to hold them.
2. Rows with the same set become one class. A class's prefix holds its rarest shingles, so many that
   linked sets share one. Classes of one size and one prefix become a group.
3. Groups that share a prefix shingle are candidates if their sizes and the shingle's places allow a
   link. First each is paired with a few neighbours in each list, in several orders, where long lists
   are dealt anew to blocks each time; then all remaining
   candidates whose members aren't yet connected, without the pairs inside the largest component of a
   list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joulemart.llm import text_hash
from joulemart.llm.components import connected_components, written
from joulemart.session import TEXT_SETTINGS, settle

#: Shingles of a hash range, on average; a task holds one range.
RANGE_SHINGLES = 2_000_000
#: Hashes are cut to so many bits once sets are made. Of two sets of 20,000, a shingle of one then
#: equals another's of the other by chance once in 700,000 pairs of sets.
HASH_BITS = 48
#: A shingle that at least one in so many rows of a chunk has is counted before all others,
CHUNK_SHARE = 64
#: and by at least so many rows of it.
CHUNK_ROWS = 8
#: What at least one in so many of all rows is found to have that way crowds its hash range,
CROWD_SHARE = 128
#: and so many such shingles, the most frequent ones, are sent to all tasks. Others go by hash range.
CROWD_SHINGLES = 4096
#: Lists longer than that are cut into blocks of about as many classes.
LIST_ROWS = 512
#: Distances of the neighbours that are tried first.
NEIGHBOURS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128)
#: Neighbours are tried so often in further orders of the lists, while that finds links.
NEIGHBOUR_ROUNDS = 2

_BLOCK_SCHEMA = "slot int, block bigint, keys binary, rows binary, low binary, high binary, n binary"
_SET_SCHEMA = "row_id bigint, n bigint, d1 bigint, d2 bigint, shared array<bigint>"


def _row(slot: int, block: int, **payloads: np.ndarray | bytes) -> dict:
    return {"slot": slot, "block": block} | {k: v if isinstance(v, bytes) else v.tobytes() for k, v in payloads.items()}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"slot": pa.int32(), "block": pa.int64()}
    names = ("slot", "block", "keys", "rows", "low", "high", "n")
    return pa.RecordBatch.from_pydict({c: pa.array([r.get(c) for r in rows], kinds.get(c, pa.binary())) for c in names})


def _digests(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each whole set, which stand for it."""
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(text_hash.mix(hashes ^ np.uint64(salt)))]) for salt in (1, 2)]
    return tuple(s[bounds[1:]] - s[bounds[:-1]] for s in sums)


def set_digests(texts: DataFrame, width: int = 5) -> DataFrame:
    """The columns of texts, but for `text` its set of shingles as similar_documents identifies it: n, d1, d2."""
    kept = [c for c in texts.columns if c != "text"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*kept).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in text_hash.text_chunks(batch):
                hashes, bounds = text_hash.shingle_sets(data, offsets, width)
                part = batch.slice(low, len(bounds) - 1)
                digests = [pa.array(d.view(np.int64)) for d in _digests(hashes, bounds)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(np.diff(bounds), pa.int64()), *digests], [*kept, "n", "d1", "d2"])

    return texts.withColumn("text", F.col("text").cast("string")).mapInArrow(run, f"{fields}, n bigint, d1 bigint, d2 bigint")


def _frequent(width: int):
    """Task: shingles that many rows of a chunk have, with their number; and, with a null hash, rows and shingles of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_hash.text_chunks(batch):
                hashes, bounds = text_hash.shingle_sets(data, offsets, width)
                rows = len(bounds) - 1
                values, counts = np.unique(hashes >> np.uint64(64 - HASH_BITS), return_counts=True)
                often = (counts >= CHUNK_ROWS) & (counts * CHUNK_SHARE >= rows)
                yield pa.RecordBatch.from_pydict({
                    "hash": pa.array([None, *values[often].tolist()], pa.int64()),
                    "rows": pa.array([rows, *counts[often].tolist()], pa.int64()),
                    "shingles": pa.array([len(hashes), *[0] * int(often.sum())], pa.int64()),
                })

    return run


def _crowding(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The shingles that crowd a hash range, ascending, with what they were counted as, and the number of shingles of all rows.

    At most CROWD_SHINGLES of them. What is counted here only decides where a shingle goes and its place in the
    order of frequency: any order that is the same for all rows finds all links.
    """
    counted = texts.mapInArrow(_frequent(width), "hash bigint, rows bigint, shingles bigint")
    counted = written(counted.groupBy("hash").agg(F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles")), "frequent")
    whole = counted.filter("hash is null").first()
    if whole is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), 0
    often = counted.filter(F.col("hash").isNotNull() & (F.col("rows") * CROWD_SHARE >= whole["rows"]))
    found = sorted(tuple(r)[:2] for r in often.orderBy(F.desc("rows"), "hash").limit(CROWD_SHINGLES).collect())
    hashes, rows = np.array(found, np.int64).reshape(-1, 2).T
    return hashes.astype(np.uint64), np.minimum(rows, (1 << 32) - 1).astype(np.uint32), whole["shingles"]


def _set_blocks(width: int, slots: int, crowding: np.ndarray):
    """Task: sets of a run of documents, cut by hash range; and a row with what is known of the documents, crowding shingles included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_id, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            for low, data, offsets in text_hash.text_chunks(batch):
                for first in range(0, len(offsets) - 1, 1 << 16):  # row numbers take two bytes
                    part = offsets[first : first + (1 << 16) + 1]
                    hashes, bounds = text_hash.shingle_sets(data[part[0] : part[-1]], part - part[0], width)
                    sizes = np.diff(bounds)
                    d1, d2 = _digests(hashes, bounds)
                    ids = batch.column(0).slice(low + first, len(sizes))
                    keys = np.concatenate([np.asarray(ids.cast(pa.int64()), np.int64), d1.view(np.int64), d2.view(np.int64)])
                    block = (part_id << 32) + count
                    hashes, rows = hashes >> np.uint64(64 - HASH_BITS), np.repeat(np.arange(len(sizes)), sizes)
                    at = np.searchsorted(crowding, hashes)
                    crowds = crowding[np.minimum(at, len(crowding) - 1)] == hashes if len(crowding) else np.zeros(len(hashes), bool)
                    head = _row(-1 - (part_id + count) % slots, block, keys=keys, n=sizes.astype("<i8"), rows=rows[crowds].astype("<u2"), high=at[crowds].astype("<u2"))
                    out = [head]
                    hashes, rows = hashes[~crowds], rows[~crowds]
                    order = np.argsort(hashes, kind="stable")
                    hashes, rows = hashes[order], rows[order]
                    cuts = np.searchsorted(hashes, [(i << HASH_BITS) // slots for i in range(1, slots)])
                    for slot, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(hashes)])):
                        if b > a:
                            h = hashes[a:b]
                            out.append(_row(slot, block, rows=rows[a:b].astype("<u2"), low=h.astype("<u4"), high=(h >> np.uint64(32)).astype("<u2")))
                    count += 1
                    yield _batch(out)

    return run


def _hashes_of(row: dict) -> np.ndarray:
    return np.frombuffer(row["low"], "<u4").astype(np.uint64) | (np.frombuffer(row["high"], "<u2").astype(np.uint64) << np.uint64(32))


def _count_range(group: pa.Table) -> pa.Table:
    """Of one hash range: the shingles that more than one row has, by block, with the number of rows."""
    rows = group.to_pylist()
    passed = [r for r in rows if r["slot"] < 0]
    rows = [r for r in rows if r["slot"] >= 0]
    out = [r | {"slot": 0} for r in passed]
    if rows:
        hashes = np.concatenate([_hashes_of(r) for r in rows])
        where = np.repeat(np.arange(len(rows), dtype=np.uint32), [len(r["rows"]) // 2 for r in rows])
        place = np.concatenate([np.frombuffer(r["rows"], "<u2") for r in rows])
        for r in rows:  # a range's payloads aren't held beside its arrays
            del r["low"], r["high"], r["rows"]
        order = np.argsort(hashes, kind="stable")
        hashes, where, place = hashes[order], where[order], place[order]
        new = np.ones(len(hashes), bool)
        np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
        sizes = np.diff(np.flatnonzero(new), append=len(hashes))
        counts = np.repeat(sizes.astype("<u4"), sizes)
        keep = counts > 1
        hashes, where, place, counts = hashes[keep], where[keep], place[keep], counts[keep]
        order = np.argsort(where, kind="stable")
        hashes, where, place, counts = hashes[order], where[order], place[order], counts[order]
        cuts = np.searchsorted(where, np.arange(len(rows) + 1))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                h = hashes[a:b]
                out.append(_row(1, rows[i]["block"], rows=place[a:b], low=h.astype("<u4"), high=(h >> np.uint64(32)).astype("<u2"), n=counts[a:b]))
    return pa.Table.from_batches([_batch(out)]) if out else pa.Table.from_batches([_batch([])])


def _assemble(crowding: np.ndarray, crowd: np.ndarray):
    """Of one block: each document with its shared shingles, rarest first."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        head = next(r for r in rows if r["slot"] == 0)
        keys = np.frombuffer(head["keys"], np.int64).reshape(3, -1)
        sizes = np.frombuffer(head["n"], "<i8")
        found = [r for r in rows if r["slot"] == 1]
        own = np.frombuffer(head["high"], "<u2")
        hashes = np.concatenate([crowding[own], *[_hashes_of(r) for r in found]])
        place = np.concatenate([np.frombuffer(r["rows"], "<u2") for r in [head, *found]])
        counts = np.concatenate([crowd[own], *[np.frombuffer(r["n"], "<u4") for r in found]])
        order = np.lexsort((hashes, counts, place))
        hashes, place = hashes[order], place[order]
        bounds = np.searchsorted(place, np.arange(len(sizes) + 1))
        return pa.table({
            "row_id": pa.array(keys[0]),
            "n": pa.array(sizes, pa.int64()),
            "d1": pa.array(keys[1]),
            "d2": pa.array(keys[2]),
            "shared": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64))),
        })

    return run


def shared_shingles(docs: DataFrame, width: int, key: str = "doc_id") -> DataFrame:
    """Every row's set of word shingles: row_id, n (its size), d1 and d2 (two hashes of the set) and
    shared (those that another row has too, in an order in which rare ones are first)."""
    settle(docs.sparkSession, TEXT_SETTINGS)
    texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("row_id"), F.col("text").cast("string").alias("text"))
    crowding, crowd, shingles = _crowding(texts, width)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = max(partitions, math.ceil(shingles / RANGE_SHINGLES))
    blocks = texts.mapInArrow(_set_blocks(width, slots, crowding), _BLOCK_SCHEMA)
    counted = blocks.groupBy("slot").applyInArrow(_count_range, _BLOCK_SCHEMA)
    return counted.groupBy("block").applyInArrow(_assemble(crowding, crowd), _SET_SCHEMA)


#: Stands for a null key inside the join.
NO_KEY = -(1 << 63)


def _prefix_length(n: Column, percent: int) -> Column:
    """So many of the first shingles of a set of n that any linked set has one of them in its own."""
    return n - F.ceil(n * percent / F.lit(100)).cast("long") + 1


def _may_link(n1: Column, at1: Column, n2: Column, at2: Column, percent: int) -> Column:
    """Whether sets whose first common shingle has these places (from 0) can be similar enough."""
    most = F.least(n1 - at1, n2 - at2)
    return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent) & (most * (100 + percent) >= (n1 + n2) * percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose similarity is high enough."""
    one = sets.select(F.col("cid").alias("a"), F.col("n").alias("n1"), F.col("shared").alias("s1"))
    two = sets.select(F.col("cid").alias("b"), F.col("n").alias("n2"), F.col("shared").alias("s2"))
    both = pairs.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("s1", "s2")))
    return both.filter(F.col("common") * (100 + percent) >= (F.col("n1") + F.col("n2")) * percent).select("a", "b")


def _neighbours(entries: DataFrame, order: list, turn: int, percent: int) -> DataFrame:
    """Pairs of classes of different components that are near each other in a list, in some order of the lists.

    Long lists are cut into blocks, to which each turn deals the classes anew.
    """
    blocks = F.ceil(F.col("in_list") / F.lit(LIST_ROWS))
    block = F.pmod(F.xxhash64(F.lit(turn), F.lit("block"), "cid"), blocks)
    # One hash of both, so that rows are not left where they lie by the shingle alone.
    entries = entries.withColumn("list", F.when(blocks > 1, F.xxhash64("shingle", block)).otherwise(F.col("shingle")))
    in_list = Window.partitionBy("list").orderBy("shingle", *order)
    near = [F.lag(F.struct("cid", "n", "at", "component", "shingle"), d).over(in_list).alias(f"near{d}") for d in NEIGHBOURS]
    fits = lambda x: x.isNotNull() & (x["shingle"] == F.col("shingle")) & (x["component"] != F.col("component")) & _may_link(F.col("n"), F.col("at"), x["n"], x["at"], percent)
    tried = entries.select("cid", "n", "at", "component", "shingle", F.array(*near).alias("near"))
    tried = tried.select("cid", F.explode(F.filter("near", fits)).alias("x"))
    return tried.select(F.greatest("cid", "x.cid").alias("a"), F.least("cid", "x.cid").alias("b"))


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Enough links between classes to connect all that links connect."""
    lone = F.col("n") - F.size("shared")
    prefix = F.slice("shared", F.lit(1), F.greatest(F.lit(0), _prefix_length(F.col("n"), percent) - lone).cast("int"))
    prefixed = sets.select("cid", "n", lone.alias("lone"), prefix.alias("prefix"))
    by_prefix = Window.partitionBy("n", "h1", "h2")
    grouped = prefixed.withColumns({"h1": F.xxhash64("prefix"), "h2": F.xxhash64(F.lit(1), "prefix")})
    groups = grouped.groupBy("n", "h1", "h2").agg(F.min("cid").alias("gid"), F.count("cid").alias("in_group"))
    members = written(grouped.select("cid", "n", "h1", "h2").join(groups, ["n", "h1", "h2"]).select("cid", "gid", "in_group"), "members")
    entries = prefixed.join(groups.select(F.col("gid").alias("cid"), "in_group"), "cid").select(
        F.col("cid").alias("gid"), "n", "lone", "in_group", F.posexplode("prefix").alias("at", "shingle")
    )
    entries = entries.select("shingle", "gid", "n", (F.col("at") + F.col("lone")).alias("at"), "in_group")
    lists = entries.groupBy("shingle").agg(F.count("gid").alias("size"), F.sum("in_group").alias("in_list"))
    # As a table, so that both sides of the join are exchanged and a long list can be split.
    lists = written(lists.filter("size > 1").select("shingle", "in_list"), "lists")
    entries = written(entries.join(lists, "shingle").select("shingle", "gid", "n", "at", "in_list"), "entries")

    # Neighbours, class by class: in every list, and in every group, as a list of its own below zero.
    in_lists = entries.join(members, "gid").select("shingle", "cid", "n", "at", "in_list")
    zero = F.lit(0).cast("bigint")
    in_groups = members.filter("in_group > 1").select((-1 - F.col("gid")).alias("shingle"), "cid", zero.alias("n"), zero.alias("at"), F.col("in_group").alias("in_list"))
    class_entries = written(in_lists.union(in_groups), "class-entries")
    links, labels = None, class_entries.select(F.col("cid").alias("node"), F.col("cid").alias("component")).limit(0)
    orders = [["n", "at", "cid"], *[[F.xxhash64(F.lit(turn), "cid"), "cid"] for turn in range(NEIGHBOUR_ROUNDS)]]
    for turn, order in enumerate(orders):
        labelled = class_entries.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        more = written(_verified(_neighbours(labelled, order, turn, percent).distinct(), sets, percent), "links")
        if links is not None and not more.limit(1).count():
            break
        links = more if links is None else links.union(more)
        labels = connected_components(links)

    # What is left: pairs of groups that no component holds whole.
    labels = labels.select(F.col("node").alias("cid"), "component")
    of_member = members.join(labels, "cid", "left").select("cid", "gid", F.coalesce("component", "cid").alias("component"))
    of_member = written(of_member, "member-components")
    of_group = of_member.groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    # A group of several components is in none: numbers below zero name no component.
    of_group = of_group.select("gid", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(-1 - F.col("gid")).alias("component"))
    labelled = entries.join(of_group, "gid")
    by_label = labelled.groupBy("shingle", "component").agg(F.count("gid").alias("size"))
    main = by_label.groupBy("shingle").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("size").alias("labels"))
    main = written(main.filter("labels > 1").select("shingle", "main"), "main-components")
    labelled = written(labelled.join(main, "shingle"), "open-entries")
    minor = labelled.filter("component <> main").select("shingle", *[F.col(c).alias(f"{c}2") for c in ("gid", "n", "at", "component")])
    open_pairs = labelled.join(minor, "shingle").filter(
        (F.col("component") != F.col("component2"))
        & ((F.col("component") == F.col("main")) | (F.col("gid") < F.col("gid2")))
        & _may_link(F.col("n"), F.col("at"), F.col("n2"), F.col("at2"), percent)
    )
    open_pairs = open_pairs.select(F.greatest("gid", "gid2").alias("a"), F.least("gid", "gid2").alias("b"))
    mixed = of_group.filter("component < 0").select(F.col("gid").alias("a"), F.col("gid").alias("b"))
    one = of_member.select(F.col("gid").alias("a"), F.col("cid").alias("ca"), F.col("component").alias("la"))
    two = of_member.select(F.col("gid").alias("b"), F.col("cid").alias("cb"), F.col("component").alias("lb"))
    pairs = open_pairs.union(mixed).distinct().join(one, "a").join(two, "b").filter("la <> lb and (a <> b or ca > cb)")
    rest = _verified(pairs.select(F.col("ca").alias("a"), F.col("cb").alias("b")), sets, percent)
    return links.union(rest)


def similar_documents(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", identity_too: bool = False) -> DataFrame:
    """Every row's number of shingles and the smallest key it is linked with, over any number of links.

    Gives key (long), n_shingles (long), component_id (long) and keeper (boolean: the row is the one of its
    component to keep). Words are runs of other than ASCII white space after lower-casing A-Z; a text
    with fewer than `width` words, but one at least, is one shingle. Two rows are linked if
    100 * intersection >= percent * union of their distinct shingles. Null, empty and blank texts have no
    shingles and no links: their component is their own key, and they are keepers. A row with a null key
    is linked like any other, but names no component; rows with equal keys stay rows. An empty table gives
    no rows. With `identity_too` rows also have n, d1, d2 (their set) and component (null without shingles), by
    which rows with equal keys can be told apart.
    """
    rows = written(shared_shingles(docs, width, key), "shingle-sets")
    full = rows.filter("n > 0")
    identity = ["n", "d1", "d2"]
    classes = full.groupBy(*identity).agg(F.min(F.when(F.col("row_id") != NO_KEY, F.col("row_id"))).alias("least_id"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    may_link = F.col("n") - F.size("shared") < _prefix_length(F.col("n"), percent)
    sets = full.filter(may_link).groupBy(*identity).agg(F.any_value("shared").alias("shared"))
    sets = written(sets.join(classes, identity).select("cid", "n", "shared"), "class-sets")
    labels = written(connected_components(_links(sets, percent)), "components")
    labelled = classes.join(labels.select(F.col("node").alias("cid"), "component"), "cid", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "cid"))
    least = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = labelled.join(least, "component").select(*identity, "component_id", "component")
    out = rows.select("row_id", *identity).join(named, identity, "left")
    own = F.when(F.col("row_id") != NO_KEY, F.col("row_id"))
    return out.select(
        own.alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", own).alias("component_id"),
        ((F.col("n") == 0) | F.coalesce(F.col("component_id") == own, F.col("component_id").isNull())).alias("keeper"),
        *([*identity, "component"] if identity_too else []),
    )
