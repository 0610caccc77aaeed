"""Which conversations begin alike: a trie over their turns, with counts and sums for every prefix.

A prefix is known by the exclusive or of its turns' hashes, each taken with its place, so that equal
prefixes have equal keys wherever they are met. Conversations are cut to segments of bounded length.
Every task inserts its segments, batch by batch, into z-fast tries and hands on each edge turn by turn:
one row a prefix that the task has seen, with the number of its conversations. Those rows are summed by
key, and what concerns whole subtrees is summed along chains: the prefixes whose smallest conversation
is the same lie on one path, and a chain hangs on another chain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joulemart.llm.components import written
from joulemart.llm.places import numbered

#: Turns of a segment: a row, and an edge, are at most so long.
SEGMENT = 1024
#: Keys that a task's tries hold before their edges are handed on and it starts anew.
TRIE_KEYS = 2_000_000
#: Conversation ids are joined to texts by ranges of 2 ** so many ids.
ID_BITS = 12

_NODES = "depth long, a long, b long, pa long, pb long, n long, least long, chars long"


def fattest(low: int, high: int) -> int:
    """The number in (low, high] that the largest power of two divides."""
    return high & (-1 << (low ^ high).bit_length() - 1)


class _Node:
    """An edge of turns low + 1 to high below `up`, and the node at its end; turns are those of `keys`."""

    __slots__ = ("keys", "chars", "low", "high", "up", "n", "least")

    def __init__(self, keys: list[bytes], chars: np.ndarray, low: int, high: int, up: _Node | None):
        self.keys, self.chars, self.low, self.high, self.up = keys, chars, low, high, up
        self.n, self.least = 0, None

    def end(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


class ZFastTrie:
    """Compacted trie of key sequences below one root. Nodes are found by the key at their handle's depth.

    A node's handle is the prefix whose length is the fattest number on its edge, so that a binary search
    over lengths that always tries the fattest one meets every node on the path of a sequence.
    """

    def __init__(self, depth: int, key: bytes):
        self.depth, self.key = depth, key
        self.root = _Node([], np.zeros(0, np.int64), 0, 0, None)
        self.handles: dict[bytes, _Node] = {}
        self.firsts: dict[bytes, _Node] = {}

    def _add(self, node: _Node) -> None:
        self.handles[node.keys[fattest(node.low, node.high) - 1]] = node
        self.firsts[node.keys[node.low]] = node

    def exit(self, keys: list[bytes]) -> tuple[_Node, _Node | None]:
        """The last node of which the whole sequence begins `keys`, and the edge below it that `keys` ends in."""
        node, low, high = self.root, 0, len(keys)
        while low < high:
            at = fattest(low, high)
            found = self.handles.get(keys[at - 1])
            if found is None:
                high = at - 1
            elif found.high <= len(keys) and keys[found.high - 1] == found.keys[found.high - 1]:
                node, low = found, found.high
            else:
                return found.up, found
        return node, self.firsts.get(keys[node.high]) if node.high < len(keys) else None

    def insert(self, keys: list[bytes], chars: np.ndarray, n: int, least: int) -> None:
        node, edge = self.exit(keys)
        if edge is not None:
            low, high = edge.low + 1, min(edge.high, len(keys))
            while low < high:  # the last turn that both have
                middle = (low + high + 1) // 2
                if keys[middle - 1] == edge.keys[middle - 1]:
                    low = middle
                else:
                    high = middle - 1
            del self.handles[edge.keys[fattest(edge.low, edge.high) - 1]]
            node = _Node(edge.keys, edge.chars, edge.low, low, edge.up)
            edge.low, edge.up = low, node
            self._add(node)
            self._add(edge)
        if node.high < len(keys):
            node = _Node(keys, chars, node.high, len(keys), node)
            self._add(node)
        node.end(n, least)

    def edges(self) -> Iterator[_Node]:
        """All edges, with what ends at or below them counted; for once, at the end."""
        nodes = sorted(self.firsts.values(), key=lambda node: -node.high)
        for node in nodes:
            yield node
            node.up.end(node.n, node.least)


def _handed_on(tries: dict) -> Iterator[pa.RecordBatch]:
    """Every prefix of the tries, edge by edge."""
    keys, befores, depths, n, least, chars, size = [], [], [], [], [], [], []
    for trie in tries.values():
        for e in trie.edges():
            keys += e.keys[e.low : e.high]
            befores.append(e.keys[e.low - 1] if e.low else trie.key)
            befores += e.keys[e.low : e.high - 1]
            depths.append(np.arange(e.low + 1, e.high + 1) + trie.depth)
            chars.append(e.chars[e.low : e.high])
            n.append(e.n)
            least.append(e.least)
            size.append(e.high - e.low)
    if not keys:
        return
    a, b = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2).T
    pa_, pb = np.frombuffer(b"".join(befores), np.int64).reshape(-1, 2).T
    columns = [np.concatenate(depths), a, b, pa_, pb, np.repeat(n, size), np.repeat(least, size), np.concatenate(chars)]
    table = pa.table([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], names=[c.split()[0] for c in _NODES.split(", ")])
    yield from table.to_batches(max_chunksize=10_000)


def _segments(batch: pa.RecordBatch) -> dict:
    """Equal segments of a batch as one: (segment, start, last key) -> [keys, chars, number, smallest conversation]."""
    column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    lengths = column["a"].value_lengths().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    pairs = np.empty((int(ends[-1]), 2), np.uint64)
    for i, (lane, start) in enumerate((("a", "sa"), ("b", "sb"))):
        up_to = np.bitwise_xor.accumulate(column[lane].flatten().to_numpy().view(np.uint64))
        before = np.concatenate([[np.uint64(0)], up_to[ends[:-1] - 1]])
        pairs[:, i] = up_to ^ np.repeat(before ^ column[start].to_numpy().view(np.uint64), lengths)
    keys, chars = pairs.view("V16").ravel().tolist(), column["chars"].flatten().to_numpy()
    starts = np.stack([column["sa"].to_numpy(), column["sb"].to_numpy()], 1).view("V16").ravel().tolist()
    found: dict = {}
    for conv, segment, start, low, high in zip(column["conv"].to_pylist(), column["segment"].to_pylist(), starts, ends - lengths, ends):
        own = found.setdefault((segment, start, keys[high - 1]), [keys[low:high], chars[low:high], 0, conv])
        own[2] += 1
        own[3] = min(own[3], conv)
    return found


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: its segments in tries, one a segment number and start; every prefix in them."""
    tries, held = {}, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        for (segment, start, _), (keys, chars, n, least) in _segments(batch).items():
            trie = tries.get((segment, start))
            if trie is None:
                trie = tries[segment, start] = ZFastTrie(segment * SEGMENT, start)
            trie.insert(keys, chars, n, least)
            held += len(keys)
        if held > TRIE_KEYS:
            yield from _handed_on(tries)
            tries, held = {}, 0
    yield from _handed_on(tries)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: pieces of texts, sorted by key and place, as one SHA-256 a key; only one piece is held."""
    out, key, state = [], None, None
    for batch in batches:
        for depth, a, b, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (depth, a, b) == key:
                state.update(b"," + text.encode())
            else:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (depth, a, b), hashlib.sha256(text.encode())
        if len(out) >= 10_000:
            yield _digest_rows(out)
            out = []
    if key is not None:
        out.append((*key, state.hexdigest()))
    yield _digest_rows(out)


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])], ["depth", "a", "b", "ends_sha256"])


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """(conv, place, total, a, b, chars): turns in order, from 0, with 128 bits of hash of role and text.

    Turns ascend by turn, nulls first; equal turns by role and hash. Turns without conv_id belong to no
    conversation and are left out. Null roles and texts are empty ones.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), role, text).alias("b"), F.char_length(text).cast("long").alias("chars"),
    )
    placed = numbered(written(turns, "turns"), "conv", ["turn", "role", "a", "b"])
    return written(placed.drop("turn", "role"), "turns")


def _running(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Sums of columns over the rows of a chain (conv) from each depth down, in slices of bounded length."""
    sliced = rows.withColumn("slice", F.expr(f"depth div {SEGMENT}"))
    deeper = Window.partitionBy("conv").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy("conv", "slice").agg(*[F.sum(c).alias(c) for c in columns])
    later = totals.select("conv", "slice", *[F.sum(c).over(deeper).alias(f"{c}_later") for c in columns]).filter(F.col(f"{columns[0]}_later").isNotNull())
    within = Window.partitionBy("conv", "slice").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    summed = sliced.select(*[F.sum(c).over(within).alias(c) if c in columns else F.col(c) for c in sliced.columns])
    joined = summed.join(later, ["conv", "slice"], "left")
    return joined.select(*[(F.col(c) + F.coalesce(f"{c}_later", F.lit(0))).alias(c) if c in columns else F.col(c) for c in rows.columns])


def _with_chains_below(chains: DataFrame) -> DataFrame:
    """Chains (conv, up, at, sums) with the sums of all chains that hang on them, near or far, by pointer doubling."""
    state = chains.select("conv", F.col("up").alias("jump"), "n_leaves", "saved_tokens")
    while state.filter("jump is not null").limit(1).count():
        below = state.filter("jump is not null").groupBy(F.col("jump").alias("of"))
        below = below.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        further = state.select(F.col("conv").alias("to"), F.col("jump").alias("further"))
        state = state.join(below, F.col("conv") == F.col("of"), "left").join(further, F.col("jump") == F.col("to"), "left")
        state = written(state.select(
            "conv", F.col("further").alias("jump"), (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        ), "chains")
    return chains.select("conv", "up", "at").join(state.drop("jump"), "conv")


def prefix_nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a prefix of the conversations: their trie's nodes, the root included.

    turns are (conv, depth from 1, a, b, chars) and convs (conv), each once, those without turns too.
    Gives conv_id (the smallest conversation that begins so), depth, parent_conv_id (that of the prefix
    one turn shorter, null for the root), n_convs, n_children, n_leaves (nodes without children at or
    below this one), saved_tokens (over the node and all below it, (n_convs - 1) times chars of the last
    turn) and ends_sha256 (of the ids of the conversations that end here, ascending, joined by commas).
    Without conversations there are no rows. Prefixes are told apart by their depth and 128 bits of hash.
    """
    lane_a, lane_b = F.xxhash64("depth", "a").alias("a"), F.xxhash64("b", "depth").alias("b")
    keyed = turns.select("conv", "depth", lane_a, lane_b, "chars", F.expr(f"(depth - 1) div {SEGMENT}").alias("segment"))
    segments = keyed.groupBy("conv", "segment").agg(
        F.array_sort(F.collect_list(F.struct("depth", "a", "b", "chars"))).alias("turns"),
        F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"), F.count(F.lit(1)).alias("n"),
    )
    segments = written(segments, "segments")
    # Segments after a conversation's first start at the key of all turns before.
    long_ones = segments.filter("segment > 0").select("conv").distinct()
    before = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select("conv", "segment", "xa", "xb").join(long_ones, "conv", "left_semi")
    starts = starts.select("conv", "segment", F.bit_xor("xa").over(before).alias("sa"), F.bit_xor("xb").over(before).alias("sb"))
    cut = segments.join(starts, ["conv", "segment"], "left").select(
        "conv", "segment", F.coalesce("sa", F.lit(0)).alias("sa"), F.coalesce("sb", F.lit(0)).alias("sb"),
        F.col("turns.a").alias("a"), F.col("turns.b").alias("b"), F.col("turns.chars").alias("chars"),
    )
    seen = cut.mapInArrow(_tries, _NODES).groupBy("depth", "a", "b").agg(
        F.sum("n").alias("n_convs"), F.min("least").alias("conv"), F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.first("chars").alias("chars")
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")).filter("n_convs > 0").select(
        zero.alias("depth"), zero.alias("a"), zero.alias("b"), "n_convs", "conv", zero.alias("pa"), zero.alias("pb"), zero.alias("chars")
    )
    nodes = written(seen.unionByName(root), "prefixes")

    key = ["depth", "a", "b"]
    up = ((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    children = nodes.filter("depth > 0").select(*up).groupBy(*key).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("parent"))
    known = nodes.join(children, key, "left").join(parents, ["depth", "pa", "pb"], "left").select(
        *key, "conv", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    known = written(known, "prefixes")

    hangs = F.col("parent").isNull() | (F.col("parent") != F.col("conv"))
    chains = known.groupBy("conv").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max(F.when(hangs, F.col("parent"))).alias("up"), F.max(F.when(hangs, F.col("depth") - 1)).alias("at"),
    )
    hung = _with_chains_below(written(chains, "chains")).filter("up is not null").groupBy(F.col("up").alias("conv"), F.col("at").alias("depth"))
    hung = hung.agg(F.sum("n_leaves").alias("hung_leaves"), F.sum("saved_tokens").alias("hung_saved"))
    below = known.join(hung, ["conv", "depth"], "left").select(
        *key, "conv", "parent", "n_convs", "n_children", (F.col("n_leaves") + F.coalesce("hung_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved_tokens") + F.coalesce("hung_saved", F.lit(0))).alias("saved_tokens"),
    )

    whole = segments.groupBy("conv").agg(F.sum("n").alias("depth"), F.bit_xor("xa").alias("a"), F.bit_xor("xb").alias("b"))
    ends = convs.join(whole, "conv", "left").select("conv", *[F.coalesce(c, zero).alias(c) for c in key])
    pieces = ends.groupBy(*key, F.shiftright("conv", ID_BITS).alias("range")).agg(F.array_sort(F.collect_list("conv")).alias("ids"))
    pieces = pieces.select(*key, F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"), "range")
    digests = pieces.repartition(*key).sortWithinPartitions(*key, "range").mapInArrow(_digests, "depth long, a long, b long, ends_sha256 string")
    return _running(below, ["n_leaves", "saved_tokens"]).join(digests, key, "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefixes of conversations (conv_id, turn, role, text); see hashed_turns and prefix_nodes."""
    turns = hashed_turns(conversations)
    return prefix_nodes(turns.select("conv", (F.col("place") + 1).alias("depth"), "a", "b", "chars"), turns.select("conv").distinct())


def with_shared_openings(turns: DataFrame, opening: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with another one's turns: (turns, convs) as prefix_nodes takes them.

    turns are those of hashed_turns. Conversation `conv` gets the first `opening` turns of conversation
    `base` (all, if it has fewer; none, if there is no such one), then its own turns after its first
    `opening`. Both are columns over conv.
    """
    convs = written(turns.groupBy("conv").agg(F.max("total").alias("n")).withColumns({"opening": opening, "base": base}), "conversations")
    most = convs.agg(F.max("opening")).first()[0] or 0
    bases = convs.select("base").distinct()
    heads = turns.filter(F.col("place") < most).join(bases, F.col("conv") == F.col("base"), "left_semi")
    heads = heads.select(F.col("conv").alias("base"), "place", "a", "b", "chars")
    opened = convs.join(heads, "base").filter(F.col("place") < F.col("opening"))
    opened = opened.select("conv", (F.col("place") + 1).alias("depth"), "a", "b", "chars")
    sizes = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    given = convs.join(sizes, "base", "left").select("conv", "opening", F.least("opening", F.coalesce("n_base", F.lit(0))).alias("given"))
    own = turns.join(given, "conv").filter(F.col("place") >= F.col("opening"))
    own = own.select("conv", (F.col("given") + F.col("place") - F.col("opening") + 1).alias("depth"), "a", "b", "chars")
    return opened.union(own), convs.select("conv")
