"""Line deduplication, hash trees and prefix tries on awkward rows, against plain recomputation."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from joulemart.llm import line_dedup, merkle, places, prefix_trie, queries_lines
from tests.llm.edge_rows import documents, lower


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _expected_lines(rows, least_chars=20, least_docs=3):
    key_of = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least_chars:
                holders[key_of(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            found = holders.get(key_of(line), ())
            if len(found) < least_docs or doc == max(found, key=lambda d: (d is not None, d or 0)):
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


_LINE = "a line that several of them have"
LINE_ROWS = [
    (1, f"{_LINE}\nown words of the first\n{_LINE}"),
    (2, f"\t {_LINE.upper()} \r\n\nshort\nshort"),
    (2, f"another text of the same id\n{_LINE}"),
    (3, f"x\n{_LINE}\x0c\nÉ{_LINE}\n"),
    (3, f"x\n{_LINE}\x0c\nÉ{_LINE}\n"),
    (4, f"É{_LINE}\né{_LINE}"),
    (None, f"É{_LINE}"),
    (None, _LINE),
    (5, None), (6, ""), (7, "\n\n"), (8, "nineteen characters\n" * 3), (9, "nineteen characters"), (10, "nineteen characters"),
    (11, "twenty characters ab"), (12, " twenty characters ab"), (13, "twenty characters ab\n" * 40_000), (-4, "twenty characters ab"),
]


@pytest.mark.parametrize("send", [True, False])
def test_lines_of_odd_rows(spark, monkeypatch, send):
    if not send:
        monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in LINE_ROWS], "doc_id long, text string, n_lines int, keeper string").repartition(3)
    found = line_dedup.drop_shared_lines(docs)
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert sorted(map(tuple, found.collect()), key=str) == _expected_lines(LINE_ROWS)
    assert line_dedup.drop_shared_lines(docs.limit(0)).count() == 0


def test_lines_with_other_bounds(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = line_dedup.drop_shared_lines(docs, least_chars=3, least_docs=2).collect()
    assert sorted(map(tuple, found), key=str) == _expected_lines(rows, 3, 2)


def test_places_of_a_group_that_all_tasks_share(spark):
    rows = spark.range(0, 5000, 1, 6).select(F.when(F.col("id") % 5 > 0, "hot").alias("g"), (F.col("id") * 7 % 5000).alias("o"))
    table = places.numbered(rows.union(spark.createDataFrame([("hot", None), ("hot", 3), ("lone", 1)], "g string, o long")), "g", ["o"])
    found = defaultdict(list)
    for r in table.collect():
        found[r["g"]].append((r["place"], r["o"], r["total"]))
    for group in found.values():
        group.sort(key=lambda r: r[0])
        assert [r[0] for r in group] == list(range(len(group))) and {r[2] for r in group} == {len(group)}
        keys = [(o is not None, o or 0) for _, o, _ in group]
        assert keys == sorted(keys)
    assert {k: len(v) for k, v in found.items()} == {"hot": 4002, None: 1000, "lone": 1}
    assert places.numbered(rows.limit(0), "g", ["o"]).count() == 0


def _up(nodes):
    return [_sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]


def _siblings(nodes, i):
    """What stands before and after the i-th node, run by run up to the top."""
    path = []
    while len(nodes) > 1:
        start = i // 3 * 3
        path.append(("".join(nodes[start:i]), "".join(nodes[i + 1 : start + 3])))
        nodes, i = _up(nodes), i // 3
    return path, nodes[0]


def test_hash_trees_of_odd_groups(spark):
    sizes = {None: 2, "": 1, "Z": 730, "a": 3, "é": 2188, "b": 27}
    rows = [(i * 5 % n if i else None, g, _sha(f"{g}{i}")) for g, n in sizes.items() for i in range(n)]
    rows += [(9, "a", _sha("same"))] * 5
    table = spark.createDataFrame([(*r, "old", 3.5) for r in rows], "doc_id long, source string, leaf string, root string, place double").repartition(5)
    proved = merkle.manifest(table)
    assert proved.columns == ["doc_id", "source", "leaf", "place", "total", "subroot", "root", "path"]
    found = proved.withColumn("folded", merkle.folded(F.col("leaf"), F.col("path"))).withColumn("proof", merkle.siblings(F.col("path"))).collect()
    groups = defaultdict(list)
    for doc, group, leaf in rows:
        groups[group].append((doc is not None, doc or 0, leaf))
    leaves = {g: [x[2] for x in sorted(v)] for g, v in groups.items()}
    order = sorted(leaves, key=lambda g: (g is not None, (g or "").encode()))
    subroots = [_siblings(leaves[g], 0)[1] for g in order]
    root = _siblings(subroots, 0)[1]
    assert len(found) == len(rows)
    for r in found:
        path, subroot = _siblings(leaves[r["source"]], r["place"])
        path += _siblings(subroots, order.index(r["source"]))[0]
        assert leaves[r["source"]][r["place"]] == r["leaf"] and r["total"] == len(leaves[r["source"]])
        assert (r["subroot"], r["root"], r["folded"]) == (subroot, root, root)
        assert [tuple(step) for step in r["path"]] == path and r["proof"] == "".join(a + b for a, b in path)


def test_one_leaf_and_none(spark):
    lone = spark.createDataFrame([(None, None, "ab")], "doc_id long, source string, leaf string")
    row = merkle.manifest(lone).first()
    assert (row["subroot"], row["root"], row["path"]) == ("ab", "ab", [])
    assert merkle.manifest(lone.limit(0)).count() == 0


def test_tampering_is_found_and_fields_are_told_apart(spark, tmp_path):
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.union(spark.createDataFrame([(20 + i, "one\ntwo", "en", "s1", 7) for i in range(12)], docs.schema))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries_lines.verified_manifest(spark, str(tmp_path)).collect()
    for r in rows:
        is_cut = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        had_feed = r["doc_id"] in (6, 11) or (r["doc_id"] or 0) >= 20
        assert r["verified"] == (r["folded_root"] == r["root"]) == (not (is_cut and had_feed))
    assert len(rows) == docs.count()
    leaf = lambda *v: spark.range(1).select(merkle.leaf_digest(*map(F.lit, v))).first()[0]
    assert leaf(5, "é", None, "-") == _sha("1:52:é-1:-")
    assert leaf("ab", "c") != leaf("a", "bc") and leaf(None, "x") != leaf("-", "x")


def test_fattest_number():
    for low in range(40):
        for high in range(low + 1, 41):
            best = max(range(low + 1, high + 1), key=lambda n: n & -n)
            assert prefix_trie.fattest(low, high) == best


def test_trie_finds_every_exit_and_keeps_every_edge():
    pick = random.Random(5)
    for _ in range(150):
        sequences = [[pick.randrange(3) for _ in range(pick.randrange(1, 40))] for _ in range(40)]
        sequences += [s[: pick.randrange(1, len(s) + 1)] + [9] * pick.randrange(12) for s in sequences]
        keyed = [[hashlib.md5(str(s[: i + 1]).encode()).digest() for i in range(len(s))] for s in sequences]
        trie = prefix_trie.ZFastTrie(0, bytes(16))
        for i, keys in enumerate(keyed):
            trie.insert(keys, [0] * len(keys), 1, i)
        known = {k for keys in keyed for k in keys}
        for s in sequences:  # and where a sequence that was never inserted leaves the trie
            probe = s[: len(s) // 2] + [pick.randrange(4) for _ in range(9)]
            keys = [hashlib.md5(str(probe[: i + 1]).encode()).digest() for i in range(len(probe))]
            shared = sum(k in known for k in keys)
            node, edge = trie.exit(keys)
            assert node.high <= shared and (edge is None or edge.low == node.high)
            assert shared == node.high if edge is None else node.high < shared <= edge.high
        members = defaultdict(list)
        for i, keys in enumerate(keyed):
            for k in keys:
                members[k].append(i)
        found = {k: (e.n, e.least) for e in trie.edges() for k in e.keys[e.low : e.high]}
        assert found == {k: (len(v), min(v)) for k, v in members.items()}


def _expected_nodes(conversations):
    """Nodes of a trie of {conv: [(role, text), ...]}, built turn by turn."""
    child, members, depth, up, last, ends = {}, [[]], [0], [None], [""], defaultdict(list)
    for conv in sorted(conversations):
        node = 0
        members[0].append(conv)
        for turn in conversations[conv]:
            if (node, turn) not in child:
                child[node, turn] = len(members)
                members.append([]), depth.append(depth[node] + 1), up.append(node), last.append(turn[1])
            node = child[node, turn]
            members[node].append(conv)
        ends[node].append(conv)
    n_children = [0] * len(members)
    for node in up[1:]:
        n_children[node] += 1
    saved = [(len(m) - 1) * len(t) for m, t in zip(members, last)]
    leaves = [int(n == 0) for n in n_children]
    for node in range(len(members) - 1, 0, -1):
        saved[up[node]] += saved[node]
        leaves[up[node]] += leaves[node]
    return sorted(
        (m[0], depth[i], None if i == 0 else members[up[i]][0], len(m), n_children[i], leaves[i], saved[i], _sha(",".join(map(str, ends[i]))))
        for i, m in enumerate(members)
    )


def _turn_rows():
    """Copies, prefixes of one another, chains of branches, one conversation over several segments twice, odd values."""
    pick = random.Random(3)
    rows = []
    for conv in [*range(0, 60), *range(100, 130), 230, -5, 1 << 40]:
        n = pick.randrange(1, 14)
        for turn in range(n):
            text = "hot" if turn < 2 else pick.choice(["a", "b", "", None, "日本"])
            rows.append((conv, turn, pick.choice(["user", None]) if turn > 3 else "user", text))
    rows += [(400 + i, t, "user", "all the same") for i in range(80) for t in range(4)]
    rows += [(500 + i, t, "user", "x") for i in range(20) for t in range(i + 1)]
    rows += [(conv, t, "user", f"turn {t}" if t != at else "other") for conv, at in ((600, -1), (601, 2600), (602, 700)) for t in range(2700)]
    rows += [(conv, 0, "user", "lone") for conv in range(901, 909)]  # without a conversation 900 to open them
    rows += [(700, None, "user", "first"), (700, 0, None, None), (700, 5, "user", "y"), (701, 3, "user", "z" * 100_000)]
    return rows


def test_prefixes_of_odd_conversations(spark):
    rows = _turn_rows()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows] + [(None, 1, "user", "lost", 1, "x")], "conv_id long, turn long, role string, text string, depth int, a string")
    conversations = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        conversations[conv].append((role or "", text or ""))
    found = prefix_trie.conversation_trie(table.repartition(5))
    assert sorted(map(tuple, found.collect())) == _expected_nodes(conversations)
    assert prefix_trie.conversation_trie(table.limit(0)).count() == 0


def test_shared_openings(spark, tmp_path):
    rows = _turn_rows()
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[conv].append((role or "", text or ""))
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - int(conv / 100) * 100 if abs(conv) < 1 << 39 else conv % 100
        rebuilt[conv] = own.get(conv - base, [])[:h] + turns[h:]
    assert any(not turns for turns in rebuilt.values())
    assert sorted(map(tuple, queries_lines.trie_of_openings(spark, str(tmp_path)).collect())) == _expected_nodes(rebuilt)


def test_repeated_turns_and_ties(spark):
    rows = [(1, 0, "b", "same"), (1, 0, "a", "other"), (1, 0, "b", "same"), (2, 1, "a", "other"), (2, 2, "b", "same")]
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert sorted((r["depth"], r["n_convs"], r["conv_id"]) for r in found) == [(0, 2, 1), (1, 2, 1), (2, 2, 1), (3, 1, 1)]
