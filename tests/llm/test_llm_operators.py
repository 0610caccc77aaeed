"""Every operator on awkward rows and on the small tables, against plain recomputation."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from joulemart.llm import backoff, components, graph_search, huffman_files, jaccard_join, licenses, mixing, near_vectors, packing, quality, text_hash, tool_calls
from joulemart.llm.queries import QUERIES, TOOLS
from tests.llm.edge_rows import components as reachable
from tests.llm.edge_rows import documents, lower, shingles

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark).repartition(3).persist()


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def _ids(text, end):
    return np.array(Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def _crc(ids):
    return zlib.crc32(ids.astype("<u4").tobytes())


def _sequences_hold(rows, most=2048):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= most
    return len(by_sequence)


def _run(name, spark, sf_dir):
    return QUERIES[name][0](spark, sf_dir).collect()


def test_packing_of_small_tables(spark, sf_dir, texts):
    rows = _run("op1_best_fit_packing", spark, sf_dir)
    expected = []
    for key, text in texts.items():
        ids = _ids(text, 0)
        expected += [(key, p, s, len(ids[s : s + 2048]), _crc(ids[s : s + 2048])) for p, s in enumerate(range(0, len(ids), 2048))]
    assert sorted(tuple(r)[:5] for r in rows) == sorted(expected)
    assert _sequences_hold(rows) <= math.ceil(sum(r["length"] for r in rows) / 2048) + 2


def test_packing_of_odd_rows(odd):
    rows = packing.pack_documents(odd, WORDS, with_ids=True).collect()
    assert _sequences_hold(rows) >= 1
    assert sum(r["length"] for r in rows) == sum(len(_ids(r["text"], 0)) for r in odd.collect())
    assert all(_crc(np.array(r["ids"])) == r["ids_crc32"] and r["length"] == len(r["ids"]) for r in rows)
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert packing.pack_documents(odd.limit(0), WORDS).count() == 0


def test_equal_rows_are_dealt_to_many_shards(spark):
    pieces = spark.range(0, 4000, 1, 4).select(F.lit(1).alias("doc_id"), F.lit(700).cast("long").alias("length"), F.lit("x").alias("offset"))
    rows = packing.pack(pieces, shard_pieces=500).collect()
    assert len({r["sequence_id"] >> 32 for r in rows}) == 8 and _sequences_hold(rows) <= 2000 + 8


def test_token_files_of_small_tables(spark, sf_dir, texts):
    rows = {r["doc_id"]: tuple(r)[1:] for r in _run("op3_huffman_files", spark, sf_dir)}
    start = 0
    for key in sorted(texts):
        ids = _ids(texts[key], 2)
        assert rows[key] == (start, len(ids), _crc(ids))
        start += len(ids)


def test_token_files_of_odd_rows(spark, odd, tmp_path):
    huffman_files.write_token_files(odd, str(tmp_path / "files"), WORDS)
    rows = huffman_files.read_token_files(spark, str(tmp_path / "files"), with_ids=True).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in odd.collect()), key=lambda i: (i is not None, i))
    assert sorted((r["ids"] for r in rows)) == sorted(_ids(r["text"], 2).tolist() for r in odd.collect())
    huffman_files.write_token_files(odd.limit(0), str(tmp_path / "none"), WORDS)
    assert huffman_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_mixing_of_odd_rows(spark, odd):
    mixed = mixing.poisson_mix(odd.withColumn("copy_no", F.lit("old")), total=3000)
    rows = mixed.collect()
    assert mixed.columns == [*odd.columns, "copy_no", "shuffle_key"]
    assert 2500 < len(rows) < 3500 and {r["source"] for r in rows} == {None, "s0", "s1"}
    weighted = mixing.poisson_mix(odd, weights={None: 1, "s1": 3}, total=4000).groupBy("source").count().collect()
    shares = {r["source"]: r["count"] for r in weighted}
    assert set(shares) == {None, "s1"} and 2.3 < shares["s1"] / shares[None] < 3.9
    assert mixing.poisson_mix(odd.limit(0)).count() == 0
    assert sorted(map(str, mixing.poisson_mix(odd, total=50).collect())) == sorted(map(str, mixing.poisson_mix(odd.repartition(5), total=50).collect()))


def test_mixing_by_join_when_there_are_many_sources(odd, monkeypatch):
    sent = sorted(map(str, mixing.poisson_mix(odd, total=60).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.poisson_mix(odd, total=60).collect())) == sent


def test_mixing_runs_no_python(spark, sf_dir):
    plan = QUERIES["op4_poisson_mix"][0](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


def _base_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    found = []
    for phrase, label in licenses.BASE_PHRASES.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), sorted(found)


def test_license_scan_of_odd_and_small_tables(spark, sf_dir, odd):
    for docs in (odd, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        scanned = licenses.scan(docs.withColumn("detections", F.lit(1)))
        assert scanned.columns == [*docs.columns, "n_words", "detections"]
        rows = licenses.digest(scanned).collect()
        given = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
        expected = []
        for key, text in given:
            n, found = _base_places(text)
            at = [i for i, _ in found]
            expected.append((key, n, len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))))
        assert sorted((tuple(r)[:6] for r in rows), key=str) == sorted(expected, key=str)
        for r in rows:
            assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert licenses.digest(licenses.scan(odd.limit(0))).count() == 0


def _expected_join(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    links = [
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
        if a and b and 100 * len(a & b) >= percent * len(a | b)
    ]
    group = reachable(len(rows), links)
    least = {}
    for (key, _), g in zip(rows, group):
        if key is not None:
            least[g] = min(key, least.get(g, key))
    return sorted(((key, len(s), least.get(g) if s else key) for (key, _), s, g in zip(rows, sets, group)), key=str)


def test_ngram_join_of_odd_and_small_tables(spark, sf_dir, odd):
    for docs, width, percent in ((odd, 5, 80), (spark.read.parquet(f"{sf_dir}/documents.parquet"), 4, 85)):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        found = jaccard_join.similar_documents(docs, width, percent).collect()
        assert sorted((tuple(r)[:3] for r in found), key=str) == _expected_join(rows, width, percent)
    assert jaccard_join.similar_documents(odd.limit(0)).count() == 0


@pytest.mark.parametrize("list_rows", [512, 8])
def test_ngram_join_of_chains_and_a_family(spark, monkeypatch, list_rows):
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", list_rows)
    random = np.random.default_rng(4)
    base = [f"w{i}" for i in range(70)]
    rows = []
    for i in range(90):  # edits of one text, of which some link with each other and some only with the text
        words = list(base)
        for at in random.integers(0, 70, int(random.integers(0, 4))):
            words[at] = f"e{i}x{at}"
        rows.append((i + 5, " ".join(words)))
    chain = [f"c{i}" for i in range(100)]
    rows += [(500 - i, " ".join(chain[i * 2 : i * 2 + 40])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted((tuple(r)[:3] for r in jaccard_join.similar_documents(docs, 4, 80).collect()), key=str)
    assert found == _expected_join(rows, 4, 80)


def test_shingles_that_crowd_a_range_stay_in_their_block(spark):
    notice = " ".join(f"n{i}" for i in range(12))
    rows = [(i, f"a{i} b{i} c{i} d{i} e{i} " + (notice if i % 3 else "") + (" x y z u" if i in (7, 70) else "")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    hashes, counts, shingles = jaccard_join._crowding(docs.select("doc_id", "text"), 4)
    sets = {key: set(_windows(text, 4)) for key, text in rows}
    having = Counter(s for found in sets.values() for s in found)
    often = [s for s, n in having.items() if n > 100]
    assert len(hashes) == len(often) == 9 and set(counts) == {having[often[0]]} == {133}
    assert shingles == sum(map(len, sets.values())) and (np.diff(hashes.astype(np.int64)) > 0).all()
    for row in jaccard_join.shared_shingles(docs, 4).collect():
        own = sets[row["row_id"]]
        common = [s for s in own if having[s] > 1]
        assert (row["n"], len(row["shared"])) == (len(own), len(common))
        # Rare ones first; the notice's last.
        frequent = [h in set(hashes.astype(np.int64)) for h in row["shared"]]
        assert frequent == sorted(frequent) and sum(frequent) == sum(having[s] > 100 for s in own)


def test_texts_come_to_the_join_in_bounded_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b "), "id", F.repeat(F.lit(" w"), 5000)).alias("text"))
    try:
        spark.conf.unset(key)
        assert jaccard_join.shared_shingles(docs, 4).agg(F.sum("n")).first()[0] == 3000 * 4
        sizes = [r[0] for r in docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"size": [b.nbytes]}) for b in batches), "size long").collect()]
        assert sum(sizes) > 30_000_000 and max(sizes) < 10_000_000
        spark.conf.set(key, "5m")
        jaccard_join.shared_shingles(docs.limit(1), 4)
        assert spark.conf.get(key) == "5m"
    finally:
        spark.conf.set(key, before)


def _windows(text, width):
    words = text.split()
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]


def test_long_lists_are_searched_in_blocks(spark, monkeypatch):
    """A list of which no block holds more than a share still yields neighbours of every turn, all of them in one list."""
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", 16)
    rows = [(shingle, shingle * 1000 + i, 50, 0, shingle * 1000 + i, 400 if shingle == 1 else 5) for shingle, size in ((1, 400), (2, 5)) for i in range(size)]
    entries = spark.createDataFrame(rows, "shingle long, cid long, n long, at long, component long, in_list long")
    found = [jaccard_join._neighbours(entries, ["n", "at", "cid"], turn, 80).distinct() for turn in (0, 1)]
    pairs = [{tuple(r) for r in f.collect()} for f in found]
    assert all(a // 1000 == b // 1000 and a > b for p in pairs for a, b in p)
    assert all(len({x for pair in p for x in pair}) == 405 for p in pairs)
    assert sum(a < 2000 for a, _ in pairs[0] - pairs[1]) > 500  # dealt anew
    links = found[0].union(found[1])
    assert components.connected_components(links).select("component").distinct().count() == 2


@pytest.mark.parametrize("finish", [10**6, 20, 0])
def test_components_in_rounds_and_at_once(spark, finish):
    random = np.random.default_rng(8)
    links = [tuple(map(int, random.integers(0, 150, 2))) for _ in range(110)] + [(200 + i, 201 + i) for i in range(40)]
    expected = reachable(300, links)
    df = spark.createDataFrame([*links, (None, 1), (9, 9)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.connected_components(df, finish_links=finish).collect()}
    assert found == {x: expected[x] for pair in links if pair[0] != pair[1] for x in pair}


def _vector_rows():
    random = np.random.default_rng(6)
    near = random.normal(size=8)
    vectors = [(near + random.normal(size=8) * 0.08).tolist() for _ in range(60)] + random.normal(size=(60, 8)).tolist()
    rows = [(i + 1, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows += [(300 + i, rows[0][1]) for i in range(20)] + [(1, rows[0][1])]
    rows += [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [float("inf")] + [1.0] * 7), (404, [None] + [1.0] * 7)]
    return rows


def _unit(rows):
    good = [v is not None and None not in v and np.isfinite(v).all() and any(v) for _, v in rows]
    wide = np.array([v if g else [1.0] * 8 for (_, v), g in zip(rows, good)])
    return np.array(good), wide / np.sqrt((wide * wide).sum(1, keepdims=True))


def test_near_vectors(spark):
    rows = _vector_rows()
    vectors = spark.createDataFrame([(k, v, "a", 1) for k, v in rows], "vec_id long, embedding array<float>, label string, cid int").repartition(3)
    good, unit = _unit(rows)
    link = (unit @ unit.T >= 0.95 - 1e-12) & good[:, None] & good & ~np.eye(len(rows), dtype=bool)
    group = reachable(len(rows), [(int(a), int(b)) for a, b in zip(*np.nonzero(link))])
    least = {}
    for (key, _), g in zip(rows, group):
        least[g] = min(key, least.get(g, key))
    expected = sorted((key, int(n), least[g], key == least[g]) for (key, _), n, g in zip(rows, link.sum(1), group))
    assert sorted(map(tuple, near_vectors.near_duplicates(vectors).collect())) == expected
    assert near_vectors.near_duplicates(vectors.limit(0)).count() == 0


def test_nearest_vectors(spark):
    rows = _vector_rows()
    vectors = spark.createDataFrame([(k, v, "a", 1) for k, v in rows] + [(None, [1.0] * 8, "b", 2)], "vec_id long, embedding array<float>, label string, rank int").repartition(3)
    queries = vectors.filter("vec_id % 7 = 0 or vec_id in (1, 300, 401)")
    found = {}
    for r in graph_search.nearest(vectors, queries, 5).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    good, unit = _unit(rows)
    at = {k: i for i, (k, _) in enumerate(rows)}
    assert set(found) == {k for k in at if good[at[k]] and (k % 7 == 0 or k in (1, 300))}
    for query, best in found.items():
        scores = unit @ unit[at[query]]
        expected = sorted({(-round(float(scores[i]), 9), k) for (k, _), i in zip(rows, range(len(rows))) if good[i] and k != query})[:5]
        assert [(-round(s, 9), k) for k, s in best] == expected
    assert graph_search.nearest(vectors.limit(0), queries.limit(0)).count() == 0
    assert {r["rank"] for r in graph_search.nearest(vectors.filter("vec_id < 4"), queries, 5).filter("query_id = 7").collect()} == {1, 2, 3}


@pytest.mark.parametrize("nodes", [3_000, 12_000])
def test_graph_search_is_audited(nodes):
    random = np.random.default_rng(3)
    vectors = graph_search.g.unit_rows(random.normal(size=(nodes, 64)))
    queries = graph_search.g.unit_rows(random.normal(size=(300, 64)))
    edges, starts = graph_search.build_graph(vectors)
    best = np.argsort(-(queries @ vectors.T), 1)[:, :5]
    recall = lambda found: np.mean([np.isin(b, f).mean() for b, f in zip(best, found)])
    assert recall(graph_search.find(vectors, edges, starts, queries, 5, 96)) >= 0.97
    # Without edges no beam finds anything, and the shard is scanned.
    assert recall(graph_search.find(vectors, np.full_like(edges, -1), starts, queries, 5, 96)) == 1.0


def test_vectors_of_unequal_length_are_refused(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0]), (3, None)], "vec_id long, embedding array<float>")
    for run in (lambda: near_vectors.near_duplicates(table), lambda: graph_search.nearest(table, table)):
        with pytest.raises(ValueError, match="components"):
            run()
    with pytest.raises(ValueError, match="components"):
        graph_search.nearest(table.filter("vec_id = 1"), table.filter("vec_id = 2"))


def test_vectors_of_the_given_tables(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    wide = np.array([v for _, v in rows])
    unit = wide / np.sqrt((wide * wide).sum(1, keepdims=True))
    keys = np.array([k for k, _ in rows])
    sims = unit @ unit.T
    np.fill_diagonal(sims, -2)
    linked = {r["vec_id"]: r["n_links"] for r in _run("op2_hnsw_near_duplicates", spark, sf_dir)}
    assert linked == {int(k): int(n) for k, n in zip(keys, (sims >= 0.95).sum(1))}
    found = _run("op7_robust_graph_search", spark, sf_dir)
    hits = 0
    for i in np.flatnonzero(keys % 50 == 0):
        best = set(keys[np.argsort(-sims[i])[:5]].tolist())
        hits += len(best & {r["vec_id"] for r in found if r["query_id"] == keys[i]})
    assert hits >= 0.9 * len(found) and len(found) == 5 * (keys % 50 == 0).sum()


def test_quality_learns_and_takes_odd_rows(spark, odd):
    good = [(i, f"the plain words of text {i} go on and on to the end of it", 1) for i in range(60)]
    bad = [(i, "CLICK!! NOW!! " * 5 + f"${i}$$ |", 0) for i in range(60, 120)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in good + bad] + [(None, 1, "x"), (3, None, "x"), (999, 0, "x"), (4, 7, "x")], "doc_id long, quality int, text string")
    model = quality.fit(docs, labels.filter(~quality.held_out(F.col("doc_id"))))
    rows = quality.score(docs, model).join(labels.filter("quality in (0, 1)").select("doc_id", "quality"), "doc_id").collect()
    assert all((r["score"] > 0.5) == (r["quality"] == 1) for r in rows)
    scored = quality.score(odd, model)
    assert scored.columns == [c for c in odd.columns if c != "score"] + ["score"] and scored.count() == odd.count()
    assert all(0 <= r["score"] <= 1 for r in scored.collect())
    empty = {r["score"] for r in scored.filter("text is null or trim(text) = ''").collect()}
    assert len(empty) <= 2
    none = quality.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(odd.limit(0), model).count() == 0


def test_rows_that_share_a_key_or_have_none_are_learned_from_by_rule(spark):
    rows = [(1, f"good text number {i} of many") for i in range(40)] + [(2, f"bad bad {i} bad") for i in range(40)] + [(None, "no key")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    settings = quality.Settings(buckets=64, dims=3, epochs=1)
    models = [quality.fit(docs.repartition(n).orderBy(F.rand(n)), labels, settings, sample_rows=10) for n in (2, 5)]
    assert (models[0] == models[1]).all() and models[0].any()
    held = {r["doc_id"]: r["h"] for r in docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("h")).distinct().collect()}
    assert held == {None: True} | {k: zlib.crc32(str(k).encode()) % 5 == 0 for k in (1, 2)}


def _features_by_hand(text, settings):
    """Bucket numbers of a text's words, repeats and character n-grams, one by one."""
    one = lambda part: int(text_hash.range_hashes(text_hash.prefix_hashes(np.frombuffer(part, np.uint8)), np.array([0]), np.array([len(part)]))[0])
    words = [one(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", text.encode())]
    found = [w % settings.buckets for w in words]
    found += [quality._REPEAT % settings.buckets for a, b in zip(words, words[1:]) if a == b]
    characters = ["_" if c in " \t\n\x0b\x0c\r" else c for c in text.replace("_", "\0")]
    for n in settings.char_ngrams:
        for i in range(len(characters) - n + 1):
            if "_" in characters[i + 1 : i + n - 1]:
                continue
            value = n
            for c in characters[i : i + n]:
                code = 32 if c == "_" else ord("_") if c == "\0" else int.from_bytes(c.encode(), "big")
                value = (value + code) * 0x9E3779B97F4A7C15 % 2**64
                value ^= value >> 29
            found.append(int(text_hash.mix(np.array([value], np.uint64))[0]) % settings.buckets)
    return found


def test_quality_features_and_scores_by_hand(spark):
    settings = quality.Settings()
    texts = ["", " \n", "a", "go go go\tgone", "Ünï — 日本語 x_y\n\nword word", "one two three\r\nfour " * 20, None, "no border\x0bhere"]
    model = np.random.default_rng(5).normal(size=settings.buckets + 1).astype(np.float32)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    for i, text in enumerate(texts):
        found = _features_by_hand(text or "", settings)
        total = float(model[settings.buckets]) + sum(float(model[b]) for b in found)
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-total / (1 + len(found))))), text


def test_quality_training_follows_the_gradient():
    settings = quality.Settings(buckets=6, dims=3, epochs=1, rate=1e-4)
    bags = [(1, np.array([0, 2, 6], np.uint32), np.array([0.5, 0.25, 0.25], np.float32))]
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1 / 3, 1 / 3, (7, 3))
    # One step from an output of zeros: the log odds move along half of the mean vector of the document.
    hidden = bags[0][2] @ vectors[bags[0][1]]
    assert quality.train(bags, settings) == pytest.approx(vectors @ hidden * settings.rate, rel=1e-3)


def test_quality_holds_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = QUERIES["op8_subword_quality"][0](spark, sf_dir).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95


def _grams(words, order):
    return Counter(tuple(words[i - n + 1 : i + 1]) for i in range(len(words)) for n in range(1, order + 1) if i >= n - 1)


def _backoff_by_hand(words, every, own, order):
    """(sum of log scores, steps back) of one document, gram by gram."""
    held = lambda gram: every[gram] - own[gram]
    others = sum(n for g, n in every.items() if len(g) == 1) - len(words)
    score, steps = 0.0, 0
    for i in range(len(words)):
        for n in range(min(order, i + 1), 0, -1):
            gram = tuple(words[i - n + 1 : i + 1])
            if held(gram):
                score += math.log(held(gram) / (held(gram[:-1]) if n > 1 else others))
                break
            steps += 1
        else:
            score -= math.log(max(others, 1))
    return score + steps * math.log(0.4), steps


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_backoff_of_odd_rows(odd, order):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    words = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for _, t in rows]
    owns = [_grams(w, order) for w in words]
    every = sum(owns, Counter())
    expected = []
    for (key, _), own_words, own in zip(rows, words, owns):
        score, steps = _backoff_by_hand(own_words, every, own, order)
        expected.append((key, len(own_words), steps, round(score / len(own_words), 6) if own_words else None))
    scored = backoff.backoff_scores(odd, order=order).collect()
    found = [(r["doc_id"], r["n_words"], r["n_backed_off"], None if r["score"] is None else round(r["score"], 6)) for r in scored]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_backoff_of_few_documents(spark, odd):
    assert backoff.backoff_scores(odd.limit(0)).count() == 0
    alone = spark.createDataFrame([(1, "a b a b")], "doc_id long, text string")
    # No other words: each of four words takes all its steps, over one.
    [row] = backoff.backoff_scores(alone).collect()
    assert (row["n_words"], row["n_backed_off"]) == (4, 1 + 2 + 3 + 3)
    assert row["score"] == pytest.approx(9 / 4 * math.log(0.4))


def test_backoff_does_not_depend_on_blocks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = sorted(map(tuple, backoff.backoff_scores(docs).select("doc_id", "n_words", "n_backed_off", F.round("score", 9)).collect()))
    cut = sorted(map(tuple, backoff.backoff_scores(docs.repartition(7, "doc_id").sortWithinPartitions("doc_id")).select("doc_id", "n_words", "n_backed_off", F.round("score", 9)).collect()))
    assert whole == cut


@pytest.mark.parametrize("width, n", [(1, 1), (7, 1), (1 << 20, 3), (1 << 52, 1), (1 << 40, 1000), (3000, 2999), ((1 << 47) + 5, 777), ((1 << 62) + 11, 50)])
def test_packed_numbers_come_back(width, n):
    drawn = np.random.default_rng(n).integers(0, width, n, dtype=np.uint64)
    values = np.unique(np.concatenate([drawn, np.array([width - 1], np.uint64)]))
    assert (backoff.unpack_sorted(backoff.pack_sorted(values, width), len(values), width) == values).all()
    counts = (values % np.uint64(70_000)).astype(np.int64)
    assert (backoff.unpack_counts(backoff.pack_counts(counts), len(counts)) == counts).all()


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            ("a", "user", '{"words": 20, "prompt": "hi", "zeta": [1, {"b": 1, "a": 2}]}', None, 1),
            ("b", "user", '{"words": 5, "prompt": "x"}', "a", 1),
            ("c", "user", '{"words": "20"}', "b", 1),
            ("d", "nope", "[1]", "gone", 1),
            ("e", "user", "no json", "f", 1),
            ("f", "system", '{"prompt": null}', "e", 1),
            ("g", "system", '{"prompt": "p"}', "f", 1),
            (None, "system", '{"prompt": "p"}', None, 1),
            ("a", "user", '{"words": 20, "prompt": "hi", "zeta": [1, {"b": 1, "a": 2}]}', None, 2),
            ("h", None, None, None, 1),
            ("i", None, "{}", "a", 1),
            ("b", "user", '{"words": 50, "prompt": "y"}', None, 3),
            ("b", "user", '{"words": 50, "prompt": "y"}', None, 4),
            ("b", "zzz", None, None, 5),
        ],
        "call_id string, name string, arguments string, depends_on string, place int",
    )
    results = spark.createDataFrame(
        [("a", 2, 'say "so"\n'), ("a", 3, None), ("b", 4, "é"), ("x", 5, "lost"), (None, 6, "none"), ("b", 4, "é")],
        "call_id string, place long, content string",
    )
    rows = tool_calls.link_tool_calls(calls, results, TOOLS).collect()
    found = sorted(((r["call_id"], r["place"], r["depth"], r["problems"]) for r in rows if r["call_id"] not in (None, "h")), key=str)
    expected = [
        ("a", 2, 0, ""), ("a", 3, 0, ""), ("b", 4, 1, "words: too small"), ("b", 4, 1, "words: too small"),
        ("c", None, 2, "prompt: missing; words: no integer"), ("d", None, 0, "arguments are no object; unknown tool"),
        ("i", None, 1, "unknown tool"), ("b", None, None, "id of another call"),
        ("b", None, None, "arguments are no object; unknown tool; id of another call"),
        ("e", None, None, "arguments are no object"), ("f", None, None, "prompt: missing"), ("g", None, None, ""), ("x", 5, None, None),
    ]
    assert found == sorted(expected, key=str)
    message = next(r["message"] for r in rows if r["place"] == 2)
    assert message == '{"arguments":{"prompt":"hi","words":20,"zeta":[1,{"a":2,"b":1}]},"content":"say \\"so\\"\\n","id":"a","name":"user","valid":true}'
    assert sum(r["call_id"] is None for r in rows) == 2
    assert tool_calls.link_tool_calls(calls.limit(0), results.limit(0), TOOLS).count() == 0


def _depths_by_hand(ids, edges):
    """The longest way down from each id; None for those that reach a circle."""
    above = {i: {b for a, b in edges if a == i and b in ids} for i in ids}
    known = {}
    while True:
        new = {i: 1 + max((known[b] for b in above[i]), default=-1) for i in ids if i not in known and above[i] <= known.keys()}
        if not new:
            return {i: known.get(i) for i in ids}
        known |= new


@pytest.mark.parametrize("seed, calls, edges", [(2, 40, 80), (3, 25, 60)])
def test_depths_with_several_dependencies(spark, seed, calls, edges):
    draw = np.random.default_rng(seed)
    ids = [f"c{i:02}" for i in range(calls)]
    # Mostly from later to earlier; a few the other way make circles.
    pairs = [tuple(sorted(draw.choice(calls, 2, replace=False), reverse=bool(k >= 2 or seed % 2))) for k in range(edges)]
    own = {ids[a]: ids[b] for a, b in pairs[: edges // 2]}
    more = [(ids[a], ids[b]) for a, b in pairs[edges // 2 :]]
    more += [more[0], (ids[3], None), (None, ids[3]), (ids[4], "gone"), ("gone", ids[4])]
    given = spark.createDataFrame([(i, own.get(i)) for i in ids], "call_id string, depends_on string")
    needs = spark.createDataFrame(more, "call_id string, depends_on string")
    found = {r["call_id"]: r["depth"] for r in tool_calls.call_depths(given, needs).collect()}
    assert found == _depths_by_hand(set(ids), [*own.items(), *more])
    alone = {r["call_id"]: r["depth"] for r in tool_calls.call_depths(given, needs.limit(0)).collect()}
    assert alone == {r["call_id"]: r["depth"] for r in tool_calls.call_depths(given).collect()} == _depths_by_hand(set(ids), own.items())


def test_depth_of_a_long_chain_with_a_meeting(spark):
    n = 300
    given = spark.createDataFrame([(str(i), str(i - 1)) for i in range(n)], "call_id string, depends_on string")
    needs = spark.createDataFrame([("200", "7")], "call_id string, depends_on string")
    assert {r["call_id"]: r["depth"] for r in tool_calls.call_depths(given, needs).collect()} == {str(i): i for i in range(n)}


def test_turns_without_a_role_are_calls_of_an_unknown_tool(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    rows = [(1, 0, "system", "be kind"), (1, 1, None, "hello there"), (1, 2, "user", "one two three four five six seven eight nine ten"), (1, 3, "assistant", "yes"), (2, 0, None, "x"), (2, 1, "assistant", None)]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(path)
    run, sql = QUERIES["op5_tool_call_links"]
    found = run(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{path}/*.parquet'")
    expected = con.execute(f"select {', '.join(found.columns)} from ({sql.strip()})").fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert sum("unknown tool" in (r["problems"] or "") for r in found.collect()) == 2
