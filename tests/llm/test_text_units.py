"""The numpy parts by themselves: hashes, tokens, codes, packing, graphs, rules."""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from joulemart.llm import graph_search, graphs, huffman_files, licenses, near_vectors, packing, text_hash, tokens
from tests.llm.edge_rows import lower, shingles

TEXTS = [
    "", None, " ", "a", "A b\tc", "The end.The end", "x" * 70_000, "don't y'all're ''s it's", "é É ß Ünder… «ça» 12.5 a1b2",
    "mixed…!a ×÷ ſt ﬁ İI", "é combining", "日本語 テキスト", "a b c\u0085d", "-- ?!;", "<|endoftext|>x",
]


def _batch():
    return pa.RecordBatch.from_pydict({"text": pa.array(TEXTS, pa.string())})


def test_ids_equal_those_of_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    found = []
    for _, ids, offsets in tokens.encoded_rows(iter([_batch(), _batch()]), path, 7):
        found += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    expected = [plain.encode(t or "", add_special_tokens=False).ids + [7] for t in TEXTS]
    assert tokens.encoder(path).by_units and found == expected * 2


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    (_, ids, offsets), = tokens.encoded_rows(iter([_batch()]), path, 1)
    assert not tokens.encoder(path).by_units
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain.encode(t or "", add_special_tokens=False).ids + [1] for t in TEXTS]


@pytest.mark.parametrize("chunk", [1, 16, 1 << 21])
def test_shingle_sets_have_the_right_sizes_and_overlaps(monkeypatch, chunk):
    monkeypatch.setattr(text_hash, "CHUNK_BYTES", chunk)
    texts = [*TEXTS, "one two three four five six", "ONE two three four five seven", "one two"]
    found = []
    for _, data, offsets in text_hash.text_chunks(pa.RecordBatch.from_pydict({"text": pa.array(texts)})):
        hashes, bounds = text_hash.shingle_sets(data, offsets, 4)
        found += [set(hashes[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
    expected = [shingles(t, 4) for t in texts]
    for i, a in enumerate(expected):
        for j, b in enumerate(expected):
            assert len(found[i] & found[j]) == len(a & b)


@pytest.mark.parametrize("counts", [[5], [1, 1], [1, 2, 4, 8, 16, 32, 64], list(range(1, 200)), [10**9] + [1] * 40])
def test_code_lengths_fit_and_are_best(counts):
    counts = np.array(counts)
    free, tight = huffman_files.code_lengths(counts, 40), huffman_files.code_lengths(counts, 8)
    assert (2.0 ** -free).sum() <= 1 and (2.0 ** -tight).sum() <= 1
    assert tight.max() <= max(8, int(np.ceil(np.log2(len(counts)))))
    heap = sorted(counts.tolist())
    cost = 0
    while len(heap) > 1:
        a, b = heap.pop(0), heap.pop(0)
        cost += a + b
        heap = sorted([*heap, a + b])
    if len(counts) > 1:
        assert (free * counts).sum() == cost


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 5000])
def test_codes_round_trip(size):
    random = np.random.default_rng(size)
    ids = np.minimum(random.zipf(1.3, size), 40_000).astype(np.int64)
    known, counts = np.unique(np.append(ids, [3, 49_000]), return_counts=True)
    code = huffman_files.Code(known, huffman_files.code_lengths(counts))
    bits, checkpoints = code.encode(ids)
    assert code.decode(bits, checkpoints, size).tolist() == ids.tolist()


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_keeps_every_constraint(rule):
    lengths = np.random.default_rng(1).integers(1, 101, 800)
    capacity = packing.Capacity(100, documents=5, attention=6_000, rule=rule)
    with pytest.raises(ValueError):
        packing.best_fit(lengths, capacity)
    lengths = np.minimum(lengths, 77)
    bins, places, made = packing.best_fit(lengths, capacity)
    for b in range(made):
        own = np.flatnonzero(bins == b)
        own = own[np.argsort(places[own])]
        assert len(own) <= 5 and lengths[own].sum() <= 100 and (lengths[own] ** 2).sum() <= 6_000
        assert places[own].tolist() == (np.cumsum(lengths[own]) - lengths[own]).tolist()
    small = np.random.default_rng(3).integers(1, 51, 800)
    _, _, few = packing.best_fit(small, packing.Capacity(100, rule=rule))
    assert few <= np.ceil(small.sum() / 100) * 1.02 + 1


def test_graphs_find_neighbours():
    random = np.random.default_rng(2)
    centres = random.normal(size=(40, 24))
    vectors = np.concatenate([centres[random.integers(0, 40, 1500)] + random.normal(size=(1500, 24)) * 0.05, random.normal(size=(1500, 24))])
    unit = graphs.unit_rows(vectors.astype(np.float32))
    sims = unit @ unit.T
    layered = near_vectors.LayeredGraph.build(unit)
    found = layered.near(unit, 0.95, layered.audited_width(0.95))
    assert sum(len(f) for f in found) >= 0.999 * (sims >= 0.95).sum()
    edges, starts = graph_search.build_graph(unit)
    nodes, _ = graph_search.search_graph(unit, edges, starts, unit[::30])
    best = np.argsort(-sims[::30], 1)[:, :5]
    assert np.mean([len(set(a) & set(b[:10].tolist())) / 5 for a, b in zip(best, nodes)]) >= 0.9


def _cut(unit, nodes):
    """A graph in which no link leads to some nodes."""
    layered = near_vectors.LayeredGraph.build(unit)
    for edges in layered.layers:
        edges[np.isin(edges, nodes)] = -1
    return layered


def _found_pairs(layered, unit, width):
    return [sorted(f.tolist()) for f in layered.near(unit, 0.95, width)]


def test_lost_links_of_small_groups_are_noticed_beside_a_large_one():
    random = np.random.default_rng(4)
    family = random.normal(size=24) + random.normal(size=(1000, 24)) * 0.05
    pairs = random.normal(size=(300, 24))
    lone = random.normal(size=(1400, 24))
    unit = graphs.unit_rows(np.concatenate([family, pairs, pairs + random.normal(size=pairs.shape) * 0.05, lone]).astype(np.float32))
    # No path leads to the second vector of any pair.
    layered = _cut(unit, np.arange(1300, 1600))
    truth = [sorted(np.flatnonzero(row >= 0.95).tolist()) for row in unit @ unit.T]
    assert _found_pairs(layered, unit, layered.audited_width(0.95)) == truth


def test_audit_sees_rare_pairs_and_queries_of_other_shards(monkeypatch):
    random = np.random.default_rng(5)
    unit = graphs.unit_rows(random.normal(size=(2500, 24)).astype(np.float32))
    layered = _cut(unit, np.arange(1, 2500, 2))
    monkeypatch.setattr(layered, "strays", np.zeros(0, np.int64), raising=False)
    # No vector has a partner in its own shard; half of the nodes cannot be found.
    assert layered.audited_width(0.95) == len(unit)
    others = graphs.unit_rows(unit[1::2] + random.normal(size=(1250, 24)).astype(np.float32) * 0.01)
    width = layered.audited_width(0.95, others, np.full(len(others), -1))
    assert [f.tolist() for f in layered.near(others, 0.95, width)] == [[i] for i in range(1, 2500, 2)]


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_small_graphs(n):
    unit = graphs.unit_rows(np.eye(8, dtype=np.float32)[:n] + 0.1) if n else np.zeros((0, 8), np.float32)
    edges, starts = graph_search.build_graph(unit)
    assert edges.shape[0] == n and len(starts) == n
    if n:
        assert (graph_search.search_graph(unit, edges, starts, unit)[0][:, 0] == np.arange(n)).all()


def test_there_are_hundreds_of_rules():
    assert len(licenses.rules()) >= 450
    assert all(rule.keywords for rule in licenses.rules())
    for text in ["permission is hereby granted, free of charge", "provided \"as is\"", "do what the fuck you want to public license",
                 "redistribution and use in source and binary forms", "no commercial use", "the unlicense"]:
        assert licenses.detect(text), text


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under the MIT License.", ["licensed", "mit"]),
        ("Apache License, Version 2.0", ["apache-2.0"]),
        ("apache license", ["apache"]),
        ("GNU Lesser General Public License v2.1", ["gpl", "lgpl-2.1"]),
        ("SPDX-License-Identifier: GPL-3.0", ["gpl-3"]),
        ("CC BY-NC-SA 4.0", ["cc-by", "cc-by-nc-sa-4.0"]),
        ("creativecommons.org/licenses/by/4.0", ["cc-by-4.0"]),
        ("accc by all", []),
        ("mit der lizenz", []),
    ],
)
def test_wide_and_strong_rules_suppress_others(text, labels):
    assert sorted({r.label for r, _, _ in licenses.detect(lower(text))}) == labels


def test_detections_that_stay_do_not_overlap():
    text = lower("licensed under the gnu general public license version 3 or cc by-nc-nd 4.0, all rights reserved. " * 50)
    found = [(s, e) for r, s, e in licenses.detect(text) if not r.base]
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    assert sum(r.base for r, _, _ in licenses.detect(text)) == 150
    assert re.findall("cc by", text)


def _sentences():
    """For each sentence pattern its shortest match with first choices, and its longest with last ones."""
    for _, patterns in licenses._SENTENCES:
        for pattern in patterns:
            for pick in (0, -1):
                text = re.sub(r"\[(\w)\w*\]", r"\1", pattern).replace("\\d", "3").replace("_", "-" if pick else "")
                while "(" in text:
                    text = re.sub(r"\(\?:([^()]*)\)(\?)?", lambda m: "" if m[2] and not pick else m[1].split("|")[pick], text)
                yield re.sub(r"(\w)\?", r"\1" if pick else "", text)


def _license_texts():
    """Short names, and notices broken over lines as in wrapped headers."""
    names = [name for _, found, _, _ in licenses._FAMILIES for name in found]
    names += [f"{name} {'.' if i % 2 else ''} version {v}" for _, found, versions, _ in licenses._FAMILIES for name in found for i, v in enumerate(versions)]
    names += [f"spdx-license-identifier: {short}-{v}" for _, _, versions, short in licenses._FAMILIES for v in (*versions, "")]
    for code, name in licenses._CREATIVE.items():
        names += [f"cc {code}", f"creative commons {name}"]
        for version in licenses._CREATIVE_VERSIONS:
            names += [f"cc {code} {version}", f"cc {code} {version.replace('.', '-')}", f"creative commons {name} international {version}"]
            names += [f"creative commons {name} {version.replace('.', ' ')}", f"creativecommons.org/licenses/{code.replace(' ', '-')}/{version}"]
    notices = [
        "copyright (c) 1999", "© 2020", "copyright holders", "some rights reserved", "proprietary and confidential", "proprietary material",
        "may not be reproduced", "may not be copied", "may not be redistributed", "no part of this book", "no part of this work",
        "into the public domain", "dedicated to the public domain", "permission is hereby granted, free of charge",
        "redistribution and use in source and binary forms", "permission to use, copy, modify, and distribute", "provided as is",
        "provided by the holders and contributors \"as is\"", "without any warranty", "without warranties",
        "free software; you can redistribute it and/or modify", "noncommercial use only", "for non-commercial purposes only", "no commercial use",
        "licensed under", "licenced under", "released under", "distributed under", "available under", "published under",
    ]
    for text in [*names, *notices, *_sentences(), *licenses.BASE_PHRASES]:
        yield text
        yield text.replace(" ", "\n")
        yield text.replace(" ", "  \r\n * ")


def test_no_gate_loses_a_match():
    patterns = [(rule, pattern) for rule, _, pattern in licenses._compiled()]
    met = set()
    for text in _license_texts():
        matches = [(rule, m.start(), m.end()) for rule, pattern in patterns for m in pattern.finditer(text)]
        met.update(rule for rule, _, _ in matches)
        assert licenses.detect(text) == licenses.resolve(matches), text
    assert met == set(licenses.rules())


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("wtfpl", "wtfpl"),
        ("gfdl", "gfdl"),
        ("creative commons zero", "cc0"),
        ("creative commons attribution 4.0", "cc-by-4.0"),
        ("public\ndomain: dedicated\nto the public\ndomain", "public-domain"),
        ("permission\n# is hereby\n# granted, free of charge", "permissive"),
        ("may not be copied", "proprietary"),
        ("noncommercial use only", "noncommercial"),
        ("provided by the holders\nand others \"as\nis\"", "no-warranty"),
    ],
)
def test_short_names_and_wrapped_notices_are_found(text, label):
    assert label in {r.label for r, _, _ in licenses.detect(text)}


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        (
            """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
            with the License. You may obtain a copy of the License at the address below. Unless required by applicable law or agreed to
            in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
            OF ANY KIND, either express or implied. See the License for the specific language governing permissions.""",
            {"licensed", "apache-2.0", "apache-text"},
        ),
        (
            """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
            Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
            later version. It is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
            warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
            {"copyleft", "gpl", "gpl-text"},
        ),
        (
            """Permission is hereby granted, free of charge, to any person obtaining a copy, to deal in the Software without
            restriction. The above copyright notice and this permission notice shall be included in all copies or substantial portions
            of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.""",
            {"permissive", "mit-text", "no-warranty"},
        ),
        (
            """Redistribution and use in source and binary forms, with or without modification, are permitted provided that:
            Redistributions of source code must retain the above copyright notice. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS
            "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES are disclaimed.""",
            {"permissive", "bsd-text", "no-warranty"},
        ),
        ("No derivative works. For personal use only, not for commercial purposes.", {"no-derivatives", "noncommercial"}),
        ("She was licensed to drive, free to use the garden, and granted a wish by the public library.", set()),
        ("The software team is in the office; the terms of the sale were agreed in writing.", set()),
    ],
)
def test_labels_of_whole_notices(text, labels):
    assert {r.label for r, _, _ in licenses.detect(lower(text))} == labels
