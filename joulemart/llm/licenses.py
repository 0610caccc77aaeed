"""License and rights notices found by ordered signature rules.

A rule is a regular expression with a label, a priority and keywords: for names and versions of licenses, sentences of their
texts, and wordings of rights. It is tried on a text only if the
text has all its keywords; they are parts of single words that every match holds, so that none is lost. Of overlapping detections, one inside another of the same or a higher priority
goes; so does one that partly overlaps another of a higher priority. Base phrases always stay.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulemart.llm import text_hash

_GAP = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_WORD = r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]"
_WORDS = re.compile(_WORD + "+")
#: Bytes that end a word, after lower-casing.
_OUTSIDE = ~text_hash.byte_table(bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256)))

#: Phrases whose places are counted, and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Licenses by family, as (label, names, versions or none, short identifier).
_CREATIVE = {
    "by": "attribution",
    "by sa": "attribution sharealike",
    "by nc": "attribution noncommercial",
    "by nd": "attribution noderivatives",
    "by nc sa": "attribution noncommercial sharealike",
    "by nc nd": "attribution noncommercial noderivatives",
}
_CREATIVE_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
_FAMILIES = (
    ("gpl", ("gnu general public license", "gnu gpl", "gpl"), ("1", "2", "3"), "gpl"),
    ("lgpl", ("gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"), ("2", "2.1", "3"), "lgpl"),
    ("agpl", ("gnu affero general public license", "affero general public license", "gnu agpl", "agpl"), ("1", "3"), "agpl"),
    ("gfdl", ("gnu free documentation license", "gfdl"), ("1.1", "1.2", "1.3"), "gfdl"),
    ("apache", ("apache license", "apache software license"), ("1.0", "1.1", "2.0"), "apache"),
    ("mpl", ("mozilla public license", "mpl"), ("1.0", "1.1", "2.0"), "mpl"),
    ("epl", ("eclipse public license",), ("1.0", "2.0"), "epl"),
    ("eupl", ("european union public licence", "eupl"), ("1.0", "1.1", "1.2"), "eupl"),
    ("cddl", ("common development and distribution license", "cddl"), ("1.0", "1.1"), "cddl"),
    ("afl", ("academic free license",), ("1.1", "1.2", "2.0", "2.1", "3.0"), "afl"),
    ("osl", ("open software license",), ("1.0", "1.1", "2.0", "2.1", "3.0"), "osl"),
    ("artistic", ("artistic license",), ("1.0", "2.0"), "artistic"),
    ("ofl", ("sil open font license", "open font license"), ("1.0", "1.1"), "ofl"),
    ("lppl", ("latex project public license",), ("1.0", "1.1", "1.2", "1.3"), "lppl"),
    ("zpl", ("zope public license",), ("1.1", "2.0", "2.1"), "zpl"),
    ("boost", ("boost software license",), ("1.0",), "bsl"),
    ("odbl", ("open database license", "odbl"), ("1.0",), "odbl"),
    ("odc-by", ("open data commons attribution license",), ("1.0",), "odc by"),
    ("bsd", ("bsd license", "berkeley software distribution license"), (), "bsd"),
    ("bsd-2", ("bsd 2 clause", "2 clause bsd", "simplified bsd license", "freebsd license"), (), "bsd 2 clause"),
    ("bsd-3", ("bsd 3 clause", "3 clause bsd", "new bsd license", "modified bsd license"), (), "bsd 3 clause"),
    ("bsd-4", ("bsd 4 clause", "4 clause bsd", "original bsd license"), (), "bsd 4 clause"),
    ("mit", ("mit license", "mit licence", "expat license", "x11 license"), (), "mit"),
    ("isc", ("isc license", "isc licence"), (), "isc"),
    ("zlib", ("zlib license", "zlib libpng license"), (), "zlib"),
    ("unlicense", ("the unlicense",), (), "unlicense"),
    ("wtfpl", ("do what the fuck you want to public license", "wtfpl"), (), "wtfpl"),
    ("cc0", ("cc0", "creative commons zero", "cc zero"), (), "cc0"),
    ("pddl", ("public domain dedication and license",), (), "pddl"),
    ("python", ("python software foundation license", "psf license"), (), "psf"),
    ("php", ("php license",), (), "php"),
    ("ruby", ("ruby license",), (), "ruby"),
    ("postgresql", ("postgresql license",), (), "postgresql"),
    ("ncsa", ("university of illinois open source license",), (), "ncsa"),
    ("ms-pl", ("microsoft public license",), (), "ms pl"),
    ("ms-rl", ("microsoft reciprocal license",), (), "ms rl"),
)
# Wordings of rights and grants, as (label, priority, keywords, pattern over words). In patterns
# a blank is any gap between words, and "_" one that may be missing.
_NOTICES = (
    ("copyright", 10, ("copyright",), r"copyright (?:c )?(?:1[89]|20)\d\d"),
    ("copyright", 10, ("©",), r"©\s*(?:1[89]|20)\d\d"),
    ("copyright", 8, ("copyright",), r"copyright (?:holder|owner|notice|law|act|protected|reserved)s?"),
    ("reserved", 20, ("reserved", "rights"), r"(?:all|some|no) rights reserved"),
    ("proprietary", 20, ("proprietary", "confidential"), r"proprietary (?:and|or) confidential"),
    ("proprietary", 20, ("proprietary",), r"proprietary (?:information|software|license|material)"),
    ("proprietary", 20, ("reproduced|copied|redistributed", "may", "not"), r"may not be (?:reproduced|copied|redistributed)"),
    ("proprietary", 20, ("part", "work|book|publication|document", "this"), r"no part of this (?:work|book|publication|document)"),
    ("public-domain", 30, ("domain", "public"), r"(?:in|into|to) the public domain"),
    ("public-domain", 30, ("dedicated", "domain", "public"), r"dedicated to the public domain"),
    ("permissive", 30, ("hereby", "permission", "granted", "charge"), r"permission is hereby granted free of charge"),
    ("permissive", 30, ("redistribution", "binary", "forms"), r"redistribution and use in source and binary forms"),
    ("permissive", 30, ("permission", "modify", "distribute"), r"permission to use copy modify and(?: or)? distribute"),
    ("no-warranty", 15, ("provided", "as", "is"), r"provided (?:by (?s:.){0,80}? )?as is"),
    ("no-warranty", 15, ("warrant", "without"), r"without (?:any )?warrant(?:y|ies)"),
    ("copyleft", 25, ("redistribute", "software", "modify"), r"free software you can redistribute it and or modify"),
    ("noncommercial", 25, ("commercial", "only"), r"(?:for )?non_commercial (?:use|purposes?) only"),
    ("noncommercial", 25, ("commercial", "use"), r"no commercial use"),
    ("licensed", 5, ("under", "licensed|licenced|released|distributed|available|published"), r"(?:licen[cs]ed|released|distributed|available|published) under"),
)

# Sentences of license texts, notices and terms, as (label, patterns over words) written as in _NOTICES.
# Words outside of brackets are in every match.
_SENTENCES = (
    ("mit-text", (
        "to deal in the software without restriction",
        "rights to use copy modify merge publish distribute sublicense and or sell",
        "permit persons to whom the software is furnished to do so",
        "(?:above|this) copyright notice and this permission notice shall be included",
        "in all copies or substantial portions of the (?:software|materials?|documentation)",
        "in no event shall the authors or copyright holders be liable",
        "arising from out of or in connection with the software",
    )),
    ("bsd-text", (
        "redistributions of source code must retain the (?:above )?copyright",
        "redistributions in binary form must reproduce the (?:above )?copyright",
        "with or without modification are permitted provided that",
        "may be used to endorse or promote products derived from",
        "all advertising materials mentioning features or use of this software",
        "this software is provided by the (?:copyright holders?|authors?|regents|contributors)",
        "procurement of substitute goods or services",
        "however caused and on any theory of liability",
    )),
    ("isc-text", (
        "for any purpose with or without fee is hereby granted",
        "the author disclaims all warranties with regard to this software",
        "resulting from loss of use data or profits",
    )),
    ("apache-text", (
        "you may not use this (?:file|work|software) except in compliance with the license",
        "you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing",
        "(?:distributed|provided) on an as is basis",
        "without warranties or conditions of any kind",
        "see the license for the specific language governing permissions",
        "perpetual worldwide non_exclusive no_charge royalty_free irrevocable (?:copyright|patent) license",
        "licensed to the apache software foundation",
        "terms and conditions for use reproduction and distribution",
        "each contributor hereby grants to you a",
    )),
    ("gpl-text", (
        "under the terms of the gnu (?:lesser |library |affero )?general public licen[cs]e",
        "as published by the free software foundation",
        "either version \\d of the license or at your option any later version",
        "in the hope that it will be useful but without any warranty",
        "implied warranty of merchantability or fitness for a particular purpose",
        "you should have received a copy of the gnu",
        "write to the free software foundation",
        "everyone is permitted to copy and distribute verbatim copies",
        "changing it is not allowed",
        "this program comes with absolutely no warranty",
        "corresponding source for a work",
        "convey(?:ing)? (?:a )?covered works?",
        "a work based on the (?:program|library)",
    )),
    ("mpl-text", (
        "this source code form is subject to the terms of the mozilla",
        "if a copy of the mpl was not distributed with this file",
        "this source code form is incompatible with secondary licenses",
        "the contents of this file are subject to the mozilla",
    )),
    ("epl-text", (
        "this program and the accompanying materials are made available under",
        "accompanies this distribution and is available at",
        "any use reproduction or distribution of the program constitutes",
    )),
    ("zlib-text", (
        "the origin of this software must not be misrepresented",
        "altered source versions must be plainly marked as such",
        "may not be removed or altered from any source distribution",
        "in no event will the authors be held liable for any damages",
    )),
    ("boost-text", (
        "distributed under the boost software license",
        "machine executable object code generated by a source language processor",
    )),
    ("unlicense-text", (
        "this is free and unencumbered software",
        "anyone is free to copy modify publish use compile sell or distribute",
        "overt act of relinquishment in perpetuity",
    )),
    ("cc0-text", (
        "waived all copyright and related (?:or|and) neighboring rights",
        "to the extent possible under law",
        "affirmer (?:hereby )?overtly fully permanently irrevocably and unconditionally waives",
        "no copyright the person who associated a work",
    )),
    ("cc-text", (
        "licensed under (?:a|the) creative commons",
        "this work is licensed under a creative",
        "you are free to share copy and redistribute the material",
        "you must give appropriate credit provide a link to the license",
        "you may not use the material for commercial purposes",
        "you must distribute your contributions under the same license",
        "if you remix transform or build upon the material",
        "no additional restrictions you may not apply legal terms",
    )),
    ("ofl-text", (
        "this font software is licensed under",
        "reserved font names?",
        "neither the font software nor any of its individual components",
    )),
    ("artistic-text", (
        "you may copy and distribute the standard version",
        "the package may be (?:freely )?(?:distributed|redistributed) under",
    )),
    ("wtfpl-text", ("you just do what the fuck you want to",)),
    ("see-license", (
        "under the same terms as (?:perl|python|ruby|php|r|the (?:kernel|library|project)) itself",
        "dual licensed under",
        "is (?:available|released|licensed) under (?:a|the) (?:dual|triple) licen[cs]e",
        "see the (?:file )?(?:licen[cs]e|copying|notice)(?: file)? for (?:details|more|copying|terms)",
        "for license (?:information|terms|details) (?:please )?see",
        "refer to the license for",
    )),
    ("proprietary", (
        "unauthorized (?:copying|reproduction|distribution|use) of this (?:file|material|work|software|document)",
        "strictly prohibited without (?:the )?(?:express |prior )?(?:written )?(?:consent|permission)",
        "without the (?:express |prior )?(?:prior )?written (?:consent|permission) of",
        "contains (?:confidential and proprietary|proprietary and confidential|trade secret)",
        "stored in a retrieval system or transmitted in any form",
        "for internal use only",
        "this software is the confidential and proprietary information of",
        "you shall not disclose such confidential information",
        "reverse engineer decompile or disassemble",
        "is licensed not sold",
        "by (?:installing|downloading|using) (?:or (?:installing|downloading|using) )?(?:this|the) software you (?:agree|accept)",
        "end user licen[cs]e agreement",
        "this is an unpublished work",
    )),
    ("reserved", (
        "all trademarks are the property of their respective owners",
        "(?:is|are) (?:a )?registered trademarks? of",
        "reproduced (?:here )?(?:with|by) (?:kind )?permission",
        "reprinted (?:with|by) (?:kind )?permission",
        "used (?:with|by) (?:kind )?permission of",
        "the moral rights? of the authors? (?:has|have) been asserted",
        "no unauthori[sz]ed (?:copying|reproduction|use)",
    )),
    ("noncommercial", (
        "for (?:personal|private|academic|educational|research)(?: and| or)? non_commercial use",
        "not (?:be used )?for commercial (?:use|purposes?)",
        "for (?:personal|academic|educational|research) (?:use|purposes?) only",
        "commercial use (?:is )?(?:not permitted|prohibited|forbidden)",
        "commercial use requires (?:a|prior|written)",
    )),
    ("no-derivatives", (
        "no derivative works",
        "you may not (?:alter|modify) transform or build upon this work",
        "you may not distribute the modified material",
    )),
    ("attribution", (
        "attribution (?:is )?required",
        "with attribution to the (?:original )?authors?",
        "provided (?:that )?the (?:original )?(?:source|authors?) (?:is|are) (?:credited|acknowledged|cited)",
        "provided the original work is properly cited",
    )),
    ("public-domain", (
        "placed (?:in|into) the public domain",
        "is (?:now )?in the public domain",
        "released (?:in|into|to) the public domain",
        "no known copyright restrictions",
        "the copyright (?:has|have) expired",
        "is a work of the united states government",
        "not subject to copyright protection",
    )),
    ("open-government", (
        "contains public sector information licensed under",
        "open government licen[cs]e",
        "crown copyright",
        "open parliament licen[cs]e",
    )),
    ("no-warranty", (
        "(?:disclaims|disclaim) all warranties",
        "without (?:any )?(?:express or implied )?warranty of any kind",
        "(?:use|used) at your own risk",
        "not (?:be )?liable for any direct indirect incidental",
        "any express or implied warranties",
    )),
)
_SENTENCE_PRIORITY = 35

@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    #: What every match holds: a part of a word each, or several with "|" between, of which it holds one.
    keywords: tuple[str, ...]
    pattern: str
    base: bool = False


def _in_every_match(pattern: str) -> tuple[str, ...]:
    """The words of a sentence's pattern that are in each of its matches: those outside of brackets and whole."""
    outside = re.sub(r"\[[^\]]*\]|\\\w", "?", pattern)
    while outside != (outside := re.sub(r"(\S*)\(\?:[^()]*\)\??(\S*)", lambda m: " " if not m[1] and not m[2] else f" {m[1]} ? {m[2]} ", outside)):
        pass
    return tuple(sorted({w for w in re.split(r"[ _]+", outside) if re.fullmatch(r"[a-z]{2,}", w)}))


def _over_words(pattern: str) -> str:
    return pattern.replace(" ", _GAP).replace("_", f"(?:{_GAP})?")


def _spaced(phrase: str) -> str:
    return _GAP.join(re.escape(word) for word in re.findall(r"[^\W_]+", phrase))


def _version(version: str) -> str:
    """A version after a name: "version 2.0", "v2", "2.0"; a closing .0 may be left out."""
    number = _GAP.join(version.removesuffix(".0").split(".")) + (rf"(?:{_GAP}0)?" if version.endswith(".0") or "." not in version else "")
    return rf"(?:{_GAP}version)?{_GAP}v?{number}"


def _family_rules() -> Iterator[Rule]:
    for label, names, versions, short in _FAMILIES:
        for i, name in enumerate(names):
            # Later names of a family are its short ones.
            yield Rule(label, 40 - i, tuple(name.split()), _spaced(name))
            for version in versions:
                yield Rule(f"{label}-{version}", 60 - i, (*name.split(), version[0]), _spaced(name) + _version(version))
        yield Rule(label, 70, ("spdx",), "spdx" + _GAP + _spaced(f"license identifier {short}"))
        for version in versions:
            yield Rule(f"{label}-{version}", 80, ("spdx", version[0]), "spdx" + _GAP + _spaced(f"license identifier {short}") + _version(version))
    for code, name in _CREATIVE.items():
        label = "cc-" + code.replace(" ", "-")
        size = len(code)  # longer codes hold shorter ones
        yield Rule(label, 40 + size, ("cc", *code.split()), _spaced(f"cc {code}"))
        yield Rule(label, 40 + size, ("commons", "creative", *name.split()), _spaced(f"creative commons {name}"))
        for version in _CREATIVE_VERSIONS:
            number = _spaced(version)
            yield Rule(f"{label}-{version}", 60 + size, ("cc", *code.split(), *version.split(".")), _spaced(f"cc {code}") + _GAP + number)
            yield Rule(f"{label}-{version}", 60 + size, ("commons", "creative", *name.split(), *version.split(".")), _spaced(f"creative commons {name}") + rf"(?:{_GAP}international|{_GAP}unported)?" + _GAP + number)
            yield Rule(f"{label}-{version}", 80 + size, ("creativecommons", "licenses", *version.split(".")), _spaced(f"creativecommons org licenses {code} {version}"))


@functools.lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, those of high priority first."""
    base = [Rule(label, 100, tuple(phrase.split()), _spaced(phrase), True) for phrase, label in BASE_PHRASES.items()]
    notices = [Rule(label, priority, keywords, _over_words(pattern)) for label, priority, keywords, pattern in _NOTICES]
    sentences = [Rule(label, _SENTENCE_PRIORITY, _in_every_match(p), _over_words(p)) for label, patterns in _SENTENCES for p in patterns]
    return tuple(sorted([*base, *_family_rules(), *notices, *sentences], key=lambda r: (-r.priority, r.label, r.pattern)))


@functools.lru_cache(maxsize=1)
def _compiled() -> list[tuple[Rule, tuple[str, ...], re.Pattern]]:
    return [(r, tuple(sorted(r.keywords, key=len, reverse=True)), re.compile(f"(?<!{_WORD})(?:{r.pattern})(?!{_WORD})")) for r in rules()]


def detect(text: str) -> list[tuple[Rule, int, int]]:
    """Detections that stay in a text in which A-Z are lower case, as (rule, start, end), by place."""
    present: dict[str, bool] = {}

    def has(keyword: str) -> bool:
        if keyword not in present:
            present[keyword] = any(word in text for word in keyword.split("|"))
        return present[keyword]

    return resolve([
        (rule, m.start(), m.end())
        for rule, keywords, pattern in _compiled()
        if all(map(has, keywords))
        for m in pattern.finditer(text)
    ])


def resolve(matches: list[tuple[Rule, int, int]]) -> list[tuple[Rule, int, int]]:
    """The matches that stay, by place."""
    base = [d for d in matches if d[0].base]
    # By priority, wide ones first; `ends` and `starts` are of those that stay, by place and disjoint or nested.
    found = sorted((d for d in matches if not d[0].base), key=lambda d: (-d[0].priority, d[1] - d[2], d[1], d[0].label))
    stay: list[tuple[Rule, int, int]] = []
    starts: list[int] = []
    spans: list[tuple[int, int]] = []
    for rule, start, end in found:
        at = bisect.bisect_left(starts, end)
        # Spans that stay don't overlap, so that only the last one beginning before `end` can touch this one.
        if at and spans[at - 1][1] > start:
            continue
        starts.insert(at, start)
        spans.insert(at, (start, end))
        stay.append((rule, start, end))
    return sorted([*base, *stay], key=lambda d: (d[1], d[2], d[0].label))


_DETECTION = pa.struct([("label", pa.string()), ("priority", pa.int32()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("word", pa.int64())])


def scan(docs: DataFrame) -> DataFrame:
    """Add n_words (long) and detections to every row of docs.

    detections is an array of (label, priority, base, start, end, word): places in characters, word the
    number of words before, in order of place. Words are runs of digits, letters a-z and characters beyond
    ASCII after lower-casing A-Z. A null or empty text has no words and no detections; columns of these
    names are replaced, all others stay.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "detections")]
    texts, name = text_hash.with_text(docs.select(*kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in text_hash.text_chunks(batch, name):
                lowered = text_hash.LOWER[data]
                _, _, first = text_hash.word_bounds(lowered, offsets, _OUTSIDE)
                whole, rows = lowered.tobytes(), []
                for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
                    text = whole[a:b].decode()
                    found = detect(text)
                    starts = [m.start() for m in _WORDS.finditer(text)] if found else []
                    rows.append([
                        {"label": r.label, "priority": r.priority, "base": r.base, "start": s, "end": e, "word": bisect.bisect_left(starts, s)}
                        for r, s, e in found
                    ])
                part = batch.slice(low, len(rows))
                arrays = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(np.diff(first), pa.int64()), pa.array(rows, pa.list_(_DETECTION))], [*kept, "n_words", "detections"]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    detection = "struct<label: string, priority: int, base: boolean, start: bigint, `end`: bigint, word: bigint>"
    return texts.mapInArrow(
        run, f"{fields}, n_words bigint, detections array<{detection}>"
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Per row of a scan: counts, places and labels; score is the highest priority found, as a share of 100."""
    base = F.filter("detections", lambda d: d["base"])
    labels = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["word"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("detections")).alias("labels"),
        (F.least(F.lit(100), F.coalesce(F.array_max(F.transform("detections", lambda d: d["priority"])), F.lit(0))) / 100.0).alias("score"),
    )
