"""Large CSV files cut into blocks give the rows of files read whole."""

from __future__ import annotations

import csv
import io
import random

import pytest

from joulemart.sources import csv_blocks, csv_landing
from joulemart.sources.csv_landing import read_csv_by_name


def _last_state(text: str) -> bool:
    """Whether a quoted field is open at the end of a text, character by character."""
    quoted, start, i = False, True, 0
    while i < len(text):
        c = text[i]
        if quoted:
            if c == '"' and text[i + 1 : i + 2] == '"':
                i += 1
            elif c == '"':
                quoted = False
        elif c == '"' and start:
            quoted = True
        start = not quoted and c in ",\n"
        i += 1
    return quoted


def test_state_after_a_line():
    pick = random.Random(1)
    for _ in range(3000):
        line = "".join(pick.choice('a,"" ') for _ in range(pick.randrange(14)))
        assert csv_blocks.ends_quoted(line, False) == _last_state(line)
        assert csv_blocks.ends_quoted(line, True) == _last_state('"' + line)


def _text(rows, end="\n"):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL).writerows(rows)
    return out.getvalue()


def _rows(seed, n):
    pick = random.Random(seed)
    values = ["", "x", "a,b", 'say "hi"', "two\nlines", "\n", '"', '\n"\n', "long " * 40 + "\n" * 30, "été\r\nagain", "5 in"]
    return [[str(i), *(pick.choice(values) for _ in range(3))] for i in range(n)]


@pytest.fixture
def blocks(spark, monkeypatch):
    """Every file by blocks of a few bytes."""
    monkeypatch.setattr(csv_landing, "WHOLE_FILE_BYTES", 0)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "173")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _read(spark, path):
    columns = ["id", "b", "c", "d", "filename"]
    return sorted((tuple(r) for r in read_csv_by_name(spark, path).select(*columns).collect()), key=str)


@pytest.mark.parametrize("send", [True, False])
def test_blocks_equal_whole_files(spark, tmp_path, monkeypatch, blocks, send):
    if not send:
        monkeypatch.setattr(csv_blocks, "BROADCAST_BLOCKS", 0)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.csv").write_bytes(_text([["id", "b", "c", "d"], *_rows(1, 120)]).encode())
    (tmp_path / "in" / "two.CSV").write_bytes(("﻿" + _text([["d", "id", "c", "b"], *_rows(2, 60)], "\r\n")).encode())
    (tmp_path / "in" / "three.csv").write_bytes((_text([["id", "b", "c", "d", "wide " * 20 + "\nname"], *_rows(3, 5)]) + "\n\n").encode()[:-1])
    (tmp_path / "in" / "none.csv").write_bytes(b"id,b,c,d\n")
    (tmp_path / "in" / "stray.csv").write_bytes(b'id,b,c,d\n1,5" pipe,x,y\n2,a"b"c,"q\nr",z\n' * 9)
    found = _read(spark, str(tmp_path / "in"))
    splits = {(r.path, r.start) for r in csv_blocks._lines(spark, [str(tmp_path / "in" / "one.csv")]).collect()}
    assert len(splits) > 20
    monkeypatch.setattr(csv_landing, "WHOLE_FILE_BYTES", 1 << 30)
    assert found == _read(spark, str(tmp_path / "in"))
    assert sum(len(r[1] or "") > 200 and "\n" in r[1] for r in found) > 3


def test_large_and_small_files_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_landing, "WHOLE_FILE_BYTES", 500)
    (tmp_path / "small.csv").write_text(_text([["id", "b", "c", "d"], *_rows(4, 2)])[:400].rsplit("\n", 1)[0])
    (tmp_path / "large.csv").write_text(_text([["id", "b", "c", "d"], *_rows(5, 60)]))
    found = _read(spark, str(tmp_path))
    monkeypatch.setattr(csv_landing, "WHOLE_FILE_BYTES", 1 << 30)
    assert found == _read(spark, str(tmp_path)) and len({r[-1] for r in found}) == 2
