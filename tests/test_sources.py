from __future__ import annotations

import gzip
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from joulemart.functions.outlines import simplify_ring
from joulemart.plans import marts
from joulemart.plans.staging import parse_failures, stage_certificates
from joulemart.session import new_work_dir, work_root
from joulemart.sources import csv_landing, geojson
from joulemart.sources.certificate_rows import raw_certificates
from joulemart.sources.csv_landing import append_chunk, file_headers, read_csv_by_name
from joulemart.sources.tables import Warehouse, create_namespace, list_tables, replace_table
from joulemart.streaming.incremental import merge_available, merge_batch, read_state
from joulemart.streaming.landing import append_available, csv_stream


@pytest.fixture
def csv_parts(tmp_path):
    (tmp_path / "north").mkdir()
    (tmp_path / "south").mkdir()
    (tmp_path / "north" / "certificates.csv").write_text('A,B,C\n1,"x, y",""\n2,"say ""hi""",\n')
    (tmp_path / "south" / "certificates.csv").write_text('B,A,D\n"two\nlines",3,q\n')
    (tmp_path / "south" / "more.csv").write_text("﻿A,B,C\n4,z,c\n", encoding="utf-8")
    (tmp_path / "notes.txt").write_text("not,a,table\n")
    return str(tmp_path)


def test_csv_aligned_by_name(spark, csv_parts):
    headers = sorted(tuple(r.header) for r in file_headers(spark, csv_parts).collect())
    assert headers == [("A", "B", "C"), ("A", "B", "C"), ("B", "A", "D")]
    rows = {r.A: r for r in read_csv_by_name(spark, csv_parts).collect()}
    assert {a: (r.B, r.C, r.D) for a, r in rows.items()} == {
        "1": ("x, y", None, None),
        "2": ('say "hi"', None, None),
        "3": ("two\nlines", None, "q"),
        "4": ("z", "c", None),
    }
    assert rows["1"].filename.endswith("north/certificates.csv")
    assert rows["3"].filename.endswith("south/certificates.csv")


def test_csv_files_of_any_suffix_in_batch_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('A,B\n1,"x\ny"\n2,b\n')
    (folder / "b.CSV").write_text("A,B\n3,c\n")
    (folder / "c.csv.gz").write_bytes(gzip.compress(b"A,B\n4,d\n"))
    rows = sorted((r.A, r.B) for r in read_csv_by_name(spark, str(folder)).collect())
    assert rows == [("1", "x\ny"), ("2", "b"), ("3", "c"), ("4", "d")]
    append_available(csv_stream(spark, str(folder), ["A", "B"]), str(tmp_path / "t"), str(tmp_path / "c"))
    assert sorted((r.A, r.B) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == rows


def test_csv_header_longer_than_any_prefix(spark, tmp_path):
    names = [f"column_{i}_" + "x" * 150 for i in range(9000)]
    (tmp_path / "wide.csv").write_text(",".join(names) + "\n" + ",".join("v" for _ in names) + "\n")
    (tmp_path / "quoted.csv").write_text('"A\n1",B\n1,2\n')
    headers = sorted((tuple(r.header) for r in file_headers(spark, str(tmp_path)).collect()), key=len)
    assert headers == [("A\n1", "B"), tuple(names)]


def test_csv_many_files_of_two_headers(spark, tmp_path, monkeypatch):
    for i in range(600):
        (tmp_path / f"{i}.csv").write_text(f"A,B\n{i},x\n" if i % 2 else f"B,A\nx,{i}\n")
    for most in (1000, 10):  # the headers sent to all tasks, and joined
        monkeypatch.setattr(csv_landing, "BROADCAST_FILES", most)
        rows = read_csv_by_name(spark, str(tmp_path))
        assert "collect_list" not in rows._jdf.queryExecution().toString()
        assert sorted((int(r.A), r.B) for r in rows.collect()) == [(i, "x") for i in range(600)]


def test_csv_missing_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv_by_name(spark, str(tmp_path))


def test_append_chunks(spark, tmp_path):
    path = str(tmp_path / "t")
    for run in range(2):
        append_chunk(spark.range(3), path, first=True)
        append_chunk(spark.range(3, 5), path, first=False)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4]


def test_namespace_and_listing(spark):
    create_namespace(spark, "raw_zone")
    create_namespace(spark, "raw_zone")
    for n in (2, 3):
        replace_table(spark.range(n), "raw_zone.certificates")
    assert spark.table("raw_zone.certificates").count() == 3
    assert ("raw_zone", "certificates") in [tuple(r) for r in list_tables(spark).collect()]


def test_parse_failures(spark):
    raw = spark.createDataFrame(
        [("12", "abc", "2020-01-01"), ("x", "1.5", "2020"), ("", None, "")],
        "number_heated_rooms string, total_floor_area string, inspection_date string",
    )
    got = {r.raw_column: (r.n_text, r.n_failed) for r in parse_failures(raw).collect()}
    assert got == {"number_heated_rooms": (2, 1), "total_floor_area": (2, 1), "inspection_date": (2, 1)}


@pytest.fixture(scope="module")
def warehouse(spark, sf_dir):
    return Warehouse(spark, new_work_dir(spark, "warehouse")).build(raw_certificates(spark, sf_dir))


def test_warehouse_tables_and_views(spark, sf_dir, warehouse):
    counts = {r.table_name: r.n_rows for r in warehouse.row_counts().collect()}
    assert counts["stg_certificates"] == 1471 and counts["dim_properties"] == 150
    warehouse.register()
    assert spark.table("fct_certificates").columns == marts.FACT
    worst = spark.sql("select min(avg_current_efficiency) as v from v_regional_energy_performance").first().v
    assert 0 < worst < 100
    assert spark.sql("select * from v_property_efficiency_gaps").count() == 310


def test_copies_scale_rows(spark, sf_dir):
    rows = raw_certificates(spark, sf_dir, copies=3)
    assert rows.count() == 4500
    assert rows.select("LMK_KEY").distinct().count() == 4500


def _brute_force(points, tolerance):
    """Textbook recursion, for comparison."""
    if len(points) < 3:
        return points
    (x0, y0), (x1, y1) = points[0], points[-1]
    length = np.hypot(x1 - x0, y1 - y0)
    distances = [
        abs((x1 - x0) * (y0 - y) - (x0 - x) * (y1 - y0)) / length if length else np.hypot(x - x0, y - y0)
        for x, y in points[1:-1]
    ]
    split = 1 + int(np.argmax(distances))
    if distances[split - 1] <= tolerance:
        return [points[0], points[-1]]
    return _brute_force(points[: split + 1], tolerance)[:-1] + _brute_force(points[split:], tolerance)


@pytest.mark.parametrize("seed", range(8))
def test_simplify_matches_recursion(seed):
    rng = np.random.default_rng(seed)
    angles = np.linspace(0, 2 * np.pi, 80)
    ring = [(float(np.cos(a) + rng.normal(0, 0.03)), float(np.sin(a) + rng.normal(0, 0.03))) for a in angles]
    ring[-1] = ring[0]
    expected = _brute_force(ring, 0.05)
    assert [tuple(p) for p in simplify_ring(np.array(ring), 0.05)] == expected
    assert 4 <= len(expected) < 80


def test_small_rings_are_kept():
    square = np.array([[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]], dtype=float)
    assert len(simplify_ring(square, 100.0)) == 5


SQUARE = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
FINE = [[0, 0], [1, 0], [2, 0], [2, 1], [2, 2], [1, 2], [0, 2], [0, 1], [0, 0]]
HEXAGON = [[5, 0], [7, 0], [8, 2], [7, 4], [5, 4], [4, 2], [5, 0]]


def _boundaries(path):
    def feature(code, name, geometry, **extra):
        properties = {"LAD13NM": name} | ({"LAD13CD": code} if code else {})
        return {"type": "Feature", "properties": properties, "geometry": geometry, **extra}

    document = {
        "type": "FeatureCollection",
        "features": [
            feature("E1", " Ashton ", {"type": "Polygon", "coordinates": [FINE]}),
            feature("E2", "Borough", {"type": "MultiPolygon", "coordinates": [[SQUARE], [HEXAGON]]}),
            feature(None, "Cove", {"type": "Polygon", "coordinates": [SQUARE]}, id="E3"),
            feature("E4", "Dale", None),
        ],
    }
    path.write_text(json.dumps(document, indent=1))
    return str(path)


def test_geojson(spark, tmp_path):
    features = geojson.read_features(spark, _boundaries(tmp_path / "lad.json"))
    got = {r.lad_code: (r.geometry_type, None if r.polygons is None else len(r.polygons)) for r in features.collect()}
    assert got == {"E1": ("Polygon", 1), "E2": ("MultiPolygon", 2), "E3": ("Polygon", 1), "E4": (None, None)}
    outlines = {r.lad_code: r.outline for r in geojson.main_outline(features).collect()}
    assert outlines == {"E1": SQUARE, "E2": HEXAGON, "E3": SQUARE}


def test_district_matching(spark, tmp_path):
    features = geojson.read_features(spark, _boundaries(tmp_path / "lad.json"))
    rows = spark.createDataFrame([("ASHTON",), (" cove",), ("Nowhere",), (None,)], "local_authority string")
    got = {r.local_authority: r.lad_code for r in geojson.match_districts(rows, features).collect()}
    assert got == {"ASHTON": "E1", " cove": "E3", "Nowhere": None, None: None}
    missing = [r.local_authority for r in geojson.unmatched_districts(rows, features).collect()]
    assert set(missing) == {None, "Nowhere"}


def test_stream_appends_once(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    for number in range(3):
        spark.range(number * 10, number * 10 + 5).select(F.col("id").cast("string").alias("A"), F.lit("b").alias("B")).write.options(
            header="true"
        ).csv(f"{landing}/drop{number}")
        append_available(csv_stream(spark, landing, ["A", "B"]), table, state)
    append_available(csv_stream(spark, landing, ["A", "B"]), table, state)
    got = sorted(int(r.A) for r in spark.read.parquet(table).collect())
    assert got == [n * 10 + i for n in range(3) for i in range(5)]


def test_stream_rejects_other_headers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("B,A\n1,2\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        append_available(csv_stream(spark, str(tmp_path / "in"), ["A", "B"]), str(tmp_path / "t"), str(tmp_path / "c"))


def _staged(spark, rows):
    columns = "lmk_key string, uprn string, inspection_date string, lodgement_date string, tenure string, current_energy_rating string"
    return stage_certificates(spark.createDataFrame(rows, columns))


def test_incremental_state(spark, tmp_path):
    log = str(tmp_path / "log")
    new = _staged(spark, [("c2", "u1", "2020-05-01", "2020-05-01", "new", "C"), ("c3", "u2", "2019-01-01", "2019-01-01", "only", "D")])
    late = _staged(spark, [("c1", "u1", "2010-01-01", "2010-01-01", "old", "E"), ("c4", "u3", "2018-01-01", "2018-01-01", "third", "D")])
    for batch_id, batch in ((0, new), (1, late), (1, late), (0, new)):  # two batches run twice
        merge_batch(batch, batch_id, log)
    got = {r.uprn: r.tenure for r in read_state(spark, log).collect()}
    assert got == {"u1": "new", "u2": "only", "u3": "third"}


def test_incremental_stream_equals_batch(spark, sf_dir, tmp_path):
    raw = raw_certificates(spark, sf_dir).drop("filename")
    raw.repartition(3).write.options(header="true", quote='"', escape='"').csv(str(tmp_path / "in"))
    stream = csv_stream(spark, str(tmp_path / "in"), raw.columns, files_per_batch=1)
    merge_available(stage_certificates(stream), str(tmp_path / "log"), str(tmp_path / "state"))
    batch = marts.dim_properties(stage_certificates(raw)).drop("property_id")
    state = read_state(spark, str(tmp_path / "log"))
    assert sorted(map(tuple, state.collect()), key=str) == sorted(map(tuple, batch.collect()), key=str)


class _Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_work_folder_of_a_local_session_without_setting():
    local = _Session(spark_master="local[2]")
    assert work_root(local) == work_root(local) and new_work_dir(local, "x").startswith(work_root(local))
    assert "spark.checkpoint.dir" not in local.settings


def test_work_folder_is_the_shared_one():
    shared = _Session(spark_master="yarn", **{"spark_checkpoint_dir": "hdfs:///work"})
    assert new_work_dir(shared, "x").startswith("hdfs:///work/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        new_work_dir(_Session(spark_master="yarn"), "x")
