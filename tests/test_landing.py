"""A stream of files whose headers change, landed exactly once."""

from __future__ import annotations

from pyspark.sql import functions as F

from joulemart.session import new_work_dir
from joulemart.sources.csv_landing import read_csv_by_name, write_csv_folders
from joulemart.sources.versions import Versions
from joulemart.streaming.landing import land_available, land_batch, read_landed


def _drop(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def _sorted(df):
    return sorted(map(str, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))


def test_changing_headers_equal_a_batch_read(spark, tmp_path):
    landing, table, checkpoint = tmp_path / "landing", new_work_dir(spark, "table"), new_work_dir(spark, "checkpoint")
    _drop(landing / "a", "one.csv", 'id,name\n1,x\n2,"two\nlines"\n')
    _drop(landing / "a", "two.CSV", "name,id\ny,3\n")
    land_available(spark, str(landing), table, checkpoint, files_per_batch=1)
    assert _sorted(read_landed(spark, table)) == _sorted(read_csv_by_name(spark, str(landing)))
    early = Versions(spark, table).latest()
    before = read_landed(spark, table)
    _drop(landing / "b", "three.csv", "id,more,name\n4,new,z\n")
    _drop(landing / "b", "empty.csv", "")
    _drop(landing / "b", "header_only.csv", "id,last\n")
    land_available(spark, str(landing), table, checkpoint)
    landed = read_landed(spark, table)
    assert _sorted(landed) == _sorted(read_csv_by_name(spark, str(landing)))
    assert landed.columns[-1] == "filename" and set(landed.columns) == {"id", "name", "more", "last", "filename"}
    assert before.count() == read_landed(spark, table, early).count() == 3 and "more" not in before.columns
    land_available(spark, str(landing), table, checkpoint)  # nothing new
    assert read_landed(spark, table).count() == 4


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    table = new_work_dir(spark, "table")
    _drop(tmp_path, "one.csv", "id\n1\n2\n")
    _drop(tmp_path, "two.csv", "id,x\n3,a\n")
    files = spark.createDataFrame([(f"file:{tmp_path}/{n}.csv",) for n in ("one", "two")], "path string")
    for _ in range(3):
        land_batch(files, 7, table)
    land_batch(files.limit(0), 8, table)
    assert read_landed(spark, table).count() == 3 and list(Versions(spark, table).tables()) == ["batch-7"]
    assert read_landed(spark, new_work_dir(spark, "none")).count() == 0


def test_headers_are_found_in_few_jobs(spark, tmp_path):
    for name, text in (("a", "k,v\n1,x\n"), ("b", "k,v\n2,y\n"), ("c", "v,k\nz,3\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    spark.sparkContext.setJobGroup("headers", "")
    try:
        rows = read_csv_by_name(spark, str(tmp_path))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert {(r.k, r.v) for r in rows.collect()} == {("1", "x"), ("2", "y"), ("3", "z")}
    assert len(jobs) <= 4  # headers written, grouped (with its shuffle, two), and sizes


def test_folders_get_few_files_whatever_wrote_them(spark, tmp_path):
    rows = spark.range(600).select(F.concat(F.lit("f"), F.col("id") % 3).alias("folder"), F.col("id").cast("string").alias("k"))
    write_csv_folders(rows.repartition(16), str(tmp_path / "out"), "folder")
    files = [p.parent.name for p in (tmp_path / "out").glob("*/*.csv")]
    assert set(files) == {"folder=f0", "folder=f1", "folder=f2"} and len(files) <= 6
    assert sorted(int(r.k) for r in read_csv_by_name(spark, str(tmp_path / "out")).collect()) == list(range(600))
