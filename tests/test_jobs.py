from __future__ import annotations

from joulemart import __main__ as jobs
from joulemart.plans import suite
from joulemart.sources.certificate_rows import raw_certificates
from joulemart.sources.csv_landing import write_csv_folders
from joulemart.sources.tables import Warehouse
from pyspark.sql import functions as F


def test_load_build_check_report(spark, sf_dir, tmp_path, capsys):
    csv, raw, root, out = (str(tmp_path / n) for n in ("csv", "raw", "root", "out"))
    rows = raw_certificates(spark, sf_dir).withColumn("folder", F.substring_index("filename", "/", 1))
    write_csv_folders(rows.drop("filename"), csv, "folder")
    assert jobs.main(["load", csv, raw]) == 0
    assert jobs.main(["build", raw, root]) == 0
    # Ratings that are off the list stage as NULL and fail the not-null check.
    assert jobs.main(["check", raw, root, "2014-01-01"]) == 1
    printed = capsys.readouterr().out
    assert "1,500 rows" in printed and "FAIL  stg_certificates  not_null(energy_rating_current)" in printed
    assert jobs.main(["report", root, out, "rating_distribution", "national_summary"]) == 0
    assert spark.read.parquet(f"{out}/rating_distribution").count() == 7


def test_failing_report_does_not_stop_others(spark, sf_dir, tmp_path, monkeypatch):
    def broken(star, retrofit):
        raise ValueError("no such column")

    monkeypatch.setitem(suite.REPORTS, "broken", broken)
    warehouse = Warehouse(spark, str(tmp_path / "w")).build(raw_certificates(spark, sf_dir))
    outcome = suite.write_reports(
        warehouse.star(), warehouse.table("v_retrofit_priority"), str(tmp_path / "out"), ["broken", "annual_trend"]
    )
    assert {r.report: r.error for r in outcome.collect()} == {
        "annual_trend": None, "broken": "ValueError: no such column",
    }


def test_usage():
    assert jobs.main([]) == 2
