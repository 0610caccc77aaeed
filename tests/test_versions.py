"""Replacing tables: whole or not at all, and readers keep what they have."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from joulemart.plans import analytics
from joulemart.session import new_work_dir
from joulemart.sources import versions
from joulemart.sources.certificate_rows import raw_certificates
from joulemart.sources.tables import Warehouse, create_namespace, list_tables, replace_table
from joulemart.sources.versions import Versions


@pytest.fixture
def tables(spark):
    return Versions(spark, new_work_dir(spark, "tables"))


def test_versions_and_pins(spark, tables):
    assert tables.latest() == 0 and tables.tables() == {}
    with pytest.raises(KeyError):
        tables.read("a")
    assert tables.replace("a", spark.range(3)) == 1
    pinned, frame = tables.pin(), tables.read("a")
    assert tables.replace("a", spark.range(5).withColumn("x", F.lit("new"))) == 2
    assert tables.replace("b", spark.range(7)) == 3
    assert (frame.count(), pinned.read("a").count(), tables.read("a").count()) == (3, 3, 5)
    assert tables.read("a").columns == ["id", "x"] and tables.at(2).tables().keys() == {"a"}
    with pytest.raises(ValueError):
        pinned.replace("a", spark.range(1))


def test_a_failed_or_killed_write_is_never_seen(spark, tables, monkeypatch):
    tables.replace("a", spark.range(10))
    half = spark.range(0, 100, 1, 10).select(F.when(F.col("id") == 95, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        tables.replace("a", half)
    assert tables.read("a").count() == 10

    class Killed(BaseException):
        pass

    def killed(*_):
        raise Killed

    # Between the data and the commit.
    monkeypatch.setattr(versions.Files, "create", killed)
    with pytest.raises(Killed):
        tables.replace("a", spark.range(50))
    monkeypatch.undo()
    assert tables.read("a").count() == 10 and tables.numbers() == [1]
    # A commit that was not finished is a draft, and no version.
    tables._files()._fs.create(tables._files()._path(f"{tables.root}/_commits/x.draft"), True).close()
    assert tables.latest() == 1 and tables.replace("a", spark.range(2)) == 2


def test_writers_at_the_same_time_lose_nothing(spark, tables):
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda i: tables.replace(f"t{i}", spark.range(i + 1)), range(6)))
    assert sorted(numbers) == [1, 2, 3, 4, 5, 6]
    assert [tables.read(f"t{i}").count() for i in range(6)] == [1, 2, 3, 4, 5, 6]
    assert not tables._files().create(tables._commit_path(3), "{}")
    with ThreadPoolExecutor(8) as pool:  # of many that want one name, one gets it
        for turn in range(40):
            path = f"{tables.root}/_commits/try-{turn}"
            won = list(pool.map(lambda i: tables._files().create(path, str(i)), range(8)))
            assert sum(won) == 1 and tables._files().read(path) == str(won.index(True))
    assert [n for n in tables._files().names(f"{tables.root}/_commits") if not n.isdigit() and not n.startswith("try")] == []


def test_vacuum_keeps_what_is_named(spark, tables):
    for i in range(4):
        tables.replace("a", spark.range(i + 1))
        tables.replace("b", spark.range(1)) if i == 0 else None
    running = tables.new_folder("a")
    spark.range(9).write.parquet(f"{tables.root}/{running}")
    gone = tables.vacuum(keep=2)
    assert len(gone) == 2 and tables.numbers() == [4, 5]
    assert tables.at(4).read("a").count() == 3 and tables.read("a").count() == 4 and tables.read("b").count() == 1
    tables.commit({"a": running})
    assert tables.read("a").count() == 9 and tables.vacuum(keep=10) == []


def test_catalog_names_are_replaced_at_once(spark):
    create_namespace(spark, "swap_zone")
    replace_table(spark.range(4), "swap_zone.things")
    old = spark.table("swap_zone.things")
    replace_table(spark.range(6).withColumn("more", F.lit(1)), "swap_zone.things")
    with pytest.raises(PySparkException):
        replace_table(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), "swap_zone.things")
    assert spark.table("swap_zone.things").count() == 6 and spark.table("swap_zone.things").columns == ["id", "more"]
    assert old.count() == 4 and ("swap_zone", "things") in [tuple(r) for r in list_tables(spark).collect()]


def test_a_broken_build_leaves_the_last_one(spark, sf_dir, monkeypatch):
    raw = raw_certificates(spark, sf_dir)
    warehouse = Warehouse(spark, new_work_dir(spark, "warehouse")).build(raw)
    before = {r.table_name: r.n_rows for r in warehouse.row_counts().collect()}
    star = warehouse.star()

    def broken(*_):
        raise RuntimeError("out of luck")

    monkeypatch.setattr(analytics, "retrofit_priority", broken)
    with pytest.raises(RuntimeError):
        warehouse.build(raw.limit(100))
    monkeypatch.undo()
    assert {r.table_name: r.n_rows for r in warehouse.row_counts().collect()} == before
    pinned = warehouse.pinned()
    warehouse.build(raw.limit(100))
    assert warehouse.table("stg_certificates").count() < pinned.table("stg_certificates").count() == before["stg_certificates"]
    assert star.staged.count() == before["stg_certificates"] and warehouse.versions().numbers() == [1, 2]
