"""The aggregate kept up by differences equals the one built from all certificates."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from joulemart.plans import marts
from joulemart.plans.marts import Star
from joulemart.plans.staging import stage_certificates
from joulemart.session import new_work_dir
from joulemart.sources.certificate_rows import raw_certificates
from joulemart.streaming import aggregates
from joulemart.streaming.aggregates import AggregateState, merge_aggregates, read_aggregates


def _rows(df):
    return sorted((str(r.asDict()) for r in df.collect()))


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    """Certificates of few properties, so that batches meet again; some postcodes have several locations."""
    rows = stage_certificates(raw_certificates(spark, sf_dir)).withColumn("uprn", F.when(F.col("uprn").isNotNull(), (F.hash("certificate_id") % 60).cast("string")))
    rows = rows.withColumn("postcode", F.when(F.col("postcode").isNotNull(), (F.hash("uprn") % 25).cast("string")))
    folder = new_work_dir(spark, "staged")
    rows.write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("send", [True, False])
def test_batches_in_any_order_and_twice_equal_the_whole(spark, staged, monkeypatch, send):
    if not send:
        monkeypatch.setattr(aggregates, "BROADCAST_KEYS", 0)
    root = new_work_dir(spark, "state")
    parts = staged.withColumn("part", F.pmod(F.hash("certificate_id", F.lit(7)), F.lit(3)))
    order = list(range(3))
    random.Random(4).shuffle(order)
    done = None
    for number, part in enumerate(order):
        batch = parts.filter(F.col("part") == part).drop("part")
        merge_aggregates(batch, number, root)
        merge_aggregates(batch, number, root)  # once more
        done = batch if done is None else done.unionByName(batch)
        assert _rows(read_aggregates(spark, root, staged)) == _rows(marts.fct_property_aggregations(Star.from_staged(done)))
    assert AggregateState(spark, root).batches() == {0, 1, 2}
    merge_aggregates(staged.limit(0), 3, root)
    assert _rows(read_aggregates(spark, root, staged)) == _rows(marts.fct_property_aggregations(Star.from_staged(staged)))


def test_a_newer_certificate_moves_all_years_and_a_place_repeats_them(spark, staged):
    base = staged.filter("certificate_id is not null").limit(1).first().asDict()
    base |= {"county": "X", "post_town": "T", "postcode": "P1", "uprn": "1", "tenure": "owner", "energy_efficiency_current": 50}
    one = lambda day, **k: {**base, "inspection_at": day, "certificate_id": str(day), **k}
    import datetime as dt

    first = [one(dt.date(2010, 1, 1)), one(dt.date(2011, 1, 1)), one(dt.date(2012, 5, 5), uprn="2", postcode="P2", county=None, energy_efficiency_current=None)]
    late = [one(dt.date(2009, 1, 1), tenure="late")]
    newer = [one(dt.date(2013, 1, 1), tenure="rented")]
    place = [one(dt.date(2000, 1, 1), county="Y", uprn="3")]
    root, seen = new_work_dir(spark, "state"), []
    cells = {}
    for number, batch in enumerate((first, late, newer, place)):
        merge_aggregates(spark.createDataFrame(batch, staged.schema), number, root)
        seen += batch
        found = read_aggregates(spark, root, staged)
        assert _rows(found) == _rows(marts.fct_property_aggregations(Star.from_staged(spark.createDataFrame(seen, staged.schema))))
        cells[number] = {(r.county, r.tenure, r.inspection_year.year): r.certificate_count for r in found.collect()}
    assert ("X", "owner", 2009) in cells[1] and not any(t == "late" for _, t, _ in cells[1])
    assert {t for c, t, _ in cells[2] if c == "X"} == {"rented"}
    assert cells[3]["Y", "rented", 2013] == cells[3]["X", "rented", 2013] == 1


def test_only_buckets_of_changed_properties_are_read(spark, staged):
    root = new_work_dir(spark, "state")
    merge_aggregates(staged, 0, root)
    state = AggregateState(spark, root)
    log = state.log("kinds", aggregates._schemas(staged)["kinds"], [3, 5])
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and {r.bucket for r in log.select("bucket").distinct().collect()} <= {3, 5}
