from __future__ import annotations

import datetime
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.functions import labels, numbers, parsing


def evaluate(spark, texts, build):
    """``build`` applied to each text, in order."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", build("t").alias("v")).orderBy("i").collect()]


AGES = {
    None: "Unknown",
    "": "Unknown",
    "NO DATA!": "Unknown",
    "England and Wales: before 1900": "Pre-1900",
    "England and Wales: 1900-1929": "1900-1929",
    "England and Wales: 1930-1949": "1930-1949",
    "England and Wales: 1950-1966": "1950-1975",
    "England and Wales: 1967-1975": "1950-1975",
    "England and Wales: 1976-1982": "1976-1990",
    "England and Wales: 1983-1990": "1976-1990",
    "England and Wales: 1991-1995": "1991-2002",
    "England and Wales: 1996-2002": "1991-2002",
    "England and Wales: 2003-2006": "2003-2011",
    "England and Wales: 2007-2011": "2003-2011",
    "England and Wales: 2007 onwards": "2003-2011",
    "England and Wales: 2012 onwards": "2012-Present",
    "Scotland: before 1919": "Unknown",
    "BEFORE 1900": "Unknown",
    "2007": "2003-2011",
    "2012": "2012-Present",
    "1899": "Pre-1900",
    "1900": "1900-1929",
    "1929": "1900-1929",
    "1930": "1930-1949",
    "1975": "1950-1975",
    "1976": "1976-1990",
    "1990": "1976-1990",
    "2002": "1991-2002",
    "2011": "2003-2011",
    "2019": "2012-Present",
    "19850": "Unknown",
    "1985\n": "Unknown",
    " 1985": "Unknown",
}
FUELS = {
    None: "Other/Unknown",
    "Mains Gas": "Mains Gas",
    "biogas (community)": "Mains Gas",
    "Gas: mains, was electricity": "Mains Gas",
    "ELECTRICITY: unspecified": "Electricity",
    "oil (not community)": "Heating Oil",
    "boiler: LPG": "Heating Oil",
    "bottled lpg": "LPG",
    "anthracite": "Solid Fuel",
    "House COAL": "Solid Fuel",
    "wood logs": "Biomass",
    "biomass": "Biomass",
    "none": "Other/Unknown",
}
WALLS = {
    None: "Other/Unknown",
    "Cavity wall, as built, no insulation (assumed)": "Cavity - Uninsulated",
    "cavity, uninsulated": "Cavity - Uninsulated",
    "Cavity wall, with external insulation": "Cavity - Insulated",
    "Cavity wall, filled cavity": "Other/Unknown",
    "Solid brick, as built, no insulation (assumed)": "Solid - Uninsulated",
    "SOLID BRICK, WITH INTERNAL INSULATION": "Solid - Insulated",
    "Solid brick, as built, insulated (assumed)": "Other/Unknown",
    "Timber frame, as built, insulated (assumed)": "Timber Frame",
    "System built, as built, no insulation (assumed)": "System Build",
    "Cob, as built": "Other/Unknown",
}


@pytest.mark.parametrize(
    ("cases", "build"),
    [
        (AGES, labels.age_label),
        (FUELS, lambda t: labels.fuel_label(f"lower({t})")),
        (WALLS, lambda t: labels.wall_label(f"lower({t})")),
    ],
)
def test_labels(spark, cases, build):
    assert dict(zip(cases, evaluate(spark, list(cases), build))) == cases


def test_integers(spark):
    texts = ["12", "12.7", "12.5", "-12.5", " 12 ", "1e3", "", "abc", None, "99999999999"]
    assert evaluate(spark, texts, parsing.text_to_int) == [12, 13, 13, -13, 12, 1000, None, None, None, None]


def test_decimals(spark):
    texts = ["1.005", "-1.005", "12", "", "x", None, "123456789.00"]
    expected = [Decimal("1.01"), Decimal("-1.01"), Decimal("12.00"), None, None, None, None]
    assert evaluate(spark, texts, parsing.text_to_decimal) == expected


def test_dates(spark):
    texts = ["2020-01-05", "2020-1-5", "2020-01-05 10:00:00", "2020", "2020-01", "5/1/2020", "", None, "2020-02-30"]
    day = datetime.date(2020, 1, 5)
    assert evaluate(spark, texts, parsing.text_to_date) == [day, day, day, None, None, None, None, None, None]
    assert evaluate(spark, ["12020-12", "2020-12", " 2020-1-5 ", "2020-12-", "120201205"], parsing.text_to_date) == [None, None, day, None, None]


def test_surrogate_key(spark):
    rows = spark.createDataFrame([("a", "b"), (None, "b")], "x string, y string")
    one = [r.k for r in rows.select(numbers.surrogate_key(F.col("x")).alias("k")).collect()]
    two = [r.k for r in rows.select(numbers.surrogate_key(F.col("x"), F.col("y")).alias("k")).collect()]
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert one == [md5("a"), md5(K.NULL_KEY_TEXT)]
    assert two == [md5("a-b"), md5(f"{K.NULL_KEY_TEXT}-b")]


def test_rounding_judges_decimal_ties(spark):
    values = spark.createDataFrame([(164.1 / 6,), (2.675,), (-0.15,), (1.45,)], "v double")
    assert [r.r for r in values.select(numbers.rounded(F.col("v"), 1).alias("r")).collect()] == [27.4, 2.7, -0.2, 1.5]


def test_clamp_keeps_missing(spark):
    values = spark.createDataFrame([(40.0,), (62.0,), (90.0,), (None,)], "v double")
    assert [r.c for r in values.select(numbers.clamp_unit(F.col("v"), 48, 76).alias("c")).collect()] == [0.0, 0.5, 1.0, None]


def test_label_formats(spark):
    rows = spark.createDataFrame([(44.5, 1234), (45.5, 7), (45.6, 2_500_000)], "s double, n bigint")
    got = rows.select(
        labels.score_text(F.col("s"), F.col("n")).alias("score"),
        labels.compact_count(F.col("n")).alias("count"),
        labels.percent_text(F.col("s")).alias("pct"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("44 (1,234)", "1,234", "44.5%"), ("46 (7)", "7", "45.5%"), ("46 (2,500,000)", "2.5M", "45.6%"),
    ]


def test_ordinal_and_feature_names(spark):
    rows = spark.createDataFrame([("Pre-1900",), ("2012-Present",), ("Unknown",), (None,)], "a string")
    assert [r.o for r in rows.select(labels.ordinal(F.col("a"), K.AGE_LABELS).alias("o")).collect()] == [0, 7, 8, 8]
    names = spark.createDataFrame([("main_fuel_LPG",), ("wall_type_Timber Frame",), ("floor_area_sqm",)], "n string")
    assert [r.n for r in names.select(labels.feature_text(F.col("n")).alias("n")).collect()] == [
        "Fuel: LPG", "Wall: Timber Frame", "floor_area_sqm",
    ]
