"""Raw all-text rows to typed, named and cleaned certificates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.functions.labels import age_label, fuel_label
from joulemart.functions.numbers import surrogate_key
from joulemart.functions.parsing import allowed_or_null, text_to_date, text_to_decimal, text_to_int

# Staged name <- raw column, by type.
TEXT = {
    "certificate_id": "lmk_key",
    "uprn": "uprn",
    "building_ref": "building_reference_number",
    "address1": "address1",
    "address2": "address2",
    "address3": "address3",
    "postcode": "postcode",
    "post_town": "posttown",
    "local_authority": "local_authority_label",
    "constituency": "constituency_label",
    "county": "county",
    "property_type": "property_type",
    "built_form": "built_form",
    "tenure": "tenure",
    "transaction_type": "transaction_type",
    "floor_level": "floor_level",
    "source_file": "filename",
}
RATING = {
    "energy_rating_current": "current_energy_rating",
    "energy_rating_potential": "potential_energy_rating",
}
INTEGER = {
    "energy_efficiency_current": "current_energy_efficiency",
    "energy_efficiency_potential": "potential_energy_efficiency",
    "env_impact_current": "environment_impact_current",
    "env_impact_potential": "environment_impact_potential",
    "energy_consumption_current": "energy_consumption_current",
    "energy_consumption_potential": "energy_consumption_potential",
    "count_habitable_rooms": "number_habitable_rooms",
    "count_heated_rooms": "number_heated_rooms",
    "count_extensions": "extension_count",
}
DECIMAL = {
    "total_floor_area_sqm": "total_floor_area",
    "co2_emissions_current_tonnes_per_year": "co2_emissions_current",
    "co2_emissions_potential_tonnes_per_year": "co2_emissions_potential",
    "lighting_cost_current": "lighting_cost_current",
    "heating_cost_current": "heating_cost_current",
    "hot_water_cost_current": "hot_water_cost_current",
}
DATE = {"inspection_at": "inspection_date", "lodgement_at": "lodgement_date"}

# Output order of the staged columns.
STAGED = (
    "certificate_key", "certificate_id", "uprn", "building_ref",
    "address1", "address2", "address3", "postcode", "post_town",
    "local_authority", "constituency", "county",
    "energy_rating_current", "energy_rating_potential",
    "energy_efficiency_current", "energy_efficiency_potential",
    "property_type", "built_form", "total_floor_area_sqm",
    "construction_age_band", "tenure", "transaction_type",
    "inspection_at", "lodgement_at",
    "env_impact_current", "env_impact_potential",
    "energy_consumption_current", "energy_consumption_potential",
    "co2_emissions_current_tonnes_per_year", "co2_emissions_potential_tonnes_per_year",
    "lighting_cost_current", "heating_cost_current", "hot_water_cost_current",
    "main_fuel", "floor_level",
    "count_habitable_rooms", "count_heated_rooms", "count_extensions",
    "source_file",
)


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def valid_rows(raw: DataFrame) -> DataFrame:
    """Rows with a usable rating, a property reference and an inspection date.

    An off-list rating passes (its staged rating is NULL); only a missing one
    or the explicit invalid marker drops the row.
    """
    rating = F.col("current_energy_rating")
    return raw.filter(
        rating.isNotNull()
        & (rating != K.INVALID_RATING)
        & F.col("uprn").isNotNull()
        & F.col("inspection_date").isNotNull()
    )


def stage_certificates(raw: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Typed certificates; ``extra`` raw text columns are carried along as is."""
    rows = valid_rows(lower_case_columns(raw))
    present = set(rows.columns)

    def source(name: str) -> str:
        return name if name in present else "cast(null as string)"

    # Lower-cased once here so that the label rules below share it.
    rows = rows.withColumn("fuel_lower", F.expr(f"lower({source('main_fuel')})"))

    staged = {name: F.expr(source(raw_name)) for name, raw_name in TEXT.items()}
    staged |= {name: allowed_or_null(source(raw_name), K.BANDS) for name, raw_name in RATING.items()}
    staged |= {name: text_to_int(source(raw_name)) for name, raw_name in INTEGER.items()}
    staged |= {name: text_to_decimal(source(raw_name)) for name, raw_name in DECIMAL.items()}
    staged |= {name: text_to_date(source(raw_name)) for name, raw_name in DATE.items()}
    staged["certificate_key"] = surrogate_key(F.expr(source("lmk_key")))
    staged["construction_age_band"] = age_label(source("construction_age_band"))
    staged["main_fuel"] = fuel_label("fuel_lower")
    return rows.select(
        *[staged[name].alias(name) for name in STAGED],
        *[F.expr(source(name)).alias(name) for name in extra],
    )


def parse_failures(raw: DataFrame) -> DataFrame:
    """Per typed column: how many cells hold text, and how many do not parse.

    One pass over the raw rows for all columns together.
    """
    rows = lower_case_columns(raw)
    parsers = (
        [(r, text_to_int) for r in INTEGER.values()]
        + [(r, text_to_decimal) for r in DECIMAL.values()]
        + [(r, text_to_date) for r in DATE.values()]
    )
    parsers = [(name, parse) for name, parse in parsers if name in rows.columns]
    counts = []
    for name, parse in parsers:
        text = F.col(name)
        filled = F.trim(text) != ""
        counts.append(
            F.struct(
                F.lit(name).alias("raw_column"),
                F.count_if(filled).alias("n_text"),
                F.count_if(filled & parse(name).isNull()).alias("n_failed"),
            )
        )
    return rows.agg(F.array(*counts).alias("checks")).select(F.inline("checks"))
