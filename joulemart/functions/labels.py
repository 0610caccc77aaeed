"""Free survey text to fixed labels, and label formatting.

The label rules are long CASE expressions. They are built as SQL text, from
the SQL text of a string expression, so that a plan is put together in a few
calls to the JVM instead of hundreds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from joulemart import constants as K


def _any_of(text: str, fragments: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"contains({text}, '{part}')" for part in fragments) + ")"


def _first_match(branches: list[tuple[str, str]], otherwise: str) -> str:
    """CASE whose (condition, label) branches are tried in the given order."""
    whens = " ".join(f"when {condition} then '{label}'" for condition, label in branches)
    return f"case {whens} else {otherwise} end"


def age_label(text: str) -> Column:
    """Construction age label; case-sensitive, order of the rules matters."""
    # Four-digit years compare as text just as they do as numbers.
    by_year = _first_match([(f"{text} <= '{last}'", label) for label, last in K.AGE_LAST_YEAR], f"'{K.AGE_LABELS[-1]}'")
    by_text = _first_match(
        [(_any_of(text, parts), label) for label, parts in K.AGE_TEXT],
        f"if(rlike({text}, r'\\A[0-9]{{4}}\\z'), {by_year}, '{K.UNKNOWN_AGE}')",
    )
    return F.expr(by_text)


def fuel_label(lowered: str) -> Column:
    """Fuel label of an already lower-cased text ("biogas" counts as gas)."""
    return F.expr(
        _first_match([(_any_of(lowered, parts), label) for label, parts in K.FUEL_TEXT], f"'{K.UNKNOWN_FUEL}'")
    )


def wall_label(lowered: str) -> Column:
    """Wall label of an already lower-cased description."""
    branches = []
    for label, material, insulation in K.WALL_TEXT:
        condition = _any_of(lowered, (material,))
        if insulation:
            condition += f" and {_any_of(lowered, insulation)}"
        branches.append((condition, label))
    return F.expr(_first_match(branches, f"'{K.UNKNOWN_WALL}'"))


def ordinal(label: Column, ordered: tuple[str, ...]) -> Column:
    """0-based position in a fixed order; ``len(ordered)`` when not in it."""
    position = F.array_position(F.array(*[F.lit(v) for v in ordered]), label).cast("int")
    return F.when(position > 0, position - 1).otherwise(F.lit(len(ordered)))


def match_key(name: Column) -> Column:
    """Join key of a place name: trimmed, upper case."""
    return F.upper(F.trim(name))


def percent_text(value: Column) -> Column:
    return F.concat(value.cast("string"), F.lit("%"))


def score_text(score: Column, count: Column) -> Column:
    """``"46 (1,234)"``; halves round to even."""
    whole = F.bround(score, 0).cast("bigint").cast("string")
    return F.concat(whole, F.lit(" ("), F.format_number(count, 0), F.lit(")"))


def compact_count(value: Column) -> Column:
    """``"12.3M"`` from a million up, thousands separators below."""
    millions = F.concat(F.round(value / F.lit(1e6), 1).cast("string"), F.lit("M"))
    return F.when(value >= 1_000_000, millions).otherwise(F.format_number(value, 0))


def feature_text(name: Column) -> Column:
    """Readable one-hot feature name."""
    return F.replace(F.replace(name, F.lit("main_fuel_"), F.lit("Fuel: ")), F.lit("wall_type_"), F.lit("Wall: "))
