"""Typed values out of all-text columns.

Functions take the SQL text of a string expression, usually a column name.
Text that does not parse becomes NULL; ``plans.staging.parse_failures``
counts it, so a bad cell is reported instead of failing a long job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Year, month and day; what follows a day (a time) is cut off.
_DATE_FORM = r"^\\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def text_to_int(text: str) -> Column:
    """Integer from text; fractions round half away from zero."""
    rounded = f"round(try_cast({text} as decimal(30,12)), 0)"
    return F.expr(f"coalesce(try_cast({text} as int), try_cast({rounded} as int))")


def text_to_decimal(text: str, precision: int = 10, scale: int = 2) -> Column:
    return F.expr(f"try_cast({text} as decimal({precision},{scale}))")


def text_to_date(text: str) -> Column:
    """Date from ISO text. Bare years and year-months are not dates."""
    return F.expr(f"if({text} rlike '{_DATE_FORM}', try_cast({text} as date), null)")


def allowed_or_null(value: str, allowed: tuple[str, ...]) -> Column:
    listed = ", ".join(f"'{v}'" for v in allowed)
    return F.expr(f"case when {value} in ({listed}) then {value} end")
