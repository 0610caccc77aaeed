"""Fixed values of the certificate domain.

Every list below is a fixed value: results only come out right when the
labels, text fragments and orders are exactly these.
"""

from __future__ import annotations

# Rating bands, best first.
BANDS = ("A", "B", "C", "D", "E", "F", "G")
BELOW_C = ("D", "E", "F", "G")
INVALID_RATING = "INVALID!"

# Construction age labels, oldest first.
AGE_LABELS = (
    "Pre-1900",
    "1900-1929",
    "1930-1949",
    "1950-1975",
    "1976-1990",
    "1991-2002",
    "2003-2011",
    "2012-Present",
)
UNKNOWN_AGE = "Unknown"

# Age label -> fragments of the survey text that select it; first match wins.
AGE_TEXT = (
    ("Pre-1900", ("before 1900",)),
    ("1900-1929", ("1900-1929",)),
    ("1930-1949", ("1930-1949",)),
    ("1950-1975", ("1950-1966", "1967-1975")),
    ("1976-1990", ("1976-1982", "1983-1990")),
    ("1991-2002", ("1991-1995", "1996-2002")),
    ("2003-2011", ("2003-2006", "2007")),
    ("2012-Present", ("2012", "onwards")),
)

# Age label -> last build year it covers, for survey texts that are a bare year.
AGE_LAST_YEAR = (
    ("Pre-1900", 1899),
    ("1900-1929", 1929),
    ("1930-1949", 1949),
    ("1950-1975", 1975),
    ("1976-1990", 1990),
    ("1991-2002", 2002),
    ("2003-2011", 2011),
)

# Fuel label -> fragments of the lower-cased fuel text; first match wins.
FUEL_TEXT = (
    ("Mains Gas", ("gas",)),
    ("Electricity", ("electricity",)),
    ("Heating Oil", ("oil",)),
    ("LPG", ("lpg",)),
    ("Solid Fuel", ("coal", "anthracite")),
    ("Biomass", ("wood", "biomass")),
)
UNKNOWN_FUEL = "Other/Unknown"

# Wall label -> (material fragment, insulation fragments, any of which must
# also occur; none needed when empty); first match wins.
WALL_TEXT = (
    ("Cavity - Uninsulated", "cavity", ("no insulation", "uninsulated")),
    ("Cavity - Insulated", "cavity", ("insulation",)),
    ("Solid - Uninsulated", "solid", ("no insulation", "uninsulated")),
    ("Solid - Insulated", "solid", ("insulation",)),
    ("Timber Frame", "timber", ()),
    ("System Build", "system", ()),
)
UNKNOWN_WALL = "Other/Unknown"

# Text hashed in place of NULL when a surrogate key is built.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"

# Retrofit score weights: inefficiency, achievable gain, carbon saving.
SCORE_WEIGHTS = (0.35, 0.40, 0.25)

# Tonnes of carbon dioxide an average car emits per year.
CAR_TONNES_PER_YEAR = 2.1

# Colour scale limits of the county bars and of the district map.
COUNTY_SCALE = (48.0, 76.0)
DISTRICT_SCALE = (45.0, 78.0)

# Vertex tolerance, in degrees, of outline simplification.
OUTLINE_TOLERANCE = 0.005
