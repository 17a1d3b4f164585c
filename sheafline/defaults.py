"""Parameter tables. Every operator takes these as keyword arguments."""

# --- Fixed values: they must equal the documented behaviour for equal results. ---

# Text that means "no value" when a CSV cell is read.
READ_NULLS = [
    "", "NA", "N/A", "n/a", "null", "NULL", "nan", "NaN", "None", "#N/A", "#NA", "<NA>",
    "-NaN", "-nan", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN", "#N/A N/A",
]

# Text that means "no value" after cell cleaning (exact, case-sensitive).
NULL_FLAGS = [
    "NA", "na", "N/A", "n/a", "-", "Null", "NULL", "null", ".", "None", "none",
    "", " ", "  ", "NaN", "nan", "#N/A", "#NA", "Missing", "missing",
]

# Characters that decorate numbers.
NUMBER_DECORATION = ",$₹"

# A text column counts as numeric from this share of number-like values on.
NUMERIC_SHARE = 0.7

# Similarity thresholds: resolving a column, and adding a name to a standard (strictly above).
RESOLVE_SCORE = 85
ASSIGN_ABOVE = 70

# Name patterns of the fallback schema, in order; searched in the squeezed lower-case name.
FALLBACK_PATTERNS = [
    ("district", ["district", "dist", "zilla", "jilla", "location"]),
    ("state", ["state", "rajya", "region"]),
    ("cattle_count", ["cattle", "gau", "bovine.*cattle", "cat"]),
    ("buffalo_count", ["buffalo", "bhains", "bovine.*buffalo", "buf"]),
    ("goat_count", ["goat", "bakri", "ruminant.*goat", "gt"]),
    ("sheep_count", ["sheep", "bhed", "ruminant.*sheep", "shp"]),
    ("year", ["year", "yr", "varsh", "data.*year", "census.*year", "survey.*year"]),
]
FALLBACK_STANDARDS = {
    "jurisdiction_level": "Unknown",
    "sector": "Unknown",
    "ministry": "Government of India",
}

# Years strictly between these bounds are believed.
YEAR_ABOVE, YEAR_BELOW = 1900, 2030
TOP_LOCATIONS = 5
SAMPLE_ROWS = 3
SAMPLE_CHARS = 500

# Page extraction.
PORTAL_BASE = "https://data.gov.in"
PORTAL_NAME = "data.gov.in"
PORTAL_PUBLISHER = "Government of India (via data.gov.in)"
UNKNOWN_TITLE = "Unknown Dataset"
MINISTRY_LABELS = ["Ministry/Department", "Ministry", "Department", "Source"]
SECTOR_LABELS = ["Sector", "Category"]
LINK_KEYWORD = "csv"
LINKS_PER_PAGE = 3
RESOURCE_NAME_CHARS = 50

# Names.
SLUG_CHARS = 100
