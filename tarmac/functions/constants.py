"""Fixed values that must equal the source project's for identical results.

They are stated once, in natural order, and used by name everywhere else.
"""

from __future__ import annotations

# --- fixed values: carriers kept by the staging model (filter list) ---
STAGED_CARRIERS = ("AA", "UA", "DL")

# --- fixed values: carrier code -> display name; anything else is 'Other' ---
CARRIER_NAMES = {
    "AA": "American Airlines",
    "UA": "United Airlines",
    "DL": "Delta Air Lines",
}
CARRIER_NAME_DEFAULT = "Other"

# --- fixed values: carrier code -> carrier group; anything else is 'Other' ---
CARRIER_GROUPS = {"AA": "Major", "UA": "Major", "DL": "Major"}
CARRIER_GROUP_DEFAULT = "Other"

# --- fixed values: US Census regions by state code, first match wins ---
CENSUS_REGIONS = (
    ("Northeast", ("CT", "ME", "MA", "NH", "NJ", "NY", "PA", "RI", "VT")),
    ("Midwest", ("IL", "IN", "IA", "KS", "MI", "MN", "MO", "NE", "ND", "OH", "SD", "WI")),
    ("South", ("AL", "AR", "DE", "FL", "GA", "KY", "LA", "MD", "MS", "NC", "OK", "SC",
               "TN", "TX", "VA", "WV", "DC")),
    ("West", ("AK", "AZ", "CA", "CO", "HI", "ID", "MT", "NV", "NM", "OR", "UT", "WA", "WY")),
)
REGION_DEFAULT = "Territory/Other"

# --- fixed values: load contract ---
NULL_TOKENS = ("", "NULL")                 # text that becomes NULL at load
LANDING_FILE_GLOB = "*on_time_*.csv.gz"   # only these files are loaded
LANDING_PATH_REGEX = r".*on_time_.*\.csv\.gz"   # the same over the whole path
CSV_QUOTE = '"'

# --- fixed values: calendar dimension ---
DATE_SPINE_START = "2024-01-01"
DATE_SPINE_DAYS = 366                     # 2024 is a leap year
WEEKEND_DAYS = (0, 6)                     # Sunday = 0, Saturday = 6

# --- fixed values: data-quality rules declared on the staging model ---
ACCEPTED_YEARS = (2024,)
ACCEPTED_MONTHS = tuple(range(1, 13))
ACCEPTED_BOOLEANS = (True, False)

# --- ingestion log: default labels of a run (parameters of ``ingestion_log``) ---
PIPELINE_NAME = "flights_ingestion"
SCHEDULED_PIPELINE_NAME = "flights_scheduled"

# --- fixed values: ingestion log ---
SOURCE_SYSTEM = "DOT BTS Reporting Carrier On-Time Performance"
LOG_STEP = "recompress_and_upload_gzip"
LOG_STATUS = "SUCCESS"
