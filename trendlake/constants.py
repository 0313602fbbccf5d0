"""Fixed values the results depend on, in one place.

Regions, thresholds and watched columns are defaults: the functions that use
them take them as arguments too. Formats, patterns and names are fixed.
"""

# The ten landed regions.
LANDED_REGIONS = ("us", "gb", "ca", "de", "fr", "in", "jp", "kr", "mx", "ru")

# Spelling of the short trending date (year.day.month).
SHORT_DATE_FORMAT = "yy.dd.MM"
SHORT_DATE_PATTERN = r"^\d{2}\.\d{2}\.\d{2}$"

# Landing path parts and run identifier.
DATE_PARTITION_FORMAT = "yyyy-MM-dd"
HOUR_PARTITION_FORMAT = "HH"
INGESTION_ID_FORMAT = "yyyyMMdd_HHmmss"
ISO_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# File routing.
REGION_IN_FILE_NAME = r"^([A-Z]{2})"
REGION_IN_PATH = r"(?:^|/)region=([^/]*)"
UNKNOWN_REGION = "unknown"
STATISTICS_KIND = "raw_stats"
REFERENCE_KIND = "raw_stats_reference_data"
UNKNOWN_KIND = "raw_stats_unknown"

# Fixed value: name given to a category the reference data does not know.
UNKNOWN_CATEGORY = "Unknown"

# Quality thresholds and columns that must be there.
MIN_ROW_COUNT = 10
MAX_NULL_PERCENT = 5.0
MAX_VIEWS = 50_000_000_000
FRESHNESS_HOURS = 48
CRITICAL_STATISTICS_COLUMNS = ("video_id", "title", "channel_title", "views", "region")
CRITICAL_REFERENCE_COLUMNS = ("category_id", "region")

# Columns watched, without failing, while silver is written.
WATCHED_STATISTICS_COLUMNS = ("video_id", "title", "channel_title", "views")
WATCHED_REFERENCE_COLUMNS = ("category_id", "category_title", "region")
