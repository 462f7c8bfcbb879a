"""Schemas (as DDL) of canonical rows and changes: fixed values, names and order of columns."""

STORE_COLUMNS = ["network", "region", "city", "address", "work_time", "latitude", "longitude", "phone", "store_format", "status", "source_url", "collected_at"]
STORE_SCHEMA = ", ".join(f"{c} {'double' if c in ('latitude', 'longitude') else 'string'}" for c in STORE_COLUMNS)
SNAPSHOT_SCHEMA = f"{STORE_SCHEMA}, stable_key string"
TRACKED_FIELDS = ["region", "city", "address", "work_time", "latitude", "longitude", "phone", "store_format", "status", "source_url"]
ORDER_FIELDS = ["network", *TRACKED_FIELDS]
CHANGE_COLUMNS = ["network", "region", "city", "address", "source_url", "change_type", "changed_fields", "old_value", "new_value", "detected_at", "stable_key"]
CHANGE_SCHEMA = ", ".join(f"{c} string" for c in CHANGE_COLUMNS)
#: Older names of columns, in order of precedence; the first that is present counts even where it is null.
ALIASES = {"latitude": ("lat",), "longitude": ("lng", "lon"), "collected_at": ("parsed_at",)}
