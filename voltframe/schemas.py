"""Fixed schemas at the entry points (no inference on landed data)."""

from pyspark.sql import types as T

PRICE_COLUMNS = ["lmp_total", "energy_component", "congestion_component", "loss_component"]
REQUIRED_COLUMNS = ["timestamp", "location_id", *PRICE_COLUMNS]
CRITICAL_COLUMNS = ["timestamp", "location_id", "lmp_total"]
DEDUP_KEYS = ["timestamp", "location_id"]

# One 15-minute locational price reading (UTC).
READING = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("location_id", T.StringType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("lmp_total", T.DoubleType()),
    T.StructField("energy_component", T.DoubleType()),
    T.StructField("congestion_component", T.DoubleType()),
    T.StructField("loss_component", T.DoubleType()),
    T.StructField("extraction_time", T.TimestampType()),
])

# Landed readings before typing: every field as text (coerced by the cleaner).
READING_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in READING.fields])

# kWh series (CSV, one header line, comma).
KWH = T.StructType([
    T.StructField("DateTime", T.TimestampType()),
    T.StructField("kWh", T.DecimalType(15, 1)),
])

# Upload manifest row.
MANIFEST = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("data_format", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("columns", T.IntegerType()),
    T.StructField("column_names", T.StringType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("upload_timestamp", T.TimestampType()),
])

# Allowed sink/landing formats.
FORMATS = ["csv", "json", "txt", "parquet", "xml", "tsv", "html", "yaml", "bin"]
