"""File sources (SRC1, SRC2, SRC4, SRC5, SRC8): fixed schemas, no inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.formats import detect_by_extension, extension
from voltframe.schemas import KWH, READING_TEXT

# How the writers spell what has a meaning in HTML or ends a line, and what
# stands between text payloads (the ASCII record separator).
HTML_ESCAPES = {"&": "&amp;", "<": "&lt;", ">": "&gt;", "\n": "&#10;", "\r": "&#13;"}
RECORD_SEPARATOR = "\x1e"


def read_kwh_csv(spark: SparkSession, path: str, schema: T.StructType = KWH) -> DataFrame:
    """SRC1: kWh table, CSV with one header line, comma-delimited."""
    return spark.read.schema(schema).option("header", True).option("sep", ",").csv(path)


def read_readings_json(spark: SparkSession, path: str, schema: T.StructType = READING_TEXT, lines: bool = False) -> DataFrame:
    """SRC2: landed reading records.  A landed file is one JSON document, an array of records
    or one record, indented or not; ``lines`` reads files of one record a line.  Every field
    is read as text and typed by the cleaner; an empty landing gives an empty frame with the
    same schema."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def payload_text(content):
    """Bytes as text where they are UTF-8, else NULL."""
    return F.try_validate_utf8(content.cast("string"))


def read_payloads(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """SRC4: scan a landing folder of mixed-format payload files, one row per file: path,
    size, modification time, the bytes, their text (NULL if they are not UTF-8) and the
    detected format (SF2: extension first, else content; ``bin`` without text)."""
    return described_payloads(spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path))


def described_payloads(raw: DataFrame) -> DataFrame:
    """What ``read_payloads`` gives of a frame of the ``binaryFile`` source, read once or as a stream."""
    return raw.select(F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
                      F.col("content").alias("raw"), payload_text(F.col("content")).alias("content")).withColumn(
                          "format", detect_by_extension(F.col("path"), F.col("content")))


def list_files(spark: SparkSession, prefix: str, file_format: str | None = None,
               recursive: bool = True) -> DataFrame:
    """SRC5: stored files under a prefix with size, time and the format named by the
    extension, optionally one format only.  Only file metadata is read (the content
    column is pruned from the binaryFile scan)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(prefix)
             .select(F.col("path").alias("key"), F.col("length").alias("size"),
                     F.col("modificationTime").alias("last_modified")))
    files = files.withColumn("detected_format", extension(F.col("key")))
    return files.filter(F.col("detected_format") == file_format) if file_format else files


def read_back(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC8: read any sink format back (tsv is csv with a tab)."""
    r = spark.read
    if schema is not None and fmt not in ("html", "yaml", "txt", "text", "bin"):
        r = r.schema(schema)
    if fmt in ("csv", "tsv"):
        # a bare empty field is NULL, a quoted one is empty text
        return r.options(header=True, multiLine=True, escape='"', lineSep="\n", sep="\t" if fmt == "tsv" else ",", nullValue="\0",
                         ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="").csv(path)
    if fmt == "json":
        return r.json(path)
    if fmt == "parquet":
        return r.parquet(path)
    if fmt == "xml":
        return r.format("xml").options(rowTag="row", ignoreSurroundingSpaces=False).load(path)
    if fmt == "html":
        return read_html(spark, path, schema) if schema is not None else r.text(path)
    if fmt == "text":
        return r.option("lineSep", RECORD_SEPARATOR).text(path)
    if fmt in ("txt", "yaml"):
        return r.text(path)
    if fmt == "bin":
        return r.format("binaryFile").load(path)
    raise ValueError(f"unknown format: {fmt}")


def read_html(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of written HTML tables; an empty cell is NULL."""
    lines = spark.read.text(path).where(F.col("value").startswith("<tr>"))
    cells = lines.select(F.regexp_extract_all("value", F.lit("<td>([^<]*)</td>"), F.lit(1)).alias("cells"))

    def plain(c):
        for shown, spelled in reversed(HTML_ESCAPES.items()):
            c = F.replace(c, F.lit(spelled), F.lit(shown))
        return F.nullif(c, F.lit(""))
    return cells.select(*[plain(F.col("cells")[i]).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])
