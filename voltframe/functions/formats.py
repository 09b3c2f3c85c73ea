"""Payload format detection (SF1, SF2, SF8, ST2, ST3) as one CASE expression each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltframe.schemas import FORMATS

# Fixed values (must equal the reference's tables).
# Header rule, first match wins: content-type containing
#   application/json -> json; text/csv -> csv; text/xml or application/xml -> xml;
#   text/html -> html; text/tab-separated-values -> tsv
HEADER_RULES = [
    (("application/json",), "json"),
    (("text/csv",), "csv"),
    (("text/xml", "application/xml"), "xml"),
    (("text/html",), "html"),
    (("text/tab-separated-values",), "tsv"),
]
# Extension map: csv json txt xml tsv html htm yaml yml parquet bin
EXTENSIONS = {"csv": "csv", "json": "json", "txt": "txt", "xml": "xml", "tsv": "tsv", "html": "html",
              "htm": "html", "yaml": "yaml", "yml": "yaml", "parquet": "parquet", "bin": "bin"}
# Whitespace stripped before content tests (ASCII part of Python's str.strip()).
STRIP_CHARS = " \t\n\r\x0b\x0c"


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(STRIP_CHARS))


def strict_parse_json(c: Column) -> Column:
    """JSON text to Variant, NULL unless the WHOLE text is one JSON value.  Spark's
    parser stops after the first complete value ('[1]x' parses as [1]); wrapping the
    text as one array element makes any trailing content a syntax error."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    return F.try_variant_get(wrapped, "$[0]", "variant")


VARIANT_BYTES = 16 << 20     # fixed value: the engine's limit for one Variant


def too_long_for_variant(c: Column) -> Column:
    return F.octet_length(c) > VARIANT_BYTES // 2


def is_json_container(c: Column) -> Column:
    """Text that parses as a JSON object or array (a dict/list payload).  Only text
    whose first non-blank character is '{' or '[' is parsed at all; one too long for
    Variant is read by the streaming JSON functions."""
    head = F.substring(stripped(c), 1, 1)
    kind = F.schema_of_variant(F.when(~too_long_for_variant(c), strict_parse_json(c)))
    streamed = F.json_array_length(c).isNotNull() | F.json_object_keys(c).isNotNull()
    parses = F.when(too_long_for_variant(c), streamed).otherwise(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
    return F.coalesce(head.isin("{", "[") & parses, F.lit(False))


def detect_by_header(content_type: Column, content: Column) -> Column:
    """SF1: content-type header first, then content: dict/list -> json, text wrapped in
    '<' ... '>' -> xml, text with ',' and a newline -> csv, other text -> txt, no text -> bin."""
    ct = F.lower(F.coalesce(content_type, F.lit("")))
    expr = None
    for needles, fmt in HEADER_RULES:
        cond = None
        for n in needles:
            c = F.instr(ct, n) > 0
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, fmt) if expr is None else expr.when(cond, fmt)
    s = stripped(content)
    return (expr.when(content.isNull(), "bin")
            .when(is_json_container(content), "json")
            .when(s.startswith("<") & s.endswith(">"), "xml")
            .when((F.instr(content, ",") > 0) & (F.instr(content, "\n") > 0), "csv")
            .otherwise("txt"))


def extension(path: Column) -> Column:
    """ST3: text after the last '.', lower-cased; NULL when the path has no '.'."""
    return F.when(F.instr(path, ".") > 0, F.lower(F.substring_index(path, ".", -1)))


def format_from_extension(path: Column) -> Column:
    m = F.create_map(*[x for k, v in EXTENSIONS.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, extension(path))


def detect_by_content(content: Column, html_first: bool = False) -> Column:
    """Content rules of SF2.  The XML test comes before the HTML test, so most HTML
    pages are 'xml'; ``html_first`` swaps the two tests."""
    s = stripped(content)
    head = F.lower(F.substring(s, 1, 14))           # prefix tests need 14 characters at most
    xml = head.startswith("<?xml") | (s.startswith("<") & s.endswith(">"))
    html = head.startswith("<!doctype html") | content.rlike("(?i)<html")
    tsv = (F.instr(content, "\t") > 0) & (F.instr(content, "\n") > 0)
    csv = (F.instr(content, ",") > 0) & (F.instr(content, "\n") > 0)
    first, second = (("html", html), ("xml", xml)) if html_first else (("xml", xml), ("html", html))
    return (F.when(content.isNull(), "bin")
            .when(is_json_container(content), "json")
            .when(first[1], first[0]).when(second[1], second[0])
            .when(tsv, "tsv").when(csv, "csv").otherwise("txt"))


def detect_by_extension(path: Column, content: Column, html_first: bool = False) -> Column:
    """SF2: extension first, else content."""
    return F.coalesce(format_from_extension(path), detect_by_content(content, html_first))


def declared_or_detected(declared: Column, detected: Column) -> Column:
    """SF8: a valid declared format wins, else the detected one."""
    return F.when(F.lower(declared).isin(FORMATS), F.lower(declared)).otherwise(detected)


def folder_name(name: Column) -> Column:
    """ST2: lower-case, spaces to '_'."""
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))
