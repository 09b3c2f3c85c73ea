"""JSON flattening, payload records, record counts, URL checks, header redaction and
XML rendering (SF3-SF7, AG17, PF9), on table columns instead of single objects.

Flattening of unknown JSON parses each document once, in Arrow batches, with Python's parser, whose rules
are the ones to match, or is a projection made from the documents' shape (``variants``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions import variants as V
from voltframe.functions.formats import strict_parse_json, too_long_for_variant


# Header names redacted case-insensitively, and the replacement text.
SENSITIVE_HEADERS = ["authorization", "x-api-key", "api-key", "token",
                     "cookie", "set-cookie", "x-auth-token", "password"]
REDACTED = "[REDACTED]"
URL_SCHEMES = ["http", "https"]


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def py_float_text(d: Column) -> Column:
    """A double as Python's ``str(float)`` writes it (shortest digits; fixed notation for
    decimal exponents -4..15 with at least one fractional digit, else 'de+XX'), derived
    from Java's shortest text.  Pure Catalyst expressions."""
    s = d.cast("string")
    sci = F.instr(s, "E") > 0
    neg = s.startswith("-")
    body = F.regexp_replace(s, "^-", "")
    mant = F.regexp_extract(body, r"^([0-9.]+)E", 1)
    exp = F.regexp_extract(body, r"E(-?[0-9]+)$", 1).cast("int")
    digits = F.regexp_replace(F.regexp_replace(mant, r"\.", ""), "0+$", "")
    digits = F.when(digits == "", F.lit("0")).otherwise(digits)
    n = F.length(digits)
    # fixed notation from (digits, exp)
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    int_part = F.rpad(digits, F.greatest(exp + 1, n), "0").substr(F.lit(1), exp + 1)
    frac = F.when(n > exp + 1, digits.substr(exp + 2, F.lit(1000))).otherwise(F.lit("0"))
    fixed = F.when(exp < 0, small).otherwise(F.concat(int_part, F.lit("."), frac))
    m_py = F.regexp_replace(mant, r"\.0$", "")
    e_py = F.concat(F.lit("e"), F.when(exp < 0, "-").otherwise("+"), F.when(F.abs(exp) < 10, F.concat(F.lit("0"), F.abs(exp).cast("string")))
                   .otherwise(F.abs(exp).cast("string")))
    from_sci = F.when((exp >= -4) & (exp < 16), fixed).otherwise(F.concat(m_py, e_py))
    out = F.when(sci, F.concat(F.when(neg, "-").otherwise(""), from_sci)).otherwise(s)
    return F.when(d.isNull(), None).when(F.isnan(d), "nan").when(d == float("inf"), "inf") \
        .when(d == float("-inf"), "-inf").otherwise(out)


def _leaves(value, sep: str, start: str = ""):
    """(key, text) of every scalar in document order, without recursion: object names join
    with ``sep``, list items add ``sep`` and their position, empty containers vanish."""
    todo = [(start, value)]
    while todo:
        key, value = todo.pop()
        if isinstance(value, dict):
            todo += [(f"{key}{sep}{k}" if key else k, v) for k, v in reversed(value.items())]
        elif isinstance(value, list):
            todo += [(f"{key}{sep}{i}", value[i]) for i in range(len(value) - 1, -1, -1)]
        else:
            yield key, None if value is None else str(value)


def _parsed(text: str):
    """(value, None) of a JSON text, or (None, why it has none).  Repeated names: the last wins."""
    import json
    try:
        return json.loads(text), None
    except RecursionError:
        return None, "nested too deeply for the parser"
    except ValueError as e:
        return None, f"not JSON: {e}"


def _json_rows(df: DataFrame, id_cols: list[str], json_col: str, fields: str, rows_of) -> DataFrame:
    """``rows_of(value, why)`` of every document that is not NULL, after its id columns.  Each
    document is parsed once, by itself, in Arrow batches; one text of a batch is held at a time."""
    from pyspark.sql import types as T

    frame = df.select(*id_cols, F.col(json_col).alias("_document"))
    out = T.StructType(frame.schema.fields[:-1] + T._parse_datatype_string(fields).fields)
    n = len(id_cols)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            taken, columns = [], [[] for _ in range(len(out.fields) - n)]
            for i, text in enumerate(batch.column(n)):
                for row in rows_of(*_parsed(text.as_py())) if text.is_valid else ():
                    taken.append(i)
                    for column, value in zip(columns, row):
                        column.append(value)
                if len(taken) > 1 << 16:
                    yield made(pa, batch, taken, columns)
                    taken, columns = [], [[] for _ in columns]
            yield made(pa, batch, taken, columns)

    kinds = [f.dataType.simpleString() for f in out.fields[n:]]

    def made(pa, batch, taken, columns):
        arrow = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
        ids = [batch.column(k).take(pa.array(taken, pa.int64())) for k in range(n)]
        return pa.RecordBatch.from_arrays(ids + [pa.array(c, arrow[k]) for c, k in zip(columns, kinds)], names=out.names)

    return frame.mapInArrow(run, out)


def flatten_json(df: DataFrame, id_cols: list[str], json_col: str, sep: str = "_",
                 strip_leading_sep: bool = False, native: bool = False) -> DataFrame:
    """SF3 on JSON text: long (ids..., key, value) rows.

    Keys join object names with ``sep``; list items add ``sep`` + position (so a top-level
    list yields '_0...', as the reference does; ``strip_leading_sep`` drops it).  Empty objects
    and lists vanish, JSON null is a NULL value, and of equal keys the later leaf in the
    document wins.  A document's rows depend on that document alone.

    Documents are parsed in Arrow batches by Python's parser, whose rules are the ones to match.
    With ``native`` their shape is found in one pass first, and a projection made from it flattens them in the
    JVM (``variants``), but for documents that Variant can't stand for, and all of them where the
    shape leaves keys open; the plan has a Python worker only if there are any.  The rows are the
    same; the parser is the faster of the two (README).  NULL gives no row, and a text that is not JSON is a row
    of ``payload_rejects``."""
    if not native:
        return _flatten_parsed(df, id_cols, json_col, sep, strip_leading_sep)
    shape, odd, numbers = V.shape_of(df, json_col, sep)
    if shape is None:
        return _flatten_parsed(df, id_cols, json_col, sep, strip_leading_sep)
    v, is_odd = V.variant_documents(json_col, numbers)
    typed = df.select(*id_cols, v.alias("_v")).select(*id_cols, F.explode(V.leaves(F.col("_v"), shape, sep)).alias("_leaf"))
    key = F.regexp_replace("_leaf.key", "^" + re.escape(sep), "") if strip_leading_sep else F.col("_leaf.key")
    out = typed.select(*id_cols, key.alias("key"), F.col("_leaf.value").alias("value"))
    return out.unionByName(_flatten_parsed(df.where(is_odd), id_cols, json_col, sep, strip_leading_sep)) if odd else out


def flatten_json_wide(df: DataFrame, id_cols: list[str], json_col: str, sep: str = "_") -> DataFrame:
    """SF3 as one row a document and one text column a key, the frame that the reference makes: columns come
    from the documents' shape, lists as far as the longest.  Missing and null are both NULL.  Only a
    frame whose shape leaves keys open, or with documents for Python's parser, is pivoted from its long form."""
    shape, odd, numbers = V.shape_of(df, json_col, sep)
    if shape is None or odd:
        return flatten_wide(flatten_json(df, id_cols, json_col, sep), id_cols)
    v, _ = V.variant_documents(json_col, numbers)
    parsed = df.where(F.col(json_col).isNotNull()).select(*id_cols, v.alias("_v"))
    return parsed.select(*id_cols, *(c.alias(name) for name, c in V.wide_columns(parsed, F.col("_v"), shape, sep)))


def _flatten_parsed(df: DataFrame, id_cols: list[str], json_col: str, sep: str, strip_leading_sep: bool) -> DataFrame:
    def rows(value, why):
        if why is None:
            last = dict(_leaves(value, sep))
            yield from (((k[len(sep):] if strip_leading_sep and k.startswith(sep) else k), v) for k, v in last.items())
    return _json_rows(df, id_cols, json_col, "key string, value string", rows)


def payload_rejects(df: DataFrame, id_cols: list[str], json_col: str) -> DataFrame:
    """The documents that flattening leaves out: ids, characters, and the reason."""
    sized = df.select(*id_cols, F.col(json_col), F.char_length(json_col).cast("long").alias("n_chars"))
    return _json_rows(sized, [*id_cols, "n_chars"], json_col, "reason string",
                      lambda value, why: [(why,)] if why is not None else [])


def flatten_struct(df: DataFrame, id_cols: list[str], col: str, sep: str = "_") -> DataFrame:
    """SF3 for a known schema: one wide row per input row, a column per leaf path,
    built as a generated ``select`` (no Variant, no explode).  Struct fields join with
    ``sep``; arrays expand to positions 0..max observed length - 1, one aggregate of
    array sizes per nesting frontier; shorter arrays give NULLs (the wide-frame form).
    Maps are kept as JSON text leaves."""
    from pyspark.sql import types as T

    def join(prefix: str, part) -> str:
        return str(part) if prefix == "" and not isinstance(part, int) else f"{prefix}{sep}{part}"

    leaves: list[tuple[str, Column]] = []
    frontier = [("", F.col(col), df.schema[col].dataType)]
    while frontier:
        arrays = [(n, c, t) for n, c, t in frontier if isinstance(t, T.ArrayType)]
        sizes = {}
        if arrays:
            row = df.agg(*[F.coalesce(F.max(F.size(c)), F.lit(0)).alias(f"s{i}")
                           for i, (_, c, _) in enumerate(arrays)]).first()
            sizes = {n: max(int(row[f"s{i}"]), 0) for i, (n, _, _) in enumerate(arrays)}
        nxt = []
        for name, c, t in frontier:
            if isinstance(t, T.StructType):
                nxt += [(join(name, f.name), c[f.name], f.dataType) for f in t.fields]
            elif isinstance(t, T.ArrayType):
                nxt += [(join(name, i), F.try_element_at(c, F.lit(i + 1)), t.elementType)
                        for i in range(sizes[name])]
            elif isinstance(t, T.MapType):
                leaves.append((name, F.to_json(c)))
            else:
                leaves.append((name, c))
        frontier = nxt
    return df.select(*id_cols, *[c.alias(n) for n, c in leaves])


def flatten_wide(long: DataFrame, id_cols: list[str], keys: list[str] | None = None) -> DataFrame:
    """Long -> one column per key.  The key list is the payload schema's width; pass it
    when known so the pivot needs no extra pass."""
    return long.groupBy(*id_cols).pivot("key", keys).agg(F.first("value"))


def payload_rows(df: DataFrame, id_cols: list[str], json_col: str, sep: str = "_", native: bool = False) -> DataFrame:
    """SF5: a list payload gives one record per element, a dict one record (flattened
    when nested), a scalar one record with key 'value'.  Long form
    (ids..., record, key, value), rejects as for ``flatten_json``; with ``native`` in the JVM where the
    shapes of lists, dicts and scalars allow it."""
    if not native:
        return _payload_parsed(df, id_cols, json_col, sep)
    shapes, odd, numbers = V.payload_shapes(df, json_col, sep)
    if shapes is None:
        return _payload_parsed(df, id_cols, json_col, sep)
    v, is_odd = V.variant_documents(json_col, numbers)
    parsed = df.select(*id_cols, v.alias("_v")).where(F.col("_v").isNotNull())
    out = parsed.select(*id_cols, F.explode(V.payload_leaves(F.col("_v"), shapes, sep)).alias("_leaf")).select(*id_cols, "_leaf.*")
    return out.unionByName(_payload_parsed(df.where(is_odd), id_cols, json_col, sep)) if odd else out


def _payload_parsed(df: DataFrame, id_cols: list[str], json_col: str, sep: str) -> DataFrame:
    def rows(value, why):
        if why is not None:
            return
        for i, record in enumerate(value if isinstance(value, list) else [value]):
            if isinstance(record, (dict, list)):
                yield from ((i, k, v) for k, v in dict(_leaves(record, sep)).items())
            else:
                yield i, "value", None if record is None else str(record)
    return _json_rows(df, id_cols, json_col, "record int, key string, value string", rows)


def record_count(content: Column) -> Column:
    """AG17: JSON array -> its length, JSON object -> 1, text -> newlines + 1,
    empty or missing -> 0."""
    head = F.substring(F.btrim(content, F.lit(" \t\n\r\x0b\x0c")), 1, 1)
    v = F.when(head.isin("{", "[") & ~too_long_for_variant(content), strict_parse_json(content))
    kind = _kind(v)
    newlines = F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit("")))
    long = too_long_for_variant(content)
    return (F.when(content.isNull() | (content == ""), 0)
            .when(long & (head == "["), F.coalesce(F.json_array_length(content), newlines + 1))
            .when(long & (head == "{") & F.json_object_keys(content).isNotNull(), 1)
            .when(F.coalesce(kind.startswith("ARRAY"), F.lit(False)), F.size(F.try_variant_get(v, "$", "array<variant>")))
            .when(F.coalesce(kind.startswith("OBJECT"), F.lit(False)), 1)
            .otherwise(newlines + 1)).cast("long")


def valid_url(url: Column) -> Column:
    """PF9: scheme http or https (either case) and something before the next '/', '?' or '#'
    after '//'.  Control characters and spaces around are dropped first, line ends and tabs
    anywhere, and nothing else about the text is judged: blanks, '_' or '{' may stand in it."""
    c = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    scheme = F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    host = F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    balanced = F.contains(host, F.lit("[")) == F.contains(host, F.lit("]"))    # an open bracket is no address
    return F.coalesce(scheme.isin(URL_SCHEMES) & (host != "") & balanced, F.lit(False))


def redact_headers(headers: Column) -> Column:
    """SF6: replace sensitive header values, names compared case-insensitively."""
    names = F.array(*[F.lit(n) for n in SENSITIVE_HEADERS])
    return F.transform_values(
        headers, lambda k, v: F.when(F.array_contains(names, F.lower(k)), F.lit(REDACTED)).otherwise(v))


def xml_name(name: str) -> str:
    """SF4 element-name rule: ' ' and '-' become '_'."""
    return name.replace(" ", "_").replace("-", "_")


def to_xml_record(df: DataFrame, cols: list[str] | None = None, row_tag: str = "root") -> Column:
    """SF4 for a fixed-shape record: a ``to_xml`` of a struct whose field names follow the
    element-name rule."""
    cols = cols or df.columns
    return F.to_xml(F.struct(*[F.col(c).alias(xml_name(c)) for c in cols]), {"rowTag": row_tag})


# Characters that XML text can't hold, what stands for markup in it, and what names may hold.
NO_XML_TEXT = re.compile("[^\t\n\r\x20-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")
MARKUP = str.maketrans({"&": "&amp;", "<": "&lt;", ">": "&gt;", "\r": "&#13;"})
NO_XML_NAME = re.compile(r"[^\w.]")


def _element(name: str) -> str:
    """An element name: the rule of ``xml_name``, and '_' for what no name may hold or begin with."""
    name = NO_XML_NAME.sub("_", xml_name(name))
    return name if name[:1].isalpha() or name[:1] == "_" else f"_{name}"


def _xml(value, root: str) -> str:
    """A JSON value as elements, without recursion: names of objects, ``item_i`` for lists, the text of
    scalars as Python has it (None, True), an empty element for what holds nothing."""
    out, todo = [], [(root, value)]
    while todo:
        name, value = todo.pop()
        if name is None:
            out.append(value)
        elif isinstance(value, (dict, list)) and value:
            children = [(_element(k), v) for k, v in value.items()] if isinstance(value, dict) else [(f"item_{i}", v) for i, v in enumerate(value)]
            out.append(f"<{name}>")
            todo.append((None, f"</{name}>"))
            todo += reversed(children)
        else:
            text = "" if isinstance(value, (dict, list)) else NO_XML_TEXT.sub("\ufffd", str(value)).translate(MARKUP)
            out.append(f"<{name}>{text}</{name}>" if text else f"<{name} />")
    return "".join(out)


def json_to_xml(df: DataFrame, id_cols: list[str], json_col: str, root: str = "root") -> DataFrame:
    """SF4 for payloads of unknown shape: (ids..., xml) of JSON texts.  Names follow the element-name
    rule at every level, list items are ``item_0 .. item_n`` of their own list (no padding to the longest),
    and texts are escaped; NULL gives no row, and a text that is not JSON is a row of ``payload_rejects``.
    Beyond the reference, names and characters that XML can't hold are replaced, so the result can be read."""
    return _json_rows(df, id_cols, json_col, "xml string", lambda value, why: [(_xml(value, root),)] if why is None else [])


def json_text(df: DataFrame, cols: list[str] | None = None) -> Column:
    """SF7: a record as JSON text, every field there, and values that JSON has no kind for as Python
    writes them: times with a blank and a fraction only if there is one, dates, decimals, and bytes as text."""
    from pyspark.sql import types as T

    def plain(c: Column, dt) -> Column:
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            fraction = F.date_format(c, "SSSSSS")
            return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.when(fraction == "000000", "").otherwise(F.concat(F.lit("."), fraction)))
        if isinstance(dt, T.StructType):
            return F.when(c.isNotNull(), F.struct(*(plain(c[f.name], f.dataType).alias(f.name) for f in dt.fields)))
        if isinstance(dt, T.ArrayType):
            return F.transform(c, lambda x: plain(x, dt.elementType))
        return c.cast("string") if isinstance(dt, (T.DateType, T.DecimalType, T.BinaryType)) else c

    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.to_json(F.struct(*(plain(F.col(f"`{c}`"), kinds[c]).alias(c) for c in cols or df.columns)), {"ignoreNullFields": "false"})


def to_xml_payload(df: DataFrame, col: str, root: str = "root") -> Column:
    """SF4 for nested payloads: element names follow the rule (' ' and '-' to '_') and
    every list becomes ``item_0 .. item_n`` children, as the reference writes dicts and
    lists.  List lengths are the observed maxima (one size aggregate per nesting level);
    missing positions are omitted."""
    from pyspark.sql import types as T

    def sizes_for(exprs: list[Column]) -> list[int]:
        if not exprs:
            return []
        row = df.agg(*[F.coalesce(F.max(F.size(e)), F.lit(0)).alias(f"s{i}") for i, e in enumerate(exprs)]).first()
        return [max(int(row[f"s{i}"]), 0) for i in range(len(exprs))]

    def build(expr: Column, dt) -> Column:
        if isinstance(dt, T.StructType):
            return F.struct(*[build(expr[f.name], f.dataType).alias(xml_name(f.name)) for f in dt.fields])
        if isinstance(dt, T.ArrayType):
            (n,) = sizes_for([expr])
            items = [build(F.try_element_at(expr, F.lit(i + 1)), dt.elementType).alias(f"item_{i}")
                     for i in range(n)]
            return F.struct(*items) if items else F.lit(None).cast("string")
        return expr

    return F.to_xml(build(F.col(col), df.schema[col].dataType), {"rowTag": root})
