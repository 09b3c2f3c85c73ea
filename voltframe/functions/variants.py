"""Flattening JSON of unknown shape inside the JVM (SF3): the shape is found once, then a generated
projection reads it.

One aggregate over the documents gives the merged shape (``schema_of_variant_agg``) and how many
documents Variant can't stand for as Python's parser would: text that it doesn't parse or is too
long for it, and numbers that it rounds or respells.  The shape becomes one expression with a
``variant_get`` for each path; lists are walked by ``transform``, whatever their length.  No explode
by level, no shuffle, no Python worker.

``shape_of`` gives None where a projection can't tell documents apart: a path that holds
containers in some and scalars in others, or names that could make one key of two paths (digits
between separators).  The caller then parses with Python, as for the documents counted above.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions.formats import strict_parse_json, too_long_for_variant

# Numbers that Variant and Python write apart: integers beyond 64 bits, large exponents, a negative zero.
ODD_NUMBER = r"[0-9]{19}|[0-9.][eE][+-]?[0-9]{3}|(^|[:\[,\s])-0(\.0*)?([eE,\]}\s]|$)"
QUOTED = re.compile(r"['\"\\`\x00-\x1f]")


@dataclass
class Shape:
    """Kind of the values of a path: ``object`` (parts by name), ``array`` (one part), or a scalar."""
    kind: str
    parts: dict = field(default_factory=dict)
    digits: tuple[int, int] = (0, 0)        # of a decimal: all, and after the point

    def has_odd_numbers(self) -> bool:
        """Whether some value may be an integer beyond 64 bits or have a large exponent."""
        return self.kind in ("DOUBLE", "FLOAT", "VARIANT") or self.digits[0] - self.digits[1] >= 19 or any(s.has_odd_numbers() for s in self.parts.values())


def _parsed(text: str) -> Shape:
    """The shape that ``schema_of_variant_agg`` writes."""
    at = 0

    def name() -> str:
        nonlocal at
        if text[at] != "`":
            end = text.index(":", at)
            found, at = text[at:end], end
            return found
        found, at = "", at + 1
        while True:
            end = text.index("`", at)
            found, at = found + text[at:end], end + 1
            if text[at] != "`":
                return found
            found, at = found + "`", at + 1

    def shape() -> Shape:
        nonlocal at
        if text.startswith("OBJECT<", at):
            at += 7
            parts = {}
            while text[at] != ">":
                if text.startswith(", ", at):
                    at += 2
                key = name()
                at += 2                                  # ": "
                parts[key] = shape()
            at += 1
            return Shape("object", parts)
        if text.startswith("ARRAY<", at):
            at += 6
            part = shape()
            at += 1
            return Shape("array", {"": part})
        word = re.compile(r"[A-Z_]+(\(\d+,\d+\))?").match(text, at).group()
        at += len(word)
        kind, _, digits = word.partition("(")
        return Shape(kind, {}, tuple(map(int, digits[:-1].split(","))) if digits else (0, 0))

    return shape()


def _keys(shape: Shape, sep: str, key: str = "") -> list[str]:
    """The flattened keys as patterns, a list's places as ``\\d+``."""
    if shape.kind == "object":
        return [k for n, s in shape.parts.items() for k in _keys(s, sep, f"{key}{re.escape(sep)}{re.escape(n)}" if key else re.escape(n))] + [key]
    if shape.kind == "array":
        return _keys(shape.parts[""], sep, f"{key}{re.escape(sep)}\\d+") + [key]
    return [key]


def _sound(shape: Shape, sep: str) -> bool:
    """Whether every flattened key belongs to one path, and names can stand in a path expression."""
    todo, names = [shape], []
    while todo:
        s = todo.pop()
        if s.kind == "VARIANT":
            return False
        names += list(s.parts) if s.kind == "object" else []
        todo += s.parts.values()
    digits = re.compile(rf"(^|{re.escape(sep)})\d+({re.escape(sep)}|$)")
    if any(QUOTED.search(n) or not n or digits.search(n) for n in names):
        return False
    keys = _keys(shape, sep)
    plain = [k.replace("\\d+", "0") for k in keys]
    if len(set(plain)) < len(plain):
        return False
    if all(sep not in n for n in names):
        return True             # keys part into names and places in one way
    return not any(re.fullmatch(a, re.sub(r"\\(.)", r"\1", b)) for i, a in enumerate(keys) for j, b in enumerate(plain) if i != j)


def variant_documents(json_col: str, numbers: bool) -> tuple[Column, Column]:
    """The Variant of each document, NULL where it can't stand for it, and whether that is so.  ``numbers``:
    whether the documents' shape leaves room for numbers that are written apart."""
    text = F.col(json_col)
    odd = too_long_for_variant(text)
    for sign in (":-0", "[-0", ",-0", " -0", "\n-0", "\t-0"):
        odd = odd | F.contains(text, F.lit(sign))
    odd = odd | F.startswith(text, F.lit("-0"))
    if numbers:
        odd = odd | text.rlike(ODD_NUMBER)
    v = F.when(~odd, strict_parse_json(text))
    return v, text.isNotNull() & v.isNull()


def _first_pass(df: DataFrame, json_col: str, made) -> tuple:
    """One row of ``made`` aggregates over ``_v``, the documents that Variant can't stand for, and whether
    numbers were looked at: only where a first look at the shapes leaves room for odd ones."""
    for numbers in (False, True):
        v, odd = variant_documents(json_col, numbers)
        row = df.select(v.alias("_v"), odd.alias("_odd")).agg(*made, F.count_if("_odd").alias("odd")).first()
        shapes = [_parsed(x) if x else Shape("VOID") for x in row[:-1]]
        if numbers or not any(s.has_odd_numbers() for s in shapes):
            return shapes, row["odd"], numbers


def shape_of(df: DataFrame, json_col: str, sep: str) -> tuple[Shape | None, int, bool]:
    """The documents' shape (None: use the parser), how many of them Variant can't stand for, and
    whether that needs a look at their numbers."""
    (shape,), odd, numbers = _first_pass(df, json_col, [F.schema_of_variant_agg("_v").alias("shape")])
    return (shape if _sound(shape, sep) else None), odd, numbers


def _step(name: str) -> str:
    return f"['{name}']"


def scalar_text(v: Column, shape: Shape, path: str = "$") -> Column:
    """A scalar at a path as Python's ``str`` writes it, NULL for JSON's null."""
    from voltframe.functions.semistructured import py_float_text

    def read(as_type):
        return F.try_variant_get(v, path, as_type)

    if shape.kind == "BOOLEAN":
        return F.when(read("boolean"), "True").when(~read("boolean"), "False")
    if shape.kind == "DECIMAL" and shape.digits[0] <= 15 and shape.digits[1] <= 4:
        text = read("string")                            # digits that a float keeps, in plain notation
        return F.when(F.instr(text, ".") > 0, text).otherwise(F.concat(text, F.lit(".0")))
    if shape.kind in ("DOUBLE", "DECIMAL", "FLOAT"):
        number = py_float_text(read("double"))
        if shape.kind == "DECIMAL" and shape.digits[0] - shape.digits[1] < 19:
            return number                                # no integer is among them
        return F.when(F.schema_of_variant(read("variant")) == "BIGINT", read("string")).otherwise(number)
    return F.lit(None).cast("string") if shape.kind == "VOID" else read("string")


LEAF = "array<struct<key:string,value:string>>"


def leaves(v: Column, shape: Shape, sep: str, key: str | Column = "") -> Column:
    """(key, value) of every scalar of a Variant of a given shape, as one array."""
    parts = []

    def one(at: str, value: Column, there: Column):
        label = F.lit(join(key, at)) if isinstance(key, str) else F.concat(key, F.lit(at))
        return F.when(there, F.array(F.struct(label.alias("key"), value.alias("value")))).otherwise(F.array().cast(LEAF))

    def join(start, at):
        return start + at if start else at[len(sep):] if at.startswith(sep) else at

    def walk(path: str, at: str, s: Shape):
        here = F.try_variant_get(v, path, "variant")
        if s.kind == "object":
            for n, part in s.parts.items():
                walk(path + _step(n), f"{at}{sep}{n}", part)
            parts.append(one(at, F.lit(None).cast("string"), F.is_variant_null(here)))
        elif s.kind == "array":
            items = F.try_variant_get(v, path, "array<variant>")
            start = F.lit((key + at if key else at[len(sep):]) + sep) if isinstance(key, str) else F.concat(key, F.lit(at + sep))
            each = F.transform(items, lambda x, i: leaves(x, s.parts[""], sep, F.concat(start, i.cast("string"))))
            parts.append(F.coalesce(F.flatten(each), F.array().cast(LEAF)))
            parts.append(one(at, F.lit(None).cast("string"), F.is_variant_null(here)))
        else:
            parts.append(one(at, scalar_text(v, s, path), here.isNotNull()))

    walk("$", "", shape)
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def wide_columns(df: DataFrame, v: Column, shape: Shape, sep: str) -> list[tuple[str, Column]]:
    """(key, text) of every path, lists as far as the longest observed: one aggregate of lengths for each
    depth of lists."""
    found, todo = [], [("", "$", shape)]
    while todo:
        arrays = [(key, path, s) for key, path, s in todo if s.kind == "array"]
        sizes = {}
        if arrays:
            longest = [F.max(F.size(F.try_variant_get(v, path, "array<variant>"))).alias(f"n{i}") for i, (_, path, _) in enumerate(arrays)]
            row = df.agg(*longest).first()
            sizes = {path: row[f"n{i}"] or 0 for i, (_, path, _) in enumerate(arrays)}
        following = []
        for key, path, s in todo:
            if s.kind == "object":
                following += [(f"{key}{sep}{n}" if key else n, path + _step(n), part) for n, part in s.parts.items()]
            elif s.kind == "array":
                following += [(f"{key}{sep}{i}", f"{path}[{i}]", s.parts[""]) for i in range(sizes[path])]
            else:
                found.append((key, scalar_text(v, s, path)))
        todo = following
    return found


def _root(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    return F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").otherwise("scalar")


def payload_shapes(df: DataFrame, json_col: str, sep: str) -> tuple[dict[str, Shape] | None, int, bool]:
    """The shapes of documents that are objects, lists and scalars, each by themselves, how many
    documents Variant can't stand for, and whether that needs a look at their numbers."""
    kinds = ("object", "array", "scalar")
    found, odd, numbers = _first_pass(df, json_col, [F.schema_of_variant_agg(F.when(_root(F.col("_v")) == k, F.col("_v"))).alias(k) for k in kinds])
    shapes = dict(zip(kinds, found))
    # scalars of any kinds are one text each; everything else must have one shape
    good = all(_sound(shapes[k], sep) for k in ("object", "array"))
    return (shapes if good else None), odd, numbers


RECORD_LEAF = "array<struct<record:int,key:string,value:string>>"


def payload_leaves(v: Column, shapes: dict[str, Shape], sep: str) -> Column:
    """(record, key, value) of a payload: a list's elements are its records, anything else is one."""
    def numbered(items: Column, number: Column):
        # what has no key of its own is the record's value
        return F.transform(items, lambda x: F.struct(number.cast("int").alias("record"), F.when(x["key"] == "", "value").otherwise(x["key"]).alias("key"), x["value"].alias("value")))

    none = F.array().cast(RECORD_LEAF)
    root, kind = _root(v), F.schema_of_variant(v)
    element = shapes["array"].parts.get("", Shape("VOID"))
    listed = F.flatten(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: numbered(leaves(x, element, sep), i)))
    text = F.lit(None).cast("string")
    for word in ("STRING", "BOOLEAN", "BIGINT", "DOUBLE", "DECIMAL"):
        text = F.when(kind.startswith(word), scalar_text(v, Shape(word, {}, (38, 0)))).otherwise(text)
    alone = F.array(F.struct(F.lit(0).alias("record"), F.lit("value").alias("key"), text.alias("value")))
    one = numbered(leaves(v, shapes["object"], sep), F.lit(0)) if shapes["object"].kind == "object" else none
    return F.when(root == "array", F.coalesce(listed, none)).when(root == "object", one).otherwise(alone)
