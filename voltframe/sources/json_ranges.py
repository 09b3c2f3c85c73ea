"""SRC2 for files larger than a task: the records of JSON arrays, read by byte ranges.

Spark's JSON reader takes a file that isn't one record a line as one value, so one task holds it.
Here the text source reads it with ``}`` as the end of a line, which it can split anywhere: every
record ends with one.  What a piece means depends on what stands before it (whether it is
inside a text, and how deep), so there are two passes, both over all ranges at once:

1. for each range, whether it turns the text state (an odd number of quotes), and for either state at
   its start how far it goes up or down, and the lowest it gets: one row a range;
2. the driver adds those rows up in the order of the file (a row for each range of ``maxPartitionBytes``,
   as many as Spark's own plan holds), so each range knows where it stands, and finds its records.

Records that cross ranges are put together by the place where they begin.  A record is an object that is
an element of the file's array, or the file's one object.  Names, texts and nesting inside records may hold
anything, quotes, braces and escapes included.  A file that ends inside a record loses that record and is
reported by ``broken_files``.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ESCAPED = re.compile(r"\\.", re.DOTALL)
RANGE = "path string, begin bigint, seen bigint, odd boolean, up array<bigint>, low array<bigint>, is_array boolean"
PIECE = "path string, begin bigint, part bigint, text string, whole boolean"


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.option("lineSep", "}").text(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("begin"), "value")


def _outside(piece: str, inside: bool) -> tuple[str, bool]:
    """The characters of a piece that are in no text, and whether it ends inside one."""
    if "\\" in piece:
        piece = ESCAPED.sub("  ", piece)
    if '"' not in piece:
        return ("" if inside else piece), inside
    parts = piece.split('"')
    return "".join(parts[inside::2]), inside ^ (len(parts) % 2 == 0)


def _steps(outside: str, inside: bool) -> tuple[int, int]:
    """Change of depth over the piece, and with the brace that ends it."""
    up = outside.count("{") + outside.count("[") - outside.count("]")
    return up, up - (not inside)


def _measure(batches):
    """One row for each range that a task reads: pieces of a range come in order, ranges one by one."""
    now, state = None, None

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(("path", "begin", "seen", "odd", "up", "low", "is_array"), (*now, *state)))],
                                          schema=pa.schema([("path", pa.string()), ("begin", pa.int64()), ("seen", pa.int64()), ("odd", pa.bool_()),
                                                            ("up", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())), ("is_array", pa.bool_())]))

    for batch in batches:
        for path, begin, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if now != (path, begin):
                if now is not None:
                    yield row()
                now, state = (path, begin), [0, False, [0, 0], [0, 0], piece.lstrip("﻿ \t\r\n").startswith("[")]
            state[0] += 1
            for start in (0, 1):
                text, inside = _outside(piece, bool(start) ^ state[1])
                up, end = _steps(text, inside)
                state[2][start] += end
                state[3][start] = min(state[3][start], state[2][start])
            state[1] ^= _outside(piece, False)[1]
    if now is not None:
        yield row()


def _placed(ranges: list) -> tuple[dict, list]:
    """Where every range begins: (inside a text, depth, depth between records, range in which the
    open record began or None, last range of a file that ends inside a record); and those files."""
    out, broken, by_file = {}, [], {}
    for r in ranges:
        by_file.setdefault(r["path"], []).append(r)
    for path, rows in by_file.items():
        rows.sort(key=lambda r: r["begin"])
        base, inside, depth, opened = int(rows[0]["is_array"]), False, 0, None
        for r in rows:
            out[path, r["begin"]] = [inside, depth, base, opened, False]
            low, depth = depth + r["low"][inside], depth + r["up"][inside]
            if depth > base:
                opened = r["begin"] if opened is None or low <= base else opened
            else:
                opened = None
            inside ^= r["odd"]
        # a sound file ends on its last brace, or with what follows it and no brace
        if inside or depth > (0 if not base else -1):
            out[path, rows[-1]["begin"]][4] = True
            broken.append(path)
    return out, broken


def _found(places: dict):
    def run(batches):
        now, rows = None, []
        held, inside, depth, base, opened, last_broken, ended = [], False, 0, 0, None, False, None

        def made():
            nonlocal rows
            done, rows = rows, []
            names = ("path", "begin", "part", "text", "whole")
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))], names=names)

        def leave():
            """The range ends: what it holds of an open record waits for the next ranges."""
            if last_broken and ended is not None and ended == len(rows) and rows:
                rows.pop()                              # closed by the end of the file, not by a brace
            elif held and not last_broken:
                rows.append((*now, "".join(held), False) if opened is None else (now[0], opened, now[1], "".join(held), False))

        for batch in batches:
            for path, begin, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[:2] != (path, begin):
                    if now is not None:
                        leave()
                    now = (path, begin, begin)
                    inside, depth, base, opened, last_broken = places[path, begin]
                    held, in_record, ended = [], opened is not None or depth > base, None
                text, after = _outside(piece, inside)
                up, end = _steps(text, after)
                ended = None
                if not in_record:
                    at = _first_brace(piece, inside)
                    if at is not None:
                        in_record, held, opened = True, [piece[at:] + "}"], None
                else:
                    held.append(piece + "}")
                inside, depth = after, depth + end
                if in_record and not inside and depth <= base:
                    whole = opened is None
                    rows.append((path, begin, begin, "".join(held), True) if whole else (path, opened, begin, "".join(held), False))
                    held, in_record, opened, ended = [], False, None, len(rows)
            if len(rows) > 4096:
                keep = rows.pop()                       # the last may have to be taken back
                yield made()
                rows, ended = [keep], 1 if ended is not None else None
        if now is not None:
            leave()
        if rows:
            yield made()

    return run


def _first_brace(piece: str, inside: bool) -> int | None:
    """Place of the first ``{`` that is in no text."""
    at = piece.find("{")
    if at < 0 or (not inside and '"' not in piece[:at]):
        return None if at < 0 else at
    masked = ESCAPED.sub("  ", piece)
    place = 0
    for n, part in enumerate(masked.split('"')):
        if n % 2 == inside and "{" in part:
            return place + part.index("{")
        place += len(part) + 1
    return None


def json_array_texts(spark: SparkSession, path: str) -> DataFrame:
    """The records' texts: path, text."""
    ranges = _ranges(spark, path)
    places, _ = _placed(_measured(ranges))
    shared = spark.sparkContext.broadcast(places)                        # a few words for each range

    def find(batches):
        yield from _found(shared.value)(batches)

    pieces = ranges.mapInArrow(find, PIECE)
    whole = pieces.where("whole").select("path", "text")
    parts = pieces.where("not whole").groupBy("path", "begin").agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("p"))   # one record
    return whole.unionByName(parts.select("path", F.array_join(F.transform("p", lambda x: x.text), "").alias("text")))


def _measured(ranges: DataFrame) -> list:
    return ranges.mapInArrow(_measure, RANGE).collect()


def broken_files(spark: SparkSession, path: str) -> list[str]:
    """Files that end inside a record."""
    return _placed(_measured(_ranges(spark, path)))[1]


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC2 by ranges: records of a fixed schema.  Text that is no record of it gives NULLs, as in
    Spark's own reader."""
    return json_array_texts(spark, path).select(F.from_json("text", schema).alias("r")).select("r.*")
