"""Secret scan with corpus-wide ownership.

Three kinds of spans are found in each whole text: ``assign`` (a key word, a sign, a value of 12
characters or more), ``access`` (AKIA and capitals or digits, 18 or more in all) and ``hex`` (16 or
more), each leftmost without overlap within its kind.  The candidate of a span is its secret part.
Candidates are then counted over the corpus by hash: in how many distinct repositories and owners
each appears.  One that ``EXAMPLE_OWNERS`` owners or more share is an example that people copy; any
other that may be a credential is a live-looking one of few owners, and its own span is added as
kind ``live``.  Only values of few different characters (less than ``MIN_BITS`` a character) and
assigned ones made of ``PLACEHOLDERS`` alone are none; digits or letters alone may be one.

Only hashes leave a text, one row for each distinct (candidate, owner, repository) of a task, so a
candidate in a third of all rows is pre-aggregated before its shuffle; the join that brings the
verdict back is split where it is skewed.

Defined cases: a null text is empty; null owners count as one owner of their own; repeated rows
each get their spans; spans are code points, end exclusive.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import fields, stage, under_aliases, with_columns

KINDS = ("assign", "access", "hex")
EXAMPLE_OWNERS = 4
MIN_BITS = 2.5           # a character, for a value to look random
PLACEHOLDERS = ("password", "passwd", "secret", "token", "api", "access", "private", "key", "your", "my", "the", "here", "user",
                "name", "value", "string", "change", "replace", "insert", "enter", "with", "this", "me", "placeholder", "example",
                "sample", "dummy", "default", "redacted", "hidden", "todo", "none", "null", "undefined", "x")
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
SPAN = "array<struct<kind:string,start:int,end:int,at:int,hash:bigint,random:boolean>>"
KINDS_OF_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("at", pa.int32()),
                                    ("hash", pa.int64()), ("random", pa.bool_())]))


def _any_case(words) -> str:
    """The key words in either case of ASCII letters, and no other folding."""
    return "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words)


ASSIGN = "(" + _any_case(KEYWORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]{16,}"


def _finder():
    assign, access, hexes = re.compile(ASSIGN), re.compile(ACCESS), re.compile(HEX)
    log2, digest = math.log2, xxhash.xxh64_intdigest
    placeholder = re.compile("|".join(sorted(PLACEHOLDERS, key=len, reverse=True)) + "|[+/_.=-]")

    def looks_random(kind, value):
        """Many different characters, and not just the words of a placeholder."""
        counts = [value.count(c) for c in set(value)]
        bits = -sum(n / len(value) * log2(n / len(value)) for n in counts)
        return bits >= MIN_BITS and (kind != "assign" or placeholder.sub("", value.lower()) != "")

    def span(kind, start, end, at, value):
        return {"kind": kind, "start": start, "end": end, "at": at, "hash": digest(value.encode(), 0) - (1 << 63),
                "random": looks_random(kind, value)}

    def find(text):
        out = [span("hex", m.start(), m.end(), m.start(), m[0]) for m in hexes.finditer(text)]
        if "AKIA" in text:
            out += [span("access", m.start(), m.end(), m.start(), m[0]) for m in access.finditer(text) if len(m[0]) >= 18]
        if ":" in text or "=" in text:
            out += [span("assign", m.start(), m.end(), m.start(2), m[2]) for m in assign.finditer(text) if len(m[2]) >= 12]
        return sorted(out, key=lambda s: (s["start"], KINDS.index(s["kind"])))

    return find


def candidates(docs: DataFrame, text_col: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus secret_spans: kind, start, end, start of the secret part (it ends where the
    span does), its hash, and whether it looks random."""
    at, find = docs.columns.index(text_col), _finder()

    def run(batch):
        return [pa.array([find(t) if t else [] for t in batch.column(at).to_pylist()], KINDS_OF_SPAN)]

    return with_columns(docs, run, fields(secret_spans=SPAN), drop)


def ownership(found: DataFrame, repo: Column, owner: Column) -> DataFrame:
    """One row for each candidate: hash, repositories, owners, uses."""
    seen = found.select(repo.alias("repo"), owner.alias("owner"), F.explode("secret_spans.hash").alias("hash"))
    seen = seen.groupBy("hash", "owner", "repo").agg(F.count("*").alias("uses"))
    by_owner = seen.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("uses").alias("uses"))
    return by_owner.groupBy("hash").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"),
                                        F.sum("uses").alias("uses"))


def scan(docs: DataFrame, text_col: str = "text", repo_col: str = "source", owner: Column | None = None,
         example_owners: int = EXAMPLE_OWNERS, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (the columns ``keep``, all by default) plus secret_spans and live_spans: start and
    end of the secret parts that few owners have.  The owner of a repository is what stands before
    its first slash, unless ``owner`` is given."""
    new = ("secret_spans", "live_spans", "secret_row")
    keep = [c for c in (keep or docs.columns) if c.lower() not in new]
    work = docs.select(list(dict.fromkeys([*keep, text_col, repo_col])))
    work = candidates(work, text_col, () if text_col in keep else (text_col,))
    found = stage(work.withColumn("secret_row", F.monotonically_increasing_id()), "secrets")
    owner = F.substring_index(F.col(repo_col), "/", 1) if owner is None else owner
    some = found.where(F.size("secret_spans") > 0)
    owned = ownership(some, F.col(repo_col), owner)
    each = some.select("secret_row", F.explode("secret_spans").alias("s")).where("s.random")
    live = each.join(owned.where(F.col("owners") < example_owners).select(F.col("hash").alias("h")), F.col("s.hash") == F.col("h"))
    span = F.struct(F.col("s.at").alias("start"), F.col("s.end").alias("end"))
    live = live.groupBy("secret_row").agg(F.array_sort(F.collect_set(span)).alias("live_spans"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    out = found.join(live, "secret_row", "left").withColumn("live_spans", F.coalesce("live_spans", none))
    return out.select(*keep, "secret_spans", "live_spans")


def named(kinds: tuple[str, ...]) -> Column:
    """Spans as kind:start:end by start, then kind as listed; of live ones too if asked for."""
    base = F.transform("secret_spans", lambda s: F.struct(
        s.start.alias("start"), F.array_position(F.lit(list(KINDS)), s.kind).alias("nth"), s.end.alias("end"), s.kind.alias("kind")))
    live = F.transform("live_spans", lambda s: F.struct(
        s.start.alias("start"), F.lit(len(KINDS) + 1).cast("long").alias("nth"), s.end.alias("end"), F.lit("live").alias("kind")))
    spans = F.array_sort(F.concat(base, live)) if "live" in kinds else F.array_sort(base)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def redact(docs: DataFrame, text_col: str = "text", repo_col: str = "source", mask: str = "[secret]", **kw) -> DataFrame:
    """``docs`` with ``mask`` in place of every live-looking secret; overlapping ones get one."""
    work, name, back = under_aliases(docs)
    found = scan(work, name[text_col], name[repo_col], **kw)
    at, spans_at = found.columns.index(name[text_col]), found.columns.index("live_spans")

    def run(batch):
        out = batch.column(at).to_pylist()
        for i, spans in enumerate(batch.column(spans_at).to_pylist()):
            for start, end in _merged(spans)[::-1]:
                out[i] = out[i][:start] + mask + out[i][end:]
        return [pa.array(out, pa.string())]

    masked = with_columns(found, run, fields(masked_text="string"), drop=("secret_spans", "live_spans", name[text_col]))
    return back(masked.withColumnRenamed("masked_text", name[text_col]))


def _merged(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for s in spans:
        if out and s["start"] < out[-1][1]:
            out[-1][1] = max(out[-1][1], s["end"])
        else:
            out.append([s["start"], s["end"]])
    return out
