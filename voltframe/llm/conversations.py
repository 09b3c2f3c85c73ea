"""Repair of the structure of conversations at the least cost.

A conversation should read: a system turn or none, then user and assistant in turn, ending with
the assistant; or be empty.  Its rows, in the order of their turns, are edited: kept (0), given
the role user or assistant (3), deleted (4), and rows with an empty text and the role user or
assistant are inserted anywhere (3).  Blank rows and repetitions of an earlier row must go;
a truncated row that stays costs 3 more.  The edits are a path in a lattice of rows by states (nothing
yet, after the system turn, after a user, after an assistant), which a bidirectional Dijkstra
search finds: a heap from either end, until the two cheapest labels together exceed the best
meeting; all meetings of that cost are compared, and the least joined audit (the edits' initials)
wins.

Equal rows of a conversation (conversation, turn, role, text) are one row with a count before
anything moves.  What is first among rows of equal role and text is marked by a record of its own
that sorts just before it.  Rows and marks are range-partitioned in the order of the conversation, so a
conversation may lie in many partitions, and a task reads its part as a stream, cut into segments
of ``SEGMENT`` rows or ``BYTES`` of text.  A segment that is a whole conversation is repaired there.  For
others the search gives the cheapest way from each state to each state, and the segments'
tables are multiplied (least cost, least audit) in a tree of ``FAN`` children a node, whose root says
by which states the path goes through each segment.  So no task or row holds a conversation's texts
whole, however long it is; only its audit is one value.

Defined cases: a null in any column reads as one space, but null turns stand first and count for
no gap, and null ids are one conversation; rows of one turn stand in the order of two hashes of role
and text; rows of equal role and text of one turn are one repeated row; a role counts by its first
letter (user, assistant and system need no other), an empty one has none; a conversation without
rows has an empty repair; an empty table gives no row; further columns take no part.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from voltframe.llm.common import fields, stage, with_columns

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3       # costs
SEGMENT, BYTES, FAN = 128, 1 << 20, 64
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
STEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FULL = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"

CHOICES = "array<struct<`from`: tinyint, to: tinyint, cost: bigint, audit: string, via: array<tinyint>>>"
ROWS = "array<struct<turn: bigint, role: string, text: string, n: bigint, fault: string>>"
FIXED = "array<struct<edit: string, turn: bigint, role: string, text: string>>"
FACTS = ("n bigint, first_turn bigint, last_turn bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, "
         "illegal bigint, first_role string, last_role string")
FACT_NAMES = [c.split(" ")[0] for c in FACTS.split(", ")]


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with faults put in, to hold a repair against: by crc32 of ``conv:turn`` modulo
    20 a row is dropped (0; column ``dropped``), emptied (1), loses its ends of sentences (2), comes
    twice (3; column ``times``) or is a user's (4).  Nulls read as one space, but for null turns in the order."""
    space = F.lit(" ")
    known = {c: F.coalesce(F.col(c).cast("string"), space) for c in (conv, turn, role, text)}
    code = F.crc32(F.concat(known[conv], F.lit(":"), known[turn])) % 20
    return rows.withColumns({
        text: F.when(code == 1, "").when(code == 2, F.translate(known[text], ".!?", "")).otherwise(known[text]),
        role: F.when(code == 4, "user").otherwise(known[role]),
        "dropped": code == 0, "times": F.when(code == 3, 2).otherwise(1)})


def _moves(kind: tuple[str, bool, bool]) -> list[tuple[int, int, str, int]]:
    """Ways over a row: (state, next state, initial, cost).  A row is its role's initial, whether
    it must go, and whether it is cut off."""
    initial, must_go, cut_off = kind
    ways = [(q, q, "D", DELETE) for q in range(4)]
    if not must_go:
        more = CUT_OFF if cut_off else 0
        ways += [(q, p, "K", KEEP + more) for q, p in STEP.get(initial, {}).items()]
        ways += [(q, p, "R", REROLE + more) for s in "ua" for q, p in STEP[s].items()]
    return ways


INSERTIONS = [(q, p, "I", INSERT) for s in "ua" for q, p in STEP[s].items()]


def _by(ways, side: int) -> list[list[tuple[int, str, int]]]:
    out = [[] for _ in range(4)]
    for w in ways:
        out[w[side]].append((w[1 - side], w[2], w[3]))
    return out


class Ways(dict):
    """Forward and backward moves over a kind of row, made once."""

    def __missing__(self, kind):
        ways = _moves(kind)
        self[kind] = _by(ways, 0), _by(ways, 1)
        return self[kind]


WAYS = Ways()
INSERT_AFTER, INSERT_BEFORE = _by(INSERTIONS, 0), _by(INSERTIONS, 1)


def cheapest(kinds: list, starts: tuple[int, ...], ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest edits from one of the states ``starts`` before the
    rows to one of ``ends`` after them; None if there are none.

    A label is (cost, audit).  Heaps are ordered by cost and place: moves of cost 0 only go
    on in place, so when a node is taken, its cost and its least audit are final."""
    n, ways = len(kinds), [WAYS[k] for k in kinds]
    ahead, back = {(0, q): (0, "") for q in starts}, {(n, q): (0, "") for q in ends}
    front, rear = [(0, 0, q) for q in starts], [(0, -n, q) for q in ends]
    done_ahead, done_back = set(), set()
    best = None

    def reach(labels, others, heap, node, place, cost, audit):
        nonlocal best
        old = labels.get(node)
        if old is None or (cost, audit) < old:
            labels[node] = (cost, audit)
            if old is None or cost < old[0]:
                heappush(heap, (cost, place, node[1]))
            other = others.get(node)
            if other is not None and (best is None or cost + other[0] < best):
                best = cost + other[0]

    for node, label in ahead.items():
        if node in back:
            best = 0
    while front and rear and (best is None or front[0][0] + rear[0][0] <= best):
        if front[0][0] <= rear[0][0]:
            cost, i, q = heappop(front)
            if (i, q) in done_ahead:
                continue
            done_ahead.add((i, q))
            audit = ahead[i, q][1]
            if i < n:
                for p, letter, more in ways[i][0][q]:
                    reach(ahead, back, front, (i + 1, p), i + 1, cost + more, audit + letter)
            for p, letter, more in INSERT_AFTER[q]:
                reach(ahead, back, front, (i, p), i, cost + more, audit + letter)
        else:
            cost, i, q = heappop(rear)
            i = -i
            if (i, q) in done_back:
                continue
            done_back.add((i, q))
            audit = back[i, q][1]
            if i:
                for p, letter, more in ways[i - 1][1][q]:
                    reach(back, ahead, rear, (i - 1, p), 1 - i, cost + more, letter + audit)
            for p, letter, more in INSERT_BEFORE[q]:
                reach(back, ahead, rear, (i, p), -i, cost + more, letter + audit)
    if best is None:
        return None
    met = (ahead[v][1] + back[v][1] for v in ahead.keys() & back.keys() if ahead[v][0] + back[v][0] == best)
    return best, min(met)


def applied(entries: list, state: int, audit: str) -> tuple[list[dict], int]:
    """The rows that remain after the edits, with the edit, and the state at the end; entries are
    (turn, role, text, n, fault), and further copies of one are deleted unseen."""
    out, at, left = [], 0, iter(entries)
    while at < len(audit):
        letter = audit[at]
        turn, role, text, n, _ = (None, None, "", 1, None) if letter == "I" else next(left)
        at += n
        if letter in "IR":
            role = FULL["a" if state == USER else "u"]
        if letter != "D":
            state = STEP[role[:1]][state]
            out.append({"edit": letter, "turn": turn, "role": role, "text": text})
    return out, state


def _audit(audit: str, counts: list[int]) -> str:
    """The audit with a deletion for each further copy of a row."""
    left = iter(counts)
    return "".join(x if x == "I" else x + "D" * (next(left) - 1) for x in audit)


def _facts(entries: list) -> list:
    """What a segment adds to the statistics; entries are (turn, role, text, n, fault)."""
    turns = [e[0] for e in entries if e[0] is not None]
    initials = [e[1][:1] for e in entries]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])) + sum(e[3] - 1 for e in entries)
    return [sum(e[3] for e in entries), turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)),
            sum(e[3] for e in entries if e[4] == "blank"), sum(e[3] - (e[4] != "duplicate") for e in entries if e[4] != "blank"),
            sum(e[4] == "truncated" for e in entries), illegal, initials[0] if entries else None, initials[-1] if entries else None]


def _kind(entry) -> tuple[str, bool, bool]:
    return entry[1][:1], entry[4] in ("blank", "duplicate"), entry[4] == "truncated"


def _copies(entries: list) -> int:
    return DELETE * sum(e[3] - 1 for e in entries)


def _choices(entries: list, starts, ends) -> list[dict]:
    """The cheapest way through a segment for each pair of states."""
    kinds, counts, extra, out = [_kind(e) for e in entries], [e[3] for e in entries], _copies(entries), []
    for q in starts:
        for p in ends:
            got = cheapest(kinds, (q,), (p,))
            if got:
                out.append({"from": q, "to": p, "cost": got[0] + extra, "audit": _audit(got[1], counts), "via": [q, p]})
    return out


def _whole(entries: list) -> tuple[list[dict], list[dict]]:
    """The way through a whole conversation, and what remains of it."""
    cost, audit = cheapest([_kind(e) for e in entries], (START,), ACCEPTED)
    audit = _audit(audit, [e[3] for e in entries])
    fixed, state = applied(entries, START, audit)
    return [{"from": START, "to": state, "cost": cost + _copies(entries), "audit": audit, "via": [START, state]}], fixed


def joined(left: list[dict], right: list[dict]) -> list[dict]:
    """Ways through two neighbouring stretches: the cheapest, then least, for each pair of states."""
    best = {}
    for a in left:
        for b in right:
            if a["to"] == b["from"]:
                key, label = (a["from"], b["to"]), (a["cost"] + b["cost"], a["audit"] + b["audit"])
                if key not in best or label < best[key][0]:
                    best[key] = label, a["via"] + b["via"][1:]
    return [{"from": q, "to": p, "cost": c, "audit": s, "via": via} for (q, p), ((c, s), via) in best.items()]


def _added(a: list, b: list) -> list:
    """Statistics of two neighbouring stretches together."""
    if not a[0] or not b[0]:
        return b if not a[0] else a
    same = a[2] is not None and a[2] == b[1]
    return [a[0] + b[0], a[1] if a[1] is not None else b[1], b[2] if b[2] is not None else a[2], a[3] + b[3] - same,
            *(x + y for x, y in zip(a[4:7], b[4:7])), a[7] + b[7] + (a[9] + b[8] not in LEGAL), a[8], b[9]]


def laid_out(rows: DataFrame, conv: str, turn: str, role: str, text: str, dropped: str | None, times: str | None) -> DataFrame:
    """Rows and the marks of first occurrences, sorted within range partitions: conv, turn, role,
    text, n, blank, truncated, kind (0: mark, 1: row, 2: the conversation exists), part."""
    gone = F.coalesce(F.col(dropped), F.lit(False)) if dropped else F.lit(False)
    space, copies = F.lit(" "), (F.col(times) if times else F.lit(1)).cast("long").alias("times")
    each = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), space).alias("role"),
                       F.coalesce(F.col(text), space).alias("text"), gone.alias("gone"), copies)
    each = each.select("conv", *(F.when(~F.col("gone"), F.col(c)).alias(c) for c in ("turn", "role", "text")),
                       F.when(F.col("gone"), 2).otherwise(1).alias("kind"), "times")
    shown, twice = F.rtrim(F.col("text"), F.lit(WHITE)), {"a": F.xxhash64("role", "text"), "b": F.xxhash64("text", F.lit(1), "role")}
    equal = each.groupBy("conv", "turn", "role", "text", "kind").agg(F.sum("times").alias("n")).withColumns(
        {**twice, "blank": shown == "", "truncated": ~F.substring(shown, -1, 1).isin(".", "!", "?")})
    order = F.struct(F.col("turn").isNotNull().alias("there"), F.col("turn").alias("turn"))
    seen = each.where((F.col("kind") == 1) & (shown != "")).select("conv", order.alias("place"), *(c.alias(x) for x, c in twice.items()))
    first = seen.groupBy("conv", "a", "b").agg(F.min("place").alias("first"))
    marks = first.select("conv", F.col("first.turn").alias("turn"), "a", "b", F.lit(0).alias("kind"))
    both = equal.unionByName(marks, allowMissingColumns=True)
    # a mark and its row have the same place, so no border of partitions parts them
    place = [F.col("conv").asc_nulls_first(), (F.col("kind") == 2).desc(), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    both = both.repartitionByRange(*place).sortWithinPartitions(*place, "kind")
    return both.select("conv", "turn", "role", "text", "n", "blank", "truncated", "kind", F.spark_partition_id().alias("part"))


class _Cutter:
    """Segments of the rows of one partition, as a stream."""

    def __init__(self, size: int, digest: bool):
        self.size, self.digest, self.out, self.number = size, digest, [], 0
        self.conv = self.part = None
        self.any = self.from_start = self.marked = False
        self.entries, self.used, self.nth = [], 0, 0

    def open(self, conv, part):
        """A conversation begins here, unless it is the partition's first, which may go on from
        the partition before."""
        if self.any:
            self.close(last=True)
        self.from_start, self.any = self.any, True
        self.conv, self.part, self.nth, self.marked = conv, part, 0, False

    def close(self, last: bool):
        entries, fixed, text_hash = self.entries, None, None
        whole = self.from_start and last
        if whole:
            ways, fixed = _whole(entries)
            if self.digest:
                text_hash, fixed = hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in fixed).encode()).hexdigest(), None
        else:
            ways = _choices(entries, (START,) if self.from_start else range(4), range(4))
        raw = None if whole else [dict(zip(("turn", "role", "text", "n", "fault"), e)) for e in entries]
        self.out.append([self.conv, self.part, self.nth, (self.part << 40) + self.number, whole, *_facts(entries), ways, raw, fixed, text_hash])
        self.entries, self.used, self.from_start = [], 0, False
        self.nth += 1
        self.number += 1

    def row(self, turn, role, text, n, blank, cut_off):
        if len(self.entries) >= self.size or self.used >= BYTES:
            self.close(last=False)
        fault = "blank" if blank else "duplicate" if not self.marked else "truncated" if cut_off else None
        self.entries.append((turn, role, text, n, fault))
        self.used += len(text)
        self.marked = False


def segments(laid: DataFrame, size: int = SEGMENT, digest: bool = False) -> DataFrame:
    """One staged row for each segment: its place (conv, part, nth, leaf), whether it is a whole
    conversation, statistics and the ways through it, and what remains of a whole one (only its
    SHA-256 with ``digest``) or the rows of another."""
    schema = (f"conv {laid.schema['conv'].dataType.simpleString()}, part int, nth bigint, leaf bigint, whole boolean, {FACTS}, "
              f"ways {CHOICES}, rows {ROWS}, fixed {FIXED}, repaired_sha256 string")
    kinds = laid.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(kinds)

    def cut(batches):
        c = _Cutter(size, digest)

        def ready():
            done, c.out = c.out, []
            return pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*done), arrow)], schema=arrow)

        for batch in batches:
            for conv, turn, role, text, n, blank, cut_off, kind, part in zip(*(x.to_pylist() for x in batch.columns)):
                if not c.any or conv != c.conv:
                    c.open(conv, part)
                if kind == 0:
                    c.marked = True
                elif kind == 1:
                    c.row(turn, role, text, n, blank, cut_off)
            if c.out:
                yield ready()
        if c.any:
            c.close(last=False)
            yield ready()

    return stage(laid.mapInArrow(cut, kinds), "segments")


def _tree(parts: DataFrame) -> DataFrame:
    """Segments (conv, part, nth, statistics, ways, leaves) to one row for each conversation."""
    schema = parts.schema
    arrow = to_arrow_schema(schema)
    names = schema.names[3:]

    def fold(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                first, *more = r["group"]
                facts, ways, leaves = [first[x] for x in FACT_NAMES], first["ways"], first["leaves"]
                for s in more:
                    facts, ways, leaves = _added(facts, [s[x] for x in FACT_NAMES]), joined(ways, s["ways"]), leaves + s["leaves"]
                out.append([r["conv"], r["part"], r["nth"], *facts, ways, leaves])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*out), arrow)], schema=arrow)

    def up(table, part, nth):
        """A group has at most ``FAN`` members: neighbours by ``nth``, or by ``part`` once that is 0."""
        groups = table.withColumns({"p": part, "i": nth}).groupBy("conv", "p", "i").agg(
            F.array_sort(F.collect_list(F.struct("part", "nth", *names))).alias("group"))
        return stage(groups.select("conv", F.col("p").alias("part"), F.col("i").alias("nth"), "group").mapInArrow(fold, schema), "conversation-tree")

    most = parts.agg(F.max("nth").alias("nth"), F.max("part").alias("part")).first()
    nth, part = most.nth or 0, most.part or 0
    while nth:
        parts, nth = up(parts, F.col("part"), F.expr(f"nth div {FAN}")), nth // FAN
    while part:
        parts, part = up(parts, F.expr(f"part div {FAN}").cast("int"), F.col("nth")), part // FAN
    return parts


@dataclass
class Repaired:
    """``conversations``: conv, gaps, blank, duplicate, truncated, illegal, cost and audit of each
    conversation, and with ``digest`` the SHA-256 of what remains where it is known already;
    ``segments``: what remains of each, in pieces (conv, part, nth, fixed) whose order is part, nth.
    With ``digest`` only conversations of several segments are there."""
    conversations: DataFrame
    segments: DataFrame


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", dropped: str | None = None,
           times: str | None = None, size: int = SEGMENT, digest: bool = False) -> Repaired:
    """Repair all conversations.  ``dropped`` names a column of rows that only tell that their
    conversation exists, ``times`` one that says how often a row stands there."""
    cut = segments(laid_out(rows, conv, turn, role, text, dropped, times), size, digest)
    parts = cut.where("not whole").select("conv", "part", "nth", *FACT_NAMES, "ways", F.array("leaf").alias("leaves"))
    top = _tree(stage(parts, "open-segments"))
    ends = F.filter("ways", lambda w: (w["from"] == START) & w["to"].isin(*ACCEPTED))
    best = F.array_min(F.transform(ends, lambda w: F.struct(w["cost"].alias("cost"), w["audit"].alias("audit"), w["via"].alias("via"))))
    top = stage(top.withColumn("best", best).withColumn("repaired_sha256", F.lit(None).cast("string")), "conversation-ways")
    done = cut.where("whole").withColumn("best", best)
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    columns = ["conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"),
               F.col("best.audit").alias("audit"), "repaired_sha256"]
    summary = done.select(columns).unionByName(top.select(columns))

    # the states between segments say which of the ways through each is taken
    steps = F.transform("leaves", lambda leaf, i: F.struct(leaf.alias("leaf"), F.get("best.via", i).alias("from"), F.get("best.via", i + 1).alias("to")))
    taken = top.select(F.explode(steps).alias("s")).select("s.*")
    chosen = cut.where("not whole").select("conv", "part", "nth", "leaf", "ways", "rows").join(taken, "leaf")
    way = F.filter("ways", lambda w: (w["from"] == F.col("from")) & (w["to"] == F.col("to")))[0]
    chosen = chosen.select("conv", "part", "nth", "rows", F.col("from").alias("state"), way["audit"].alias("audit"))

    def apply(batch):
        out = []
        for entries, state, audit in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5))):
            out.append(applied([(e["turn"], e["role"], e["text"], e["n"], e["fault"]) for e in entries], state, audit)[0])
        return [pa.array(out, fixed_type)]

    fixed = fields(fixed=FIXED)
    fixed_type = to_arrow_schema(fixed).field(0).type
    pieces = with_columns(chosen, apply, fixed, drop=("rows", "state", "audit"))
    if not digest:
        pieces = cut.where("whole").select("conv", "part", "nth", "fixed").unionByName(pieces)
    return Repaired(summary, pieces)


def digests(done: Repaired) -> DataFrame:
    """``done.conversations`` with the SHA-256 of ``role:text`` lines of what remains.

    A digest is serial by nature: a conversation of several segments is hashed segment by segment,
    as a stream, in one task."""
    parts = done.segments.select("conv", "part", "nth", F.transform("fixed", lambda r: F.concat(r["role"], F.lit(":"), r["text"])).alias("lines"))
    parts = parts.repartition("conv").sortWithinPartitions("conv", "part", "nth")
    schema = parts.select("conv", F.lit("").alias("sha")).schema
    names = schema.names

    def run(batches):
        now, state, empty, any_row, out = None, None, True, False, []
        for batch in batches:
            for conv, _, _, lines in zip(*(c.to_pylist() for c in batch.columns)):
                if not any_row or conv != now:
                    if any_row:
                        out.append((now, state.hexdigest()))
                    now, state, empty, any_row = conv, hashlib.sha256(), True, True
                for line in lines:
                    state.update((line if empty else "\n" + line).encode())
                    empty = False
        if any_row:
            out.append((now, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], conv_type), pa.array([r[1] for r in out])], names=names)

    conv_type = to_arrow_schema(schema).field(0).type
    hashed = parts.mapInArrow(run, schema)
    known, rest = done.conversations.where("repaired_sha256 is not null"), done.conversations.where("repaired_sha256 is null")
    rest = rest.drop("repaired_sha256").join(hashed.withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of"))).drop("of")
    return known.unionByName(rest.withColumnRenamed("sha", "repaired_sha256"))
