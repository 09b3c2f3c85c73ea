"""Packing of encoded documents into sequences of a fixed capacity, with few sequences.

A document is its ids and an end id.  Longer ones are cut into pieces of the capacity, of which
the first may be shorter; every other document is one piece.  What decides a packing is only how
many pieces there are of each length, so the plan is made from the histogram of lengths, which has
``capacity`` entries at most whatever the corpus:

1. Martello and Toth's dominance reduction.  A set dominates another if the other's items can be
   parted among its own, each taking no more than it weighs; then swapping them costs no bin.  Where
   a set of one, two or three items dominates every feasible set that holds one item of its own,
   it is a bin of some best packing, and is fixed.  What is left is a smaller instance, which is
   gone through again until nothing more can be fixed.  All bins of one kind are fixed at once: the
   conditions only get weaker as items go.
2. Best fit, longest first, for the remainder; again all bins of one kind at a time.

The plan says how many bins there are of each kind.  A piece then needs its rank among the
pieces of its length: tasks number theirs as they encode, and prefix sums over the tasks' counts
give the rest.  Only (task, length) counts are ever shuffled with the pieces, never texts or ids.

Defined cases: null text is empty and holds the end id only; null and repeated ids are documents of
their own, a row each; an empty table gives no row.
"""

from __future__ import annotations

import itertools
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltframe.llm.common import fields, share_file, stage, with_columns
from voltframe.llm.tokens import END, Encoder

CAPACITY = 1024
PIECE = "id long, piece int, start long, length long, ids_crc32 long, nth long, part int"


class Instance:
    """How many items there are of each size, by size."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.count = {s: n for s, n in counts.items() if n}
        self.capacity = capacity
        self.sizes = sorted(self.count)
        if self.sizes and not 0 < self.sizes[0] <= self.sizes[-1] <= capacity:
            raise ValueError("an item has at least size 1 and fits a bin")

    def take(self, kind: tuple[int, ...], times: int) -> None:
        for s in kind:
            self.count[s] -= times
            if not self.count[s]:
                del self.count[s]
                del self.sizes[bisect_left(self.sizes, s)]

    def times(self, kind: tuple[int, ...]) -> int:
        """How many bins of this kind the items are enough for."""
        return min(self.count[s] // kind.count(s) for s in set(kind))

    def largest(self, limit: int, used: tuple[int, ...]) -> int:
        """Largest size up to ``limit`` of an item that is not among ``used``; 0 if there is none."""
        for i in range(bisect_right(self.sizes, limit) - 1, -1, -1):
            if self.count[self.sizes[i]] > used.count(self.sizes[i]):
                return self.sizes[i]
        return 0

    def smallest(self, n: int, used: tuple[int, ...], above: int = 0) -> list[int]:
        """The ``n`` smallest items larger than ``above`` that are not among ``used``."""
        out = []
        for s in itertools.islice(self.sizes, bisect_right(self.sizes, above), None):
            out += [s] * min(n - len(out), self.count[s] - used.count(s))
            if len(out) == n:
                break
        return out

    def best_pair(self, room: int, used: tuple[int, ...]) -> int:
        """Largest sum up to ``room`` of two items that are not among ``used``; 0 if no two fit."""
        best, j = 0, 0
        for s in reversed(self.sizes):
            if s > room or self.count[s] == used.count(s):
                continue
            other = self.largest(min(s, room - s), (*used, s))
            if other:
                best = max(best, s + other)
            if 2 * s <= best:
                break
        return best

    def dominant(self, j: int) -> tuple[int, ...] | None:
        """A set with an item of size ``j`` that dominates all feasible sets with it, if one of up
        to three items is known to."""
        room, own = self.capacity - j, (j,)
        small = self.smallest(3, own)
        if not small or small[0] > room:
            return own
        mate = self.largest(room, own)
        if mate == room or len(small) < 2 or small[0] + small[1] > room:
            return j, mate                       # fills the bin, or no two others fit together
        if len(small) == 3 and sum(small) <= room:
            return None                          # three others fit: no rule
        if mate >= self.best_pair(room, own):
            return j, mate
        third = self.largest(room - mate, (j, mate))
        if third:
            # a pair that this set doesn't dominate has both items above the third
            heavier = self.smallest(2, (j, mate), above=third)
            if len(heavier) < 2 or sum(heavier) > room:
                return j, mate, third
        return None


def reduce(left: Instance) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets until none is found; ``left`` keeps the remainder."""
    fixed, found = [], True
    while found:
        found = False
        for j in reversed(left.sizes[:]):
            while j in left.count and (kind := left.dominant(j)):
                times = left.times(kind)
                left.take(kind, times)
                fixed.append((kind, times))
                found = True
    return fixed


def best_fit(left: Instance) -> list[tuple[tuple[int, ...], int]]:
    """Pack what is left, longest first, each into the fullest bin that has room."""
    open_bins: dict[int, list] = {}      # room left -> kinds of bins and how many
    rooms: list[int] = []

    def put(kind, times):
        room = left.capacity - sum(kind)
        if room not in open_bins:
            insort(rooms, room)
        open_bins.setdefault(room, []).append((kind, times))

    for s in reversed(left.sizes):
        n = left.count[s]
        while n:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                each = left.capacity // s
                for kind, times in (((s,) * each, n // each), ((s,) * (n % each), 1)):
                    if kind and times:
                        put(kind, times)
                break
            room = rooms[at]
            kind, times = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
            now = min(n, times)
            if now < times:
                put(kind, times - now)
            put((*kind, s), now)
            n -= now
    return [k for kinds in open_bins.values() for k in kinds]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list, list]:
    """Kinds of bins and how many of each: those that dominance fixes, and those of best fit."""
    left = Instance(counts, capacity)
    return reduce(left), best_fit(left)


def slots(kinds: list) -> dict[int, np.ndarray]:
    """For each size, the ranks that go to each kind of bin: rows (first rank, first sequence,
    items of the size in a bin, offset of the first of them)."""
    out, used, base = {}, {}, 0
    for kind, times in kinds:
        offset = 0
        for s, run in itertools.groupby(kind):
            each = len(list(run))
            out.setdefault(s, []).append((used.get(s, 0), base, each, offset))
            used[s] = used.get(s, 0) + each * times
            offset += s * each
        base += times
    return {s: np.array(rows, np.int64) for s, rows in out.items()}


def pieces(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY, end: int = END,
           with_ids: bool = False) -> DataFrame:
    """One staged row for each piece: id, piece, start, length, ids_crc32, its number ``nth`` among
    the pieces of its length in task ``part``, and its ids if asked."""
    get = share_file(docs, path, Encoder)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("part"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        enc, seen = get(), np.zeros(capacity + 1, np.int64)
        stop = np.array([end], enc.width).tobytes()
        for batch in batches:
            row, start, length, crc, nth, raw = [], [], [], [], [], []
            for i, got in enumerate(enc.encode(batch.column(1).to_pylist())):
                ids = np.frombuffer(got + stop, enc.width).astype("<u4")
                first = len(ids) % capacity or capacity
                for a in range(first - capacity, len(ids), capacity) if len(ids) > capacity else (0,):
                    part = ids[max(0, a):min(a + capacity, len(ids))]
                    row.append(i)
                    start.append(max(0, a))
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
                    nth.append(seen[len(part)])
                    seen[len(part)] += 1
                    if with_ids:
                        raw.append(part.astype(np.int32))
            if not row:
                continue
            at = np.array(row)
            of_doc = np.arange(len(at)) - np.searchsorted(at, at)
            columns = [batch.column(0).take(pa.array(at)), pa.array(of_doc, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                       pa.array(crc, pa.int64()), pa.array(nth, pa.int64()), batch.column(2).take(pa.array(at)).cast(pa.int32())]
            if with_ids:
                columns.append(pa.array(raw, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = PIECE.replace("id long", f"id {id_type}", 1) + (", ids array<int>" if with_ids else "")
    names = [c.split(" ")[0] for c in schema.split(", ")]
    return stage(rows.mapInArrow(run, schema), "pieces")


def pack(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY, end: int = END,
         with_ids: bool = False) -> DataFrame:
    """One row for each piece: the id column, piece (from 0), start (ids of its document before
    it), length, ids_crc32, sequence_id (from 0), offset (its place there), and ids if asked."""
    cut = pieces(docs, path, text_col, id_col, capacity, end, with_ids)
    by_task = stage(cut.groupBy("part", "length").count(), "piece-counts")
    total = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}   # at most ``capacity`` rows
    fixed, fitted = plan(total, capacity)
    shared = docs.sparkSession.sparkContext.broadcast(slots(fixed + fitted))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)    # a row for each task
    bases = by_task.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(bases, ["part", "length"]).withColumn("nth", F.col("nth") + F.col("base")).drop("part", "base")

    def place(batch):
        table, size, rank = shared.value, batch.column(at).to_numpy(), batch.column(nth).to_numpy()
        sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
        for s in np.unique(size):
            mine = np.flatnonzero(size == s)
            first, base, each, begin = table[s][np.searchsorted(table[s][:, 0], rank[mine], "right") - 1].T
            sequence[mine] = base + (rank[mine] - first) // each
            offset[mine] = begin + (rank[mine] - first) % each * s
        return [pa.array(sequence), pa.array(offset)]

    at, nth = ranked.columns.index("length"), ranked.columns.index("nth")
    out = with_columns(ranked, place, fields(sequence_id="bigint", offset="bigint"), drop=("nth",))
    kept = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return out.select(F.col("id").alias(id_col), *kept)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids: sequence_id, ids, and how many pieces are in it (a sequence holds
    ``capacity`` ids at most, so its group is bounded)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p.ids)).alias("ids"), F.count("*").alias("n_pieces"))
