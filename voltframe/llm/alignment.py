"""Alignment of two tokenizers' ids over the same texts.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a sentencepiece model whose
pieces hold no space but at their front (runs of spaces aside).  A text gets a space in front, both
encode it, and the byte offsets where tokens of both end cut it into groups.  Tokens whose bytes
overlap are linked: a link is a stretch between two neighbouring ends of either kind.

Ends, groups and links come from cumulative sums over many texts at once.  Neither tokenizer joins a
character that is not white space with a space after it, so both end a token there whatever stands around:
there a very long text is cut, and its stretches are aligned one by one.

How many documents hold a linked pair is counted in two ways.  For each A id there is at most one
B id with the same bytes; such pairs, of which every exact one-to-one group holds one, are counted
in a vector as long as the vocabulary.  Only other pairs, from irregular groups, are shuffled,
added up by task first.  Texts are encoded once: each document's distinct pairs are staged, and when the
counts are known, a second pass over them gives every document's sums.  The vector and the ``known``
most frequent pairs (a fixed number, chosen by their counts' powers of two) go to all tasks; the rest, none
of which holds more than a ``known``-th of all, is joined by pair.

Defined cases: texts that are null, empty, or that either tokenizer doesn't give back byte for
byte have no tokens (zeros, and no groups); strings of special tokens are plain text; repeated rows and
ids count as documents of their own; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.bpe import BLANK, byte_letters
from voltframe.llm.common import Lazy, fields, stage, under_aliases, with_columns
from voltframe.llm.tokens import Encoder

KNOWN = 1 << 20
FLUSH = 1 << 20          # pairs that a task holds before it adds them up and sends them on
STRETCH, RUN = 1 << 19, 1 << 19      # characters that are encoded as one text, and that one round of vector work begins with


class Aligner:
    def __init__(self, a_spec: str, b_spec: bytes):
        from sentencepiece import SentencePieceProcessor

        self.a = Encoder(a_spec)
        self.a.library.encode_special_tokens = True
        self.a.special = None
        self.b = SentencePieceProcessor(model_proto=b_spec)
        raw = {c: bytes([i]) for i, c in enumerate(byte_letters())}
        vocab = self.a.library.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            # the added tokens are text, not byte letters
            self.a_bytes[i] = b"".join(raw[c] for c in token) if all(c in raw for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        self.n_b = len(self.b_bytes)
        by_bytes = {}
        for i, x in enumerate(self.b_bytes):
            if not (self.b.is_control(i) or self.b.is_unknown(i)) and (x not in by_bytes or self.b.is_byte(by_bytes[x])):
                by_bytes[x] = i
        self.same = np.array([by_bytes.get(x, -1) for x in self.a_bytes], np.int64)      # A id to the B id of the same bytes
        self.cut = re.compile(rf"(?<=[^{BLANK}])(?= )")
        self.lone_space = self.b.piece_to_id("▁")

        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        # how ids are written in a group, by what follows them
        self.written = np.array([f"{i}{end}" for n, ends in ((len(self.a_bytes), ",|"), (self.n_b, ",;")) for end in ends for i in range(n)], object)

    def parts(self, text: str):
        """The text with its space, cut at certain ends into stretches of bounded size."""
        text, at = " " + text, 0
        while at < len(text):
            border = self.cut.search(text, at + STRETCH) if len(text) - at > STRETCH else None
            end = border.start() if border else len(text)
            yield text[at:end]
            at = end

    def ids(self, stretches: list[str]) -> list[tuple[bytes, np.ndarray] | None]:
        """Ids of A and of B of stretches, of which B's model puts the first space itself; None where one
        doesn't give the stretch back."""
        out = []
        for text, b in zip(stretches, self.b.encode([x[1:] for x in stretches], num_threads=1)):
            b = b if len(text) > 1 else [self.lone_space]
            raw, a = text.encode(), self.a.one(text)
            good = b"".join([self.b_bytes[i] for i in b]) == raw and b"".join([self.a_bytes[i] for i in np.frombuffer(a, self.a.width).tolist()]) == raw
            out.append((a, np.array(b, np.int64)) if good else None)
        return out

    def aligned(self, a: np.ndarray, b: np.ndarray, a_doc: np.ndarray, docs: int):
        """Ids of stretches whose bytes are equal, and the document (below ``docs``) of each A id: for each
        document its groups, links and written groups; for links their document, A id and B id."""
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends_a, ends_b = (np.zeros(a_end[-1] + 1, bool) for _ in range(2))
        ends_a[a_end], ends_b[b_end] = True, True
        ends = np.flatnonzero(ends_a | ends_b)
        is_a, is_b = ends_a[ends], ends_b[ends]
        level = is_a & is_b
        at_a, at_b, group = (np.cumsum(x) - x for x in (is_a, is_b, level))      # of the link that ends there
        link_doc = a_doc[at_a]
        group_a, group_b, group_doc = group[is_a], group[is_b], link_doc[level]
        many = len(group_doc)
        in_a, in_b = np.bincount(group_a, minlength=many), np.bincount(group_b, minlength=many)
        upto_a, upto_b = np.cumsum(in_a), np.cumsum(in_b)
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[upto_a - 1], last_b[upto_b - 1] = True, True
        # a group is written as its A ids and then its B ids
        codes, n_a = np.empty(len(a) + len(b), np.int64), len(self.a_bytes)
        codes[np.arange(len(a)) + (upto_b - in_b)[group_a]] = a + n_a * last_a
        codes[np.arange(len(b)) + upto_a[group_b]] = b + 2 * n_a + self.n_b * last_b
        texts = self.written[codes].tolist()
        upto = np.searchsorted(group_doc, np.arange(docs + 1))         # groups before each document
        n_groups = np.diff(upto)
        before = np.append(0, upto_a + upto_b)[upto]
        groups = ["".join(texts[x:y])[:-1] for x, y in zip(before.tolist(), before[1:].tolist())]
        return n_groups, np.bincount(link_doc, minlength=docs), groups, link_doc, a[at_a], b[at_b]


@dataclass
class Alignment:
    """``documents``: the given columns and n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups; ``pairs``: a, b and n_docs for each linked pair."""
    documents: DataFrame
    pairs: DataFrame


def _share(df: DataFrame, a_path: str, b_path: str):
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        shared = df.sparkSession.sparkContext.broadcast(Lazy(Aligner, f.read(), g.read()))
    return lambda: shared.value.get()


def _joined(parts: list, digest: bool) -> str:
    if not digest:
        return ";".join(parts)
    out = hashlib.sha256()
    for n, p in enumerate(parts):
        out.update((";" + p if n else p).encode())
    return out.hexdigest()


def _align_run(tool: Aligner, held: list, sizes: np.ndarray, sound: np.ndarray, groups: list, links: list, digest: bool) -> None:
    """Align the held stretches (document, text) and add what they hold to the documents'."""
    found = [(i, x) for (i, _), x in zip(held, tool.ids([t for _, t in held]))]
    for i, x in found:
        sound[i] &= x is not None
    found = [(i, x) for i, x in found if sound[i]]
    if not found:
        return
    of = np.array([i for i, _ in found])
    a_ids = [np.frombuffer(x[0], tool.a.width) for _, x in found]
    n_a, n_b = np.array(list(map(len, a_ids))), np.array([len(x[1]) for _, x in found])
    a, b = np.concatenate(a_ids).astype(np.int64), np.concatenate([x[1] for _, x in found])
    n_groups, n_links, texts, nth, link_a, link_b = tool.aligned(a, b, np.repeat(np.arange(len(of)), n_a), len(of))
    for column, x in enumerate((n_a, n_b, n_groups, n_links)):
        np.add.at(sizes[:, column], of, x)
    for i, text in zip(of.tolist(), texts):
        groups[i].append(text)
    links.append(np.unique(of[nth] << 32 | (link_a * tool.n_b + link_b), return_counts=True))


ENCODED = dict(n_a="bigint", n_b="bigint", n_groups="bigint", n_links="bigint", groups="string", same="array<bigint>", same_n="array<int>",
               other="array<bigint>", other_n="array<int>")


def encoded(docs: DataFrame, get, text_col: str, digest: bool, drop: tuple[str, ...]) -> DataFrame:
    """``docs`` plus the sizes, groups (their SHA-256 with ``digest``) and distinct pairs of each
    text, with how often each is linked."""
    at = docs.columns.index(text_col)

    def run(batch):
        tool, texts = get(), batch.column(at).to_pylist()
        n = len(texts)
        sizes, sound = np.zeros((n, 4), np.int64), np.array([bool(t) for t in texts])
        hashes, links, held, size = [[] for _ in texts], [], [], 0
        for i, part in ((i, part) for i, t in enumerate(texts) if t for part in tool.parts(t)):
            held.append((i, part))
            size += len(part)
            if size > RUN:
                _align_run(tool, held, sizes, sound, hashes, links, digest)
                held, size = [], 0
        _align_run(tool, held, sizes, sound, hashes, links, digest)
        sizes[~sound] = 0
        groups = [_joined(h, digest) if ok else "" for h, ok in zip(hashes, sound.tolist())]
        # a document's pairs, added up over its runs: those of equal bytes by A id, others by code
        keys, times = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*links)) or ((), ())))
        keys, place = np.unique(keys, return_inverse=True)
        times = np.bincount(place, weights=times, minlength=len(keys)).astype(np.int64)
        doc, code = keys >> 32, keys & 0xFFFFFFFF
        good = sound[doc]
        doc, code, times = doc[good], code[good], times[good]
        a = code // tool.n_b
        same = tool.same[a] == code % tool.n_b
        ends = [pa.array(np.append(0, np.cumsum(np.bincount(doc[m], minlength=n))).astype(np.int32)) for m in (same, ~same)]
        lists = [pa.ListArray.from_arrays(e, pa.array(x, k)) for e, x, k in (
            (ends[0], a[same], pa.int64()), (ends[0], times[same], pa.int32()), (ends[1], code[~same], pa.int64()), (ends[1], times[~same], pa.int32()))]
        return [*(pa.array(x) for x in sizes.T.copy()), pa.array(groups, pa.string()), *lists]

    return with_columns(docs, run, fields(**ENCODED), drop)


def pair_counts(rows: DataFrame, get) -> DataFrame:
    """code (a x size of B + b), n: how many documents hold each linked pair."""
    def run(batches):
        tool = get()
        vector, held, size = np.zeros(len(tool.same), np.int64), [], 0
        ids = np.arange(len(vector))

        def sent(codes, n):
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

        for batch in batches:
            vector += np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(vector))
            held.append(batch.column(1).flatten().to_numpy())
            size += len(held[-1])
            if size > FLUSH:
                yield sent(*np.unique(np.concatenate(held), return_counts=True))
                held, size = [], 0
        if size:
            yield sent(*np.unique(np.concatenate(held), return_counts=True))
        there = ids[vector > 0]
        if len(there):
            yield sent(there * tool.n_b + tool.same[there], vector[there])

    return rows.select("same", "other").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, known: int) -> tuple[int, int]:
    """The least power of two such that at most ``known`` pairs have it or more, and how many
    have less."""
    rows = counts.groupBy((F.length(F.bin("n")) - 1).alias("power")).count().collect()     # 64 rows at most
    total, least = 0, 0
    for r in sorted(rows, key=lambda r: -r.power):
        if total + r["count"] > known:
            least = 2 ** (r.power + 1)
            break
        total += r["count"]
    return least, sum(r["count"] for r in rows) - total


def align(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", digest: bool = False, drop: tuple[str, ...] = (),
          known: int = KNOWN) -> Alignment:
    """``docs`` plus, for each text: tokens of A and B, groups, links; links whose pair is in as many
    documents as any pair of its A id (``n_best``); and the sum over links of that number of documents."""
    spark, get = docs.sparkSession, _share(docs, a_path, b_path)
    work, name, _ = under_aliases(docs)
    rows = stage(encoded(work.withColumn("row", F.monotonically_increasing_id()), get, name[text_col], digest, tuple(name[c] for c in drop)), "encoded")
    counts = stage(pair_counts(rows, get), "pair-counts")
    tool = get()
    a_of = F.expr(f"code div {tool.n_b}")
    best, vector = np.zeros(len(tool.same), np.int64), np.zeros(len(tool.same), np.int64)
    for r in counts.groupBy(a_of.alias("a")).agg(F.max("n").alias("n")).collect():                # one row for each A id at most
        best[r.a] = r.n
    own = spark.createDataFrame([(int(a * tool.n_b + b),) for a, b in enumerate(tool.same) if b >= 0], "code long")
    same = counts.join(F.broadcast(own), "code")                                                 # one row for each A id at most
    for r in same.collect():
        vector[r.code // tool.n_b] = r.n
    others = counts.join(F.broadcast(own), "code", "left_anti")
    least, rare = _frequent(others, known)
    top = others.where(F.col("n") >= least).toArrow()                                            # ``known`` rows at most
    codes, order = np.sort(top["code"].to_numpy()), np.argsort(top["code"].to_numpy())
    shared = spark.sparkContext.broadcast((best, vector, codes, top["n"].to_numpy()[order], tool.n_b))
    places = [rows.columns.index(c) for c in ("same", "same_n", "other", "other_n")]

    def sums(batch):
        best, vector, codes, n_of, n_b = shared.value
        columns = [batch.column(i) for i in places]
        row_of = [np.repeat(np.arange(batch.num_rows), c.value_lengths().to_numpy()) for c in (columns[0], columns[2])]
        same, same_n, other, other_n = (c.flatten().to_numpy() for c in columns)
        n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)

        def add(row, a, n, times):
            np.add.at(total, row, n * times)
            np.add.at(n_best, row, times * (n == best[a]))

        add(row_of[0], same, vector[same], same_n.astype(np.int64))
        at = np.searchsorted(codes, other)
        found = np.zeros(len(other), bool)
        inside = at < len(codes)
        found[inside] = codes[at[inside]] == other[inside]
        add(row_of[1][found], other[found] // n_b, n_of[at[found]], other_n[found].astype(np.int64))
        left = ~found
        lengths = np.bincount(row_of[1][left], minlength=batch.num_rows)
        ends = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
        return [pa.array(n_best), pa.array(total), pa.ListArray.from_arrays(ends, pa.array(other[left], pa.int64())),
                pa.ListArray.from_arrays(ends, pa.array(other_n[left], pa.int32()))]

    out = with_columns(rows, sums, fields(n_best="bigint", count_sum="bigint", rare="array<bigint>", rare_n="array<int>"),
                       drop=("same", "same_n", "other", "other_n"))
    if rare:
        out = stage(out, "known-links")
        mine = out.select("row", F.explode(F.arrays_zip(F.col("rare").alias("code"), F.col("rare_n").alias("times"))).alias("p")).select("row", "p.*")

        def is_best(batch):
            best, n_b = shared.value[0], shared.value[4]
            return [pa.array(batch.column(1).to_numpy() == best[batch.column(0).to_numpy() // n_b])]

        scarce = with_columns(others.where(F.col("n") < least).select("code", "n"), is_best, fields(is_best="boolean"))
        late = mine.join(scarce, "code").groupBy("row").agg(
            F.sum(F.col("n") * F.col("times")).alias("late_sum"), F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("late_best"))
        out = out.join(late, "row", "left").withColumns({c: F.col(c) + F.coalesce(F.col(x), F.lit(0))
                                                          for c, x in (("n_best", "late_best"), ("count_sum", "late_sum"))})
    found = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    taken = {c.lower() for c in found}
    kept = [F.col(a).alias(c) for c, a in name.items() if c not in drop and c.lower() not in taken]
    pairs = counts.select(a_of.alias("a"), (F.col("code") % tool.n_b).alias("b"), F.col("n").alias("n_docs"))
    return Alignment(out.select(*kept, *found), pairs)
