"""BPE encoding and decoding with forced boundaries.

A merge only ever makes a vocabulary token, so two neighbouring bytes that stand side by side in
no token can't be joined by any order of merges: between them a cut is certain.  Words are cut
there, every fragment is encoded by itself (the library merges it, with or without the end of a word) and
the ids are concatenated.  White space is a certain cut too, so pieces and fragments recur, and their ids
are kept in tables of bounded size.

The vocabulary file is read on the driver (``path`` is a parameter) and broadcast as text.  The
library normalises and splits pieces beyond ASCII; merging and joining are done here.

Defined cases: null is the empty text and has no ids; special tokens that a text spells out are
single ids, as the library has it; a fragment of any length takes n log n steps.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voltframe.llm.common import Remembered, fields, share_file, with_columns

KEPT = 200_000
# The Unicode property White_Space (Python's own class also has 28 to 31).
BLANK = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


# The letters of Latin-1 beyond ASCII, as ranges of a pattern.
LATIN = "\xc0-\xd6\xd8-\xf6\xf8-\xff"
PROBES = ["It's 2024, WE'LL go!  don't\tA_b-c...", "É日本 ﬁß x1y2 'S 's<|endoftext|> <|x|>", "aaaaaaaaaaaaaaaa #@!%^ 100,000.50"]


def byte_letters() -> list[str]:
    """The visible character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file, given as its JSON text."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        model = json.loads(spec)
        self.library = Tokenizer.from_str(spec)
        self.vocab = model["model"]["vocab"]
        self.suffix = model["model"].get("end_of_word_suffix") or ""
        # the library's merging, of fragments that end a word and of others
        self.ending = self.library.model
        model["model"]["end_of_word_suffix"] = None
        self.inside = Tokenizer.from_str(json.dumps(model)).model
        self.letters = byte_letters()
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.special = special
        self.splits = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.names = {i: t for t, i in {**self.vocab, **special}.items()}
        self.together = {(a, b) for t in self.vocab for a, b in zip(self._bare(t), self._bare(t)[1:])}
        self.pieces = re.compile(rf"[^{BLANK}]+")
        self.odd = re.compile(r"[\x1c-\x1f]")
        self.plain = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
        self.latin = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^a-z0-9{LATIN}]+")
        self.beyond = re.compile(rf"[^\x00-\x7f{LATIN}]")
        self.bytes_of = {c: "".join(self.letters[b] for b in chr(c).encode()) for c in range(256)}
        self.chunks = Remembered(self.chunk_ids, KEPT)
        self.inner = Remembered(lambda f: [t.id for t in self.inside.tokenize(f)], KEPT)
        self.last = Remembered(lambda f: [t.id for t in self.ending.tokenize(f)], KEPT)
        for text in PROBES:
            ids = self.library.encode(text, add_special_tokens=False).ids
            if np.frombuffer(self.encode(text), "<u4").tolist() != ids or self.decode(np.array(ids, "<u4").tobytes()) != self.library.decode(ids, skip_special_tokens=False):
                raise ValueError("this vocabulary splits, normalises or joins texts in another way than this codec")

    def _bare(self, token: str) -> str:
        return token[:-len(self.suffix)] if self.suffix and token.endswith(self.suffix) else token

    def cuts(self, word: str) -> list[str]:
        """The word parted wherever its neighbouring bytes never meet inside a token."""
        at = [i for i in range(1, len(word)) if (word[i - 1], word[i]) not in self.together]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)])] if at else [word]

    def words(self, chunk: str) -> list[str]:
        """The pre-tokens of a piece without white space, in byte letters."""
        if chunk.isascii():
            found = self.plain.findall(chunk.lower())
            return found if chunk.isprintable() else [w.translate(self.bytes_of) for w in found]
        if self.beyond.search(chunk) is None:            # composed letters, of which lower case is one too
            return [w.translate(self.bytes_of) for w in self.latin.findall(chunk.lower())]
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))]

    def chunk_ids(self, chunk: str) -> bytes:
        out = array("I")
        for word in self.words(chunk):
            *inner, last = self.cuts(word)
            for part in inner:
                out.extend(self.inner[part])
            out.extend(self.last[last])
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.splits and "<|" in text and len(runs := self.splits.split(text)) > 1:
            return b"".join(np.array([self.special[r]], "<u4").tobytes() if i % 2 else self.encode_plain(r) for i, r in enumerate(runs))
        return self.encode_plain(text)

    def encode_plain(self, text: str) -> bytes:
        chunks = text.split() if self.odd.search(text) is None else self.pieces.findall(text)
        kept = self.chunks
        return b"".join([kept[c] for c in chunks])

    def decode(self, ids: bytes) -> str:
        """The tokens' strings with a space between two: the file names no decoder."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus the ids of each text (array<bigint>, empty for null)."""
    get, at = share_file(docs, path, Codec), docs.columns.index(text_col)

    def run(batch):
        codec = get()
        rows = [np.frombuffer(codec.encode(t), "<u4").astype(np.int64) for t in batch.column(at).to_pylist()]
        return [pa.array(rows, pa.list_(pa.int64()))]

    return with_columns(docs, run, fields(**{out: "array<bigint>"}), drop)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded", drop: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` plus the text that the ids stand for (null ids give the empty text)."""
    get, at = share_file(rows, path, Codec), rows.columns.index(ids_col)

    def run(batch):
        codec = get()
        return [pa.array([codec.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(at).to_pylist()], pa.string())]

    return with_columns(rows, run, fields(**{out: "string"}), drop)


def digests(docs: DataFrame, path: str, text_col: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus n_tokens, ids_sha256 and decoded_sha256: encoded and decoded in one pass,
    so neither ids nor decoded texts travel."""
    get, at = share_file(docs, path, Codec), docs.columns.index(text_col)

    def run(batch):
        codec, n, ids, texts = get(), [], [], []
        for t in batch.column(at).to_pylist():
            got = codec.encode(t)
            n.append(len(got) // 4)
            ids.append(hashlib.sha256(got).hexdigest())
            texts.append(hashlib.sha256(codec.decode(got).encode()).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]

    return with_columns(docs, run, fields(n_tokens="bigint", ids_sha256="string", decoded_sha256="string"), drop)
