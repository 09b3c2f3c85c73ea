"""Language identification with string kernels.

The kernel of two texts is the blended spectrum of presence: the number of byte n-grams, n = 1 to
3, that both hold, over the root of the product of their own numbers (hashed to ``SIZES`` places,
one range for each n).  ``fit`` takes about ``PER_LANG`` labelled texts of each language, chosen by
a hash of id and text, and ``LANDMARKS`` of them as Nystroem landmarks.  One-versus-rest kernel
ridge regression on the Nystroem features has a closed form.  Texts are scored in batches: one
product gives the kernels with all landmarks, one the scores of all languages.

Whole texts are read.  A text that is null or has no letter is ``und`` with score 0, and so is
every text if nothing could be learned.  Null ids and null languages teach nothing.  The score is
the softmax of the regression values, so it lies between 0 and 1; ties go to the first language
in alphabetical order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import fields, hash_sample, under_aliases, with_columns

SIZES = (256, 4096, 12288)          # places for the n-grams of one, two and three bytes
PER_LANG, LANDMARKS, RIDGE, SHARPNESS = 500, 192, 1e-3, 6.0
PIECE_ROWS, PIECE_BYTES = 64, 1 << 20
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray            # features by landmark, each of length 1
    weights: np.ndarray              # landmark by language


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def presence(texts: list[str | None]) -> np.ndarray:
    """A row of 0 and 1 for each text: which hashed n-grams it holds.  Runs of bytes that are
    not letters count as one space each byte."""
    out = np.zeros((len(texts), sum(SIZES)), np.float32)
    plain = np.full(256, 32, np.uint8)
    plain[97:123] = np.arange(97, 123)
    plain[128:] = np.arange(128, 256)
    for row, text in zip(out, texts):
        raw = np.frombuffer((text or "").lower().encode(), np.uint8)
        for lo in range(0, len(raw), PIECE_BYTES):
            b = plain[raw[lo:lo + PIECE_BYTES + 2]]
            row[b] = 1
            b = b.astype(np.uint32)
            pair = b[:-1] << 8 | b[1:]
            row[SIZES[0] + (pair * np.uint32(2654435761) >> 16) % SIZES[1]] = 1
            three = pair[:-1] << 8 | b[2:]
            row[SIZES[0] + SIZES[1] + (three * np.uint32(2246822519) >> 12) % SIZES[2]] = 1
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.maximum(1, x.sum(axis=1, keepdims=True)))


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        per_lang: int = PER_LANG, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Learn from the rows for which ``learn`` holds.  The driver gets one packed bit row of
    2 KB for each sampled text, so its share is bounded by ``per_lang`` and the languages."""
    rows = docs.where(learn & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("id"))
    key = [F.col("id").cast("string"), F.col("text")]
    rows = hash_sample(rows, "lang", key, per_lang).select("text", "lang", F.xxhash64(*key).alias("place"))

    def bits(batch):
        texts = batch.column(0).to_pylist()
        packed = [np.packbits(presence([t]).astype(bool)).tobytes() if _has_letter(t) else None for t in texts]
        return [pa.array(packed, pa.binary())]

    got = with_columns(rows, bits, fields(bits="binary"), drop=("text",)).where("bits is not null").distinct().collect()
    if not got:
        return None
    nth, last = {}, {}
    for r in sorted(got, key=lambda r: (r.lang, r.place)):
        last[r.lang] = nth[r] = last.get(r.lang, 0) + 1
    got.sort(key=lambda r: (nth[r], r.lang))
    x = np.unpackbits(np.frombuffer(b"".join(r.bits for r in got), np.uint8).reshape(len(got), -1), axis=1,
                      count=sum(SIZES)).astype(np.float32)
    x = _unit(x)
    names = sorted({r.lang for r in got})
    y = np.array([[1.0 if r.lang == n else -1.0 for n in names] for r in got])
    marks = x[:landmarks]                               # round robin over the languages
    among = (marks @ marks.T).astype(float)
    values, vectors = np.linalg.eigh(among + 1e-6 * np.eye(len(among)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    z = (x @ marks.T).astype(float) @ root
    share = np.array([1 / max(1, sum(r.lang == n for r in got)) for n in names])
    weight = np.array([share[names.index(r.lang)] for r in got]) * len(got) / len(names)
    w = np.linalg.solve((z * weight[:, None]).T @ z + ridge * len(got) * np.eye(z.shape[1]), (z * weight[:, None]).T @ y)
    return Model(names, np.ascontiguousarray(marks.T), (root @ w).astype(np.float32))


def scores(model: Model, texts: list[str | None]) -> np.ndarray:
    """Softmax of the one-versus-rest values, by text and language."""
    kernels = _unit(presence(texts)) @ model.landmarks
    values = (kernels @ model.weights).astype(float) * SHARPNESS
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus lang_pred and score."""
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        model, column = shared.value, batch.column(at)
        names, best = [UNKNOWN] * len(column), np.zeros(len(column))
        for lo in range(0, len(column) if model else 0, PIECE_ROWS):
            texts = column.slice(lo, PIECE_ROWS).to_pylist()
            p = scores(model, texts)
            top = p.argmax(axis=1)
            for i, t in enumerate(texts):
                if _has_letter(t):
                    names[lo + i], best[lo + i] = model.languages[top[i]], p[i, top[i]]
        return [pa.array(names, pa.string()), pa.array(best, pa.float64())]

    return with_columns(docs, run, fields(lang_pred="string", score="double"), drop)


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``; not so for null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == part, F.lit(False))


def keep_known(docs: DataFrame, model: Model | None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the texts that have no language (``und``), and with the predicted language
    where ``lang_col`` is null.  If nothing could be learned, all texts that have a letter stay as
    they are."""
    work, name, back = under_aliases(docs)
    if model is None:
        return back(work.where(F.col(name[text_col]).rlike(r"\p{L}")))
    found = identify(work, model, name[text_col]).where(F.col("lang_pred") != UNKNOWN)
    if lang_col in name:
        found = found.withColumn(name[lang_col], F.coalesce(F.col(name[lang_col]), F.col("lang_pred").cast(docs.schema[lang_col].dataType)))
    return back(found)
