"""Language identification with hyperdimensional profiles.

Every letter class has a random bipolar vector.  An n-gram vector binds
(multiplies) its letters' vectors, each permuted (rotated) by its place; a
text's vector bundles (adds) the vectors of its n-grams, and a language's
prototype bundles those of its training texts.  A text takes the language
whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import raw_bytes, remainder_is, ship

DIMENSIONS = 512
#: 0 is "no letter", 1-26 are a-z, other letters share the rest by code point.
CLASSES = 48
#: Languages that the prototype table may hold.
MAX_LANGUAGES = 4096
UNKNOWN = "und"
_BLOCK_CHARS = 1 << 20


@lru_cache(1)
def _letter_class() -> np.ndarray:
    """Class of every code point; capitals share their small letter's class."""
    out = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[cp] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 >> 7) % (CLASSES - 27)
    return out


@lru_cache(1)
def gram_vectors() -> np.ndarray:
    """Vectors of all letter trigrams, int8, row a * CLASSES^2 + b * CLASSES + c."""
    letters = np.random.Generator(np.random.PCG64(99)).choice(np.array([-1, 1], np.int8), (CLASSES, DIMENSIONS))
    first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    pair = first[:, None, :] * second[None, :, :]
    return (pair[:, :, None, :] * letters[None, None, :, :]).reshape(-1, DIMENSIONS)


def gram_counts(text: bytes | None) -> tuple[np.ndarray, np.ndarray, bool]:
    """Trigram numbers of a text with their counts, and whether it has a
    letter.  Runs of other characters count as one border."""
    found, counts, letter, carry = [], [], False, np.zeros(1, np.uint8)
    text = (text or b"").decode()
    table = _letter_class()
    for at in range(0, len(text), _BLOCK_CHARS):
        piece = text[at:at + _BLOCK_CHARS]
        kind = table[np.frombuffer(piece.encode("utf-32-le"), np.uint32)]
        last = at + _BLOCK_CHARS >= len(text)
        kind = np.concatenate((carry, kind, np.zeros(int(last), np.uint8)))
        kind = kind[np.concatenate(([True], (kind[1:] != 0) | (kind[:-1] != 0)))]
        letter = letter or bool(kind.any())
        wide = kind.astype(np.int32)
        grams = np.sort((wide[:-2] * CLASSES + wide[1:-1]) * CLASSES + wide[2:])
        carry = kind[-2:]
        if len(grams):
            first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
            found.append(grams[first])
            counts.append(np.diff(np.append(first, len(grams))))
        if len(found) == 2:  # one entry per trigram, however many blocks the text has
            total = np.zeros(CLASSES ** 3, np.int64)
            for g, n in zip(found, counts):
                total[g] += n
            found = [np.flatnonzero(total).astype(np.int32)]
            counts = [total[found[0]]]
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), letter
    return found[0], counts[0], letter


def text_vector(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bundle of a text's trigrams, a slice of them at a time."""
    vectors, out = gram_vectors(), np.zeros(DIMENSIONS, np.float32)
    for at in range(0, len(grams), 8192):
        out += counts[at:at + 8192].astype(np.float32) @ vectors[grams[at:at + 8192]].astype(np.float32)
    return out


def prototypes(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, np.ndarray]:
    """Bundle of all texts of each non-null language: every task adds up its
    own texts' trigrams and sends one vector per language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def sums() -> pa.RecordBatch:
            vectors = gram_vectors()
            total = [np.zeros(DIMENSIONS, np.int64) for _ in held]
            for out, counts in zip(total, held.values()):
                used = np.flatnonzero(counts)
                for at in range(0, len(used), 4096):
                    part = used[at:at + 4096]
                    out += np.rint(counts[part].astype(np.float64) @ vectors[part].astype(np.float64)).astype(np.int64)
            names = [n for n in held for _ in range(DIMENSIONS)]
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(held))),
                 pa.array(np.concatenate(total))], ["lang", "i", "v"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), raw_bytes(batch, "text")):
                if lang not in held:
                    if len(held) >= 64:  # bounds a task's memory
                        yield sums()
                        held = {}
                    held[lang] = np.zeros(CLASSES ** 3, np.int64)
                grams, counts, _ = gram_counts(text)
                np.add.at(held[lang], grams, counts)
        if held:
            yield sums()

    ship(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    summed = rows.mapInArrow(run, "lang string, i int, v long").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    found = (summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("v"))
             .limit(MAX_LANGUAGES + 1).collect())
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r["lang"]: np.array([x["v"] for x in r["v"]], np.float64) for r in sorted(found, key=lambda r: r["lang"])}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` per row from the text alone.  A text
    that is null or has no letter gives ``und`` and 0, as does every text when
    there is no profile; equal cosines take the first language in code point
    order; a negative cosine counts as 0."""
    names = [n for n in profiles if np.linalg.norm(profiles[n])]
    unit = np.array([profiles[n] / np.linalg.norm(profiles[n]) for n in names], np.float32).reshape(len(names), DIMENSIONS)
    shared = docs.sparkSession.sparkContext.broadcast((names, unit))  # at most MAX_LANGUAGES x DIMENSIONS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, unit = shared.value
        for batch in batches:
            langs, scores = [], []
            for text in raw_bytes(batch, "text"):
                grams, counts, letter = gram_counts(text)
                best, cosine = UNKNOWN, 0.0
                if letter and names:
                    vector = text_vector(grams, counts)
                    cosines = unit @ vector / max(float(np.linalg.norm(vector)), 1e-9)
                    k = int(np.argmax(cosines))
                    best, cosine = names[k], min(1.0, max(0.0, float(cosines[k])))
                langs.append(best)
                scores.append(cosine)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ship(docs.sparkSession)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def identify(docs: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learns from the rows that are
    not held out (a null id is not) and predicts every row.  Null texts and
    texts without a letter are ``und``; repeated rows each get a row; very long
    texts are read whole in bounded memory; an empty table gives an empty
    result; other columns are ignored."""
    held = lambda: remainder_is(F.col("doc_id"), modulus, remainder)
    profiles = prototypes(docs.where(~held()))
    return predict(docs, profiles).select("doc_id", held().alias("held_out"), "lang_pred", "score")
