"""Exact removal of repeated word windows by level-wise doubling.

A window is ``window`` consecutive words.  Windows are first tested by a short
piece of them; only those whose piece repeats are tested by a piece of twice
the length, and so on until the piece is the window (lengths 9, 18, 35 for 35
words).  The piece of a window is its anchor: the piece with the smallest
hash in it.  Equal windows have equal anchors at equal places, so a window
whose anchor occurs once occurs once, and neighbouring windows share anchors:
the first level sends about one row per 13 words, and later levels only see
what is still in question.

Texts are handled once per distinct text; the shuffled rows are hashes and
places, and texts themselves travel compressed.  Counts are combined before
the shuffle and joined back to the places, so a window in very many texts is
neither gathered nor paired.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import raw_bytes, ship, store

_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: The check bits are sums modulo the prime 2^31 - 1, over bytes and over words.
_PRIME, _CHECK_BASE, _CHECK_WORD_BASE = (1 << 31) - 1, 0x2545F491, 0x5851F42D


def levels(window: int) -> list[int]:
    """Piece lengths, each at most twice the one before, the last the window itself."""
    out = [window]
    while out[0] > 12:
        out.insert(0, -(-out[0] // 2))
    return out


@lru_cache(4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base^k and base^-k mod 2^64 for k < size."""
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(size, b, np.uint64)
        steps[0] = 1
        both.append(np.cumprod(steps, dtype=np.uint64))
    return both[0], both[1]


def _sums(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values * base^k and the inverse powers."""
    up, down = _powers(base, 1 << max(12, int(len(values)).bit_length()))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return total, down


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(joined: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text joined by single blanks."""
    if not joined:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(joined, np.uint8)
    total, down = _sums(raw.astype(np.uint64) + np.uint64(1), _BASE)
    ends = np.append(np.flatnonzero(raw == 0x20), len(raw))
    starts = np.concatenate(([0], ends[:-1] + 1))
    return _mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@lru_cache(4)
def _check_powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base^k and base^-k mod _PRIME for k < size."""
    both = []
    for b in (base, pow(base, -1, _PRIME)):
        out = np.ones(1, np.uint64)
        while len(out) < size:
            out = np.concatenate((out, out * np.uint64(pow(b, len(out), _PRIME)) % np.uint64(_PRIME)))
        both.append(out[:size])
    return both[0], both[1]


def _check_sums(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[start + k] * base^k up to each end, mod _PRIME (values below it)."""
    prime = np.uint64(_PRIME)
    up, down = _check_powers(base, 1 << max(12, int(len(values)).bit_length()))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)] % prime, out=total[1:])  # exact: below 2^31 x 2^33 values
    return (total[ends] - total[starts]) % prime * down[starts] % prime


def check_hashes(joined: bytes) -> np.ndarray:
    """Hashes of the words below _PRIME, from other sums than :func:`word_hashes`."""
    if not joined:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(joined, np.uint8)
    ends = np.append(np.flatnonzero(raw == 0x20), len(raw))
    starts = np.concatenate(([0], ends[:-1] + 1))
    return (_check_sums(raw.astype(np.uint64) + np.uint64(1), _CHECK_BASE, starts, ends)
            + (ends - starts).astype(np.uint64)) % np.uint64(_PRIME)


class Pieces:
    """Hashes of all ``length``-word pieces of a text and the anchor of each window."""

    def __init__(self, words: np.ndarray, length: int, window: int):
        n = len(words)
        total, down = _sums(words, _WORD_BASE)
        at = np.arange(max(0, n - length + 1))
        self.hashes = _mix((total[at + length] - total[at]) * down[at])
        self.length = length
        # smallest hash (leftmost) of the pieces in each window, by doubling the range
        width, have, best = window - length + 1, 1, at
        while have < width:
            step = min(have, width - have)
            left, right = best[:len(best) - step], best[step:]
            best = np.where(self.hashes[left] <= self.hashes[right], left, right)
            have += step
        self.anchors = best  # one per window start

    def check(self, joined: bytes, at: np.ndarray) -> np.ndarray:
        """Further 31 bits of the pieces at ``at``, from the words of the text
        by sums of another modulus, so they do not follow from ``hashes``."""
        return _check_sums(check_hashes(joined), _CHECK_WORD_BASE, at, at + self.length)


def _spans(starts: np.ndarray) -> list[int]:
    """Sorted numbers as flat [first, last, first, last, ...] runs."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    return np.stack((starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)]), 1).reshape(-1).tolist()


def _numbers(spans: list[int]) -> np.ndarray:
    pairs = np.array(spans, np.int64).reshape(-1, 2)
    return np.concatenate([np.arange(a, b + 1) for a, b in pairs]) if len(pairs) else np.zeros(0, np.int64)


def distinct_texts(docs: DataFrame, window: int) -> DataFrame:
    """One row per distinct text: ``tid, h1, h2, copies, n, sha, blob`` (words joined by blanks, compressed)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                n, sha, blobs = [], [], []
                for text in raw_bytes(batch, "text"):  # one text's words at a time
                    words = (text or b"").split()
                    joined = b" ".join(words)
                    n.append(len(words))
                    sha.append(hashlib.sha256(joined).hexdigest())
                    blobs.append(squeeze.compress(joined) if len(words) >= window else b"")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sha, pa.string()),
                     pa.array(blobs, pa.binary())], ["h1", "h2", "n", "sha", "blob"])
    ship(docs.sparkSession)
    rows = docs.select("h1", "h2", "text").mapInArrow(run, "h1 long, h2 long, n long, sha string, blob binary")
    return (rows.groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sha").alias("sha"),
                                         F.first("blob").alias("blob"))
            .withColumn("tid", F.monotonically_increasing_id()))


def _pieces(state: DataFrame, length: int, window: int) -> DataFrame:
    """``(g, c, tid, pos)``: the distinct anchors of the windows still in question."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for tid, blob, spans in zip(*(c.to_pylist() for c in batch.columns)):
                joined = expand.decompress(blob)
                found = Pieces(word_hashes(joined), length, window)
                at = np.unique(found.anchors[_numbers(spans)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.hashes[at].view(np.int64)),
                     pa.array(found.check(joined, at).astype(np.int32)),
                     pa.array(np.full(len(at), tid, np.int64)), pa.array(at.astype(np.int32))], ["g", "c", "tid", "pos"])

    ship(state.sparkSession)
    return state.select("tid", "blob", "spans").mapInArrow(_gathered(run), "g long, c int, tid long, pos int")


def _gathered(run):
    """Joins small record batches into larger ones."""
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in run(batches):
            held.append(b)
            rows += b.num_rows
            if rows >= 50_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return out


def _narrow(state: DataFrame, alive: DataFrame, length: int, window: int) -> DataFrame:
    """The texts and windows whose anchor is in ``alive`` (tid, places)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            kept = []
            for tid, blob, spans, places in zip(*(c.to_pylist() for c in batch.columns)):
                found = Pieces(word_hashes(expand.decompress(blob)), length, window)
                starts = _numbers(spans)
                mark = np.zeros(len(found.hashes), bool)
                mark[places] = True
                kept.append(_spans(starts[mark[found.anchors[starts]]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.list_(pa.int64()))],
                                             ["tid", "blob", "spans"])
    return (state.select("tid", "blob", "spans").join(alive, "tid")
            .mapInArrow(run, "tid long, blob binary, spans array<bigint>"))


def _repeated(pieces: DataFrame, length: int) -> DataFrame:
    """Places of the pieces that occur more than once: ``(tid, places)``.

    Pieces are hashed once and stored, and so are the repeated keys: the join
    then reads two tables, so a key with very many places can be split (an
    aggregate between its shuffle and its sort would keep the skew join away)."""
    pieces = store(pieces, f"substring-pieces-{length}")
    often = store(pieces.groupBy("g", "c").agg(F.count("*").alias("k")).where("k > 1").drop("k"), f"substring-often-{length}")
    return pieces.join(often, ["g", "c"], "left_semi").groupBy("tid").agg(F.collect_list("pos").alias("places"))


def _cover(state: DataFrame, window: int) -> DataFrame:
    """``(tid, kept, sha)``: what is left of each text when the windows in ``spans`` go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            n, sha = [], []
            for blob, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = expand.decompress(blob).split()
                edge = np.zeros(len(words) + 1, np.int64)
                for a, b in zip(spans[::2], spans[1::2]):
                    edge[a] += 1
                    edge[min(b + window, len(words))] -= 1
                kept = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                n.append(len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string())],
                                             ["tid", "kept", "kept_sha"])
    ship(state.sparkSession)
    return state.mapInArrow(run, "tid long, kept long, kept_sha string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` per input row: every word
    covered by a window whose words also start anywhere else goes.

    Null, empty and blank texts have no words; texts shorter than the window
    lose none; all words of a text (of window length or more) that occurs in
    two rows go.  Repeated rows each get a row and are copies of each other;
    null ids stay null; other columns are ignored; an empty table gives an
    empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.col("text")).alias("h2"))
    texts = store(distinct_texts(keyed, window), "substring-texts")
    state = texts.where(F.col("n") >= window).select(
        "tid", "blob", F.array(F.lit(0).cast("long"), F.col("n") - window).alias("spans"))
    for length in levels(window):
        alive = _repeated(_pieces(state, length, window), length)
        state = store(_narrow(state, alive, length, window), f"substring-{length}")
    left = _cover(state, window)
    whole = (F.col("copies") > 1) & (F.col("n") >= window)  # another row holds the same text
    facts = texts.drop("blob").join(left, "tid", "left").select(
        "h1", "h2", F.col("n").alias("n_words"),
        F.when(whole, F.col("n")).otherwise(F.col("n") - F.coalesce("kept", "n")).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"))
    return keyed.select("doc_id", "h1", "h2").join(facts, ["h1", "h2"]).drop("h1", "h2")
