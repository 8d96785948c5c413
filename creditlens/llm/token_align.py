"""Alignment of two tokenizers over the same text.

A is a byte-level BPE of the ``tokenizers`` library, B a ``sentencepiece``
model with byte fallback; both see the text after one space.  The library's
character offsets (A) and the proto spans (B) are the coarse cuts: where a
token ends at the start of the next one, its end is known.  Tokens inside a
multibyte character share its span, and byte-fallback tokens have empty ones;
their ends are refined with the bytes that they decode to.  Byte offsets where
both sides end cut the tokens into groups; two tokens are linked where their
bytes overlap.

Neither tokenizer joins characters across certain places (a single space
before a character, a line feed after one, closing punctuation after a letter;
checked against the pieces of B when it is loaded), so a text is the sequence
of the words between them and a worker keeps the alignment of recent words.

The texts are encoded once.  What is stored of a text are its links in order,
each with the side or sides that end with it; groups and counts follow from
that.  Links of an id pair are counted over the corpus with a map-side sum per
task, and a last pass looks the counts up.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import raw_bytes, ship, store
from creditlens.llm.subwords import Recent

#: Words in each of the two generations of a worker's caches; longer words than LONG bytes are not kept.
CACHE_WORDS, LONG = 300_000, 100
#: Id pairs that are broadcast at most; more are joined by a shuffle.
MAX_PAIRS = 4_000_000
#: Bytes of a text that are cut into words at a time.
SLICE = 1 << 20
#: Links that are turned into text, or looked up, at a time.
LINKS = 1 << 18
_CALL = 1024
#: Where a text may be cut: before a single space that no other white space can follow, before a line feed after a
#: visible ASCII character, before closing punctuation after an ASCII letter.
_CUT = re.compile(rb"(?<=[^ ])(?= [!-~\x80-\xc1\xc3-\xe0\xe4-\xff])|(?<=[!-~])(?=\n)|(?<=[A-Za-z])(?=[,.;:!?])")
#: Spaces that are no such place.
_OTHER = re.compile(rb" (?![!-~\x80-\xc1\xc3-\xe0\xe4-\xff])")
#: Marks a word without the space before it (no UTF-8 text has this byte).
_BARE = b"\xff"


def byte_of_symbol() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_ends(begin: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """End offset of each token: its span's end where the next span starts there
    (a coarse cut), else the end before plus the bytes that it decodes to."""
    n, upto = len(sizes), np.cumsum(sizes)
    coarse = (end > begin) & (np.append(begin[1:], end[-1:]) >= end)
    last = np.maximum.accumulate(np.where(coarse, np.arange(n), -1))  # the coarse cut at or before each token
    return np.where(last >= 0, end[last] + upto - upto[last], upto)


class Aligner:
    """Both tokenizers, and the alignment of recent words: the packed codes of
    their links (a * size_b + b) and a byte per link, 1 where the token of A
    ends with it, 2 where that of B does, 3 where a group does; or None where
    the decoded bytes differ."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(public_tokenizers.path(a))
        self.a.encode_special_tokens = True
        symbols, size_a = byte_of_symbol(), self.a.get_vocab_size()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * size_a
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(symbols[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        self.size_b = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.kind = code_kind(size_a, self.size_b)
        before = json.loads(self.a.pre_tokenizer.__getstate__())
        joined = (p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)))
        self.cuts = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not any(
            re.search("[^▁]▁|.\n|[A-Za-z][,.;:!?]", p, re.S) for p in joined))
        self.words, self.parts, self.passing = Recent(CACHE_WORDS), Recent(CACHE_WORDS), []

    def keys(self, data: bytes) -> Iterator[list[bytes]]:
        """The words of `` text``, some at a time; the space before a word is left out."""
        if not self.cuts:
            yield [data[1:]]
            return
        at = 0
        while at < len(data):
            stop = _CUT.search(data, at + SLICE) if len(data) - at > SLICE else None
            end = stop.start() if stop else len(data)
            part = data[at:end] if at or stop else data
            if part[:1] == b" " and not _OTHER.search(part):
                yield part[1:].split(b" ")
            else:
                yield [p[1:] if p[:1] == b" " else _BARE + p for p in _CUT.split(part)]
            at = end

    def _align(self, parts: list[bytes]) -> list[tuple | None]:
        """The alignment of each part, many in one text.  A part without a space
        before it follows a letter, which neither side joins to it."""
        if len(parts) > 1 and any(p[-1:] == b" " for p in parts):  # only these could join the next part
            return [x for p in parts for x in self._align([p])]
        laid = [p if p[:1] == b" " else b" x" + p for p in parts]
        data = b"".join(laid)
        ends = np.cumsum(np.fromiter(map(len, laid), np.int64, len(laid)))
        starts = ends - np.fromiter(map(len, parts), np.int64, len(parts))
        text = data.decode()
        side_a = self.a.encode(text, add_special_tokens=False)
        side_b = self.b.encode(text[1:], return_type="proto").pieces  # B puts the first space before its text
        a_ids, b_spans = side_a.ids, [(p.id, p.begin, p.end) for p in side_b]
        same = (b"".join([self.a_bytes[i] for i in a_ids]) == data == b"".join([self.b_bytes[i] for i, _, _ in b_spans]))
        if same:
            a, spans = np.array(a_ids, np.int64), np.array(side_a.offsets, np.int64)
            if len(text) != len(data):  # characters to bytes
                starts_of = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
                spans = np.append(starts_of, len(data))[spans]
            b, begin, end = np.array(b_spans, np.int64).T
            a_end = byte_ends(spans[:, 0], spans[:, 1], self.a_sizes[a])
            b_end = byte_ends(np.append(0, begin[1:] + 1), np.append(end[0] + 1 if end[0] else 0, end[1:] + 1), self.b_sizes[b])
            edges = np.union1d(ends, starts[starts > 0])
            same = bool(np.isin(edges, a_end).all() and np.isin(edges, b_end).all())
        if not same:
            half = len(parts) // 2
            return [None] if not half else self._align(parts[:half]) + self._align(parts[half:])
        union = np.union1d(a_end, b_end)
        at_a, at_b = np.searchsorted(a_end, union), np.searchsorted(b_end, union)
        codes = (a[at_a] * self.size_b + b[at_b]).astype(self.kind).tobytes()
        sides = ((a_end[at_a] == union) + 2 * (b_end[at_b] == union)).astype(np.uint8).tobytes()
        low, high = (np.searchsorted(union, e, "right").tolist() for e in (starts, ends))
        width = self.kind.itemsize
        return [(codes[width * i:width * j], sides[i:j]) for i, j in zip(low, high)]

    def learn(self, keys: Iterable[bytes]) -> None:
        """Make the alignment of every one of ``keys`` present in ``words.young``."""
        for w in self.passing:
            self.words.young.pop(w, None)
        new = self.words.missing(keys)
        self.passing = [w for w in new if len(w) > LONG]
        cut = {w: _CUT.split(data) if self.cuts else [data] for w in new
               for data in [w[1:] if w[:1] == _BARE else b" " + w]}
        missing = self.parts.missing(p for parts in cut.values() for p in parts)
        odd = [p for p in missing if p[-1:] == b" "]
        plain = [p for p in missing if p[-1:] != b" "]
        known = self.parts.young
        for i in range(0, len(plain), _CALL):
            known.update(zip(plain[i:i + _CALL], self._align(plain[i:i + _CALL])))
        known.update((p, self._align([p])[0]) for p in odd)
        for w, parts in cut.items():
            found = [known[p] for p in parts]
            self.words.young[w] = found[0] if len(found) == 1 else None if None in found else (
                b"".join([x[0] for x in found]), b"".join([x[1] for x in found]))
        for p in missing:
            if len(p) > LONG:
                del known[p]

    def known(self, keys: Iterable[bytes]) -> list[tuple | None]:
        return list(map(self.words.young.__getitem__, keys))


def code_kind(size_a: int, size_b: int) -> np.dtype:
    return np.dtype(np.uint32 if size_a * size_b <= 2**32 else np.int64)


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    """The worker's aligner for two tokenizer files."""
    if (a, b) not in _LOADED:
        _LOADED[a, b] = Aligner(a, b)
    return _LOADED[a, b]


def _batches(batches: Iterator[pa.RecordBatch], tool: Aligner) -> Iterator[tuple[pa.RecordBatch, list[list[list[bytes]] | None]]]:
    """Rows of about SLICE bytes with the words of their texts, which are
    learned; a longer text comes alone, as None and its bytes are cut later."""
    for batch in batches:
        texts = raw_bytes(batch, "text")
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end] or b"") <= SLICE):
                size += len(texts[end] or b"")
                end += 1
            part = texts[at:end]
            if len(part) == 1 and size > SLICE:
                yield batch.slice(at, 1), part
            else:
                words = [next(tool.keys(b" " + t)) if t else [] for t in part]
                tool.learn(w for keys in words for w in keys)
                yield batch.slice(at, end - at), words
            at = end


def _slices(words: list[bytes] | bytes, tool: Aligner) -> Iterator[list[bytes]]:
    """The words of a text, learned, some at a time."""
    if isinstance(words, bytes):
        for keys in tool.keys(b" " + words):
            tool.learn(keys)
            yield keys
    elif words:
        yield words


def text_links(words: list[bytes] | bytes | None, tool: Aligner) -> tuple[bytes, bytes]:
    """Codes and sides of a text's links; none where a word is refused."""
    codes, sides = [], []
    for keys in _slices(words, tool):
        found = tool.known(keys)
        if None in found:
            return b"", b""
        codes += [x[0] for x in found]
        sides += [x[1] for x in found]
        if len(codes) > 4 * SLICE:
            codes, sides = [b"".join(codes)], [b"".join(sides)]
    return b"".join(codes), b"".join(sides)


def stored_links(docs: DataFrame, a: str, b: str) -> DataFrame:
    """``(doc_id, row, n, links)`` per row of ``(doc_id, text)``: its links,
    packed; ``row`` numbers the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, squeeze = aligner(a, b), zstandard.ZstdCompressor(1)
        for batch, texts in _batches(batches, tool):
            found = [text_links(words, tool) for words in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(sides) for _, sides in found], pa.int64()),
                 pa.array([squeeze.compress(codes + sides) for codes, sides in found], pa.binary())], ["doc_id", "row", "n", "links"])
    ship(docs.sparkSession)
    rows = docs.withColumn("row", F.monotonically_increasing_id()).select("doc_id", "row", "text")
    return store(rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, row long, n long, links binary"),
                 "align-links")


def _unpacked(batch: pa.RecordBatch, kind: np.dtype) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and sides of each row."""
    expand = zstandard.ZstdDecompressor()
    for n, blob in zip(batch.column("n").to_pylist(), batch.column("links")):
        raw = expand.decompress(blob.as_buffer()) if n else b""
        yield np.frombuffer(raw, kind, n), np.frombuffer(raw, np.uint8, n, n * kind.itemsize)


def _sum_by_code(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    return unique, np.bincount(inverse, np.concatenate(counts), len(unique)).astype(np.int64)


def pair_counts(links: DataFrame, kind: np.dtype, size_b: int) -> DataFrame:
    """``(code, n, best)``: how many links of the corpus hold an id pair, and
    whether that is the most that its B id has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = (np.zeros(0, kind), np.zeros(0, np.int64)), [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total[0].astype(np.int64)), pa.array(total[1])], ["code", "n"])

        for batch in batches:
            for codes, _ in _unpacked(batch, kind):
                held.append(codes)
                size += len(codes)
                if size > 1 << 21:
                    x, n = np.unique(np.concatenate(held), return_counts=True)
                    total, held, size = _sum_by_code([total[0], x], [total[1], n]), [], 0
                    if len(total[0]) > 1 << 21:
                        yield out()
                        total = np.zeros(0, kind), np.zeros(0, np.int64)
        if held:
            x, n = np.unique(np.concatenate(held), return_counts=True)
            total = _sum_by_code([total[0], x], [total[1], n])
        yield out()

    total = store(links.select("n", "links").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")),
                  "align-counts")
    most = total.groupBy((F.col("code") % size_b).alias("b")).agg(F.max("n").alias("most"))  # a row per B id at most
    return (total.withColumn("b", F.col("code") % size_b).join(F.broadcast(most), "b")
            .select("code", "n", (F.col("n") == F.col("most")).alias("best")))


def _parts(codes: np.ndarray, sides: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole groups, about LINKS links at a time."""
    at = 0
    while at < len(codes):
        end = at + LINKS
        while end < len(codes) and not (sides[at:end] == 3).any():
            end += LINKS
        if end < len(codes):
            end = at + int(np.flatnonzero(sides[at:end] == 3)[-1]) + 1
        yield codes[at:end], sides[at:end]
        at = end


class Writer:
    """Links -> groups as text."""

    def __init__(self, size_a: int, size_b: int):
        self.size_a, self.size_b = size_a, size_b
        # an id as it is written: within a group, and last of its side in it
        self.written = [b"%d%s" % (i, end) for n, ends in ((size_a, (b",", b"|")), (size_b, (b",", b";")))
                        for i in range(n) for end in ends]

    def groups(self, codes: np.ndarray, sides: np.ndarray) -> bytes:
        out = []
        for c, s in _parts(codes, sides):
            closed = s == 3
            group = np.cumsum(closed) - closed
            by_a, by_b = s & 1 > 0, s & 2 > 0
            a, b = c[by_a] // self.size_b, c[by_b] % self.size_b
            name = np.concatenate((2 * a.astype(np.int64) + closed[by_a], 2 * (self.size_a + b.astype(np.int64)) + closed[by_b]))
            order = np.argsort(np.concatenate((2 * group[by_a], 2 * group[by_b] + 1)), kind="stable")
            out += map(self.written.__getitem__, name[order].tolist())
        return b"".join(out)[:-1]


_SHAPE = "n_a long, n_b long, n_groups long, n_links long, groups string"


def _described(links: DataFrame, kind: np.dtype, size_a: int, size_b: int, score, extra: Sequence[str]) -> DataFrame:
    """``(doc_id, row, n_a, ..., groups, *extra)``; ``score(codes)`` gives the extra sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(size_a, size_b)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, out = batch.slice(at, 64), []
                for codes, sides in _unpacked(part, kind):
                    out.append((int((sides & 1 > 0).sum()), int((sides & 2 > 0).sum()), int((sides == 3).sum()), len(sides),
                                writer.groups(codes, sides), *(score(codes) if extra else ())))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(c, pa.int64()) for c in cols[:4]),
                     pa.array(cols[4], pa.binary()).cast(pa.string()), *(pa.array(c, pa.int64()) for c in cols[5:])],
                    ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups", *extra])
    kinds = f"doc_id {links.schema['doc_id'].dataType.simpleString()}, row long, {_SHAPE}" + "".join(f", {c} long" for c in extra)
    return links.mapInArrow(run, kinds)


def _exploded(links: DataFrame, kind: np.dtype) -> DataFrame:
    """``(row, code, k)``: the links of each row by id pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (codes, _) in zip(batch.column("row").to_pylist(), _unpacked(batch, kind)):
                x, n = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), row, np.int64)), pa.array(x.astype(np.int64)), pa.array(n)],
                                                 ["row", "code", "k"])
    return links.mapInArrow(run, "row long, code long, k long")


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", id_col: str = "doc_id",
          text_col: str = "text", max_pairs: int = MAX_PAIRS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum)`` per input row.

    ``groups`` is ``a1,a2|b1;a3|b2``: the ids of the groups in order.  n_best
    counts the links whose id pair is the most frequent of its B id in the
    corpus (ties included), count_sum adds up the counts of all links' pairs.
    Null and empty texts, and texts that either side does not give back byte
    by byte (such as those with U+2581), have no tokens: zeros and ''.  They
    count for no pair.  Strings of special tokens are plain text.  Ids may be
    null or repeated (a row each).  Very long texts are aligned whole, a slice
    of words at a time.  Other columns are ignored, an empty table gives an
    empty result.  The counts of more than ``max_pairs`` id pairs are joined
    by a shuffle instead of looked up, with the same result.
    """
    spark, tool = docs.sparkSession, aligner(a, b)
    size_a, size_b, kind = len(tool.a_bytes), tool.size_b, tool.kind
    links = stored_links(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), a, b)
    counts = store(pair_counts(links, kind, size_b), "align-pairs")
    if counts.count() > max_pairs:
        scored = (_exploded(links, kind).join(counts, "code").groupBy("row")
                  .agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"),
                       F.sum(F.col("k") * F.col("n")).alias("count_sum")))
        zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
        return (_described(links, kind, size_a, size_b, None, ()).join(scored, "row", "left")
                .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", zero("n_best"), zero("count_sum")))
    table = counts.toArrow().sort_by("code")
    code, n, best = (table.column(c).to_numpy() for c in ("code", "n", "best"))
    shared = spark.sparkContext.broadcast((code.astype(kind), n, best.astype(np.int64)))

    def score(codes: np.ndarray) -> tuple[int, int]:
        code, n, best = shared.value
        out = [0, 0]
        for i in range(0, len(codes), LINKS):
            at = np.searchsorted(code, codes[i:i + LINKS])
            out = [out[0] + int(best[at].sum()), out[1] + int(n[at].sum())]
        return out[0], out[1]

    return _described(links, kind, size_a, size_b, score, ("n_best", "count_sum")).drop("row")
