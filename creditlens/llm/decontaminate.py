"""Benchmark decontamination with one Aho-Corasick automaton.

Every window of ``window`` consecutive item words (a shorter item is one
window) becomes a pattern of the automaton; each text is normalised and
scanned once, and matches are mapped back to word numbers and to offsets of
the original text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import keep, map_batches, raw_bytes, store

#: Item bytes that one automaton may hold (about 310 MB of a worker); more items
#: are scanned for in further passes of the same kind, one automaton at a time.
MAX_ITEM_BYTES = 1_000_000
#: Lower-cases A-Z and turns every ASCII character outside [0-9a-z] into a blank; byte length is unchanged.
_FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
              for b in range(256))


def normalise(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased (A-Z) text."""
    return (text or b"").translate(_FOLD).split()


def _key(words: list[bytes]) -> str:
    # latin-1 keeps one character per byte; blanks on both ends pin word borders
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def patterns(items: list[tuple[str, bytes | None]], window: int) -> dict[str, tuple[str, ...]]:
    """Pattern -> ids of the items that contain it."""
    found: dict[str, set[str]] = {}
    for item, text in items:
        words = normalise(text)
        width = min(window, len(words))
        for i in range(len(words) - width + 1 if words else 0):
            found.setdefault(_key(words[i:i + width]), set()).add(item)
    return {k: tuple(sorted(v)) for k, v in found.items()}


def automaton(table: dict[str, tuple[str, ...]], name: str) -> ahocorasick.Automaton:
    """Built once per worker process."""
    def build() -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for k, ids in table.items():
            a.add_word(k, (k.count(" ") - 1, ids))
        a.make_automaton()
        return a
    return keep(("windows", name), build)


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return merged


def scan(text: bytes | None, found: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged hit word ranges [start, end), ids of occurring items."""
    words = normalise(text)
    if not words or not len(found):
        return len(words), [], set()
    line = _key(words)
    spans, ids, blanks, seen = [], set(), 0, 0
    for end, (width, items) in found.iter(line):
        blanks += line.count(" ", seen, end + 1)  # blanks up to and with the closing one
        seen = end + 1
        spans.append((blanks - 1 - width, blanks - 1))
        ids.update(items)
    return len(words), _merge(spans), ids


def original_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges -> character ranges of the original text."""
    if not ranges:
        return []
    keep = np.frombuffer(text.translate(_FOLD), np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], keep.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [(int(chars[starts[s]]), int(chars[ends[e - 1]])) for s, e in ranges]


def item_tables(items: DataFrame, item_id: str = "item_id", item_text: str = "text",
                window: int = 10) -> Iterator[tuple[Broadcast, str, int, bool]]:
    """(broadcast pattern table, its name, number, whether it is the last) per
    block of at most about MAX_ITEM_BYTES of items: the size is checked before
    anything is collected, and larger item tables give more blocks.  A block
    is collected when the one before is done with."""
    bench = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"),
                         F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    total = bench.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = int(total // MAX_ITEM_BYTES) + 1
    for block in range(blocks):
        part = bench.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        table = patterns([(r["i"], r["t"].encode()) for r in part.collect()], window)
        name = hashlib.sha256(repr(sorted(table.items())).encode()).hexdigest()
        yield items.sparkSession.sparkContext.broadcast(table), name, block, block == blocks - 1


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = 10) -> DataFrame:
    """Per input row: ``doc_id, n_words, ranges`` (hit word ranges), ``spans``
    (the same as character offsets of the original text), ``items`` (ids of
    occurring items as strings, sorted).

    Null, empty and wordless texts have no words and no hits; null and
    wordless items no windows; a null item id is the empty string; repeated
    items and ids count once; repeated rows each get a row.  Other columns
    are ignored.  The item table is read in blocks of at most MAX_ITEM_BYTES
    (an item is never split); each block is one automaton and one scan, and
    the rows are stored between scans.  An empty table gives an empty result;
    very long texts are scanned whole.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.lit(0).cast("long").alias("n_words"),
                       F.array().cast("array<struct<start:int,end:int>>").alias("ranges"),
                       F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
                       F.array().cast("array<string>").alias("items"))
    schema = rows.schema
    for shared, name, block, last in item_tables(items, item_id, item_text, window):
        def run(batch: pa.RecordBatch, shared=shared, name=name, first=not block, last=last) -> pa.RecordBatch:
            auto = automaton(shared.value, name)
            texts = raw_bytes(batch, "text")
            before = None if first else (batch.column(3).to_pylist(), batch.column(5).to_pylist())
            n, ranges, spans, ids = [], [], [], []
            for k, text in enumerate(texts):
                count, hit, names = scan(text, auto)
                if before:
                    hit = _merge([*hit, *((r["start"], r["end"]) for r in before[0][k])])
                    names = names | set(before[1][k])
                n.append(count)
                ranges.append([{"start": s, "end": e} for s, e in hit])
                spans.append([{"start": s, "end": e} for s, e in original_spans(text or b"", hit)] if last else [])
                ids.append(sorted(names))
            pairs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.nulls(len(n), pa.string()) if last else batch.column(1), pa.array(n, pa.int64()),
                 pa.array(ranges, pairs), pa.array(spans, pairs), pa.array(ids, pa.list_(pa.string()))],
                ["doc_id", "text", "n_words", "ranges", "spans", "items"])
        rows = map_batches(rows, run, schema)
        if not last:
            rows = store(rows, "decontaminate")
            shared.unpersist()
    return rows.drop("text")


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = 10) -> DataFrame:
    """The rows of ``docs`` (same columns) in which no item window occurs."""
    at = docs.columns.index(text_col)
    for shared, name, _, last in item_tables(items, window=window):
        def run(batch: pa.RecordBatch, shared=shared, name=name) -> pa.RecordBatch:
            auto = automaton(shared.value, name)
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            return batch.filter(pa.array([not scan(t, auto)[1] for t in texts], pa.bool_()))
        docs = map_batches(docs, run, docs.schema)
        if not last:
            docs = store(docs, "decontaminate")
            shared.unpersist()
    return docs
