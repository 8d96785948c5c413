"""Token ids in byte-aligned variable-length blocks.

Ids are ranked by their frequency in the whole corpus, so frequent ids take
one byte.  A block holds the ranks of consecutive documents: a control stream
with two bits per rank (its byte length - 1, four ranks to a control byte) and
a data stream with the little-endian bytes.  A 256-row table gives the four
lengths of a control byte, so a whole block is decoded by numpy indexing.

Files are Parquet rows ``(part, seq, before, doc_ids, counts, control, data)``
in ascending doc_id order of (part, seq), plus the id ranking.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.llm.common import map_batches, release, shared_path, ship, store
from creditlens.llm.subwords import word_ids

END_ID = 2
#: Ids in a block (a longer document is a block of its own).
BLOCK_IDS = 1 << 20
_TEXTS = 1024
_LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """uint32 values -> (control bytes, data bytes)."""
    values = np.ascontiguousarray(values, "<u4")
    n = len(values)
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-n // 4) * 4, np.uint8)
    codes[:n] = size - 1
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8)[None, :] < size[:, None]]
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """Inverse of :func:`encode` for ``n`` values."""
    size = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4, dtype=np.uint8)[None, :] < size[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


def _pack(ids: np.ndarray, squeeze: zstandard.ZstdCompressor) -> bytes:
    return squeeze.compress(ids.astype("<u2" if not len(ids) or ids.max() < 65536 else "<u4").tobytes())


def _unpack(blob: bytes, n: int, expand: zstandard.ZstdDecompressor) -> np.ndarray:
    raw = expand.decompress(blob)
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype(np.uint32)


def token_ids(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int | None) -> DataFrame:
    """``(doc_id, n, ids)``: packed ids of each text, with the end id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, squeeze = word_ids(tokenizer), zstandard.ZstdCompressor(1)
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(at, _TEXTS)
                flat, edges = words.of_column(part.column(1))
                edges = edges.tolist()
                ids = [np.concatenate((flat[a:b], tail)) for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([_pack(x, squeeze) for x in ids], pa.binary())], ["doc_id", "n", "ids"])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ship(docs.sparkSession)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, ids binary")


def ranking(packed: DataFrame) -> np.ndarray:
    """Ids by falling frequency over the corpus (ties: smaller id first).
    Bounded by the tokenizer's vocabulary."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # the words of the tasks before
        expand, total = zstandard.ZstdDecompressor(), np.zeros(0, np.int64)
        for batch in batches:
            for n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = np.bincount(_unpack(blob, n, expand), minlength=len(total))
                seen[:len(total)] += total
                total = seen
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])
    ship(packed.sparkSession)
    rows = (packed.select("n", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
            .collect())
    return np.array([r["id"] for r in sorted(rows, key=lambda r: (-r["n"], r["id"]))], np.uint32)


_BLOCK = "part int, seq int, before long, doc_ids array<{id}>, counts array<long>, control binary, data binary"


def write(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", id_col: str = "doc_id",
          text_col: str = "text", end_id: int | None = END_ID) -> None:
    """Tokenize ``docs`` and write block files under ``path``/blocks and the
    ranking under ``path``/ranking, documents in ascending id order.

    Null and empty texts hold only the end id.  Null ids come first; rows with
    equal ids follow one another in a fixed order.  An empty table writes no
    block.  Other columns are ignored.
    """
    spark = docs.sparkSession
    packed = store(token_ids(docs, tokenizer, id_col, text_col, end_id), "token-ids")
    ranks = ranking(packed)
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(ranks)], "rank int, id long").write.parquet(f"{path}/ranking")
    rank_of = np.zeros(int(ranks.max(initial=0)) + 1, np.uint32)
    rank_of[ranks] = np.arange(len(ranks), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)
    kind = packed.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        expand, part = zstandard.ZstdDecompressor(), TaskContext.get().partitionId()
        seq = before = held = 0
        docs_, counts, ids = [], [], []

        def block() -> pa.RecordBatch:
            control, data = encode(shared.value[np.concatenate(ids)])
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([docs_], pa.list_(id_type)), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                ["part", "seq", "before", "doc_ids", "counts", "control", "data"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc, n, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and held + n > BLOCK_IDS:
                    yield block()
                    seq, before, held = seq + 1, before + held, 0
                    docs_, counts, ids = [], [], []
                docs_.append(doc)
                counts.append(n)
                ids.append(_unpack(blob, n, expand))
                held += n
        if ids:
            yield block()

    (packed.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
     .mapInArrow(run, _BLOCK.format(id=kind)).write.parquet(f"{path}/blocks"))


def read(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document from the files at
    ``path``; ``start`` counts the ids of all documents before it."""
    blocks = spark.read.schema(_BLOCK.format(id=id_type)).parquet(f"{path}/blocks")
    # one row per written partition
    totals = blocks.groupBy("part").agg(F.max(F.col("before") + F.aggregate(
        "counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).orderBy("part").collect()
    base, so_far = {}, 0
    for r in totals:
        base[r["part"]], so_far = so_far, so_far + r["n"]
    ranks = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranking").orderBy("rank").collect()], np.uint32)
    shared = spark.sparkContext.broadcast((base, ranks))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        release()
        base, ranks = shared.value
        out: list[list] = [[], [], [], []]
        for i in range(batch.num_rows):
            part, _, before, doc_ids, counts, control, data = (c[i].as_py() for c in batch.columns)
            ids = ranks[decode(control, data, sum(counts))].astype("<u4")
            at = 0
            for doc, n in zip(doc_ids, counts):
                out[0].append(doc)
                out[1].append(base[part] + before + at)
                out[2].append(n)
                out[3].append(zlib.crc32(ids[at:at + n].tobytes()))
                at += n
        kind = batch.schema.field("doc_ids").type.value_type
        return pa.RecordBatch.from_arrays([pa.array(out[0], kind), *(pa.array(x, pa.int64()) for x in out[1:])],
                                          ["doc_id", "start", "n_tokens", "ids_crc32"])
    return map_batches(blocks, run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    path = shared_path(docs.sparkSession, "token-files")
    write(docs, path, id_col=id_col, text_col=text_col, **how)
    return read(docs.sparkSession, path, docs.schema[id_col].dataType.simpleString())
