"""Language-model scores: a word unigram base and a causal self-attention model.

The attention model works on subword ids of a public byte-level BPE.  An id's
probability is that of its class given the text before it, times that of the
id among the ids of its class given the same; frequent ids are classes of their
own.  Both are learned: the ids of a class are the leaves of a tree whose
choices depend on what attention gives and on the id before, and start from the
counts of all neighbours in the training texts, across blanks and ends too.
Every id of every training text takes part in a gradient step of this output.
The class model is one causal self-attention layer
over the classes of up to CONTEXT ids before (with a learned weight per
distance) beside a class bigram table.  The bigram table
starts from the counts of all training texts, ends included, and every block
of every training text takes part in a gradient step, in numpy: texts are dealt
over ROUNDS rounds and, within a round, over shards that each go on from the
same tables and whose tables are averaged by blocks.  A text is cut into blocks
of STRIDE ids; each block attends to itself and the block before, so windows
overlap and every id is scored once, many blocks at a time in one masked batch.
"""

from __future__ import annotations

import base64
import copy
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import column_words, remainder_is, shared_path, ship, store

TOKENIZER = "byte_bpe_50k.tiktoken"
VOCABULARY, END = 50257, 50256
CLASSES, OWN, WIDTH = 64, 48, 16
#: Shares depend on the id before among the PAIR_IDS most frequent ids; PAIR_WEIGHT is the weight of the plain share.
PAIR_IDS, PAIR_WEIGHT = 1024, 5.0
STRIDE, CONTEXT = 16, 32
#: Least number of gradient steps and blocks of a step, which goes over them PART at a time.
STEPS, BATCH, PART = 500, 128, 128
#: Training texts of up to SHARD blocks are fitted on the driver, more in ROUNDS rounds of shards of about as many.
SHARD, ROUNDS = 1 << 16, 8
#: Blocks of a shard that the output over ids learns from, of one of its steps, its rate, and values in a row of its tables.
OUTPUT_SHARD, PART_BLOCKS, OUTPUT_RATE, OUTPUT_SLICE = 1 << 18, 256, 0.1, 1 << 16
#: Most frequent words whose counts every worker holds; the others are looked up by a join.
HOT_WORDS = 400_000
_FLUSH_WORDS = 300_000
_COUNT_TEXTS, _SLICE_BYTES = 1024, 4 << 20
_LONG_WORD = 256
#: A word with other white space may be joined to the word beside it.
_OTHER_SPACE = "[\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


@lru_cache(2)
def encoding(name: str = TOKENIZER) -> tiktoken.Encoding:
    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def subword_ids(words: list[bytes]) -> list[int]:
    """Ids of the words, a blank before each.  Very long words are encoded in
    pieces, as the encoder's time grows with the square of a word's length."""
    encode = encoding().encode_ordinary
    if not words:
        return []
    if max(map(len, words)) <= _LONG_WORD:
        return encode((b" " + b" ".join(words)).decode())
    out: list[int] = []
    for w in words:
        text = " " + w.decode()
        for at in range(0, len(text), _LONG_WORD):
            out += encode(text[at:at + _LONG_WORD])
    return out


@lru_cache(1)
def _id_lengths() -> np.ndarray:
    """Bytes of every id but the end."""
    return np.array([len(encoding().decode_single_token_bytes(i)) for i in range(VOCABULARY - 1)])


def not_on_their_own(words: pa.Array) -> np.ndarray:
    """Which words are to be encoded within their whole text: very long ones and those with other white space."""
    words = words.cast(pa.string())
    return pc.or_(pc.greater(pc.binary_length(words), _LONG_WORD), pc.match_substring_regex(words, _OTHER_SPACE)).to_numpy(zero_copy_only=False)


def word_ids(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, each with a blank before it, one word after another, and
    the number of each (the empty word: none).  The encoder splits before every
    blank, so most words go through it as one text; the bytes of the ids tell them apart."""
    alone, length = not_on_their_own(words), pc.binary_length(words).to_numpy()
    size, found = np.zeros(len(words), np.int64), []
    plain = np.flatnonzero(~alone & (length > 0))
    if len(plain):
        one = pa.ListArray.from_arrays([0, len(plain)], words.take(pa.array(plain)).cast(pa.string()))
        ids = np.array(encoding().encode_ordinary(" " + pc.binary_join(one, " ")[0].as_py()), np.int64)
        ends = np.searchsorted(np.cumsum(_id_lengths()[ids]), np.cumsum(length[plain] + 1)) + 1
        size[plain] = np.diff(ends, prepend=0)
        found.append(ids)
    for i in np.flatnonzero(alone).tolist():
        found.append(np.array(subword_ids([words[i].cast(pa.binary()).as_py()]), np.int64))
        size[i] = len(found[-1])
    first, at = np.zeros(len(words), np.int64), np.append(plain, np.flatnonzero(alone))
    first[at] = np.cumsum(size[at]) - size[at]
    return spread(np.concatenate([np.zeros(0, np.int64), *found]), first, size), size


def spread(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ``size`` ids from each ``first`` on, one after another."""
    ends = np.cumsum(size)
    return ids[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


# ---- counts -------------------------------------------------------------------------------------------------------

def word_counts(texts: DataFrame) -> DataFrame:
    """``(w, c)``: occurrences of every lower-cased word, and of the end of a
    text as the empty word.  Tasks add up before the shuffle, in bounded memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        ends = 0
        for batch in batches:
            ends += batch.num_rows
            for at in range(0, batch.num_rows, _COUNT_TEXTS):
                flat, _ = column_words(pc.ascii_lower(pc.fill_null(batch.column(0).slice(at, _COUNT_TEXTS), "")))
                found = flat.value_counts()
                held.append(pa.table({"w": found.field("values").cast(pa.binary()), "c": found.field("counts")}))
                if sum(t.num_rows for t in held) > 2 * _FLUSH_WORDS:
                    held = [_added(held)]
                    if held[0].num_rows > _FLUSH_WORDS:
                        yield from held.pop().to_batches()
        if ends:
            held.append(pa.table({"w": pa.array([b""], pa.binary()), "c": pa.array([ends], pa.int64())}))
            yield from _added(held).to_batches()

    ship(texts.sparkSession)
    return texts.select("text").mapInArrow(run, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c"))


def _added(counts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(counts).group_by("w", use_threads=False).aggregate([("c", "sum")]).rename_columns(["w", "c"])


def _hot(counts: DataFrame) -> DataFrame:
    """The words above the lowest count that at most HOT_WORDS words reach,
    found from the number of words per band of counts."""
    band = F.floor(F.log2("c") * 16)
    sizes = counts.groupBy(band.alias("band")).agg(F.count("*").alias("n")).orderBy(F.desc("band")).collect()
    least, total = None, 0
    for r in sizes:
        total += r["n"]
        if total > HOT_WORDS:
            break
        least = r["band"]
    return counts.where(F.lit(False) if least is None else band >= least)


def subword_counts(counts: DataFrame, slot: np.ndarray | None = None) -> np.ndarray:
    """Occurrences of every subword id in the counted texts or, given the slots
    of ids, of neighbours within a word as a table by slot (-1: none).  Both
    are bounded, by the vocabulary and by PAIR_IDS."""
    size = VOCABULARY if slot is None else PAIR_IDS ** 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            words, times = batch.column(0), batch.column(1).to_numpy()
            at, lens = word_ids(words)
            ends = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
            total[END if slot is None else 0] += times[ends].sum() if slot is None else 0
            times = np.repeat(times, lens)
            lens = lens[lens > 0]
            if slot is not None:
                inside = np.ones(len(at), bool)
                inside[np.cumsum(lens) - lens] = False  # the first id of a word has no neighbour there
                cur, prev = slot[at], slot[np.roll(at, 1)]
                inside &= (cur >= 0) & (prev >= 0)
                at, times = (prev * PAIR_IDS + cur)[inside], times[inside]
            np.add.at(total, at, times)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "c"])

    out = np.zeros(size, np.int64)
    found = counts.mapInArrow(run, "id long, c long").groupBy("id").agg(F.sum("c").alias("c")).toArrow()
    out[found["id"].to_numpy()] = found["c"].to_numpy()
    return out if slot is None else out.reshape(PAIR_IDS, PAIR_IDS)


# ---- the model ----------------------------------------------------------------------------------------------------

def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of every id and the log10 of its share of the class.  The OWN
    most frequent ids and the end are classes of their own; others are
    grouped by leading blank and length.  Unseen ids have a small share."""
    order = np.lexsort((np.arange(VOCABULARY), -counts))
    kind = np.zeros(VOCABULARY, np.int64)
    decode = encoding().decode_single_token_bytes
    for i in range(VOCABULARY - 1):
        token = decode(i)
        kind[i] = OWN + 1 + 7 * token.startswith(b" ") + min(7, len(token.strip()) or 1) - 1
    own = [i for i in order.tolist() if i != END][:OWN]
    kind[own] = np.arange(1, OWN + 1)
    kind[END] = 0
    share = counts + 0.5
    return kind, np.log10(share / np.bincount(kind, share, CLASSES)[kind])


def slots_of(counts: np.ndarray) -> np.ndarray:
    """Slot of each of the PAIR_IDS most frequent ids (ties: smaller id first), -1 for others."""
    slot = np.full(VOCABULARY, -1, np.int64)
    slot[np.lexsort((np.arange(VOCABULARY), -counts))[:PAIR_IDS]] = np.arange(PAIR_IDS)
    return slot


class Shares:
    """log10 of an id's share of its class given the id before it: the counts
    of the pair, plus PAIR_WEIGHT spread by the plain shares.  Ids without a
    slot have no pair counts, so the shares of a class always add up to 1."""

    def __init__(self, kind: np.ndarray, plain: np.ndarray, slot: np.ndarray, pairs: np.ndarray):
        self.kind, self.plain = kind, plain
        self.slot = np.where(slot < 0, PAIR_IDS, slot).astype(np.int32)
        ids = np.zeros(PAIR_IDS, np.int64)
        ids[slot[slot >= 0]] = np.flatnonzero(slot >= 0)
        in_class = np.zeros((PAIR_IDS, CLASSES))
        for c in range(CLASSES):
            in_class[:, c] = pairs[:, kind[ids] == c].sum(1)
        self.rest = np.zeros((PAIR_IDS + 1, CLASSES), np.float32)
        self.rest[:-1] = np.log10(PAIR_WEIGHT / (in_class + PAIR_WEIGHT))
        self.pair = np.zeros((PAIR_IDS + 1, PAIR_IDS + 1), np.float32)
        self.pair[:, :-1] = plain[ids]
        self.pair[:-1, :-1] = np.log10((pairs + PAIR_WEIGHT * 10 ** plain[ids]) / (in_class[:, kind[ids]] + PAIR_WEIGHT))

    def along(self, ids: np.ndarray) -> np.ndarray:
        """The share of every id but the first, after the one before it."""
        slots = self.slot.take(ids)
        before, now = slots[:-1], slots[1:]
        out = self.pair.reshape(-1).take(before * (PAIR_IDS + 1) + now)
        other = np.flatnonzero(now == PAIR_IDS)
        if len(other):
            rare = ids[1:][other]
            out[other] = self.plain[rare] + self.rest[before[other], self.kind[rare]]
        return out


def _tree(kind: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A Huffman tree over the ids of every class: the node above each id and
    each node, and which side of it they are on (1, -1), ids first and then
    nodes, which come after what is below them; -1 above a root.  The last
    result is the mass below each."""
    above, side, mass = [-1] * VOCABULARY, [0] * VOCABULARY, mass.tolist()
    for c in range(CLASSES):
        heap = [(mass[i], i) for i in np.flatnonzero(kind == c).tolist()]
        heapq.heapify(heap)
        while len(heap) > 1:
            (x, i), (y, j) = heapq.heappop(heap), heapq.heappop(heap)
            above[i] = above[j] = len(above) - VOCABULARY
            side[i], side[j] = 1, -1
            heapq.heappush(heap, (x + y, len(above)))
            above.append(-1)
            side.append(0)
            mass.append(x + y)
    return np.array(above), np.array(side), np.array(mass)


class Output:
    """Learned output over the ids of a class: an id's probability is the
    product of the two-way choices on its way down the class's tree.  A choice
    depends on what attention gives there (``node`` and ``bias`` per choice) and
    on the id before (``after``).  Untrained it gives :class:`Shares`: a choice
    starts from the log odds of the counts below its two sides, after the id before."""

    NAMES = ("node", "bias", "after")

    def __init__(self, kind: np.ndarray, plain: np.ndarray, slot: np.ndarray, pairs: np.ndarray):
        self.kind, self.slot = kind, np.where(slot < 0, PAIR_IDS, slot)
        above, side, mass = _tree(kind, 10.0 ** plain)
        # the way from each id up to its root
        found, at, ids = [], np.arange(VOCABULARY), np.arange(VOCABULARY)
        while len(ids := ids[(up := above[at]) >= 0]):
            at, up = at[up >= 0], up[up >= 0]
            found.append((ids, up, side[at]))
            at = up + VOCABULARY
        ids, nodes, sides = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in range(3))
        order = np.argsort(ids, kind="stable")
        self.nodes, self.sides = nodes[order].astype(np.int32), sides[order].astype(np.float32)
        self.size = np.bincount(ids, minlength=VOCABULARY)
        self.first = np.cumsum(self.size) - self.size
        # the log odds of the counts, and what the id before changes of them
        count = len(above) - VOCABULARY
        halves, sums, columns = np.zeros((2, count)), {}, [np.zeros(PAIR_IDS + 1, np.float32)]  # of nodes without
        for i, k in enumerate(slot.tolist()):
            if k >= 0 and pairs[:, k].any():
                sums[i] = pairs[:, k].astype(np.float64)
        self.near = np.zeros(count, np.int64)
        below: list[list[int]] = [[0, 0] for _ in range(count)]
        for i, (up, s) in enumerate(zip(above.tolist(), side.tolist())):
            if up >= 0:
                halves[(1 - s) // 2, up] = mass[i]
                below[up][(1 - s) // 2] = i
        self.plain = np.log(halves[0] / halves[1]).astype(np.float32)
        for x, (i, j) in enumerate(below):
            left, right = sums.pop(i, None), sums.pop(j, None)
            if left is not None or right is not None:
                left, right = (np.zeros(PAIR_IDS) if v is None else v for v in (left, right))
                odds = np.log((left + PAIR_WEIGHT * halves[0, x]) / (right + PAIR_WEIGHT * halves[1, x]))
                self.near[x] = len(columns)
                columns.append(np.append(odds - self.plain[x], 0).astype(np.float32))
                sums[x + VOCABULARY] = left + right
        self.changes = np.stack(columns, 1)
        self.t = {"node": np.zeros((count, WIDTH), np.float32), "bias": np.zeros(count, np.float32),
                  "after": np.zeros((VOCABULARY, WIDTH), np.float32)}

    def choices(self, before: np.ndarray, ids: np.ndarray, h: np.ndarray):
        """For the positions whose id is reached by choices, those with most
        choices first: their numbers, and the choices in levels from the id up:
        where the level of each choice begins and how many positions it has,
        then for every choice the position, its node, the side taken and the
        log odds; and what the odds come from."""
        n = self.size.take(ids)
        way = np.argsort((255 - n).astype(np.uint8), kind="stable")[:np.count_nonzero(n)]
        ids, before, n = ids.take(way), before.take(way), n.take(way)
        many = len(way) - np.cumsum(np.bincount(n, minlength=1))[:-1]
        starts = np.cumsum(many) - many
        where = np.arange(many.sum()) - np.repeat(starts, many)
        at = self.first.take(ids).take(where) + np.repeat(np.arange(len(many)), many)
        node, side = self.nodes.take(at), self.sides.take(at)
        given = h.take(way, 0) + self.t["after"].take(before, 0)
        rows = self.t["node"].take(node, 0)
        levels, each = list(zip(starts.tolist(), many.tolist())), np.empty_like(rows)
        for a, k in levels:
            np.multiply(given[:k], rows[a:a + k], out=each[a:a + k])
        odds = each @ _ONES[:WIDTH]
        odds += self.t["bias"].take(node)
        odds += self.plain.take(node)
        near = self.near.take(node)
        near += (self.slot.take(before) * self.changes.shape[1]).take(where)
        odds += self.changes.reshape(-1).take(near)
        return way, levels, where, node, side, odds, given, rows

    def log10(self, before: np.ndarray, ids: np.ndarray, h: np.ndarray) -> np.ndarray:
        """log10 probability of each id in its class, after the id before and what attention gives."""
        way, levels, _, _, side, odds, _, _ = self.choices(before, ids, h)
        odds *= side
        each = np.minimum(odds, 0) - np.log(1 + np.exp(-np.abs(odds)))
        out, total = np.zeros(len(ids)), np.zeros(len(way))
        for a, n in levels:
            total[:n] += each[a:a + n]
        out[way] = total / np.log(10)
        return out

    def gradients(self, before: np.ndarray, ids: np.ndarray, h: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Gradients of the summed log probability: per table the rows and their gradients."""
        way, levels, where, node, side, odds, given, rows = self.choices(before, ids, h)
        g = side / (1 + np.exp(np.clip(side * odds, -40, 40)))
        rows *= g[:, None]
        back = np.zeros_like(given)
        for a, n in levels:
            back[:n] += rows[a:a + n]
        order, first, after = _groups(before.take(way))
        back = np.add.reduceat(back.take(order, 0), first, 0)
        order, first, node = _groups(node)
        g = g.take(order)
        rows = given.take(where.take(order), 0)
        rows *= g[:, None]
        return {"node": (node, np.add.reduceat(rows, first, 0)), "bias": (node, np.add.reduceat(g, first, 0)), "after": (after, back)}


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (ids or nodes) in order: their order, where each begins, and the different ones."""
    order = np.argsort(keys.astype(np.uint16), kind="stable")  # both are below 2 ** 16
    keys = keys.take(order)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return order, first, keys.take(first)


class Adagrad:
    """Gradient steps that change the tables of an output."""

    def __init__(self, output: Output):
        self.output = output
        self.square = {k: np.ones_like(v) for k, v in output.t.items()}

    def learn(self, before: np.ndarray, ids: np.ndarray, h: np.ndarray) -> None:
        for k, (rows, g) in self.output.gradients(before, ids, h).items():
            square = self.square[k].take(rows, 0)
            square += g * g
            self.square[k][rows] = square
            g *= np.float32(OUTPUT_RATE)
            g /= np.sqrt(square, out=square)
            g += self.output.t[k].take(rows, 0)
            self.output.t[k][rows] = g


def fit_output(tokens: DataFrame, model: Model, output: Output, blocks: int) -> None:
    """Learn ``output`` from every id of every text in ``tokens`` (``h``,
    ``ids``): shards of about OUTPUT_SHARD blocks go over their texts once from
    the same tables, and the changes are averaged by blocks, a slice of the tables a row."""
    spark = tokens.sparkSession
    now = spark.sparkContext.broadcast((model.t, output))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, start = now.value
        fitted, learner = Model(tables), copy.copy(start)  # workers are used again
        learner.t = {k: v.copy() for k, v in start.t.items()}
        steps, done = Adagrad(learner), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                texts = [_stored_ids(b) for b in batch.column(0).slice(at, 64).to_pylist()]
                for into, goal, before, ids, _ in _parts(learner.kind, texts):
                    steps.learn(before, ids, fitted.hidden(into).reshape(-1, WIDTH)[goal.reshape(-1) >= 0])
                    done += len(into)
        if done:
            change = np.concatenate([(learner.t[k] - start.t[k]).reshape(-1) for k in Output.NAMES]).astype(np.float16)
            cut = range(0, len(change), OUTPUT_SLICE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(cut), pa.int64()), pa.array([TaskContext.get().partitionId()] * len(cut), pa.int64()),
                 pa.array([change[i:i + OUTPUT_SLICE].tobytes() for i in cut], pa.binary()), pa.array([done] * len(cut), pa.int64())],
                ["at", "shard", "change", "n"])

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # one slice at a time, as the rows are sorted
        for batch in batches:
            for at, change, n in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if at not in held:
                    yield from map(_slice, held.items())
                    held = {at: [0, 0.0]}
                held[at] = [held[at][0] + n, held[at][1] + n * np.frombuffer(change, np.float16).astype(np.float64)]
        yield from map(_slice, held.items())

    found = (tokens.select("h", "ids").repartition(max(1, -(-blocks // OUTPUT_SHARD)), "h").sortWithinPartitions("h", "ids")
             .select("ids").mapInArrow(run, "at long, shard long, change binary, n long")
             .repartition("at").sortWithinPartitions("at", "shard").mapInArrow(mean, "at long, change binary").toArrow())
    if found.num_rows:
        flat = np.concatenate([np.frombuffer(b, np.float32) for _, b in sorted(zip(*(c.to_pylist() for c in found.columns)))])
        for k, part in zip(Output.NAMES, np.split(flat, np.cumsum([output.t[k].size for k in Output.NAMES])[:-1])):
            output.t[k] = output.t[k] + part.reshape(output.t[k].shape)


def _slice(item: tuple[int, list]) -> pa.RecordBatch:
    at, (n, total) = item
    return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())],
                                      ["at", "change"])


def _parts(kind: np.ndarray, texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """The blocks of texts (ids with their end), PART_BLOCKS at a time: inputs,
    goals, the id before each id, the ids, and the text each id is of."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.concatenate(([END], *texts))
    classes, ends = kind.take(flat[1:]), np.cumsum(lens)
    blocks = [_blocks(classes[a:b]) for a, b in zip((ends - lens).tolist(), ends.tolist())]
    into, goal = (np.concatenate([b[k] for b in blocks]) for k in (0, 1))
    owner, done = np.repeat(np.arange(len(texts)), lens), 0
    for at in range(0, len(into), PART_BLOCKS):
        part = goal[at:at + PART_BLOCKS]
        n = int((part >= 0).sum())
        yield into[at:at + PART_BLOCKS], part, flat[done:done + n], flat[done + 1:done + n + 1], owner[done:done + n]
        done += n


def _blocks(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of a text (with its end) -> inputs ``(B, CONTEXT)`` and targets
    ``(B, STRIDE)``; -1 where there is nothing."""
    n = len(classes)
    count = -(-n // STRIDE)
    into = np.full((count + 1) * STRIDE, -1, np.int64)
    into[STRIDE] = 0  # a text begins after an end
    into[STRIDE + 1:STRIDE + n] = classes[:-1]
    goal = np.full(count * STRIDE, -1, np.int64)
    goal[:n] = classes
    rows = into.reshape(-1, STRIDE)
    return np.concatenate((rows[:-1], rows[1:]), 1), goal.reshape(-1, STRIDE)


_QUERY = np.arange(CONTEXT - STRIDE, CONTEXT)
_DISTANCE = _QUERY[:, None] - np.arange(CONTEXT)[None, :]
_CAUSAL = np.where(_DISTANCE >= 0, 0, -1e9).astype(np.float32)
_FAR = np.maximum(_DISTANCE, 0)
_ONES = np.ones(CLASSES, np.float32)


def _keep_finite(scores: np.ndarray) -> None:
    """Move rows of scores where exp() might leave the range of the type; shares of a row stay the same."""
    if len(scores) and (scores.max() > 60 or scores.min() < -60):
        scores -= scores.max(1, keepdims=True)


class Model:
    """Tables: query, key, value, own (class -> vector), out (vector -> class
    scores), pair (class bigram scores), far (score per distance)."""

    NAMES = ("query", "key", "value", "own", "out", "pair", "far")

    def __init__(self, tables: dict[str, np.ndarray]):
        self.t = {k: np.ascontiguousarray(v, np.float32) for k, v in tables.items()}

    @classmethod
    def start(cls, seed: int = 5) -> Model:
        rng = np.random.Generator(np.random.PCG64(seed))
        tables = {k: rng.normal(0, 0.3, (CLASSES, WIDTH)) for k in cls.NAMES[:4]}
        return cls(tables | {"out": rng.normal(0, 0.1, (WIDTH, CLASSES)), "pair": np.zeros((CLASSES, CLASSES)),
                             "far": np.zeros(CONTEXT)})

    def attend(self, into: np.ndarray):
        """What attention gives at each position (``given``), and what it comes
        from: a weight is a product of one factor per pair of classes (``pair``
        says which) and one per distance, from tables; the last column of
        ``value`` adds up the weights."""
        t, safe = self.t, np.maximum(into, 0)
        asked = safe[:, CONTEXT - STRIDE:]
        pair = (asked * CLASSES)[:, :, None] + safe[:, None, :]
        weight = np.take(np.exp(np.minimum(np.maximum(t["query"] @ t["key"].T, -40), 40)), pair, mode="clip")
        weight *= np.exp(t["far"].take(_FAR) + _CAUSAL)
        weight[into[:, 0] < 0, :, :CONTEXT - STRIDE] = 0  # nothing is before a text's first block
        value = np.concatenate((t["value"], _ONES[:, None]), 1).take(safe, 0)
        given = weight @ value
        total = given[..., WIDTH:]
        return asked.reshape(-1), safe, pair, weight, value, total, given[..., :WIDTH] / total

    def small(self, h: np.ndarray) -> bool:
        """Whether no score of a class can be far from 0, by the largest numbers in ``h`` and the tables."""
        most = max(h.max(initial=0), -h.min(initial=0))
        return most * np.abs(self.t["out"]).sum(0).max() + np.abs(self.t["pair"]).max() < 60

    def hidden(self, into: np.ndarray) -> np.ndarray:
        """What attention gives at each position, with what the class there adds."""
        asked, *_, given = self.attend(into)
        given += self.t["own"].take(asked, 0).reshape(given.shape)
        return given

    def log10(self, into: np.ndarray, goal: np.ndarray, h: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of each goal class, 0 where there is none."""
        h = self.hidden(into) if h is None else h
        scores = h.reshape(-1, WIDTH) @ self.t["out"]
        scores += self.t["pair"].take(np.maximum(into[:, CONTEXT - STRIDE:], 0).reshape(-1), 0)
        if not self.small(h):
            _keep_finite(scores)
        goal = goal.reshape(-1)
        picked = scores.reshape(-1).take(np.arange(len(goal)) * CLASSES + np.maximum(goal, 0))
        np.exp(scores, out=scores)
        out = (picked - np.log(scores @ _ONES)) / np.float32(np.log(10))
        return np.where(goal >= 0, out, 0)

    def gradients(self, into: np.ndarray, goal: np.ndarray, with_loss: bool = True) -> tuple[float, dict[str, np.ndarray]]:
        t = self.t
        asked, safe, pair, weight, value, total, given = self.attend(into)
        order, first, classes = _groups(asked)  # positions in the order of their classes
        asked = asked.take(order)
        given = given.reshape(-1, WIDTH).take(order, 0)
        h = given + t["own"].take(asked, 0)
        p = h @ t["out"]
        p += t["pair"].take(asked, 0)
        if not self.small(h):
            _keep_finite(p)
        np.exp(p, out=p)
        norm = p @ _ONES
        goal = goal.reshape(-1).take(order)
        rows = np.flatnonzero(goal >= 0)
        wanted, n = rows * CLASSES + goal.take(rows), max(1, len(rows))
        loss = -float(np.log(p.reshape(-1).take(wanted) / norm.take(rows) + 1e-30).mean()) if with_loss else 0.0
        p *= ((goal >= 0) / (n * norm)).astype(np.float32)[:, None]
        p.reshape(-1)[wanted] -= np.float32(1 / n)
        back = p @ t["out"].T
        by = np.zeros((CLASSES, CLASSES), np.float32)
        by[classes] = np.add.reduceat(p, first, 0)
        # of a weight: by what it is multiplied with, and by the sum it is divided by
        back /= total.reshape(-1, 1).take(order, 0)
        each = np.concatenate((back, -np.einsum("ij,ij->i", back, given)[:, None]), 1)
        at = np.empty_like(order)
        at[order] = np.arange(len(order))
        each = each.take(at, 0).reshape(*weight.shape[:2], WIDTH + 1)
        score = each @ value.transpose(0, 2, 1)
        score *= weight
        far = np.bincount(_FAR.reshape(-1), score.sum(0).reshape(-1), CONTEXT)
        score = np.bincount(pair.reshape(-1), score.reshape(-1), CLASSES ** 2).astype(np.float32).reshape(CLASSES, CLASSES)
        seen, first, classes = _groups(safe.reshape(-1))
        weight = (weight.transpose(0, 2, 1) @ each[..., :WIDTH]).reshape(-1, WIDTH).take(seen, 0)
        value = np.zeros((CLASSES, WIDTH), np.float32)
        value[classes] = np.add.reduceat(weight, first, 0)
        return loss, {"out": (p.T @ h).T, "pair": by, "own": by @ t["out"].T, "value": value,
                      "query": score @ t["key"], "key": score.T @ t["query"], "far": far}


def bigram_scores(pairs: np.ndarray) -> np.ndarray:
    """Log share of each class after the class before it, smoothed by the plain shares."""
    pairs = pairs + 0.5 + pairs.sum(0) / max(1, pairs.sum())
    return np.log(pairs / pairs.sum(1, keepdims=True)).astype(np.float32)


def class_pairs(classes: np.ndarray) -> np.ndarray:
    """Neighbours in a text's classes (with its end), which begins after an end."""
    return np.bincount(np.append(0, classes[:-1]) * CLASSES + classes, minlength=CLASSES ** 2)


class Adam:
    """Gradient steps that change the tables of a model."""

    def __init__(self, model: Model):
        self.model, self.step = model, 0
        self.cuts = np.cumsum([0, *(model.t[k].size for k in Model.NAMES)]).tolist()
        self.mean, self.square = np.zeros((2, self.cuts[-1]))  # float64: tiny float32 numbers are slow

    def learn(self, into: np.ndarray, goal: np.ndarray, rate: float) -> None:
        g, total = np.zeros_like(self.mean), max(1, int((goal >= 0).sum()))
        for at in range(0, len(into), PART):
            part = goal[at:at + PART]
            grads = self.model.gradients(into[at:at + PART], part, False)[1]
            g += (part >= 0).sum() / total * np.concatenate([grads[k].reshape(-1) for k in Model.NAMES], dtype=np.float64)
        self.step += 1
        self.mean += 0.1 * (g - self.mean)
        self.square += 0.01 * (g * g - self.square)
        change = (rate / (1 - 0.9 ** self.step) * self.mean / (np.sqrt(self.square / (1 - 0.99 ** self.step)) + 1e-8)).astype(np.float32)
        for k, a, b in zip(Model.NAMES, self.cuts, self.cuts[1:]):
            self.model.t[k] -= change[a:b].reshape(self.model.t[k].shape)


def fit(texts: list[np.ndarray], steps: int | None = None, seed: int = 5) -> Model:
    """Adam over batches of blocks in random order, each block as often as any
    other; without ``steps`` at least STEPS and so many that every block is in
    one.  The bigram table starts from the counts of the texts."""
    model = Model.start(seed)
    if not texts:
        return model
    parts = [_blocks(c) for c in texts]
    into, goal = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    model.t["pair"] = bigram_scores(sum(map(class_pairs, texts)).reshape(CLASSES, CLASSES))
    rng = np.random.Generator(np.random.PCG64(seed + 1))
    adam, steps = Adam(model), max(STEPS, -(-len(into) // BATCH)) if steps is None else steps
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        while len(order) < BATCH:
            order = np.append(order, rng.permutation(len(into)))
        rows, order = order[:BATCH], order[BATCH:]
        adam.learn(into[rows], goal[rows], 0.01 * (1 - step / (steps + 1)))
    return model


def text_counts(tokens: DataFrame, kind: np.ndarray, slot: np.ndarray | None = None) -> tuple[np.ndarray, int, np.ndarray]:
    """Class pairs of all texts (``ids`` as stored by :func:`score`), ends
    included, their number of blocks, and the neighbours among the ids with a
    slot, across blanks and ends too, as a table by slot (empty without slots)."""
    first, size = CLASSES ** 2 + 1, 0 if slot is None else PAIR_IDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(first + size ** 2, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                texts = [_stored_ids(blob) for blob in batch.column(0).slice(at, 64).to_pylist()]
                total[first - 1] += sum(-(-len(ids) // STRIDE) for ids in texts)
                ids = np.concatenate(([END], *texts))  # a text begins after an end
                classes = kind.take(ids)
                total[:first - 1] += np.bincount(classes[:-1] * CLASSES + classes[1:], minlength=CLASSES ** 2)
                if size:
                    slots = slot.take(ids)
                    both = (slots[:-1] >= 0) & (slots[1:] >= 0)
                    np.add.at(total, first + slots[:-1][both] * PAIR_IDS + slots[1:][both], 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["at", "c"])

    out = np.zeros(first + size ** 2, np.int64)
    found = tokens.select("ids").mapInArrow(run, "at long, c long").groupBy("at").agg(F.sum("c").alias("c")).toArrow()
    out[found["at"].to_numpy()] = found["c"].to_numpy()
    return out[:first - 1].reshape(CLASSES, CLASSES), int(out[first - 1]), out[first:].reshape(size, size)


def _stored_ids(blob: bytes) -> np.ndarray:
    """The ids of a stored text and its end."""
    return np.append(np.frombuffer(blob, np.uint16), END)


def fit_all(tokens: DataFrame, kind: np.ndarray, pairs: np.ndarray, blocks: int, seed: int = 5) -> Model:
    """The model of all texts in ``tokens`` (``h``, ``ids``), from their class
    pairs and number of blocks.  Every block is in at least one gradient step."""
    if blocks <= SHARD:
        return fit([kind[_stored_ids(r["ids"])] for r in tokens.select("h", "ids").orderBy("h").collect()], seed=seed)
    spark = tokens.sparkSession
    model = Model.start(seed)
    model.t["pair"] = bigram_scores(pairs)
    sizes = [model.t[k].size for k in Model.NAMES]
    shapes = [model.t[k].shape for k in Model.NAMES]

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [kind[_stored_ids(b)].astype(np.uint8).tobytes() for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["h", "classes"])

    path = shared_path(spark, "lm-classes")
    (tokens.select("h", "ids").mapInArrow(classes, "h long, classes binary")
     .withColumn("round", F.pmod(F.xxhash64(F.lit(2), "h"), F.lit(ROUNDS)).cast("int")).write.partitionBy("round").parquet(path))
    texts = spark.read.schema("h long, classes binary, round int").parquet(path)
    for k in range(ROUNDS):
        now, rate = spark.sparkContext.broadcast(model.t), 0.01 * (1 - k / ROUNDS)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            adam = Adam(Model({name: x.copy() for name, x in now.value.items()}))  # workers are used again
            rng = np.random.Generator(np.random.PCG64(seed + 1))
            held, have, done = [], 0, 0

            def learn(last: bool) -> int:
                """Steps over the blocks held, in random order; what does not fill a step waits unless it is the last."""
                nonlocal held, have
                into, goal = (np.concatenate([h[i] for h in held]) for i in (0, 1))
                order = rng.permutation(len(into))
                end = len(order) if last else len(order) // BATCH * BATCH
                for at in range(0, end, BATCH):
                    rows = order[at:min(at + BATCH, end)]
                    adam.learn(into[rows], goal[rows], rate)
                held, have = [(into[order[end:]], goal[order[end:]])], len(order) - end
                return end

            for batch in batches:
                for blob in batch.column(0).to_pylist():
                    held.append(_blocks(np.frombuffer(blob, np.uint8).astype(np.int64)))
                    have += len(held[-1][0])
                    if have >= 64 * BATCH:
                        done += learn(False)
            if have:
                done += learn(True)
            if done:
                flat = np.concatenate([adam.model.t[k].reshape(-1) for k in Model.NAMES])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat))), pa.array(np.rint(flat * 2.0 ** 32).astype(np.int64)),
                     pa.array(np.full(len(flat), done))], ["at", "v", "n"])

        # whole numbers: the sums do not depend on the order of the shards
        found = (texts.where(F.col("round") == k).repartition(-(-blocks // (ROUNDS * SHARD)), "h").sortWithinPartitions("h")
                 .select("classes").mapInArrow(run, "at long, v long, n long").groupBy("at")
                 .agg(F.sum(F.col("v").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")).cast("double").alias("v"),
                      F.sum("n").alias("n")).toArrow())
        if found.num_rows:
            flat = np.zeros(sum(sizes))
            flat[found["at"].to_numpy()] = found["v"].to_numpy() / found["n"].to_numpy() / 2.0 ** 32
            cut = np.split(flat, np.cumsum(sizes)[:-1])
            model = Model({name: x.reshape(shape) for name, x, shape in zip(Model.NAMES, cut, shapes)})
    return model


def score_texts(model: Model, output: Output, texts: list[np.ndarray]) -> list[float]:
    """log10 probability of each text (its ids, the last one the end)."""
    total = np.zeros(len(texts))
    for into, goal, before, ids, owner in _parts(output.kind, texts):
        h, used = model.hidden(into), goal.reshape(-1) >= 0
        each = model.log10(into, goal, h)[used] + output.log10(before, ids, h.reshape(-1, WIDTH)[used])
        total += np.bincount(owner, each, len(texts))
    return total.tolist()


class Hot:
    """The most frequent words, their log10 probabilities and their ids, in Arrow
    and numpy: as Python objects they would take ten times the memory."""

    def __init__(self, words: pa.Array, value: np.ndarray):
        self.words, self.value = words.cast(pa.binary()), value
        ids, self.size = word_ids(self.words)
        self.ids, self.first = ids.astype(np.uint16), np.cumsum(self.size) - self.size

    def facts(self, texts: pa.Array):
        """Of every text: tokens, those that are hot, the sum of their log10
        probabilities, its ids as bytes, and its other words and how often they occur."""
        flat, edges = column_words(pc.ascii_lower(pc.fill_null(texts, "")))
        coded, count = flat.dictionary_encode(), len(texts)
        # the end of a text is the empty word
        distinct = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([b""], pa.binary())])
        lens = np.diff(edges)
        owner = np.repeat(np.arange(count), lens + 1)
        at = np.insert(coded.indices.to_numpy().astype(np.int64), edges[1:], len(distinct) - 1)
        found = pc.fill_null(pc.index_in(distinct, value_set=self.words), -1).to_numpy().astype(np.int64)
        hot = found >= 0
        value = np.append(self.value, 0.0)[found]
        inside = hot[at]
        known = np.bincount(owner[inside], minlength=count)
        base = np.bincount(owner, value[at], count)
        keys, times = np.unique(owner[~inside] * len(distinct) + at[~inside], return_counts=True)
        cuts = pa.array(np.searchsorted(keys, np.arange(count + 1) * len(distinct)), pa.int32())
        rare = pa.ListArray.from_arrays(cuts, distinct.take(pa.array(keys % len(distinct))))
        times = pa.ListArray.from_arrays(cuts, pa.array(times, pa.int64()))
        # ids: of hot words, then of the others
        cold = np.flatnonzero(~hot)
        other, cold_size = word_ids(distinct.take(pa.array(cold)))
        size, first = np.append(self.size, 0)[found], np.append(self.first, 0)[found]
        size[cold], first[cold] = cold_size, np.cumsum(cold_size) - cold_size + len(self.ids)
        ids = spread(np.concatenate((self.ids, other.astype(np.uint16))), first[at], size[at])
        ends = np.append(0, np.cumsum(np.bincount(owner, size[at], count).astype(np.int64))).tolist()
        blobs = [ids[a:b].tobytes() for a, b in zip(ends, ends[1:])]
        for i in np.unique(owner[not_on_their_own(distinct)[at]]).tolist():
            blobs[i] = np.array(subword_ids(words_of((texts[i].as_py() or "").encode())), np.uint16).tobytes()
        return lens + 1, known, base, blobs, rare, times


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Up to _COUNT_TEXTS rows at a time, fewer where the texts (second column) are long."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    at = done = 0
    while at < batch.num_rows:
        end = min(max(at + 1, int(np.searchsorted(ends, done + _SLICE_BYTES, "right"))), at + _COUNT_TEXTS)
        yield batch.slice(at, end - at)
        at, done = end, int(ends[end - 1])


# ---- the operator -------------------------------------------------------------------------------------------------

def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score)`` per input row, learning from the rows that are not held out.

    A null or wordless text is one end token.  Repeated rows each count and
    get a row; a null id is not held out; other columns are ignored.  Without
    training rows every base probability is 1 and the attention model is the
    untrained one.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    held = remainder_is(F.col(id_col), 5, 1) if held_out is None else held_out
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out"))
    train = rows.where(~F.col("held_out"))
    counts = store(word_counts(train), "lm-words")
    seen, vocabulary = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    whole = seen + 0.5 * (vocabulary + 1)
    top = _hot(counts).toArrow().combine_chunks()
    hot = Hot(top["w"].combine_chunks() if top.num_rows else pa.array([], pa.binary()), np.log10((top["c"].to_numpy() + 0.5) / whole))
    plain = subword_counts(counts)
    kind, share = classes_of(plain)
    slot = slots_of(plain)
    # bounded: HOT_WORDS words, below the subword vocabulary, the pairs of PAIR_IDS ids and the model
    often = spark.sparkContext.broadcast(hot)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, row = often.value, TaskContext.get().partitionId() << 33
        for whole_batch in batches:
            for batch in _slices(whole_batch):
                count = batch.num_rows
                n, known, base, ids, rare, times = hot.facts(batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + count)), batch.column(0), batch.column(2), batch.column(3), pa.array(n),
                     pa.array(known), pa.array(base), pa.array(ids, pa.binary()), rare, times],
                    ["row", "doc_id", "held_out", "h", "n_tokens", "known", "base", "ids", "rare", "times"])
                row += count

    kind_of = rows.schema["doc_id"].dataType.simpleString()
    facts = f"row long, doc_id {kind_of}, held_out boolean, h long, n_tokens long, known long, base double"
    hashed = rows.withColumn("h", F.xxhash64(F.lit(1), "doc_id", F.xxhash64("text")))
    tokens = store(hashed.mapInArrow(tokenise, f"{facts}, ids binary, rare array<binary>, times array<long>"), "lm-tokens")
    learned = tokens.where(~F.col("held_out"))
    pairs, blocks, follow = text_counts(learned, kind, slot)
    model = fit_all(learned, kind, pairs, blocks)
    output = Output(kind, share, slot, follow)
    fit_output(learned, model, output, blocks)
    shared = spark.sparkContext.broadcast((output, model.t))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        output, tables = shared.value
        model = Model(tables)
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 64):
                batch = whole_batch.slice(at, 64)
                scores = score_texts(model, output, [_stored_ids(b) for b in batch.column(7).to_pylist()])
                yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(scores, pa.float64())],
                                                 [*batch.schema.names[:7], "score"])

    scored = tokens.drop("rare", "times").mapInArrow(run, f"{facts}, score double")
    rare = (tokens.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x"))
            .select("row", F.col("x.rare").alias("w"), F.col("x.times").alias("k"))
            .join(counts, "w", "left")
            .groupBy("row").agg(
                F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("more"),
                F.sum(F.col("k") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / whole)).alias("added")))
    return (scored.join(rare, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                    F.lit(seen).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("added", F.lit(0.0))).alias("base_score"), "score"))
