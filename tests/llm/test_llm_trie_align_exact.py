"""Prefix trie, tokenizer alignment and exact dedup against brute force."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditlens.llm import exact_dedup, prefix_trie, token_align
from llm_fixtures import messy, messy_rows, nothing, prose  # noqa: F401

# ---- 11 prefix trie -----------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, path string, chars int, n int, sid int"


def brute_trie(rows, every=100, openings=6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
        own[c].append((turn is not None, turn or 0, name, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % openings if c is not None else 0
        base = own.get(c - int(c - every * int(c / every)), []) if c is not None else []
        convs[c] = tuple(base[:h] + turns[h:])
    members = defaultdict(list)
    for c, p in convs.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    low = lambda p: min((c for c in members[p] if c is not None), default=None)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if c is not None and convs[c] == p))
        out.append((low(p), len(p), low(p[:-1]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def trie_rows(seed, n):
    rng = random.Random(seed)
    say = ["", "yes", "nö 😀", None, "w" * 40, "a b"]
    rows = []
    for c in [None, *rng.sample(range(-150, 900), n)]:
        for k in range(rng.choice((1, 1, 2, 3, 5, 9, 30))):
            # few texts at first, so that paths share openings and some conversations are equal
            rows.append((c, rng.choice((None, k, k, 3)), rng.choice(("user", "user", None)), rng.choice(say[:2 + min(k, 4)])))
    rows += [(1000 + i, k, "user", "hot") for i in range(300) for k in range(4)]
    rows += [(5000, 0, "user", "x" * 100_000)]
    return rows


@pytest.mark.parametrize("shard", [1, 7, 60, 10**6])
def test_trie(spark, monkeypatch, shard):
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 5)
    rows = trie_rows(shard, 120)
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], TURNS)
    got = prefix_trie.prefix_trie(df, shard_turns=shard)
    assert got.columns == list(prefix_trie.COLUMNS)
    assert Counter(map(tuple, got.collect())) == brute_trie(rows)


def test_trie_skeleton_is_used_and_small(spark):
    rows = trie_rows(3, 200)
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], TURNS)
    convs = prefix_trie.shared_openings(prefix_trie.conversations(prefix_trie.named_turns(df)))
    paths = prefix_trie.distinct_paths(convs).cache()
    cuts = prefix_trie.splitters(paths, 20, paths.count())
    assert cuts == sorted(set(cuts)) and 5 <= len(cuts) < 20
    skeleton = prefix_trie.Skeleton(cuts)
    found = prefix_trie._shard_nodes(paths, skeleton).where("sid >= 0").groupBy("sid").count().collect()
    # every skeleton node is a node of the trie, and some are met in several shards
    assert {r["sid"] for r in found} == set(range(len(skeleton.parents))) and max(r["count"] for r in found) > 5


def test_trie_turnless_and_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    # crc32("104") % 6 = 4: its own two turns are dropped and conversation 100 is absent
    assert zlib.crc32(b"104") % 6 >= 2
    rows = [(104, 0, "user", "a"), (104, 1, "user", "b")]
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], TURNS)
    [root] = prefix_trie.prefix_trie(df).collect()
    assert tuple(root) == (104, 0, None, 1, 0, 1, 0, hashlib.sha256(b"104").hexdigest())


# ---- 12 tokenizer alignment ---------------------------------------------------------------------------------------

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
SYMBOLS = token_align.byte_of_symbol()
ODD = ["x▁y", "tab\there\n\n  two  spaces \n x ", " lead", "trail ", "\nline", "a,b;c!? d.'s don't ... a .b", "漢字 かな　全角",
       "👩‍👩‍👧 é é  x   y", "<|endoftext|> <s> </s> <unk> <0x41> <0x0A>", "\x00\x01 \x1c \x85   z", "a\r\nb",
       " ", "  ", "\n", ",", "x", "ALİ. YENİ, ev", "\U0010ffff ￿", "x,\ny.\n\nz", "12,345.67 4x4, a1,b", "w\x0b\x0c q",
       " a ᠎ b ​ c ﻿ d"]


def brute_tokens(text):
    """Whole-text tokens with their bytes, or none."""
    if not text:
        return [], []
    a = [(i, bytes(SYMBOLS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode())
         for i in B.encode(text) for p in [B.id_to_piece(i)]]
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def brute_align(texts):
    docs, counts = [], Counter()
    for text in texts:
        a, b = brute_tokens(text)
        spans = []
        for side in (a, b):
            at, ends = 0, []
            for _, data in side:
                ends.append((at, at + len(data)))
                at += len(data)
            spans.append(ends)
        first = 0
        links = []
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][first][1] <= s:
                first += 1
            j = first
            while j < len(b) and spans[1][j][0] < e:
                links.append((a[i][0], b[j][0]))
                j += 1
        counts.update(links)
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = [([x for (x, _), (_, e) in zip(a, spans[0]) if lo < e <= hi], [x for (x, _), (_, e) in zip(b, spans[1]) if lo < e <= hi])
                  for lo, hi in zip([0, *cuts], cuts)] if len(a) < 3000 else None
        docs.append((len(a), len(b), len(cuts), links, groups))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(n_a, n_b, n_groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
             None if groups is None else ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups))
            for n_a, n_b, n_groups, links, groups in docs]


@pytest.mark.parametrize("max_pairs, cache, size", [(10**9, 100_000, 1 << 20), (0, 100_000, 1 << 20), (10**9, 40, 3000)])
def test_alignment(spark, messy_rows, monkeypatch, max_pairs, cache, size):
    monkeypatch.setattr(token_align, "CACHE_WORDS", cache)
    monkeypatch.setattr(token_align, "SLICE", size)
    texts = [(r[0], r[1]) for r in messy_rows] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(7, "ü" * 3000 + " é,x")]
    df = spark.createDataFrame([(i, t, None, 1, 2, 3) for i, t in texts], "doc_id long, text string, groups string, n_a int, code int, row int")
    # no reuse of a worker that holds other limits
    token_align._LOADED.clear()
    got = token_align.align(df.repartition(3), max_pairs=max_pairs)
    out = got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()
    want = [(i, *w) for (i, _), w in zip(texts, brute_align([t for _, t in texts]))]
    assert Counter(tuple(r)[:7] for r in out) == Counter(w[:7] for w in want)
    known = {w for w in want if w[7] is not None}
    assert known <= {tuple(r) for r in out}
    assert [w[1:] for w in want if w[0] == 1000] == [(0, 0, 0, 0, 0, 0, "")]  # holds U+2581


def test_words_align_like_whole_texts():
    tool = token_align.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    assert tool.cuts
    writer = token_align.Writer(len(tool.a_bytes), tool.size_b)
    rng = random.Random(5)
    bits = [" ", "  ", "\n", "\n ", ",", ".", "a", "Tree", "é", "漢", "1", "'s", "\t", " ", "👍", "-", "x.y", "　", "the", "\x1f"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        a, b = brute_tokens(text)
        [keys] = tool.keys((" " + text).encode())
        tool.learn(keys)
        codes, sides = token_align.text_links(keys, tool)
        groups = writer.groups(np.frombuffer(codes, tool.kind), np.frombuffer(sides, np.uint8)).decode()
        flat = [g.split("|") for g in groups.split(";")] if groups else []
        ids = [[int(i) for g in flat for i in g[k].split(",")] for k in (0, 1)]
        assert ids == [[i for i, _ in a], [i for i, _ in b]], repr(text)


def test_coarse_cuts_and_refined_ends():
    ends = lambda spans, sizes: token_align.byte_ends(*np.array(spans).T, np.array(sizes)).tolist()
    # a character of three bytes over two A tokens; byte fallback has empty spans
    assert ends([(0, 1), (1, 4), (1, 4), (4, 5)], [1, 2, 1, 1]) == [1, 3, 4, 5]
    assert ends([(0, 0), (1, 1), (1, 1), (1, 4)], [1, 1, 1, 1]) == [1, 2, 3, 4]
    tool = token_align.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    # the first part stands for itself, the last after a letter; U+2581 is refused alone
    parts = [" 漢字".encode(), b" Tree", " x▁y".encode(), b"\nb", b",!"]
    together, alone = tool._align(parts), [tool._align([p])[0] for p in parts]
    assert together == alone and [x is None for x in alone] == [False, False, True, False, False]


def test_alignment_of_nothing(nothing):
    out = token_align.align(nothing)
    assert out.count() == 0 and out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]


# ---- 13 exact dedup -----------------------------------------------------------------------------------------------

def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for k, i in enumerate(sorted(ids, key=lambda i: (i is not None, i))):
            out[i, keep, len(ids), k == len(ids) - 1] += 1
    return out


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.substring(exact_dedup.sha256(t), 1, 1),
                                    lambda t: F.lit(b"same").cast("binary")])
@pytest.mark.parametrize("hot_rows", [0, 5, 1024])
def test_exact(spark, messy_rows, digest, hot_rows):
    rows = [(r[0], r[1]) for r in messy_rows] + [(2000 + i % 90, "copy") for i in range(120)] + [(None, None)] * 3 + [(None, "n")] * 2
    rows += [(3000 + i, "near copy %d" % (i % 40)) for i in range(80)]
    df = spark.createDataFrame([(i, t, "d", 1, 2, 3) for i, t in rows],
                               "doc_id long, text string, digest string, row int, salt int, keep_id int").repartition(6)
    got = exact_dedup.find_duplicates(df, digest=digest, hot_rows=hot_rows)
    out = got.select("doc_id", "keep_id", "group_size", "kept").collect()
    assert Counter(map(tuple, out)) == brute_exact(rows)


def test_exact_compares_texts_whole(spark):
    long = "x" * 400_000
    rows = [(1, long + "a"), (2, long + "b"), (3, long + "a"), (4, "X"), (5, "x"), (6, "x "), (7, "é"), (8, "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.find_duplicates(df).collect()}
    assert kept == {1: (3, False), 3: (3, True), **{i: (i, True) for i in (2, 4, 5, 6, 7, 8)}}


def test_exact_keeps_rows(messy, messy_rows, nothing):
    assert exact_dedup.find_duplicates(nothing).count() == 0 and exact_dedup.keep_one(nothing).columns == nothing.columns
    out = exact_dedup.keep_one(messy)
    assert out.columns == messy.columns
    best = {}
    for r in messy_rows:
        t = r[1] or ""
        if t not in best or best[t] is None or (r[0] is not None and r[0] > best[t]):
            best[t] = r[0]
    assert Counter((r.doc_id, r.text or "") for r in out.collect()) == Counter((i, t) for t, i in best.items())


def test_slices_and_small_caches_change_nothing(messy_rows, monkeypatch):
    texts = [r[1] for r in messy_rows if r[1]] + [t for t in ODD if t]
    whole = token_align.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    want = [token_align.text_links(t.encode(), whole) for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    every = lambda tool: [token_align.text_links(w, tool) for _, words in token_align._batches([batch], tool) for w in words]
    assert every(whole) == want
    writer = token_align.Writer(len(whole.a_bytes), whole.size_b)
    arrays = [(np.frombuffer(c, whole.kind), np.frombuffer(s, np.uint8)) for c, s in want]
    written = [writer.groups(*x) for x in arrays]
    monkeypatch.setattr(token_align, "CACHE_WORDS", 30)
    monkeypatch.setattr(token_align, "SLICE", 200)
    monkeypatch.setattr(token_align, "LINKS", 7)
    small = token_align.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    assert sum(len(list(small.keys((" " + t).encode()))) for t in texts) > 2 * len(texts)
    assert [token_align.text_links(t.encode(), small) for t in texts] == want and every(small) == want
    assert [writer.groups(*x) for x in arrays] == [b";".join(writer.groups(c, s) for c, s in token_align._parts(*x)) for x in arrays] == written
    assert len(small.words.young) <= 30 + max(len(t.split()) for t in texts)
