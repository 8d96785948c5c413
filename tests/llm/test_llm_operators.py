"""Each operator against a brute-force version on rows with nulls, empty and
long texts, ties, repeated rows and clashing column names, and on no rows."""
import gc
import hashlib
import math
import re
import tracemalloc
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditlens.llm import (chat, common, decontaminate, html_text, language, lm, mixing, quality, simhash, substring_dedup,
                            subwords, token_files)
from creditlens.llm.graph import connected_components
from llm_fixtures import messy, messy_rows, nothing  # noqa: F401
from creditlens.llm.subwords import WordIds, lowered_words

words = lambda t: (t or "").encode().split()
remainder = lambda i, m: None if i is None else zlib.crc32(str(i).encode()) % m


def rows_of(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


# ---- 1 SimHash ----------------------------------------------------------------------------------------------------

def brute_fingerprint(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, bits=4):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(fps))]


def test_simhash(messy, messy_rows):
    fps = [brute_fingerprint(r[1]) for r in messy_rows]
    comps = brute_components([r[0] for r in messy_rows], fps)
    want = Counter((r[0], f - (f >> 63 << 64), c) for r, f, c in zip(messy_rows, fps, comps))
    assert rows_of(simhash.near_duplicates(messy), "doc_id", "fp", "component_id") == want


def test_simhash_nothing(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_one(nothing).columns == nothing.columns


def test_simhash_keeps_one_row_per_component(messy):
    kept = simhash.keep_one(messy)
    assert kept.columns == messy.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    # id 15 names two unrelated texts (one of them twice): one row per component, so both stay
    assert ids.pop(15) == 2 and set(ids.values()) == {1} and {1, 5, 8, 9} <= set(ids) and not {2, 4, 6, 7} & set(ids)


@pytest.mark.parametrize("max_bits", [0, 2, 4])
def test_hot_keys_and_local_links_lose_no_link(spark, monkeypatch, max_bits):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 30)
    fps = {int(c) for c in centres}
    for c in centres[:6]:  # large clouds of near copies, chains among them
        for _ in range(60):
            f = int(c)
            for b in rng.integers(0, 63, rng.integers(1, 6)):
                f ^= 1 << int(b)
            fps.add(f)
    fps = sorted(fps)
    monkeypatch.setattr(simhash, "CHUNK", 16)  # nearly every key is cut into chunks
    groups = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = {r.node: r.root for r in connected_components(simhash.links(groups, len(fps), max_bits)).collect()}
    assert [found.get(f, f) for f in fps] == brute_components(fps, fps, max_bits)


def test_longer_keys_find_the_same_links(spark, monkeypatch):
    rng = np.random.default_rng(4)
    fps = sorted({int(x) for x in rng.integers(0, 2**63, 300)} | {int(x) ^ 0b1000000010000001001 for x in rng.integers(0, 2**63, 5)})
    near = [f ^ (1 << 3) ^ (1 << 21) ^ (1 << 44) ^ (1 << 60) for f in fps[:50]]
    fps = sorted({*fps, *near})
    groups = spark.createDataFrame([(f,) for f in fps], "fp long")
    short = rows_of(connected_components(simhash.links(groups, len(fps))), "node", "root")
    long = rows_of(connected_components(simhash.links(groups, 10**9)), "node", "root")
    assert short == long and sum(short.values()) >= 50


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(7, 7), (100, 99), (99, 100)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 99}


# ---- 2 chat -------------------------------------------------------------------------------------------------------

def test_chat(spark):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "bye"), (None, None), ("user", "x" * 100000)]
    convs = {1: talk[:1], 2: talk[:3], 3: talk[:3], 4: talk, 5: [("user", "hi"), ("assistant", "no")], 6: [("user", "")],
             7: [("user", "hi")] * 2, None: [("user", "lone")]}
    rows = [(c, k, r, t, "x") for c, ts in convs.items() for k, (r, t) in enumerate(ts)]
    rows += [(8, None, "user", "a", "x"), (8, 0, "user", "b", "x"), (8, 0, "user", "b", "x")]
    got = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, k string")).collect()}
    assert set(got) == {4, 5, 6, 7, 8, None}  # 1 and 2 = 3 are prefixes of 4
    assert got[4].n_turns == 5 and got[7].n_turns == 2 and got[8].n_turns == 3
    assert got[8].text == "".join(f"<|im_start|>user\n{t}<|im_end|>\n" for t in "abb")
    assert got[4].text.startswith("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello") and "<|im_start|>\n<|im_end|>" in got[4].text


def test_chat_equal_conversations_and_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    same = spark.createDataFrame([(c, k, "user", f"t{k}") for c in (9, 3, 5) for k in range(2)], schema)
    assert [(r.conv_id, r.n_turns, r.n_copies) for r in chat.format_chats(same).collect()] == [(3, 2, 3)]
    assert chat.format_chats(spark.createDataFrame([], schema)).count() == 0


# ---- 3 language ---------------------------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and all(r.held_out == (remainder(r.doc_id, 4) == 2) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(messy, nothing, spark):
    got = language.identify(messy).collect()
    assert len(got) == messy.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert all(by[i][0].lang_pred == "und" and by[i][0].score == 0 for i in (5, 6, 7))
    assert {r.lang_pred for r in got} <= {"en", "de", "und"} and not by[None][0].held_out
    assert language.identify(nothing).count() == 0
    digits = spark.createDataFrame([(1, "123 456", "en", "x"), (2, "abc", None, "x")], "doc_id long, text string, lang string, score string")
    assert {r.lang_pred for r in language.identify(digits).collect()} <= {"und"}


def brute_language(rows):
    """The method with plain lists: letter vectors rotated by place, multiplied, added up, compared by cosine."""
    letters = np.random.Generator(np.random.PCG64(99)).choice(np.array([-1, 1], np.int8), (language.CLASSES, language.DIMENSIONS)).astype(int)
    kinds = language._letter_class()

    def bundle(text):
        classes = [0]
        for c in text + "\0":
            k = int(kinds[ord(c)])
            if k or classes[-1]:
                classes.append(k)
        total = np.zeros(language.DIMENSIONS, int)
        for a, b, c in zip(classes, classes[1:], classes[2:]):
            total += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
        return total, any(classes)
    profiles = {}
    for i, t, lang in rows:
        if lang is not None and remainder(i, 4) != 2:
            profiles[lang] = profiles.get(lang, 0) + bundle(t or "")[0]
    out = []
    for i, t, _ in rows:
        v, letter = bundle(t or "")
        cosines = {n: float(p @ v / max(np.linalg.norm(p) * np.linalg.norm(v), 1e-9)) for n, p in sorted(profiles.items()) if np.any(p)}
        best = max(cosines, key=cosines.get) if letter and cosines else "und"
        out.append((i, best, max(0.0, cosines.get(best, 0.0))))
    return out


def test_language_against_plain_lists(spark):
    from creditlens.sources.tables import Tables
    docs = [(r.doc_id, r.text[:700] if r.text else r.text, r.lang) for r in
            Tables(spark, "/root/testdata/sf0.001").documents.select("doc_id", "text", "lang").collect()][:90]
    docs += [(None, "Привет мир, как дела", "ru"), (5000, "Привет всем", None), (5001, None, "ru"), (5002, "1 2 3", "en")]
    got = language.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    want = {i: (lang, score) for i, lang, score in brute_language(docs)}
    assert len(got) == len(docs)
    for r in got:
        assert r.lang_pred == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-5, r


def test_language_memory_of_a_long_text():
    import resource
    rng = np.random.default_rng(1)
    text = "".join(map(chr, rng.choice([*range(97, 123), 32, *range(0x430, 0x450)], 8_000_000))).encode()
    language.gram_vectors()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    grams, counts, letter = language.gram_counts(text)
    vector = language.text_vector(grams, counts)
    assert letter and len(grams) == len(set(grams.tolist())) and vector.shape == (language.DIMENSIONS,)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000  # kB


def test_language_blocks_do_not_change_counts(monkeypatch):
    text = "Ein Würfel, zwei  Würfel -- drei!".encode()
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "_BLOCK_CHARS", 5)
    parts = language.gram_counts(text)
    assert Counter(dict(zip(*whole[:2]))) == sum((Counter({g: c}) for g, c in zip(*parts[:2])), Counter())


# ---- 4 quality ----------------------------------------------------------------------------------------------------

def brute_stats(text):
    w = words(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    repeat = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeat))


def test_quality_statistics(messy, messy_rows, nothing):
    got = rows_of(quality.score(messy, None), "doc_id", *quality.STATS, "base_failed", "kept")
    want = Counter()
    for r in messy_rows:
        s = brute_stats(r[1])
        bad = s[0] < 50 or 100 * s[4] > 50 * s[0]
        want[(r[0], *s, bad, not bad)] += 1
    assert got == want
    assert quality.score(nothing, None).count() == 0


def test_quality_rules_learn_from_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.score(docs, labels.unionByName(labels.limit(3)).unionByName(
        spark.createDataFrame([(None, 0, 0), (1, None, 0)], labels.schema))).join(labels, "doc_id").collect()
    passed = [r for r in got if not r.base_failed]
    assert any(r.rule for r in passed) and all((r.rule is None) == r.kept for r in passed)
    assert sum(r.kept == (r.quality == 1) for r in passed) / len(passed) > 0.98
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns


def test_quality_no_or_one_sided_labels(messy, nothing, spark):
    for labels in (spark.createDataFrame([], "doc_id long, quality int"), spark.createDataFrame([(100 + i, 1) for i in range(40)], "doc_id long, quality int")):
        assert quality.score(messy, labels).where("kept = base_failed").count() == 0
    assert quality.keep_good(messy, None).columns == messy.columns
    assert quality.keep_good(nothing, None).count() == 0


def test_decision_list_grows_conjunctions(spark):
    rows = [(i, float(i % 20), float(i // 20 % 20), int(i % 20 > 12 and i // 20 % 20 <= 5)) for i in range(2000)]
    rules = quality.learn(spark.createDataFrame(rows, "doc_id long, x double, y double, bad int"), ["x", "y"])
    cols = {"x": F.col("x"), "y": F.col("y")}
    wrong = spark.createDataFrame(rows, "doc_id long, x double, y double, bad int").where(
        quality.rejects(rules, cols).isNotNull() != (F.col("bad") == 1)).count()
    assert wrong == 0 and max(map(len, rules)) == 2


# ---- 5 decontamination --------------------------------------------------------------------------------------------

def folded(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_hits(text, items, window=10):
    w, hit, ids = folded(text), set(), set()
    for item, t in items:
        v = folded(t)
        n = min(window, len(v))
        for i in range(len(v) - n + 1 if v else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == v[i:i + n]:
                    hit.update(range(j, j + n))
                    ids.add("" if item is None else str(item))
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("block", [1_000_000, 150])
def test_decontamination(messy, messy_rows, nothing, spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "MAX_ITEM_BYTES", block)  # the small one scans in several blocks
    base = messy_rows[0][1].split()
    items = [(1, " ".join(base[20:35])), (2, "ONE, two... three!"), (3, None), (4, "--"), (None, " ".join(base[50:58])), (5, "x"),
             (2, "one two three"), (6, " ".join(base[27:40]) + " no such words")]
    table = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, ranges string")
    found = decontaminate.find(messy, table).collect()
    got = Counter((r.doc_id, r.n_words, sum(x.end - x.start for x in r.ranges), tuple(r["items"])) for r in found)
    want = Counter()
    for r in messy_rows:
        n, hit, ids = brute_hits(r[1], items)
        want[(r[0], n, hit, tuple(ids))] += 1
    assert got == want
    texts = {r[0]: r[1] for r in messy_rows}
    nine = next(r for r in found if r.doc_id == 9)
    assert [texts[9][s.start:s.end] for s in nine.spans] == ["one two three"]
    clean = decontaminate.keep_clean(messy, table)
    assert clean.columns == messy.columns
    assert rows_of(clean, "doc_id") == Counter((r[0],) for r in messy_rows if not brute_hits(r[1], items)[1])
    assert decontaminate.find(nothing, table).count() == 0
    assert decontaminate.keep_clean(messy, table.limit(0)).count() == len(messy_rows)


def test_spans_in_the_original_text():
    text = "Ünï (One) 😀 TWO"
    assert [text[a:b] for a, b in decontaminate.original_spans(text.encode(), [(0, 1), (1, 2), (3, 4)])] == ["Ünï", "One", "TWO"]


# ---- 6 substring --------------------------------------------------------------------------------------------------

def brute_repeats(texts, window):
    docs = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for w in docs:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


@pytest.mark.parametrize("window", [35, 5, 50])
def test_substring(messy, messy_rows, window):
    got = rows_of(substring_dedup.remove_repeats(messy, window=window), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == Counter((r[0], *x) for r, x in zip(messy_rows, brute_repeats([r[1] for r in messy_rows], window)))


def test_substring_nothing_and_levels(nothing):
    assert substring_dedup.remove_repeats(nothing).count() == 0
    assert substring_dedup.levels(35) == [9, 18, 35] and substring_dedup.levels(5) == [5]


# ---- 7 HTML -------------------------------------------------------------------------------------------------------

def test_html_pages(spark):
    line = "the water rose over the lower road all night until it fell again at dawn"
    page = f"""<!doctype html><html><head><title>T</title><style>p {{ a > b }}</style><script>var x = "</p><p>no";</script></head>
    <body><nav><a href=/>Home</a></nav><div class="ad">Buy &lt;now&gt; {line}</div><!-- <p>no</p> --><div class='cookie-notice'>{line}</div>
    <article><h1>A &amp; B</h1><p>One&nbsp;two<br>three <b>four</b>\n  five</p><p>{line}, <a href="a>b">see</a> &#233;.</p>
    <form><p>{line}</p><button>Go</button></form><p>End.</p><section class="comments"><p>{line} says a reader</p></section></article>
    <aside>{line}</aside><footer>&copy; {line}</footer>"""
    want = f"A & B\n\nOne two three four five\n\n{line}, see é.\n\nEnd."
    rows = [(1, "u", page, "x"), (2, None, None, "x"), (None, "v", "", "x"), (1, "u", page, "x"), (3, "w", "<p", "x"), (4, "w", "<p>" * 20000, "x")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in got] == [
        (1, "u", want, len(want)), (2, None, "", 0), (None, "v", "", 0), (1, "u", want, len(want)), (3, "w", "", 0), (4, "w", "", 0)]
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


LINE = "the water rose over the lower road all night until it fell again at dawn"
LONG = " ".join([LINE] * 3)
NAV = "<ul><li><a href=/>Home</a><li><a href=/n>All the news</a><li><a href=/s>Sport</a></ul>"
#: Hand-written templates: page, the article's blocks.
TEMPLATES = [
    (f'<article class="post no-sidebar"><p>{LINE}</p><p>Short.</p></article>', [LINE, "Short."]),
    (f'<main class="has-sidebar"><p>{LINE}</p></main><div class=sidebar><p>{LINE}</p></div>', [LINE]),
    (f'<div id=content class="content comments-open comments"><p>{LINE}</p></div>', [LINE]),
    (f'{NAV}<div><p>{LINE}</p><p>Short.</p><p>{LINE}</p><p>All went well.</p><p>{LINE}</p></div><div><a>Next</a></div>',
     [LINE, "Short.", LINE, "All went well.", LINE]),
    (f'<article><h1>Flood</h1><p>{LONG}</p></article><section id=kommentare><p>{LONG} says a reader</p></section>', ["Flood", LONG]),
    (f'<body class="sidebar menu"><main><h2>Two</h2><p>{LINE}</p><div class="ad box"><p>{LINE}, buy now</p></div></main></body>', ["Two", LINE]),
    (f'<header><h1>The Paper</h1><p>{LINE}</p></header><article><header><h1>Bridge</h1></header><p>{LONG}</p></article><footer>{LINE}</footer>',
     ["Bridge", LONG]),
    (f'<div role=banner><p>{LINE}</p></div><div role=main><p>{LINE}</p><ul><li>One</li><li>Two</li></ul></div><div role=search>{LINE}</div>',
     [LINE, "One", "Two"]),
    (f'<table><tr><td><ul><li><a>A</a><li><a>B</a></ul></td></tr><tr><td><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></td></tr></table>', [LONG] * 3),
    (f'<div class=cookie-notice>{LINE}</div><div class="entry-content"><h2>Head</h2><p>{LONG}</p><blockquote>{LINE}</blockquote></div>',
     ["Head", LONG, LINE]),
    (f'<article><p>{LINE}</p><form><p>{LINE}</p></form><div class="share"><a>Mail</a></div><p>End.</p></article>', [LINE, "End."]),
    (f'{NAV}<div><h1>Plain</h1><p>{LONG}</p><p>{LONG} <a>more</a></p><p>{LINE}</p></div>{NAV}', ["Plain", LONG, f"{LONG} more", LINE]),
    (f'<div class="post"><p>{LONG}</p></div><div class="comment text"><p>{LONG}</p></div>', [LONG]),
]


@pytest.mark.parametrize("k", range(len(TEMPLATES)))
def test_html_templates(k):
    page, want = TEMPLATES[k]
    assert html_text.main_text(f"<!doctype html><html>{page}</html>").split("\n\n") == want


def test_html_tree_is_read_as_it_is_trained():
    """A plain reader: the rules of the tree as lists of conditions, tried one by one."""
    tree = html_text.default_tree()
    rules = []

    def paths(t, so_far):
        if isinstance(t, html_text.Leaf):
            rules.append((so_far, t.keep))
        else:
            paths(t[2], [*so_far, (t[0], t[1], True)])
            paths(t[3], [*so_far, (t[0], t[1], False)])
    paths(tree, [])
    assert len(rules) > 5 and {"words", "run_blocks"} & {html_text.FEATURES[f] for r, _ in rules for f, _, _ in r}
    for page, _ in TEMPLATES:
        found = html_text.blocks(page)
        kept = []
        for b, row in zip(found, html_text.describe(found)):
            [keep] = [k for rule, k in rules if all((row[f] <= cut) == low for f, cut, low in rule)]
            kept += [b.text] * keep
        assert "\n\n".join(kept) == html_text.main_text(page)


def test_html_long_pages_and_clashing_columns(spark):
    page = "<article>" + f"<p>{LINE}</p>" * 30_000 + "</article>"
    df = spark.createDataFrame([(1, None, page, "t", 5)], "page_id long, url string, html string, text string, n_chars int")
    [r] = html_text.extract(df).collect()
    assert r.text == "\n\n".join([LINE] * 30_000) and r.n_chars == len(r.text) and r.url is None


def test_html_tree_on_pages_it_did_not_see():
    held = html_text.sample_pages()[::5]
    rows, labels = [], []
    for k, page in enumerate(html_text.sample_pages()):
        if k % 5:
            found = html_text.blocks(page)
            rows += html_text.describe(found)
            labels += [b.label for b in found]
    tree = html_text.train(rows, labels)
    judged = [(html_text.keeps(tree, r), b.label) for f in map(html_text.blocks, held) for b, r in zip(f, html_text.describe(f))]
    assert sum(a == b for a, b in judged) / len(judged) > 0.97


# ---- 8 token files ------------------------------------------------------------------------------------------------

def test_codec_round_trip():
    for values in ([], [0], [255, 256, 65535, 65536, 2**24, 2**32 - 1, 7], list(range(0, 70000, 7))):
        v = np.array(values, np.uint32)
        assert (token_files.decode(*token_files.encode(v), len(v)) == v).all()


def test_cached_ids_equal_whole_text_ids(messy_rows):
    ids = WordIds("word_bpe_49k.json")
    odd = ["'S it's <|endoftext|>x <|ENDOFTEXT|> é ΣΑΣ 12ab İstanbul \x1c z\x85q ﬁ 👍🏽 한국 é!! ...a 1. é. 'll'll", "a.b,c!? d's. ….́."]
    for t in [r[1] or "" for r in messy_rows if len(r[1] or "") < 20000] + odd:
        assert ids.of_texts([lowered_words(t.encode())])[0].tolist() == ids.tokenizer.encode(t, add_special_tokens=False).ids


def test_every_letter_before_punctuation():
    ids = WordIds("word_bpe_49k.json")
    letters = [chr(c) for c in range(0xA0, 0x30000) if chr(c).isalpha() and not 0x3500 < c < 0x9F00 and not 0xAD00 < c < 0xD700 and not 0x20100 < c < 0x2F700]
    words = [x + c + end for c in letters for x, end in (("a", "."), ("", ",!"))] + "ALİ. YENİ, ev ड़. ਲ਼; ଡ଼?".split()
    for i in range(0, len(words), 500):
        part = words[i:i + 500]
        want = [ids.tokenizer.encode(w, add_special_tokens=False).ids for w in part]
        assert [x.tolist() for x in ids.of_texts([[w.encode()] for w in part])] == want
    # not every letter is its own end, and most are
    assert not ids.closed["İ"] and not ids.closed["\u0958"] and ids.closed["é"] and sum(ids.closed.values()) > 0.9 * len(ids.closed)


@pytest.mark.parametrize("block", [1 << 20, 500])
def test_token_files(messy, messy_rows, nothing, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK_IDS", block)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, t, *_ in messy_rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want[(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    got = token_files.write_and_read(messy).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    assert token_files.write_and_read(nothing).count() == 0


# ---- 9 mixing -----------------------------------------------------------------------------------------------------

def test_targets_water_fill():
    got = mixing.targets({"a": 10, "b": 1000, "c": 1000, None: 0})
    assert got["a"] == 20 and got[None] == 0 and abs(sum(got.values()) - 1.5 * 2010) < 1e-6
    assert abs(got["b"] / got["c"] - 2) < 1e-9 and list(mixing.targets({})) == []


def test_flow_uses_fresh_words_first_and_meets_quotas():
    flow = mixing.route({("a",): 100, ("a", "b"): 100, ("b",): 10}, {"a": 150, "b": 110})
    assert sum(flow["a",].values()) + flow["a", "b"]["a"] == 150
    assert flow["a", "b"]["b"] + flow["b",]["b"] == 110
    assert sum(flow["a", "b"].values()) <= 200 and sum(flow["b",].values()) <= 20
    assert sum(sum(f.values()) for f in flow.values()) == 260


def brute_flow(patterns, quota, passes):
    """Cheapest total by successive shortest paths, one word at a time."""
    left, used, out = dict(quota), Counter(), Counter()
    cost = 0
    while True:
        best = None
        for p in sorted(patterns, key=str):  # cheapest next use of a pattern that can still reach a quota
            if used[p] < passes * patterns[p]:
                price = 2 * (used[p] // patterns[p]) + 1
                queue, via = [(p, None)], {}
                while queue:
                    at, _ = queue.pop(0)
                    for s in at:
                        if s not in via:
                            via[s] = at
                            queue += [(q, s) for (q, t), n in out.items() if t == s and n]
                ends = [s for s in via if left[s]]
                if ends and (best is None or price < best[0]):
                    best = price, p, ends[0], dict(via)
        if best is None:
            return cost, sum(used.values())
        price, p, s, via = best
        cost, left[s] = cost + price, left[s] - 1
        used[p] += 1
        while True:  # along the path, patterns hand a source over
            q = via[s]
            out[q, s] += 1
            if q == p:
                break
            s = next(t for t in via if out[q, t] and t != s and q != via[t])
            out[q, s] -= 1


@pytest.mark.parametrize("seed", range(12))
def test_flow_costs_as_little_as_one_word_at_a_time(seed):
    rng = np.random.default_rng(seed)
    names = "abcd"
    patterns = {p: int(rng.integers(1, 7)) for p in {tuple(sorted(rng.choice(list(names), rng.integers(1, 4), replace=False))) for _ in range(5)}}
    quota = {s: int(rng.integers(0, 12)) for s in sorted({s for p in patterns for s in p})}
    flow = mixing.route(patterns, quota, 2)
    used = {p: sum(f.values()) for p, f in flow.items()}
    assert all(used[p] <= 2 * n for p, n in patterns.items()) and all(set(f) <= set(p) for p, f in flow.items())
    assert all(sum(f.get(s, 0) for f in flow.values()) <= q for s, q in quota.items())
    cost = sum(n + 2 * max(0, n - patterns[p]) for p, n in used.items())
    assert (cost, sum(used.values())) == brute_flow(patterns, quota, 2)


def test_flow_of_many_patterns_is_quick():
    import time
    rng = np.random.default_rng(1)
    single = {(f"s{i:06d}",): int(rng.integers(1, 1000)) for i in range(100_000)}
    start = time.time()
    flow = mixing.route(single, {p[0]: n * 3 // 2 for p, n in single.items()})
    assert all(flow[p][p[0]] == n * 3 // 2 for p, n in single.items())
    overlap = {tuple(sorted(f"s{x:03d}" for x in set(rng.integers(0, 400, rng.integers(1, 5)).tolist()))): int(rng.integers(1, 1000)) for _ in range(30_000)}
    total = sum(overlap.values())
    flow = mixing.route(overlap, {f"s{i:03d}": total * 3 // 2 // 400 for i in range(400)})
    assert sum(sum(f.values()) for f in flow.values()) == total * 3 // 2 // 400 * 400
    assert time.time() - start < 60


def test_mix(messy, messy_rows, nothing):
    got = mixing.mix(messy).collect()
    again = mixing.mix(messy).collect()
    assert Counter(map(str, got)) == Counter(map(str, again)) and len(got) == len(messy_rows)
    sizes = Counter()
    for r in messy_rows:
        sizes[r[3]] += len(words(r[1]))
    goal = mixing.targets(dict(sizes))
    taken = Counter()
    for r in got:
        s = r.members[0]
        assert r.taken in (0, r.size, 2 * r.size) and r.source_sizes == [sizes[s]] and r.targets == [goal[s]]
        taken[s] += r.taken
    longest = defaultdict(int)
    for r in messy_rows:
        longest[r[3]] = max(longest[r[3]], len(words(r[1])))
    assert all(abs(taken[s] - goal[s]) <= longest[s] for s in sizes)
    rows = mixing.repeat_documents(messy)
    assert rows.columns == messy.columns
    assert sum(len(words(r.text)) for r in rows.select("text").collect()) == sum(taken.values())
    assert mixing.mix(nothing).count() == 0 and mixing.repeat_documents(nothing).count() == 0


def test_word_ids_of_a_column_look_up_distinct_words_once(monkeypatch):
    texts = [None, "", "  ", "the the Cat.  the " * 50, "".join(map(chr, range(1, 128))) * 2, "a<|X|>B Cat", "ALİ. É x\x1cy\u3000z", "the"]
    words = WordIds("word_bpe_49k.json")
    asked = []
    encode = words._encode
    monkeypatch.setattr(words, "_encode", lambda stems: (asked.extend(stems), encode(stems)))
    for sliced in (pa.array(texts), pa.array(["x", *texts])[1:], pa.array(texts, pa.large_string())):
        flat, edges = words.of_column(sliced)
        for text, a, b in zip(texts, edges, edges[1:], strict=False):
            assert flat[a:b].tolist() == words.tokenizer.encode(text or "", add_special_tokens=False).ids, text
    assert len(asked) == len(set(asked)) and len(edges) == len(texts) + 1
    flat, edges = words.of_column(pa.array([None, " "], pa.string()))
    assert len(flat) == 0 and edges.tolist() == [0, 0, 0]


def test_workers_let_go_of_what_another_operator_kept():
    words = subwords.word_ids("word_bpe_49k.json")
    assert subwords.word_ids("word_bpe_49k.json") is words
    held = weakref.ref(words)
    del words
    found = decontaminate.automaton({" a ": ("i",)}, "one")
    assert decontaminate.automaton({}, "one") is found
    gc.collect()
    assert held() is None  # its words are let go for the automaton
    held = weakref.ref(subwords.word_ids("word_bpe_49k.json"))
    assert len(decontaminate.automaton({}, "one")) == 0
    common.release()
    gc.collect()
    assert held() is None and len(decontaminate.automaton({" a ": ("i",)}, "one")) == 1
    common.release()


def test_mix_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a", "b"] if i % 3 else ["b"]) for i in range(90)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source array<string>")).collect()
    assert sum(r.taken for r in got) >= 10 * 90 and all(r.uses <= 2 for r in got)


# ---- 10 LM --------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("hot", [100_000, 50])
def test_lm_base(messy, messy_rows, nothing, monkeypatch, hot):
    monkeypatch.setattr(lm, "HOT_WORDS", hot)  # the small one sends most words through the join
    monkeypatch.setattr(lm, "STEPS", 5)
    low = lambda t: (t or "").encode().lower().split()
    counts = Counter()
    for r in messy_rows:
        if remainder(r[0], 5) != 1:
            counts.update([*low(r[1]), b" "])
    n, v = sum(counts.values()), len(counts)
    got = sorted(lm.score(messy).collect(), key=lambda r: (r.doc_id or 0, r.n_tokens, r.base_score))
    want = []
    for r in messy_rows:
        w = [*low(r[1]), b" "]
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        want.append((r[0], remainder(r[0], 5) == 1, len(w), sum(counts[x] > 0 for x in w), n, base))
    want.sort(key=lambda x: (x[0] or 0, x[2], x[5]))
    for g, x in zip(got, want, strict=True):
        assert (g.doc_id, g.held_out, g.n_tokens, g.n_known, g.train_tokens) == x[:5]
        assert abs(g.base_score - x[5]) < 1e-6 * max(1, abs(x[5])) and g.score < 0
    assert lm.score(nothing).count() == 0


def brute_log10(model, classes):
    """Every position on its own, with plain loops over its context window."""
    t, total = model.t, 0.0
    into = [0, *classes[:-1]]
    for p, goal in enumerate(classes):
        start = max(0, p // lm.STRIDE * lm.STRIDE - (lm.CONTEXT - lm.STRIDE))
        q = t["query"][into[p]]
        s = np.array([q @ t["key"][into[j]] + t["far"][p - j] for j in range(start, p + 1)])
        a = np.exp(s - s.max())
        a /= a.sum()
        h = sum(x * t["value"][into[start + j]] for j, x in enumerate(a)) + t["own"][into[p]]
        z = h @ t["out"] + t["pair"][into[p]]
        total += (z[goal] - z.max() - np.log(np.exp(z - z.max()).sum())) / np.log(10)
    return total


def test_lm_windows_score_each_id_once():
    rng = np.random.default_rng(1)
    model = lm.Model.start()
    model.t["far"] = rng.normal(0, 1, lm.CONTEXT).astype(np.float32)
    model.t["pair"] = rng.normal(0, 1, (lm.CLASSES, lm.CLASSES)).astype(np.float32)
    for n in (1, 15, 16, 17, 70):
        classes = rng.integers(0, lm.CLASSES, n)
        into, goal = lm._blocks(classes)
        assert abs(model.log10(into, goal).sum() - brute_log10(model, classes.tolist())) < 1e-3


def test_lm_gradients():
    rng = np.random.default_rng(2)
    model = lm.Model.start()
    into, goal = lm._blocks(rng.integers(0, lm.CLASSES, 50))
    _, grads = model.gradients(into, goal)
    for name in lm.Model.NAMES:
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        value, sides = model.t[name][at], []
        for step in (1e-2, -1e-2):
            model.t[name][at] = value + step
            sides.append(model.gradients(into, goal)[0])
        model.t[name][at] = value
        assert abs((sides[0] - sides[1]) / 2e-2 - grads[name][at]) < 0.03 * abs(grads[name][at]) + 1e-3, name


def test_lm_gradients_of_texts_of_many_lengths():
    rng = np.random.default_rng(12)
    parts = [lm._blocks(x) for x in (*(rng.integers(0, lm.CLASSES, n) for n in (1, 15, 16, 17, 200)), np.full(90, 5))]
    into, goal = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    model = lm.Model.start()
    model.t["far"] = rng.normal(0, 1, lm.CONTEXT).astype(np.float32)
    model.t["pair"] = rng.normal(0, 1, (lm.CLASSES, lm.CLASSES)).astype(np.float32)
    grads = model.gradients(into, goal)[1]
    for name in lm.Model.NAMES:  # along the gradient: every entry counts
        value, way = model.t[name], grads[name] / np.linalg.norm(grads[name])
        sides = []
        for step in (3e-2, -3e-2):
            model.t[name] = (value + step * way).astype(np.float32)
            sides.append(-model.log10(into, goal).sum() * math.log(10) / (goal >= 0).sum())
        model.t[name] = value
        want = np.linalg.norm(grads[name])
        assert abs((sides[0] - sides[1]) / 6e-2 - want) < 0.03 * want + 1e-5, name


def test_lm_step_holds_no_class_per_place_before():
    into, goal = lm._blocks(np.random.default_rng(13).integers(0, lm.CLASSES, lm.BATCH * lm.STRIDE))
    adam = lm.Adam(lm.Model.start())
    gc.collect()
    tracemalloc.start()
    adam.learn(into, goal, 0.01)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1200 * into.size, most  # twice that before: 64 numbers for each of the 32 places of a block


def test_lm_attention_learns_more_than_bigrams():
    rng = np.random.default_rng(3)
    def text():  # each class repeats the one three before
        x = rng.integers(1, 12, 3).tolist()
        while len(x) < 120:
            x.append(x[-3])
        return np.array([*x, 0])
    model = lm.fit([text() for _ in range(150)], steps=400)
    flat = lm.fit([text() for _ in range(150)], steps=0)
    into, goal = lm._blocks(text())
    assert model.log10(into, goal).mean() > flat.log10(into, goal).mean() + 0.3


def test_lm_shares(spark):
    words = {b"onthething": 7, b"ofthe": 3, b"": 4, b"the": 5, "ñandúes".encode(): 2, b"x" * 300: 1}
    counts = spark.createDataFrame([(bytearray(w), c) for w, c in words.items()], "w binary, c long")
    plain = lm.subword_counts(counts)
    kind, share = lm.classes_of(plain)
    slot = lm.slots_of(plain)
    pairs, single = Counter(), Counter()
    for w, c in words.items():
        ids = lm.subword_ids([w]) if w else [lm.END]
        for i in ids:
            single[i] += c
        for a, b in zip(ids, ids[1:]):
            pairs[a, b] += c
    assert {i: int(plain[i]) for i in np.flatnonzero(plain)} == single
    table = lm.subword_counts(counts, slot)
    ids = np.flatnonzero(slot >= 0)
    back = dict(zip(slot[ids].tolist(), ids.tolist()))
    assert {(back[i], back[j]): int(table[i, j]) for i, j in np.argwhere(table)} == pairs
    shares = lm.Shares(kind, share, slot, table)
    every = np.arange(lm.VOCABULARY)
    for before in (lm.END, lm.VOCABULARY - 2, *{a for a, _ in pairs}):
        after = shares.along(np.stack((np.full(lm.VOCABULARY, before), every), 1).reshape(-1))[::2]
        total = np.bincount(kind, 10.0 ** after, lm.CLASSES)
        assert np.allclose(total[np.unique(kind)], 1, atol=1e-3)  # a distribution over the ids of every class
    (a, b), n = max(((p, n) for p, n in pairs.items() if (kind == kind[p[1]]).sum() > 1), key=lambda x: x[1], default=((0, 0), 0))
    if n:
        assert shares.along(np.array([a, b]))[0] > share[b]


def test_lm_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = lm.score(docs).where("held_out").agg(F.sum("score"), F.sum("n_tokens")).first()
    assert got[0] / got[1] > -6  # log10 per word on texts not learned from


def stored(spark, texts):
    rows = [(i, bytearray(np.array(t, np.uint16).tobytes())) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "h long, ids binary")


def small_output(texts, seed=8):
    """The output of a few texts (ids with their end), untrained, and their shares."""
    plain = np.bincount(np.concatenate(texts), minlength=lm.VOCABULARY)
    kind, share = lm.classes_of(plain)
    slot, table = lm.slots_of(plain), np.zeros((lm.PAIR_IDS, lm.PAIR_IDS), int)
    for t in texts:
        for a, b in zip([lm.END, *t], t):
            if slot[a] >= 0 and slot[b] >= 0:
                table[slot[a], slot[b]] += 1
    return lm.Output(kind, share, slot, table), lm.Shares(kind, share, slot, table)


def test_lm_output_starts_from_shares_and_is_a_distribution():
    rng = np.random.default_rng(8)
    texts = [np.append(rng.integers(0, 300, 200), lm.END) for _ in range(5)]
    output, shares = small_output(texts)
    every = np.arange(lm.VOCABULARY)
    for trained in (False, True):
        if trained:
            output.t = {k: rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in output.t.items()}
        for before in (lm.END, 7, 299, 40_000):
            got = output.log10(np.full(lm.VOCABULARY, before), every, np.tile(rng.normal(0, 1, lm.WIDTH).astype(np.float32), (lm.VOCABULARY, 1)))
            assert np.allclose(np.bincount(output.kind, 10.0 ** got, lm.CLASSES)[np.unique(output.kind)], 1, atol=1e-3)
            if not trained:
                want = shares.along(np.stack((np.full(lm.VOCABULARY, before), every), 1).reshape(-1))[::2]
                assert np.abs(got - want).max() < 1e-3


def test_lm_output_gradients():
    rng = np.random.default_rng(9)
    ids = rng.integers(0, 300, 60)
    output, _ = small_output([np.append(ids, lm.END)])
    output.t = {k: rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in output.t.items()}
    before, h = np.append(lm.END, ids[:-1]), rng.normal(0, 1, (60, lm.WIDTH)).astype(np.float32)
    for name, (rows, grads) in output.gradients(before, ids, h).items():
        at = np.unravel_index(np.abs(grads).argmax(), grads.shape)
        where, value, sides = (int(rows[at[0]]), *at[1:]), None, []
        value = output.t[name][where]
        for step in (1e-2, -1e-2):
            output.t[name][where] = value + step
            sides.append(output.log10(before, ids, h).sum() * math.log(10))
        output.t[name][where] = value
        assert abs((sides[0] - sides[1]) / 2e-2 - grads[at]) < 0.03 * abs(grads[at]) + 1e-2, name


@pytest.mark.parametrize("shard", [1 << 18, 1 << 7])
def test_lm_output_learns_ids_from_the_text_before(spark, monkeypatch, shard):
    monkeypatch.setattr(lm, "OUTPUT_SHARD", shard)  # the small one gives several shards
    rng = np.random.default_rng(10)
    kind = np.full(lm.VOCABULARY, 60)
    kind[lm.END], kind[1], kind[2] = 0, 1, 2

    def text():  # the id after 2000 tells of the id before it, which counts of neighbours do not
        out = []
        for x in rng.integers(1, 3, 60).tolist():
            out += [x, 2000, 3000 + x]
        return out
    texts = [text() for _ in range(120)]
    share = np.bincount(np.concatenate([*texts, [lm.END]]), minlength=lm.VOCABULARY) + 0.5
    plain = np.log10(share / np.bincount(kind, share, lm.CLASSES)[kind])
    output = lm.Output(kind, plain, np.full(lm.VOCABULARY, -1), np.zeros((lm.PAIR_IDS, lm.PAIR_IDS), int))
    model = lm.Model.start()
    fresh = lm._stored_ids(np.array(text(), np.uint16).tobytes())
    start = lm.score_texts(model, output, [fresh, fresh[-1:]])
    tokens = stored(spark, texts)
    lm.fit_output(tokens, model, output, sum(-(-(len(t) + 1) // lm.STRIDE) for t in texts))
    end = lm.score_texts(model, output, [fresh, fresh[-1:]])
    assert end[0] > start[0] + 10 and len(end) == 2 and end[1] < 0


def test_lm_word_counts_in_slices(spark, monkeypatch):
    monkeypatch.setattr(lm, "_COUNT_TEXTS", 3)
    monkeypatch.setattr(lm, "_FLUSH_WORDS", 10)  # partial counts are added up and passed on many times
    rng = np.random.default_rng(11)
    texts = [None, "", "\t", "A\x0ba\x1cb\x0c\xa0 É", *(" ".join(f"W{x}" for x in rng.integers(0, 40, 30)) for _ in range(50))]
    want = Counter()
    for t in texts:
        want.update([*(t or "").encode().lower().split(), b""])
    got = lm.word_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)).collect()
    assert {bytes(r.w): r.c for r in got} == want and len(got) == len(want)


def test_lm_facts_of_a_column_of_texts(monkeypatch):
    texts = [None, "", " ", "The the cat's A\x85 b it's x\x1cy", "a\u3000 \u3000y b", "w" * 300 + " e " + "v" * 256, "É é ǅ 'twas",
             "x" * 256, *(f"t{i} the b" for i in range(40))]
    low = [lm.words_of((t or "").encode()) for t in texts]
    top = [b"", b"the", b"b", b"v" * 256, b"w" * 300, "a\u3000".encode()]
    for words in (top, []):
        hot = lm.Hot(pa.array(words, pa.binary()), np.arange(len(words)) - 9.5)
        value = dict(zip(words, hot.value))
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts) + 1)), pa.array(["left out", *texts])], ["h", "text"])[1:]
        monkeypatch.setattr(lm, "_SLICE_BYTES", 300)
        parts = list(lm._slices(batch))
        assert len(parts) > 2 and pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
        got = [hot.facts(part.column(1)) for part in parts]
        rows = [row for f in got for row in zip(*(x.to_pylist() if isinstance(x, pa.Array) else x for x in f))]
        for w, (n, known, base, ids, rare, times) in zip(low, rows, strict=True):
            count = Counter([*w, b""])
            assert (n, known) == (len(w) + 1, sum(c for x, c in count.items() if x in value))
            assert abs(base - sum(c * value[x] for x, c in count.items() if x in value)) < 1e-9
            assert np.frombuffer(ids, np.uint16).tolist() == lm.subword_ids(w)
            assert dict(zip(rare, times, strict=True)) == {x: c for x, c in count.items() if x not in value}
    ids, size = lm.word_ids(pa.array([b"", b"cats", b"w" * 300, b"\xc3\xa9"], pa.binary()))
    want = [lm.subword_ids([w] if w else []) for w in (b"", b"cats", b"w" * 300, b"\xc3\xa9")]
    assert ids.tolist() == [i for x in want for i in x] and size.tolist() == list(map(len, want))


def test_lm_scores_stay_finite():
    model = lm.Model.start()
    into, goal = lm._blocks(np.random.default_rng(4).integers(0, lm.CLASSES, 40))
    want = model.log10(into, goal)
    for shift in (500, -500):  # of all scores after a class: shares stay the same
        model.t["pair"] = np.full((lm.CLASSES, lm.CLASSES), shift, np.float32)
        assert np.allclose(model.log10(into, goal), want, atol=1e-3)
        assert all(np.isfinite(g).all() for g in model.gradients(into, goal)[1].values())


def test_lm_counts_whole_texts(spark):
    kind = np.arange(lm.VOCABULARY) % (lm.CLASSES - 1) + 1
    kind[lm.END] = 0
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 500, n).tolist() for n in [0, 1, 15, 16, 9000] + [3] * 2500]
    want, blocks = np.zeros((lm.CLASSES, lm.CLASSES), int), 0
    for t in texts:
        classes = [0, *kind[t].tolist(), 0]
        for a, b in zip(classes, classes[1:]):
            want[a, b] += 1
        blocks += -(-(len(t) + 1) // lm.STRIDE)
    pairs, n = lm.text_counts(stored(spark, texts), kind)[:2]
    assert (pairs == want).all() and n == blocks


@pytest.mark.parametrize("shard", [1 << 16, 1 << 12])
def test_lm_learns_from_all_of_every_text(spark, monkeypatch, shard):
    monkeypatch.setattr(lm, "SHARD", shard)  # the small one gives several shards a round
    kind = np.zeros(lm.VOCABULARY, np.int64)
    kind[:lm.CLASSES] = np.arange(lm.CLASSES)
    rng = np.random.default_rng(7)

    def text(plain):  # only the end of a long text repeats the class three before
        x = rng.integers(1, 12, plain + 3).tolist()
        while len(x) < plain + 2200:
            x.append(x[-3])
        return x
    tokens = stored(spark, [text(500) for _ in range(380)])
    pairs, blocks = lm.text_counts(tokens, kind)[:2]
    model = lm.fit_all(tokens, kind, pairs, blocks)
    flat = lm.Model.start()
    flat.t["pair"] = lm.bigram_scores(pairs)
    into, goal = lm._blocks(np.array(text(0)))
    assert model.log10(into, goal).mean() > flat.log10(into, goal).mean() + 0.15


def test_lm_pairs_across_blanks(spark):
    texts = ["the one of the other the one", "", "of", "the one"] * 3
    ids = [lm.subword_ids(lm.words_of(t.encode())) for t in texts]
    plain = np.bincount([i for t in ids for i in (*t, lm.END)], minlength=lm.VOCABULARY)
    kind, share = lm.classes_of(plain)
    slot = lm.slots_of(plain)
    pairs = Counter(x for t in ids for x in zip([lm.END, *t], [*t, lm.END]))
    table = lm.text_counts(stored(spark, ids), kind, slot)[2]
    back = {int(slot[i]): i for i in np.flatnonzero(slot >= 0).tolist()}
    assert {(back[i], back[j]): int(table[i, j]) for i, j in np.argwhere(table)} == pairs
    the, one = lm.subword_ids([b"the", b"one"])
    assert pairs[the, one] == 9  # no word holds both, so the word table has no such pair


def test_substring_check_is_not_a_function_of_the_hash():
    joined = b"a b c d a b e f"
    found = substring_dedup.Pieces(substring_dedup.word_hashes(joined), 2, 4)
    check = substring_dedup.Pieces(np.zeros(8, np.uint64), 2, 4).check(joined, np.arange(7))  # all hashes collide
    assert check[0] == check[4] and len(set(check.tolist())) == 6
    assert (found.check(joined, np.arange(7)) == check).all()
    p, base = substring_dedup._PRIME, substring_dedup._CHECK_BASE
    words = b"zebra \xc3\xa9t\xc3\xa9".split()
    want = [(sum((b + 1) * pow(base, i, p) for i, b in enumerate(w)) + len(w)) % p for w in words]
    assert substring_dedup.check_hashes(b" ".join(words)).tolist() == want


def test_simhash_bins_follow_the_rows_of_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)
    monkeypatch.setattr(simhash, "BIN_ROWS", 256)
    fps = spark.range(600).select((F.col("id") * 2 ** 50).alias("fp"))  # all meet under keys without the high bits
    plan = simhash.links(fps, 600, 4)._jdf.queryExecution().analyzed().toString()
    bins = int(re.search(r"pmod\(xxhash64\(11, key#\d+L, 42\), cast\((\d+) as bigint\)\)", plan)[1])
    assert bins > 10 * 600 * 5 // 256


def test_simhash_keeps_the_right_rows_without_unique_ids(spark):
    a, b, c = (" ".join(f"w{x}" for x in np.random.default_rng(k).integers(0, 10**6, 100)) for k in (801, 802, 803))
    rows = [(1, a), *[(2, t) for t in (a, b)], *[(None, c)] * 5, (None, a), (None, c + " "), (3, None), (None, "")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k int").repartition(7, "k")
    kept = sorted((r.doc_id or 0, (r.text or "").strip()) for r in simhash.keep_one(docs).collect())
    assert kept == sorted([(0, c), (1, a), (2, b), (3, "")])


@pytest.mark.parametrize("rare", [0.006, 0.015])
def test_decision_list_finds_a_rare_kind_at_a_tail(spark, rare):
    rng = np.random.default_rng(5)
    n, bad = 6000, int(6000 * rare)
    x = np.concatenate((rng.normal(5, 0.3, n - bad), rng.uniform(8, 9, bad)))
    y = rng.normal(0, 1, n)
    rows = [(i, float(u), float(v), int(i >= n - bad)) for i, (u, v) in enumerate(zip(x, y))]
    data = spark.createDataFrame(rows, "doc_id long, x double, y double, bad int")
    rules = quality.learn(data, ["x", "y"])
    hit = quality.rejects(rules, {"x": F.col("x"), "y": F.col("y")}).isNotNull()
    got = data.agg(F.sum((hit & (F.col("bad") == 1)).cast("int")), F.sum((hit & (F.col("bad") == 0)).cast("int"))).first()
    assert got[0] >= bad - 1 and got[1] <= 2, rules


def test_decision_list_goes_on_after_a_failed_rule_and_ends_on_noise(spark):
    rng = np.random.default_rng(8)
    x, y, z = rng.uniform(0, 1, 6000), rng.uniform(0, 1, 6000), rng.uniform(0, 1, 6000)
    bad = (x > 0.5) & (rng.uniform(0, 1, 6000) < 0.3) | (z > 0.995)  # the first kind is nowhere more than half
    rows = [(i, float(a), float(b), float(c), int(d)) for i, (a, b, c, d) in enumerate(zip(x, y, z, bad))]
    data = spark.createDataFrame(rows, "doc_id long, x double, y double, z double, bad int")
    rules = quality.learn(data, ["x", "y", "z"])
    assert any(c.feature == "z" for r in rules for c in r), rules
    noise = spark.createDataFrame([(i, float(a), int(b < 0.2)) for i, (a, b) in enumerate(zip(x, y))], "doc_id long, x double, bad int")
    assert quality.learn(noise, ["x"]) == []
