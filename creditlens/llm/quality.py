"""Quality rules as a learned decision list, DataFrame operations only.

Text statistics are native column expressions.  Sequential covering learns an
ordered list of threshold conjunctions from labelled statistics: each rule is
grown by the condition with the best information gain on two thirds of the
labelled rows, pruned back to the prefix that does best on the other third,
and the rows it covers are set aside, also when it fails pruning.  Cut points
are the quantiles of the rows that the growing rule still covers, so a rare
kind at the tail of a feature is told apart step by step.  A rule ends when
a condition saves fewer bits of the labels than naming it costs, and learning
when that holds for the first one.  Every step is two aggregates over the labelled table (the cut points, and at most
features x THRESHOLDS result rows), so all labels count.  The list becomes one chain of Spark ``when`` expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import BLANKS, store, word_array
from creditlens.session import checkpoint_dir

SYMBOLS = "[#*$%&|<>]"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Candidate cut points of a feature (its quantiles).
THRESHOLDS = 32
MIN_COVER = 5


def with_statistics(docs: DataFrame, text_col: str = "text", into: str = "stats") -> DataFrame:
    """``docs`` plus one struct column of STATS (longs); a null text has none of anything."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    n = F.size("_w")
    windows = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))).otherwise(
        F.array().cast("array<bigint>"))
    # only texts with a repeated window are sorted: (hash, position) neighbours of equal hash, then the
    # positions in order, each covering up to the next flagged window
    ordered = F.when(F.size(F.array_distinct("_h")) < F.size("_h"),
                     F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    flagged = F.sort_array(F.transform(F.filter("_o", lambda x, j: (
        F.coalesce(F.get("_o", j - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("_o", j + 1)["h"] == x["h"], F.lit(False)))), lambda x: x["i"]))
    covered = F.aggregate(
        F.transform("_p", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_p", j + 1) - p, F.lit(3)))),
        F.lit(0), lambda acc, x: acc + x)
    out = (docs.withColumn("_w", word_array(F.col(text_col))).withColumn("_l", lines)
           .withColumn("_h", windows).withColumn("_o", ordered).withColumn("_p", flagged))
    values = [n, F.char_length(F.concat_ws("", "_w")), F.regexp_count(text, F.lit(SYMBOLS)),
              F.size("_l") - F.size(F.array_distinct("_l")), F.coalesce(covered, F.lit(0))]
    return out.withColumn(into, F.struct(*[v.cast("long").alias(c) for c, v in zip(STATS, values)])).drop(
        "_w", "_l", "_h", "_o", "_p")


def base_failed(stats: str = "stats") -> Column:
    s = F.col(stats)
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def features(stats: str = "stats") -> dict[str, Column]:
    """What rules may test: numbers per word, 0 for a text without words."""
    s = F.col(stats)
    per_word = lambda c: F.coalesce(F.try_divide(s[c].cast("double"), s["n_words"]), F.lit(0.0))
    return {"words": s["n_words"].cast("double"), "word_length": per_word("word_chars"),
            "symbols_per_word": per_word("n_symbols"), "dup_lines_per_word": per_word("n_dup_lines"),
            "repeat_share": per_word("n_repeat_words")}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def expr(self, columns: dict[str, Column]) -> Column:
        c = columns[self.feature]
        return c > self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def rejects(rules: list[Rule], columns: dict[str, Column]) -> Column:
    """The ordered list as one conditional expression: index of the first rule
    that holds (a rejection), null when none does."""
    chain = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules))):
        chain = F.when(_all(rule, columns), F.lit(k)).otherwise(chain)
    return chain


def _all(rule: Rule, columns: dict[str, Column]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.expr(columns)
    return out


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _bits(p: float, n: float, p0: float, n0: float) -> float:
    """What splitting ``p`` of ``p0`` bad and ``n`` of ``n0`` good rows off saves in coding the labels."""
    cost = lambda a, b: sum(-x * math.log2(x / (a + b)) for x in (a, b) if x)
    return cost(p0, n0) - cost(p, n) - cost(p0 - p, n0 - n)


def _best_condition(rows: DataFrame, names: list[str], p0: float, n0: float) -> tuple[float, Condition, float] | None:
    """The condition with the best gain over ``rows``, after its gain, and the
    bits it saves; cut points are quantiles of ``rows``, and
    thresholds lie halfway between the values on either side of a cut."""
    quantiles = [i / THRESHOLDS for i in range(1, THRESHOLDS)]
    cuts = rows.agg(*[F.percentile_approx(f, quantiles, 10000).alias(f) for f in names]).first()
    bins = {f: sum((F.col(f) > v).cast("int") for v in sorted(set(cuts[f] or []))) + F.lit(0) for f in names}
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), bins[f].alias("bin"), F.col(f).alias("v"))
                                for f in names])).alias("c")
    found = (rows.select("bad", cells).groupBy("c.f", "c.bin")
             .agg(F.sum("bad").alias("p"), F.count("*").alias("t"), F.min("c.v").alias("lo"), F.max("c.v").alias("hi"))
             .orderBy("f", "bin").collect())
    best = None
    for f in names:
        bins = [r for r in found if r["f"] == f]
        p = t = 0
        for a, b in zip(bins, bins[1:]):
            p, t = p + a["p"], t + a["t"]
            cut = (a["hi"] + b["lo"]) / 2
            for above, pos, neg in ((False, p, t - p), (True, p0 - p, n0 - (t - p))):
                if pos + neg >= MIN_COVER and (best is None or _gain(pos, neg, p0, n0) > best[0]):
                    best = (_gain(pos, neg, p0, n0), Condition(f, above, cut), _bits(pos, neg, p0, n0))
    return best


def learn(labelled: DataFrame, names: list[str], key: str = "doc_id") -> list[Rule]:
    """Decision list from ``labelled``: double columns ``names``, ``bad`` (0/1)
    and a key that only decides the growing / pruning parts.  No rows, or no
    bad ones: no rules."""
    checkpoint_dir(labelled.sparkSession)
    rows = labelled.select(
        *names, F.col("bad").cast("int").alias("bad"),
        (F.pmod(F.xxhash64(F.lit(3), F.col(key)), F.lit(3)) > 0).alias("grow")).checkpoint(eager=True)
    columns = {f: F.col(f) for f in names}
    least = math.log2(2 * THRESHOLDS * len(names))  # bits to name one of the conditions
    rules: list[Rule] = []
    aside: list[Rule] = []  # all rules, those that failed pruning too
    while True:
        left = rows.where(rejects(aside, columns).isNull()) if aside else rows
        growing, rule = left.where("grow"), ()
        p, t = growing.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.count("*")).first()
        while p and p < t:
            best = _best_condition(growing, names, p, t - p)
            if best is None or best[0] <= 1e-9 or best[2] <= least:
                break
            rule = (*rule, best[1])
            growing = growing.where(best[1].expr(columns))
            p, t = growing.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.count("*")).first()
        if not rule:
            break
        # prune: the prefix with the best (bad - good) / (bad + good) on the rows not grown on
        counts = left.where("not grow").agg(*[
            F.coalesce(F.sum(F.when(_all(rule[:k], columns), v)), F.lit(0))
            for k in range(1, len(rule) + 1) for v in (F.col("bad"), F.lit(1))]).first()
        worth = [((2 * counts[2 * k] - counts[2 * k + 1]) / max(1, counts[2 * k + 1]), -k) for k in range(len(rule))]
        value, k = max(worth)
        if value > 0:
            rule = rule[: 1 - k]
            rules.append(rule)
        aside.append(rule)
    return rules


def judge(judged: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", stats: str = "stats") -> list[Rule]:
    """Learn from the labelled rows that pass the base.  A document labelled
    more than once is bad if any label says so; null ids and labels are left out."""
    if labels is None:
        return []
    marks = (labels.where("doc_id is not null and quality is not null")
             .groupBy(F.col("doc_id").alias("_label_id")).agg(F.min("quality").alias("_quality")))
    names = list(features(stats))
    rows = (judged.where(~base_failed(stats)).select(F.col(id_col).alias("_id"), stats)
            .join(marks, F.col("_id") == F.col("_label_id"))
            .select(F.col("_id"), (F.col("_quality") == 0).alias("bad"),
                    *[c.alias(f) for f, c in features(stats).items()]))
    return learn(rows, names, key="_id")


def score(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, STATS, ``base_failed``, ``kept``, ``rule`` (text of the rule
    that rejected, else null), one row per input row.  Null, empty and blank
    texts fail the base.  Other columns of ``docs`` are ignored."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = store(with_statistics(rows).select("doc_id", "stats"), "quality-stats")
    rules = judge(rows, labels)
    hit = rejects(rules, features())
    texts = F.array(*[F.lit(" and ".join(map(str, r))) for r in rules]).cast("array<string>")
    return rows.select("doc_id", *[F.col("stats")[c].alias(c) for c in STATS], base_failed().alias("base_failed"),
                       (~base_failed() & hit.isNull()).alias("kept"), F.get(texts, hit).alias("rule"))


def keep_good(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`score` keeps, same columns."""
    rows = store(with_statistics(docs, text_col, "_quality_stats"), "quality-docs")
    rules = judge(rows, labels, id_col, "_quality_stats")
    good = ~base_failed("_quality_stats") & rejects(rules, features("_quality_stats")).isNull()
    return rows.where(good).select(*docs.columns)
