"""Rule queries over the user table: risk flags, segments, quotas, proxies,
macro features, credit-line rules, dataset initialisation, sampling, splits
and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions import rules as R
from creditlens.operators import metrics as M
from creditlens.operators import prepare as P
from creditlens.operators import sampling as S
from creditlens.operators.scoring import CLI_FEATURES, add_macro, with_cli_features
from creditlens.plans import oracle_master as OM
from creditlens.plans import sqlparts as Q
from creditlens.plans.registry import query, r6, r6s, scored_view, sig, sigs, user_view

DC12, DC24 = "payment_hist_1_12_delinquency_count", "payment_hist_13_24_delinquency_count"

# ------------------------------------------------------------- risk flags


def _risk_a_sql() -> str:
    raw = (f"CAST((coalesce({DC12} > 3, false) OR coalesce({DC24} > 3, false) "
           f"OR coalesce(utilization_pct > 95 AND credit_score < 600, false)) AS INTEGER)")
    return OM.user_view_ctes() + f""",
r AS (SELECT user_id, {raw} AS risk_raw FROM um)
SELECT user_id, risk_raw, risk_flag FROM ({OM._quota_sql('r', 'risk_raw', 0.08, 42, 'risk_flag')})"""


@query("risk_flag_a", _risk_a_sql)
def risk_flag_a(spark, sf_dir):
    """RUL-05 + SMP-03: delinquency > 3 or util > 95 & score < 600, then
    topped up to 8 % by hash order."""
    u = user_view(spark, sf_dir).select("user_id", R.risk_rule_a(DC12, DC24, "utilization_pct", "credit_score")
                                        .alias("risk_raw"))
    return S.flag_top_up(u.withColumn("risk_flag", F.col("risk_raw")), "risk_flag", ["user_id"], 0.08, 42)


def _risk_b_sql() -> str:
    return OM.user_view_ctes() + f""",
r0 AS (SELECT user_id, CAST(coalesce(try_cast({DC12} AS DOUBLE), 0) > 1 AS INTEGER) AS delinquency_12mo,
              CAST(coalesce(try_cast({DC24} AS DOUBLE), 0) > 1 AS INTEGER) AS delinquency_24mo,
              CAST(coalesce(try_cast(has_fraud AS DOUBLE), 0) AS INTEGER) AS has_fraud,
              coalesce(utilization_pct, 50.0) AS u, coalesce(credit_score, 680.0) AS s FROM um),
r AS (SELECT user_id, delinquency_12mo, delinquency_24mo, has_fraud,
             CAST((delinquency_12mo = 1 OR delinquency_24mo = 1 OR has_fraud = 1) OR (u > 85 AND s < 650) AS INTEGER)
                 AS risk_raw FROM r0)
SELECT user_id, delinquency_12mo, delinquency_24mo, has_fraud, risk_raw, risk_flag
FROM ({OM._quota_sql('r', 'risk_raw', 0.15, 42, 'risk_flag')})"""


@query("risk_flag_b", _risk_b_sql)
def risk_flag_b(spark, sf_dir):
    """RUL-04 (> 1) + RUL-06 + SMP-03 (15 %)."""
    u = user_view(spark, sf_dir)
    d = u.select("user_id",
                 (F.coalesce(F.expr(f"try_cast({DC12} as double)"), F.lit(0.0)) > 1).cast("int").alias("delinquency_12mo"),
                 (F.coalesce(F.expr(f"try_cast({DC24} as double)"), F.lit(0.0)) > 1).cast("int").alias("delinquency_24mo"),
                 R.numeric_flag("has_fraud").alias("has_fraud"), "utilization_pct", "credit_score")
    d = d.withColumn("risk_raw", R.risk_rule_b("delinquency_12mo", "delinquency_24mo", "has_fraud",
                                               "utilization_pct", "credit_score"))
    d = d.withColumn("risk_flag", F.col("risk_raw"))
    return S.flag_top_up(d, "risk_flag", ["user_id"], 0.15, 42).drop("utilization_pct", "credit_score")


def _risk_c_sql() -> str:
    return OM.user_view_ctes() + f""",
r AS (SELECT user_id, CAST((delinquency_12mo = 1 OR delinquency_24mo = 1 OR coalesce(has_fraud, 0) = 1)
                         OR (coalesce(utilization_pct, 50.0) > 90 AND coalesce(credit_score, 680.0) < 620) AS INTEGER)
                 AS risk_raw FROM um)
SELECT user_id, risk_raw, risk_flag FROM ({OM._quota_sql('r', 'risk_raw', 0.15, 42, 'risk_flag')})"""


@query("risk_flag_c", _risk_c_sql)
def risk_flag_c(spark, sf_dir):
    """RUL-07 + SMP-03 (15 %) on the master delinquency flags."""
    u = user_view(spark, sf_dir)
    d = u.select("user_id", R.risk_rule_c("delinquency_12mo", "delinquency_24mo",
                                          F.coalesce(F.col("has_fraud"), F.lit(0.0)),
                                          "utilization_pct", "credit_score").alias("risk_raw"))
    return S.flag_top_up(d.withColumn("risk_flag", F.col("risk_raw")), "risk_flag", ["user_id"], 0.15, 42)


def _risk_d_sql() -> str:
    return OM.user_view_ctes() + f""",
r AS (SELECT user_id, CAST(coalesce(delinquency_12mo = 1 OR delinquency_24mo = 1, false) AS INTEGER) AS risk_raw FROM um)
SELECT user_id, risk_raw, risk_flag FROM ({OM._quota_sql('r', 'risk_raw', 0.08, 42, 'risk_flag')})"""


@query("risk_flag_d", _risk_d_sql)
def risk_flag_d(spark, sf_dir):
    """RUL-08: either delinquency flag (``risk_raw`` = variant E, no quota),
    then topped up to 8 % (variant D)."""
    u = user_view(spark, sf_dir)
    d = u.select("user_id", R.risk_rule_d("delinquency_12mo", "delinquency_24mo").alias("risk_raw"))
    return S.flag_top_up(d.withColumn("risk_flag", F.col("risk_raw")), "risk_flag", ["user_id"], 0.08, 42)


def _quota_q_sql() -> str:
    return OM.user_view_ctes() + f""",
r AS (SELECT user_id, CAST(coalesce(delinquency_12mo = 1 OR delinquency_24mo = 1, false) AS INTEGER) AS flagged FROM um)
SELECT user_id, flagged AS before_quota, after_quota FROM ({OM._quota_sql('r', 'flagged', 0.15, 7, 'after_quota')})"""


@query("quota_topup", _quota_q_sql)
def quota_topup(spark, sf_dir):
    """SMP-03 alone: top a flag up to 15 % with seed 7."""
    u = user_view(spark, sf_dir)
    d = u.select("user_id", R.risk_rule_d("delinquency_12mo", "delinquency_24mo").alias("before_quota"))
    out = S.flag_top_up(d.withColumn("after_quota", F.col("before_quota")), "after_quota", ["user_id"], 0.15, 7)
    return out


def _seg_sql() -> str:
    return OM.user_view_ctes() + f"""
SELECT user_id, {Q.segment_a_sql()} AS segment_a,
       {Q.segment_b_sql('coalesce(utilization_pct, 50.0)', 'coalesce(credit_score, 680.0)', 'risk_flag')} AS segment_b
FROM um"""


@query("segment_rules", _seg_sql)
def segment_rules(spark, sf_dir):
    """RUL-09 (master form) and RUL-10 (model form, fills 50 / 680) side by
    side on the same risk flag."""
    u = user_view(spark, sf_dir)
    return u.select("user_id", R.segment_a("utilization_pct", "credit_score", "risk_flag").alias("segment_a"),
                    R.segment_b(F.coalesce(F.col("utilization_pct"), F.lit(50.0)),
                                F.coalesce(F.col("credit_score"), F.lit(680.0)), "risk_flag").alias("segment_b"))


def _rebalance_c_sql() -> str:
    """SMP-04(c) twin: sequential steps (target segment t, source segment o)."""
    shares = S.TARGET_SHARES
    seg_b = Q.segment_b_sql('coalesce(utilization_pct, 50.0)', 'coalesce(credit_score, 680.0)', 'risk_flag')
    ctes = [f"st0 AS (SELECT user_id, {seg_b} AS segment_label FROM um)"]
    prev, k = "st0", 0
    for t in range(4):
        start = prev
        for o in [s for s in range(4) if s != t]:
            k += 1
            h = S.key_hash_sql(["user_id"], t * 100 + o)
            n = f"(SELECT count(*) FROM {prev})"
            cnt_t0 = f"(SELECT count(*) FILTER (WHERE segment_label = {t}) FROM {start})"
            cnt_t = f"(SELECT count(*) FILTER (WHERE segment_label = {t}) FROM {prev})"
            cnt_o = f"(SELECT count(*) FILTER (WHERE segment_label = {o}) FROM {prev})"
            qualifies = f"(CAST({cnt_t0} AS DOUBLE) / {n} < {shares[t]} * 0.5)"
            needed = f"(CAST(floor(CAST({n} AS DOUBLE) * {shares[t]}) AS BIGINT) - {cnt_t})"
            take = (f"(CASE WHEN {qualifies} AND CAST({cnt_o} AS DOUBLE) / {n} > {shares[o]} AND {needed} > 0 "
                    f"THEN CAST(floor(least({cnt_o} * 0.5, {needed})) AS BIGINT) ELSE 0 END)")
            ctes.append(f"""st{k} AS (SELECT user_id, CASE WHEN _rn <= {take} THEN {t} ELSE segment_label END AS segment_label
  FROM (SELECT p.*, CASE WHEN segment_label = {o} THEN row_number() OVER (PARTITION BY segment_label = {o} ORDER BY {h}) END AS _rn
        FROM {prev} p))""")
            prev = f"st{k}"
    return OM.user_view_ctes() + ",\n" + ",\n".join(ctes) + f"""
SELECT s0.user_id, s0.segment_label AS segment_before, s.segment_label AS segment_after
FROM st0 s0 JOIN {prev} s ON s.user_id = s0.user_id"""


@query("segment_rebalance", _rebalance_c_sql)
def segment_rebalance(spark, sf_dir):
    """RUL-11 + SMP-04(c): a segment under half its target share receives
    its shortfall from segments above their own target (at most half of
    each); the move plan is computed on the 4-row count table and each move
    takes the smallest-hash rows of the source segment."""
    u = user_view(spark, sf_dir)
    d = u.select("user_id", R.segment_b(F.coalesce(F.col("utilization_pct"), F.lit(50.0)),
                                        F.coalesce(F.col("credit_score"), F.lit(680.0)), "risk_flag")
                 .alias("segment_before"))
    d = d.withColumn("segment_label", F.col("segment_before")).checkpoint(eager=True)
    out = S.rebalance_under_half(d, "segment_label", ["user_id"])
    return out.withColumnRenamed("segment_label", "segment_after")


def _rebalance_small_ctes(st0: str) -> tuple[list[str], str]:
    """SMP-04(b) twin over ``st0`` (user_id, segment_label): donors of each
    target in the order of their size before any move.  CTEs and the last one's name."""
    shares = S.TARGET_SHARES
    ctes = [f"st0 AS ({st0})", "c0 AS (SELECT segment_label AS seg, count(*) AS c FROM st0 GROUP BY 1)"]
    prev, k = "st0", 0
    for t in range(4):
        start = prev
        for r in range(3):
            k += 1
            donor = f"(SELECT seg FROM c0 WHERE seg <> {t} ORDER BY c DESC, seg LIMIT 1 OFFSET {r})"
            n = "(SELECT count(*) FROM st0)"
            small = f"(coalesce((SELECT c FROM c0 WHERE seg = {t}), 0) / CAST({n} AS DOUBLE) * 100 < 5.0)"
            came = (f"((SELECT count(*) FILTER (WHERE segment_label = {t}) FROM {prev})"
                    f" - (SELECT count(*) FILTER (WHERE segment_label = {t}) FROM {start}))")
            half = f"(SELECT count(*) FILTER (WHERE segment_label = d.seg) // 2 FROM {prev})"
            ctes.append(f"""d{k} AS (SELECT seg, CASE WHEN {small} THEN greatest(0, least({half},
      CAST(floor({n} * CAST({shares[t]} AS DOUBLE)) AS BIGINT) - {came})) ELSE 0 END AS take FROM (SELECT {donor} AS seg) d)""")
            ctes.append(f"""st{k} AS (SELECT user_id, CASE WHEN _in AND _rn <= (SELECT take FROM d{k}) THEN {t} ELSE segment_label END AS segment_label
  FROM (SELECT p.*, coalesce(segment_label = (SELECT seg FROM d{k}), false) AS _in,
               row_number() OVER (PARTITION BY coalesce(segment_label = (SELECT seg FROM d{k}), false)
                 ORDER BY md5(CAST(user_id AS VARCHAR) || '|' || CAST({t} * 100 + (SELECT seg FROM d{k}) AS VARCHAR))) AS _rn
        FROM {prev} p))""")
            prev = f"st{k}"
    return ctes, prev


def _rebalance_small_sql() -> str:
    seg_b = Q.segment_b_sql('coalesce(utilization_pct, 50.0)', 'coalesce(credit_score, 680.0)', 'risk_flag')
    ctes, last = _rebalance_small_ctes(f"SELECT user_id, {seg_b} AS segment_label FROM um")
    return OM.user_view_ctes() + ",\n" + ",\n".join(ctes) + f"""
SELECT s0.user_id, s0.segment_label AS segment_before, s.segment_label AS segment_after
FROM st0 s0 JOIN {last} s ON s.user_id = s0.user_id"""


@query("segment_rebalance_small", _rebalance_small_sql)
def segment_rebalance_small(spark, sf_dir):
    """SMP-04(b): a segment that starts below 5 % receives its target share
    from the others, largest first, at most half of each."""
    u = user_view(spark, sf_dir)
    d = u.select("user_id", R.segment_b(F.coalesce(F.col("utilization_pct"), F.lit(50.0)),
                                        F.coalesce(F.col("credit_score"), F.lit(680.0)), "risk_flag")
                 .alias("segment_before"))
    d = d.withColumn("segment_label", F.col("segment_before")).checkpoint(eager=True)
    out = S.rebalance_small_segments(d, "segment_label", ["user_id"])
    return out.withColumnRenamed("segment_label", "segment_after")


def _proxy_sql() -> str:
    return OM.user_view_ctes() + f"\nSELECT user_id, {Q.risk_probability_sql()} AS risk_probability FROM um"


@query("risk_proxy", _proxy_sql)
def risk_proxy(spark, sf_dir):
    """RUL-12: risk probability proxy with hash noise."""
    u = user_view(spark, sf_dir)
    return u.select("user_id", R.risk_probability_proxy("risk_flag", "credit_score", "utilization_pct", "user_id")
                    .alias("risk_probability"))


# ------------------------------------------------------- macro and CLI rules

def _macro_sql() -> str:
    return OM.scored_ctes() + """
SELECT user_id, (1.1 + (CASE WHEN credit_score < 300 THEN 300 WHEN credit_score > 850 THEN 850 ELSE credit_score END
                         - 300) / 550 * 0.3) AS score_multiplier,
       economic_factor, seasonal_index, spending_elasticity, q4_adjustment_factor,
       holiday_spending_multiplier, holiday_spending_power
FROM scored"""


@query("macro_features", _macro_sql)
def macro_features(spark, sf_dir):
    """RUL-13 + RUL-14 (the multiplier is overwritten with 1.25 after the
    adjustment factor used the score-based value)."""
    u = user_view(spark, sf_dir)
    m = R.macro_features()
    return add_macro(u).select("user_id", m["holiday_spending_multiplier"].alias("score_multiplier"),
                               "economic_factor", "seasonal_index", "spending_elasticity", "q4_adjustment_factor",
                               "holiday_spending_multiplier", "holiday_spending_power")


def _cts_sql() -> str:
    k = ("(CASE WHEN segment_label = 0 AND is_high_income = 1 THEN 2.0 WHEN segment_label = 1 AND is_high_income = 1 "
         "THEN 1.5 WHEN segment_label = 0 THEN 1.5 WHEN segment_label = 1 THEN 1.2 END)")
    return OM.user_view_ctes() + f""",
f AS (SELECT user_id, segment_label, is_high_income, credit_line, total_spend_2024 * 0.3 AS spend_Q4_2024,
             total_spend_2024 * 0.3 * 1.05 AS predicted_q4_spend FROM um)
SELECT user_id, spend_Q4_2024, predicted_q4_spend,
       CASE WHEN {k} IS NOT NULL THEN greatest(0.0, {k} * predicted_q4_spend - credit_line * 1000) ELSE 0.0 END
           AS CLI_target_amount
FROM f"""


@query("cli_target_spend", _cts_sql)
def cli_target_spend(spark, sf_dir):
    """RUL-15 + RUL-16: Q4 proxy (0.3 x annual), baseline forecast (x 1.05)
    and the spend-based increase target."""
    u = user_view(spark, sf_dir)
    q4 = F.col("total_spend_2024") * 0.3
    d = u.select("user_id", "segment_label", "is_high_income", "credit_line", q4.alias("spend_Q4_2024"),
                 (q4 * 1.05).alias("predicted_q4_spend"))
    return d.select("user_id", "spend_Q4_2024", "predicted_q4_spend",
                    R.cli_target_spend("segment_label", "predicted_q4_spend", "credit_line", "is_high_income")
                    .alias("CLI_target_amount"))


# master columns as the preparation meets them: without labels, with gaps
_RAW_USERS = {
    "utilization_pct": ("CASE WHEN user_id % 29 = 0 THEN NULL ELSE utilization_pct END",
                        lambda: F.when(F.col("user_id") % 29 != 0, F.col("utilization_pct"))),
    "credit_score": ("CASE WHEN user_id % 17 = 0 THEN NULL ELSE credit_score END",
                     lambda: F.when(F.col("user_id") % 17 != 0, F.col("credit_score"))),
}
_PREPARED = ("spend_Q4_2024 delinquency_12mo delinquency_24mo has_fraud utilization_pct credit_score risk_flag segment_label "
             "predicted_q4_spend CLI_target_amount").split()


def _prepared_sql() -> str:
    k = ("(CASE WHEN segment_label = 0 AND is_high_income = 1 THEN 2.0 WHEN segment_label = 1 AND is_high_income = 1 "
         "THEN 1.5 WHEN segment_label = 0 THEN 1.5 WHEN segment_label = 1 THEN 1.2 END)")
    raw = ", ".join(f"coalesce({sql}, {fill}) AS {c}" for (c, (sql, _)), fill in zip(_RAW_USERS.items(), ("50.0", "680.0")))
    ctes, last = _rebalance_small_ctes(f"SELECT user_id, {Q.segment_b_sql('utilization_pct', 'credit_score', 'risk_flag')} AS segment_label FROM pq")
    return OM.user_view_ctes() + f""",
p0 AS (SELECT user_id, is_high_income, credit_line, total_spend_2024 * 0.3 AS spend_Q4_2024,
              CAST(coalesce({DC12}, 0) > 1 AS INTEGER) AS delinquency_12mo, CAST(coalesce({DC24}, 0) > 1 AS INTEGER) AS delinquency_24mo,
              CAST(coalesce(has_fraud, 0) AS INTEGER) AS has_fraud, {raw} FROM um),
p1 AS (SELECT *, CAST((delinquency_12mo = 1 OR delinquency_24mo = 1 OR has_fraud = 1) OR (utilization_pct > 85 AND credit_score < 650)
                      AS INTEGER) AS risk_raw FROM p0),
pq AS ({OM._quota_sql('p1', 'risk_raw', 0.15, 42, 'risk_flag')}),
""" + ",\n".join(ctes) + f""",
pl AS (SELECT pq.*, s.segment_label, spend_Q4_2024 * 1.05 AS predicted_q4_spend FROM pq JOIN {last} s ON s.user_id = pq.user_id)
SELECT user_id, {', '.join(_PREPARED[:-1])},
       CASE WHEN {k} IS NOT NULL THEN greatest(0.0, {k} * predicted_q4_spend - credit_line * 1000) ELSE 0.0 END AS CLI_target_amount
FROM pl"""


@query("prepared_targets", _prepared_sql)
def prepared_targets(spark, sf_dir):
    """RUL-04/06/10/11/15/16 + SMP-03/04(b) in one chain: the targets of a user
    table that has neither flags nor labels and misses some values."""
    u = user_view(spark, sf_dir).drop("risk_flag", "segment_label", "delinquency_12mo", "delinquency_24mo", "risk_probability")
    raw = u.withColumns({c: value() for c, (_, value) in _RAW_USERS.items()}).checkpoint(eager=True)
    return P.prepare_targets(raw).select("user_id", *_PREPARED)


def _ctl_sql() -> str:
    return OM.user_view_ctes() + """
SELECT user_id, CASE WHEN segment_label = 0 AND is_high_income = 1 THEN credit_line * 750
                     WHEN segment_label = 1 AND is_high_income = 1 THEN credit_line * 375
                     WHEN segment_label = 0 THEN credit_line * 500 WHEN segment_label = 1 THEN credit_line * 250
                     ELSE 0.0 END AS CLI_target_amount
FROM um"""


@query("cli_target_line", _ctl_sql)
def cli_target_line(spark, sf_dir):
    """RUL-17: line-based increase target."""
    u = user_view(spark, sf_dir)
    return u.select("user_id", R.cli_target_line("segment_label", "credit_line", "is_high_income")
                    .alias("CLI_target_amount"))


def _pct_sql() -> str:
    return OM.user_view_ctes() + f"""
SELECT user_id, {Q.max_cli_pct_sql()} AS max_cli_percentage,
       credit_line * 1000 * {Q.max_cli_pct_sql()} AS max_cli_amount FROM um"""


@query("cli_max_pct", _pct_sql)
def cli_max_pct(spark, sf_dir):
    """RUL-18 + RUL-20: tiered maximum increase share and amount."""
    u = user_view(spark, sf_dir)
    pct = R.max_cli_pct("segment_label", "credit_score", "is_high_income")
    return u.select("user_id", pct.alias("max_cli_percentage"),
                    (F.col("credit_line") * 1000 * pct).alias("max_cli_amount"))


def _cli_features_sql() -> str:
    line = "(credit_line * 1000)"

    def rg(a, b):
        return f"(CASE WHEN coalesce(CASE WHEN {a} <> 0 THEN {b} / {a} END, 1.0) < 0 THEN 0.0 " \
               f"WHEN coalesce(CASE WHEN {a} <> 0 THEN {b} / {a} END, 1.0) > 5 THEN 5.0 " \
               f"ELSE coalesce(CASE WHEN {a} <> 0 THEN {b} / {a} END, 1.0) END)"
    return OM.scored_ctes() + f""",
e0 AS (SELECT * EXCLUDE (max_cli_percentage) FROM scored WHERE segment_label IN (0, 1)),
e1 AS (SELECT *, CASE WHEN {line} <> 0 THEN total_spend_2024 / {line} END AS spend_to_limit_ratio,
              {line} * (1.0 - utilization_pct / 100) AS available_credit,
              CAST(credit_score >= 750 AS INTEGER) AS is_excellent_credit,
              CAST(credit_score >= 700 AND credit_score < 750 AS INTEGER) AS is_good_credit,
              CAST(credit_score >= 650 AND credit_score < 700 AS INTEGER) AS is_fair_credit,
              CAST(credit_score < 650 AS INTEGER) AS is_poor_credit,
              {rg('spend_2024_q1', 'spend_2024_q2')} AS q2_q1_growth,
              {rg('spend_2024_q2', 'spend_2024_q3')} AS q3_q2_growth,
              {rg('spend_2024_q3', 'spend_2024_q4')} AS q4_q3_growth,
              (1.0 - risk_probability) * credit_score / 850 * credit_line * 1000 * 0.25 AS risk_adjusted_cli_potential,
              CAST(segment_label = 0 AS INTEGER) AS is_segment_0, CAST(segment_label = 1 AS INTEGER) AS is_segment_1,
              is_high_income * credit_line * 1000 * 0.05 AS high_income_cli_potential,
              {Q.max_cli_pct_sql()} AS max_cli_percentage
       FROM e0),
e2 AS (SELECT *, CASE WHEN {line} <> 0 THEN available_credit / {line} END AS available_credit_ratio,
              0.2 * q2_q1_growth + 0.3 * q3_q2_growth + 0.5 * q4_q3_growth AS growth_trajectory,
              CASE WHEN predicted_q4_spend - available_credit < 0 THEN 0.0 ELSE predicted_q4_spend - available_credit END
                  AS projected_headroom_needed,
              is_segment_0 * total_spend_2024 AS segment0_spend, is_segment_1 * total_spend_2024 AS segment1_spend,
              is_high_income * is_segment_0 AS high_income_seg0, is_high_income * is_segment_1 AS high_income_seg1,
              CAST(is_excellent_credit = 1 AND utilization_pct > 40 AND utilization_pct < 80 AND is_high_income = 1
                   AND risk_probability < 0.2 AS INTEGER) AS prime_cli_candidate
       FROM e1),
e3 AS (SELECT *, prime_cli_candidate * credit_line * 1000 * 0.10 AS high_tier_cli_potential FROM e2)
SELECT user_id, {', '.join(CLI_FEATURES[:-1])},
       0.3 * max_cli_percentage * credit_line * 1000 + 0.2 * high_income_cli_potential
       + 0.3 * high_tier_cli_potential + 0.2 * projected_headroom_needed AS cli_recommendation_score
FROM e3"""


@query("cli_features", _cli_features_sql)
def cli_features(spark, sf_dir):
    """FLT-05 + RUL-19: the 24 increase features for eligible users."""
    e = scored_view(spark, sf_dir).filter(F.col("segment_label").isin(0, 1)).drop("max_cli_percentage")
    return with_cli_features(e).select("user_id", *CLI_FEATURES)


def _post_sql() -> str:
    k = ("(CASE WHEN segment_label = 0 AND is_high_income = 1 THEN 2.0 WHEN segment_label = 1 AND is_high_income = 1 "
         "THEN 1.5 WHEN segment_label = 0 THEN 1.5 WHEN segment_label = 1 THEN 1.2 END)")
    pred = f"(CASE WHEN {k} IS NOT NULL THEN greatest(0.0, {k} * predicted_q4_spend - credit_line * 1000) ELSE 0.0 END - 400.0)"
    post = Q.cli_postprocess_sql("candidate_amount", "credit_line", "max_cli_percentage",
                                 "segment_label IN (0, 1)", "is_high_income")
    return OM.scored_ctes() + f""",
c AS (SELECT user_id, segment_label, is_high_income, credit_line, max_cli_percentage, {pred} AS candidate_amount
      FROM scored)
SELECT user_id, candidate_amount, {post} AS recommended_cli_amount FROM c"""


@query("cli_postprocess", _post_sql)
def cli_postprocess(spark, sf_dir):
    """RUL-21 applied to a candidate amount (spend-based target - 400, so
    negative, small and capped values all occur)."""
    s = scored_view(spark, sf_dir)
    cand = R.cli_target_spend("segment_label", "predicted_q4_spend", "credit_line", "is_high_income") - 400.0
    c = s.select("user_id", "segment_label", "is_high_income", "credit_line", "max_cli_percentage",
                 cand.alias("candidate_amount"))
    return c.select("user_id", "candidate_amount", R.cli_postprocess(
        "candidate_amount", "credit_line", "max_cli_percentage", F.col("segment_label").isin(0, 1),
        "is_high_income").alias("recommended_cli_amount"))


# ------------------------------------------------- initialisation / impute

def injected_view(u):
    """The user table with missing / infinite / NaN / text values injected by
    key and some columns under alternative names (test convention)."""
    k, nan = F.col("user_id"), F.lit(float("nan"))
    return u.select(
        "user_id",
        F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, nan).otherwise(F.col("credit_score")).alias("credit_score"),
        F.when(k % 23 == 0, F.lit(0.0)).when(k % 37 == 0, nan).otherwise(F.col("credit_line")).alias("credit_line"),
        F.when(k % 29 == 0, F.lit(float("inf"))).when(k % 31 == 0, nan).otherwise(F.col("utilization_pct"))
        .alias("utilization_pct"),
        F.col("current_balance").alias("cur_balance"),
        F.when(k % 41 == 0, nan).otherwise(F.col("total_spend_2024")).alias("total_spend_2024"),
        F.when(k % 43 == 0, F.lit("NaN")).otherwise(F.col("spend_2024_q1").cast("string")).alias("spend_2024_q1"), "spend_2024_q2", "spend_2024_q3", "spend_2024_q4",
        "is_high_income",
        F.when(k % 3 == 0, "Yes").when(k % 3 == 1, "n").alias("fraud_flag"),
        F.col("delinquency_12mo").alias("delinq_12mo"), "delinquency_24mo", "risk_flag",
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("segment_label") + k % 5 - 2).alias("segment_label"),
        "risk_probability", DC12, DC24, "num_accounts",
    )


def _injected_sql() -> str:
    return OM.user_view_ctes() + f""",
inj AS (SELECT user_id, CASE WHEN user_id % 17 = 0 THEN NULL WHEN user_id % 19 = 0 THEN CAST('nan' AS DOUBLE)
                    ELSE credit_score END AS credit_score,
               CASE WHEN user_id % 23 = 0 THEN 0.0 WHEN user_id % 37 = 0 THEN CAST('nan' AS DOUBLE)
                    ELSE credit_line END AS credit_line,
               CASE WHEN user_id % 29 = 0 THEN CAST('inf' AS DOUBLE) WHEN user_id % 31 = 0 THEN CAST('nan' AS DOUBLE)
                    ELSE utilization_pct END AS utilization_pct,
               current_balance AS cur_balance,
               CASE WHEN user_id % 41 = 0 THEN CAST('nan' AS DOUBLE) ELSE total_spend_2024 END AS total_spend_2024,
               CASE WHEN user_id % 43 = 0 THEN 'NaN' ELSE CAST(spend_2024_q1 AS VARCHAR) END AS spend_2024_q1,
               spend_2024_q2, spend_2024_q3,
               spend_2024_q4, is_high_income,
               CASE WHEN user_id % 3 = 0 THEN 'Yes' WHEN user_id % 3 = 1 THEN 'n' END AS fraud_flag,
               delinquency_12mo AS delinq_12mo, delinquency_24mo, risk_flag,
               CASE WHEN user_id % 11 = 0 THEN NULL ELSE segment_label + user_id % 5 - 2 END AS segment_label,
               risk_probability, {DC12}, {DC24}, num_accounts
        FROM um)"""


INIT_OUT = ["user_id", "credit_score", "utilization_pct", "credit_line", "current_balance", "total_spend_2024",
            "avg_monthly_spend_2024", "is_high_income", "spend_2024_q1", "spend_2024_q2", "spend_2024_q3",
            "spend_2024_q4", "CLI_target_amount", "risk_probability", "has_fraud", "delinquency_12mo",
            "delinquency_24mo", "risk_flag", "segment_label"]


def _init_sql() -> str:
    def med(c, src):  # Spark's percentile interpolation
        return f"(SELECT q0 FROM ({Q.quantile_sql(src, c, [0.5])}))"
    def num(c):  # NaN, also as text, is missing
        return f"(CASE WHEN isnan(try_cast({c} AS DOUBLE)) THEN NULL ELSE try_cast({c} AS DOUBLE) END)"
    inf_null = "CASE WHEN isinf({c}) OR isnan({c}) THEN NULL ELSE {c} END"
    return _injected_sql() + f""",
i0 AS (SELECT *, current_balance AS _cb FROM (SELECT * EXCLUDE (cur_balance, fraud_flag, delinq_12mo),
              cur_balance AS current_balance, fraud_flag AS has_fraud, delinq_12mo AS delinquency_12mo,
              total_spend_2024 / 12 AS avg_monthly_spend_2024 FROM inj)),
i1 AS (SELECT *, CASE WHEN segment_label = 0 AND is_high_income = 1 THEN credit_line * 750
                      WHEN segment_label = 1 AND is_high_income = 1 THEN credit_line * 375
                      WHEN segment_label = 0 THEN credit_line * 500 WHEN segment_label = 1 THEN credit_line * 250
                      ELSE 0.0 END AS CLI_target_amount FROM i0),
i2 AS (SELECT user_id,
              coalesce({Q.clip_sql(num('credit_score'), 300.0, 850.0)}, 680.0) AS credit_score,
              coalesce({Q.clip_sql(num('utilization_pct'), 0.0, 100.0)}, 50.0) AS utilization_pct,
              coalesce({Q.clip_sql(num('credit_line'), 0.5, 100.0)}, 10.0) AS credit_line,
              {num('current_balance')} AS current_balance,
              {num('total_spend_2024')} AS total_spend_2024,
              {num('avg_monthly_spend_2024')} AS avg_monthly_spend_2024,
              {inf_null.format(c='try_cast(is_high_income AS DOUBLE)')} AS is_high_income,
              {num('spend_2024_q1')} AS spend_2024_q1, {num('spend_2024_q2')} AS spend_2024_q2,
              {num('spend_2024_q3')} AS spend_2024_q3, {num('spend_2024_q4')} AS spend_2024_q4,
              {inf_null.format(c='try_cast(CLI_target_amount AS DOUBLE)')} AS CLI_target_amount,
              {inf_null.format(c='try_cast(risk_probability AS DOUBLE)')} AS risk_probability,
              has_fraud, delinquency_12mo, delinquency_24mo, risk_flag, segment_label
       FROM i1),
i3 AS (SELECT * REPLACE ({Q.clip_sql('current_balance', 0.0, '(SELECT max(credit_line) * 1.2 FROM i2)')} AS current_balance)
       FROM i2)
SELECT user_id, credit_score, utilization_pct, credit_line,
       coalesce(current_balance, {med('current_balance', 'i3')}) AS current_balance,
       coalesce({Q.clip_sql('total_spend_2024', 0.0)}, 0.0) AS total_spend_2024,
       coalesce({Q.clip_sql('avg_monthly_spend_2024', 0.0)}, 0.0) AS avg_monthly_spend_2024,
       coalesce(is_high_income, {med('is_high_income', 'i3')}) AS is_high_income,
       coalesce({Q.clip_sql('spend_2024_q1', 0.0)}, 0.0) AS spend_2024_q1,
       coalesce({Q.clip_sql('spend_2024_q2', 0.0)}, 0.0) AS spend_2024_q2,
       coalesce({Q.clip_sql('spend_2024_q3', 0.0)}, 0.0) AS spend_2024_q3,
       coalesce({Q.clip_sql('spend_2024_q4', 0.0)}, 0.0) AS spend_2024_q4,
       coalesce(CLI_target_amount, {med('CLI_target_amount', 'i3')}) AS CLI_target_amount,
       coalesce(risk_probability, {med('risk_probability', 'i3')}) AS risk_probability,
       CAST(coalesce(lower(CAST(has_fraud AS VARCHAR)) IN ('y', 'yes', 'true', 't', '1'), false) AS INTEGER) AS has_fraud,
       CAST(coalesce(try_cast(delinquency_12mo AS DOUBLE), 0.0) AS INTEGER) AS delinquency_12mo,
       CAST(coalesce(try_cast(delinquency_24mo AS DOUBLE), 0.0) AS INTEGER) AS delinquency_24mo,
       CAST(coalesce(try_cast(risk_flag AS DOUBLE), 0.0) AS INTEGER) AS risk_flag,
       CAST(least(greatest(coalesce(CAST(segment_label AS DOUBLE), 2.0), 0.0), 3.0) AS INTEGER) AS segment_label
FROM i3"""


@query("initialize_dataset", _init_sql)
def initialize_dataset(spark, sf_dir):
    """RUL-22 + RUL-23 + PRJ-04/14/19/20/21/22 + RUL-17 on the injected user
    table: alias standardisation, reconstruction, line-based target,
    coercion, clip / fill rules, flag normalisation and label clipping."""
    out = P.initialise(injected_view(user_view(spark, sf_dir)))
    return out.select(*INIT_OUT)


IMPUTE_COLS = ["credit_score", "utilization_pct", "credit_line", "cur_balance", "num_accounts",
               DC12, DC24, "risk_probability"]


def _impute_sql() -> str:
    outs = []
    for c in IMPUTE_COLS:
        v = f"(CASE WHEN isinf(try_cast({c} AS DOUBLE)) OR isnan(try_cast({c} AS DOUBLE)) THEN NULL " \
            f"ELSE try_cast({c} AS DOUBLE) END)"
        if c.endswith("_count") or c.startswith("has_"):
            outs.append(f"coalesce({v}, 0.0) AS {c}")
        else:
            outs.append(f"coalesce({v}, coalesce((SELECT q0 FROM ({Q.quantile_sql('inj', v, [0.5])})), 0.0)) AS {c}")
    return _injected_sql() + f"\nSELECT user_id, {', '.join(outs)} FROM inj"


@query("impute_median", _impute_sql)
def impute_median(spark, sf_dir):
    """PRJ-22 + PRJ-23 (model form): inf -> missing; count-like names -> 0,
    others -> median from one aggregate row (0 if all missing)."""
    inj = injected_view(user_view(spark, sf_dir))
    return P.impute_model_features(inj, IMPUTE_COLS).select("user_id", *IMPUTE_COLS)


def _flags_sql() -> str:
    return _injected_sql() + """
SELECT user_id, fraud_flag,
       CAST(coalesce(lower(CAST(fraud_flag AS VARCHAR)) IN ('y', 'yes', 'true', 't', '1'), false) AS INTEGER) AS fraud_text_flag,
       CAST(coalesce(try_cast(delinq_12mo AS DOUBLE), 0.0) AS INTEGER) AS delinq_numeric_flag
FROM inj"""


@query("flag_normalise", _flags_sql)
def flag_normalise(spark, sf_dir):
    """PRJ-19: text flags by the true-word list, numeric flags coerced."""
    inj = injected_view(user_view(spark, sf_dir))
    return inj.select("user_id", "fraud_flag", R.text_flag("fraud_flag").alias("fraud_text_flag"),
                      R.numeric_flag("delinq_12mo").alias("delinq_numeric_flag"))


def _labels_sql() -> str:
    return _injected_sql() + """,
l AS (SELECT user_id, segment_label,
             CASE WHEN risk_flag = 1 THEN 'High_Risk' WHEN segment_label = 0 THEN 'Eligible_No_Risk'
                  WHEN segment_label = 1 THEN 'eligible_at_risk' WHEN segment_label = 2 THEN 'NO_INCREASE'
                  WHEN segment_label IS NULL THEN NULL ELSE 'other' END AS segment_text FROM inj)
SELECT user_id, segment_label AS segment_raw, segment_text,
       CAST(least(greatest(coalesce(CAST(segment_label AS DOUBLE), 2.0), 0.0), 3.0) AS INTEGER) AS segment_from_number,
       CASE lower(segment_text) WHEN 'eligible_no_risk' THEN 0 WHEN 'eligible_at_risk' THEN 1
            WHEN 'no_increase' THEN 2 WHEN 'high_risk' THEN 3 ELSE 2 END AS segment_from_text
FROM l"""


@query("label_map", _labels_sql)
def label_map(spark, sf_dir):
    """PRJ-20: numeric labels coerced / filled 2 / clipped to 0..3; text
    labels mapped by name with default 2."""
    inj = injected_view(user_view(spark, sf_dir))
    seg = F.col("segment_label")
    text = (F.when(F.col("risk_flag") == 1, "High_Risk").when(seg == 0, "Eligible_No_Risk")
            .when(seg == 1, "eligible_at_risk").when(seg == 2, "NO_INCREASE")
            .when(seg.isNull(), F.lit(None)).otherwise("other"))
    d = inj.select("user_id", seg.alias("segment_raw"), text.alias("segment_text"))
    return d.select("user_id", "segment_raw", "segment_text",
                    R.segment_from_number("segment_raw").alias("segment_from_number"),
                    R.segment_from_text("segment_text").alias("segment_from_text"))


def _alias_sql() -> str:
    return _injected_sql() + """
SELECT user_id, cur_balance AS current_balance, fraud_flag AS has_fraud, delinq_12mo AS delinquency_12mo,
       credit_line, credit_score FROM inj"""


@query("alias_columns", _alias_sql)
def alias_columns(spark, sf_dir):
    """PRJ-04: alternative spellings mapped to canonical names."""
    inj = injected_view(user_view(spark, sf_dir))
    std = P.standardise_aliases(inj)
    return std.select("user_id", "current_balance", "has_fraud", "delinquency_12mo", "credit_line", "credit_score")


def _req_sql() -> str:
    return _injected_sql() + """
SELECT c AS column_name, c IN ('is_high_income', 'delinquency_24mo', 'risk_flag', 'segment_label', 'risk_probability')
           AS present, (SELECT count(*) FROM inj) AS n_rows
FROM (VALUES ('is_high_income'), ('delinquency_12mo'), ('delinquency_24mo'), ('risk_flag'), ('segment_label'),
             ('risk_probability')) v(c)"""


@query("required_columns", _req_sql)
def required_columns(spark, sf_dir):
    """PRJ-05: which required columns the injected table holds (plan-time
    set difference), with its row count."""
    inj = injected_view(user_view(spark, sf_dir))
    return P.required_audit(inj).withColumn("n_rows", inj.select(F.count("*")).scalar())


# ------------------------------------------------- sampling and splitting

def _spg_sql() -> str:
    h = S.key_hash_sql(["user_id"], 42)
    return OM.user_view_ctes() + f"""
SELECT user_id, is_high_income FROM (
  SELECT user_id, is_high_income, row_number() OVER (PARTITION BY is_high_income ORDER BY {h}) AS rn FROM um)
WHERE rn <= 1000"""


@query("sample_per_group", _spg_sql)
def sample_per_group(spark, sf_dir):
    """SMP-01: 1000 users per income group (n = 1000, seed 42), smallest-hash order."""
    u = user_view(spark, sf_dir).select("user_id", "is_high_income")
    return S.sample_per_group(u, ["is_high_income"], ["user_id"], 1000, 42)


def _split_sql() -> str:
    return OM.user_view_ctes() + f"""
SELECT user_id, CAST({S.hash_fraction_sql(['user_id'], 42)} < 0.2 AS INTEGER) AS is_test,
       CAST({S.hash_fraction_sql(['user_id'], 43)} < 0.2 AS INTEGER) AS in_sample
FROM um"""


@query("hash_split", _split_sql)
def hash_split(spark, sf_dir):
    """ML-02 (80/20 split) + SMP-02 (20 % sample) as hash columns."""
    u = user_view(spark, sf_dir).select("user_id")
    return S.hash_split(u, ["user_id"], 0.2, 42).withColumn(
        "in_sample", (S.hash_fraction(["user_id"], 43) < 0.2).cast("int"))


def _strat_sql() -> str:
    h = S.key_hash_sql(["user_id"], 42)
    return OM.user_view_ctes() + f"""
SELECT user_id, segment_label,
       CAST(row_number() OVER (PARTITION BY segment_label ORDER BY {h})
            <= ceil(count(*) OVER (PARTITION BY segment_label) * 0.2) AS INTEGER) AS is_test
FROM um"""


@query("stratified_split", _strat_sql)
def stratified_split(spark, sf_dir):
    """ML-03: per class, ceil(0.2 n) smallest-hash rows are test rows."""
    u = user_view(spark, sf_dir).select("user_id", "segment_label")
    return S.stratified_split(u, "segment_label", ["user_id"], 0.2, 42)


STD_COLS = ["credit_score", "utilization_pct", "total_spend_2024", "credit_line"]


def _std_sql() -> str:
    h = S.hash_fraction_sql(["user_id"], 42)
    stats = ", ".join(f"avg({c}) FILTER (WHERE {h} >= 0.2) AS m_{c}, "
                      f"stddev_pop({c}) FILTER (WHERE {h} >= 0.2) AS s_{c}" for c in STD_COLS)
    outs = ", ".join(f"{r6s(f'({c} - m_{c}) / (CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END)')} AS {c}"
                     for c in STD_COLS)
    return OM.user_view_ctes() + f""",
st AS (SELECT {stats} FROM um)
SELECT user_id, {outs} FROM um, st"""


@query("standardise", _std_sql)
def standardise(spark, sf_dir):
    """ML-04: population standardisation fitted on the training rows of the
    hash split and applied to all rows (zero std -> 1)."""
    from creditlens.operators.ml import standardise as std
    u = S.hash_split(user_view(spark, sf_dir), ["user_id"], 0.2, 42)
    out = std(u, STD_COLS, fit_filter=F.col("is_test") == 0)
    return out.select("user_id", *[r6(F.col(c)).alias(c) for c in STD_COLS])


# ------------------------------------------------------------- metrics

def _reg_sql() -> str:
    return OM.user_view_ctes() + f""",
d AS (SELECT spend_2024_q3 AS y, (spend_2024_q1 + spend_2024_q2) / 2 AS p FROM um
      WHERE spend_2024_q3 IS NOT NULL AND spend_2024_q1 IS NOT NULL AND spend_2024_q2 IS NOT NULL),
a AS (SELECT count(*) AS n, avg((y - p) * (y - p)) AS mse, var_pop(y) AS vy,
             avg(abs((y - p) / greatest(y, 1.0))) AS ape, avg(y) AS my FROM d)
SELECT n, {sigs('mse')} AS mse, {sigs('sqrt(mse)')} AS rmse, {sigs('1.0 - mse / vy')} AS r2,
       {sigs('ape * 100')} AS mape, {sigs('sqrt(mse) / my * 100')} AS rmse_pct_of_mean FROM a"""


@query("regression_metrics", _reg_sql)
def regression_metrics(spark, sf_dir):
    """ML-12 + FLT-10: Q3 spend against the mean of Q1 and Q2."""
    u = user_view(spark, sf_dir)
    d = u.select(F.col("spend_2024_q3").alias("y"),
                 ((F.col("spend_2024_q1") + F.col("spend_2024_q2")) / 2).alias("p"))
    m = M.regression_metrics(d, "y", "p")
    return m.select("n", *[sig(c).alias(c) for c in ("mse", "rmse", "r2", "mape", "rmse_pct_of_mean")])


def _seg_pairs_sql() -> str:
    return OM.user_view_ctes() + f""",
pr AS (SELECT segment_label AS y,
              {Q.segment_b_sql('coalesce(utilization_pct, 50.0)', 'coalesce(credit_score, 680.0)', 'risk_flag')} AS p
       FROM um)"""


def _report_sql() -> str:
    return _seg_pairs_sql() + """,
c AS (SELECT y, p, count(*) AS n FROM pr GROUP BY 1, 2),
cls AS (SELECT y AS cls FROM c UNION SELECT p FROM c),
k AS (SELECT cls, coalesce((SELECT sum(n) FROM c WHERE c.y = cls.cls AND c.p = cls.cls), 0) AS tp,
             coalesce((SELECT sum(n) FROM c WHERE c.y = cls.cls), 0) AS support,
             coalesce((SELECT sum(n) FROM c WHERE c.p = cls.cls), 0) AS n_pred FROM cls),
r AS (SELECT cls, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, CAST(support AS BIGINT) AS support FROM k)
SELECT cls, precision, recall,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, support,
       (SELECT sum(n) FILTER (WHERE y = p) / sum(n) FROM c) AS accuracy
FROM r"""


def _seg_pairs(spark, sf_dir):
    u = user_view(spark, sf_dir)
    return u.select(F.col("segment_label").alias("y"),
                    R.segment_b(F.coalesce(F.col("utilization_pct"), F.lit(50.0)),
                                F.coalesce(F.col("credit_score"), F.lit(680.0)), "risk_flag").alias("p"))


@query("classification_report", _report_sql)
def classification_report(spark, sf_dir):
    """ML-13 + ML-15: master segments (RUL-09 + balancing) scored against the
    model-form rule RUL-10."""
    return M.classification_report(_seg_pairs(spark, sf_dir), "y", "p")


def _cm_sql() -> str:
    return _seg_pairs_sql() + """,
grid AS (SELECT a.x AS actual, b.x AS predicted FROM (VALUES (0), (1), (2), (3)) a(x), (VALUES (0), (1), (2), (3)) b(x)),
c AS (SELECT y, p, count(*) AS n FROM pr GROUP BY 1, 2)
SELECT CAST(actual AS INTEGER) AS actual, CAST(predicted AS INTEGER) AS predicted, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM grid LEFT JOIN c ON c.y = grid.actual AND c.p = grid.predicted"""


@query("confusion_matrix", _cm_sql)
def confusion_matrix(spark, sf_dir):
    """ML-14 + JOIN-14: 4 x 4 confusion counts with empty cells as 0."""
    return M.confusion_matrix(_seg_pairs(spark, sf_dir), "y", "p", [0, 1, 2, 3])


def _auc_sql() -> str:
    return OM.user_view_ctes() + """,
d AS (SELECT CAST(risk_probability AS DOUBLE) AS s, CAST(risk_flag AS INTEGER) AS y FROM um
      WHERE risk_probability IS NOT NULL AND risk_flag IS NOT NULL),
r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM d),
a AS (SELECT sum(rk) FILTER (WHERE y = 1) AS sr, count(*) FILTER (WHERE y = 1) AS P,
             count(*) FILTER (WHERE y <> 1) AS N FROM r)
SELECT CASE WHEN P > 0 AND N > 0 THEN (sr - P * (P + 1) / 2.0) / (P * N) END AS auc, P AS n_pos, N AS n_neg FROM a"""


@query("roc_auc", _auc_sql)
def roc_auc(spark, sf_dir):
    """ML-16: exact ROC AUC of the risk probability against the risk flag."""
    u = user_view(spark, sf_dir)
    return M.roc_auc(u, "risk_flag", "risk_probability")
