"""SQL fragments shared by the oracle queries (DuckDB dialect).

These mirror the Column builders in ``creditlens.functions.rules`` one to
one; the oracle is an independent statement of the same semantics.
"""

from __future__ import annotations

from creditlens.functions import rules as R
from creditlens.operators.rollup import SPEND_MEASURES
from creditlens.sources.roles import PERIODS, Periods


def between(c: str, b: tuple) -> str:
    return f"{c} BETWEEN DATE '{b[0]}' AND DATE '{b[1]}'"


def payment_history_sql(src: str, prefix: str) -> str:
    h = f"coalesce(upper(regexp_replace({src}, '^\\s+|\\s+$', '', 'g')), '')"
    mapped = f"regexp_replace(translate({h}, '{R.DELINQ_LETTERS}', '{R.DELINQ_DIGITS}'), '[^1-7]', '', 'g')"
    mx = "CASE " + " ".join(f"WHEN instr({mapped}, '{d}') > 0 THEN {d}" for d in range(7, 0, -1)) + " ELSE 0 END"

    def cnt(cls: str) -> str:
        return f"CAST(length({h}) - length(regexp_replace({h}, '{cls}', '', 'g')) AS INTEGER)"

    return ",\n".join([
        f"CAST(length({mapped}) AS INTEGER) AS {prefix}delinquency_count",
        f"CAST({mx} AS INTEGER) AS {prefix}max_delinquency",
        f"{cnt('Z')} AS {prefix}zero_balance_months",
        f"{cnt('[%#+\\-]')} AS {prefix}credit_balance_months",
        f"{cnt('[AIQ]')} AS {prefix}normal_months",
    ])


def signed_amount_sql(tx_type="transaction_type", amt="transaction_amt", us="us_equiv_amt") -> str:
    a = f"(CASE WHEN {us} IS NULL OR {us} = 0 THEN {amt} ELSE {us} END)"
    return f"CASE WHEN {tx_type} = 'RETURN' THEN -{a} ELSE {a} END"


def period_pivot_sql(src: str, periods: Periods = PERIODS, key="current_account_nbr") -> str:
    parts = []
    for spend, cnt, attr in SPEND_MEASURES:
        b = getattr(periods, attr)
        parts.append(f"coalesce(sum(CASE WHEN {between('transaction_date', b)} THEN signed_amount END), 0) AS {spend}")
        parts.append(f"count(*) FILTER (WHERE {between('transaction_date', b)} AND transaction_type = 'SALE') AS {cnt}")
    return f"SELECT {key}, " + ",\n  ".join(parts) + f" FROM {src} GROUP BY {key}"


def hash_uniform_sql(key: str, salt: str = "") -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '{salt}'), 1, 8)) AS UBIGINT) / 4294967296.0"


def segment_a_sql(u="utilization_pct", s="credit_score", r="risk_flag") -> str:
    return (f"CASE WHEN (({u} > 70) OR ({s} < 670)) AND ({r} = 0) THEN 1 "
            f"WHEN ({u} > 30) AND ({u} <= 70) AND ({s} >= 670) AND ({r} = 0) THEN 0 "
            f"WHEN {r} = 1 THEN 3 ELSE 2 END")


def segment_b_sql(u="utilization_pct", s="credit_score", r="risk_flag") -> str:
    nhr = f"NOT coalesce({r} = 1, false)"
    nlow = f"NOT coalesce({u} <= 30, false)"
    return (f"CASE WHEN ({u} > 30) AND ({u} <= 70) AND ({s} >= 670) AND {nhr} THEN 0 "
            f"WHEN (({u} > 70) OR ({s} < 670)) AND {nhr} AND {nlow} THEN 1 "
            f"WHEN ({u} <= 30) AND {nhr} THEN 2 "
            f"WHEN {r} = 1 THEN 3 ELSE 2 END")


def risk_probability_sql(r="risk_flag", s="credit_score", u="utilization_pct", key="user_id") -> str:
    noise = f"({hash_uniform_sql(key)} * 0.3)"
    base = f"(CASE WHEN {r} = 0 THEN {noise} ELSE CAST({r} AS DOUBLE) * 0.7 + {noise} END)"
    cf = f"greatest(0.0, least(1.0, (700.0 - {s}) / 300.0))"
    p = f"(({base} * 0.7 + {cf} * 0.3) * 0.7 + ({u} / 100.0) * 0.3)"
    return f"greatest(0.0, least(1.0, {p}))"


def clip_sql(c: str, lo=None, hi=None) -> str:
    out = c
    if lo is not None:
        out = f"(CASE WHEN {out} < {lo} THEN {lo} ELSE {out} END)"
    if hi is not None:
        out = f"(CASE WHEN {out} > {hi} THEN {hi} ELSE {out} END)"
    return out


def macro_sql(score="credit_score", hi="is_high_income") -> dict:
    mult = f"(1.1 + ({clip_sql(score, 300, 850)} - 300) / 550 * 0.3)"
    el = f"CAST(CASE WHEN {hi} = 1 THEN 0.8 ELSE 1.0 END AS DOUBLE)"
    return {
        "holiday_spending_multiplier": mult,
        "economic_factor": "CAST(0.05 AS DOUBLE)",
        "seasonal_index": "CAST(1.2 AS DOUBLE)",
        "spending_elasticity": el,
        "q4_adjustment_factor": f"({mult} * (1.0 + 0.05) / {el})",
    }


def max_cli_pct_sql(seg="segment_label", s="credit_score", hi="is_high_income") -> str:
    # DOUBLE literals: the bonus is added in floating point, as in Spark
    def d(x):
        return f"CAST({x} AS DOUBLE)"
    base = (f"(CASE WHEN {seg} = 0 THEN (CASE WHEN {s} >= 750 THEN {d(0.25)} WHEN {s} >= 700 THEN {d(0.20)} ELSE {d(0.15)} END) "
            f"WHEN {seg} = 1 THEN (CASE WHEN {s} >= 700 THEN {d(0.15)} WHEN {s} >= 650 THEN {d(0.10)} ELSE {d(0.05)} END) "
            f"ELSE {d(0.0)} END)")
    return f"({base} + CASE WHEN {hi} = 1 AND {seg} IN (0, 1) THEN {d(0.05)} ELSE {d(0.0)} END)"


def cli_postprocess_sql(pred: str, line: str, pct: str, elig: str, hi: str) -> str:
    p1 = f"(CASE WHEN {pred} > 0 THEN greatest({pred}, 500.0) ELSE {pred} END)"
    p2 = f"least({p1}, {line} * 1000 * {pct})"
    e = f"coalesce({elig}, false)"
    p3 = f"(CASE WHEN {e} THEN {p2} ELSE 0.0 END)"
    p4 = f"(CASE WHEN {e} AND {hi} = 1 THEN least({p3}, {line} * 1000 * 0.3) ELSE {p3} END)"
    return f"(CASE WHEN {e} AND {p4} > 0 THEN greatest({p4}, 500.0) ELSE {p4} END)"


def quantile_sql(src: str, col: str, ps, group: str | None = None, names=None) -> str:
    """Exact linear-interpolation quantiles with Spark's formula:
    position = (n - 1) * p; lower/higher = floor/ceil(position);
    value = (higher - position) * v[lower] + (position - lower) * v[higher]
    (v[lower] when both positions hold the same value).  Returns a SELECT
    with columns [group,] q0, q1, ... (or ``names``)."""
    names = names or [f"q{i}" for i in range(len(ps))]
    part = f"PARTITION BY {group} " if group else ""
    g_sel = f"{group}, " if group else ""
    g_by = f" GROUP BY {group}" if group else ""
    outs = []
    for p, nm in zip(ps, names):
        pos = f"((n - 1) * CAST({p} AS DOUBLE))"
        lo = f"max(v) FILTER (WHERE i = floor({pos}))"
        hi = f"max(v) FILTER (WHERE i = ceil({pos}))"
        outs.append(f"CASE WHEN floor(max({pos})) = ceil(max({pos})) OR {lo} = {hi} THEN {lo} "
                    f"ELSE (ceil(max({pos})) - max({pos})) * {lo} + (max({pos}) - floor(max({pos}))) * {hi} END AS {nm}")
    return (f"SELECT {g_sel}{', '.join(outs)} FROM (SELECT {g_sel}CAST({col} AS DOUBLE) AS v, "
            f"row_number() OVER ({part}ORDER BY {col}) - 1 AS i, count(*) OVER ({part.strip()}) AS n "
            f"FROM {src} WHERE {col} IS NOT NULL){g_by}")
