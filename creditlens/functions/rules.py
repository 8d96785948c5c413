"""Business rules as pure ``Column`` builders.

Every rule is a native Spark expression (whole-stage codegen, no Python per
row).  Mask assignments of the form "set c = v where m" applied in sequence
become one ``when`` chain listed in reverse order (the last assignment wins).
Comparisons with NULL behave like pandas comparisons with NaN (false) because
``when`` treats a NULL condition as not matched; explicit negations are
wrapped with ``coalesce(m, false)`` first (``NOT NULL`` is NULL, ``~NaN-mask``
is True).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_true(m: Column) -> Column:
    return F.coalesce(m, F.lit(False))


def is_not(m: Column) -> Column:
    """pandas ``~mask`` where a NaN comparison counted as False."""
    return ~F.coalesce(m, F.lit(False))


# ------------------------------------------------------------ transactions

def effective_amount(amt, us) -> Column:
    """RUL-01: converted amount, falling back to the raw amount when the
    converted one is missing or zero."""
    us, amt = col(us), col(amt)
    return F.when(us.isNull() | (us == 0), amt).otherwise(us)


def signed_amount(tx_type, amt, us=None) -> Column:
    """RUL-01: returns are negative, every other type adds to spend."""
    a = col(amt) if us is None else effective_amount(amt, us)
    return F.when(col(tx_type) == "RETURN", -a).otherwise(a)


# ---------------------------------------------------------- payment history

# Fixed values of the payment-history code legend:
#   delinquent cycles 1..7 : B C D E F G H, J K L M N O P, 1 2 3 4 5 6 7
#   zero balance           : Z
#   credit balance         : % # + -
#   normal                 : A I Q
DELINQ_LETTERS = "BCDEFGHJKLMNOP"
DELINQ_DIGITS = "12345671234567"
CREDIT_CODES = "%#+-"
NORMAL_CODES = "AIQ"


def _count_class(s: Column, codes: str) -> Column:
    return F.length(s) - F.length(F.translate(s, codes, ""))


def clean_code_string(s) -> Column:
    """strip + upper (Python ``str.strip`` removes all surrounding whitespace)."""
    return F.upper(F.btrim(col(s), F.lit(" \t\n\x0b\f\r")))


def payment_history(s) -> Column:
    """RUL-02 with STR-01 (strip + upper), STR-02 (per-class character
    counts) and STR-03 (max of mapped characters): parse a payment-history
    string into a struct of five counts.

    Missing history gives zeros everywhere; U-X and 0, 8, 9 count as nothing.
    """
    h = F.coalesce(clean_code_string(s), F.lit(""))
    mapped = F.translate(h, DELINQ_LETTERS, DELINQ_DIGITS)
    max_d = F.lit(0)
    for d in range(1, 8):  # highest digit present
        max_d = F.when(F.instr(mapped, str(d)) > 0, F.lit(d)).otherwise(max_d)
    return F.struct(
        _count_class(mapped, "1234567").cast("int").alias("delinquency_count"),
        max_d.cast("int").alias("max_delinquency"),
        _count_class(h, "Z").cast("int").alias("zero_balance_months"),
        _count_class(h, CREDIT_CODES).cast("int").alias("credit_balance_months"),
        _count_class(h, NORMAL_CODES).cast("int").alias("normal_months"),
    )


# Names of the payment-history measures
PAYMENT_METRICS = ("delinquency_count", "max_delinquency", "zero_balance_months",
                   "credit_balance_months", "normal_months")


def payment_history_columns(s, prefix: str) -> list[Column]:
    """PRJ-08: struct fields expanded into prefixed columns."""
    st = payment_history(s)
    return [st[m].alias(f"{prefix}{m}") for m in PAYMENT_METRICS]


# -------------------------------------------------------------- value maps

def income_from_code(c) -> Column:
    """PRJ-15: NULL / 'Y' -> 0, 'H' -> 1; other codes are unknown (NULL)."""
    c = col(c)
    return F.when(c.isNull() | (c == "Y"), F.lit(0)).when(c == "H", F.lit(1))


def sentinel_recode(c, sentinel=99, value=0) -> Column:
    """PRJ-16."""
    c = col(c)
    return F.when(c == sentinel, F.lit(value)).otherwise(c)


# Text flag values read as true
TRUE_WORDS = ("y", "yes", "true", "t", "1")


def text_flag(c) -> Column:
    """PRJ-19 for text flags: lower-cased value in the true-word list -> 1."""
    return F.coalesce(F.lower(col(c).cast("string")).isin(*TRUE_WORDS), F.lit(False)).cast("int")


def numeric_flag(c) -> Column:
    """PRJ-19 for numeric flags: coerce, NULL -> 0, int."""
    return F.coalesce(F.expr(f"try_cast({c} as double)") if isinstance(c, str) else col(c).cast("double"),
                      F.lit(0.0)).cast("int")


# Segment names accepted by the label map
SEGMENT_NAMES = {"eligible_no_risk": 0, "eligible_at_risk": 1, "no_increase": 2, "high_risk": 3}


def segment_from_text(c) -> Column:
    """PRJ-20 for text labels: lower-cased name -> id, unknown -> 2."""
    low = F.lower(col(c))
    out = F.lit(2)
    for name, v in reversed(list(SEGMENT_NAMES.items())):
        out = F.when(low == name, F.lit(v)).otherwise(out)
    return out


def segment_from_number(c) -> Column:
    """PRJ-20 for numeric labels: coerce, NULL -> 2, clip to 0..3, int."""
    v = F.coalesce(col(c).cast("double"), F.lit(2.0))
    return F.least(F.greatest(v, F.lit(0.0)), F.lit(3.0)).cast("int")


def clip(c, lo=None, hi=None) -> Column:
    """PRJ-21: pandas ``clip`` (NULL stays NULL, NaN counts as missing and
    becomes NULL; bounds may be columns)."""
    c = col(c)
    out = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    if lo is not None:
        lo = lo if isinstance(lo, Column) else F.lit(lo)
        out = F.when(out < lo, lo).otherwise(out)
    if hi is not None:
        hi = hi if isinstance(hi, Column) else F.lit(hi)
        out = F.when(out > hi, hi).otherwise(out)
    return out


def inf_to_null(c) -> Column:
    """PRJ-22 (NaN is treated as missing too)."""
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


# ------------------------------------------------------------------ maths

def guarded_pct(num, den) -> Column:
    """MTH-01 / RUL-03: num/den*100 when den > 0, else NULL."""
    num, den = col(num).cast("double"), col(den).cast("double")
    return F.when(den > 0, num / den * 100.0)


def guarded_avg(total, n) -> Column:
    """MTH-02: total/n when n > 0, else 0."""
    total, n = col(total).cast("double"), col(n).cast("double")
    return F.when(n > 0, total / n).otherwise(F.lit(0.0))


def growth_clipped(a, b) -> Column:
    """MTH-03: (b-a)/max(1,a) when a > 0 else 0, clipped to [-5, 5]."""
    a, b = col(a).cast("double"), col(b).cast("double")
    g = F.when(a > 0, (b - a) / F.greatest(F.lit(1.0), a)).otherwise(F.lit(0.0))
    return clip(g, -5.0, 5.0)


def growth(a, b) -> Column:
    """MTH-04: (b-a)/a when a > 0 else 0."""
    a, b = col(a).cast("double"), col(b).cast("double")
    return F.when(a > 0, (b - a) / a).otherwise(F.lit(0.0))


def ratio_growth(a, b) -> Column:
    """MTH-05: b/a with a == 0 -> missing -> 1, clipped to [0, 5]."""
    a, b = col(a).cast("double"), col(b).cast("double")
    r = F.coalesce(F.when(a != 0, b / a), F.lit(1.0))
    return clip(r, 0.0, 5.0)


# ------------------------------------------------------------- risk rules

def delinquency_flag(count_col, threshold: int = 0) -> Column:
    """RUL-04: count > threshold (0 in the master build, 1 in the model prep)."""
    return F.coalesce(col(count_col) > threshold, F.lit(False)).cast("int")


def risk_rule_a(dc12, dc24, util, score) -> Column:
    """RUL-05 (before quota): more than 3 delinquencies in either window, or
    utilisation > 95 with score < 600."""
    m = (is_true(col(dc12) > 3) | is_true(col(dc24) > 3)
         | is_true((col(util) > 95) & (col(score) < 600)))
    return m.cast("int")


def risk_rule_b(d12, d24, fraud, util, score) -> Column:
    """RUL-06 (before quota): any delinquency flag or fraud; or utilisation
    > 85 with score < 650 (utilisation filled 50, score filled 680)."""
    u = F.coalesce(col(util).cast("double"), F.lit(50.0))
    s = F.coalesce(col(score).cast("double"), F.lit(680.0))
    primary = (col(d12) == 1) | (col(d24) == 1) | (col(fraud) == 1)
    return (is_true(primary) | ((u > 85) & (s < 650))).cast("int")


def risk_rule_c(d12, d24, fraud, util, score) -> Column:
    """RUL-07 (before quota): delinquency or fraud; or utilisation > 90 with
    score < 620 (same fills as RUL-06)."""
    u = F.coalesce(col(util).cast("double"), F.lit(50.0))
    s = F.coalesce(col(score).cast("double"), F.lit(680.0))
    primary = (col(d12) == 1) | (col(d24) == 1) | (col(fraud) == 1)
    return (is_true(primary) | ((u > 90) & (s < 620))).cast("int")


def risk_rule_d(d12, d24) -> Column:
    """RUL-08: either delinquency flag."""
    return is_true((col(d12) == 1) | (col(d24) == 1)).cast("int")


def segment_a(util, score, risk) -> Column:
    """RUL-09 (master): default 2; 3 if risky; 0 if 30 < util <= 70 and
    score >= 670 and not risky; 1 if util > 70 or score < 670 and not risky."""
    u, s, r = col(util), col(score), col(risk)
    return (F.when(((u > 70) | (s < 670)) & (r == 0), F.lit(1))
            .when((u > 30) & (u <= 70) & (s >= 670) & (r == 0), F.lit(0))
            .when(r == 1, F.lit(3))
            .otherwise(F.lit(2)))


def segment_b(util, score, risk) -> Column:
    """RUL-10 (models / scoring): as RUL-09, but utilisation <= 30 stays 2."""
    u, s = col(util), col(score)
    hr = col(risk) == 1
    low = u <= 30
    return (F.when((u > 30) & (u <= 70) & (s >= 670) & is_not(hr), F.lit(0))
            .when(((u > 70) | (s < 670)) & is_not(hr) & is_not(low), F.lit(1))
            .when(low & is_not(hr), F.lit(2))
            .when(hr, F.lit(3))
            .otherwise(F.lit(2)))


def hash_uniform(key, salt: str = "") -> Column:
    """Deterministic U[0,1): first 8 hex digits of md5(key || salt) / 2^32."""
    h = F.md5(F.concat(col(key).cast("string"), F.lit(salt)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / 4294967296.0


def risk_probability_proxy(risk, score, util, key) -> Column:
    """RUL-12: flag-based base with hash noise in [0, 0.3), blended with a
    score factor and a utilisation factor, clipped to [0, 1]."""
    noise = hash_uniform(key) * 0.3
    base = F.when(col(risk) == 0, noise).otherwise(col(risk).cast("double") * 0.7 + noise)
    credit_factor = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.lit(700.0) - col(score)) / 300.0))
    p = base * 0.7 + credit_factor * 0.3
    p = p * 0.7 + (col(util) / 100.0) * 0.3
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))


# ----------------------------------------------------------- macro features

def macro_features(score="credit_score", high_income="is_high_income", has_score=True) -> dict:
    """RUL-13: holiday multiplier, economic factor, seasonal index,
    elasticity and the composite Q4 adjustment factor."""
    if has_score:
        norm = (clip(col(score), 300, 850) - 300) / 550
        mult = F.lit(1.1) + norm * 0.3
    else:
        mult = F.lit(1.25)
    elasticity = F.when(col(high_income) == 1, F.lit(0.8)).otherwise(F.lit(1.0))
    return {
        "holiday_spending_multiplier": mult,
        "economic_factor": F.lit(0.05),
        "seasonal_index": F.lit(1.2),
        "spending_elasticity": elasticity,
        "q4_adjustment_factor": mult * (F.lit(1.0) + F.lit(0.05)) / elasticity,
    }


def holiday_spending_power(monthly="avg_monthly_spend_2024", high_income="is_high_income") -> Column:
    """RUL-14: monthly spend x 1.25 x (1 + 0.2 x high income)."""
    return col(monthly) * 1.25 * (F.lit(1.0) + F.lit(0.2) * col(high_income))


# --------------------------------------------------------- credit-line rules

def cli_target_spend(segment, forecast, line, high_income) -> Column:
    """RUL-16: max(0, k x forecast - line x 1000), k = 1.5 / 1.2 for
    segments 0 / 1 and 2.0 / 1.5 when high income; others 0."""
    seg, f, ln, hi = col(segment), col(forecast), col(line) * 1000, col(high_income) == 1
    k = (F.when((seg == 0) & hi, F.lit(2.0)).when((seg == 1) & hi, F.lit(1.5))
         .when(seg == 0, F.lit(1.5)).when(seg == 1, F.lit(1.2)))
    return F.when(k.isNotNull(), F.greatest(F.lit(0.0), k * f - ln)).otherwise(F.lit(0.0))


def cli_target_line(segment, line, high_income) -> Column:
    """RUL-17: line x 500 / 250 for segments 0 / 1, x 750 / 375 when high
    income, else 0."""
    seg, ln, hi = col(segment), col(line), col(high_income) == 1
    return (F.when((seg == 0) & hi, ln * 750).when((seg == 1) & hi, ln * 375)
            .when(seg == 0, ln * 500).when(seg == 1, ln * 250).otherwise(F.lit(0.0)))


def max_cli_pct(segment, score, high_income) -> Column:
    """RUL-18: segment/score tiered cap, +0.05 for high income (eligible only)."""
    seg, s = col(segment), col(score)
    base = (F.when(seg == 0, F.when(s >= 750, 0.25).when(s >= 700, 0.20).otherwise(0.15))
            .when(seg == 1, F.when(s >= 700, 0.15).when(s >= 650, 0.10).otherwise(0.05))
            .otherwise(0.0))
    bonus = F.when((col(high_income) == 1) & seg.isin(0, 1), F.lit(0.05)).otherwise(F.lit(0.0))
    return base + bonus


def cli_postprocess(pred, line, pct, eligible, high_income) -> Column:
    """RUL-21: floor 500 if positive -> cap line*1000*pct -> non-eligible 0 ->
    high-income cap 30 % of line -> floor 500 again if positive."""
    p = col(pred)
    cap = col(line) * 1000 * col(pct)
    p = F.when(p > 0, F.greatest(p, F.lit(500.0))).otherwise(p)
    p = F.least(p, cap)
    elig = is_true(col(eligible))
    p = F.when(elig, p).otherwise(F.lit(0.0))
    p = F.when(elig & (col(high_income) == 1), F.least(p, col(line) * 1000 * 0.3)).otherwise(p)
    return F.when(elig & (p > 0), F.greatest(p, F.lit(500.0))).otherwise(p)
