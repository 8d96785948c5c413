"""Foreign-currency conversion: as-of rate lookup, keyed amount lookup and
US business-day counts.

As-of join at scale: transactions are never partitioned by currency (one
currency may carry a third of all rows).  Instead the *rate* side is turned
into a calendar table — one row per (currency, day) from each rate date up
to the day before the next one — whose size is bounded by
``currencies x days of rate history`` and does not grow with the
transactions.  The transactions then meet it in an equi-join on
(currency, date): a broadcast hash join when the calendar is under the
broadcast budget (checked on the small table itself), otherwise a shuffled
join on the two-column key with AQE skew handling.  Transactions after the
last rate date use the latest rate through a second one-row-per-currency
lookup.  The result equals an ``ASOF LEFT JOIN`` (latest rate date <=
transaction date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditlens.sources import roles
from creditlens.sources.roles import with_roles
from creditlens.sources.tables import Tables

# Fixed values of the conversion rules
USD_NUMERIC_CODE = 840            # converted 1:1
SKIPPED_CURRENCIES = ("BAM", "AMD")  # never converted


def rate_calendar(rates: DataFrame) -> DataFrame:
    """(currency, day, open) for every day from a rate date to the day before
    the next rate date of the same currency.  A repeated rate date counts
    once, with its lowest rate."""
    rates = rates.groupBy("currency", "rate_date").agg(F.min("open").alias("open"))
    w = Window.partitionBy("currency").orderBy("rate_date")
    nxt = F.lead("rate_date").over(w)
    spans = rates.select("currency", "rate_date", "open", F.date_sub(nxt, 1).alias("_until"))
    return (spans.filter(F.col("_until").isNotNull())
            .select("currency", F.explode(F.sequence("rate_date", "_until")).alias("day"), "open"))


def latest_rate(rates: DataFrame) -> DataFrame:
    return rates.groupBy("currency").agg(F.min_by("open", F.struct(-F.unix_date("rate_date"), "open")).alias("last_open"),
                                         F.max("rate_date").alias("last_date"))


def asof_rate(tx: DataFrame, rates: DataFrame, cur_col: str = "currency",
              date_col: str = "transaction_date", out: str = "rate") -> DataFrame:
    """Add ``out`` = open rate of the latest rate date <= the row's date."""
    rates = rates.checkpoint(eager=True)  # read twice below; its source once
    cal = rate_calendar(rates)
    cal = cal.withColumnsRenamed({"currency": "_c", "day": "_d", "open": "_o"})
    last = latest_rate(rates).withColumnRenamed("currency", "_lc")
    j = (tx.join(cal, (F.col(cur_col) == F.col("_c")) & (F.col(date_col) == F.col("_d")), "left")
           .join(last, F.col(cur_col) == F.col("_lc"), "left"))
    rate = F.coalesce(F.col("_o"), F.when(F.col(date_col) >= F.col("last_date"), F.col("last_open")))
    return j.withColumn(out, rate).drop("_c", "_d", "_o", "_lc", "last_open", "last_date")


def convert(tx: DataFrame, codes: DataFrame, rates: DataFrame) -> DataFrame:
    """JOIN-11 + JOIN-10: numeric code -> alphabetic code (first match), USD
    1:1, skipped or unknown codes stay unconverted (NULL), else amount x
    as-of rate."""
    first = codes.groupBy("numeric_code").agg(F.min("alphabetic_code").alias("alphabetic_code"))
    # the code list is a fixed reference table (ISO 4217 has < 300 codes)
    j = tx.join(F.broadcast(first), tx.frgn_curr_code == first.numeric_code, "left").drop("numeric_code")
    j = asof_rate(j.withColumnRenamed("alphabetic_code", "currency"), rates)
    usd = F.col("frgn_curr_code") == USD_NUMERIC_CODE
    skip = F.col("currency").isin(*SKIPPED_CURRENCIES) | F.col("currency").isNull()
    rate = F.when(usd, F.lit(1.0)).when(skip, F.lit(None)).otherwise(F.col("rate"))
    return (j.withColumn("rate", rate)
             .withColumn("us_equiv_amt", F.col("transaction_amt").cast("double") * F.col("rate")))


def asof_convert(t: Tables) -> DataFrame:
    tx = roles.foreign_with_currency(t)
    out = convert(tx, roles.currency_codes(t), roles.fx_rates(t))
    return out.select("current_account_nbr", F.col("transaction_date").cast("string").alias("transaction_date"),
                      F.col("transaction_amt").cast("double").alias("transaction_amt"),
                      "frgn_curr_code", "currency", "rate", "us_equiv_amt")


def asof_convert_sql() -> str:
    return with_roles("foreign_with_currency", "currency_codes", "fx_rates") + f""",
first_code AS (SELECT numeric_code, min(alphabetic_code) AS alphabetic_code FROM currency_codes GROUP BY 1),
j AS (SELECT t.*, c.alphabetic_code AS currency FROM foreign_with_currency t
      LEFT JOIN first_code c ON t.frgn_curr_code = c.numeric_code),
a AS (SELECT j.*, r.open AS asof_open FROM j ASOF LEFT JOIN fx_rates r
      ON j.currency = r.currency AND j.transaction_date >= r.rate_date)
SELECT current_account_nbr, CAST(transaction_date AS VARCHAR) AS transaction_date,
       CAST(transaction_amt AS DOUBLE) AS transaction_amt, frgn_curr_code, currency,
       CASE WHEN frgn_curr_code = {USD_NUMERIC_CODE} THEN 1.0
            WHEN currency IN {SKIPPED_CURRENCIES} OR currency IS NULL THEN NULL ELSE asof_open END AS rate,
       CAST(transaction_amt AS DOUBLE) * (CASE WHEN frgn_curr_code = {USD_NUMERIC_CODE} THEN 1.0
            WHEN currency IN {SKIPPED_CURRENCIES} OR currency IS NULL THEN NULL ELSE asof_open END) AS us_equiv_amt
FROM a"""


# ------------------------------------------------------------- JOIN-04

def keyed_amount(t: Tables) -> DataFrame:
    """Left join on (account, date, amount) — amount as DECIMAL, never DOUBLE."""
    tx = roles.transactions(t).drop("us_equiv_amt")
    side = roles.foreign_transactions(t).select("current_account_nbr", "transaction_date", "transaction_amt",
                                                "us_equiv_amt")
    j = tx.join(side, ["current_account_nbr", "transaction_date", "transaction_amt"], "left")
    return j.select("current_account_nbr", F.col("transaction_date").cast("string").alias("transaction_date"),
                    "transaction_type", F.col("transaction_amt").cast("double").alias("transaction_amt"),
                    F.col("us_equiv_amt").cast("double").alias("us_equiv_amt"))


def keyed_amount_sql() -> str:
    return with_roles("transactions", "foreign_transactions") + """
SELECT t.current_account_nbr, CAST(t.transaction_date AS VARCHAR) AS transaction_date, t.transaction_type,
       CAST(t.transaction_amt AS DOUBLE) AS transaction_amt, CAST(f.us_equiv_amt AS DOUBLE) AS us_equiv_amt
FROM transactions t LEFT JOIN foreign_transactions f
  ON f.current_account_nbr = t.current_account_nbr AND f.transaction_date = t.transaction_date
 AND f.transaction_amt = t.transaction_amt"""


# ------------------------------------------------------------- DAT-10

def _nth_weekday(y, m, dow_spark: int, n: int):
    """n-th given weekday (Spark dayofweek numbering, 1 = Sunday) of month."""
    first = F.make_date(y, F.lit(m), F.lit(1))
    return F.date_add(first, ((F.lit(7 + dow_spark) - F.dayofweek(first)) % 7 + 7 * (n - 1)).cast("int"))


def _last_weekday(y, m, last_day: int, dow_spark: int):
    last = F.make_date(y, F.lit(m), F.lit(last_day))
    return F.date_sub(last, ((F.dayofweek(last) - F.lit(dow_spark) + 7) % 7).cast("int"))


def _observed(d):
    """nearest workday: Saturday -> Friday, Sunday -> Monday."""
    dow = F.dayofweek(d)
    return F.when(dow == 7, F.date_sub(d, 1)).when(dow == 1, F.date_add(d, 1)).otherwise(d)


def us_federal_holidays(years: DataFrame) -> DataFrame:
    """US federal holiday dates (observed) for the years in ``years(y)``,
    from the calendar rules."""
    y = F.col("y")
    fixed = lambda m, d: _observed(F.make_date(y, F.lit(m), F.lit(d)))
    days = [
        fixed(1, 1),                                   # New Year's Day
        F.when(y >= 1986, _nth_weekday(y, 1, 2, 3)),   # Martin Luther King Jr. Day, 3rd Monday of January
        _nth_weekday(y, 2, 2, 3),                      # Presidents Day, 3rd Monday of February
        _last_weekday(y, 5, 31, 2),                    # Memorial Day, last Monday of May
        F.when(y >= 2021, fixed(6, 19)),               # Juneteenth
        fixed(7, 4),                                   # Independence Day
        _nth_weekday(y, 9, 2, 1),                      # Labor Day, 1st Monday of September
        _nth_weekday(y, 10, 2, 2),                     # Columbus Day, 2nd Monday of October
        fixed(11, 11),                                 # Veterans Day
        _nth_weekday(y, 11, 5, 4),                     # Thanksgiving, 4th Thursday of November
        fixed(12, 25),                                 # Christmas Day
    ]
    return years.select(F.explode(F.array(*days)).alias("holiday")).filter(F.col("holiday").isNotNull()).distinct()


def business_day_calendar(bounds: DataFrame) -> DataFrame:
    """(day, bd_upto) where bd_upto = number of business days <= day, over
    the span in the one-row ``bounds(lo, hi)``.  Bounded by the day span."""
    days = bounds.select(F.explode(F.sequence(F.date_sub("lo", 1), "hi")).alias("day"))
    years = bounds.select(F.explode(F.sequence(F.year("lo") - 1, F.year("hi") + 1)).alias("y"))
    hol = us_federal_holidays(years)
    cal = days.join(F.broadcast(hol), days.day == hol.holiday, "left")
    is_bd = (~F.dayofweek("day").isin(1, 7)) & F.col("holiday").isNull()
    # the calendar has one row per day of the span: a small single-partition window
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return cal.select("day", F.sum(is_bd.cast("int")).over(w).alias("bd_upto"))


def business_days(df: DataFrame, start: str, end: str, out: str = "business_days") -> DataFrame:
    """pandas ``len(date_range(start, end, freq=US business day)) - 1``."""
    span = df.agg(F.least(F.min(start), F.min(end)).alias("lo"), F.greatest(F.max(start), F.max(end)).alias("hi")).first()
    # one row, found once: the calendar is then built without the input
    bounds = df.sparkSession.range(1).select(*[F.lit(span[c]).cast("date").alias(c) for c in ("lo", "hi")])
    cal = F.broadcast(business_day_calendar(bounds))
    a = cal.select(F.col("day").alias("_sd"), F.col("bd_upto").alias("_sb"))
    b = cal.select(F.col("day").alias("_ed"), F.col("bd_upto").alias("_eb"))
    j = (df.join(a, F.date_sub(F.col(start), 1) == F.col("_sd"), "left")
           .join(b, F.col(end) == F.col("_ed"), "left"))
    n = F.when(F.col(start) > F.col(end), F.lit(-1)).otherwise(F.col("_eb") - F.col("_sb") - 1)
    return j.withColumn(out, F.when(F.col(start).isNotNull() & F.col(end).isNotNull(), n).cast("long")) \
            .drop("_sd", "_sb", "_ed", "_eb")


def business_days_between(t: Tables) -> DataFrame:
    a = roles.account_dim(t).select("current_account_nbr", "open_date", "card_activation_date")
    r = business_days(a, "open_date", "card_activation_date")
    return r.select("current_account_nbr", F.col("open_date").cast("string").alias("open_date"),
                    F.col("card_activation_date").cast("string").alias("card_activation_date"), "business_days")


def _holidays_sql(y: str) -> str:
    """DuckDB twin (dayofweek: 0 = Sunday)."""
    def md(m, d):
        return f"make_date({y}, {m}, {d})"

    def obs(d):
        return (f"(CASE dayofweek({d}) WHEN 6 THEN {d} - 1 WHEN 0 THEN {d} + 1 ELSE {d} END)")

    def nth(m, dow, n):
        first = md(m, 1)
        return f"({first} + CAST(((7 + {dow} - dayofweek({first})) % 7 + {7 * (n - 1)}) AS INTEGER))"

    def last(m, ld, dow):
        lst = md(m, ld)
        return f"({lst} - CAST(((dayofweek({lst}) - {dow} + 7) % 7) AS INTEGER))"

    return ", ".join([
        obs(md(1, 1)), f"CASE WHEN {y} >= 1986 THEN {nth(1, 1, 3)} END", nth(2, 1, 3), last(5, 31, 1),
        f"CASE WHEN {y} >= 2021 THEN {obs(md(6, 19))} END", obs(md(7, 4)), nth(9, 1, 1), nth(10, 1, 2),
        obs(md(11, 11)), nth(11, 4, 4), obs(md(12, 25)),
    ])


def business_days_sql() -> str:
    return with_roles("account_dim") + f""",
b AS (SELECT least(min(open_date), min(card_activation_date)) AS lo,
             greatest(max(open_date), max(card_activation_date)) AS hi FROM account_dim),
yrs AS (SELECT CAST(y AS INTEGER) AS y FROM b, range(year(lo) - 1, year(hi) + 2) t(y)),
hol AS (SELECT DISTINCT h AS holiday FROM (SELECT unnest([{_holidays_sql('y')}]) AS h FROM yrs) WHERE h IS NOT NULL),
days AS (SELECT CAST(d AS DATE) AS day FROM b, range(CAST(lo - 1 AS TIMESTAMP), CAST(hi + 1 AS TIMESTAMP),
         INTERVAL 1 DAY) t(d)),
cal AS (SELECT day, sum(CASE WHEN dayofweek(day) NOT IN (0, 6) AND holiday IS NULL THEN 1 ELSE 0 END)
                 OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bd_upto
        FROM days LEFT JOIN hol ON hol.holiday = days.day)
SELECT a.current_account_nbr, CAST(a.open_date AS VARCHAR) AS open_date,
       CAST(a.card_activation_date AS VARCHAR) AS card_activation_date,
       CAST(CASE WHEN a.open_date IS NULL OR a.card_activation_date IS NULL THEN NULL
                 WHEN a.open_date > a.card_activation_date THEN -1
                 ELSE ce.bd_upto - cs.bd_upto - 1 END AS BIGINT) AS business_days
FROM account_dim a LEFT JOIN cal cs ON cs.day = a.open_date - 1
LEFT JOIN cal ce ON ce.day = a.card_activation_date"""
