"""Rule-based scoring of the user table (RUL-13..21 without a model).

``rule_scores`` adds the macro features, the Q4 proxy forecast, the
increase cap and the post-processed increase amount, all as native
expressions.  The model flow (``operators.ml``) replaces the proxy forecast
and amount with model predictions; everything downstream (reports) reads
the same column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.functions import rules as R


def add_macro(df: DataFrame) -> DataFrame:
    """RUL-13 then RUL-14: the multiplier is overwritten with 1.25 after the
    adjustment factor has used the score-based one."""
    df = df.withColumns(R.macro_features(has_score="credit_score" in df.columns))
    return df.withColumns({
        "holiday_spending_multiplier": F.lit(1.25),
        "holiday_spending_power": R.holiday_spending_power(),
    })


def rule_scores(df: DataFrame) -> DataFrame:
    df = add_macro(df)
    df = df.withColumns({
        "spend_Q4_2024": F.col("total_spend_2024") * 0.3,                       # RUL-15
    })
    df = df.withColumns({
        "predicted_q4_spend": F.col("spend_Q4_2024") * 1.05,
        "max_cli_percentage": R.max_cli_pct("segment_label", "credit_score", "is_high_income"),  # RUL-18
    })
    df = df.withColumn("CLI_target_amount", F.col("credit_line") * 1000 * F.col("max_cli_percentage"))  # RUL-20
    eligible = F.col("segment_label").isin(0, 1)
    return df.withColumn("recommended_cli_amount", R.cli_postprocess(
        "CLI_target_amount", "credit_line", "max_cli_percentage", eligible, "is_high_income"))


# Names of the increase-model features (RUL-19)
CLI_FEATURES = ["spend_to_limit_ratio", "available_credit", "available_credit_ratio", "is_excellent_credit",
                "is_good_credit", "is_fair_credit", "is_poor_credit", "q2_q1_growth", "q3_q2_growth",
                "q4_q3_growth", "growth_trajectory", "projected_headroom_needed", "risk_adjusted_cli_potential",
                "is_segment_0", "is_segment_1", "segment0_spend", "segment1_spend", "high_income_seg0",
                "high_income_seg1", "high_income_cli_potential", "prime_cli_candidate", "high_tier_cli_potential",
                "max_cli_percentage", "cli_recommendation_score"]


def cli_feature_columns() -> dict:
    """RUL-19 as ordered (name -> Column) pairs; later ones use earlier ones."""
    c = F.col
    line_usd = c("credit_line") * 1000
    return {
        "spend_to_limit_ratio": F.try_divide(c("total_spend_2024"), line_usd),
        "available_credit": line_usd * (F.lit(1.0) - c("utilization_pct") / 100),
        "available_credit_ratio": F.try_divide(c("available_credit"), line_usd),
        "is_excellent_credit": (c("credit_score") >= 750).cast("int"),
        "is_good_credit": ((c("credit_score") >= 700) & (c("credit_score") < 750)).cast("int"),
        "is_fair_credit": ((c("credit_score") >= 650) & (c("credit_score") < 700)).cast("int"),
        "is_poor_credit": (c("credit_score") < 650).cast("int"),
        "q2_q1_growth": R.ratio_growth("spend_2024_q1", "spend_2024_q2"),
        "q3_q2_growth": R.ratio_growth("spend_2024_q2", "spend_2024_q3"),
        "q4_q3_growth": R.ratio_growth("spend_2024_q3", "spend_2024_q4"),
        "growth_trajectory": 0.2 * c("q2_q1_growth") + 0.3 * c("q3_q2_growth") + 0.5 * c("q4_q3_growth"),
        "projected_headroom_needed": R.clip(c("predicted_q4_spend") - c("available_credit"), 0.0),
        "risk_adjusted_cli_potential": ((F.lit(1.0) - c("risk_probability")) * c("credit_score") / 850
                                        * c("credit_line") * 1000 * 0.25),
        "is_segment_0": (c("segment_label") == 0).cast("int"),
        "is_segment_1": (c("segment_label") == 1).cast("int"),
        "segment0_spend": c("is_segment_0") * c("total_spend_2024"),
        "segment1_spend": c("is_segment_1") * c("total_spend_2024"),
        "high_income_seg0": c("is_high_income") * c("is_segment_0"),
        "high_income_seg1": c("is_high_income") * c("is_segment_1"),
        "high_income_cli_potential": c("is_high_income") * c("credit_line") * 1000 * 0.05,
        "prime_cli_candidate": ((c("is_excellent_credit") == 1) & (c("utilization_pct") > 40)
                                & (c("utilization_pct") < 80) & (c("is_high_income") == 1)
                                & (c("risk_probability") < 0.2)).cast("int"),
        "high_tier_cli_potential": c("prime_cli_candidate") * c("credit_line") * 1000 * 0.10,
        "max_cli_percentage": R.max_cli_pct("segment_label", "credit_score", "is_high_income"),
        "cli_recommendation_score": (0.3 * c("max_cli_percentage") * c("credit_line") * 1000
                                     + 0.2 * c("high_income_cli_potential") + 0.3 * c("high_tier_cli_potential")
                                     + 0.2 * c("projected_headroom_needed")),
    }


def with_cli_features(df):
    for name, expr in cli_feature_columns().items():
        df = df.withColumn(name, expr)
    return df
