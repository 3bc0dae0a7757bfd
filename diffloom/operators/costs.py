"""Costs (D14) and budgets (F3 lives in ``sampling.stop_at_budget``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def price_calls(calls: DataFrame, prices: DataFrame, model_col: str, in_tokens: str,
                out_tokens: str | None = None, in_price: str = "price_per_word",
                out_price: str | None = None) -> DataFrame:
    """``cost = in * p (+ out * q)``. The price table has one row per model; whether
    it is broadcast is left to its size at run time. Unknown models get ``cost`` NULL and ``unknown_model``."""
    j = calls.join(prices, model_col, "left")
    cost = F.col(in_tokens) * F.col(in_price)
    if out_tokens and out_price:
        cost = cost + F.col(out_tokens) * F.col(out_price)
    return j.withColumn("cost", cost).withColumn("unknown_model", F.col(in_price).isNull())


def fits_model_context(df: DataFrame, limits: DataFrame, model_col: str, n_tokens_col: str) -> DataFrame:
    """Tokens <= the model's context limit (inclusive)."""
    return df.join(limits, model_col).where(F.col(n_tokens_col) <= F.col("context_limit"))
