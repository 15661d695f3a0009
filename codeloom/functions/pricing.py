"""Cost of a request from its token counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# US dollars per 1,000 tokens (input, output) of the three model tiers of each pipeline.
TRANSACTION_PRICES = {"large": (0.015, 0.075), "medium": (0.003, 0.015), "small": (0.001, 0.001)}
PRODUCT_PRICES = {"large": (0.005, 0.025), "medium": (0.003, 0.015), "small": (0.001, 0.001)}


def estimate_cost(tokens_in: Column, tokens_out: Column, model: Column, prices: dict[str, tuple[float, float]]) -> Column:
    """An unknown model costs nothing."""
    price_in, price_out = F.lit(0.0), F.lit(0.0)
    for name, (per_in, per_out) in prices.items():
        price_in = F.when(model == name, F.lit(per_in)).otherwise(price_in)
        price_out = F.when(model == name, F.lit(per_out)).otherwise(price_out)
    return (tokens_in * price_in + tokens_out * price_out) / F.lit(1000.0)
