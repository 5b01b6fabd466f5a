"""Revenue reports over the current purchase and product-item tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.rules import gmv_eligible, in_year
from daybook.operators.ranking import top_k, top_k_per_group
from daybook.schemas import ITEM_KEY, MONEY_TOTAL


def _revenue(
    purchase: DataFrame, item: DataFrame, by: Sequence[str], year: int | None, name: str
) -> DataFrame:
    """Sum of item values over eligible purchases, inner-joined on the composite item key.

    Purchases are counted per (producer, item) before they meet the items: a hot item joins as one
    row per producer instead of one per sale. Items are not aggregated, a repeated item key counts
    each time it joins.
    """
    eligible = purchase.where(gmv_eligible())
    if year is not None:
        eligible = eligible.where(in_year("release_date", year))
    sales = eligible.groupBy("producer_id", *ITEM_KEY).agg(F.count(F.lit(1)).alias("sales"))
    total = F.sum(F.col("sales") * F.col("purchase_value")).cast(MONEY_TOTAL)
    return sales.join(item, ITEM_KEY).groupBy(*by).agg(total.alias(name))


def top_producers(purchase: DataFrame, item: DataFrame, year: int, k: int = 50) -> DataFrame:
    """The k producers with the most revenue released in `year`; equal ones by id."""
    name = f"faturamento_{year}"
    return top_k(_revenue(purchase, item, ["producer_id"], year, name), name, k, ["producer_id"])


def producer_products(purchase: DataFrame, item: DataFrame) -> DataFrame:
    """Revenue per producer and product, all years."""
    return _revenue(purchase, item, ["producer_id", "product_id"], None, "faturamento")


def top_products(
    purchase: DataFrame, item: DataFrame, n: int = 2, ties: Literal["break", "keep"] = "break"
) -> DataFrame:
    """The n best products of each producer, by revenue, then by smaller product id."""
    best = top_k_per_group(
        producer_products(purchase, item), "producer_id", "faturamento", n, ["product_id"], ties
    )
    return best.orderBy(
        F.asc_nulls_last("producer_id"), F.desc_nulls_last("faturamento"), F.asc_nulls_last("product_id")
    )
