"""Seeded synthetic rows for demos and load tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.sampling import drawn, seeded_pick


def draw(seed: int, key: str, low: int, high: int) -> Column:
    """Whole number from low to high, both included, that depends on seed and key alone."""
    return (F.pmod(drawn(seed, key), F.lit(high - low + 1)) + low).cast("int")


def synthetic_orders(keys: DataFrame, products: DataFrame, start: dt.date, days: int, seed: int,
                     regions: tuple[str, ...] = ("EAST", "WEST", "OVERSEAS")) -> DataFrame:
    """One order per key row: random day, product, quantity, region and status (1 in 10 cancelled).

    The same keys and products give the same orders on every cluster; gaps in the product ids lose no order.
    """
    key = keys.columns[0]
    x = keys.withColumn("quantity", draw(seed + 1, key, 1, 5)).withColumn("_s", draw(seed + 2, key, 1, 10)) \
            .withColumn("_r", draw(seed + 3, key, 1, len(regions))).withColumn("_d", draw(seed + 4, key, 0, days - 1))
    x = seeded_pick(x, key, products.select("product_id", "product_name", "category", "list_price"), "product_id", seed)
    return x.select(
        F.concat(F.lit("ORD-"), F.lpad(F.col(key).cast("string"), 12, "0")).alias("order_id"),
        F.date_add(F.lit(start), F.col("_d")).alias("order_date"), "product_id", "product_name", "category",
        "quantity", F.col("list_price").alias("unit_price"),
        (F.col("quantity") * F.col("list_price")).alias("total_amount"),
        F.element_at(F.array(*[F.lit(r) for r in regions]), F.col("_r")).alias("region"),
        F.when(F.col("_s") == 1, "cancelled").when(F.col("_s") == 2, "pending").otherwise("completed").alias("status"))


# Names of the demo rows, picked by i % 3.
REGIONS = ("東京", "大阪", "名古屋")
PRODUCT_PREFIX = "製品"


def numbered_sales(ids: DataFrame, id_col: str, as_of: dt.date) -> DataFrame:
    """Sales rows computed from a running number i: code, name and region by i % 3, amounts from i."""
    i = F.col(id_col)
    third = (i % 3).cast("int")
    return ids.select(
        i.alias("sales_id"), F.date_sub(F.lit(as_of), (i % 36500).cast("int")).alias("sales_date"),
        F.concat(F.lit("P00"), (third + 1).cast("string")).alias("product_code"),
        F.concat(F.lit(PRODUCT_PREFIX), F.char(65 + third)).alias("product_name"),
        (i * 10).alias("quantity"), (i * 100).cast("decimal(18,2)").alias("unit_price"),
        ((i * 10).cast("decimal(18,0)") * (i * 100).cast("decimal(18,0)")).cast("decimal(38,2)").alias("total_amount"),
        F.element_at(F.array(*[F.lit(r) for r in REGIONS]), third + 1).alias("region"))
