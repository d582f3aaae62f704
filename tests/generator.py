"""Synthetic order and item records, one per row of a base table.

Every field comes from a hash of the base row's id, so a lost task regenerates the same rows and
the size follows the base table. Keys repeat many times by construction, as in a change feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ranges of the generated fields, both ends included.
ORDER_ID = (1, 1000)
CUSTOMER_ID = (1, 100)
ITEM_ID = (1, 1000)
QUANTITY = (2, 20)
PRICE = (0.1, 50.0)
YEAR, MONTH, DAY = 2021, 7, (20, 25)
NAME_LENGTH = 10
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_DIGITS = 7  # hex digits per drawn number


def _draw(salted: Column, slot: int, digits: int = _DIGITS) -> Column:
    """The ``slot``-th number drawn from a hash, below 16 ** digits."""
    part = F.substring(salted, 1 + slot * digits, digits)
    return F.conv(part, 16, 10).cast("bigint")


def _between(salted: Column, slot: int, low: int, high: int) -> Column:
    return (F.pmod(_draw(salted, slot), F.lit(high - low + 1)) + low).cast("int")


def _hash(base_id: str, entity: str) -> Column:
    return F.md5(F.concat(F.lit(f"{entity}-"), F.col(base_id).cast("string")).cast("binary"))


def _stamped(base_id: str, updated_from_ms: int) -> Column:
    return (F.lit(updated_from_ms).cast("bigint") + F.col(base_id)).alias("last_update_time")


def generated_orders(base: DataFrame, base_id: str, updated_from_ms: int) -> DataFrame:
    """orderId, customerId, itemId, quantity, year, month, day, last_update_time."""
    one = base.select(
        F.col(base_id), _hash(base_id, "order").alias("h"), _hash(base_id, "day").alias("d")
    )
    return one.select(
        _between("h", 0, *ORDER_ID).alias("orderId"),
        _between("h", 1, *CUSTOMER_ID).alias("customerId"),
        _between("h", 2, *ITEM_ID).alias("itemId"),
        _between("h", 3, *QUANTITY).alias("quantity"),
        F.lit(YEAR).alias("year"),
        F.lit(MONTH).alias("month"),
        _between("d", 0, *DAY).alias("day"),
        _stamped(base_id, updated_from_ms),
    )


def generated_items(base: DataFrame, base_id: str, updated_from_ms: int) -> DataFrame:
    """itemId, name, price, year, month, day, last_update_time."""
    one = base.select(
        F.col(base_id), _hash(base_id, "item").alias("h"), _hash(base_id, "name").alias("n")
    )
    low, high = PRICE
    share = _draw("h", 1) / F.lit(float(16**_DIGITS - 1))
    letters = [
        F.substring(F.lit(LETTERS), F.pmod(_draw("n", i, 3), F.lit(len(LETTERS))).cast("int") + 1, 1)
        for i in range(NAME_LENGTH)
    ]
    return one.select(
        _between("h", 0, *ITEM_ID).alias("itemId"),
        F.concat(*letters).alias("name"),
        (F.lit(low) + share * F.lit(high - low)).alias("price"),
        F.lit(YEAR).alias("year"),
        F.lit(MONTH).alias("month"),
        _between("h", 2, *DAY).alias("day"),
        _stamped(base_id, updated_from_ms),
    )
