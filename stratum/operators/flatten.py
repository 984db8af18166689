"""Flattening of nested arrays (one output row per array element)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.money import to_cents

# Fixed value: struct field -> output column of an order item.
ITEM_FIELDS: Mapping[str, str] = {
    "item_id": "item_id",
    "name": "item_name",
    "category": "item_category",
    "price": "item_price",
    "quantity": "item_quantity",
}


def explode_array(df: DataFrame, array_col: str, fields: Mapping[str, str],
                  outer: bool = False, casts: Mapping[str, str] | None = None) -> DataFrame:
    """One row per element of ``array_col``; struct fields become columns.

    Inner by default: a row whose array is null or empty disappears.  With
    ``outer=True`` such a row is kept once, its element columns null.  The
    array column is dropped.  Catalyst prunes unused struct fields down to the
    scan (nested column pruning), so wide structs cost nothing extra.
    """
    casts = dict(casts or {})
    gen = F.explode_outer if outer else F.explode
    elem = "__elem"
    keep = [c for c in df.columns if c != array_col]
    exploded = df.select(*keep, gen(F.col(array_col)).alias(elem))
    out = []
    for field, name in fields.items():
        c = F.col(f"{elem}.{field}")
        if name in casts:
            c = c.cast(casts[name])
        out.append(c.alias(name))
    return exploded.select(*keep, *out)


def explode_items(df: DataFrame, outer: bool = False) -> DataFrame:
    """Order lines from nested orders, with ``item_total`` and exact cents."""
    lines = explode_array(df, "items", ITEM_FIELDS, outer=outer,
                          casts={"item_price": "double", "item_quantity": "int"})
    return lines.withColumns({
        "item_total": F.col("item_price") * F.col("item_quantity"),
        "item_total_cents": to_cents("item_price") * F.col("item_quantity"),
    })
