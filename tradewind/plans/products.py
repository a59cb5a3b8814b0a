"""Products with a translated category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.joins import lookup_join
from tradewind.schemas import ORDINAL


def products_with_category(raw_products: DataFrame, translation: DataFrame) -> DataFrame:
    """Add ``category_english``: the translation, else the original name."""
    names = translation.select("product_category_name", "product_category_name_english")
    joined = lookup_join(raw_products, names, "product_category_name")
    category = F.coalesce("product_category_name_english", "product_category_name")
    kept = ["product_id", "product_category_name", category.alias("category_english")]
    return joined.select(*kept, *(c for c in raw_products.columns if c == ORDINAL))
