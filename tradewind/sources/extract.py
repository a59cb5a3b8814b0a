"""Raw tables to the five inputs of the transformation."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.text import checked, null_if_token, typed_cell
from tradewind.plans.products import products_with_category
from tradewind.schemas import MONEY, MONEY_COLUMNS


class Source(Protocol):
    """Anything that can serve a raw table by name."""

    def table(self, name: str) -> DataFrame: ...


def _money(name: str, kind: T.DataType, on_bad_cells: str) -> Column:
    """A money column as decimal; NaN counts as missing, what does not fit is a bad cell."""
    if isinstance(kind, T.StringType):
        value = null_if_token(F.col(name))
        return checked(value, typed_cell(value, MONEY), name, on_bad_cells)
    if isinstance(kind, T.IntegralType):
        value = F.col(name)
        return checked(value, value.try_cast(MONEY), name, on_bad_cells)
    value = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
    amount = value.try_cast(MONEY)
    # Four decimals to the precision that a double has.
    off = F.abs(amount.cast("double") - value)
    exact = F.when(off <= F.greatest(F.lit(1.0), F.abs(value)) * 1e-9, amount)
    return checked(value, exact, name, on_bad_cells)


def conform(df: DataFrame, on_bad_cells: str = "fail") -> DataFrame:
    """Money columns as decimal, so that sums do not depend on the order of addition.

    An amount that is infinite, too large or finer than four decimals fails the action that
    reads it, or becomes null with ``on_bad_cells="count"``; :func:`bad_money` counts them.
    """
    money = {
        field.name: _money(field.name, field.dataType, on_bad_cells)
        for field in df.schema
        if field.name in MONEY_COLUMNS and not isinstance(field.dataType, T.DecimalType)
    }
    return df.withColumns(money) if money else df


def bad_money(df: DataFrame) -> dict[str, int]:
    """Number of amounts per money column that :func:`conform` cannot take, by one pass."""
    kinds = {f.name: f.dataType for f in df.schema if f.name in MONEY_COLUMNS}
    kinds = {n: k for n, k in kinds.items() if not isinstance(k, T.DecimalType)}
    if not kinds:
        return {}
    bad = {
        name: F.count_if(
            _present(name, kind) & _money(name, kind, "count").isNull()
        ).alias(name)
        for name, kind in kinds.items()
    }
    return {name: n for name, n in df.agg(*bad.values()).first().asDict().items() if n}


def _present(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return null_if_token(F.col(name)).isNotNull()
    if isinstance(kind, T.IntegralType):
        return F.col(name).isNotNull()
    return F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))


def read_products(source: Source) -> DataFrame:
    """Products with their English category."""
    return products_with_category(
        source.table("raw_products"), source.table("raw_category_translation")
    )


def extract(source: Source, on_bad_cells: str = "fail") -> dict[str, DataFrame]:
    """The named bundle of inputs, lazily."""
    return {
        "orders": source.table("raw_orders"),
        "customers": source.table("raw_customers"),
        "order_items": conform(source.table("raw_order_items"), on_bad_cells),
        "products": read_products(source),
        "payments": conform(source.table("raw_order_payments"), on_bad_cells),
    }
