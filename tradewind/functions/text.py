"""Reading untyped text cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts that stand for a missing value in a CSV file.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def null_if_token(text: Column) -> Column:
    """Null for the cells that mean "missing"."""
    return F.when(~text.isin(*NULL_TOKENS), text)


def _if_exact(text: Column, number: Column, scale: int) -> Column:
    """The number where its ``scale`` decimals hold all that the text says, else null."""
    scientific = text.rlike("[eE]")
    same = F.when(scientific, number.cast("double") == text.try_cast("double")).otherwise(
        ~text.rlike(rf"\.[0-9]{{{scale}}}[0-9]*[1-9]")
    )
    return F.when(same, number)


def whole_number(text: Column, kind: T.DataType) -> Column:
    """Text to an integer type; takes ``3`` and ``3.0``, null for any fraction and for words."""
    number = text.try_cast(T.DecimalType(38, 0))
    return _if_exact(text, number, 0).try_cast(kind)


def typed_cell(text: Column, kind: T.DataType) -> Column:
    """A cleaned text cell as ``kind``; null when it does not fit without loss."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.IntegralType):
        return whole_number(text, kind)
    if isinstance(kind, T.DecimalType):
        return _if_exact(text, text.try_cast(kind), kind.scale)
    return text.try_cast(kind)


def checked(value: Column, typed: Column, name: str, on_bad_cells: str) -> Column:
    """``typed``; where it is null although ``value`` is not, an error, or null for "count"."""
    if on_bad_cells == "count":
        return typed
    if on_bad_cells != "fail":
        raise ValueError(f"on_bad_cells is fail or count, not {on_bad_cells}")
    message = F.concat(F.lit(f"column {name}, bad cell: "), value.cast("string"))
    return F.when(value.isNotNull() & typed.isNull(), F.raise_error(message)).otherwise(typed)
