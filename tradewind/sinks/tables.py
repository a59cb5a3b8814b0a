"""Replacing stored tables, with the row count taken while writing."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tradewind.sources.tables import CatalogZone, JdbcZone, ParquetZone


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with a row counter that fills during its one action.

    The counter sits in the last stage, where each finished task counts once even
    when an executor is lost and its tasks run again.
    """
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def rows_of(observation: Observation) -> int:
    """Rows counted by a finished action."""
    return observation.get.get("rows", 0)


@dataclass(frozen=True)
class ParquetSink:
    """Replaces ``<root>/<table>`` folders."""

    zone: ParquetZone

    def write(self, df: DataFrame, name: str, folders: str | None = None) -> int:
        """Write a table, in one folder per value of the column ``folders`` if given."""
        df, observation = counted(df)
        writer = df.write.mode("overwrite")
        if folders:
            writer = writer.partitionBy(folders)
        writer.parquet(self.zone.path(name))
        return rows_of(observation)


@dataclass(frozen=True)
class CatalogSink:
    """Replaces catalog tables."""

    zone: CatalogZone

    def write(self, df: DataFrame, name: str) -> int:
        df, observation = counted(df)
        df.write.format("parquet").mode("overwrite").saveAsTable(self.zone.path(name))
        return rows_of(observation)


@dataclass(frozen=True)
class JdbcSink:
    """Replaces database tables in batched inserts."""

    zone: JdbcZone

    def write(self, df: DataFrame, name: str) -> int:
        df, observation = counted(df)
        self.zone.replace(df, name)
        return rows_of(observation)

    def write_all(self, tables: Mapping[str, DataFrame]) -> dict[str, int]:
        """Replace several tables; readers see all the old ones or all the new ones.

        All are written beside the old ones first. Where the database's dialect knows no swap,
        they are replaced one by one.
        """
        if not self.zone.can_swap():
            return {name: self.write(df, name) for name, df in tables.items()}
        rows, staged = {}, {}
        for name, df in tables.items():
            df, observation = counted(df)
            staged[self.zone.stage(df, name)] = name
            rows[name] = rows_of(observation)
        self.zone.swap(staged)
        return rows
