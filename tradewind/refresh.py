"""Refreshing the marts over orders from new loads only.

A load holds rows that were added since the one before, in the layout of
:class:`tradewind.sources.tables.LoadZone`. The states of all orders are stored per refresh, with the loads that
they are made of; a refresh reads the loads that are not among them, merges their states into the
stored ones, and builds the marts from there. Items and payments are read once, ever.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradewind.plans import marts, rollups, star
from tradewind.plans.states import merged, order_states, totals_of
from tradewind.session import child_files, fit_shuffles, put_if_absent, read_text
from tradewind.sources.extract import conform
from tradewind.sources.tables import LoadZone, ParquetZone

log = logging.getLogger(__name__)

INCREMENTS = ("raw_orders", "raw_order_items", "raw_order_payments")


class OvertakenError(RuntimeError):
    """Another refresh has stored states meanwhile."""


@dataclass(frozen=True)
class OrderStates:
    """Merged states below ``<root>``, one version per refresh, the last of which counts."""

    spark: SparkSession
    root: str

    def _versions(self) -> str:
        return f"{self.root.rstrip('/')}/_versions"

    def version(self) -> int:
        """Number of the last version; 0 before the first."""
        names = child_files(self.spark, self._versions())
        return max((int(name) for name in names if name.isdigit()), default=0)

    def _zone(self) -> ParquetZone:
        return ParquetZone(self.spark, self.root)

    def last(self) -> tuple[DataFrame | None, list[str]]:
        """The last states, and the loads that they are made of."""
        number = self.version()
        if not number:
            return None, []
        entry = json.loads(read_text(self.spark, f"{self._versions()}/{number:012d}"))
        return self._zone().table(entry["table"]), entry["loads"]

    def advance(self, loads: LoadZone) -> list[str]:
        """Merge the loads that the states do not hold yet; their ids.

        Which loads those are is known by id, not by time, so a load that is entered late is
        not missed. Of two refreshes at a time one fails and changes nothing.
        """
        number = self.version()
        states, done = self.last()
        entered = loads.entered()
        new = [load_id for load_id in sorted(entered) if load_id not in set(done)]
        if not new:
            return []
        parts = [] if states is None else [states]
        for load_id in new:
            tables = [_table(loads, load_id, name, entered) for name in INCREMENTS]
            fit_shuffles(self.spark, *tables, *parts[:1])
            parts.append(order_states(load_id, *tables))
        # A name of its own, as another refresh may be writing at the same time.
        table = f"states/{number + 1:012d}-{uuid.uuid4().hex[:8]}"
        merged(*parts).write.mode("overwrite").parquet(self._zone().path(table))
        entry = json.dumps({"table": table, "loads": [*done, *new]})
        if not put_if_absent(self.spark, f"{self._versions()}/{number + 1:012d}", entry):
            raise OvertakenError(f"states {number + 1} under {self.root} are stored already")
        log.info("states %d from loads %s", number + 1, ", ".join(new))
        return new

    def totals(self) -> DataFrame:
        """Totals of all delivered orders, as the full refresh has them."""
        states, _ = self.last()
        if states is None:
            raise LookupError(f"no states under {self.root}")
        return totals_of(states)


def _table(loads: LoadZone, load_id: str, name: str, entered: Mapping[str, list[str]]) -> DataFrame:
    """A table of a load; one that the load does not have is empty, as other loads have it."""
    if name in entered[load_id]:
        return conform(loads.folder(load_id).table(name))
    other = next((i for i in sorted(entered) if name in entered[i]), None)
    if other is None:
        raise LookupError(f"no load has {name}")
    return conform(loads.folder(other).table(name)).limit(0)


def order_marts(totals: DataFrame, customers: DataFrame) -> dict[str, DataFrame]:
    """The four warehouse tables that come from order totals.

    Customers must be unique by ``customer_id``, as for the rollups.
    """
    return {
        "daily_revenue": rollups.daily_revenue(totals),
        "customer_summary": rollups.customer_summary(totals, customers),
        "delivery_performance": marts.delivery_performance(totals, customers),
        "dim_date": star.dim_date(totals),
    }
