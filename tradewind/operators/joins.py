"""Left outer equi-joins.

No broadcast hints: Catalyst and AQE broadcast a side when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``, and sort-merge beyond. A hot key on the *left* of a
left join, null included, is split by AQE at run time. A hot key on the *right* cannot be,
because every split would have to know whether another one matched; :func:`fan_out_join` is for
that case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join for an N:1 lookup; a null key matches nothing."""
    return left.join(right, key, "left")


def fan_out_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join for a 1:N fan-out where one key may hold most of the right side.

    The matches come from an inner join, either side of which AQE can split, and the left rows
    without any from an anti join, whose right side is each key once. Nothing depends on the
    order or the number of rows.
    """
    matched = left.join(right, key)
    alone = left.join(right.select(key).distinct(), key, "left_anti")
    others = {f.name: F.lit(None).cast(f.dataType) for f in right.schema if f.name != key}
    return matched.unionByName(alone.withColumns(others))
