"""The given tables reshaped into the six raw input tables by pure expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradewind.sources.extract import extract


def _shifted(seconds: str) -> str:
    """Order date plus an expression in seconds, as text."""
    return f"cast(o_orderdate + make_dt_interval(0, 0, 0, {seconds}) as string)"


_PURCHASE = "(o_orderkey * 7919) % 86400"
_DELIVERY = "(o_orderkey * 31) % 40 * 86400 - 86400 + (o_orderkey * 104729) % 86400"

_ORDERS = (
    "o_orderkey as order_id",
    "o_custkey as customer_id",
    "if(o_orderstatus = 'F', 'delivered', if(o_orderstatus = 'O', 'shipped', 'canceled'))"
    " as order_status",
    f"case when o_orderkey % 97 = 0 then 'not a date' else {_shifted(_PURCHASE)} end"
    " as order_purchase_timestamp",
    f"{_shifted(_PURCHASE + ' + 3600')} as order_approved_at",
    f"{_shifted(_PURCHASE + ' + 86400')} as order_delivered_carrier_date",
    f"case when o_orderkey % 53 != 0 then {_shifted(_DELIVERY)} end"
    " as order_delivered_customer_date",
    f"{_shifted('20 * 86400')} as order_estimated_delivery_date",
)
_CUSTOMERS = (
    "c_custkey as customer_id",
    "case when c_custkey % 5 = 4 then c_custkey - 1 else c_custkey end as customer_unique_id",
    "c_nationkey * 1000 + 7 as customer_zip_code_prefix",
    "c_mktsegment as customer_city",
    "case when c_custkey % 101 != 0 then n_name end as customer_state",
)
_ITEMS = (
    "l_orderkey as order_id",
    "l_linenumber as order_item_id",
    "l_partkey as product_id",
    "l_suppkey as seller_id",
    "cast(l_extendedprice as decimal(18,4)) as price",
    "cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))"
    " as decimal(18,4)) as freight_value",
)
_PRODUCTS = (
    "p_partkey as product_id",
    "case when p_partkey % 53 != 0 then p_type end as product_category_name",
)
# One line stands for one payment; the line's own columns give the payments their order.
_PAYMENTS = (
    "l_orderkey as order_id",
    "case l_returnflag when 'A' then 'credit_card' when 'R' then 'voucher' end as payment_type",
    "l_linenumber as payment_installments",
    "case when l_orderkey % 41 != 0 then cast(l_extendedprice as decimal(18,4)) end"
    " as payment_value",
    "struct(l_linenumber, l_partkey, l_suppkey, l_extendedprice) as _ord",
)
_SELLERS = (
    "s_suppkey as seller_id",
    "s_name as seller_name",
    "cast(s_nationkey as bigint) as seller_nation",
)
# SMALL and STANDARD have no translation.
_TRANSLATION = """
    select * from values
      ('ECONOMY', 'economy goods'), ('LARGE', 'large goods'),
      ('MEDIUM', 'medium goods'), ('PROMO', 'promotional goods')
    as t(product_category_name, product_category_name_english)
"""


# Columns of the given tables that the mapping uses; declared, so that no job reads footers.
_GIVEN_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
    " o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_type string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_extendedprice double, l_tax double, l_returnflag string",
}


@dataclass(frozen=True)
class GivenTables:
    """Source that serves the raw tables from a folder of the given parquet files."""

    spark: SparkSession
    folder: str

    def _given(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(_GIVEN_SCHEMAS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        if name == "raw_orders":
            return self._given("orders").selectExpr(*_ORDERS)
        if name == "raw_customers":
            nation, customer = self._given("nation"), self._given("customer")
            same_nation = customer.c_nationkey == nation.n_nationkey
            return customer.join(nation, same_nation).selectExpr(*_CUSTOMERS)
        if name == "raw_order_items":
            return self._given("lineitem").selectExpr(*_ITEMS)
        if name == "raw_products":
            return self._given("part").selectExpr(*_PRODUCTS)
        if name == "raw_order_payments":
            return self._given("lineitem").selectExpr(*_PAYMENTS)
        if name == "raw_sellers":
            return self._given("supplier").selectExpr(*_SELLERS)
        if name == "raw_category_translation":
            return self.spark.sql(_TRANSLATION)
        raise KeyError(name)


def given_inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five extracted inputs over the given tables."""
    return extract(GivenTables(spark, folder))
