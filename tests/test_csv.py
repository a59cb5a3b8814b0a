"""CSV ingest: null tokens, types, header handling, row order, missing files."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.operators.aggregates import keep_first, row_order
from tradewind.schemas import RAW_TABLES, RawTable
from tradewind.sinks.tables import ParquetSink
from tradewind.sources.csv import has_quoted_breaks, ingest, read_csv
from tradewind.sources.tables import ParquetZone

ITEMS = RAW_TABLES["raw_order_items"]


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


@pytest.mark.parametrize("cell", ["", "NA", "null", "nan", "n/a", "#N/A", "<NA>", "None", '""'])
def test_null_tokens(spark, tmp_path, cell):
    path = write(tmp_path / "p.csv", f"product_id,product_category_name\n1,{cell}\n2,kept\n")
    df = read_csv(spark, path, RAW_TABLES["raw_products"]).drop("_ord")
    assert [tuple(r) for r in df.collect()] == [("1", None), ("2", "kept")]


def test_columns_are_found_by_name_and_extras_pass_through(spark, tmp_path):
    path = write(
        tmp_path / "i.csv",
        "price,order_id,extra,order_item_id,product_id,seller_id,freight_value\n"
        '1.25,o1,"a, ""b""",1,p,s,0.5\nbad,o2,,2.0,p,s,7\n1,o3,x,2.5,p,s,\n',
    )
    df = read_csv(spark, path, ITEMS, on_bad_cells="count")
    assert df.columns[2] == "extra" and df.schema["price"].dataType == T.DecimalType(18, 4)
    rows = {r["order_id"]: r for r in df.collect()}
    assert rows["o1"]["extra"] == 'a, "b"' and rows["o1"]["price"] == Decimal("1.25")
    assert rows["o2"]["price"] is None and rows["o2"]["order_item_id"] == 2
    assert rows["o3"]["order_item_id"] is None and rows["o3"]["freight_value"] is None


def test_leading_zeros_survive(spark, tmp_path):
    header = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state"
    path = write(tmp_path / "c.csv", header + "\nc,u,03149,x,SP\n")
    df = read_csv(spark, path, RAW_TABLES["raw_customers"])
    assert df.first()["customer_zip_code_prefix"] == "03149"


def test_byte_order_mark(spark, tmp_path):
    text = "product_category_name,product_category_name_english\nmóveis,furniture\n"
    path = write(tmp_path / "t.csv", text, "utf-8-sig")
    df = read_csv(spark, path, RAW_TABLES["raw_category_translation"])
    assert tuple(df.first()) == ("móveis", "furniture")


def test_inferred_types(spark, tmp_path):
    path = write(tmp_path / "x.csv", "a,b,c,d,e\n1,1.5,x,,2\n2,2,3,,\n")
    df = read_csv(spark, path, RawTable(T.StructType()), infer_undeclared=True)
    assert [t for _, t in df.dtypes] == ["bigint", "double", "string", "string", "bigint"]
    assert [tuple(r) for r in df.collect()] == [(1, 1.5, "x", None, 2), (2, 2.0, "3", None, None)]


def test_quoted_line_breaks(spark, tmp_path):
    text = 'product_id,product_category_name\n1,"two\nlines"\n2,"say ""a"""\n'
    path = write(tmp_path / "p.csv", text)
    for options in ({}, {"multi_line": True}):
        df = read_csv(spark, path, RAW_TABLES["raw_products"], **options)
        # The file's order is in the recorded position.
        assert [r[1] for r in df.orderBy("_ord").collect()] == ["two\nlines", 'say "a"']
    plain = write(tmp_path / "q.csv", 'product_id,product_category_name\n2,"say ""a"""\n')
    assert has_quoted_breaks(spark, path) and not has_quoted_breaks(spark, plain)


HEADER = "order_id,order_item_id,product_id,seller_id,price,freight_value"


@pytest.mark.parametrize(
    "column, cell",
    [("price", "100000000000000.5"), ("price", "inf"), ("price", '"12,50"'), ("price", "1.23456"),
     ("freight_value", "1.23456e0"), ("order_item_id", "3.0000001"), ("order_item_id", "x"),
     ("order_item_id", "3000000000"), ("price", "-0.00001"), ("price", "1e-20")],
)
def test_bad_cells_fail_or_are_counted(spark, tmp_path, column, cell):
    good = {"order_item_id": "3.0", "price": "1.2500", "freight_value": "1.5e1"}
    row = good | {column: cell}
    lines = [f"o,{r['order_item_id']},p,s,{r['price']},{r['freight_value']}" for r in (good, row)]
    write(tmp_path / "i.csv", "\n".join([HEADER, *lines, "o,NA,p,s,nan,"]) + "\n")
    sink = ParquetSink(ParquetZone(spark, str(tmp_path / "raw")))
    manifest = {"i.csv": "raw_order_items"}
    with pytest.raises(Exception, match=f"column {column}, bad cell"):
        ingest(spark, str(tmp_path), sink, manifest)
    found = ingest(spark, str(tmp_path), sink, manifest, on_bad_cells="count")
    assert found == {"raw_order_items": 3}
    assert found.bad_cells == {("raw_order_items", column): 1}
    rows = sink.zone.table("raw_order_items").orderBy(F.col(column).desc_nulls_last()).collect()
    assert [r[column] is None for r in rows] == [False, True, True]
    assert rows[0]["order_item_id"] == 3 and rows[0]["freight_value"] == 15


def test_undeclared_tables_come_in_inferred(spark, tmp_path):
    write(tmp_path / "sellers.csv", "seller_id,score\n1,0.5\n2,\n")
    sink = ParquetSink(ParquetZone(spark, str(tmp_path / "raw")))
    assert ingest(spark, str(tmp_path), sink, {"sellers.csv": "raw_sellers"}) == {"raw_sellers": 2}
    assert sink.zone.table("raw_sellers").dtypes == [("seller_id", "bigint"), ("score", "double")]


def test_missing_column_is_named(spark, tmp_path):
    path = write(tmp_path / "p.csv", "product_id\n1\n")
    with pytest.raises(ValueError, match="product_category_name"):
        read_csv(spark, path, RAW_TABLES["raw_products"])


def test_row_order_follows_the_file_over_splits(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", 300_000)
    conf("spark.sql.files.openCostInBytes", 0)
    lines = "".join(f"{i % 10},row{i}\n" for i in range(200_000))
    path = write(tmp_path / "p.csv", "product_id,product_category_name\n" + lines)
    df = read_csv(spark, path, RAW_TABLES["raw_products"])
    assert df.rdd.getNumPartitions() >= 5
    ordered = [r[1] for r in df.orderBy("_ord").collect()]
    assert ordered == [f"row{i}" for i in range(200_000)]
    first = keep_first(df, "product_id", row_order(df, "product_category_name"))
    assert {tuple(r) for r in first.collect()} == {(str(i), f"row{i}") for i in range(10)}


def test_ingest_skips_missing_files(spark, tmp_path, caplog):
    write(tmp_path / "products.csv", "product_id,product_category_name\n1,a\n")
    write(
        tmp_path / "category_translation.csv",
        "product_category_name,product_category_name_english\na,b\n",
    )
    sink = ParquetSink(ParquetZone(spark, str(tmp_path / "raw")))
    counts = ingest(spark, str(tmp_path), sink)
    assert counts == {"raw_products": 1, "raw_category_translation": 1}
    assert caplog.text.count("not found, skipped") == 4
    assert sink.zone.table("raw_products").select("product_id").first()[0] == "1"
    with pytest.raises(FileNotFoundError):
        ingest(spark, str(tmp_path), sink, on_missing="fail")


def test_ingest_replaces_the_table(spark, tmp_path):
    sink = ParquetSink(ParquetZone(spark, str(tmp_path / "raw")))
    manifest = {"any name.csv": "raw_products"}
    for n in (3, 2):
        body = "".join(f"{i},a\n" for i in range(n))
        write(tmp_path / "any name.csv", "product_id,product_category_name\n" + body)
        assert ingest(spark, str(tmp_path), sink, manifest) == {"raw_products": n}
    assert sink.zone.table("raw_products").agg(F.count("*")).first()[0] == 2
