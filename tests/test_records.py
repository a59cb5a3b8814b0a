"""Records with line breaks from byte ranges, against the reader that takes a file in one task."""

import random

import pytest

from pyspark.sql import types as T

from tradewind.schemas import RawTable
from tradewind.sources.csv import has_bare_returns, read_csv
from tradewind.sources.records import whole_records

TABLE = RawTable(T.StructType(), keeps_order=True)
CELLS = (
    "a", "", '""', '"x"', '"two\nlines"', '"a,b\n\n,c"', '"say ""hi""\n"""', 'in"side', 'in"side"', " ",
    '"""\n"""', "é\U0001f600", '"\n"', '","', '"\n,"', "NA", '" "',
)


def made(seed, rows, cells=CELLS, end="\n", last=True):
    pick = random.Random(seed)
    lines = ["k,v,w"]
    for i in range(rows):
        row = f"{i},{pick.choice(cells)},{pick.choice(cells)}"
        lines.append(row if pick.random() < 0.9 else f"{i},{pick.choice(cells)}")
        if pick.random() < 0.1:
            lines.append("")
    return ("\n".join(lines) + "\n" * last).replace("\n", end)


def both(spark, path):
    """Rows in file order from the ranges, and from the reader of whole files."""
    ranges = read_csv(spark, path, TABLE, split_above=0)
    ordered = [tuple(r)[:-1] for r in ranges.orderBy("_ord").collect()]
    whole = read_csv(spark, path, TABLE, multi_line=True).orderBy("_ord").collect()
    return ordered, [tuple(r)[:-1] for r in whole]


@pytest.mark.parametrize("size", [11, 90, 3000])
def test_equal_for_every_range_size(spark, conf, tmp_path, size):
    conf("spark.sql.files.maxPartitionBytes", size)
    conf("spark.sql.files.openCostInBytes", 0)
    path = tmp_path / "x.csv"
    text = made(size, 40, last=size != 90)
    path.write_bytes(text.encode())
    got, want = both(spark, str(path))
    assert got == want and len(got) == 40
    assert spark.read.text(str(path)).rdd.getNumPartitions() >= min(8, len(text) // size)
    # Breaks of two characters.
    path.write_bytes(made(size, 40, end="\r\n").encode())
    assert both(spark, str(path)) == (want, want)


def test_several_files_and_one_long_record(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", 500)
    conf("spark.sql.files.openCostInBytes", 0)
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text(made(i, 50) + '9,"' + "many\nlines\n" * 400 + '",z\n', "utf-8")
    got, want = both(spark, str(tmp_path))
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(got) == 255


def test_open_quote_to_the_end(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", 60)
    path = tmp_path / "x.csv"
    path.write_text('k,v,w\n1,"a\nb",c\n2,"never closed\n' + "3,4,5\n" * 40)
    got, want = both(spark, str(path))
    assert got[0] == want[0] == ("1", "a\nb", "c")
    assert len(got) == len(want) == 2 and got[1][1].startswith("never closed\n3,4,5\n3,4,5")


def test_byte_order_mark_and_quoted_header(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('k,"v\n1",w\n1,"a\nb",c\n', "utf-8-sig")
    df = read_csv(spark, str(path), TABLE, split_above=0)
    assert df.columns == ["k", "v\n1", "w", "_ord"] and tuple(df.first())[:3] == ("1", "a\nb", "c")


def test_headers_that_disagree_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v,w\n1,"a\nb",c\n')
    (tmp_path / "b.csv").write_text('k,w,v\n1,"a\nb",c\n')
    with pytest.raises(Exception, match="header differs"):
        read_csv(spark, str(tmp_path), TABLE, split_above=0).collect()


def test_bare_returns_are_left_to_the_whole_file_reader(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes(b'k,v,w\r\n1,"a\rb\r\nc",d\r\n')
    assert has_bare_returns(spark, str(path))
    got, want = both(spark, str(path))
    assert got == want


def test_no_task_reads_the_file_and_no_text_is_shuffled(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", 2000)
    conf("spark.sql.files.openCostInBytes", 0)
    path = tmp_path / "x.csv"
    path.write_text(made(1, 400))
    records = whole_records(spark, str(path)).filter("_record > 0")
    plan = records._jdf.queryExecution().executedPlan().toString()
    whole = plan.split("Aggregate")[0]
    assert "BroadcastHashJoin" in whole and "Exchange hashpartitioning" not in whole
    assert spark.read.text(str(path)).rdd.getNumPartitions() >= 4
    assert records.count() == 401


def test_size_decides_how_a_file_is_read(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text(made(2, 20))
    plans = [
        read_csv(spark, str(path), TABLE, split_above=size)._jdf.queryExecution().toString()
        for size in (0, 10**6)
    ]
    assert "MapInArrow" in plans[0] and "MapInArrow" not in plans[1]
