"""Column expressions against plain Python over many random values, one job each."""

import random
import re
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.dates import elapsed_days, strict_timestamp
from tradewind.functions.numbers import round_half_even
from tradewind.functions.text import whole_number


def moments(rng, n):
    start = datetime(1900, 1, 1)
    return [start + timedelta(microseconds=rng.randrange(6 * 10**15)) for _ in range(n)]


def test_elapsed_days(spark):
    rng = random.Random(1)
    starts = moments(rng, 3000)
    ends = [a + timedelta(seconds=rng.randrange(-400_000, 400_000)) for a in starts[:1500]]
    ends += moments(rng, 1500)
    df = spark.createDataFrame(list(zip(starts, ends)), "a timestamp_ntz, b timestamp_ntz")
    for row in df.select("a", "b", elapsed_days(F.col("a"), F.col("b")).alias("days")).collect():
        assert row["days"] == (row["b"] - row["a"]) // timedelta(days=1)


@pytest.mark.parametrize("digits", [1, 2])
def test_round_half_even(spark, digits):
    rng = random.Random(2)
    values = [rng.randrange(-(10**9), 10**9) / 10 ** rng.randrange(1, 6) for _ in range(3000)]
    values += [k / 8 for k in range(-400, 400)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", round_half_even(F.col("v"), digits).alias("r")).collect()
    for row in rows:
        assert row["r"] == np.rint(row["v"] * 10.0**digits) / 10.0**digits == np.round(
            row["v"], digits
        )


def test_strict_timestamp(spark):
    rng = random.Random(3)
    texts = []
    for moment in moments(rng, 1500):
        text = list(moment.strftime("%Y-%m-%d %H:%M:%S"))
        for _ in range(rng.choice([0, 0, 1, 2])):
            text[rng.randrange(len(text))] = rng.choice("0123456789-: Tx")
        texts.append("".join(text))

    def expected(text):
        if not re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", text):
            return None
        try:
            return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
        except ValueError:
            return None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", strict_timestamp(F.col("t")).alias("p")).collect()
    parsed = {row["t"]: row["p"] for row in rows if not row["t"].startswith("0000")}
    assert parsed == {t: expected(t) for t in parsed}
    assert 500 < sum(p is not None for p in parsed.values()) < 1400


@pytest.mark.parametrize(
    "text, number",
    [("3", 3), ("3.0", 3), ("-7.000", -7), ("3.5", None), ("x", None), (None, None),
     ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None), ("1e3", 1000),
     ("3.0000001", None), ("3.", 3), ("1.5e1", 15), ("1.55e1", None)],
)
def test_whole_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(whole_number(F.col("t"), T.LongType())).first()[0] == number
