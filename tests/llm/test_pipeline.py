"""The corpus pipeline: its stages in order, each on what the one before kept."""

import llm_cases as cases
import pytest
from test_decontaminate import ITEM_SCHEMA, ITEMS, leaking_rows
from test_decontaminate import expected as hits
from test_outliers import quality_rows
from test_simhash import plain_components, plain_print

import corpus_pipeline
import __spark_entry__ as contract


@pytest.fixture
def folder(spark, tmp_path):
    rows = quality_rows() + leaking_rows()
    rows += [
        (6000 + i, cases.prose(500 + i, 90) + " " + cases.prose(900, 40), "en", "news", 1)
        for i in range(8)
    ]
    cases.stored_documents(cases.table(spark, rows), tmp_path)
    spark.createDataFrame(ITEMS, ITEM_SCHEMA).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder).cache()
        if name != "shards":
            assert after.columns == columns
        before = [tuple(r) for r in docs.collect()]
        rows = [tuple(r)[:5] for r in after.collect()]
        if name == "near_duplicates":
            prints = [plain_print(r[1]) for r in before]
            groups = plain_components(prints, range(len(before)))
            named = plain_components(prints, [r[0] for r in before])
            assert sorted(r[0] for r in rows) == sorted(dict(zip(groups, named, strict=True)).values())
        if name == "decontamination":
            clean = [h[0] for h in hits(before, ITEMS) if not h[-1]]
            assert sorted(r[0] for r in rows) == sorted(clean)
        if name in ("quality", "near_duplicates", "decontamination"):
            assert len(rows) < len(before) and set(rows) <= set(before)
        if name == "shards":
            assert sorted(rows) == sorted(before)
        seen.append(name)
        docs = after
    assert seen == ["quality", "near_duplicates", "decontamination", "mixture", "shards"]


def test_run_is_registered(spark, folder):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[-2:] == ["shard", "slot"]
    assert out.count() > 0
