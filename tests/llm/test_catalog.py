"""The registered queries on the smallest tables: against their SQL, or for one row per input row."""

import pytest

import __spark_entry__ as contract
from gameflow.llm import catalog
from tests.oracle_check import actual, duck, expected

SF_DIR = "/root/testdata/sf0.001"
PER_ROW = {
    "op3_visible_text": "pages", "op5_simhash_components": "documents", "op6_suffix_dedup": "documents",
    "op7_katz_scores": "documents", "op11_toxicity_scores": "documents",
}


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert actual(catalog.QUERIES[name](spark, SF_DIR)) == expected(duck(SF_DIR), catalog.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_a_row_for_each_row(spark, name):
    key = "page_id" if PER_ROW[name] == "pages" else "doc_id"
    ids = sorted(r[key] for r in spark.read.parquet(f"{SF_DIR}/{PER_ROW[name]}.parquet").select(key).collect())
    assert sorted(r[key] for r in catalog.QUERIES[name](spark, SF_DIR).collect()) == ids


def test_all_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*catalog.QUERIES, "pipeline"} <= set(contract.queries())
    assert set(catalog.ORACLE_SQL) <= set(contract.oracle_sql())
