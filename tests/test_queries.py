"""Every registered query against its SQL twin on the smallest test set."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


#: Trained models and the tokenizer have no SQL; their tests are in tests/llm.
WITHOUT_SQL = {"op1_pii", "op3_url_filter", "op6_language_id", "op7_bpe", "op8_toxicity", "op10_quality", "op11_lm_score",
               "pipeline"}


def test_every_query_has_its_sql():
    assert set(entry_points.queries()) - WITHOUT_SQL == set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query(spark, con, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert compare(df, con, entry_points.oracle_sql()[name]) is None
