"""The registered queries on the small tables: those with SQL against it, the others for their contract."""

import pytest

from quire.llm.queries import ORACLES, QUERIES
from tests.compare import SF, connection, same

COLUMNS = {
    "op3_quality": ["doc_id", "held_out", "score", "predicted"],
    "op4_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op6_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op7_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_simhash": ["doc_id", "fingerprint", "component_id"],
    "op10_substring": ["doc_id", "component_id"],
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_is_its_sql(spark, name):
    same(QUERIES[name](spark, SF), connection(), ORACLES[name])


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_returns_all_documents(spark, name):
    got = QUERIES[name](spark, SF)
    assert got.columns[: len(COLUMNS[name])] == COLUMNS[name]
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
