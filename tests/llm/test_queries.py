"""The registered training-data queries over the driver tables: against their SQL, or for their contract's columns."""

import os

import pytest

from compare import compare, connect
from marketlake.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

COLUMNS = {
    "op1_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op2_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3_language_id": "doc_id held_out lang_pred score",
    "op7_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op8_simhash": "doc_id fingerprint component_id",
    "op9_toxicity": "doc_id held_out score predicted",
    "op11_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op13_whitening": "vec_id component n deviation whitened explained identity_error",
}


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_is_covered():
    assert set(QUERIES) == set(SQL) | set(COLUMNS) and not set(SQL) & set(COLUMNS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, tables, name):
    assert compare(QUERIES[name](spark, SF_DIR), tables, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_covers_its_table(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    documents = tables.execute("select count(*) from documents").fetchone()[0]
    if name == "op13_whitening":
        found = df.agg({"component": "max", "identity_error": "max"}).first()
        assert found["max(component)"] == 32 and found["max(identity_error)"] <= 0.0001
    elif name == "op1_packing":
        assert df.select("doc_id").distinct().count() == documents
    else:
        assert df.count() == documents
