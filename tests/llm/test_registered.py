"""Every registered query of the subpackage runs; those with SQL give the same rows."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import oracle  # noqa: E402

from folioflow.llm import registry, tokens  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_its_sql(spark, con, name):
    oracle.same(spark, con, registry.QUERIES[name], registry.SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL) - {"p8_ids"}))
def test_gives_rows(spark, name):
    df = registry.QUERIES[name](spark, oracle.DATA)
    assert df.count() > 0


def test_ids_are_those_of_whole_texts(spark):
    enc = tokens.encoder(tokens.vocabulary_path())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{oracle.DATA}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: list(r.ids) for r in registry.QUERIES["p8_ids"](spark, oracle.DATA).collect()}
    assert got == {k: enc.encode_ordinary(t or "") for k, t in texts.items()}
