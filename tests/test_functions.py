"""Identifiers and text functions against Python's own library and known cases."""

import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioflow.functions import identifiers as ids
from folioflow.functions import text as tx


def one(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_doi(spark):
    raw = ["10.1145/3292500", "https://doi.org/10.1145/3292500", "http://dx.doi.org/10.1145/3292500", "doi: 10.1145/3292500", "  10.1145/ABC ", "", "not-a-doi", None]
    assert one(spark, raw, ids.doi) == ["10.1145/3292500"] * 4 + ["10.1145/abc", None, None, None]


def test_arxiv_id(spark):
    raw = ["1706.03762", "arXiv:1706.03762v5", "https://arxiv.org/abs/1706.03762v2", "hep-th/9901001", "math.GT/0309136v1", "17.1", None]
    assert one(spark, raw, ids.arxiv_id) == ["1706.03762"] * 3 + ["hep-th/9901001", "math.gt/0309136", None, None]
    assert one(spark, ["1706.03762v5"], lambda c: ids.arxiv_id(c, False)) == ["1706.03762v5"]


def test_orcid_and_ror(spark):
    raw = ["0000-0002-1825-0097", "https://orcid.org/0000-0002-1825-0097", "0000000218250097", "0000-0002-1825-0099", "0000-0002-1694-233X", "X", None]
    assert one(spark, raw, ids.orcid) == ["0000-0002-1825-0097"] * 3 + [None, "0000-0002-1694-233X", None, None]
    assert one(spark, ["03vek6s52", "https://ror.org/03VEK6S52", "13vek6s52", None], ids.ror) == ["https://ror.org/03vek6s52"] * 2 + [None, None]


def test_uuid5_equals_the_library(spark):
    keys = ["doi:10.1/x", "name:élan ñ 漢", "", "cluster:crossref:"]
    for kind, ns in ids.NAMESPACES.items():
        assert one(spark, keys, lambda c: ids.uuid5(kind, c)) == [str(uuid.uuid5(uuid.UUID(ns), k)) for k in keys]  # noqa: B023


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cn", "Co", "M", "Sk", "No", "Nl", "Lm", "Lo")), max_size=30), min_size=1, max_size=20))
def test_slug_is_that_of_unicode_words(spark, values):
    import re

    due = [re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", v.lower())).strip() for v in values]
    got = one(spark, values, tx.slug)
    ascii_only = [i for i, v in enumerate(values) if v.isascii() and "\0" not in v]
    assert [got[i] for i in ascii_only] == [due[i] for i in ascii_only]


def test_text(spark):
    assert one(spark, ["  a \n b ", "", "   ", None], tx.clean_text) == ["a b", None, None, None]
    assert one(spark, ["``Q''  `x`", None], tx.plain_tex) == ['"Q" \'x\'', ""]
    assert one(spark, ["<jats:p>A  b</jats:p>", "<p></p>", None], tx.without_tags) == ["A b", None, None]
    assert one(spark, ["A-B_c!  d", None], tx.slug) == ["ab_c d", ""]


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.125,), (0.0,)], "x double")
    assert [r.o for r in df.select(tx.rounded(F.col("x")).alias("o")).collect()] == [1.0, 2.13, 0.0]


def test_fingerprint(spark):
    df = spark.createDataFrame([("T x", 2020, "A"), ("T x", None, None)], "t string, y int, a string")
    a, b = [r.o for r in df.select(ids.fingerprint(F.col("t"), F.col("y"), F.col("a")).alias("o")).collect()]
    import hashlib

    assert a == hashlib.md5(b"t x|2020|a").hexdigest() and b == hashlib.md5(b"t x|unknown|").hexdigest()


@pytest.mark.parametrize("name", ["citation_velocity", "slugify"])
def test_registry_has_sql(name):
    from folioflow.plans import registry

    assert name in registry.QUERIES and name in registry.SQL
