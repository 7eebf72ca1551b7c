"""Encoding is exact however texts are cut; pieces keep their limit, overlap and text."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm import tokens as T

PATH = T.vocabulary_path()
mixed = st.text(alphabet=st.sampled_from("abc  \n\t.,'日本é—1😀’s  ́"), max_size=300)


@settings(max_examples=300, deadline=None)
@given(mixed, st.integers(3, 12), st.integers(12, 40))
def test_chunks_joined_are_the_whole(text, least, most):
    enc = T.encoder(PATH)
    parts, start, before, whole = [], 0, 0, ""
    for end, sure in T.chunk_ends(text, least, 18, most):
        piece = text[start:end]
        parts.append((np.array(enc.encode_ordinary(piece), dtype=np.uint16), before | (0 if sure else 2), piece))
        start, before, whole = end, 0 if sure else 1, whole + piece
    assert whole == text and T.joined(enc, parts).tolist() == enc.encode_ordinary(text)


def test_chunks_depend_on_content_not_on_place():
    body = " ".join(f"word{i * 7919 % 1000} of" for i in range(4000))
    cut = lambda t: {t[a:b] for a, b in zip([0, *[e for e, _ in T.chunk_ends(t, 256, 1024, 8192)]], [e for e, _ in T.chunk_ends(t, 256, 1024, 8192)])}
    a, b = cut(body), cut("Another beginning altogether, " + body)
    assert len(a & b) > 0.8 * len(a)


def test_encode_corpus(spark):
    enc = T.encoder(PATH)
    texts = [None, "", "  ", "plain text", "<|endoftext|> stays", "x" * 40_000, "word " * 9000, "日本語" * 5000, "plain text", "a\u0000b"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, uid string")
    got = {r.doc_id: list(r.ids) for r in T.encode_corpus(df).collect()}
    assert got == {i: enc.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert T.encode_corpus(df.limit(0)).count() == 0
    twice = df.where("doc_id = 3").union(df.where("doc_id = 3"))
    assert [list(r.ids) for r in T.encode_corpus(twice).collect()] == [got[3]] * 2


@settings(max_examples=300, deadline=None)
@given(mixed, st.integers(5, 30), st.integers(0, 6))
def test_pieces(text, most, overlap):
    enc, lengths = T.encoder(PATH), T.token_lengths(PATH)
    pieces = T.cut_places(enc, lengths, text, most, overlap)
    data = text.encode()
    if not pieces:
        assert text == ""
        return
    assert pieces[0][0] == 0 and pieces[-1][1] == len(data) and pieces[-1][5] == "end"
    for a, b, s, e, n, _ in pieces:
        assert n == len(enc.encode_ordinary(data[a:b].decode())) <= most
        assert s < e
    for p, q in zip(pieces, pieces[1:]):
        assert p[2] < q[2] and q[0] <= p[1]
        assert p[3] - q[2] >= min(overlap, most - 1) or p[3] == q[2]


def test_natural_boundaries_come_first():
    enc, lengths = T.encoder(PATH), T.token_lengths(PATH)
    text = "One two three four five six seven. Eight nine ten.\n\nNext paragraph has some words here and there"
    kinds = [p[5] for p in T.cut_places(enc, lengths, text, 14, 2)]
    assert kinds[0] == "paragraph" and kinds[-1] == "end"


@pytest.mark.parametrize("overlap", [0, None, 500])
def test_split_oversized(spark, overlap):
    docs = spark.createDataFrame([(1, "word " * 300, "a", "x"), (2, "short", "a", "x"), (3, None, "a", "x"), (4, "", "a", "x"), (5, "word " * 300, None, "x"), (6, "word " * 300, "zz", "x")], "doc_id bigint, text string, source string, cut string")
    limits = spark.createDataFrame([("a", 64, overlap), ("a", 100, 0), (None, 5, 1), ("b", None, None)], "source string, max_tokens int, overlap_tokens int")
    got = T.split_oversized(docs, limits).collect()
    assert {r.doc_id for r in got} == {1} and all(r.n_tokens <= 64 for r in got)
    assert sorted(r.piece_no for r in got) == list(range(1, len(got) + 1)) and got[0].n_pieces == len(got)
    if not overlap:
        assert "".join(r.text for r in sorted(got, key=lambda r: r.piece_no)) == "word " * 300
    assert T.split_oversized(docs.limit(0), limits).count() == 0
