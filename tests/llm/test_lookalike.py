import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from punctual.llm import lookalike
from punctual.llm.lookalike import Rewriter, UnionFind, alike_classes, alike_pairs, fit_rewriter, normalize_texts, unit_frequencies

R = Rewriter()


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("Hello, 42!", "Ｈｅｌｌｏ， ４２！"), ("café", "café"), ("note book", "note book"), ("note book", "no​te　bo﻿ok"), ("Tokyo", "Тоkуо"),
        ("é", "е́"), ("ë", "ё"), ("ї", "ï"), ("ό", "о́"), ("ệ", "ệ"), ("ệ", "ệ"), ("Å", "Å"), ("ガ", "ｶﾞ"), ("한", "한"),
        ("a\r\nb", "a\nb"), ("soft", "so­ft"), ("é", "e‍́"),
    ],
)
def test_look_the_same(a, b):
    assert R(a) == R(b)


@pytest.mark.parametrize(("a", "b"), [("Hello", "hello"), ("cafe", "café"), ("l", "1"), ("O", "0"), ("rn", "m"), ("a b", "ab"), ("a b", "a  b"), ("²", "2"), ("ﬁ", "fi"), ("и", "й"), ("е", "ё")])
def test_look_different(a, b):
    assert R(a) != R(b)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aeoOcеоАВ éëё̣́̈​　ａＡ한1하")), max_size=20))
def test_rewriting_is_stable(text):
    once = R(text)
    assert R(once) == once == R(unicodedata.normalize("NFD", text)) == R(unicodedata.normalize("NFC", text))


def test_frequent_member_stands_for_its_class():
    cyrillic = Rewriter({"о": 10, "o": 3, "ё": 5, "ë": 1})
    assert cyrillic("o") == "о" and cyrillic("ë") == "ё" and cyrillic("oо") == "оо"


def test_union_find():
    uf = UnionFind()
    for a, b in (("a", "b"), ("c", "d"), ("b", "d")):
        uf.union(a, b)
    assert len({uf.find(x) for x in "abcd"}) == 1 and uf.find("z") == "z"


def test_tables(spark):
    rows = [
        (1, "Oh no"), (2, "Оh nо"), (3, "Oh no"), (4, "Oh no"), (5, "oh no"), (6, None), (7, ""), (8, "​  "), (9, " "), (10, "x" * 200_000), (11, "x" * 199_999 + "х"),
        (12, "plain"), (12, "plain"),
    ]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, look string")
    got = {tuple(r) for r in alike_pairs(docs).collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (2, 4), (3, 4), (10, 11)}
    out = normalize_texts(docs, fit_rewriter(docs)).collect()
    by = {r.doc_id: r.canonical for r in out}
    assert len(out) == 13 and by[6] is None and by[7] == "" and by[2] == "Oh no" and by[11] == "x" * 200_000
    n = {r.unit: r.n for r in unit_frequencies(docs).collect()}
    assert n[" "] == 2 and n["O"] == 3 and n["О"] == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alike_pairs(docs).count() == 0 and normalize_texts(docs, R).count() == 0


def test_classes_say_what_the_pairs_say(spark):
    rows = [(1, "Oh no"), (2, "Оh nо"), (3, "Oh no"), (4, "Oh no"), (5, "oh no"), (6, None), (7, ""), (8, "​"), (5, "oh no"), (9, "LISU"), (10, "ꓡꓲꓢꓴ")]
    docs = spark.createDataFrame([(i, t, "k", 0) for i, t in rows], "doc_id long, text string, form string, n long")
    got = sorted(map(tuple, alike_classes(docs).collect()))
    assert got == [(1, 1, 1, 3, 4), (2, 1, 2, 3, 4), (3, 1, 3, 3, 4), (4, 1, 1, 3, 4), (5, 5, 5, 1, 2), (5, 5, 5, 1, 2), (9, 9, 9, 2, 2), (10, 9, 10, 2, 2)]
    pairs = {(a[0], b[0]) for a in got for b in got if a[0] < b[0] and a[1] == b[1] and a[2] != b[2]}
    assert {tuple(r) for r in alike_pairs(docs).collect()} == pairs
    assert alike_classes(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [200_000, 100])
def test_hot_class_of_copies(spark, monkeypatch, rows):
    monkeypatch.setattr(lookalike, "ROWS_PER_PART", rows)  # 100: the hot form is split
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same text', concat('t', id)) as text").unionByName(spark.createDataFrame([(9000, "ѕame text")], "doc_id long, text string"))
    assert alike_pairs(docs).count() == 1000
    assert alike_classes(docs).where("class = 0 and n_rows = 1001 and n_forms = 2").count() == 1001
