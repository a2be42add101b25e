import os
import random

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from punctual.llm.prefix_bpe import TOKENIZERS, WORD_PATTERN, EditableText, Encoder, PrefixTable, Vocabulary, encode_corpus, word_splitter

pytestmark = pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="no public tokenizers here")
TEXT = st.text(alphabet=st.one_of(st.sampled_from(list("abehlorst'  \n\t.,-<|>0123")), st.characters(exclude_categories=["Cs"])), max_size=60)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Vocabulary.load())


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(os.path.join(TOKENIZERS, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_same_ids_as_the_public_library(encoder, reference, text):
    assert encoder.encode(text) == reference(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a" * 5000, " " * 3000, "it's they'll I'D", "日本語テキスト", "​﻿", "x\r\n\r\ny", "é" * 300])
def test_odd_texts(encoder, reference, text):
    assert encoder.encode(text) == reference(text)


def test_null_and_empty(encoder):
    assert encoder.encode(None) == encoder.encode("") == []


@settings(max_examples=300, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 70), st.integers(0, 12), st.text(alphabet="ab's \n1é", max_size=6)), max_size=4))
def test_appends_and_edits_are_exact(encoder, text, edits):
    e = EditableText(encoder, text[: len(text) // 2]).append(text[len(text) // 2 :])
    assert e.text == text and e.ids() == encoder.encode(text)
    for start, n, new in edits:
        start = min(start, len(e.text))
        want = e.text[:start] + new + e.text[start + n :]
        e.replace(start, min(len(e.text), start + n), new)
        assert e.text == want and e.ids() == encoder.encode(want)


def test_edit_reuses_distant_words(encoder):
    e = EditableText(encoder, "one two three four five six seven " * 50)
    before = {id(t) for t in e.tables}
    e.replace(100, 103, "xyz")
    assert sum(id(t) in before for t in e.tables) >= len(e.tables) - 4


def test_prefix_table_has_the_encoding_of_every_prefix(encoder):
    v, word = encoder.vocabulary, "unbelievably".encode()
    t = PrefixTable(v, word)
    for k in range(1, len(word) + 1):
        assert PrefixTable(v, word[:k]).ids() == PrefixTable(v, word).cut_back(k).ids()
    assert t.ids() == PrefixTable(v, word[:5]).append(word[5:]).ids()
    assert b"".join(v.bytes_of[i] for i in t.ids()) == word


def test_bounded_table_of_words(encoder):
    small = Encoder(encoder.vocabulary, kept=3)
    texts = ["alpha beta gamma delta", "beta epsilon", None, "", "zeta eta theta"]
    for t in texts:
        assert small.encode(t) == encoder.encode(t)
    assert len(small.number) <= 3 + 4


def test_table(spark, encoder):
    rows = [(1, "Hello there"), (2, None), (3, ""), (4, "x " * 50_000), (5, "Hello there"), (5, "Hello there")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int")
    out = encode_corpus(docs)
    assert out.columns == ["doc_id", "ids"] and sorted((r.doc_id, r.ids) for r in out.collect()) == sorted((i, encoder.encode(t)) for i, t in rows)
    assert encode_corpus(docs.limit(0)).count() == 0


def test_both_matchers_split_alike():
    slow, fast = regex.compile(WORD_PATTERN).findall, word_splitter(WORD_PATTERN)
    every = "".join(chr(o) for o in range(0x10000) if not 0xD800 <= o < 0xE000)
    assert fast(every) == slow(every) and fast("") == []
    rnd = random.Random(4)
    alphabet = "aZé ßЖ中ﬁ²½٣Ⅷ_'s'll\t\n\r\x1c\x85\u00a0\u2028\u3000\u200b\u0301-.,!😀𝔸"
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30)))
        assert fast(text) == slow(text), text
    for word in (" x", "  x", "x  ", "x \n y", "don't I'll", "\u00a0x", "a\u00a0\u00a0b"):
        assert fast(word) == slow(word)
