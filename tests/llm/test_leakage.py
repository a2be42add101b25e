import random

import numpy as np
import pytest

from punctual.llm import leakage
from punctual.llm.leakage import LeakRule, SeedIndex, aligned, find_leaks, leaks_of, rolling_hashes, runs, tiles
from punctual.llm.lookalike import Rewriter
from punctual.llm.spoken import spoken_words

R = Rewriter()
RULE = LeakRule()


def cues(words, per=6, start=1):
    parts = [" ".join(words[k : k + per]) for k in range(0, len(words), per)]
    return "\n\n".join(f"{n}\n00:00:{n % 60:02},000 --> 00:00:{n % 60:02},900\n{p}" for n, p in enumerate(parts, start))


def test_spoken_words():
    text = (
        "WEBVTT - a title\n\n0\n00:00:01.000 --> 00:00:02.000 line:85%\n<i>Don't STOP,</i>\n\n7\n00:00:02,500 --> 00:00:03,000\n[door (creaks)]\n\n00:00:03,500 --> 00:00:04,000\n"
        "- * sighs *\n\n3\n00:00:05,000 --> 00:00:06,000\n[wind] Nоw​!\r\n\r\n4\r\n00:00:07,000 --> 00:00:08,000\r\n♪ Ｇｏ — 42 times ♪\n\n5\n00:00:09,000 --> 00:00:09,500\n{\\an8}Straße STRASSE"
    )
    assert spoken_words(text, R) == ["dont", "stop", "wind", "now", "go", "42", "times", "strasse", "strasse"]
    assert spoken_words(None, R) == spoken_words("", R) == spoken_words(" \n♪", R) == []
    assert spoken_words("plain words here", R) == ["plain", "words", "here"]


@pytest.mark.parametrize("text", [
    "в москве нет никого кто бы не знал этого", "θέλω να μάθω νέα βιβλία και τη ζωή μου ήταν όνομα", "the line is live βut never",
    "ով հայոց սիրտ", "ΐ ᾳ ῥ ђ ї ё й",
])
def test_letter_case_does_not_count(text):
    assert spoken_words(text.upper(), R) == spoken_words(text, R) == spoken_words(text.title(), R)


def test_case_and_look_alikes_together():
    assert spoken_words("MOCKBA BETEP", R) == spoken_words("москва ветер", R)  # Latin capitals for Cyrillic ones
    assert spoken_words("NEA BΡOΝTH", R) == spoken_words("νεα βροντη", R)
    assert spoken_words("BRAΝCH saνe SΑVE", R) == ["branch", "save", "save"]
    assert len(set(spoken_words("live line have ham han", R))) == 5  # letters of one script stay apart
    assert spoken_words("μέvω", R) == spoken_words("ΜΈΝΩ", R) != spoken_words("μενω", R)  # missing accents count
    assert spoken_words("ὁ ή", R) != spoken_words("ο η", R)


def test_leaks_in_capitals(spark):
    russian = [f"вам{c}нет{k}" for c in "бгджз" for k in "ивмт"]
    greek = [f"μην{c}βρη{k}" for c in "γδθλξ" for k in "νητυ"]
    d = spark.createDataFrame([(1, cues([w.upper() for w in russian])), (2, cues([w.upper() for w in greek]))], "doc_id long, text string")
    e = spark.createDataFrame([(5, " ".join(russian)), (6, " ".join(greek))], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in find_leaks(d, e).collect()} == {(1, 5), (2, 6)}


def edits(window, doc):
    """Fewest words replaced, put in or left out between the window and some part of the document."""
    row = [0] * (len(doc) + 1)
    for w in window:
        new = [row[0] + 1]
        for k, x in enumerate(doc):
            new.append(min(row[k] + (w != x), row[k + 1] + 1, new[k] + 1))
        row = new
    return min(row)


def slow(item, doc, rule=RULE):
    return any(
        rule.one_in * edits(item[a:z], doc) <= z - a for a in range(len(item)) for z in range(a + rule.min_words, min(len(item), a + 2 * rule.min_words) + 1)
    )


def test_like_brute_force():
    rnd = random.Random(8)
    seen = [0, 0]
    for _ in range(120):
        item = [f"w{rnd.randint(0, 40)}" for _ in range(rnd.randint(18, 40))]
        n = rnd.randint(8, len(item))
        s = rnd.randint(0, len(item) - n)
        part = [w if rnd.random() > rnd.choice([0, 0.06, 0.12, 0.25]) else "zz" for w in item[s : s + n]]
        doc = [f"w{rnd.randint(0, 40)}" for _ in range(20)] + part + [f"w{rnd.randint(0, 40)}" for _ in range(20)]
        index = SeedIndex([(1, item)])
        ids = np.array([index.vocabulary.get(w, 0) for w in doc], np.int64)
        got = bool(list(leaks_of(ids, index, RULE)))
        want = slow(item, doc)
        seen[want] += 1
        assert got == want
    assert min(seen) > 15


def leaks(item, doc):
    index = SeedIndex([(1, item)])
    return bool(list(leaks_of(np.array([index.vocabulary.get(w, 0) for w in doc], np.int64), index, RULE)))


def test_longer_quote_does_not_hide_a_passage():
    item = [f"w{k}" for k in range(30)]
    passage = ["zz" if k in (4, 9) else w for k, w in enumerate(item[:18])]
    for doc in (passage + ["yy"] * 20 + item[8:20], item[8:20] + ["yy"] + passage):
        assert slow(item, doc) and leaks(item, doc)


def test_like_brute_force_with_repeated_fragments():
    rnd = random.Random(13)
    seen = [0, 0]
    for _ in range(120):
        item = [f"w{rnd.randint(0, 60)}" for _ in range(rnd.randint(18, 40))]
        cut = lambda n: item[(s := rnd.randint(0, len(item) - n)) : s + n]
        part = cut(rnd.randint(18, min(22, len(item))))
        for k in rnd.sample(range(len(part)), rnd.randint(1, 3)):
            part[k] = "zz"
        pieces = [part] + [cut(rnd.randint(5, 14)) for _ in range(rnd.randint(1, 4))]
        rnd.shuffle(pieces)
        doc = [w for p in pieces for w in [*p, *["yy"] * 20]]
        want = slow(item, doc)
        seen[want] += 1
        assert leaks(item, doc) == want
    assert min(seen) > 15


def test_least_tiled_is_a_lower_bound():
    assert RULE.least_tiled() == 8


def matches(item, doc):
    h = rolling_hashes(np.asarray(doc))
    order = np.argsort(h, kind="stable")
    return runs(rolling_hashes(np.asarray(item)), h[order], order)


def test_tiling_is_greedy_and_does_not_overlap():
    item, doc = np.arange(1, 21), np.r_[np.arange(11, 21), [0], np.arange(1, 11)]
    assert tiles(matches(item, doc), 20, len(doc)) == [(0, 11, 10), (10, 0, 10)]  # reordered halves
    twice = np.r_[np.arange(1, 13), np.arange(5, 10)]
    assert tiles(matches(item, twice), 20, len(twice)) == [(0, 0, 12)]  # the shorter copy would overlap in the item
    cut = np.r_[np.arange(1, 13), [0], np.arange(6, 19)]
    assert tiles(matches(item, cut), 20, len(cut)) == [(0, 0, 5), (5, 13, 13)]  # what a longer tile leaves of a match
    assert len(rolling_hashes(np.arange(4))) == 0


@pytest.mark.parametrize("pairs", [2_000_000, 7])
def test_matches_are_maximal(monkeypatch, pairs):
    monkeypatch.setattr(leakage, "PAIRS", pairs)
    rnd = np.random.default_rng(5)
    for _ in range(30):
        item, doc = rnd.integers(1, 4, 25), rnd.integers(1, 4, 60)
        want = set()
        for i in range(25):
            for d in range(60):
                if i and d and item[i - 1] == doc[d - 1]:
                    continue
                n = 0
                while i + n < 25 and d + n < 60 and item[i + n] == doc[d + n]:
                    n += 1
                if n >= 5:
                    want.add((i, d, n))
        got = list(zip(*(x.tolist() for x in matches(item, doc))))
        assert set(got) == want and len(got) == len(want)


def test_inserted_and_left_out_words_count_wherever_they_stand():
    item = [f"w{k}" for k in range(18)]
    for at in range(1, 18):
        more, less = item[:at] + ["zz"] + item[at:], item[:at] + item[at + 1 :]
        for doc in (more, less, ["yy"] * 9 + more + ["yy"] * 9):
            assert slow(item, doc) and leaks(item, doc), (at, doc)
    assert not leaks(item, item[:9] + ["zz"] * 4 + item[9:])
    assert not aligned(np.arange(17), np.arange(17), RULE) and not aligned(np.arange(30), np.empty(0, np.int64), RULE)


def test_a_refrain_is_no_trouble():
    import time

    began = time.monotonic()
    item = ["la"] * 100
    assert leaks(item, ["la"] * 20_000)
    assert not leaks(["la"] * 10 + [f"w{k}" for k in range(90)], (["la"] * 10 + ["zz"] * 30) * 2_000)
    assert time.monotonic() - began < 20


@pytest.mark.parametrize("block", [50_000, 2])
def test_tables(spark, block):
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randint(0, 500)}"
    items = [(k, [word() for _ in range(30)]) for k in range(5)]
    noise = [word() for _ in range(200)]
    docs = [
        (1, cues(noise)), (2, cues(noise[:50] + items[0][1] + noise[50:])), (3, cues(noise[:40] + items[1][1][5:25] + items[2][1])), (4, None), (5, ""),
        (6, cues([w.upper() + "!" for w in items[3][1]]).replace("W", "Ｗ")), (7, cues(items[4][1][:15])), (8, cues(noise * 200 + items[4][1])), (2, cues(noise[:50] + items[0][1])),
    ]
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
    e = spark.createDataFrame([(k, " ".join(w)) for k, w in items] + [(90, None), (91, ""), (92, "too short"), (0, " ".join(items[0][1]))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.tiled_words for r in find_leaks(d, e, max_items=block).collect()}
    assert got == {(r.doc_id, r.item_id): r.tiled_words for r in find_leaks(d, e, max_chars=200).collect()}
    assert set(got) == {(2, 0), (3, 1), (3, 2), (6, 3), (8, 4)} and got[2, 0] == 30 and got[3, 1] == 20


def test_empty_tables(spark):
    d, e = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert find_leaks(d, e).count() == 0 and find_leaks(d, one).count() == 0 and find_leaks(one.withColumnRenamed("item_id", "doc_id"), e).count() == 0
