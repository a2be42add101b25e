"""One written form for texts that look the same.

The letter table covers Latin, Greek, Cyrillic and Armenian, and the capitals of Cherokee, Coptic and Lisu; letters that
are alike only in some fonts (Greek small alpha and a) are left apart, as are signs of one script (l and 1).

Classes of look-alike code points and strings are built by union-find from rules (wide and narrow forms,
spaces, canonical composition) and the letter table below. The most frequent member of a class in the corpus
stands for it. Texts are rewritten greedily, longest match first, by a multi-pattern automaton; patterns of one
code point, its states of depth one, run as a translation table.

Defined results: null stays null, an empty text stays empty, a text of invisible characters becomes empty.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.operators.skew import SALT, Salts
from punctual.session import cut, spread

# Letters of different scripts with the same shape, the Latin letter first.
SAME_SHAPE = [
    "AАΑ", "BВΒ", "CСϹ", "EЕΕ", "FϜ", "GԌ", "HНΗ", "IІΙӀ", "JЈͿ", "KКΚ", "MМΜϺ", "NΝ", "OОΟՕ", "PРΡ", "QԚ",
    "SЅՏ", "TТΤ", "UՍ", "VѴ", "WԜ", "XХΧ", "YҮΥУ", "ZΖ",
    "aа", "cсϲ", "dԁ", "eе", "gց", "hһհ", "iі", "jјϳ", "nո", "oоοօ", "pрρ", "qԛ", "sѕ", "uս", "vνѵ", "wԝ", "xх", "yу",
    "ПΠ", "ГΓ", "ФΦ", "кκ", "μµ", "ЛΛ",
    # Cherokee
    "AᎪ", "BᏴ", "CᏟ", "EᎬ", "GᏀ", "HᎻ", "JᎫ", "KᏦ", "LᏞ", "MᎷ", "PᏢ", "RᎡ", "SᏚ", "TᎢ", "VᏙ", "WᎳ", "ZᏃ",
    # Coptic
    "BⲂ", "CⲤ", "HⲎ", "IⲒ", "KⲔ", "MⲘ", "NⲚ", "OⲞ", "PⲢ", "TⲦ", "XⲬ",
    # Lisu
    "Aꓮ", "Bꓐ", "Cꓚ", "Dꓓ", "Eꓰ", "Fꓝ", "Gꓖ", "Hꓧ", "Iꓲ", "Jꓙ", "Kꓗ", "Lꓡ", "Mꓟ", "Nꓠ", "Oꓳ", "Pꓑ", "Rꓣ", "Sꓢ", "Tꓔ", "Uꓴ", "Vꓦ", "Wꓪ", "Xꓫ", "Yꓬ",
    "Zꓜ",
]
# Invisible marks outside the format category.
EXTRA_INVISIBLE = [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0]
#: Rows of one written form that meet in one task.
ROWS_PER_PART = 200_000
KEPT_CONTROLS = "\t\n\v\f"
#: Small nu looks like v, but its capital like N: of case-folded letters it stands with n, or n and v would be one.
FOLDED_APART = {("v", "ν")}


def is_invisible(ch: str) -> bool:
    """True for format and control characters, variation selectors and fillers; line breaks and tabs stay."""
    o = ord(ch)
    if o in EXTRA_INVISIBLE or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF:
        return True
    kind = unicodedata.category(ch)
    return kind == "Cf" or (kind == "Cc" and ch not in KEPT_CONTROLS)


class UnionFind:
    """Disjoint sets over strings, with path halving."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        p = self.parent
        if x not in p:
            p[x] = x
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def union(self, a: str, b: str) -> None:
        ra, rb = self.find(a), self.find(b)
        if ra != rb:
            self.parent[max(ra, rb)] = min(ra, rb)


@lru_cache(maxsize=2)
def _rules(fold_case: bool = False) -> tuple[list[str], list[tuple[str, str]], list[tuple[str, str]]]:
    """Invisible code points, pairs of alike code points, and (code point, decomposed string) pairs.

    With ``fold_case`` letters are alike in small form if they are in either form.
    """
    invisible, pairs, strings = [], [], []
    for o in range(sys.maxunicode + 1):
        if 0xD800 <= o < 0xE000:
            continue
        ch = chr(o)
        if is_invisible(ch):
            invisible.append(ch)
            continue
        if unicodedata.category(ch) == "Zs":
            pairs.append((ch, " "))
            continue
        d = unicodedata.decomposition(ch)
        if not d:
            continue
        tag, _, rest = d.rpartition("> ") if d.startswith("<") else ("", "", d)
        if tag in ("<wide", "<narrow"):
            target = "".join(chr(int(x, 16)) for x in rest.split())
            (pairs if len(target) == 1 else strings).append((ch, target))
        elif not tag:
            full = unicodedata.normalize("NFD", ch)
            (pairs if len(full) == 1 else strings).append((ch, full))
    for group in SAME_SHAPE:
        alike = [(group[0], x) for x in group[1:]]
        if fold_case:
            alike = [p for a, b in alike if (p := (a.casefold(), b.casefold())) not in FOLDED_APART]
        pairs += alike
    return invisible, pairs, strings


class Rewriter:
    """Rewrites texts to the class representatives chosen by ``frequency`` (of code points and clusters).

    With ``fold_case`` the classes are closed under case folding, for texts that are case-folded already.
    """

    def __init__(self, frequency: Mapping[str, int] | None = None, fold_case: bool = False) -> None:
        freq = frequency or {}
        self.fold_case = fold_case
        invisible, pairs, strings = _rules(fold_case)
        uf = UnionFind()
        for a, b in pairs:
            uf.union(a, b)
        # A string is keyed by the classes of its characters, so strings alike character by character are one node.
        forms: dict[str, set[str]] = {}
        for ch, full in strings:
            key = "".join(uf.find(x) for x in full)
            forms.setdefault(key, set()).add(full)
            uf.union(ch, key) if len(key) > 1 else uf.union(ch, key)
        members: dict[str, list[str]] = {}
        for x in list(uf.parent):
            members.setdefault(uf.find(x), []).append(x)
        best = lambda xs: min(xs, key=lambda x: (len(x) > 1, -freq.get(x, 0), [ord(c) for c in x]))
        self.table: dict[int, str | None] = {ord(c): None for c in invisible}
        patterns: dict[str, str] = {}
        stands = {root: best(xs) for root, xs in members.items()}
        rep = lambda c: stands.get(uf.find(c), c) if c in uf.parent else c
        for root, xs in members.items():
            for x in xs:
                if len(x) == 1 and x != stands[root]:
                    self.table[ord(x)] = stands[root]
        for key, fulls in forms.items():
            out = stands[uf.find(key)]
            for full in fulls:
                for j in range(1, len(full)):
                    head = unicodedata.normalize("NFC", full[:j])
                    if len(head) == 1:
                        patterns["".join(rep(c) for c in head + full[j:])] = out
        self.patterns = {k: v for k, v in patterns.items() if k != v}
        self._prepare()

    def _prepare(self) -> None:
        auto = ahocorasick.Automaton()
        for k, v in self.patterns.items():
            auto.add_word(k, (len(k), v))
        auto.make_automaton()
        self.auto = auto
        tails = sorted({c for k in self.patterns for c in k[1:]} | {chr(c) for c in range(0x300, 0x370)})
        self.tail = re.compile("[" + "".join(map(re.escape, tails)) + "ᄀ-ᇿ]")
        ascii_touched = "".join(chr(o) for o in self.table if o < 128)
        self.plain = re.compile("[" + re.escape(ascii_touched) + "]") if ascii_touched else None

    def __getstate__(self) -> dict:
        return {"table": self.table, "patterns": self.patterns, "fold_case": self.fold_case}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._prepare()

    def __call__(self, text: str) -> str:
        if text.isascii() and not (self.plain and self.plain.search(text)):
            return text
        text = text.translate(self.table)
        if self.tail.search(text):
            text = unicodedata.normalize("NFC", text)  # puts marks in canonical order
            out, at = [], 0
            for end, (n, to) in self.auto.iter_long(text):
                out += (text[at : end + 1 - n], to)
                at = end + 1
            text = ("".join(out) + text[at:]).translate(self.table)
        return text


_CLUSTER = re.compile("[^̀-ͯ][̀-ͯ]+")


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    small, large, strings = np.zeros(0x3000, np.int64), Counter(), Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if not text:
                continue
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            low = points < 0x3000
            small += np.bincount(points[low] if not low.all() else points, minlength=0x3000)
            if not low.all():
                large.update(points[~low].tolist())
            if not text.isascii():
                strings.update(_CLUSTER.findall(text))
    found = [(chr(o), int(small[o])) for o in np.flatnonzero(small)]
    found += [(chr(o), n) for o, n in large.items() if not 0xD800 <= o < 0xE000] + list(strings.items())
    yield pa.RecordBatch.from_arrays(
        [pa.array([c for c, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], ["unit", "n"]
    )


def unit_frequencies(texts: DataFrame, column: str = "text") -> DataFrame:
    """(unit, n) of every code point and combining cluster: counted per task, then one small shuffle."""
    return spread(texts.select(column)).mapInArrow(_count_batches, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def fit_rewriter(texts: DataFrame, column: str = "text") -> Rewriter:
    """The rewriter of a corpus. Only units in some class are brought to the driver: at most as many as Unicode
    has code points with a rule (about 4,000), whatever the corpus size."""
    base = Rewriter()
    touched = sorted({chr(o) for o in base.table} | {v for v in base.table.values() if v} | set(base.patterns) | set(base.patterns.values()))
    spark = texts.sparkSession
    ruled = spark.createDataFrame([(x,) for x in touched], "unit string")
    return Rewriter({r.unit: r.n for r in unit_frequencies(texts, column).join(ruled, "unit", "left_semi").collect()})


def _batched(batches: Iterable[pa.RecordBatch], fn) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield fn(batch)


def normalize_texts(texts: DataFrame, rewriter: Rewriter, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, canonical text) of every row, in one pass without a shuffle."""
    shared = texts.sparkSession.sparkContext.broadcast(rewriter)

    def run(batches):
        rewrite = shared.value

        def one(batch):
            out = [None if t is None else rewrite(t) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["key", "canonical"])

        return _batched(batches, one)

    kind = texts.schema[key].dataType.simpleString()
    return spread(texts.select(key, column)).mapInArrow(run, f"key {kind}, canonical string").select(F.col("key").alias(key), "canonical")


def look_keys(texts: DataFrame, rewriter: Rewriter, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, look, form): 128-bit hashes of the canonical text and of the text itself, for texts with a visible
    character. Only these leave the tasks, never the texts."""
    shared = texts.sparkSession.sparkContext.broadcast(rewriter)

    def run(batches):
        rewrite = shared.value
        digest = lambda s: hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest()

        def one(batch):
            ids, looks, forms = [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t and (c := rewrite(t)).strip():
                    forms.append(d := digest(t))
                    looks.append(d if c is t or c == t else digest(c))
                    ids.append(i)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.types[0]), pa.array(looks, pa.binary()), pa.array(forms, pa.binary())],
                ["key", "look", "form"],
            )

        return _batched(batches, one)

    kind = texts.schema[key].dataType.simpleString()
    return spread(texts.select(key, column)).mapInArrow(run, f"key {kind}, look binary, form binary").select(F.col("key").alias(key), "look", "form")


def _varied(texts: DataFrame, rewriter: Rewriter, key: str, column: str) -> DataFrame:
    """(id, look, form) of texts that share their look with another written form, computed once.

    Looks with one written form are dropped by a partial aggregation, so a look on a third of all rows costs one row per
    task.
    """
    keys = cut(look_keys(texts, rewriter, key, column).select(F.col(key).alias("id"), "look", "form"))
    varied = keys.groupBy("look").agg(F.min("form").alias("lo"), F.max("form").alias("hi")).where("lo <> hi").select("look")
    return keys.join(varied, "look", "left_semi")


def alike_classes(texts: DataFrame, rewriter: Rewriter | None = None, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, class, form, n_forms, n_rows) of every text with a visible character.

    ``class`` is the least key of the texts that look the same, ``form`` that of the texts that are the same string; the
    class's forms and rows are counted. Two rows look the same if their classes are equal, and are different strings if
    their forms aren't; a class with one form has no pair. Repeated rows of one key come out as often as they are.
    """
    rewriter = rewriter or fit_rewriter(texts, column)
    keys = cut(look_keys(texts, rewriter, key, column).select(F.col(key).alias("id"), "look", "form"))
    forms = keys.groupBy("look", "form").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    looks = forms.groupBy("look").agg(F.min("least").alias("class"), F.count("*").alias("n_forms"), F.sum("n").alias("n_rows"))
    # One row a form: the rows of a hot form are split before they meet it.
    named = forms.join(looks, "look").select("form", F.col("least").alias("first"), "class", "n_forms", "n_rows", "n")
    salts = Salts(named.select("form", "n"), ["form"], ROWS_PER_PART, counted="n")
    rows, copies = salts.spread(keys, ["id"]), salts.copies(named)
    return rows.join(copies, ["form", SALT]).select(F.col("id").alias(key), "class", F.col("first").alias("form"), "n_forms", "n_rows")


def alike_pairs(texts: DataFrame, rewriter: Rewriter | None = None, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Pairs (key_1 < key_2) of texts that look the same but are different strings.

    Written forms are paired first, each once, and rows are joined to the paired forms, so every joined row is a row
    of the result: however many exact copies a class holds, they never meet one another. A form on very many rows is
    split on both sides. The pairs of large classes are many by their nature; ``alike_classes`` says the same in one row
    per text.
    """
    rewriter = rewriter or fit_rewriter(texts, column)
    rows = _varied(texts, rewriter, key, column)
    salts = Salts(rows, ["form"], ROWS_PER_PART)
    forms = rows.select("look", "form").distinct()
    paired = forms.withColumnRenamed("form", "f1").join(forms.withColumnRenamed("form", "f2"), "look").where("f1 < f2").select("f1", "f2")
    dealt = salts.spread(rows, ["id"]).select("form", SALT, "id")
    one = salts.copies(paired.withColumnRenamed("f1", "form")).join(dealt.withColumnRenamed("id", "a"), ["form", SALT]).select("f2", "a")
    found = salts.copies(one.withColumnRenamed("f2", "form")).join(dealt.withColumnRenamed("id", "b"), ["form", SALT]).where("a <> b")
    return found.select(F.least("a", "b").alias(f"{key}_1"), F.greatest("a", "b").alias(f"{key}_2")).distinct()
