"""The spoken words of subtitle text, for comparisons that ignore layout, markup and look-alike spelling."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from punctual.llm.lookalike import SAME_SHAPE, Rewriter

# A cue's time line with the number line before it, if any.
_TIMES = re.compile(r"(?:^[ \t]*\d+[ \t]*\n)?^[ \t]*(?:\d+:)?\d+:\d+[.,:]\d+[ \t]*-->[^\n]*$", re.M)
_HEADER = re.compile(r"\A\s*webvtt[^\n]*")
_TAGS = re.compile(r"<[^<>\n]*>|\{[^{}\n]*\}")
_SOUND_ONLY = re.compile(r"(?<=\x00)[\s♪#\-]*(?:(?:\[[^\[\]\x00]*\]|\([^()\x00]*\)|\*[^*\x00]+\*)[\s♪#.\-]*)+(?=\x00|\Z)")
_MARKS = re.compile(r"[^\w\s]+|_+")
_LATIN_LIKE = {x for group in SAME_SHAPE if group[0].isascii() for x in group} | {"μ"}
# Greek letters that no Latin letter looks like.
_GREEK = re.compile("[" + "".join(
    c for o in [*range(0x370, 0x400), *range(0x1F00, 0x2000)]
    if (c := chr(o)).isalpha() and unicodedata.normalize("NFD", c)[0] not in _LATIN_LIKE
) + "]")
_LATIN = re.compile("[A-Za-z]")
_LETTERS = re.compile("(?:[^\\W\\d_]|[\u0300-\u036f\u00ad\u200b-\u200f\u2060\ufeff])+")


@lru_cache(maxsize=1)
def word_rewriter() -> Rewriter:
    """The rewriter of case-folded words: classes closed under case folding."""
    return Rewriter(fold_case=True)


def _nu(word: re.Match) -> str:
    """In a Greek word v is a small nu, in one with Latin letters a small nu is v."""
    w = word[0]
    if _GREEK.search(w):
        return w.replace("v", "ν")
    return w.replace("ν", "v") if _LATIN.search(w) else w


def spoken_words(text: str | None, rewrite: Rewriter) -> list[str]:
    """Case-folded words without punctuation, tags, cue numbers, times and cues holding only a sound description.

    Null and empty texts have no words. Words are split at white space; a word of punctuation alone is none. Case is
    folded before look-alikes, whose classes are then those of ``word_rewriter``: a capital and its small letter are
    one wherever either looks like a letter of another script (so small һ and н, both like h, count as one).
    """
    if not text:
        return []
    if not rewrite.fold_case:
        rewrite = word_rewriter()
    if not text.isascii():
        if "ν" in text or _GREEK.search(text):
            text = _LETTERS.sub(_nu, text)
        text = unicodedata.normalize("NFC", text)
    text = rewrite(text.casefold())
    if "-->" in text:
        text = _TIMES.sub("\x00", _HEADER.sub("", text))
    if "<" in text or "{" in text:
        text = _TAGS.sub("", text)
    if "[" in text or "(" in text or "*" in text:
        text = _SOUND_ONLY.sub("", text)
    return _MARKS.sub("", text.replace("\x00", "\n")).split()
