"""Split texts into the pieces that byte-level vocabularies merge within."""

from __future__ import annotations

import re

import public_tokenizers
import regex

# Letters, digits and white space of the Latin blocks and of general punctuation.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGIT = "0-9²³¹¼-¾"
_SPACE = "\t-\r \u0085    "
_ALL_SPACE = r"\t-\r \u0085   -     　"

_latin = re.compile("[\u0000-ɏ‐-⁞]*")
_fast = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_full = regex.compile(
    public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^{_ALL_SPACE}\p{{L}}\p{{N}}]")
    .replace(r"\s+(?!\S)", rf"[{_ALL_SPACE}]+(?![^{_ALL_SPACE}])").replace(r"\s+", rf"[{_ALL_SPACE}]+")
)


def is_latin(text: str) -> bool:
    return _latin.fullmatch(text) is not None


def pieces(text: str) -> list[str]:
    """Every match of the public pattern, in order; they make up the whole text.

    Texts within the Latin blocks take the standard library's matcher, which is twice as fast.
    """
    return _fast.findall(text) if is_latin(text) else _full.findall(text)
