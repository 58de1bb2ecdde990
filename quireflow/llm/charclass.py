"""Matching token patterns where Unicode tables disagree.

The ``regex`` module knows more letters and numbers than the tokenizers'
engines.  They agree on all characters that Python's own tables assign; for
others the tokenizers' engine is asked, and the pattern runs on a shadow of the
text in which a well-known character of the same class stands in.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import regex
from tokenizers import Regex, normalizers, pre_tokenizers

#: Stand-ins: a letter and a number that occur in no pattern, and a character that is neither nor white space.
_LETTER, _NUMBER, _OTHER = "\u03b1", "\u00bd", "\ue000"


def unassigned(text: str) -> bool:
    return not text.isascii() and any(unicodedata.category(c) == "Cn" for c in text)


@cache
def _stand_in(c: str) -> str:
    for name, other in (("L", _LETTER), ("N", _NUMBER)):
        if pre_tokenizers.Split(Regex(rf"\p{{{name}}}"), "removed", invert=True).pre_tokenize_str(c):
            return other
    return _OTHER


def find_all(pattern: regex.Pattern, text: str) -> list[tuple[int, str]]:
    """Start and text of all matches."""
    if not unassigned(text):
        return [(m.start(), m.group()) for m in pattern.finditer(text)]
    shadow = "".join(_stand_in(c) if unicodedata.category(c) == "Cn" else c for c in text)
    return [(m.start(), text[m.start() : m.end()]) for m in pattern.finditer(shadow)]


@cache
def _library() -> normalizers.Normalizer:
    return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])


def fold(text: str) -> str:
    """NFC and lower case, each character on its own."""
    if text.isascii():
        return text.lower()
    if unassigned(text):
        return _library().normalize_str(text)
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
