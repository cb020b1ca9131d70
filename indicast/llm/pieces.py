"""Cutting texts into pieces and words the way the word-end vocabularies do,
and a bounded memory for what has been worked out about them.

No pre-token of these vocabularies spans white space and their normaliser
treats each white-space-free piece alone, so what is known of a piece holds
wherever it occurs."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

# The white space of the vocabularies' pattern \s.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_GAPS = re.compile(f"[{SPACE}]+")
_ODD = re.compile("[\x1c-\x1f]")
# What the vocabularies' pattern finds in lower-cased printable ASCII and Latin-1 letters.
_SIMPLE = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")


def pieces(text: str) -> list[str]:
    """The text's runs without white space (``str.split`` also cuts at the four
    separators U+001C to U+001F, which the pattern does not count as space)."""
    if _ODD.search(text):
        return [p for p in _GAPS.split(text) if p]
    return text.split()


def simple_words(piece: str) -> list[str] | None:
    """The words of a piece of printable ASCII and Latin-1 letters (which are in
    normal form already); None for others."""
    return _WORDS.findall(piece.lower()) if _SIMPLE.fullmatch(piece) else None


class Recent:
    """A memory of ``make``'s results in two generations of at most ``limit``
    entries; what is in use moves to the younger one, the rest is forgotten."""

    def __init__(self, make: Callable[[list[str]], Iterable], limit: int):
        self.make, self.limit = make, limit
        self.young: dict = {}
        self.old: dict = {}

    def over(self, keys: Iterable[str]) -> dict:
        """A dictionary that holds all of the keys (fewer than ``limit``)."""
        new = set(keys).difference(self.young)
        if len(self.young) + len(new) > self.limit:
            self.old, self.young = self.young, {}
            new = set(keys)
        missing = []
        for key in new:
            known = self.old.get(key)
            if known is None:
                missing.append(key)
            else:
                self.young[key] = known
        if missing:
            self.young.update(zip(missing, self.make(missing)))
        return self.young
