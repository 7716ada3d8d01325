"""Cutting texts into pre-tokens, with what each cut yields remembered in bounded memory."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import regex

#: The pattern for which cutting at single spaces first is proved in :func:`chunks`.
SPACED_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A single space between other characters.
SINGLE_SPACE = re.compile(r" (?=\S)(?<=\S )")
_SEGMENT = 1 << 18
_LONGEST_KEY = 100
_MARKS = ".,"


class Memo(dict):
    """``memo[key]`` is ``make(key)``, remembered. Two generations of at most ``limit`` keys; long keys are not kept,
    nor those that end in one of ``passing``."""

    def __init__(self, make: Callable, limit: int = 250_000, passing: str = ""):
        super().__init__()
        self._make, self._limit, self._older, self._passing = make, limit, {}, frozenset(passing)

    def __missing__(self, key):
        found = self._older.get(key)
        if found is None:
            found = self._make(key)
        if len(key) <= _LONGEST_KEY and key[-1:] not in self._passing:
            if len(self) >= self._limit:
                self._older = dict(self)
                self.clear()
            self[key] = found
        return found


def segments(text: str) -> Iterator[tuple[bool, str]]:
    """The text in parts of about a quarter million characters, cut at single spaces; true if a space was taken off its head."""
    start, headless = 0, False
    while len(text) - start > 2 * _SEGMENT:
        cut = SINGLE_SPACE.search(text, start + _SEGMENT)
        if cut is None:
            break
        yield headless, text[start : cut.start()]
        start, headless = cut.end(), True
    yield headless, text[start:]


def chunks(text: str) -> Iterator[tuple[str | None, list[str]]]:
    """Parts of ``text`` whose pre-tokens do not depend on each other: a first one as it is, then parts that lack one leading space.

    Between two characters that are not white space, a single space always begins a pre-token of :data:`SPACED_PATTERN`:
    no alternative has a space after another character, except those of white space alone, and their look-ahead sees at most
    the character after the run. So the pre-tokens on either side are those of either side alone.
    """
    for headless, segment in segments(text):
        parts = SINGLE_SPACE.split(segment)
        if headless:
            yield None, parts
        else:
            yield parts[0], parts[1:]


class Pretokenizer:
    """Sums ``value(pre-token)`` over texts, through :class:`Memo` on the chunks and on the pre-tokens."""

    def __init__(self, pattern: str, value: Callable, add: Callable):
        self._find, self._add, self._value = regex.compile(pattern).findall, add, value
        self._letters = regex.compile(r"\p{L}+").fullmatch
        self._values = Memo(value)
        self._spaced = Memo(self._of_part, passing=_MARKS)
        self._cuttable = pattern == SPACED_PATTERN

    def _whole(self, text: str):
        return self._add(map(self._values.__getitem__, self._find(text)))

    def _of_part(self, part: str):
        """A space and ``part``. Letters alone are one pre-token; a mark after letters is another."""
        if self._letters(part):
            return self._value(" " + part)
        if part[-1:] in _MARKS and self._letters(part, 0, len(part) - 1):
            return self._add((self._spaced[part[:-1]], self._values[part[-1:]]))
        return self._whole(" " + part)

    def of(self, text: str):
        if not self._cuttable:
            return self._whole(text)
        found = []
        for head, parts in chunks(text):
            if head is not None:
                found.append(self._whole(head))
            found.append(self._add(map(self._spaced.__getitem__, parts)))
        return self._add(found)
