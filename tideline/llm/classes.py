"""Make word patterns agree with another library's edition of Unicode.

Libraries differ in how new their character tables are.  The driver asks the
library once which characters it takes for letters and numbers, and how it
lower-cases; texts that hold a character on which the two disagree go through
a pattern and a mapping corrected for them.  All others, in practice nearly
all, take the plain pattern.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import regex

CLASSES = (r"\p{L}", r"\p{N}")


def all_characters() -> str:
    """Every code point but surrogates, controls and the blank, with a line feed after each."""
    return "\n".join(chr(i) for i in range(0x21, 0x110000) if not 0xD800 <= i < 0xE000)


def _set(characters: Iterable[str]) -> str:
    """A regular-expression set of the characters, as ranges."""
    ranges: list[list[int]] = []
    for c in sorted(map(ord, characters)):
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


@dataclass
class Words:
    """A word pattern in plain and corrected form."""

    pattern: str
    #: For each class, what our tables count in and the library does not, and the reverse.
    gaps: dict[str, tuple[set[str], set[str]]] = field(default_factory=dict)
    lower: dict[int, str] = field(default_factory=dict)

    @classmethod
    def fitted(cls, pattern: str, members: Callable[[str, str], Iterable[str]], lower: Callable[[str], str] | None = None):
        """``members(pattern, text)`` gives the pieces of a text that the library's pattern matches."""
        text = all_characters()
        gaps = {}
        for c in CLASSES:
            theirs = {x for piece in members(c, text) for x in piece}
            ours = set(regex.findall(c, text))
            gaps[c] = (ours - theirs, theirs - ours)
        changed = {}
        if lower:
            same = zip(text.split("\n"), lower(text).split("\n"))
            changed = {ord(a): b for a, b in same if a.lower() != b}
        return cls(pattern, gaps, changed)

    def compiled(self) -> "Matcher":
        return Matcher(self)


class Matcher:
    def __init__(self, words: Words):
        self.plain = regex.compile(words.pattern)
        self.lower = words.lower
        exact = words.pattern
        for name, (extra, missing) in words.gaps.items():
            inner = f"[{name}--[{_set(extra)}]]" if extra else name
            exact = exact.replace(name, f"[{inner}{_set(missing)}]")
        self.exact = regex.compile(exact, regex.V1)
        self.odd = {x for pair in words.gaps.values() for part in pair for x in part} | {chr(i) for i in words.lower}

    def findall(self, text: str, lower: bool = False) -> list[str]:
        """Words of a text, lower-cased first if asked for."""
        if text.isascii():
            return self.plain.findall(text.lower() if lower else text)
        odd = not self.odd.isdisjoint(text)
        if lower:
            # One character at a time, without the rule for a final sigma.
            text = text.replace("Σ", "σ")
            if odd and self.lower:
                text = "".join([self.lower.get(ord(c), None) or c.lower() for c in text])
            else:
                text = text.lower()
        return (self.exact if odd else self.plain).findall(text)
