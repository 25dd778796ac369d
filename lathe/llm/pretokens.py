"""Cutting texts for byte-level BPE vocabularies, with results kept per distinct piece.

The vocabularies' pattern never lets a token go on from a character that isn't a
space into a space. So a text may be cut before every space, but for spaces
with white space on both sides (a run of white space is one token less its
last character); texts with such a space are cut by the pattern itself.
"""

from __future__ import annotations

import re

import regex

_SPACED = re.compile(r" \s")
_ODD = re.compile(r"\s \s")


def pieces(text: str) -> list[str] | None:
    """Parts of ``text.split(" ")``, which all but the first stand for themselves with a space before; None if that cut isn't valid."""
    if _SPACED.search(text) and _ODD.search(text):
        return None
    return text.split(" ")


class Pieces:
    """Values of pieces, computed for many new ones at a time; kept up to ``most`` characters of pieces, no long piece at all."""

    def __init__(self, compute, pattern: str, special: str | None = None, most: int = 9_000_000, long: int = 200) -> None:
        self.compute, self.pattern, self.special, self.most, self.long = compute, regex.compile(pattern), special, most, long
        self.held = 0  # characters of the pieces kept, and 8 for each
        self.known: dict[str, object] = {}  # by piece, of the piece with a space before it
        self.bare: dict[str, object] = {}  # by string as it is

    def of(self, texts: list[str]) -> list[list]:
        """For each text the values of its parts, in order."""
        if self.held > self.most:
            self.known.clear()
            self.bare.clear()
            self.held = 0
        cut = []
        new, new_bare = set(), set()
        for text in texts:
            parts = pieces(text)
            if parts is None:
                parts = self._whole(text)
                new_bare.update(parts)
                cut.append((False, parts))
            else:
                new.update(parts[1:])
                new_bare.add(parts[0])
                cut.append((True, parts))
        self._learn(self.known, new, " ")
        self._learn(self.bare, new_bare, "")
        out = [[self.bare[p[0]], *map(self.known.__getitem__, p[1:])] if spaced else list(map(self.bare.__getitem__, p)) for spaced, p in cut]
        for kept, met in ((self.known, new), (self.bare, new_bare)):
            for x in met:
                if len(x) > self.long and kept.pop(x, None) is not None:
                    self.held -= len(x) + 8
        return out

    def _learn(self, kept: dict, met: set[str], before: str) -> None:
        todo = [x for x in met if x not in kept]
        kept.update(zip(todo, self.compute([before + x for x in todo]), strict=True))
        self.held += sum(map(len, todo)) + 8 * len(todo)

    def _whole(self, text: str) -> list[str]:
        out = []
        for k, part in enumerate(text.split(self.special) if self.special else [text]):
            out += ([self.special] if k else []) + self.pattern.findall(part)
        return out or [""]
