"""Texts as independent units for byte-pair vocabularies, with a bounded memory of units seen before.

The pre-tokenizer of the vocabulary never joins characters over a single space between two other characters,
so a text may be cut there and each unit (with its leading space) handled alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

# A worker remembers at most so many units; then it starts anew.
REMEMBERED = 800_000

# Texts are taken together until they hold so many characters.
CHARACTERS = 500_000

_CUT = re.compile(r"(?<=\S) (?=\S)")


def _edged(piece: str) -> bool:
    """Whether white space at an edge, or nothing at all, could belong to a longer run of white space."""
    return not piece or piece[0].isspace() or piece[-1].isspace()


def units_of(text: str) -> list[str]:
    first, *rest = _CUT.split(text)
    return [first, *[" " + piece for piece in rest]]


class Units:
    """``of(texts)`` gives for each text the values of its units; ``compute`` makes the values of new units.

    Units are known without their leading space; those that begin a text, with one that they do not have.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable[Any]]) -> None:
        self.compute = compute
        self.known: dict[str, Any] = {}

    def _batch(self, texts: list[str]) -> Iterator[list[Any]]:
        get = self.known.get
        rows = []
        missing: set[str] = set()
        for text in texts:
            for cut in (str.split, _CUT.split):
                pieces = text.split(" ") if cut is str.split else cut(text)
                pieces[0] = " " + pieces[0]
                values = list(map(get, pieces))
                gaps = [i for i, v in enumerate(values) if v is None] if None in values else []
                if not any(_edged(pieces[i] if i else pieces[i][1:]) for i in gaps):
                    break
            missing.update(pieces[i] for i in gaps)
            rows.append((values, [(i, pieces[i]) for i in gaps]))
        new = list(missing)
        fresh = dict(zip(new, self.compute([u[1:] if u[:1] == " " else " " + u for u in new]), strict=True))
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known = {}
        self.known.update((u, v) for u, v in fresh.items() if not _edged(u[1:] if u[:1] == " " else u))
        for values, gaps in rows:
            for i, unit in gaps:
                values[i] = fresh[unit]
            yield values

    def of(self, texts: Iterable[str | None]) -> Iterator[list[Any]]:
        """A null text has the values of an empty one."""
        batch, size = [], 0
        for text in texts:
            batch.append(text or "")
            size += len(batch[-1])
            if size >= CHARACTERS:
                yield from self._batch(batch)
                batch, size = [], 0
        if batch:
            yield from self._batch(batch)
