"""A bounded memory of results by key, kept by a Python worker between batches and tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Generic, TypeVar

V = TypeVar("V")


class Memory(Generic[V]):
    """Two generations of at most ``most`` results each: what is not used again while one fills is forgotten."""

    def __init__(self, learn: Callable[[Sequence[str]], Iterable[V]], most: int) -> None:
        self.learn, self.most = learn, most
        self.known: dict[str, V] = {}
        self.older: dict[str, V] = {}

    def of(self, keys: set[str]) -> Callable[[str], V]:
        """A look-up that knows all of ``keys``; new ones are learnt together."""
        if len(self.known) > self.most:
            self.older, self.known = self.known, {}
        new = []
        for key in keys.difference(self.known):
            if key in self.older:
                self.known[key] = self.older[key]
            else:
                new.append(key)
        if new:
            self.known.update(zip(new, self.learn(new), strict=True))
        return self.known.__getitem__
