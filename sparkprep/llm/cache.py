"""What Python workers keep from task to task: built models, and results of frequent words."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, TypeVar

from pyspark import Broadcast

T = TypeVar("T")
_BUILT: dict[str, Any] = {}


def built(key: str, source: Broadcast, build: Callable[[Any], T]) -> T:
    """``build(source.value)``, made once per worker and ``key``; a few results are kept."""
    if key not in _BUILT:
        if len(_BUILT) >= 4:
            _BUILT.clear()
        _BUILT[key] = build(source.value)
    return _BUILT[key]


LONGEST = 48


class Memo(dict):
    """A function's results by argument, of the last ``limit`` to twice as many different arguments.

    When full, the results become the older half, from which those asked for again return. Texts of
    more than ``LONGEST`` characters are passed by: where blanks are rare, a whole paragraph is one
    word, and seldom comes again. So the limit bounds the bytes that are held.
    """

    def __init__(self, function: Callable, limit: int = 200_000):
        super().__init__()
        self.function, self.limit, self.older = function, limit, {}

    def __missing__(self, key):
        if isinstance(key, str) and len(key) > LONGEST:
            return self.function(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        value = self.older[key] if key in self.older else self.function(key)
        self[key] = value
        return value
