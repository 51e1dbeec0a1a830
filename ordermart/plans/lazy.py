"""A read-only mapping whose values are built on first access.

Layer dictionaries are wired this way so that a query touching two tables
does not construct (and analyse) the plans of the other twenty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any


class LazyMap(Mapping):
    def __init__(self, builders: dict[str, Callable[[], Any]]):
        self._builders = dict(builders)
        self._values: dict[str, Any] = {}

    def __getitem__(self, key: str) -> Any:
        if key not in self._values:
            self._values[key] = self._builders[key]()
        return self._values[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
