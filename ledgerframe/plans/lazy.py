"""A read-only mapping whose values are built on first access.

DataFrame construction is not free in Spark Classic (every transformation
is analysed on the driver), so composing all models when a caller needs one
of them costs real time; models are therefore built on demand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any


class LazyTables(Mapping):
    def __init__(self, builders: dict[str, Callable[[], Any]]):
        self._builders = dict(builders)
        self._built: dict[str, Any] = {}

    def __getitem__(self, name: str) -> Any:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
