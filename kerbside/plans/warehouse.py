"""Where a warehouse keeps its stores."""

from __future__ import annotations

from dataclasses import dataclass

from kerbside.sources import store


@dataclass(frozen=True)
class Warehouse:
    """Where the stores are, under one folder on a shared file system.

    ``retained`` is how many versions of each store readers can go on using.
    """

    root: str
    retained: int = store.RETAINED

    @property
    def trips(self) -> str:
        return f"{self.root}/trips"

    @property
    def parts(self) -> str:
        return f"{self.root}/hourly_parts"

    @property
    def rollup(self) -> str:
        return f"{self.root}/hourly"

    @property
    def record(self) -> str:
        return f"{self.root}/load_record"
