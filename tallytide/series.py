"""The one abstraction every ordered operator takes."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class SeriesSpec:
    """Names the columns that make a table a set of series.

    ``order_by`` must be a total order inside one ``key``: ties would make
    fills, lags and differences depend on the shuffle.
    """

    key: tuple[str, ...]
    order_by: tuple[str, ...]
    value: str

    def __post_init__(self) -> None:
        for field in ("key", "order_by"):
            given = getattr(self, field)
            object.__setattr__(self, field, (given,) if isinstance(given, str) else tuple(given))

    def of(self, value: str) -> SeriesSpec:
        """The same series with another value column."""
        return replace(self, value=value)
