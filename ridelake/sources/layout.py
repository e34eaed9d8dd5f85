"""Where each layer lives below a lake root."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str

    def raw_trips(self, year: int) -> str:
        return f"{self.root}/raw/trips/{year}"

    def raw_weather(self, year: int) -> str:
        return f"{self.root}/raw/weather/{year}_weather.csv"

    def silver(self, load: str | None = None) -> str:
        """The Silver table, or the part of it that one load delivered."""
        return f"{self.root}/silver" if load is None else f"{self.root}/silver/load={load}"

    def changes(self, load: str | None = None) -> str:
        """Months of Silver that were rewritten and that Gold has not followed yet."""
        return f"{self.root}/silver_changes" if load is None else f"{self.root}/silver_changes/load={load}"

    def states(self, name: str | None = None) -> str:
        """Tables of monthly states."""
        return f"{self.root}/states" if name is None else f"{self.root}/states/{name}"

    @property
    def state_changes(self) -> str:
        """Months of Silver that were written and that the states have not followed yet."""
        return f"{self.root}/state_changes"

    def ride_ids(self, load: str | None = None) -> str:
        """Filters over the ride ids of Silver, by load."""
        return f"{self.root}/silver_ids" if load is None else f"{self.root}/silver_ids/load={load}"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def dimension(self, name: str) -> str:
        return f"{self.root}/gold/dimensions/{name}"

    @property
    def fact(self) -> str:
        return f"{self.root}/gold/facts/fact_trips"
