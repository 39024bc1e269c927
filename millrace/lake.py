"""Where the layers of a lake live."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


def checked_day(day: str) -> str:
    """The day as ``YYYY-MM-DD``; anything else is refused before it becomes a path."""
    return date.fromisoformat(day).isoformat()


def day_range(start: str, n_days: int) -> list[str]:
    first = date.fromisoformat(start)
    return [(first + timedelta(days=i)).isoformat() for i in range(n_days)]


def day_path(root: str, entity: str, day: str) -> str:
    """The folder with one entity's raw lines of one day."""
    return f"{root}/{entity}/date={checked_day(day)}"


@dataclass(frozen=True)
class Lake:
    """Paths are any URI Hadoop can open; access settings belong to the session, not here."""

    root: str
    raw: str
    fmt: str = "parquet"

    def raw_entity(self, entity: str) -> str:
        return f"{self.raw}/{entity}"

    def bronze(self, entity: str) -> str:
        return f"{self.root}/bronze/{entity}"

    def silver(self, entity: str) -> str:
        return f"{self.root}/silver/{entity}"

    def quarantine(self, entity: str) -> str:
        return f"{self.root}/silver/quarantine/{entity}"

    def bad_lines(self, entity: str) -> str:
        return f"{self.root}/bronze/_bad_lines/{entity}"

    def staging(self, entity: str) -> str:
        return f"{self.root}/_staging/{entity}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def day_runs(self, entity: str) -> str:
        return f"{self.root}/pipeline_days/{entity}"

    @property
    def runs(self) -> str:
        return f"{self.root}/pipeline_runs"
