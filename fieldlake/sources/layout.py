"""Where the tables of an environment lie."""

from __future__ import annotations

import posixpath
from collections.abc import Mapping
from dataclasses import dataclass

from fieldlake.errors import SourceError
from fieldlake.sources.versions import FORMAT as VERSIONED, KEPT


@dataclass(frozen=True)
class Layout:
    """Paths of all layers under one root, on any file system Spark can reach.

    Facts lie by month of their event date, or with ``facts_by_day`` by the date itself: then a
    filter of a view on that date reads the days it names alone. Of a table that a run replaces
    ``kept_versions`` stay; with 1 the old one goes as soon as the new one is complete, so that a
    reader must not go on over a run.
    """

    root: str
    table_format: str = "parquet"
    facts_by_day: bool = False
    kept_versions: int = KEPT

    def __post_init__(self):
        if self.kept_versions < 1:
            raise SourceError(f"a table keeps one version at least, not {self.kept_versions}")

    @property
    def batch_format(self) -> str:
        """The format of tables that a run replaces: Parquet ones are versioned, so that readers never see a gap."""
        return VERSIONED if self.table_format == "parquet" else self.table_format

    def _at(self, *parts: str) -> str:
        return posixpath.join(self.root, *parts)

    def landing(self, source: str, file_name: str = "") -> str:
        return self._at("landing", source, file_name) if file_name else self._at("landing", source)

    def bronze(self, source: str) -> str:
        return self._at("bronze", source)

    def silver(self, source: str) -> str:
        return self._at("silver", source)

    def gold(self, model: str) -> str:
        return self._at("gold", model)

    def quality(self, run: str) -> str:
        return self._at("quality", run)

    def incoming(self, source: str) -> str:
        return self._at("incoming", source)

    def live_bronze(self, source: str) -> str:
        return self._at("live-bronze", source)

    def live_silver(self, source: str) -> str:
        return self._at("live-silver", source)

    def live_partials(self, source: str) -> str:
        return self._at("live-partials", source)

    def checkpoint(self, stream: str) -> str:
        return self._at("checkpoints", stream)


def choose_layout(environment: str, layouts: Mapping[str, Layout]) -> Layout:
    """The layout of an environment; an unknown name is an error, never a default."""
    wanted = environment.strip().lower()
    if wanted not in layouts:
        raise SourceError(f"unknown environment {environment!r}; known are {sorted(layouts)}")
    return layouts[wanted]
