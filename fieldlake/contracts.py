"""Sources, models and serving tables described as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from fieldlake.errors import ContractError


@dataclass(frozen=True)
class Range:
    """Plausible values of a column; ``None`` leaves that side open."""

    column: str
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class SourceContract:
    """What a source looks like at the edge and how it is cleaned.

    ``columns`` is the edge schema as a DDL string in file order. ``retyped`` names the columns
    whose type changes in cleaning. ``required`` columns must not be NULL for a row to be kept and
    ``key`` identifies a row; the two differ where a key part may be missing.
    """

    name: str
    file_name: str
    columns: str
    key: tuple[str, ...]
    required: tuple[str, ...]
    retyped: Mapping[str, str] = field(default_factory=dict)
    blanks: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    trims: tuple[str, ...] = ()
    ranges: tuple[Range, ...] = ()
    expected_rows: int | None = None
    free_text: bool = False

    @property
    def edge_types(self) -> dict[str, str]:
        pairs = (column.split() for column in self.columns.split(","))
        return {name: kind.lower() for name, kind in pairs}

    @property
    def column_names(self) -> list[str]:
        return list(self.edge_types)

    @property
    def text_schema(self) -> str:
        """The edge columns, all as text."""
        return ", ".join(f"`{name}` string" for name in self.column_names)

    @property
    def clean_types(self) -> dict[str, str]:
        return {**self.edge_types, **self.retyped}

    @property
    def parsed_columns(self) -> list[str]:
        """Columns whose cleaned type is not text, so a value can be lost in parsing."""
        return [name for name, kind in self.clean_types.items() if kind != "string"]

    def __post_init__(self):
        known = set(self.edge_types)
        named = {*self.key, *self.required, *self.retyped, *self.blanks, *self.codes, *self.trims}
        named |= {rule.column for rule in self.ranges}
        if named - known:
            raise ContractError(f"{self.name}: rules name unknown columns {sorted(named - known)}")


@dataclass(frozen=True)
class ModelSpec:
    """A dimension or fact table: where it comes from, its grain and its columns.

    ``columns`` maps an output column to a SQL expression over the cleaned source. With ``latest_by``
    the newest row of a key wins; without it the rows of a key are put in a total order.
    ``event_date`` names the output column that dates a fact, for partitioning its table by month.
    """

    name: str
    source: str
    key: tuple[str, ...]
    required: tuple[str, ...]
    columns: Mapping[str, str]
    latest_by: str | None = None
    event_date: str | None = None


@dataclass(frozen=True)
class ServingContract:
    """The fixed columns, order and SQL types a reader of a table may rely on."""

    name: str
    columns: Mapping[str, str]
