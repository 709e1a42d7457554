"""Plain descriptions of tables, keys, partitions and cast rules.

These objects hold schema-level facts only; no data ever lives in them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

DIALECTS = ("mysql", "mssql", "sqlite", "pgsql")


@dataclass(frozen=True)
class CastRule:
    """One source-type -> target-type rule.

    ``source_type`` empty matches every type. ``type_mod`` must be contained in
    the full column type. The three flags are tri-state: None means "do not
    look", True/False means the column must / must not have the property.
    """

    source_type: str
    target: str
    type_mod: str = ""
    unsigned: bool | None = None
    auto_increment: bool | None = None
    on_update: bool | None = None
    drop_typemod: bool = False
    transform: str | None = None


@dataclass(frozen=True)
class ColumnSpec:
    """A source column: ``source_type`` is the full type, e.g. ``int(10) unsigned``."""

    name: str
    source_type: str
    nullable: bool = True
    extra: str = ""
    labels: tuple[str, ...] = ()
    comment: str | None = None

    @property
    def auto_increment(self) -> bool:
        return "auto_increment" in self.extra


@dataclass(frozen=True)
class KeySpec:
    """A primary or unique key; ``predicate`` (Spark SQL) makes it a filtered key."""

    columns: tuple[str, ...]
    primary: bool = False
    predicate: str | None = None


@dataclass(frozen=True)
class ForeignKeySpec:
    """Child columns -> parent columns. The referential rules are metadata only."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    match: str = "simple"
    on_delete: str = "no action"
    on_update: str = "no action"

    @property
    def name(self) -> str:
        # The column names are part of the name, so two keys to one parent differ.
        return "fk_" + "_".join(self.columns) + "_" + self.parent.replace(".", "_")


@dataclass(frozen=True)
class PartitionSpec:
    """Declarative partitioning of a target table.

    range: ``partitions`` is a sequence of (name, low, high), low inclusive, high
    exclusive, None = unbounded. list: (name, values), where None among the
    values takes NULL keys. hash: ``modulus`` partitions.
    ``key`` is a column name or any Spark SQL expression.
    """

    strategy: str
    key: str
    partitions: tuple = ()
    modulus: int = 0
    default: str | None = None
    prefix: str = "p"


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    schema: str | None = None
    keys: tuple[KeySpec, ...] = ()
    foreign_keys: tuple[ForeignKeySpec, ...] = ()
    comment: str | None = None
    partitioning: PartitionSpec | None = field(default=None)

    @property
    def qualified_name(self) -> str:
        return f"{self.schema}.{self.name}" if self.schema else self.name

    @property
    def primary_key(self) -> tuple[str, ...]:
        for key in self.keys:
            if key.primary:
                return key.columns
        return ()

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.qualified_name} has no column {name!r}")
