"""Mart specifications and the registry that builds marts by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from starmill.sources.schemas import entity_name


@dataclass(frozen=True)
class MartSpec:
    """What a mart reads and what it promises about its rows."""

    name: str
    sources: tuple[str, ...]
    grain: tuple[str, ...]
    columns: Mapping[str, str]
    builder: Callable[..., DataFrame] = field(repr=False)
    positive: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    between: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    in_set: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    target: str = ""

    @property
    def target_table(self) -> str:
        return f"gold.{self.target or self.name}"


_MARTS: dict[str, MartSpec] = {}


def mart(sources: str, grain: str, columns: str, **checks):
    """Register the decorated builder as a mart.

    ``sources`` and ``grain`` are space-separated names, ``columns`` is the output schema as
    ``name type, ...`` in output order.
    """

    def register(builder: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        typed = dict(part.strip().split(" ", 1) for part in columns.split(","))
        _MARTS[builder.__name__] = MartSpec(
            name=builder.__name__,
            sources=tuple(sources.split()),
            grain=tuple(grain.split()),
            columns=typed,
            builder=builder,
            **checks,
        )
        return builder

    return register


def _loaded() -> dict[str, MartSpec]:
    import starmill.plans  # noqa: F401  (fills the registry)

    return _MARTS


def mart_names() -> list[str]:
    return sorted(_loaded())


def spec(name: str) -> MartSpec:
    return _loaded()[name]


def build(name: str, tables: Mapping[str, DataFrame], **args) -> DataFrame:
    """The mart as a DataFrame. ``tables`` may use entity or raw table names."""
    chosen = spec(name)
    have = {entity_name(t): df for t, df in tables.items()}
    missing = [s for s in chosen.sources if s not in have]
    if missing:
        raise KeyError(f"{name} needs the tables {missing}")
    # The declared order of columns is the table's contract (keys first, then measures).
    return chosen.builder(have, **args).select(*chosen.columns)
