"""Entity specification: the seven names that place an entity in the lake, its
keys, schemas and layer hooks. Driver-side configuration only, no data."""

from __future__ import annotations

from dataclasses import MISSING, dataclass, field, fields
from typing import Any, Callable

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Layout:
    """Where a layer of an entity lives: one naming pattern per layer, filled in with the
    entity's names. Callers with their own conventions pass their own patterns."""
    raw: str = "{root}/{env}/raw/{functional_domain}/{functional_sub_domain}/{data_source}/{entity}/{sub_entity}/{ingestion_type}"
    bronze: str = "{env}_bronze_{functional_domain}.{functional_sub_domain}_{data_source}_{entity}_{sub_entity}"
    silver: str = "{env}_silver_{functional_domain}.{functional_sub_domain}_{entity}_{sub_entity}"


@dataclass(frozen=True)
class EntitySpec:
    functional_domain: str
    functional_sub_domain: str
    data_type: str
    data_source: str
    entity: str
    ingestion_type: str
    sub_entity: str
    primary_keys: tuple[str, ...] = ()
    raw_schema: StructType | None = None
    bronze_schema: StructType | None = None
    silver_schema: StructType | None = None
    sequence_column: str | None = None
    operation_column: str | None = None
    bronze_func: Callable | None = None
    bronze_args: tuple = ()
    bronze_kwargs: dict = field(default_factory=dict)
    silver_func: Callable | None = None
    silver_args: tuple = ()
    silver_kwargs: dict = field(default_factory=dict)
    delimiter: str = "|"
    header: bool = True
    read_options: dict = field(default_factory=dict)
    env: str = "dev"
    root: str = "lake"
    layout: Layout = Layout()

    def __post_init__(self):
        empty = [k for k in self.names() if not getattr(self, k)]
        if empty:
            raise ValueError(f"an entity needs a value for each of its names; empty: {', '.join(empty)}")

    @classmethod
    def names(cls) -> list[str]:
        """The fields that have no default: they place the entity in the lake."""
        return [f.name for f in fields(cls) if f.default is MISSING and f.default_factory is MISSING]

    def _fill(self, pattern: str) -> str:
        return pattern.format(env=self.env, root=self.root, **{k: getattr(self, k) for k in self.names()})

    @property
    def raw_path(self) -> str:
        return self._fill(self.layout.raw)

    @property
    def bronze_name(self) -> str:
        return self._fill(self.layout.bronze)

    @property
    def silver_name(self) -> str:
        return self._fill(self.layout.silver)


class Registry(dict):
    """Specs keyed by (domain, sub-domain, entity, sub-entity)."""

    def add(self, spec: EntitySpec) -> EntitySpec:
        self[(spec.functional_domain, spec.functional_sub_domain, spec.entity, spec.sub_entity)] = spec
        return spec

    def get_spec(self, domain: str, sub_domain: str, entity: str, sub_entity: str) -> EntitySpec:
        return self[(domain, sub_domain, entity, sub_entity)]

    def with_args(self, key: tuple, **changes: Any) -> EntitySpec:
        from dataclasses import replace
        return replace(self[key], **changes)
