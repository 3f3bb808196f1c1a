"""Which table and column plays which part.

Operators take plain DataFrames and column names. The named queries need many
columns at once, so they take a ``Tables`` (five DataFrames) and a ``Roles``
(their column names).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Roles:
    # entity: one row per item
    entity_id: str = "entity_id"
    external_id: str = "external_id"
    name: str = "name"
    description: str = "description"
    price: str = "price"
    released: str = "released"
    maker: str = "maker"
    publisher: str = "publisher"
    created_at: str = "created_at"
    updated_at: str = "updated_at"
    # category, and the bridge that holds (entity_id, category_id)
    category_id: str = "category_id"
    category_name: str = "category_name"
    # snapshot: append-only series, many rows per entity
    snapshot_id: str = "snapshot_id"
    recorded_at: str = "recorded_at"
    current_count: str = "current_count"
    peak_count: str = "peak_count"
    total_ratings: str = "total_ratings"
    # rating: at most one row per entity
    rating_id: str = "rating_id"
    positive: str = "positive"
    negative: str = "negative"
    positive_pct: str = "positive_pct"
    label: str = "label"

    def using(self, **names: str) -> Roles:
        return replace(self, **names)


@dataclass(frozen=True)
class Tables:
    """The tables a query needs; the others may be left out."""

    entity: DataFrame | None = None
    category: DataFrame | None = None
    bridge: DataFrame | None = None
    snapshot: DataFrame | None = None
    rating: DataFrame | None = None
    roles: Roles = field(default_factory=Roles)
