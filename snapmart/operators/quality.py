"""Constraints as data: rows that break a rule, doubles, orphans, quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import scalars
from snapmart.roles import Roles
from snapmart.schema import RATING_LABELS


@dataclass(frozen=True)
class Rule:
    """A named condition. Like a CHECK it passes where the condition is null."""

    name: str
    condition: Column


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"{c}_not_null", F.col(c).isNotNull()) for c in columns]


def max_length(column: str, limit: int) -> Rule:
    return Rule(f"{column}_length", F.length(column) <= limit)


def entity_rules(r: Roles = Roles()) -> list[Rule]:
    return [
        Rule("price_not_negative", F.col(r.price) >= 0),
        Rule("name_not_blank", scalars.not_blank(r.name)),
        *not_null(r.entity_id, r.external_id, r.name, r.price),
    ]


def category_rules(r: Roles = Roles()) -> list[Rule]:
    return [
        Rule("category_name_not_blank", scalars.not_blank(r.category_name)),
        *not_null(r.category_id, r.category_name),
    ]


def snapshot_rules(r: Roles = Roles()) -> list[Rule]:
    return [
        Rule("current_not_negative", F.col(r.current_count) >= 0),
        Rule("peak_not_negative", F.col(r.peak_count) >= 0),
        Rule("ratings_not_negative", F.col(r.total_ratings) >= 0),
        Rule("peak_at_least_current", F.col(r.peak_count) >= F.col(r.current_count)),
        *not_null(r.snapshot_id, r.entity_id, r.current_count, r.peak_count, r.total_ratings, r.recorded_at),
    ]


def rating_rules(r: Roles = Roles(), collation: str | None = None) -> list[Rule]:
    return [
        Rule("positive_not_negative", F.col(r.positive) >= 0),
        Rule("negative_not_negative", F.col(r.negative) >= 0),
        Rule("percent_in_range", F.col(r.positive_pct).between(0, 100)),
        Rule("label_known", scalars.one_of(r.label, RATING_LABELS, collation) | F.col(r.label).isNull()),
        *not_null(r.rating_id, r.entity_id, r.positive, r.negative, r.positive_pct),
    ]


def audit_rules(collation: str | None = None) -> list[Rule]:
    return [
        Rule("operation_known", scalars.one_of("operation", ("INSERT", "UPDATE", "DELETE"), collation)),
        *not_null("database_name", "table_name", "operation", "logged_at", "user_name"),
    ]


def _broken(rules: Sequence[Rule]) -> Column:
    """Array of the names of the rules a row breaks."""
    names = [F.when(~F.coalesce(rule.condition, F.lit(True)), F.lit(rule.name)) for rule in rules]
    return F.filter(F.array(*names), lambda name: name.isNotNull())


def check(df: DataFrame, keys: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """One row per broken rule: the keys and ``rule``. A single pass, no shuffle."""
    return df.select(*keys, F.explode(_broken(rules)).alias("rule"))


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with the broken rules of each row as ``reasons``, null if it keeps all."""
    marked = df.withColumn("reasons", _broken(rules))
    return marked.withColumn("reasons", F.when(F.size("reasons") > 0, F.array_join("reasons", ",")))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with ``reasons``."""
    marked = with_reasons(df, rules)
    return marked.where("reasons IS NULL").drop("reasons"), marked.where("reasons IS NOT NULL")


def unique_violations(df: DataFrame, keys: Sequence[str], collation: str | None = None) -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    Counts are combined in the map tasks. With a collation, texts that it holds
    equal are one key; the smallest text is shown.
    """
    if collation is None:
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    else:
        texts = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
        shown = [F.min(k).alias(k) for k in keys]
        grouped = [F.collate(F.col(k), collation).alias(f"__{k}") if k in texts else F.col(k).alias(f"__{k}")
                   for k in keys]
        counted = df.groupBy(*grouped).agg(*shown, F.count(F.lit(1)).alias("rows")).select(*keys, "rows")
    return counted.where(F.col("rows") > 1)


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose parent is missing; a null reference passes.

    One join of two plain sides: Spark broadcasts parents that are few, and can
    split a reference that very many rows share.
    """
    parents = parent.select(F.col(pk).alias("__pk"))
    return child.where(F.col(fk).isNotNull()).join(parents, F.col(fk) == F.col("__pk"), "left_anti")
