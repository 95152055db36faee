"""Rules on records: a condition that is broken gives a message, a set of conditions gives points."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A finding: ``broken`` is a boolean column, ``message`` its text; severity is error, warning or info."""

    name: str
    broken: Column
    message: Column
    severity: str = "error"


@dataclass(frozen=True)
class Dimension:
    """A part of a score: the sum of (condition, points) pairs."""

    name: str
    parts: Sequence[tuple[Column, int]] = field(default_factory=list)

    def column(self) -> Column:
        out = F.lit(0)
        for condition, points in self.parts:
            out = out + F.when(F.coalesce(condition, F.lit(False)), points).otherwise(0)
        return out


def messages(rules: Sequence[Rule], severity: str | None = None) -> Column:
    """Array of the messages of broken rules, in the rules' order."""
    chosen = [r for r in rules if severity in (None, r.severity)]
    if not chosen:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(F.coalesce(r.broken, F.lit(False)), r.message) for r in chosen]))


def score(df: DataFrame, dimensions: Sequence[Dimension], rules: Sequence[Rule]) -> DataFrame:
    """``df`` with a column per dimension, ``score`` (their sum) and ``flags`` (all messages)."""
    scored = df.select("*", *[d.column().alias(f"score_{d.name}") for d in dimensions], messages(rules).alias("flags"))
    total = F.lit(0)
    for d in dimensions:
        total = total + F.col(f"score_{d.name}")
    return scored.withColumn("score", total)


def validate(df: DataFrame, rules: Sequence[Rule], ignored: Sequence[str] = ()) -> DataFrame:
    """``df`` with arrays ``errors`` and ``warnings``; rules by an ignored name are left out."""
    kept = [r for r in rules if r.name not in ignored]
    return df.select("*", messages(kept, "error").alias("errors"), messages(kept, "warning").alias("warnings"))
