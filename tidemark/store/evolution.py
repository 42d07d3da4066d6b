"""What differs between a stored schema and a new one, and what to do about columns that went."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class SchemaDiff:
    new_columns: list[str] = field(default_factory=list)
    missing_columns: list[str] = field(default_factory=list)
    changed_types: dict[str, tuple[str, str]] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.new_columns or self.missing_columns or self.changed_types)

    def warnings(self) -> list[str]:
        return (
            [f"new column {c}" for c in self.new_columns]
            + [f"missing column {c}" for c in self.missing_columns]
            + [f"column {c} was {a} and is {b}" for c, (a, b) in self.changed_types.items()]
        )


def compare(stored: StructType | None, fresh: StructType) -> SchemaDiff:
    """Differences by name and by type; none where nothing is stored."""
    if stored is None:
        return SchemaDiff()
    old, new = ({f.name: f.dataType.simpleString() for f in s} for s in (stored, fresh))
    return SchemaDiff([c for c in new if c not in old], [c for c in old if c not in new], {c: (old[c], new[c]) for c in new if c in old and old[c] != new[c]})


class MissingColumnsError(ValueError):
    """A stored column isn't among the new ones, and the policy is to refuse that."""


#: What to do about missing columns: 'raise', 'overwrite' (the new schema replaces the old) or 'ignore' (they become NULL).
Policy = str | Callable[[SchemaDiff], str]


def decide(diff: SchemaDiff, policy: Policy) -> str:
    """The action for a diff with missing columns: 'overwrite' or 'ignore'; raises MissingColumnsError otherwise."""
    action = policy(diff) if callable(policy) else policy
    if action == "raise":
        raise MissingColumnsError("; ".join(diff.warnings()))
    if action not in ("overwrite", "ignore"):
        raise ValueError(f"unknown policy {action!r}")
    return action
