"""Domain flags: an ordered registry of name -> pattern, searched without regard to case."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def check_registry(registry: Mapping[str, str], required: Iterable[str]) -> None:
    missing = sorted(set(required) - set(registry))
    if missing:
        raise ValueError(f"flag registry lacks {missing}")


def flag_columns(text: Column, registry: Mapping[str, str] = fixed.DOMAIN_FLAGS) -> dict[str, Column]:
    """One boolean column per registered flag.

    Patterns of the default registry run only on texts that hold one of their
    substrings: most texts have none, and a substring search is far cheaper.
    Texts with letters that only equal a plain one in a search without regard to
    case are always searched.
    """
    lowered, unusual = F.lower(text), text.rlike(fixed.CASE_VARIANTS)

    def flag(name: str, pattern: str) -> Column:
        found = text.rlike(f"(?iU){pattern}")
        if pattern == fixed.DOMAIN_FLAGS.get(name):
            possible = reduce(Column.__or__, [lowered.contains(n) for n in fixed.FLAG_NEEDLES[name]], unusual)
            found = possible & found
        return F.coalesce(found, F.lit(False))

    return {name: flag(name, pattern) for name, pattern in registry.items()}


def priority_label(
    columns: Iterable[str],
    labels: Mapping[str, str] = fixed.FLAG_LABELS,
    default: str = fixed.DEFAULT_LABEL,
) -> Column:
    """Label of the first flag that is set; flags the table lacks never match."""
    present = set(columns)
    return F.coalesce(
        *[F.when(F.col(flag), F.lit(label)) for flag, label in labels.items() if flag in present], F.lit(default)
    )
