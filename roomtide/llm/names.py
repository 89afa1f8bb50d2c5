"""Names of helper columns that no column of a caller has."""

from __future__ import annotations

from collections.abc import Sequence


def unused(columns: Sequence[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores before it as it takes to clash with none."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
