"""Names for helper columns that no column of a caller's table has."""

from __future__ import annotations

from collections.abc import Iterable


def unused(taken: Iterable[str], *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to be free among ``taken``, whatever the case."""
    have, out = {t.casefold() for t in taken}, []
    for name in names:
        while name.casefold() in have:
            name = f"_{name}"
        have.add(name.casefold())
        out.append(name)
    return out
