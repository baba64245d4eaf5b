"""Column names: turning free-text CSV headers into unique SQL identifiers."""

import re
from collections.abc import Iterable
from itertools import chain, count


def clean_name(header: str, position: int = 0) -> str:
    """Lower-case identifier for one header.

    Runs of other characters become one underscore, edges are stripped, a header
    with nothing left is named by its position, a leading digit gets a prefix.
    """
    words = re.findall(r"[a-z0-9]+", header.lower())
    name = "_".join(words) or str(position)
    return f"col_{name}" if name[0].isdigit() else name


def clean_names(headers: Iterable[str]) -> list[str]:
    """Clean every header; later clashes are numbered from 2."""
    taken: dict[str, None] = {}
    for position, header in enumerate(headers):
        name = clean_name(header, position)
        numbered = (f"{name}_{n}" for n in count(2))
        free = next(c for c in chain([name], numbered) if c not in taken)
        taken[free] = None
    return list(taken)
