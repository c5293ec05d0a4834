"""Column names for flattened paths. Works on schemas, never on rows.

A path that is a plain lower-case word is its own name. Every other one that would be empty,
too long, start with a digit or meet a name in use gets a mark made from the path, so names
do not depend on what else a table holds, but for the first of two that look alike.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

MAX_LENGTH = 63  # fixed value: longest identifier
ROW_ID = "id"  # the landing table's own; its other columns start with an underscore
SENDER_ID = "id_field"  # fixed value: where the sending system's record id is found


def _free_name(path: str, used: set[str]) -> str:
    plain = re.sub(r"\W", "_", path.lower(), flags=re.ASCII).strip("_")
    if plain == ROW_ID:
        plain = SENDER_ID
    if plain[:1].isalpha() and len(plain) <= MAX_LENGTH and plain not in used:
        return plain
    stem = plain if plain[:1].isalpha() else f"c{plain}"
    mark = hashlib.sha256(path.encode()).hexdigest()
    marked = (f"{stem[: MAX_LENGTH - 1 - n]}_{mark[:n]}" for n in range(8, MAX_LENGTH - 1))
    return next(name for name in marked if name not in used)


def distinct_names(paths: Iterable[str], taken: dict[str, str]) -> dict[str, str]:
    """A name for every path. `taken` maps known paths to theirs, which never change."""
    names = dict(taken)
    used = {ROW_ID, *names.values()}
    for path in paths:
        if path not in names:
            names[path] = _free_name(path, used)
            used.add(names[path])
    return names
