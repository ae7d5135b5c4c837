"""Column-name rules, applied to ``df.columns`` before any data is touched."""

from __future__ import annotations

import re

from lateline.schema import SPECIAL_NAMES

_DELETED = str.maketrans("/-", "__", "().")


def snake_name(raw: str) -> str:
    """The snake_case name of one raw column name."""
    text = raw.strip().lower()
    if text in SPECIAL_NAMES:
        return SPECIAL_NAMES[text]
    # Every run of other characters, underscores included, becomes one underscore.
    return re.sub(r"[^a-z0-9]+", "_", text.translate(_DELETED)).strip("_")


def unique_names(names: list[str]) -> list[str]:
    """Number repeated names ``a, a_1, a_2``; a number already in use is passed over."""
    taken = set(names)
    used: set[str] = set()
    result = []
    for name in names:
        candidate, number = name, 0
        while candidate in used or (number and candidate in taken):
            number += 1
            candidate = f"{name}_{number}"
        used.add(candidate)
        result.append(candidate)
    return result
