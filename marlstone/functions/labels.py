"""Result labels."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

SEPARATOR = ", "


def escape(label: str) -> str:
    """Escape the commas of one level."""
    return label.replace("\\,", ",").replace(",", "\\,")


def unescape(label: str) -> str:
    return label.replace("\\,", ",")


def flatten(levels: Iterable[object], drop: Sequence[int] = ()) -> str:
    """One flat label out of several levels; null levels are skipped."""
    kept = [escape(str(v)) for i, v in enumerate(levels) if i not in drop and v is not None and str(v) != ""]
    return SEPARATOR.join(kept)


def unique(labels: Sequence[str]) -> list[str]:
    """Make repeated labels unique: ``x, x__1, x__2``."""
    seen: dict[str, int] = {}
    out: list[str] = []
    for label in labels:
        if label in seen:
            candidate = label
            while candidate in seen:
                seen[label] += 1
                candidate = f"{label}__{seen[label]}"
            seen[candidate] = 0
            out.append(candidate)
        else:
            seen[label] = 0
            out.append(label)
    return out
