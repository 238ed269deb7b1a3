"""Matching of file headers to known fields. Works on names only, never on rows."""

from __future__ import annotations

import re
from collections.abc import Iterable

from tillscope.schemas import COVERAGE_ALIASES, PREVIEW_ALIASES, UPLOAD_ALIASES


def underscored(name: str) -> str:
    return name.lower().replace(" ", "_")


def alphanumeric(name: str) -> str:
    return "".join(ch for ch in name.lower() if ch.isalnum())


def ascii_alphanumeric(name: str) -> str:
    return re.sub(r"[^a-z0-9]", "", name.lower())


def detect_columns(columns: Iterable[str], strict: bool = True) -> dict[str, str]:
    """Canonical field -> header. Of several fitting headers the last one wins.

    ``strict=False`` also ignores punctuation, so that ``InvoiceNo`` or
    ``Unit-Price`` are found.
    """
    spell = underscored if strict else alphanumeric
    found = {}
    for field, aliases in UPLOAD_ALIASES.items():
        spellings = {spell(alias) for alias in aliases}
        fitting = [column for column in columns if spell(column) in spellings]
        if fitting:
            found[field] = fitting[-1]
    return found


def field_coverage(columns: Iterable[str]) -> dict[str, str | None]:
    """Field label -> header, or None. Aliases are tried in their listed order."""
    by_spelling = {alphanumeric(column): column for column in columns}
    return {
        label: next((by_spelling[s] for s in map(alphanumeric, aliases) if s in by_spelling), None)
        for label, aliases in COVERAGE_ALIASES.items()
    }


def preview_fields(columns: Iterable[str]) -> dict[str, str | None]:
    """Field label -> first fitting header in file order, or None."""
    columns = list(columns)
    return {
        label: next(
            (c for c in columns if ascii_alphanumeric(c) in set(map(ascii_alphanumeric, aliases))), None
        )
        for label, aliases in PREVIEW_ALIASES.items()
    }
