"""Which columns play a part: update time, create time, business key."""

from __future__ import annotations

from collections.abc import Iterable

# Names and name parts that source schemas use.
UPDATE_NAMES = ("lastupdatetime", "lastupdatedate", "last_update_date")
UPDATE_PARTS = ("update", "updat", "modify", "modified")
UPDATE_TIME_PARTS = ("time", "date", "createat", "createdat", "updateat", "updatedat")
CREATE_PARTS = ("create", "creat")
CREATE_TIME_PARTS = ("date", "time", "createat", "creatat", "createdat")
BOOKKEEPING = "__dbz__"


class MissingColumn(ValueError):
    """A column that the work needs isn't there."""


def _first(names: Iterable[str], *needs: tuple[str, ...]) -> str | None:
    return next((n for n in names if all(any(p in n.lower() for p in parts) for parts in needs)), None)


def update_column(names: Iterable[str], use_global: bool = True) -> str | None:
    """The update-time column: a well-known name first, else the first name that speaks of an update and a time."""
    names = list(names)
    known = next((n for n in names if n.lower() in UPDATE_NAMES), None) if use_global else None
    return known or _first(names, UPDATE_PARTS, UPDATE_TIME_PARTS)


def create_column(names: Iterable[str]) -> str | None:
    """The create-time column, from which partitions derive."""
    return _first(names, CREATE_PARTS, CREATE_TIME_PARTS)


def key_columns(names: Iterable[str]) -> list[str]:
    """Key fields without the source's bookkeeping."""
    return [n for n in names if BOOKKEEPING not in n.lower()]


def required(found: str | None, what: str) -> str:
    if not found:
        raise MissingColumn(f"no {what} column")
    return found
