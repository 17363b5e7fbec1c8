"""Checked requests: which months a run may touch, before it touches any."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from faremill.operators.periods import Period, month_range

# The accepted modes and the largest refresh.
REFRESH_MODE = "replace_period"
REBUILD_MODE = "full_raw_rebuild"
MAX_REFRESH_MONTHS = 12

_UNTOUCHED = "Nothing was changed."
_RANGE = ("start_year", "start_month", "end_year", "end_month")
_DEFAULT_REFRESH = {
    "start_year": "2024",
    "start_month": "01",
    "end_year": "2024",
    "end_month": "01",
    "refresh_mode": REFRESH_MODE,
}


def _text(config: Mapping[str, Any] | None, key: str) -> str:
    value = (config or {}).get(key)
    return "" if value is None else str(value).strip()


def refresh_periods(
    config: Mapping[str, Any] | None, most: int = MAX_REFRESH_MONTHS
) -> list[Period]:
    """Months of a refresh request; blank values take their defaults."""
    values = {
        key: _text(config, key) or default for key, default in _DEFAULT_REFRESH.items()
    }
    if values["refresh_mode"] != REFRESH_MODE:
        raise ValueError(
            f"refresh_mode {values['refresh_mode']!r} is unknown, only {REFRESH_MODE!r} is there"
        )
    months = month_range(*[values[key] for key in _RANGE])
    if len(months) > most:
        raise ValueError(
            f"{len(months)} months are more than the {most} that one refresh may take"
        )
    return months


@dataclass(frozen=True)
class RebuildRequest:
    """A confirmed full rebuild and the months it expects."""

    expected: tuple[Period, ...]


def _confirmed(value: Any) -> bool:
    return value is True or (isinstance(value, str) and value.strip().lower() == "true")


def rebuild_request(config: Mapping[str, Any]) -> RebuildRequest:
    """Refuse unless the mode, both confirmations and the range are given."""
    if config.get("rebuild_mode") != REBUILD_MODE:
        raise ValueError(
            f"a rebuild is asked for by rebuild_mode {REBUILD_MODE!r}. "
            f"{_UNTOUCHED}"
        )
    for key in ("confirm_full_rebuild", "confirm_serving_replacement"):
        if not _confirmed(config.get(key)):
            raise ValueError(
                f"a rebuild waits for {key}. {_UNTOUCHED}"
            )
    names = [f"expected_{key}" for key in _RANGE]
    for name in names:
        if not _text(config, name):
            raise ValueError(
                f"a rebuild needs {name}. {_UNTOUCHED}"
            )
    try:
        months = month_range(*[_text(config, name) for name in names])
    except ValueError as error:
        raise ValueError(f"{error}. {_UNTOUCHED}") from error
    return RebuildRequest(tuple(months))
