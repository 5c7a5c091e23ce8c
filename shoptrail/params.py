"""Task parameters shared by the batch jobs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass


def _items(value) -> tuple[str, ...]:
    """A comma list, a sequence or nothing -> tuple of texts."""
    if value is None or value == "":
        return ()
    if isinstance(value, str):
        return tuple(v for v in value.split(",") if v != "")
    return tuple(str(v) for v in value)


def _number(value) -> int | None:
    return None if value is None or value == "" else int(value)


@dataclass(frozen=True)
class TaskParams:
    """What to analyse. A missing, ``None`` or empty filter lets every session pass."""

    start_date: str | None = None  # None: yesterday
    end_date: str | None = None  # None: today
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    page_flow: str = ""
    strict_bounds: bool = False  # True: one age bound alone filters too

    @classmethod
    def from_dict(cls, task: Mapping, **extra) -> "TaskParams":
        """Build from the job's parameter object (``startDate``, ``endDate``, ``startAge``, ...). Without dates the range is yesterday and today."""
        return cls(
            start_date=task.get("startDate") or None,
            end_date=task.get("endDate") or None,
            start_age=_number(task.get("startAge")),
            end_age=_number(task.get("endAge")),
            professionals=_items(task.get("professionals")),
            cities=_items(task.get("cities")),
            sex=task.get("sex") or None,
            keywords=_items(task.get("keywords")),
            category_ids=tuple(int(c) for c in _items(task.get("categoryIds"))),
            page_flow=",".join(_items(task.get("targetPageFlow"))),
            **extra,
        )
