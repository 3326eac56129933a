"""Parameters of one monthly run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from ..functions import fixed_values as fv
from .calendar import Chunk, chunk_calendar


@dataclass(frozen=True)
class RunParams:
    period_start: str = fv.PERIOD_START
    period_end: str = fv.PERIOD_END
    # Extract months kept by the aggregation (inclusive).
    complete_month_cutoff: str = fv.COMPLETE_MONTH_CUTOFF
    # Working-day months kept (exclusive) -- deliberately a separate value.
    working_day_cutoff: str = fv.WORKING_DAY_CUTOFF
    # Evaluate per-episode windows inside yearly chunks, as the monthly run does.
    chunked: bool = True
    chunks: tuple[Chunk, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "chunks", tuple(chunk_calendar(self.period_start, self.period_end)))

    @property
    def complete_month_cutoff_date(self) -> dt.date:
        return dt.date.fromisoformat(self.complete_month_cutoff)

    @property
    def working_day_cutoff_date(self) -> dt.date:
        return dt.date.fromisoformat(self.working_day_cutoff)


DEFAULT = RunParams()
