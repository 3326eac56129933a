"""Extraction period and its yearly chunks.

The monthly run extracts the period in roughly yearly chunks, and every
per-episode window (max dose, min intent, first known demographics, best
address) is evaluated inside one chunk.  Here the chunks are not separate
queries: a ``chunk_id`` column, derived from the treatment date, joins the
key of every per-episode aggregate, which gives the same rows as binding the
per-chunk results in one plan.
"""

from __future__ import annotations

import calendar as _cal
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import fixed_values as fv


@dataclass(frozen=True)
class Chunk:
    chunk_id: int
    start: dt.date
    end: dt.date


def _add_months(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.month - 1 + n, 12)
    y, m = d.year + y, m + 1
    return dt.date(y, m, min(d.day, _cal.monthrange(y, m)[1]))


def _next_month_start(d: dt.date) -> dt.date:
    """Ceiling to a month boundary; a date already on one moves on a month."""
    return _add_months(d.replace(day=1), 1)


def _round_half_even(x: float) -> int:
    return int(round(x))  # Python rounds half to even


def chunk_calendar(start: str = fv.PERIOD_START, end: str = fv.PERIOD_END) -> list[Chunk]:
    """Split ``[start, end]`` into the chunks of the monthly run.

    Full months in the period, divided by 12 and rounded half to even, give
    the number of chunks; chunk ``i`` ends the month after ``start`` plus
    ``12 i - 1`` months, and the last chunk always runs to ``end``.
    """
    s, e = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    months = (e.year - s.year) * 12 + (e.month - s.month) - (1 if e.day < s.day else 0)
    n = max(_round_half_even(months / 12), 1)
    starts, ends = [s], []
    for i in range(1, n + 1):
        boundary = _next_month_start(_add_months(s, 12 * i - 1))
        starts.append(boundary)
        ends.append(boundary - dt.timedelta(days=1))
    ends[n - 1] = e
    return [Chunk(i + 1, starts[i], ends[i]) for i in range(n)]


def chunk_id(d: Column, chunks: list[Chunk]) -> Column:
    """Chunk number of a date (null outside the period)."""
    expr = None
    for c in chunks:
        cond = d.between(F.lit(c.start), F.lit(c.end))
        expr = F.when(cond, F.lit(c.chunk_id)) if expr is None else expr.when(cond, F.lit(c.chunk_id))
    return expr


def in_period(d: Column, chunks: list[Chunk]) -> Column:
    return d.between(F.lit(chunks[0].start), F.lit(chunks[-1].end))
