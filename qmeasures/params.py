"""Run parameters shared by every measure (performance year and claim run-out)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


def _add_months(d: dt.date, months: int) -> dt.date:
    """First-of-month aware month shift (only used on first-of-month dates)."""
    y, m = divmod(d.month - 1 + months, 12)
    return dt.date(d.year + y, m + 1, d.day)


@dataclass(frozen=True)
class MeasureParams:
    """Dates that parameterise one measurement run.

    ``measure_start`` is the first day of the performance year and ``measure_end``
    defaults to December 31 of that year.  ``date_latestpaid`` is the last paid
    date of the claim extract.  ``runout_start`` defaults to the first day of the
    month after ``date_latestpaid`` minus three months: visits on or after it are
    still "in run-out" (not final).  ``empirical_elig_date_end`` overrides the
    eligibility end that is otherwise derived from the data (the last enrollment
    end shared by at least ``min_member_count`` members).
    """

    measure_start: dt.date
    date_latestpaid: dt.date
    measure_end: dt.date | None = None
    runout_start: dt.date | None = None
    empirical_elig_date_end: dt.date | None = None
    min_member_count: int = 42
    extra: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if self.measure_end is None:
            object.__setattr__(self, "measure_end", dt.date(self.measure_start.year, 12, 31))
        if self.runout_start is None:
            month_after = _add_months(self.date_latestpaid.replace(day=1), 1)
            object.__setattr__(self, "runout_start", _add_months(month_after, -3))

    @classmethod
    def for_year(cls, year: int, date_latestpaid: dt.date, **kw) -> "MeasureParams":
        return cls(measure_start=dt.date(year, 1, 1), date_latestpaid=date_latestpaid, **kw)

    def key(self) -> tuple:
        """Identity of a run for shared intermediates; ``extra`` counts."""
        return (self, tuple(sorted((k, repr(v)) for k, v in self.extra.items())))

    def with_(self, **kw) -> "MeasureParams":
        return replace(self, **kw)

    @property
    def round_elig_date(self) -> dt.date:
        """The earlier of latest paid date and measure end."""
        return min(self.date_latestpaid, self.measure_end)
