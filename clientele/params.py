"""Explicit run parameters; nothing reads the clock."""

from __future__ import annotations

import dataclasses
import datetime as dt
import re

from clientele.functions import fixed_values as fv
from clientele.functions.predicates import ALL

SEGMENTS = ("VIP", "RETAIL", "WHOLESALE", ALL)


def as_date(value: str | dt.date) -> dt.date:
    """A run date as a date; text must be written YYYY-MM-DD."""
    if isinstance(value, dt.date):
        return value
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
        raise ValueError(f"run date {value!r} is not written YYYY-MM-DD")
    return dt.date.fromisoformat(value)


@dataclasses.dataclass(frozen=True)
class RunParams:
    """Parameters of one load.

    ``as_of`` is the day from which recency is counted. ``batch_size`` None takes every row; with a size, each
    call stages and scores the next batch. ``batch_sizes`` may override the size for a segment. The configured scores have
    a model version of their own, by default the first one with ``-configured``. ``campaign`` limits the campaign figures
    of the day to one campaign; those of the others stay. ``workflow`` and ``job`` name the load in the audit table.
    """

    run_date: dt.date
    segment: str = ALL
    region: str = ALL
    campaign: str = ALL
    batch_size: int | None = None
    batch_sizes: tuple[tuple[str, int], ...] = ()
    model_version: str = fv.MODEL_VERSION
    config_model_version: str | None = None
    as_of: dt.date | None = None
    allow_empty: bool = False
    spend_rule: str = "per_customer"
    workflow: str = "WEEKLY"
    job: str = "SEGMENT_LOAD"

    def __post_init__(self):
        object.__setattr__(self, "run_date", as_date(self.run_date))
        object.__setattr__(self, "segment", self.segment.upper())
        if self.segment not in SEGMENTS:
            raise ValueError(f"segment {self.segment!r} is not one of {SEGMENTS}")
        if self.config_model_version is None:
            object.__setattr__(self, "config_model_version", f"{self.model_version}-configured")
        if self.config_model_version == self.model_version:
            raise ValueError("the configured scores need a model version of their own")
        if self.as_of is None:
            object.__setattr__(self, "as_of", self.run_date)

    @property
    def batch(self) -> int | None:
        return dict(self.batch_sizes).get(self.segment, self.batch_size)

    @property
    def batch_number(self) -> int:
        """The run date as a number, used as load batch id."""
        return int(self.run_date.strftime("%Y%m%d"))
