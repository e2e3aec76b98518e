from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

NO_DATA = "no data"
LOADED = "loaded"
INCOMPLETE = "incomplete"


@dataclass(frozen=True)
class RunResult:
    """What a run did. ``watermark`` is set only if the run published one."""

    status: str
    rows: int = 0
    rejected: int = 0
    watermark: dt.datetime | None = None
