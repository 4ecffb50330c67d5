"""Daily gross-merchandise-value tables from change-event logs, as Spark DataFrame jobs."""

from daybook.logs import EventLogs
from daybook.operators.latest import latest_by
from daybook.operators.window import DateWindow, resolve_window
from daybook.plans.incremental import impacted_dates, state_complete_gmv
from daybook.plans.metric import full_history_gmv, gmv_as_of, windowed_gmv
from daybook.plans.run import RunReport, run_daily_gmv

__all__ = [
    "DateWindow",
    "EventLogs",
    "RunReport",
    "full_history_gmv",
    "gmv_as_of",
    "impacted_dates",
    "latest_by",
    "resolve_window",
    "run_daily_gmv",
    "state_complete_gmv",
    "windowed_gmv",
]
