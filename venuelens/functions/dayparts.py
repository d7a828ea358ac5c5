"""Day-part bucketing of a timestamp's hour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four day-part labels of the visit query and their inclusive hour bounds.
MORNING = "Morning (6-12)"
AFTERNOON = "Afternoon (12-18)"
EVENING = "Evening (18-24)"
NIGHT = "Night/Early Morning (0-6)"
DAY_PARTS = ((MORNING, 6, 11), (AFTERNOON, 12, 17), (EVENING, 18, 23))


def day_part(ts: Column | str) -> Column:
    """Label of the hour of ``ts``; hours 0-5 and a NULL timestamp fall to the night label."""
    hour = F.hour(F.col(ts) if isinstance(ts, str) else ts)
    expr = None
    for label, lo, hi in DAY_PARTS:
        cond = hour.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(NIGHT)
