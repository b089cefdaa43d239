"""Day and time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundloom.functions.indices import as_col

# Launch days of the two L-band satellites and the lidar time origin.
LAUNCH_FIRST = "2006-01-24"
LAUNCH_SECOND = "2014-05-24"
LIDAR_EPOCH = "2018-01-01 00:00:00"


def day_of_year(days_after_launch: Column | str, year: Column | int) -> Column:
    """Day of the year from days since launch; the satellite changes with the year 2014."""
    year = F.lit(year) if isinstance(year, int) else year
    launch = F.when(year < 2014, F.lit(LAUNCH_FIRST).cast("date")).otherwise(F.lit(LAUNCH_SECOND).cast("date"))
    new_year = F.make_date(year, F.lit(1), F.lit(1))
    return (as_col(days_after_launch) + F.date_diff(launch, new_year) + 1).cast("smallint")


def epoch_seconds(seconds: Column | str, epoch: str = LIDAR_EPOCH) -> Column:
    """Time origin plus a number of seconds, as a time without zone."""
    return (F.lit(epoch).cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), as_col(seconds).cast("decimal(18,6)")))
