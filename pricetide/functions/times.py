"""Timestamps and the windows an update pass covers."""

from pyspark.sql import functions as F


def micros(ts):
    """Microseconds since the epoch."""
    return F.unix_micros(ts.cast("timestamp"))


def add_seconds(ts, seconds):
    span = F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return ts.cast("timestamp") + span


def second_grid(start, end):
    """Every whole second step of a window, from its start."""
    return F.sequence(start, end, F.expr("interval 1 second"))


def iso_text(ts):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
