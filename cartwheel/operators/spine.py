"""Gold abandonment spine: the anchor rows of a training set."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.timestamps import strip_event_time
from ..schemas import SPINE_COLUMNS


def abandonment_spine(labelled: DataFrame) -> DataFrame:
    """Keys, event time, target and real-time payload of every labelled event.

    ``label_available_date`` goes through a millisecond text round trip: it
    truncates to ms and, on a stream, yields a plain column without the
    upstream watermark's event-time metadata. A pure projection, no shuffle.
    """
    return (labelled.withColumn("label_available_date", strip_event_time("label_available_date"))
                    .select(*SPINE_COLUMNS))
