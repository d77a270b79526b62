"""Pipeline counters: one row for a batch, observed metrics for a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from fluxwell.schema import RANGE, TIMESTAMP

OBSERVATION = "pipeline"


def counters() -> list[Column]:
    """Counters over judged rows. Unreadable payloads never reach validation, so they are
    not processed records; an unknown error type counts as a schema error.

    ``records_valid`` is counted at validation, before any write.
    """
    reached = F.col("parse_error").isNull()
    failed = reached & F.col("error").isNotNull()
    kind = F.col("error.error_type")
    return [
        F.count_if(reached).alias("records_processed"),
        F.count_if(failed & ~kind.isin(TIMESTAMP, RANGE)).alias("validation_errors_schema"),
        F.count_if(failed & (kind == TIMESTAMP)).alias("validation_errors_timestamp"),
        F.count_if(failed & (kind == RANGE)).alias("validation_errors_range"),
        F.count_if(reached & F.col("error").isNull()).alias("records_valid"),
    ]


def pipeline_counters(judged: DataFrame) -> DataFrame:
    """One row of counters for a batch of judged rows."""
    return judged.agg(*counters())


def observe(judged: DataFrame, name: str = OBSERVATION) -> DataFrame:
    """Count rows on their way to the sink; read the result from the query progress."""
    return judged.observe(name, *counters())


class CounterListener(StreamingQueryListener):
    """Adds up the observed counters of every micro-batch."""

    def __init__(self, name: str = OBSERVATION) -> None:
        self.name = name
        self.totals: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            for key, value in row.asDict().items():
                self.totals[key] = self.totals.get(key, 0) + value

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
