"""Watching a running stream and stopping it between batches."""

import logging
import time
from collections import deque

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tillroll.sources.paths import folder_exists

log = logging.getLogger(__name__)

#: Seconds between two looks at a running stream.
POLL_SECONDS = 5.0
#: Seconds to wait for the present batch before the stream is stopped within it.
STOP_SECONDS = 600.0


class Progress(StreamingQueryListener):
    """The latest progress reports of the streams of a session, also written to the log.

    Add it with ``spark.streams.addListener``. Only the last ``keep`` reports are held.
    """

    def __init__(self, keep: int = 1000):
        self.reports = deque(maxlen=keep)
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        log.info("stream %s started", event.id)

    def onQueryProgress(self, event) -> None:
        report = event.progress
        log.info(
            "batch %s: %s rows, %s ms", report.batchId, report.numInputRows, report.batchDuration
        )
        self.reports.append(report)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("stream %s ended: %s", event.id, event.exception or "stopped")
        self.ended[str(event.id)] = event.exception

    def batches(self) -> list[tuple[int, int]]:
        """(batch id, input rows) of the reports held that had rows."""
        return [(r.batchId, r.numInputRows) for r in self.reports if r.numInputRows]


def stop_between_batches(query: StreamingQuery, seconds: float = STOP_SECONDS) -> bool:
    """Stop a stream once its present batch is done; false if that took too long.

    It is stopped in either case. A batch cut off is not committed; the next start delivers
    it again and replaces what it wrote.
    """
    end = time.monotonic() + seconds
    while query.isActive and query.status["isTriggerActive"]:
        if time.monotonic() > end:
            query.stop()
            return False
        time.sleep(0.05)
    query.stop()
    return True


def run_until_stopped(
    spark: SparkSession,
    query: StreamingQuery,
    stop_path: str | None = None,
    poll_seconds: float = POLL_SECONDS,
) -> None:
    """Wait for a stream: until it ends or fails, or until something lies at ``stop_path``.

    A failure of the stream is raised here.
    """
    while not query.awaitTermination(poll_seconds):
        if stop_path and folder_exists(spark, stop_path):
            stop_between_batches(query)
