"""Figures about the stream: lag, retention, offsets, histograms, health. Rules are column expressions, so they run over tables too."""

from __future__ import annotations

import threading
from dataclasses import dataclass, field
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walrill.functions.retry import PermanentError
from walrill.operators.ordered import running

#: Upper bounds of the histograms' buckets (fixed values).
DURATION_BUCKETS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10)
SIZE_BUCKETS = (1, 2, 5, 10, 25, 50, 100, 250, 500, 1000)
#: Metric families and their kinds (fixed values).
FAMILIES = {
    "cdc_messages_processed_total": "counter", "cdc_messages_published_total": "counter", "cdc_transactions_acked_total": "counter", "cdc_errors_total": "counter", "cdc_dead_letters_total": "counter",
    "cdc_lag_seconds": "gauge", "cdc_retention_headroom_seconds": "gauge", "cdc_pending_events": "gauge", "cdc_group_age_seconds": "gauge", "cdc_ready": "gauge",
    "cdc_batch_duration_seconds": "histogram", "cdc_batch_size": "histogram",
}
#: Seconds of retention unless RETENTION_SECONDS says otherwise; WAL that is held so long and so far ahead is a stall.
RETENTION_SECONDS, STALL_SECONDS, STALL_BYTES = 604_800, 60, 64 << 20


def lag(produced: Column, consumed: Column) -> Column:
    """Events not consumed yet; -1 where either offset is unknown or the consumer is ahead."""
    return F.when((produced < 0) | (consumed < 0) | (consumed > produced), F.lit(-1).cast("long")).otherwise((produced - consumed).cast("long"))


def retention_outran(committed: Column, start: Column) -> Column:
    """Whether the log was cut beyond what was committed."""
    return (committed >= 0) & (committed < start)


def headroom(lag_seconds: Column, budget: Column) -> Column:
    return budget - lag_seconds


def consumer_figures(offsets: DataFrame) -> DataFrame:
    """produced, consumed, lag and outran from (start, end, committed) offsets, of which a negative or missing one is unknown.

    -1 says unknown: all three unless both ends are known and in order, consumed and lag without a commit, lag beyond the end."""
    known = lambda c: F.coalesce(F.col(c) >= 0, F.lit(False))
    ends = known("start") & known("end") & F.coalesce(F.col("end") >= F.col("start"), F.lit(False))
    read = ends & known("committed")
    figure = lambda when, value, name: F.when(when, value).otherwise(-1).cast("long").alias(name)
    return offsets.select(
        "*", figure(ends, F.col("end") - F.col("start"), "produced"), figure(read, F.col("committed") - F.col("start"), "consumed"),
        figure(read & (F.col("end") >= F.col("committed")), F.col("end") - F.col("committed"), "lag"), (known("start") & F.coalesce(retention_outran(F.col("committed"), F.col("start")), F.lit(False))).alias("outran"),
    )


def stalled(seconds: Column, bytes_ahead: Column) -> Column:
    """From STALL_SECONDS on, with more than STALL_BYTES waiting; what is unknown is no stall."""
    return F.coalesce((seconds >= STALL_SECONDS) & (bytes_ahead > STALL_BYTES), F.lit(False))


def retention_ms(setting: Column) -> Column:
    """A topic's ``retention.ms`` from its text; 0 if it is missing or no number."""
    return F.coalesce(setting.try_cast("bigint"), F.lit(0).cast("bigint"))


def position_faults(reports: DataFrame) -> DataFrame:
    """Reports (pos, lsn) of a durable position before one reported earlier, with that (``durable``)."""
    seen = running(reports, ["pos"], {"durable": ("max", F.col("lsn"))}, exclusive=True)
    return seen.where("lsn < durable").select("pos", "lsn", "durable")


def bucket(value: Column, bounds: tuple[float, ...]) -> Column:
    """The least bound at or above ``value``; infinity beyond all."""
    out = F.lit(float("inf"))
    for b in reversed(bounds):
        out = F.when(value <= F.lit(float(b)), F.lit(float(b))).otherwise(out)
    return out


def histogram(df: DataFrame, value: str, bounds: tuple[float, ...]) -> DataFrame:
    """(le, n) for each bucket that holds a value; counts combine before the exchange."""
    return df.groupBy(bucket(F.col(value), bounds).alias("le")).agg(F.count(F.lit(1)).alias("n"))


def durability_faults(topic: DataFrame) -> DataFrame:
    """``topic`` (brokers, partitions, replication, in_sync, min_in_sync) with the first rule that it breaks."""
    fault = (
        F.when(F.col("brokers") < 3, "fewer than 3 brokers").when(F.col("partitions") != 1, "not exactly 1 partition").when(F.col("replication") < 3, "replication below 3")
        .when(F.col("in_sync") < 2, "fewer than 2 replicas in sync").when(F.col("min_in_sync") < 2, "min.insync.replicas below 2")
    )
    return topic.withColumn("fault", fault)


def require_durable(topic: DataFrame) -> None:
    """Raises unless ``topic`` keeps every rule; to be called before a stream starts. No waiting mends a wrong setting."""
    fault = durability_faults(topic).where("fault is not null").select("fault").first()
    if fault is not None:
        raise PermanentError(f"the topic can't be relied on: {fault['fault']}")


@dataclass
class Metrics:
    """Counters, gauges and histograms of a process, in the text form that scrapers read."""

    values: dict[tuple[str, tuple[tuple[str, str], ...]], float] = field(default_factory=dict)
    observed: dict[str, list[float]] = field(default_factory=dict)
    ready: bool = False
    _lock: threading.Lock = field(default_factory=threading.Lock)

    def add(self, name: str, by: float = 1, **labels: str) -> None:
        with self._lock:
            key = (name, tuple(sorted(labels.items())))
            self.values[key] = self.values.get(key, 0) + by

    def set(self, name: str, value: float) -> None:
        with self._lock:
            self.values[name, ()] = value

    def observe(self, name: str, value: float) -> None:
        bounds = DURATION_BUCKETS if name == "cdc_batch_duration_seconds" else SIZE_BUCKETS
        with self._lock:
            cells = self.observed.setdefault(name, [0.0] * (len(bounds) + 2))
            for i, b in enumerate((*bounds, float("inf"))):
                if value <= b:
                    cells[i] += 1
            cells[-1] += value

    def set_ready(self, ready: bool) -> None:
        self.ready = ready
        self.set("cdc_ready", float(ready))

    def set_lag(self, lag_seconds: float, retention: float = RETENTION_SECONDS) -> None:
        self.set("cdc_lag_seconds", lag_seconds)
        self.set("cdc_retention_headroom_seconds", retention - lag_seconds)

    def batch_done(self, report: dict, seconds: float) -> None:
        """Takes in what a writer reports after a commit: counts by outcome, what waits and for how long."""
        outcomes = {k: v for k, v in report.items() if k not in ("batch", "version", "pending", "group_age")}
        for outcome, n in outcomes.items():
            if n:
                self.add("cdc_messages_processed_total", n, outcome=outcome)
        self.add("cdc_dead_letters_total", report.get("dead letter", 0) + report.get("unreadable", 0))
        if "pending" in report:
            self.set("cdc_pending_events", report["pending"])
        if "group_age" in report:
            self.set("cdc_group_age_seconds", report["group_age"])
        self.observe("cdc_batch_duration_seconds", seconds)
        self.observe("cdc_batch_size", sum(outcomes.values()))

    def publish_done(self, report: dict) -> None:
        """Takes in what a publisher reports after a batch."""
        self.add("cdc_messages_published_total", report.get("published", 0))
        self.add("cdc_transactions_acked_total", report.get("transactions", 0))

    def failed(self, component: str) -> None:
        self.add("cdc_errors_total", component=component)

    def text(self) -> str:
        with self._lock:
            lines = []
            for name, kind in FAMILIES.items():
                lines.append(f"# TYPE {name} {kind}")
                for (n, labels), v in sorted(self.values.items()):
                    if n == name:
                        inner = ",".join(f'{k}="{x}"' for k, x in labels)
                        lines.append(f"{name}{{{inner}}} {v:g}" if inner else f"{name} {v:g}")
                if name in self.observed:
                    bounds = DURATION_BUCKETS if name == "cdc_batch_duration_seconds" else SIZE_BUCKETS
                    cells = self.observed[name]
                    lines += [f'{name}_bucket{{le="{b:g}"}} {c:g}' for b, c in zip((*bounds, float("inf")), cells, strict=False)]
                    lines += [f"{name}_sum {cells[-1]:g}", f"{name}_count {cells[-2]:g}"]
            return "\n".join(lines) + "\n"


def answer(metrics: Metrics, path: str) -> tuple[int, str]:
    """Status and body of the three pages."""
    if path == "/metrics":
        return 200, metrics.text()
    if path == "/healthz":
        return 200, "ok\n"
    if path == "/readyz":
        return (200, "ready\n") if metrics.ready else (503, "not ready\n")
    return 404, "not found\n"


def serve(metrics: Metrics, port: int = 0) -> ThreadingHTTPServer:
    """Serves the pages in the background."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            status, body = answer(metrics, self.path)
            self.send_response(status)
            self.send_header("Content-Type", "text/plain; charset=utf-8")
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *_) -> None:
            pass

    server = ThreadingHTTPServer(("", port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
