"""Counters of running streams, and an HTTP endpoint that shows them."""

from __future__ import annotations

import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent


class Counters(StreamingQueryListener):
    """Batches, rows and milliseconds of each query by name (by id where it has none), and whether it failed.

    Add it by spark.streams.addListener(counters).
    """

    def __init__(self) -> None:
        self.found: dict[tuple[str, str], float] = {}
        self._names: dict[str, str] = {}
        self._lock = threading.Lock()

    def add(self, query: str, metric: str, value: float) -> None:
        with self._lock:
            self.found[query, metric] = self.found.get((query, metric), 0) + value

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self._names[str(event.id)] = event.name or str(event.id)

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        name = p.name or str(p.id)
        self.add(name, "batches", 1)
        self.add(name, "rows", p.numInputRows)
        self.add(name, "milliseconds", p.batchDuration)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        name = self._names.get(str(event.id), str(event.id))
        self.add(name, "failures" if event.exception else "ends", 1)

    def text(self) -> str:
        """A line for each counter, as scrapers read them."""
        with self._lock:
            return "".join(f'cdclake_{metric}{{query="{query}"}} {value:g}\n' for (query, metric), value in sorted(self.found.items()))


def serve(counters: Counters, port: int = 0) -> ThreadingHTTPServer:
    """Show counters at /metrics of a port (0: a free one) until shutdown() is called on the server that is returned."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            body = counters.text().encode() if self.path == "/metrics" else b""
            self.send_response(200 if self.path == "/metrics" else 404)
            self.send_header("Content-Type", "text/plain; version=0.0.4")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args) -> None:
            pass

    server = ThreadingHTTPServer(("127.0.0.1", port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
