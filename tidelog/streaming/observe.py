"""Health and metrics for operators: documents and pages for HTTP, and probes."""

from __future__ import annotations

import json
import socket
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from tidelog.operators.accounting import BUCKETS

VERSION = "1.0.0"


class Metrics:
    """Counters, gauges and a duration histogram, as Prometheus text."""

    def __init__(self):
        self.lock, self.started = threading.Lock(), time.time()
        self.counts: dict[tuple, float] = {}
        self.gauges: dict[tuple, float] = {}
        self.durations: dict[str, list[float]] = {}

    def add(self, name: str, n: float = 1, **labels: str) -> None:
        with self.lock:
            key = (name, *sorted(labels.items()))
            self.counts[key] = self.counts.get(key, 0) + n

    def set(self, name: str, value: float, **labels: str) -> None:
        with self.lock:
            self.gauges[(name, *sorted(labels.items()))] = value

    def observe(self, seconds: float, destination: str) -> None:
        with self.lock:
            row = self.durations.setdefault(destination, [0.0] * (len(BUCKETS) + 2))
            for i, b in enumerate(BUCKETS):
                row[i] += seconds <= b
            row[-2] += 1
            row[-1] += seconds

    def render(self) -> str:
        def line(name, labels, value):
            text = ",".join(f'{k}="{v}"' for k, v in labels)
            return f"{name}{{{text}}} {value:g}" if text else f"{name} {value:g}"

        with self.lock:
            out = [line(k[0], k[1:], v) for k, v in sorted(self.counts.items())] + [line(k[0], k[1:], v) for k, v in sorted(self.gauges.items())]
            for d, row in sorted(self.durations.items()):
                out += [line("replication_duration_seconds_bucket", (("destination", d), ("le", str(b))), v) for b, v in zip((*BUCKETS, "+Inf"), row, strict=False)]
                out += [line("replication_duration_seconds_sum", (("destination", d),), row[-1]), line("replication_duration_seconds_count", (("destination", d),), row[-2])]
            out.append(line("uptime_seconds", (), time.time() - self.started))
        return "\n".join(out) + "\n"


class Health:
    """Healthy if there are dependencies and all are up."""

    def __init__(self):
        self.started, self.dependencies = time.time(), {}

    def update(self, name: str, up: bool, latency_ms: float) -> None:
        self.dependencies[name] = {"status": "up" if up else "down", "latency_ms": round(latency_ms, 2), "last_check": datetime.now(UTC).isoformat()}

    @property
    def healthy(self) -> bool:
        return bool(self.dependencies) and all(d["status"] == "up" for d in self.dependencies.values())

    def document(self) -> dict:
        return {"status": "healthy" if self.healthy else "unhealthy", "version": VERSION, "timestamp": datetime.now(UTC).isoformat(), "uptime_seconds": round(time.time() - self.started, 2), "dependencies": self.dependencies}

    def probe(self, probes: dict[str, Callable[[], object]], timeout: float = 5.0) -> None:
        """All probes at once; a failing or late one is down at latency 0."""
        pool = ThreadPoolExecutor(max(1, len(probes)))
        begun = {name: (time.time(), pool.submit(p)) for name, p in probes.items()}
        for name, (at, result) in begun.items():
            try:
                ok = result.result(timeout) is not False
                self.update(name, ok, (time.time() - at) * 1000 if ok else 0.0)
            except Exception:
                self.update(name, False, 0.0)
        pool.shutdown(wait=False)


def folder_exists(spark, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at))


def reaches(host: str, port: int, timeout: float = 5.0) -> Callable[[], bool]:
    """A probe of a store by its port."""

    def probe() -> bool:
        with socket.create_connection((host, port), timeout):
            return True

    return probe


def every(seconds: float, health: Health, probes: dict[str, Callable[[], object]], stop: threading.Event) -> threading.Thread:
    """Probe now and then, until told to stop."""

    def run() -> None:
        while not stop.is_set():
            health.probe(probes)
            stop.wait(seconds)

    found = threading.Thread(target=run, daemon=True)
    found.start()
    return found


def serve(port: int, health: Health | None = None, metrics: Metrics | None = None) -> ThreadingHTTPServer:
    """/health (200 or 503) and /metrics in a thread; other paths are 404."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path == "/health" and health:
                code, kind, body = (200 if health.healthy else 503), "application/json", json.dumps(health.document())
            elif self.path == "/metrics" and metrics:
                code, kind, body = 200, "text/plain; version=0.0.4", metrics.render()
            else:
                code, kind, body = 404, "text/plain", "not found"
            self.send_response(code)
            self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
