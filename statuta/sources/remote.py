"""Remote services as a Python data source (S-01): one partition per host, so that each host's throttle holds, with bounded retries.

    spark.dataSource.register(RemoteSource)
    spark.read.format("statuta_remote").option("urls", "https://host/a https://host/b").load()

Rows are (url, status, body, error); a failure is a row with an error, never a missing row. Only HTTPS is followed, and only within a host.
"""

from __future__ import annotations

import time
from collections import defaultdict
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def allowed(url: str, origin: str | None = None) -> bool:
    """S-02: HTTPS, and on a redirect the same host."""
    parts = urlsplit(url)
    return parts.scheme == "https" and bool(parts.hostname) and (origin is None or parts.hostname == urlsplit(origin).hostname)


def wait_seconds(status: int, retry_after: str | None, attempt: int) -> float | None:
    """How long to wait before another attempt; None if there is none."""
    if attempt >= 2 or not (status == 429 or status >= 500 or status == 0):
        return None
    return min(60.0, float(retry_after)) if retry_after and retry_after.isdigit() else 1.0 + attempt


class Host(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class RemoteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "statuta_remote"

    def schema(self) -> str:
        return "url string, status int, body string, error string"

    def reader(self, schema) -> RemoteReader:
        return RemoteReader(self.options)


class RemoteReader(DataSourceReader):
    def __init__(self, options):
        self.urls = options.get("urls", "").split()
        self.pause = float(options.get("pause", "0.6"))
        self.timeout = float(options.get("timeout", "30"))

    def partitions(self):
        hosts = defaultdict(list)
        for u in self.urls:
            hosts[urlsplit(u).hostname].append(u)
        return [Host(u) for _, u in sorted(hosts.items(), key=lambda x: str(x[0]))]

    def read(self, partition):
        import urllib.error
        import urllib.request

        class SameHost(urllib.request.HTTPRedirectHandler):
            def redirect_request(self, req, fp, code, msg, headers, newurl):
                if not allowed(newurl, req.full_url):
                    raise urllib.error.URLError("redirect refused")
                return super().redirect_request(req, fp, code, msg, headers, newurl)

        opener = urllib.request.build_opener(SameHost)
        for url in partition.urls:
            if not allowed(url):
                yield url, 0, None, "only https is read"
                continue
            for attempt in range(3):
                status, body, error, after = 0, None, None, None
                try:
                    with opener.open(url, timeout=self.timeout) as answer:
                        status, body = answer.status, answer.read().decode("utf-8", "replace")
                except urllib.error.HTTPError as e:
                    status, error, after = e.code, str(e), e.headers.get("Retry-After")
                except OSError as e:
                    error = str(e)
                wait = wait_seconds(status, after, attempt) if error else None
                time.sleep(self.pause if wait is None else wait)
                if wait is None:
                    break
            yield url, status, body, error
