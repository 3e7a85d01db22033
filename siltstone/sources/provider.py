"""A Python Data Source over a paged object API, one partition per pull request.

The transport is a callable (path, page) -> (status, list of objects), named by import path in the option
``transport``, so tests and offline runs use recorded answers. Pages are read up to a bound; reaching it is an
error and never a silent truncation. Server errors are tried again with growing pauses; missing objects are
rows of their own kind.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "repository string, pull_request bigint, kind string, object_id string, payload string, missing boolean"
#: Object kinds and their paths; page size, pages, tries; statuses to try again and to report as missing.
KINDS = {"pull_request": "pulls/{n}", "commit": "pulls/{n}/commits", "timeline": "issues/{n}/timeline", "run": "pulls/{n}/runs", "check": "pulls/{n}/checks"}
PAGE, MOST_PAGES, TRIES = 100, 10, 3
AGAIN, GONE = (500, 502, 503, 504), (404, 410)


def fetch(transport: Callable, path: str, page: int, pause: float) -> tuple[int, list]:
    for k in range(TRIES):
        status, objects = transport(path, page)
        if status not in AGAIN:
            return status, objects
        time.sleep(pause * 2**k)
    raise OSError(f"{path}: status {status} after {TRIES} tries")


def pages(transport: Callable, path: str, page_size: int = PAGE, most: int = MOST_PAGES, pause: float = 0.5) -> Iterator[dict] | None:
    """All objects of a collection; None if it's gone."""
    out: list[dict] = []
    for page in range(1, most + 1):
        status, objects = fetch(transport, path, page, pause)
        if status in GONE:
            return None
        if status != 200:
            raise OSError(f"{path}: status {status}")
        out += objects
        if len(objects) < page_size:
            return out
    raise OSError(f"{path}: more than {most} pages of {page_size}")


class PullRequest(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


class Reader(DataSourceReader):
    def __init__(self, options):
        self.repository = options["repository"]
        self.numbers = [int(n) for n in options["pull_requests"].split(",") if n.strip()]
        self.transport, self.pause = options["transport"], float(options.get("pause", "0.5"))

    def partitions(self):
        return [PullRequest(n) for n in self.numbers]

    def read(self, partition):
        module, _, name = self.transport.partition(":")
        transport = getattr(importlib.import_module(module), name)
        for kind, path in KINDS.items():
            found = pages(transport, f"{self.repository}/{path.format(n=partition.number)}", pause=self.pause)
            if found is None:
                yield self.repository, partition.number, kind, None, None, True
                continue
            seen = set()
            for obj in found:
                if (name := str(obj["id"])) not in seen:  # the first of an id counts
                    seen.add(name)
                    yield self.repository, partition.number, kind, name, json.dumps(obj, sort_keys=True, separators=(",", ":"), ensure_ascii=False), False


class ProviderSource(DataSource):
    """``spark.read.format("siltstone_provider").option("repository", ...).option("pull_requests", "1,2").option("transport", "module:function")``"""

    @classmethod
    def name(cls):
        return "siltstone_provider"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return Reader(self.options)
