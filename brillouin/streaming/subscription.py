"""A message queue as a streaming source: a message is acknowledged once a query has finished with it.

    spark.dataSource.register(Requests)
    messages = spark.readStream.format("requests").option("broker", "brillouin.streaming.subscription:Spool").option("path", folder).load()
    accepted(messages, requests=..., rejected=..., checkpoint=...)

Offsets are message numbers.  They are in the query's checkpoint, so a restart goes on behind the last batch that was finished and runs an unfinished one again, over
the same messages.  Spark acknowledges a batch when it plans the next one (or the first one after a restart); until then the queue holds its messages.
"""

from __future__ import annotations

import importlib
import os
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming.query import StreamingQuery

from .service import parsed_requests


class Broker(Protocol):
    """What a queue has to offer. Numbers count from 0 without gaps; -1 stands for none."""

    def acknowledged(self) -> int:
        """Number of the last message that was acknowledged."""

    def last(self) -> int:
        """Number of the last message behind which none is missing."""

    def fetch(self, first: int, last: int) -> Iterator[tuple[int, str]]:
        """Messages of these numbers, both ends included. Called by executors."""

    def acknowledge(self, last: int) -> None:
        """Lets go of all messages up to this one. May come again for the same number."""


class Spool:
    """Queue in a folder that driver and executors share: a file <number>.json for each message, renamed into place by its writer.

    A message that is missing holds back those behind it, so one that is written late is never passed over.
    """

    def __init__(self, options: dict):
        self.path = options["path"]

    def _mark(self) -> str:
        return os.path.join(self.path, "acknowledged")

    def acknowledged(self) -> int:
        try:
            with open(self._mark()) as f:
                return int(f.read())
        except FileNotFoundError:
            return -1

    def _waiting(self) -> list[int]:
        return sorted(int(n[:-5]) for n in os.listdir(self.path) if n.endswith(".json") and n[:-5].isdigit())

    def last(self) -> int:
        at = self.acknowledged()
        for number in self._waiting():
            if number > at + 1:
                break
            at = max(at, number)
        return at

    def fetch(self, first: int, last: int) -> Iterator[tuple[int, str]]:
        for number in range(first, last + 1):
            with open(os.path.join(self.path, f"{number}.json"), encoding="utf-8", errors="replace") as f:
                yield number, f.read()

    def acknowledge(self, last: int) -> None:
        if last > self.acknowledged():
            with open(f"{self._mark()}.new", "w") as f:
                f.write(str(last))
            os.replace(f"{self._mark()}.new", self._mark())
        for number in self._waiting():
            if number <= last:
                os.remove(os.path.join(self.path, f"{number}.json"))


class Span(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        module, _, name = options["broker"].partition(":")
        self.make, self.options = (module, name), options
        self.step = int(options.get("messagespertask", 1000))

    def broker(self) -> Broker:
        return getattr(importlib.import_module(self.make[0]), self.make[1])(self.options)

    def initialOffset(self) -> dict:
        return {"done": self.broker().acknowledged()}

    def latestOffset(self) -> dict:
        return {"done": self.broker().last()}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return [Span(first, min(first + self.step - 1, end["done"])) for first in range(start["done"] + 1, end["done"] + 1, self.step)]

    def read(self, partition: Span) -> Iterator[tuple[int, str]]:
        return iter(self.broker().fetch(partition.first, partition.last))

    def commit(self, end: dict) -> None:
        self.broker().acknowledge(end["done"])


class Requests(DataSource):
    """Format "requests": number, value. Options: broker (module:class, see Broker), messagesPerTask, and what the broker takes."""

    @classmethod
    def name(cls) -> str:
        return "requests"

    def schema(self) -> str:
        return "number long, value string"

    def streamReader(self, schema) -> _Reader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def accepted(messages: DataFrame, *, requests: str, rejected: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Writes the requests of a stream of messages and, apart, those that don't fit the model: Parquet tables with a folder for each batch.

    A batch that is run again replaces its folders, so each message is in one of the tables once. Rejected messages are acknowledged as well and not tried again.
    """

    def write(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()
        for part, path in zip(parsed_requests(rows), (requests, rejected), strict=True):
            part.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")
        rows.unpersist()

    stream = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if available_now else stream).start()
