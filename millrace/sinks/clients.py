"""Sinks with a client: one connection per partition, opened where the rows are.

A client made on the driver cannot travel to the executors, one per record costs
a connection per row; these two forms open it once per partition and close it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, Row


class Client(Protocol):
    def send(self, message: str) -> None: ...

    def close(self) -> None: ...


def deliver(df: DataFrame, col: str, connect: Callable[[], Client]) -> DataFrame:
    """Send a text column and return receipts ``(opened, sent, sent_chars)``, at most one row per
    partition. A retried task sends again: delivery is at least once, receipts are exact."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, sent, chars = None, 0, 0
        try:
            for batch in batches:
                for message in batch[col]:
                    client = client or connect()
                    client.send(message)
                    sent += 1
                    chars += len(message)
        finally:
            if client:
                client.close()
        if client:
            yield pd.DataFrame({"opened": [1], "sent": [sent], "sent_chars": [chars]})

    return df.select(col).mapInPandas(run, "opened long, sent long, sent_chars long")


class PartitionWriter:
    """The same life cycle for ``writeStream.foreach``."""

    def __init__(self, col: str, connect: Callable[[int, int], Client]):
        self.col = col
        self.connect = connect
        self.client: Client | None = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.client = self.connect(partition_id, epoch_id)
        return True

    def process(self, row: Row) -> None:
        self.client.send(row[self.col])

    def close(self, error: Exception | None) -> None:
        if self.client:
            self.client.close()
