"""Message envelopes: the payload of a broker record or an agent event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def payload(df: DataFrame, body: str = "value") -> DataFrame:
    """Replace the envelope by its body as UTF-8 text; works on ``format("kafka")`` rows."""
    return df.select(F.decode(F.col(body), "UTF-8").alias("value"))
