"""The running counts and the raw tweets as stream outputs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from chirpline.operators.counts import airline_sentiment_counts, sentiment_counts, tag_counts
from chirpline.operators.records import key_fields
from chirpline.schema import TABLES, keys_of


@dataclass(frozen=True)
class Output:
    """One result of the stream.

    ``fields`` are the record fields it needs, so that no others are parsed;
    ``large`` says that its keys may grow without bound.
    """

    table: str
    make: Callable[[DataFrame], DataFrame]
    fields: tuple[str, ...]
    large: bool = False

    @property
    def keys(self) -> list[str]:
        return keys_of(self.table)


HASHTAGS = Output("hashtags", tag_counts, ("hashtags",), large=True)
SENTIMENT = Output("sentiment_counts", sentiment_counts, ("airline_sentiment",))
AIRLINE = Output("airline_sentiment", airline_sentiment_counts, ("airline", "airline_sentiment"))
RUNNING_COUNTS = (HASHTAGS, SENTIMENT, AIRLINE)

RAW = Output(
    "tweets",
    key_fields,
    tuple(name for name in TABLES["tweets"].names if name != "processing_time"),
)
