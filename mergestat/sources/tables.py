"""Table loading and the keyed projection.

Sources are plain parquet scans; we only ever ``select`` the columns a
statistic needs so that Catalyst prunes the scan's ``ReadSchema`` and pushes
key filters into ``PushedFilters``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a scale-factor folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def key_names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def keyed(df: DataFrame, keys: str | Sequence[str], value: str | Column,
          value_name: str = "value", extra: Sequence[str] = ()) -> DataFrame:
    """Event -> (key..., value).  ``extra`` columns (order, batch) ride along."""
    v = F.col(value) if isinstance(value, str) else value
    return df.select(*key_names(keys), *extra, v.alias(value_name))


def keyed_event(df: DataFrame, keys: str | Sequence[str],
                fields: Sequence[str], name: str = "event") -> DataFrame:
    """Event -> (key..., struct(event fields)) — the whole event as one value."""
    return df.select(*key_names(keys), F.struct(*fields).alias(name))


def only_key(df: DataFrame, key: str, value) -> DataFrame:
    """keep one key value; a plain predicate, pushed into the parquet scan."""
    return df.where(F.col(key) == F.lit(value))


def events_stream_view(df: DataFrame) -> DataFrame:
    """The default mapping of the ``events`` table onto the keyed-event model.

    label <- event_type, value <- value, order <- (ts, event_id),
    batch <- calendar day of ts.
    """
    return df.select(
        F.col("event_type").alias("label"),
        F.col("value"),
        F.col("ts"),
        F.col("event_id"),
        F.to_date("ts").alias("batch"),
    )
