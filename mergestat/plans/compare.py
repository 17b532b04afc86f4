"""Result normalisation for oracle comparison and plan inspection helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every DOUBLE column (and DOUBLE array) to ``digits`` decimals.

    Double sums depend on the order Spark merges partial buffers in, so both
    our result and the SQL oracle are compared at a fixed precision.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DoubleType):
            c = F.transform(c, lambda x: F.round(x, digits))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (``explain`` output captured)."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))
