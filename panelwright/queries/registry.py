"""Query registry: each entry pairs a Spark callable with an equivalent DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _digits(spec: str) -> dict[str, int]:
    out = {}
    for item in spec.split():
        name, _, d = item.partition(":")
        out[name] = int(d or 8)
    return out


def query(name: str, sql: str | None = None, dbl: str = ""):
    """Register ``fn(tables) -> DataFrame``.

    ``dbl`` lists computed double columns as ``name[:digits]``; both sides are rounded to that
    many digits so that order-of-addition noise does not show. Integers leave as bigint.
    """
    digits = _digits(dbl)

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(Tables(spark, sf_dir))
            whole = (T.IntegerType, T.ShortType, T.ByteType)
            cols = []
            for f in df.schema.fields:
                c = f"`{f.name}`"
                if f.name in digits:
                    cols.append(f"round(CAST({c} AS DOUBLE), {digits[f.name]}) + 0.0D AS {c}")
                elif isinstance(f.dataType, whole):
                    cols.append(f"CAST({c} AS BIGINT) AS {c}")
                else:
                    cols.append(c)
            return df.selectExpr(*cols)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            text = sql
            if digits:
                rep = ", ".join(
                    f'round(CAST("{c}" AS DOUBLE), {d}) + 0.0 AS "{c}"' for c, d in digits.items()
                )
                text = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS rounded"
            ORACLES[name] = text
        return fn

    return wrap
