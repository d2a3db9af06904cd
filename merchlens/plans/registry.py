"""Registry of queries: name -> Spark job, output columns, oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracle_tables import with_tables
from .tables import Retail


@dataclass(frozen=True)
class Query:
    build: Callable[[Retail], DataFrame]
    columns: str
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return shape(self.build(Retail(spark, folder)), self.columns)

    def oracle(self) -> str | None:
        return None if self.sql is None else with_tables(f"SELECT {select_list(self.columns)} FROM ({self.sql})")


QUERIES: dict[str, Query] = {}


def register(name: str, columns: str, sql: str | None = None):
    """Columns are `name`, `name:N` (rounded to N digits), `name:i` (bigint) or `name:s` (text)."""
    def keep(build: Callable[[Retail], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(build, columns, sql)
        return build

    return keep


def _parse(columns: str) -> list[tuple[str, str]]:
    return [(c.partition(":")[0], c.partition(":")[2]) for c in columns.split()]


def rounded(x: Column, digits: int) -> Column:
    """Rounding five digits further first puts a value on or off the tie in any engine.

    Spark rounds doubles by way of decimals, which is most of the work on a row of a panel. A value that is the double nearest to a decimal
    of so few digits is what the rounding gives back, so it is left as it is (adding 0 turns -0.0 to 0.0, as rounding does).
    """
    power = F.lit(10.0**digits)
    there = (F.abs(x) < F.lit(10.0 ** (15 - digits))) & (F.rint(x * power) / power == x)
    return F.when(there, x + F.lit(0.0)).otherwise(F.round(F.round(x, digits + 5), digits))


def shape(df: DataFrame, columns: str) -> DataFrame:
    def one(name: str, fmt: str):
        c = F.col(name)
        if fmt == "i":
            c = c.cast("bigint")
        elif fmt == "s":
            c = c.cast("string")
        elif fmt:
            c = rounded(c.cast("double"), int(fmt))
        return c.alias(name)

    return df.select(*[one(n, f) for n, f in _parse(columns)])


def select_list(columns: str) -> str:
    def one(name: str, fmt: str) -> str:
        if fmt == "i":
            return f'CAST("{name}" AS BIGINT) AS "{name}"'
        if fmt == "s":
            return f'CAST("{name}" AS VARCHAR) AS "{name}"'
        if fmt:
            near = f'CAST(CAST("{name}" AS DOUBLE) AS DECIMAL(38, {int(fmt) + 5}))'
            return f'CAST(round({near}, {fmt}) AS DOUBLE) AS "{name}"'
        return f'"{name}"'

    return ", ".join(one(n, f) for n, f in _parse(columns))
