"""Registration of named queries over a directory of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadastra.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``tables.orders`` is the DataFrame of ``<directory>/orders.parquet``."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        # Called once per table: the frame is kept, because each read has to open a file footer.
        df = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        setattr(self, name, df)
        return df


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under ``name`` with its SQL counterpart."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(tune(spark), sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
