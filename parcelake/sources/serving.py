"""The serving side: tables in fixed shape for dashboards."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from parcelake.sources.tables import Table


def to_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Columns of the contract, in its order and with its types; a missing one is an error.

    Counts are bigint in Spark and int in the contracts. Under ANSI casts (the default) a
    count that does not fit raises instead of wrapping.
    """
    missing = [f.name for f in contract.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the served table: {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in contract.fields])


@dataclass(frozen=True)
class ParquetServing:
    spark: SparkSession
    root: str

    def refresh(self, name: str, df: DataFrame) -> None:
        Table(self.spark, f"{self.root}/{name}").overwrite(df)

    def refresh_all(self, tables: Mapping[str, DataFrame]) -> None:
        """Each table appears as a whole; the tables appear one after the other."""
        for name, df in tables.items():
            self.refresh(name, df)

    def read(self, name: str) -> DataFrame:
        return Table(self.spark, f"{self.root}/{name}").read()


@dataclass(frozen=True)
class JdbcServing:
    """Create if missing, else truncate and insert. Rows go from the executors to the database."""

    url: str
    options: Mapping[str, str] = field(default_factory=dict)

    def refresh(self, name: str, df: DataFrame) -> None:
        (
            df.write.format("jdbc").mode("overwrite")
            .option("url", self.url).option("dbtable", name).option("truncate", "true")
            .options(**self.options).save()
        )


def database_connection(spark: SparkSession, url: str, options: Mapping[str, str]):
    """A connection of the driver, for statements that move no rows through it."""
    jvm = spark._jvm
    if "driver" in options:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(options["driver"])
    properties = jvm.java.util.Properties()
    for key, value in options.items():
        properties.setProperty(key, value)
    return jvm.java.sql.DriverManager.getConnection(url, properties)


@dataclass(frozen=True)
class JdbcTwoPhaseServing(JdbcServing):
    """Tables that change in one transaction.

    First the executors fill `<name>__next` of every table; a task or job that fails there leaves
    what is served as it was, and the next refresh empties the rest of it. Then the driver replaces the
    rows of all tables from their `__next` in one transaction inside the database. A reader sees
    all of a refresh or nothing of it; if a statement or the commit fails, it is rolled back and raised.
    A refresh that is repeated ends in the same rows. One refresh at a time.
    """

    connect: Callable[[], object] = None

    def refresh(self, name: str, df: DataFrame) -> None:
        self.refresh_all({name: df})

    def refresh_all(self, tables: Mapping[str, DataFrame]) -> None:
        for name, df in tables.items():
            super().refresh(f"{name}__next", df)
            # no row: only makes the served table if it is missing
            (
                df.limit(0).write.format("jdbc").mode("append")
                .option("url", self.url).option("dbtable", name).options(**self.options).save()
            )
        connection = self.connect()
        try:
            connection.setAutoCommit(False)
            try:
                self._replace(connection, tables)
                connection.commit()
            except Exception:
                connection.rollback()
                raise
        finally:
            connection.close()

    @staticmethod
    def _replace(connection, tables: Mapping[str, DataFrame]) -> None:
        quote = connection.getMetaData().getIdentifierQuoteString().strip()
        statement = connection.createStatement()
        try:
            for name, df in tables.items():
                columns = ", ".join(f"{quote}{c}{quote}" for c in df.columns)
                statement.executeUpdate(f"DELETE FROM {name}")
                statement.executeUpdate(
                    f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {name}__next")
        finally:
            statement.close()
