"""Relational targets of streams and hourly jobs: staged, keyed, replay-safe.

Spark writes a batch to a staging table of its own (in parallel, a truncated or
new table each time).  Then one transaction on the driver's connection moves the
rows into the target with set statements and notes the batch in a ledger, so that
the target shows a batch wholly or not at all:

* ``append``: the target's rows of this batch (or hour) are deleted, then the
  staged rows are inserted.  A replayed batch, or an hour run again, replaces itself.
* ``upsert``: the target's rows with a staged key are deleted, then the staged rows
  are inserted.  A batch that the ledger has, or a later one, makes an older batch a
  no-op, so a late replay cannot put an old state over a newer one.

No row goes through the driver; only the statements do.  Keys are compared with
``IS NOT DISTINCT FROM`` (a null key is a key).  The statements are standard SQL;
identifiers are quoted.  ``connect`` opens a connection with ``execute(sql)``,
``query(sql) -> first column of the first row or None``, ``commit()``, ``rollback()``
and ``close()``; the default one goes through the JDBC driver on Spark's classpath.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch_id"


def quoted(name: str) -> str:
    """A (schema-qualified) identifier in double quotes."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def literal(value: int | str) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def ledger_statement(ledger: str) -> str:
    return f"CREATE TABLE IF NOT EXISTS {quoted(ledger)} (target VARCHAR(200), batch_id BIGINT, PRIMARY KEY (target))"


def note_statements(ledger: str, target: str, batch_id: int) -> list[str]:
    return [f"DELETE FROM {quoted(ledger)} WHERE target = {literal(target)}",
            f"INSERT INTO {quoted(ledger)} (target, batch_id) VALUES ({literal(target)}, {batch_id})"]


def target_statement(target: str, staging: str) -> str:
    """The target in the staged rows' columns and types, if it is not there."""
    return f"CREATE TABLE IF NOT EXISTS {quoted(target)} AS SELECT * FROM {quoted(staging)} WHERE 1 = 0"


def insert_statement(target: str, staging: str, columns: Sequence[str]) -> str:
    names = ", ".join(quoted(c) for c in columns)
    return f"INSERT INTO {quoted(target)} ({names}) SELECT {names} FROM {quoted(staging)}"


def append_statements(target: str, staging: str, columns: Sequence[str], scope: str, value: int | str) -> list[str]:
    """Replace the target's rows with ``scope = value`` by the staged ones."""
    return [target_statement(target, staging),
            f"DELETE FROM {quoted(target)} WHERE {quoted(scope)} = {literal(value)}",
            insert_statement(target, staging, columns)]


def upsert_statements(target: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Replace the target's rows that have a staged key."""
    same = " AND ".join(f"s.{quoted(k)} IS NOT DISTINCT FROM {quoted(target)}.{quoted(k)}" for k in keys)
    return [target_statement(target, staging),
            f"DELETE FROM {quoted(target)} WHERE EXISTS (SELECT 1 FROM {quoted(staging)} s WHERE {same})",
            insert_statement(target, staging, columns)]


class JdbcConnection:
    """A connection of the driver's JVM without auto-commit."""

    def __init__(self, spark: SparkSession, url: str, properties: dict):
        jvm = spark.sparkContext._jvm
        settings = jvm.java.util.Properties()
        for k, v in properties.items():
            settings.setProperty(k, v)
        if "driver" in properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
        self.connection = jvm.java.sql.DriverManager.getConnection(url, settings)
        self.connection.setAutoCommit(False)

    def execute(self, sql: str) -> None:
        statement = self.connection.createStatement()
        try:
            statement.execute(sql)
        finally:
            statement.close()

    def query(self, sql: str) -> int | None:
        statement = self.connection.createStatement()
        try:
            rows = statement.executeQuery(sql)
            return rows.getLong(1) if rows.next() else None
        finally:
            statement.close()

    def commit(self) -> None:
        self.connection.commit()

    def rollback(self) -> None:
        self.connection.rollback()

    def close(self) -> None:
        self.connection.close()


@dataclass
class JdbcTarget:
    """Tables ``<prefix><name>``, their staging tables and one ledger."""

    url: str
    prefix: str
    properties: dict = field(default_factory=dict)
    connect: Callable[[SparkSession, str, dict], JdbcConnection] = JdbcConnection

    def table(self, name: str) -> str:
        return f"{self.prefix}{name}"

    @property
    def ledger(self) -> str:
        return self.table("batches")

    def _stage(self, df: DataFrame, name: str) -> str:
        staging = f"{self.table(name)}_staging"
        df.write.jdbc(url=self.url, table=quoted(staging), mode="overwrite", properties={**self.properties, "truncate": "false"})
        return staging

    def _run(self, spark: SparkSession, work: Callable[[JdbcConnection], None]) -> None:
        connection = self.connect(spark, self.url, self.properties)
        try:
            work(connection)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def append(self, df: DataFrame, name: str, value: int | str, scope: str = BATCH) -> None:
        """Rows of one batch or hour, which ``scope = value`` marks."""
        target = self.table(name)
        staging = self._stage(df, name)

        def work(c: JdbcConnection) -> None:
            for sql in append_statements(target, staging, df.columns, scope, value):
                c.execute(sql)

        self._run(df.sparkSession, work)

    def upsert(self, df: DataFrame, name: str, keys: Sequence[str], batch_id: int) -> bool:
        """The newest state of each key; False where the ledger has a later batch."""
        target = self.table(name)
        staging = self._stage(df, name)
        done = []

        def work(c: JdbcConnection) -> None:
            c.execute(ledger_statement(self.ledger))
            last = c.query(f"SELECT batch_id FROM {quoted(self.ledger)} WHERE target = {literal(target)}")
            if last is not None and last > batch_id:
                return
            for sql in upsert_statements(target, staging, df.columns, keys):
                c.execute(sql)
            for sql in note_statements(self.ledger, target, batch_id):
                c.execute(sql)
            done.append(True)

        self._run(df.sparkSession, work)
        return bool(done)

    def batch_writer(self, name: str) -> Callable[[DataFrame, int], None]:
        """A foreachBatch function that appends each batch once."""
        def write(batch: DataFrame, batch_id: int) -> None:
            self.append(batch.withColumn(BATCH, F.lit(batch_id).cast("bigint")), name, batch_id)
        return write
