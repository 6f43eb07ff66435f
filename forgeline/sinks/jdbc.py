"""Export to an RDBMS table."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: the driver class of the target database.
DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"


def jdbc_url(server: str, database: str, port: int = 1433) -> str:
    return f"jdbc:sqlserver://{server}:{port};databaseName={database}"


def jdbc_write_options(
    server: str, database: str, table: str, user: str, password: str, batch_rows: int = 10_000, partitions: int = 16
) -> dict[str, str]:
    """Options of a bulk export. ``partitions`` caps the connections the database sees. The
    credentials come from the caller and travel as options, not inside the URL."""
    return {
        "url": jdbc_url(server, database),
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": DRIVER,
        "batchsize": str(batch_rows),
        "numPartitions": str(partitions),
    }


def export_jdbc(df: DataFrame, options: dict[str, str], truncate: bool = False) -> None:
    """Append to a table, or replace its rows while keeping its definition."""
    writer = df.write.format("jdbc").options(**options)
    if truncate:
        writer.option("truncate", "true").mode("overwrite").save()
    else:
        writer.mode("append").save()
