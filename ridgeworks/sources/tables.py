"""Delimited text in, CSV and result tables out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridgeworks.operators.indexing import row_index

# fixed values: column names of the hourly logs
LOG_COLUMNS = ["date", "time", "AMPM", "delhipm", "delhiaqi", "chennaipm", "aqichenn", "pmkol"]
RESULTS = "n long, accuracy double, lambda double, elapsed_s double"


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """CSV with a header line; blanks around names and values do not count."""
    return spark.read.csv(
        path,
        schema=schema,
        header=True,
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
        nullValue="NA",
        mode="FAILFAST",
    )


def log_fields(line: Column, names: list[str] = LOG_COLUMNS) -> list[Column]:
    """Fields of a line separated by runs of blanks; missing ones are null."""
    parts = F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ")
    return [F.get(parts, i).alias(name) for i, name in enumerate(names)]


def parse_log(lines: DataFrame, column: str = "value", names: list[str] = LOG_COLUMNS) -> DataFrame:
    """Text lines to named string columns; blank lines are skipped."""
    return lines.where(F.col(column).rlike(r"\S")).select(*log_fields(F.col(column), names))


def read_log(spark: SparkSession, path: str, names: list[str] = LOG_COLUMNS) -> DataFrame:
    """Headerless log file(s) with blank-separated columns."""
    return parse_log(spark.read.text(path), "value", names)


def write_csv(df: DataFrame, path: str, number_by: str | None = None) -> None:
    """CSV with header, nulls as NA; ``number_by`` adds 1-based row numbers in that key's order."""
    if number_by:
        numbered = row_index(df, number_by, "_row")
        df = numbered.select((F.col("_row") + 1).alias("row"), *df.columns)
    df.write.csv(path, header=True, nullValue="NA", mode="errorifexists")


def append_results(results: DataFrame, path: str, run: str | None = None) -> None:
    """Add rows (n, accuracy, lambda, elapsed_s) to a result table.

    With ``run`` the rows are that run's part of the table (a column of that name): writing it again, after a
    failure or by mistake, replaces that part and nothing else. A table has either runs or none.
    """
    schema = StructType.fromDDL(RESULTS)
    rows = results.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    if run is None:
        rows.write.mode("append").parquet(path)
        return
    own = rows.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    own.partitionBy("run").parquet(path)


def read_results(spark: SparkSession, path: str, runs: bool = False) -> DataFrame:
    """A result table; ``runs`` says whether it was written by run."""
    return spark.read.schema(f"{RESULTS}, run string" if runs else RESULTS).parquet(path)
