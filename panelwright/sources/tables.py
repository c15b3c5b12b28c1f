"""Readers and writers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import existing
from ..functions.scalars import NUMBER_TEXT, missing_if_nan, to_number
from ..operators.aggregates import extent

LATIN1 = "ISO-8859-1"
ORDINAL = "_ord"

# Cell texts that mean "missing" in a CSV file.
MISSING_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _open(name: str, path: str, read) -> DataFrame:
    """A missing input is reported under its table name."""
    try:
        return read(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem):
            raise FileNotFoundError(f"{name} not found at: {path}") from problem
        raise


def read_text_table(
    spark: SparkSession,
    name: str,
    path: str,
    encoding: str = "UTF-8",
    schema: str | None = None,
    by_position: Sequence[str] | None = None,
    ordinal: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header row.

    ``multi_line`` reads cells with line breaks; such a file is one split.

    Without a schema every column is text, to be coerced where it is used; no
    pass over the data is spent on guessing types. ``by_position`` renames the
    leading columns, whatever the header says. ``ordinal`` adds the row's place
    in the input (file, block, row), which "first in file" needs (T7).
    """
    reader = spark.read.option("header", True).option("encoding", encoding).option("escape", '"')
    reader = reader.option("multiLine", multi_line)
    if schema:
        reader = reader.schema(schema)
    df = _open(name, path, reader.csv)
    named = list(df.columns)
    if by_position:
        named[: len(by_position)] = by_position
    cells = []
    for field, alias in zip(df.schema.fields, named):
        cell = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            cell = F.when(~cell.isin(*MISSING_TEXT), cell)
        cells.append(cell.alias(alias))
    if ordinal:
        cells.append(F.struct(
            "_metadata.file_path", "_metadata.file_block_start",
            F.monotonically_increasing_id().alias("row")).alias(ORDINAL))
    return df.select(*cells)


def type_numbers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns that hold only numbers become doubles.

    Without ``columns`` one pass over all text columns decides, as reading types
    from the whole file would; a given list costs no pass.
    """
    if columns is None:
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        seen = df.agg(*[F.bool_and(F.col(c).rlike(NUMBER_TEXT)).alias(c) for c in text]).first()
        columns = [c for c in text if seen[c] is not False]
    return df.withColumns({c: to_number(c) for c in columns})


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Reload of a processed table."""
    return _open(name, path, spark.read.parquet)


def read_grid(
    spark: SparkSession, name: str, path: str, value: str = "lwe_thickness", side: str = "uncertainty"
) -> DataFrame:
    """S3: gridded measurements in long form; the side variable is optional."""
    grid = read_table(spark, name, path)
    measures = existing(grid, [value, side])
    return grid.select("time", "lat", "lon", *[missing_if_nan(F.col(m).cast("double")).alias(m) for m in measures])


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Overwrite as Parquet, optionally one folder per partition value.

    Rows are first rebalanced by the partition columns, which keeps files few and
    splits the partitions of a value that holds much of the data.
    """
    writer = df
    if partition_by:
        writer = df.hint("rebalance", *[F.col(c) for c in partition_by])
    out = writer.write.mode("overwrite")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)
    return path


def store_panel(
    df: DataFrame, name: str, path: str, entity: Sequence[str], time: str, buckets: int, partition_by: Sequence[str] = (),
) -> DataFrame:
    """Overwrite table ``name`` at ``path``, bucketed by entity and sorted by time, a folder per partition value.

    Queries that group, order or join by entity read such a table without an exchange; filters on the partition
    columns skip folders. Choose ``buckets`` so that a bucket suits a task: it is one task's share for as long as the
    table lives, and all rows of an entity are in one.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    out = df.repartition(buckets, *entity).write.mode("overwrite").option("path", path)
    out = out.bucketBy(buckets, *entity).sortBy(*entity, time)
    (out.partitionBy(*partition_by) if partition_by else out).saveAsTable(name)
    return spark.table(name)


def attach_panel(
    spark: SparkSession, name: str, path: str, entity: Sequence[str], time: str, buckets: int, partition_by: Sequence[str] = (),
) -> DataFrame:
    """A panel stored before, in a session whose catalog does not know it; the layout is the one it was stored with."""
    schema = read_table(spark, name, path).schema
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    cells = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    listed = lambda names: ", ".join(f"`{c}`" for c in names)
    spark.sql(
        f"CREATE TABLE `{name}` ({cells}) USING parquet "
        + (f"PARTITIONED BY ({listed(partition_by)}) " if partition_by else "")
        + f"CLUSTERED BY ({listed(entity)}) SORTED BY ({listed([*entity, time])}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE `{name}`")
    return spark.table(name)


def export_text(df: DataFrame, path: str, encoding: str = "UTF-8") -> str:
    """Overwrite as CSV files with a header row."""
    df.write.mode("overwrite").option("header", True).option("encoding", encoding).option("escape", '"').csv(path)
    return path


def run_record(
    panel: DataFrame,
    classification: dict[str, dict[str, float]],
    regression: dict[str, dict[str, float]],
    entity: str = "country_code",
    time: str = "date",
    at: datetime | None = None,
) -> DataFrame:
    """One row with table counts and the scores of every model."""
    seen = extent(panel, entity, time)

    def scores(found: dict[str, dict[str, float]], names: Sequence[str]):
        kind = "map<string,struct<" + ",".join(f"{n}:double" for n in names) + ">>"
        if not found:
            return F.create_map().cast(kind)
        parts = []
        for model, values in found.items():
            parts += [F.lit(model), F.struct(*[F.lit(float(values[n])).alias(n) for n in names])]
        return F.create_map(*parts).cast(kind)

    return seen.select(
        F.lit((at or datetime.now()).isoformat()).alias("timestamp"),
        F.col("rows").alias("data_rows"),
        F.col("columns").alias("data_columns"),
        F.col("entities").alias("countries"),
        F.concat_ws(" to ", F.col("first_time").cast("string"), F.col("last_time").cast("string")).alias("date_range"),
        scores(classification, ["f1_weighted", "accuracy"]).alias("classification"),
        scores(regression, ["RMSE", "MAE", "R2"]).alias("regression"),
    )


def append_run(record: DataFrame, path: str) -> None:
    """Append the record as one JSON line."""
    record.write.mode("append").json(path)
