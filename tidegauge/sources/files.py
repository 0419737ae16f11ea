"""File inputs and outputs. The readers take a SparkSession's ``read`` or ``readStream``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

REJECTED = "rejected_line"
BUCKET_FORMAT = "yyyy-MM-dd--HH"


def delimited(reader, path: str, schema: StructType, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(records, rejected lines) of delimited text with a fixed schema.

    A line that does not fit the schema goes to the second output instead of failing the job. Every
    line is parsed whole, so the same lines are rejected whatever columns are selected. A record is
    one line: a quoted field with a line break in it comes as two rejected lines.
    """
    full = StructType([*schema.fields, StructField(REJECTED, StringType())])
    options = {
        "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED,
        "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
    }
    rows = reader.text(path).where(F.trim("value") != "").select(F.from_csv("value", full.toDDL(), options).alias("row"))
    # an empty text field means "missing" and stays an empty string
    fields = [
        (F.coalesce(cell, F.lit("")) if isinstance(field.dataType, StringType) else cell).alias(field.name)
        for field, cell in ((field, F.col("row")[field.name]) for field in schema.fields)
    ]
    rejected = F.col("row")[REJECTED]
    return rows.where(rejected.isNull()).select(*fields), rows.where(rejected.isNotNull()).select(rejected.alias(REJECTED))


def _parsed(lines: DataFrame, line: str, row: Column, fits: Column) -> tuple[DataFrame, DataFrame]:
    """(records, rejected lines), both with the other columns of ``lines``, from one parse.

    ``row`` goes through a generator: a filter on its fields is not pushed below one, where the
    parse would run again.
    """
    parsed = lines.withColumn("__row", F.explode(F.array(row)))
    kept = [c for c in lines.columns if c != line]
    good = F.coalesce(fits, F.lit(False))
    return parsed.where(good).select(*kept, "__row.*"), parsed.where(~good).select(*kept, F.col(line).alias(REJECTED))


def access_log(lines: DataFrame, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """(records, rejected lines) of an access log; both keep the other columns of ``lines``.

    Records are ip, user_id, ts, method, url; the time's zone offset is honoured. A line without a
    time or a url, or a NULL one, is rejected.
    """
    part = F.split(line, " ")
    at = F.try_to_timestamp(
        F.concat_ws(" ", F.get(part, F.lit(3)), F.get(part, F.lit(4))), F.lit("dd/MM/yyyy:HH:mm:ss Z")
    )
    row = F.struct(
        F.get(part, F.lit(0)).alias("ip"), F.get(part, F.lit(1)).alias("user_id"), at.alias("ts"),
        F.get(part, F.lit(5)).alias("method"), F.get(part, F.lit(6)).alias("url"),
    )
    return _parsed(lines, line, row, F.col("__row.ts").isNotNull() & F.col("__row.url").isNotNull())


def key_value_lines(lines: DataFrame, schema: StructType, sep: str = " ", line: str = "value") -> tuple[DataFrame, DataFrame]:
    """(records, rejected lines) of separated fields; a field of another type, or a wrong number of
    them, rejects the line. Blank lines are neither."""
    part = F.split(F.trim(line), sep)
    row = F.struct(F.size(part).alias("__parts"), *[
        F.get(part, F.lit(at)).try_cast(field.dataType).alias(field.name) for at, field in enumerate(schema.fields)
    ])
    fits = F.col("__row.__parts") == len(schema.fields)
    for field in schema.fields:
        fits = fits & F.col("__row")[field.name].isNotNull()
    records, rejected = _parsed(lines.where(F.trim(line) != ""), line, row, fits)
    return records.drop("__parts"), rejected


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("sep", sep).option("emptyValue", "").csv(path)


def bucket_of(ts: Column | str) -> Column:
    """Date-hour bucket, the directory name of the bucketed outputs."""
    return F.date_format(ts, BUCKET_FORMAT)


def write_bucketed_parquet(df: DataFrame, path: str, ts: str, max_records_per_file: int = 5_000_000, ranged: bool = False) -> None:
    """Parquet in one directory per date-hour bucket.

    Rows are dealt out by ranges of time, so a task opens few buckets and a busy hour, which spans
    several ranges, is written by several tasks. Rows that are ``ranged`` lie in ranges of time already.
    """
    bucketed = df.withColumn("bucket", bucket_of(ts))
    (
        (bucketed if ranged else bucketed.repartitionByRange("bucket", ts)).write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("bucket")
        .parquet(path)
    )
