"""Transaction lines from CSV files, and the records of such files that are no lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage import schema as S


CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class ReadResult:
    """Lines that fit the declared types, and the records that do not, as they stand in the file."""

    lines: DataFrame
    corrupt: DataFrame

    def counts(self) -> DataFrame:
        """One row: records read, lines among them, corrupt records."""
        lines, corrupt = (df.agg(F.count("*").alias("n")) for df in (self.lines, self.corrupt))
        counted = lines.select(F.col("n").alias("line_count"), corrupt.scalar().alias("corrupt_count"))
        return counted.select((F.col("line_count") + F.col("corrupt_count")).alias("record_count"), "line_count", "corrupt_count")


def _header(spark: SparkSession, path: str) -> list[str]:
    header = spark.read.option("header", True).csv(path).columns
    missing = [name for name in S.REQUIRED_COLUMNS if name not in header]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return header


def _declared(spark: SparkSession, path: str, header: list[str], corrupt: bool) -> DataFrame:
    # Ids arrive as text, because exports often hold 17850.0 where 17850 is meant.
    declared = S.TRANSACTION_TYPES | {"CustomerID": T.StringType()}
    fields = [T.StructField(name, declared.get(name, T.StringType())) for name in header]
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")
    records = reader.schema(T.StructType(fields)).csv(path)
    # Always true, but it names every column: a reader that is asked for some of them parses no
    # others, and would not notice that these are corrupt.
    return records.where(F.hash(*records.columns) >= -(2**31)) if corrupt else records


def _whole_ids(lines: DataFrame, customer_type: str) -> DataFrame:
    if customer_type == "string":
        return lines
    number = F.col("CustomerID").cast("decimal(38,6)")
    # An id with a fraction names nobody: its lines count as those of unknown customers.
    whole = F.when(number == F.floor(number), number.cast("bigint"))
    customer = F.coalesce(F.col("CustomerID").try_cast("bigint"), whole)
    return lines.withColumn("CustomerID", customer)


def read_checked(spark: SparkSession, path: str, *, customer_type: str = "bigint") -> ReadResult:
    """As `read_transactions`, with records that do not fit the declared types kept apart.

    A record is corrupt if a number or, unless ids are text, an id cannot be read, or if it has more
    or fewer cells than the header. An empty cell is a null, and dates are text, so neither makes a
    record corrupt.
    """
    header = _header(spark, path)
    records = _declared(spark, path, header, corrupt=True)
    names = [name for name in S.TRANSACTION_TYPES if name in header]
    if customer_type != "string":
        unread = F.col("CustomerID").isNotNull() & F.col("CustomerID").try_cast("decimal(38,6)").isNull()
        written = F.when(unread, F.to_csv(F.struct(*header)))
        records = records.withColumn(CORRUPT, F.coalesce(CORRUPT, written))
    lines = records.where(F.col(CORRUPT).isNull()).select(*names)
    return ReadResult(
        lines=_whole_ids(lines, customer_type),
        corrupt=records.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record")),
    )


def read_transactions(
    spark: SparkSession,
    path: str,
    *,
    infer: bool = False,
    customer_type: str = "bigint",
) -> DataFrame:
    """Read CSV files with a header row.

    Columns are found by header name, in any order, among any others. Types are declared,
    which saves the extra pass of inference; `infer=True` asks Spark to infer them all.
    `customer_type="string"` keeps customer ids that are not numbers.
    """
    header = _header(spark, path)
    if infer:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    lines = _declared(spark, path, header, corrupt=False)
    return _whole_ids(lines.select(*(name for name in S.TRANSACTION_TYPES if name in header)), customer_type)
