"""The record table as a directory of CSV files with header lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marklens.functions.scoring import cleaned
from marklens.spec import (
    AVERAGE,
    DEFAULT_SPEC,
    GRADE,
    INGEST_ORDER,
    STATUS,
    ScorecardSpec,
)

CORRUPT_RECORD = "_corrupt_record"

# A quote inside a quoted value is doubled, on reading and on writing. Files whose
# header differs from the first one's are refused.
_CSV = {"header": True, "escape": '"', "encoding": "UTF-8"}
_READ = _CSV | {"enforceSchema": False}


def header_schema(
    spark: SparkSession, path: str, types: dict[str, T.DataType]
) -> T.StructType:
    """Fields in the order of the first file's header; a name not known is text."""
    names = spark.read.options(**_CSV).csv(path).columns
    return T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])


def read_records(
    spark: SparkSession,
    path: str,
    spec: ScorecardSpec = DEFAULT_SPEC,
    keep_corrupt: bool = False,
    storage: str = "csv",
) -> DataFrame:
    """Read stored records with the known schema, without an inference pass.

    Columns are found by name; one that is absent reads as null, as does a value
    that does not fit its type, or NaN. ``keep_corrupt`` adds the raw line of such
    rows in ``_corrupt_record``. ``storage`` names another file format, of which
    a columnar one spares reading all columns for the keys.
    """
    if storage != "csv":
        found = spark.read.format(storage).load(path)
    else:
        schema = header_schema(spark, path, {f.name: f.dataType for f in spec.schema})
        if keep_corrupt:
            schema = T.StructType([*schema, T.StructField(CORRUPT_RECORD, T.StringType())])
        reader = spark.read.options(**_READ).option("mode", "PERMISSIVE")
        found = reader.option("columnNameOfCorruptRecord", CORRUPT_RECORD).schema(schema).csv(path)
    columns = [
        F.col(f.name) if f.name in found.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spec.schema
    ]
    corrupt = [CORRUPT_RECORD] if keep_corrupt and storage == "csv" else []
    return cleaned(found.select(*columns, *corrupt), spec)


def read_submissions(
    spark: SparkSession, path: str, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """Read incoming records as text, with the order they arrived in.

    A column ``Ingest_Order`` of the files gives the order. Otherwise it is text
    made of the file's time, its name and the place in the file, which sorts as
    the records arrived, however the files are split.
    """
    schema = header_schema(spark, path, {INGEST_ORDER: T.LongType()})
    df = spark.read.options(**_READ).schema(schema).csv(path)
    if INGEST_ORDER in df.columns:
        return df
    # The row's number within its task; tasks read a block of a file in order.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    order = F.concat_ws(
        "|",
        F.lpad(F.unix_millis("_metadata.file_modification_time").cast("string"), 15, "0"),
        "_metadata.file_path",
        F.lpad(F.col("_metadata.file_block_start").cast("string"), 19, "0"),
        F.lpad(row.cast("string"), 10, "0"),
    )
    return df.withColumn(INGEST_ORDER, order)


def create_empty(
    spark: SparkSession, path: str, spec: ScorecardSpec = DEFAULT_SPEC, storage: str = "csv"
) -> None:
    """Create the table, in CSV with its header line, unless it is there already."""
    empty = spark.createDataFrame([], spec.schema)
    _save(empty, path, "ignore", storage)


def append(
    df: DataFrame, path: str, spec: ScorecardSpec = DEFAULT_SPEC, storage: str = "csv"
) -> None:
    """Add rows in the stored column order; existing files are left alone."""
    _save(df.select(*spec.columns), path, "append", storage)


def _save(df: DataFrame, path: str, mode: str, storage: str) -> None:
    options = _CSV if storage == "csv" else {}
    df.write.mode(mode).options(**options).format(storage).save(path)


def export(scored: DataFrame, path: str, spec: ScorecardSpec = DEFAULT_SPEC) -> None:
    """Write scored records, all columns, in the order they have."""
    columns = [*spec.columns, AVERAGE, GRADE, STATUS]
    scored.select(*columns).write.mode("errorifexists").options(**_CSV).csv(path)


def has_rows(df: DataFrame) -> bool:
    """Whether there is any row; stops at the first one."""
    return not df.isEmpty()
