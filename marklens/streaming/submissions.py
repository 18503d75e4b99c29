"""Row rules on a stream of submissions.

The rules a row can break by itself need no state, so ``stage`` only parses and
sorts rows out. Key rules need the stored table: ``append_stream`` adds each batch of
the stream to a table in versions, which also remembers the batches it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from marklens.operators import ingest
from marklens.sources.records import header_schema
from marklens.spec import DEFAULT_SPEC, INGEST_ORDER, REJECT_REASON, ScorecardSpec

VERDICT = "verdict"
ACCEPTED, REFUSED = "accepted", "refused"


def read_stream(
    spark: SparkSession,
    path: str,
    spec: ScorecardSpec = DEFAULT_SPEC,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Submission files that carry their own ``Ingest_Order`` column.

    Columns are found by the header of the files that are there at the start; a
    file with another header stops the stream. ``files_per_batch`` bounds a batch.
    """
    schema = header_schema(spark, path, {INGEST_ORDER: T.LongType()})
    if not len(schema):
        schema = spec.submission_schema.add(INGEST_ORDER, "long")
    reader = spark.readStream.option("header", True).option("escape", '"')
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def append_stream(
    submissions: DataFrame,
    path: str,
    checkpoint: str,
    stream: str,
    spec: ScorecardSpec = DEFAULT_SPEC,
) -> StreamingQuery:
    """Add what is there now to the table in versions at ``path``, by all rules.

    A batch that is run again, as after a failure between its commit and the stream's
    own note of it, finds its number in the table and adds nothing. ``stream`` names
    the stream in the table and belongs to its checkpoint.
    """

    def add(batch: DataFrame, number: int) -> None:
        ingest.append_committed(batch, path, spec, stream, number)

    return (
        submissions.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def check_rows(
    submissions: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """Parsed submissions with the first rule each breaks by itself."""
    fault = F.coalesce(ingest.key_fault(spec), ingest.own_fault(spec))
    return ingest.parse(submissions, spec).withColumn(REJECT_REASON, fault)


def stage(checked: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is there now, into one folder per verdict."""
    refused = F.col(REJECT_REASON).isNotNull()
    return (
        checked.withColumn(VERDICT, F.when(refused, REFUSED).otherwise(ACCEPTED))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(VERDICT)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
