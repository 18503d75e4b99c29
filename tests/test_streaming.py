from pyspark.sql import functions as F

from marklens.operators import ingest
from marklens.sources import records as store
from marklens.streaming import submissions as stream
from samples import column, submitted


def test_staged_rows_join_the_table(spark, tmp_path):
    inbox, staged, table = (str(tmp_path / n) for n in ("inbox", "staged", "table"))

    def arrive(rows):
        submitted(spark, rows).write.mode("append").option("header", True).option("escape", '"').csv(inbox)
        checked = stream.check_rows(stream.read_stream(spark, inbox))
        stream.stage(checked, staged, str(tmp_path / "checkpoint")).awaitTermination()

    arrive([{"Student_ID": "1"}, {"Student_ID": "x"}, {"Student_ID": "2", "Math": "101"}])
    arrive([{"Student_ID": "1", "Ingest_Order": 10}, {"Student_ID": "3", "Ingest_Order": 11}])

    rows = spark.read.parquet(staged)
    refused = rows.filter(F.col(stream.VERDICT) == stream.REFUSED).orderBy("Ingest_Order")
    assert column(refused, "Reject_Reason") == [ingest.NOT_A_NUMBER, "Marks must be between 0 and 100."]

    good = rows.filter(F.col(stream.VERDICT) == stream.ACCEPTED)
    ingest.append_to(good, table)
    ingest.append_to(good, table)
    stored = store.read_records(spark, table)
    assert sorted(column(stored, "Student_ID")) == [1, 3]
    assert column(stored.filter("Student_ID = 1"), "Math") == [50.0]
