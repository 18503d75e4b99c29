"""A record table in versions, with atomic commits and key ranges per file.

A version is a small file that names the data folders of the table. It is written
once under its number and never replaced: of two writers that add the same version
one succeeds, and the other learns that it must look again. Folders that no version
names are not part of the table, so a writer that is lost leaves nothing to be read.

Data files are sorted by key. Each folder has a table of the smallest and largest
key per file beside it, so that a lookup opens only the files that can hold the key;
inside them the row groups' own statistics and Bloom filters go on.

The file system must offer an atomic rename that refuses to replace, as HDFS does, or
be the local one of a local session. An object store without that needs another
place for the version files.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marklens.spec import DEFAULT_SPEC, ScorecardSpec

_VERSIONS = "_versions"


@dataclass(frozen=True)
class Version:
    """number: 0 for the empty table; folders: data folders, oldest first; batches:
    the last batch that each stream has added."""

    number: int = 0
    folders: tuple[str, ...] = ()
    batches: dict[str, int] = field(default_factory=dict)

    def after(self, folder: str, stream: str | None, batch: int | None) -> Version:
        added = {} if stream is None else {stream: batch}
        return Version(self.number + 1, (*self.folders, folder), self.batches | added)

    def has(self, stream: str | None, batch: int | None) -> bool:
        return stream is not None and self.batches.get(stream, -1) >= batch


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, text: str) -> None:
    place, files = _at(spark, path)
    out = files.create(place, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file under a name that must be free, whole or not at all."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    _put(spark, draft, text)
    place, files = _at(spark, path)
    start, _ = _at(spark, draft)
    try:
        if files.getUri().getScheme() == "file":
            os.link(start.toUri().getPath(), place.toUri().getPath())
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                files.getUri(), spark._jsc.hadoopConfiguration()
            )
            # No option: the name must be free.
            options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(start, place, options)
    except FileExistsError:
        return False
    except Py4JJavaError as refused:
        if "FileAlreadyExistsException" in str(refused.java_exception.getClass()):
            return False
        raise
    finally:
        files.delete(start, False)
    return True


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _at(spark, path)
    return files.exists(place)


def read_text(spark: SparkSession, path: str) -> str:
    place, files = _at(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def latest(spark: SparkSession, path: str) -> Version:
    place, files = _at(spark, f"{path}/{_VERSIONS}")
    if not files.exists(place):
        return Version()
    names = [status.getPath().getName() for status in files.listStatus(place)]
    numbers = sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"[0-9]+\.json", n))
    return version(spark, path, numbers[-1]) if numbers else Version()


def _file(path: str, number: int) -> str:
    return f"{path}/{_VERSIONS}/{number:020d}.json"


def version(spark: SparkSession, path: str, number: int) -> Version:
    if number == 0:
        return Version()
    found = json.loads(read_text(spark, _file(path, number)))
    return Version(number, tuple(found["folders"]), found["batches"])


def commit(spark: SparkSession, path: str, new: Version) -> bool:
    """Add a version; False when another writer has added it already."""
    text = json.dumps({"folders": new.folders, "batches": new.batches})
    return create_new(spark, _file(path, new.number), text)


def write_folder(df: DataFrame, path: str, spec: ScorecardSpec = DEFAULT_SPEC) -> str:
    """Write records sorted by key into a folder that belongs to no version yet."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    rows = df.select(*spec.columns).repartitionByRange(spec.key).sortWithinPartitions(spec.key)
    writer = rows.write.option(f"parquet.bloom.filter.enabled#{spec.key}", "true")
    writer.parquet(f"{path}/data-{name}")
    written = spark.read.schema(spec.schema).parquet(f"{path}/data-{name}")
    ranges = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(spec.key).alias("low"), F.max(spec.key).alias("high"), F.count("*").alias("records")
    )
    ranges.coalesce(1).write.parquet(f"{path}/ranges-{name}")
    return name


def drop_folder(spark: SparkSession, path: str, name: str) -> None:
    """Remove a folder of one's own that belongs to no version."""
    for kind in ("data", "ranges"):
        place, files = _at(spark, f"{path}/{kind}-{name}")
        files.delete(place, True)


def read_folders(
    spark: SparkSession, path: str, folders: tuple[str, ...], spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], spec.schema)
    return spark.read.schema(spec.schema).parquet(*[f"{path}/data-{name}" for name in folders])


def read(
    spark: SparkSession, path: str, spec: ScorecardSpec = DEFAULT_SPEC, number: int | None = None
) -> DataFrame:
    """The table as of a version, the latest by default."""
    found = latest(spark, path) if number is None else version(spark, path, number)
    return read_folders(spark, path, found.folders, spec)


def file_ranges(spark: SparkSession, path: str, found: Version | None = None) -> DataFrame:
    """Smallest and largest key and the records of each file."""
    found = found or latest(spark, path)
    schema = "file string, low bigint, high bigint, records bigint"
    if not found.folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/ranges-{name}" for name in found.folders])


def read_range(
    spark: SparkSession, path: str, low: int, high: int, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """Records with keys from low to high; files without such keys are not opened.

    The driver gets the names of the files that are.
    """
    touching = (F.col("low") <= high) & (F.col("high") >= low)
    files = [row["file"] for row in file_ranges(spark, path).filter(touching).select("file").collect()]
    if not files:
        return spark.createDataFrame([], spec.schema)
    found = spark.read.schema(spec.schema).parquet(*sorted(files))
    return found.filter(F.col(spec.key).between(low, high))
