"""Redacting a stream of JSON lines."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from veilframe.operators.lexicon import NameLexicon
from veilframe.operators.redaction import redact
from veilframe.sources.corpus import required

#: The folder that says which batches are finished; Spark reads no folder of such a name as data.
COMMITS = "_commits"


def read_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON lines as they arrive in a folder; a malformed line or a missing field stops the stream."""
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return required(reader.json(path))


def write_available(
    stream: DataFrame, column: str, lexicon: NameLexicon, path: str, checkpoint: str
) -> StreamingQuery:
    """Redact what is there and stop; a restart goes on after the last finished batch.

    Each batch is redacted like a table, with a dictionary of any size, and written to a folder of
    its own below ``path``.  Once it is complete a file in ``path/_commits``, created in one
    step and named by the batch, names that folder.  A batch that is run again, since the stream
    broke off before its checkpoint, finds the file and writes nothing; one that broke off
    in its writing has no file, so nobody reads what it left.
    """

    own: list[NameLexicon] = []  # the batches of a run share a session, which is not that of the caller

    def write(batch: DataFrame, batch_id: int) -> None:
        session, commit = batch.sparkSession, f"{path}/{COMMITS}/{batch_id}"
        if _exists(session, commit):
            return
        if not own:
            own.append(lexicon.in_session(session))
        folder = f"batch-{batch_id}-{uuid.uuid4().hex}"
        redact(batch, column, own[0]).write.parquet(f"{path}/{folder}")
        _create(session, commit, folder)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def committed(spark: SparkSession, path: str) -> list[str]:
    """The folders of all finished batches, in the order of the batches; a short name for each batch comes to the driver."""
    if not _exists(spark, f"{path}/{COMMITS}"):
        return []
    lines = spark.read.text(f"{path}/{COMMITS}").filter("value <> ''").collect()
    return [f"{path}/{r.value}" for r in sorted(lines, key=lambda r: int(r.value.split("-")[1]))]


def read_redacted(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all finished batches, each once."""
    folders = committed(spark, path)
    if not folders:
        raise ValueError(f"no finished batch in {path}")
    return spark.read.parquet(*folders)


def _file(spark: SparkSession, path: str):
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return file, file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    file, system = _file(spark, path)
    return system.exists(file)


def _create(spark: SparkSession, path: str, text: str) -> None:
    """Create a file that must not be there yet."""
    file, system = _file(spark, path)
    out = system.create(file, False)
    out.write(bytearray(f"{text}\n".encode()))
    out.close()
