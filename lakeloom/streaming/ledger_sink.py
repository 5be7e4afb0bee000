"""A streaming sink that commits offsets and payloads itself.

Every task reduces its rows to the newest record of each (topic, partition) and
returns it as its commit message. The driver merges the messages of a batch,
one entry per partition and task, into one file, written aside and moved into
place: a batch is in the ledger whole or not at all. A failed batch leaves
nothing; one that is run again replaces its own file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.sources.files import path_kind

FORMAT = "offset_ledger"
LEDGER = "batch_id bigint, topic string, partition int, until_offset bigint, data string"


def _source():
    # Defined here so that the classes travel with the plan; workers need no copy of this package.
    import json
    from dataclasses import dataclass

    import pyarrow as pa
    from pyarrow import fs
    from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

    def place(path):
        if ":/" in path:
            return fs.FileSystem.from_uri(path)
        return fs.LocalFileSystem(), path

    @dataclass
    class Newest(WriterCommitMessage):
        entries: list

    class Writer(DataSourceStreamArrowWriter):
        def __init__(self, path):
            self.path = path

        def write(self, iterator):
            best = {}
            for batch in iterator:
                own = pa.table({c: batch.column(c) for c in ("topic", "partition", "offset")})
                top = own.group_by(["topic", "partition"]).aggregate([("offset", "max")]).to_pylist()
                wanted = {(r["topic"], r["partition"]): r["offset_max"] for r in top if r["offset_max"] is not None}
                rows = zip(own["topic"].to_pylist(), own["partition"].to_pylist(), own["offset"].to_pylist())
                for i, (topic, part, offset) in enumerate(rows):
                    key = (topic, part)
                    if offset is not None and wanted.get(key) == offset and offset >= best.get(key, (-1,))[0]:
                        best[key] = offset, batch.column("data")[i].as_py()
            return Newest([(t, p, o, d) for (t, p), (o, d) in best.items()])

        def commit(self, messages, batchId):
            best = {}
            for m in messages:
                for topic, part, offset, data in (m.entries if m is not None else ()):
                    if offset >= best.get((topic, part), (-1,))[0]:
                        best[topic, part] = offset, data
            if not best:
                return  # an empty batch leaves no entry
            where, path = place(self.path)
            where.create_dir(path, recursive=True)
            aside = f"{path}/.batch-{batchId}"
            with where.open_output_stream(aside) as out:
                for (topic, part), (offset, data) in best.items():
                    out.write(json.dumps({"batch_id": batchId, "topic": topic, "partition": part,
                                          "until_offset": offset + 1, "data": data}).encode() + b"\n")
            where.move(aside, f"{path}/batch-{batchId}.json")

        def abort(self, messages, batchId):
            where, path = place(self.path)
            if where.get_file_info(f"{path}/.batch-{batchId}").type != fs.FileType.NotFound:
                where.delete_file(f"{path}/.batch-{batchId}")

    class Ledger(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def schema(self):
            return "topic string, partition int, offset bigint, data string"

        def streamWriter(self, schema, overwrite):
            return Writer(self.options["path"])

    return Ledger


def register(spark: SparkSession) -> None:
    spark.dataSource.register(_source())


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The committed entries, one per batch and partition; no row before the first commit."""
    if path_kind(spark, path) is None:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).json(path)
