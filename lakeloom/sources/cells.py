"""Cell source over region files: one partition per region, key filters drop regions.

Reads what ``operators.bulk.write`` has written. The manifest says which keys a
file holds, so comparisons of ``row_key`` with constants drop whole regions on
the driver; Spark applies the filters once more to the rows that are read. Files
are opened by the tasks with pyarrow's file systems (local, HDFS, S3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FORMAT = "cell_regions"
PUSHDOWN = {"spark.sql.python.filterPushdown.enabled": "true"}


def _source():
    # Defined here so that the classes travel with the plan; workers need no copy of this package.
    from dataclasses import dataclass

    from pyarrow import fs
    from pyspark.sql import datasource as ds

    @dataclass
    class Region(ds.InputPartition):
        file: str
        lower: str
        upper: str

    class Reader(ds.DataSourceReader):
        def __init__(self, regions):
            self.regions, self.tests = regions, []

        def pushFilters(self, filters):
            for f in filters:
                if getattr(f, "attribute", None) == ("row_key",):
                    if isinstance(f, ds.EqualTo):
                        self.tests.append(lambda a, b, v=f.value: a <= v <= b)
                    elif isinstance(f, ds.In):
                        self.tests.append(lambda a, b, vs=f.value: any(a <= v <= b for v in vs if v is not None))
                    elif isinstance(f, ds.GreaterThan):
                        self.tests.append(lambda a, b, v=f.value: b > v)
                    elif isinstance(f, ds.GreaterThanOrEqual):
                        self.tests.append(lambda a, b, v=f.value: b >= v)
                    elif isinstance(f, ds.LessThan):
                        self.tests.append(lambda a, b, v=f.value: a < v)
                    elif isinstance(f, ds.LessThanOrEqual):
                        self.tests.append(lambda a, b, v=f.value: a <= v)
                    elif isinstance(f, ds.StringStartsWith):
                        self.tests.append(lambda a, b, v=f.value: b >= v and a[:len(v)] <= v)
                yield f  # a region holds other keys as well: Spark filters its rows

        def partitions(self):
            # A scan needs a partition: without a region left, one that reads nothing.
            kept = [Region(*r) for r in self.regions if all(t(r[1], r[2]) for t in self.tests)]
            return kept or [Region("", "", "")]

        def read(self, region):
            import pyarrow.parquet as pq

            if not region.file:
                return
            where, path = fs.FileSystem.from_uri(region.file) if ":/" in region.file else (fs.LocalFileSystem(), region.file)
            with where.open_input_file(path) as f:
                for batch in pq.ParquetFile(f).iter_batches(columns=["row_key", "family", "qualifier", "version", "value"]):
                    yield batch

    class Cells(ds.DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def schema(self):
            return "row_key string, family string, qualifier string, version bigint, value string"

        def reader(self, schema):
            import json

            return Reader(json.loads(self.options["regions"]))

    return Cells


def regions(spark: SparkSession, path: str) -> DataFrame:
    """The cells under ``path`` as a source of one partition per region. The
    manifest, a row for each file, comes to the driver."""
    import json

    from lakeloom.operators.bulk import MANIFEST

    spark.dataSource.register(_source())
    files = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy("region").collect()
    listed = json.dumps([[r.file, r.first_key, r.last_key] for r in files])
    return spark.read.format(FORMAT).option("regions", listed).load()
