"""File round trips, catalog operations, observed metrics, JDBC predicates, presets, workbooks."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from lakeloom.sources import catalog, files, jdbc, presets
from lakeloom.sources.workbooks import parse_workbook, read_workbooks
from tests.conftest import SF001


def events(spark):
    return spark.read.parquet(f"{SF001}/events.parquet")


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
def test_round_trips_are_exact(spark, tmp, fmt):
    ev = events(spark)
    files.write(ev, f"{tmp}/x", fmt)
    back = files.read(spark, f"{tmp}/x", fmt, ev.schema if fmt in ("csv", "json") else None)
    assert back.exceptAll(ev).count() == 0 and ev.exceptAll(back).count() == 0


def test_text_round_trip_single_file(spark, tmp):
    df = spark.createDataFrame([("a b",), ("c",)], "value string")
    files.write_text(df, f"{tmp}/t", single_file=True)
    assert len([p for p in __import__("os").listdir(f"{tmp}/t") if p.startswith("part-")]) == 1
    assert sorted(r.value for r in files.read_text(spark, f"{tmp}/t", 3).collect()) == ["a b", "c"]


def test_catalog_ops(spark, tmp):
    name = "t_catalog_ops"
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, data_type string")
    catalog.append_partitioned(df, name, ["data_type"], f"{tmp}/tbl")
    catalog.append_partitioned(df, name, ["data_type"], f"{tmp}/tbl")
    assert catalog.exists(spark, name) and name in catalog.list_tables(spark)
    catalog.refresh(spark, name)
    q = catalog.scan(spark, name).where("data_type = 'x'")
    assert q.count() == 2
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "data_type" in plan
    catalog.create_table(spark, "t_ddl", "id int, v string", f"{tmp}/ddl")
    assert catalog.exists(spark, "t_ddl")


def test_empty_relation_needs_schema(spark):
    from lakeloom.operators.relational import empty_with_schema, union_many
    e = empty_with_schema(spark, "id bigint")
    assert union_many([e, spark.range(3)]).count() == 3


def test_observed_metrics(spark):
    from pyspark.sql import Observation
    obs = Observation("acc")
    df = spark.range(10).observe(obs, F.sum("id").alias("total"), F.count(F.lit(1)).alias("n"))
    df.collect()
    assert obs.get == {"total": 45, "n": 10}


def test_jdbc_predicates_cover_every_row():
    preds = jdbc.half_open_ranges("created_at", ["'2018-01-01'", "'2018-06-01'"])
    assert preds == ["created_at < '2018-01-01'",
                     "created_at >= '2018-01-01' AND created_at < '2018-06-01'",
                     "created_at >= '2018-06-01'", "created_at IS NULL"]
    props = jdbc.properties("u", "p", driver="mysql")
    assert props == {"user": "u", "password": "p", "driver": "com.mysql.cj.jdbc.Driver"}


def test_presets_configure_without_loading(spark):
    r = presets.mongo_reader(spark, "mongodb://h", "db", "coll")
    assert r is not None
    with pytest.raises(Exception):
        presets.avro_reader(spark).load("/nonexistent")  # spark-avro jar absent here


def _xlsx(rows):
    """Minimal workbook: shared strings, inline strings and numbers."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    shared = sorted({v for r in rows for v in r if isinstance(v, str)})
    cells = []
    for i, r in enumerate(rows, 1):
        cs = []
        for j, v in enumerate(r):
            ref = f"{chr(65 + 2 * j)}{i}"  # skip a column to test gaps
            if v is None:
                continue
            if isinstance(v, str):
                cs.append(f'<c r="{ref}" t="s"><v>{shared.index(v)}</v></c>')
            else:
                cs.append(f'<c r="{ref}"><v>{v}</v></c>')
        cells.append(f'<row r="{i}">{"".join(cs)}</row>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} {rns}><sheets><sheet name="S1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml" Type="x"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}>' + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData>{"".join(cells)}</sheetData></worksheet>')
    return buf.getvalue()


def test_workbooks_directory(spark, tmp):
    data = _xlsx([["name", "age"], ["zhangsan", 10], ["lisi", None]])
    assert list(parse_workbook(data))[1] == ("S1", 2, ["zhangsan", None, "10"])
    for i in range(3):
        with open(f"{tmp}/b{i}.xlsx", "wb") as f:
            f.write(data)
    df = read_workbooks(spark, tmp)
    assert df.count() == 9
    assert df.where("row_no = 3").select("cells").first().cells == ["lisi"]


def test_kafka_source_options():
    from lakeloom.streaming.sources import kafka_source_options
    o = kafka_source_options("b:9092", topic="app_logs", group_id="g", maxOffsetsPerTrigger="100")
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "app_logs",
                 "startingOffsets": "latest", "kafka.group.id": "g", "maxOffsetsPerTrigger": "100"}
    a = kafka_source_options("b:9092", assign_json='{"t":{"1":5,"0":3}}')
    assert a["assign"] == '{"t": [0, 1]}' and a["startingOffsets"] == '{"t":{"1":5,"0":3}}'


def test_save_table_errors_if_exists(spark, tmp):
    df = spark.createDataFrame([(1,)], "id int")
    catalog.save_table(df, "t_once", location=f"{tmp}/t_once")
    with pytest.raises(Exception):
        catalog.save_table(df, "t_once", location=f"{tmp}/t_once2")
    catalog.save_table(df, "t_once", mode="overwrite", location=f"{tmp}/t_once")
    assert catalog.scan(spark, "t_once").count() == 1
