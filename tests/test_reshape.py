"""JSON explosion (text and robust), entries, inference, struct projection, cells round trip."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.json import infer_object_schema
from lakeloom.operators import kv, reshape
from lakeloom.schemas import CONTACT


def test_explode_json_text_edges(spark):
    rows = [(1, '[{"name":"a","phone":"1"},{"name":"b","phone":"2"}]'), (2, "[]"), (3, None),
            (4, '[{"a":[1,2]},{"a":3}]'), (5, '[{"n":"x"}, {"n":"y"}]')]
    df = spark.createDataFrame(rows, "user_id int, contacts string")
    got = sorted((r.user_id, r.element) for r in
                 reshape.explode_json_text(df, ["user_id"], "contacts").collect())
    assert got == sorted([(1, '{"name":"a","phone":"1"}'), (1, '{"name":"b","phone":"2"}'),
                          (4, '{"a":[1,2]}'), (4, '{"a":3}'), (5, '{"n":"x"}'), (5, '{"n":"y"}')])


def test_json_cells(spark):
    rows = [(300_000_001, '{"name":"a","age":3,"gone":null}'), (300_000_002, '{"name":"b","tags":[1,2]}'),
            (3, "[]"), (4, None)]
    df = spark.createDataFrame(rows, "id bigint, doc string")
    from lakeloom.plans.derived import row_key
    got = sorted(tuple(r) for r in reshape.json_cells(df, row_key("id"), "doc", "f").collect())
    key = "00000000000300000001"
    other = "00000000000300000002"  # keys beyond 10^8 stay apart
    assert got == [(key, "f", "age", 0, "3"), (key, "f", "name", 0, "a"),
                   (other, "f", "name", 0, "b"), (other, "f", "tags", 0, "[1,2]")]


def test_explode_json_array_and_columns(spark):
    df = spark.createDataFrame([(1, '[{"name":"a","phone":"1"},{"name":"b"}]'), (2, None)],
                               "user_id int, contacts string")
    out = reshape.explode_json_array(df, ["user_id"], "contacts", CONTACT)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "1"), (1, "b", None)]
    el = reshape.explode_json_text(df, ["user_id"], "contacts")
    cols = reshape.elements_to_columns(el, ["user_id"], "element", CONTACT, "contacts")
    assert cols.columns == ["user_id", "contacts_name", "contacts_phone"]


def test_json_entries_and_malformed(spark):
    df = spark.createDataFrame([('{"name":"n","phone":"p","age":3}',), ("not json",)], "j string")
    got = sorted(tuple(r) for r in reshape.json_entries(df, [], "j", drop=["phone"]).collect())
    assert got == [("age", "3"), ("name", "n")]
    parsed = df.select(F.from_json("j", "name string").alias("s")).collect()
    assert parsed[1].s is None or parsed[1].s.name is None


def test_infer_object_schema(spark):
    df = spark.createDataFrame([('{"k": 1, "f": 1.5, "b": true, "z": null}',),
                                ('{"k": 2, "s": "x", "f": 2}',)], "j string")
    sch = infer_object_schema(df, "j")
    assert [(f.name, f.dataType) for f in sch.fields] == [
        ("b", T.BooleanType()), ("f", T.DoubleType()), ("k", T.LongType()), ("s", T.StringType()),
        ("z", T.StringType())]
    out = reshape.infer_and_parse(df, [], "j").collect()
    assert out[1].s == "x" and out[0].s is None


def test_json_tuple_takes_names(spark):
    df = spark.createDataFrame([('{"name":"n","phone":"p"}',)], "j string")
    r = df.select(F.json_tuple("j", "name", "$.phone")).first()
    assert tuple(r) == ("n", None)


def test_array_struct_project(spark):
    df = spark.createDataFrame([([("a", "b", "c", "d", 1, "f")],)],
                               "arr array<struct<c0:string,c1:string,c2:string,c3:string,c4:int,c5:string>>")
    r = df.select(reshape.array_struct_project(F.col("arr"), ["c2", "c4"]).alias("x")).first()
    assert [tuple(e) for e in r.x] == [("c", 1)]


def test_cast_all_to_string_dotted_names(spark):
    from lakeloom.operators.relational import cast_all_to_string
    df = spark.createDataFrame([(1, 2.5)], "`a.b` int, c double")
    out = cast_all_to_string(df)
    assert out.columns == ["a.b", "c"] and tuple(out.first()) == ("1", "2.5")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.text("abc", max_size=3),
                          st.one_of(st.none(), st.integers(-5, 5))), max_size=12,
                unique_by=lambda t: t[0]))
def test_cells_rows_round_trip(spark, rows):
    schema = "k int, name string, age int"
    df = spark.createDataFrame(rows, schema)
    cells = reshape.unpivot_cells(df, F.lpad(F.col("k").cast("string"), 5, "0"), "cf",
                                  ["name", "age"])
    back = kv.cells_to_rows(cells, "cf", ["name", "age"], {"age": "int"})
    want = {(f"{k:05d}", n, a) for k, n, a in rows if n is not None or a is not None}
    assert {tuple(r) for r in back.collect()} == want


def test_inference_keeps_quoted_numbers_as_strings(spark):
    df = spark.createDataFrame([('{"id":"007","flag":"True","n":{"a":1}}',), ("{'id':'8'}",)],
                               "j string")
    out = reshape.infer_and_parse(df, [], "j")
    assert out.schema.simpleString() == "struct<flag:string,id:string,n:struct<a:bigint>>"
    assert sorted(r.id for r in out.collect()) == ["007", "8"]


def test_single_quoted_values_keep_their_types(spark):
    df = spark.createDataFrame([('{"a":true}',), ("{'a':'TRUE','b':'12'}",)], "j string")
    from lakeloom.functions.json import infer_object_schema
    assert infer_object_schema(df, "j").simpleString() == "struct<a:string,b:string>"
