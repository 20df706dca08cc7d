import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from stratum.sources import readers
from stratum.sources.payloads import flatten, parse_and_flatten, unwrap_payloads
from stratum.sources.readers import incremental_extract, jdbc_options, read_source, register_reader
from stratum.sources.registry import SourceSpec, expand_environment, load_sources
from tests.conftest import rows


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def csv_source(path, schema=None, **options):
    return SourceSpec("s", "flat_file", path, schema=schema, options=options)


def test_csv_keeps_ids_as_text_and_normalises_missing_values(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,amount,note\n007,1.5,"x, ""y"""\n008,NA,NULL\n009,abc,n/a\n')
    assert rows(read_source(spark, csv_source(path))) == [
        ("007", "1.5", 'x, "y"'), ("008", None, None), ("009", "abc", None),
    ]
    typed = read_source(spark, csv_source(path, "note string, id string, amount double"))
    assert typed.dtypes == [("note", "string"), ("id", "string"), ("amount", "double")]
    assert rows(typed) == [('x, "y"', "007", 1.5), (None, "008", None), (None, "009", None)]


def test_csv_line_with_too_many_fields_stops_the_read(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b\n1,2\n3,4,5\n")
    found = read_source(spark, csv_source(path))
    for run in (found.collect, found.select("b").collect, found.count):
        with pytest.raises(Exception, match="too many fields"):
            run()
    aside = read_source(spark, csv_source(path, quarantine="true"))
    assert (aside.count(), aside.filter("_malformed_line is not null").count()) == (2, 1)


def test_csv_short_lines_are_filled_and_long_ones_kept_aside(spark, tmp_path):
    text = 'id,n,note\n1\n2,5\n3,x,y,z\n4,7,"a, ""b"", c"\n"5,6",8,"x,y",9\n6,,\n\n7,"1"\n'
    path = write(tmp_path / "a.csv", text)
    got = read_source(spark, csv_source(path, "n bigint", quarantine="true"))
    assert got.columns == ["n", "id", "note", "_malformed_line"]
    assert rows(got.select("id", "n", "note", "_malformed_line")) == [
        ("1", None, None, None), ("2", 5, None, None), ("3", None, "y", "3,x,y,z"),
        ("4", 7, 'a, "b", c', None), ("5,6", 8, "x,y", '"5,6",8,"x,y",9'), ("6", None, None, None),
        ("7", 1, None, None),
    ]
    short = write(tmp_path / "b.csv", "a;b\n1\n2;x,y\n")
    assert rows(read_source(spark, csv_source(short, sep=";"))) == [("1", None), ("2", "x,y")]


def test_csv_keeps_undeclared_columns_and_misses_declared_ones(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b\n1,NA\n2,x\n")
    assert read_source(spark, csv_source(path, "b string")).columns == ["b", "a"]
    assert rows(read_source(spark, csv_source(path, "a bigint"))) == [(1, None), (2, "x")]
    with pytest.raises(ValueError, match="lacks the declared columns c"):
        read_source(spark, csv_source(path, "a bigint, c date"))


def test_csv_line_breaks_in_fields(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b\n1,"x\ny"\n')
    assert rows(read_source(spark, csv_source(path, multiLine="true"))) == [("1", "x\ny")]


def test_csv_files_with_another_header_are_refused(spark, tmp_path):
    write(tmp_path / "a.csv", "a,b\n1,2\n")
    write(tmp_path / "b.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_source(spark, csv_source(str(tmp_path))).collect()


def test_json_array_and_json_lines(spark, tmp_path):
    array = write(tmp_path / "a.json", '[{"id": "1", "n": {"x": 2}},\n {"id": "3"}]')
    lines = write(tmp_path / "b.json", '{"id": "1"}\n{"id": "3"}\n')
    schema = "id string, n struct<x: bigint>"
    assert rows(read_source(spark, SourceSpec("s", "flat_file", array, "json", schema))) == [
        ("1", (2,)), ("3", None),
    ]
    spec = SourceSpec("s", "flat_file", lines, "json", options={"lines": "true"})
    assert rows(read_source(spark, spec)) == [("1",), ("3",)]


def test_unsupported_format_and_unknown_type(spark):
    with pytest.raises(ValueError, match="no reader for files of format xml"):
        read_source(spark, SourceSpec("s", "flat_file", "x", "xml"))
    with pytest.raises(readers.UnknownSourceType):
        read_source(spark, SourceSpec("s", "queue"))


def test_registered_reader(spark):
    register_reader("numbers", lambda session, spec: session.range(int(spec.options["n"])))
    try:
        assert read_source(spark, SourceSpec("s", "numbers", options={"n": "3"})).count() == 3
    finally:
        del readers._READERS["numbers"]


PAYLOADS = [
    '[{"id": 1, "a": {"b": {"c": "x"}, "l": [1, 2]}}, {"id": 2}]',
    '{"results": [{"id": 3, "a": {"b": {"c": "y"}}}], "next": null}',
    ' {"id": 4, "a": {"b": null}}',
    '\n[\n]',
    '{"results": []}',
    "[]",
]
RECORD = "id bigint, a struct<b: struct<c: string>, l: array<bigint>>"


@pytest.mark.parametrize("schema", [RECORD, None])
def test_unwrap_and_flatten(spark, schema):
    payloads = spark.createDataFrame([(p,) for p in PAYLOADS], "body string")
    flat = flatten(unwrap_payloads(payloads, "body", schema))
    assert sorted(flat.columns) == ["a.b.c", "a.l", "id"]
    assert rows(flat.select("id", "`a.b.c`", "`a.l`")) == [
        (1, "x", [1, 2]), (2, None, None), (3, "y", None), (4, None, None),
    ]


def test_inferred_numbers_and_untyped_values(spark):
    payloads = spark.createDataFrame([('[{"n": 1, "v": null}, {"n": 2.5}]',)], "body string")
    assert unwrap_payloads(payloads, "body").dtypes == [("n", "double"), ("v", "string")]


def test_malformed_payload_stops_the_job(spark):
    payloads = spark.createDataFrame([("{broken",)], "body string")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|Malformed"):
        unwrap_payloads(payloads, "body", RECORD).collect()


def test_api_source_reads_landed_pages(spark, tmp_path):
    for i, payload in enumerate(PAYLOADS):
        write(tmp_path / f"page{i}.json", payload)
    spec = SourceSpec("products", "rest_api", str(tmp_path), schema=RECORD, url="https://example.org")
    assert read_source(spark, spec).count() == 4
    with pytest.raises(ValueError, match="landed payloads"):
        read_source(spark, SourceSpec("products", "rest_api", url="https://example.org"))


def test_flatten_handles_null_structs_and_dotted_names(spark):
    df = spark.sql("select named_struct('x', 1, 'y.z', 2) as s, cast(null as struct<q: int>) as n, 3 as `d.e`")
    flat = flatten(df)
    assert flat.columns == ["s.x", "s.y.z", "n.q", "d.e"]
    assert rows(flat) == [(1, 2, None, 3)]


def test_parse_and_flatten(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, None), (3, "{}")], "id int, props string")
    assert rows(parse_and_flatten(df, "props", "k bigint")) == [(1, 5), (2, None), (3, None)]


def test_jdbc_options():
    spec = SourceSpec("db", "database", connection_string="jdbc:x://h/d", query="SELECT 1")
    fetch = {"fetchsize": "10000"}
    assert jdbc_options(spec) == {"url": "jdbc:x://h/d", "query": "SELECT 1", **fetch}
    split = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    spec = SourceSpec("db", "database", connection_string="u", query="SELECT 1", options=split)
    assert jdbc_options(spec) == {
        "url": "u", **fetch, **split, "dbtable": "(SELECT 1) source_query",
    }
    with pytest.raises(ValueError, match="lowerBound, numPartitions, upperBound"):
        jdbc_options(
            SourceSpec("db", "database", connection_string="u", query="q", options={"partitionColumn": "id"})
        )
    with pytest.raises(ValueError, match="connection_string and query"):
        jdbc_options(SourceSpec("db", "database"))


def test_split_predicates_part_all_rows(spark):
    keys = [None, "", "a", "it's", "k", "z", "zz"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for cuts in ([], ["k"], ["a", "it's", "z"]):
        parts = [rows(df.filter(p)) for p in readers.split_predicates("k", cuts)]
        assert len(parts) == len(cuts) + 1
        assert sorted(sum(parts, []), key=repr) == rows(df)
    numbers = spark.range(10)
    assert [numbers.filter(p).count() for p in readers.split_predicates("id", [2, 3, 8])] == [2, 1, 5, 2]
    for wrong in (["b", "a"], [1, 1]):
        with pytest.raises(ValueError, match="must ascend"):
            readers.split_predicates("k", wrong)
    spec = SourceSpec("db", "database", connection_string="u", query="q", options={"splitColumn": "k", "splitAt": "[1]"})
    assert jdbc_options(spec)["dbtable"] == "(q) source_query"
    with pytest.raises(ValueError, match="lacks splitAt"):
        jdbc_options(SourceSpec("db", "database", connection_string="u", query="q", options={"splitColumn": "k"}))


def test_incremental_extract(spark):
    df = spark.createDataFrame(
        [(1, date(2020, 1, 1)), (2, date(2020, 1, 2)), (3, date(2020, 1, 3)), (4, None)],
        "id int, updated_at date",
    )
    assert rows(incremental_extract(df, ["id"], as_of="2020-01-03")) == [(2,), (3,)]
    assert rows(incremental_extract(df, ["id"], as_of="2020-01-03", days=2)) == [(1,), (2,), (3,)]


def test_registry(tmp_path, monkeypatch):
    config = {
        "sources": [
            {"name": "t", "type": "flat_file", "path": "p.csv", "sla_hours": 6, "owner": "o", "description": "d"},
            {"name": "c", "type": "database", "connection_string": "${STRATUM_DB}", "query": "q"},
        ],
        "bronze_retention_days": 30,
        "default_partition_column": "day",
    }
    path = tmp_path / "sources.json"
    path.write_text(json.dumps(config), encoding="utf-8")
    loaded = load_sources(str(path))
    assert (loaded.bronze_retention_days, loaded.partition_column) == (30, "day")
    first, second = loaded.sources
    assert (first.format, first.sla_hours, first.owner) == ("csv", 6, "o")
    monkeypatch.delenv("STRATUM_DB", raising=False)
    with pytest.raises(ValueError, match="STRATUM_DB is not set"):
        expand_environment(second)
    monkeypatch.setenv("STRATUM_DB", "jdbc:y")
    assert expand_environment(second).connection_string == "jdbc:y"


def test_registry_defaults():
    loaded = load_sources({"sources": []})
    assert (loaded.bronze_retention_days, loaded.partition_column) == (90, "ingest_date")


def test_null_tokens_do_not_touch_other_text(spark):
    df = spark.createDataFrame([("NAN",), ("none",), ("0",)], "t string")
    assert rows(df.select(readers._cleaned("t"))) == [("0",), ("NAN",), ("none",)]
