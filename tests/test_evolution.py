"""Published contracts, and records of other versions."""

import json

import pytest
from pyspark.sql import types as T

from riskstream.operators import evolution as V
from riskstream.operators.contracts import CONTRACTS, DEFAULTS, ContractError


def contract(*fields, name="Payment"):
    return json.dumps({"type": "record", "name": name, "fields": list(fields)})


def field(name, kind, **more):
    return {"name": name, "type": kind, **more}


def read(*fields, **options):
    return V.read_contract(contract(*fields), **options)


@pytest.mark.parametrize("subject", sorted(CONTRACTS))
def test_published_contract_reads_back(subject):
    text = V.published("Record", CONTRACTS[subject], DEFAULTS.get(subject))
    back = V.read_contract(text, strict=True)
    assert back.schema() == CONTRACTS[subject]
    assert {f.name: f.default for f in back.fields if f.default is not None} == {
        k: v for k, v in DEFAULTS.get(subject, {}).items() if k != "schemaVersion"
    }


def test_default_of_another_branch():
    odd = field("currency", ["null", "string"], default="USD")
    assert V.default_problems(read(odd)) == ["default of field currency is not of its first type, null"]
    with pytest.raises(ContractError, match="not of its first type"):
        read(odd, strict=True)
    assert read(field("currency", ["string", "null"], default="USD"), strict=True).fields[0].nullable


@pytest.mark.parametrize(
    "text, problem",
    [
        ("{", "not a contract"),
        ('{"type": "enum"}', "no record"),
        ('["null"]', "no record"),
        (contract({"type": "int"}), "no name"),
        (contract(field("a", ["int", "string"])), "not supported"),
        (contract(field("a", "null")), "not supported"),
        (contract(field("a", ["int", "int"])), "not supported"),
        (contract(field("a", {"type": "map", "values": "int"})), "not supported"),
        (contract(field("a", "int", default="x")), "fits none"),
        (contract(field("a", "int", default=True)), "fits none"),
        (contract(field("a", "int", default=1 << 31)), "fits none"),
        (contract(field("a", "int", default=None)), "fits none"),
        (contract(field("a", "int"), field("a", "long")), "stand twice: a"),
    ],
)
def test_odd_contracts(text, problem):
    with pytest.raises(ContractError, match=problem):
        V.read_contract(text)


def test_resolution():
    writer = read(field("a", "int"), field("b", ["null", "string"]), field("old", "float"), field("gone", "string"))
    assert V.resolution_problems(writer, writer) == []
    fits = read(field("a", "double"), field("b", ["bytes", "null"]), field("c", "double", aliases=["older", "old"]), field("n", "int", default=3))
    assert V.resolution_problems(writer, fits) == []
    odd = read(field("a", "string"), field("b", "string"), field("n", "int"), field("gone", "int"))
    assert V.resolution_problems(writer, odd) == [
        "field a is written as int, which is not read as string",
        "field b may be written as null",
        "field n is not written and has no default",
        "field gone is written as string, which is not read as int",
    ]


def test_compatibility_of_versions():
    first = read(field("a", "int"))
    second = read(field("a", "long"), field("b", "string", default=""))
    third = read(field("a", "long"))
    assert V.compatibility_problems(second, {1: first}) == {}
    assert V.compatibility_problems(second, {1: first}, V.FORWARD) == {1: ["field a is written as long, which is not read as int"]}
    assert V.compatibility_problems(third, {1: first, 2: second}, V.FULL) == {}
    assert list(V.compatibility_problems(third, {1: first, 2: second}, V.FULL, all_versions=True)) == [1]
    assert V.compatibility_problems(first, {}, V.FULL) == {}
    with pytest.raises(ValueError, match="mode must be"):
        V.compatibility_problems(first, {}, "sideways")


def test_contract_files(spark, tmp_path):
    texts = {2: contract(field("a", "int")), 10: contract(field("a", "long"), field("b", ["null", "string"], default=None))}
    V.write_contracts(spark, texts, f"{tmp_path}/subject")
    assert V.read_contracts(spark, f"{tmp_path}/subject") == {v: V.read_contract(t) for v, t in texts.items()}
    (tmp_path / "subject/version=2/again.avsc").write_text(texts[2])
    with pytest.raises(ContractError, match="one file"):
        V.read_contracts(spark, f"{tmp_path}/subject")


def test_columns_under_another_contract(spark):
    writer = read(field("a", "int"), field("user", ["null", "string"]), field("gone", "string"))
    reader = read(field("a", "double"), field("userId", ["null", "string"], aliases=["user"]), field("n", ["null", "long"], default=7))
    frame = spark.createDataFrame([(1, None, "x"), (2, "u", "y")], "a int, user string, gone string")
    got = V.read_as(frame, writer, reader)
    assert got.schema.simpleString() == "struct<a:double,userId:string,n:bigint>"
    assert [tuple(r) for r in got.orderBy("a").collect()] == [(1.0, None, 7), (2.0, "u", 7)]
    with pytest.raises(ContractError, match="gone is not written"):
        V.read_as(frame, reader, writer)


VERSIONS = {
    1: read(field("id", "string"), field("paid", "int")),
    2: read(field("id", "string"), field("paid", "double"), field("country", ["null", "string"], default="??")),
}


def read_records(spark, *rows):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "place int, version int, value string")
    return V.read_versions(frame, VERSIONS, VERSIONS[2])


def test_records_of_versions(spark):
    unread = "malformed JSON, or a field that is not of its type"
    rows = [
        ((1, '{"id": "a", "paid": 3, "country": "no field of version 1"}'), ("a", 3.0, "??", None)),
        ((2, ' {"id": "b", "paid": 1.5}'), ("b", 1.5, None, None)),
        ((2, '{"id": "c", "paid": 1.5, "country": null}'), ("c", 1.5, None, None)),
        ((2, '{"id": "d", "country": "X"}'), ("d", None, "X", "required field paid is null")),
        ((1, '{"id": "e", "paid": 1.5}'), ("e", None, "??", unread)),
        ((2, '{"id": "f", "paid"'), (..., ..., ..., unread)),
        ((2, "[1]"), (..., ..., ..., "not a JSON object")),
        ((2, ""), (..., ..., ..., "not a JSON object")),
        ((2, None), (..., ..., ..., "not a JSON object")),
        ((3, '{"id": "g", "paid": 1}'), (None, None, None, "no contract for version 3")),
        ((None, '{"id": "h", "paid": 1}'), (None, None, None, "no contract for version null")),
    ]
    got = read_records(spark, *[given for given, _ in rows]).orderBy("place").collect()
    for found, (given, want) in zip(got, rows, strict=True):
        assert all(w is ... or w == f for f, w in zip(found[1:], want, strict=True)), (given, found)


def test_long_record_and_empty_table(spark):
    text = "x" * 3_000_000
    got = read_records(spark, (2, json.dumps({"id": text, "paid": 2}))).first()
    assert (got.id, got.contractProblem) == (text, None)
    assert read_records(spark, (1, "{}")).limit(0).columns == ["place", "id", "paid", "country", "contractProblem"]


def test_column_named_like_a_field_gives_way(spark):
    frame = spark.createDataFrame([("other", 2, '{"id": "a", "paid": 1}')], "id string, version int, value string")
    got = V.read_versions(frame, VERSIONS, VERSIONS[2])
    assert got.columns == ["id", "paid", "country", "contractProblem"] and got.first().id == "a"


def test_each_record_is_parsed_once(spark):
    plan = read_records(spark, (1, "{}"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("from_json(") == len(VERSIONS)


def test_versions_that_the_reader_cannot_take(spark):
    frame = spark.createDataFrame([], "version int, value string")
    with pytest.raises(ContractError, match="version 2: field paid is written as double"):
        V.read_versions(frame, VERSIONS, VERSIONS[1])
    assert V.read_versions(frame, {}, VERSIONS[2]).schema["paid"].dataType == T.DoubleType()
