import pytest
from pyspark.sql import functions as F

from quayside.functions.json_schema import struct_type
from quayside.operators.quarantine import dead_letters, header_map, reason_text, replay
from quayside.operators.validate import accepted, conform, rejected, unknown_keys, validate
from quayside.sources.topics import decode_json

SCHEMA = struct_type(
    [
        ("i", "BIGINT", True),
        ("d", "DOUBLE", True),
        ("s", "VARCHAR", True),
        ("b", "BOOLEAN", True),
        ("n", "VARCHAR", True, True),
        ("need", "BIGINT", False),
    ]
)

CASES = [
    ('{"need":1}', ""),
    ('{"need":1,"i":7,"d":1.5,"s":"x","b":true,"n":{"a":[1]}}', ""),
    ('{"need":1,"i":null,"d":null,"s":null,"b":null,"n":null}', ""),
    ("{}", "need:missing"),
    ('{"need":null}', "need:null"),
    ('{"need":1,"i":1.5}', "i:fraction"),
    ('{"need":1,"i":2.0}', ""),
    ('{"need":1,"i":1e2}', ""),
    ('{"need":1,"i":1e-2}', "i:fraction"),
    ('{"need":1,"i":1e-40}', "i:fraction"),
    ('{"need":1,"i":9223372036854775807}', ""),
    ('{"need":1,"i":-9223372036854775808}', ""),
    ('{"need":1,"i":9223372036854775808}', "i:out_of_range"),
    ('{"need":1,"i":-9223372036854775809}', "i:out_of_range"),
    ('{"need":1,"i":9223372036854775808.0}', "i:out_of_range"),
    ('{"need":1,"i":123456789012345678901234567890123456789012345}', "i:out_of_range"),
    ('{"need":1,"i":1e30}', "i:out_of_range"),
    ('{"need":1,"i":1e999}', "i:out_of_range"),
    ('{"need":1,"i":"7"}', "i:wrong_type"),
    ('{"need":1,"i":true}', "i:wrong_type"),
    ('{"need":1,"i":[7]}', "i:wrong_type"),
    ('{"need":1,"d":7}', ""),
    ('{"need":1,"d":1e999}', "d:not_finite"),
    ('{"need":1,"d":-1e999}', "d:not_finite"),
    ('{"need":1,"d":"1.5"}', "d:wrong_type"),
    ('{"need":1,"d":"NaN"}', "d:wrong_type"),
    ('{"need":1,"d":false}', "d:wrong_type"),
    ('{"need":1,"s":5}', "s:wrong_type"),
    ('{"need":1,"s":{"a":1}}', "s:wrong_type"),
    ('{"need":1,"b":"true"}', "b:wrong_type"),
    ('{"need":1,"b":1}', "b:wrong_type"),
    ('{"need":1,"n":"text"}', "n:wrong_type"),
    ('{"need":1,"n":[1,2]}', ""),
    ('{"i":"x","d":"y"}', "i:wrong_type,d:wrong_type,need:missing"),
    ('{"need":1,"need":2}', ""),
    ('{"need":1,"other":{"x":[]}}', ""),
    ('  {"need":1}  ', ""),
    ('{"need":1} trailing', ""),
    ('{"need":', "$:not_json"),
    ('{"need":NaN}', "$:not_json"),
    ("", "$:not_json"),
    ("[1]", "$:not_object"),
    ("5", "$:not_object"),
    ("null", "$:not_object"),
    (None, "$:null_value"),
]


def topic(spark, values):
    rows = [("t", 0, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")


def test_rules(spark):
    checked = validate(decode_json(topic(spark, [v for v, _ in CASES])), SCHEMA)
    got = {r["offset"]: r["why"] for r in checked.select("offset", reason_text(F.col("violations")).alias("why")).collect()}
    assert {i: got[i] for i in got} == {i: why for i, (_, why) in enumerate(CASES)}


def test_every_record_is_accepted_or_rejected(spark):
    checked = validate(decode_json(topic(spark, [v for v, _ in CASES])), SCHEMA)
    good = {r["offset"] for r in accepted(checked).collect()}
    bad = {r["offset"] for r in rejected(checked).collect()}
    assert not good & bad and good | bad == set(range(len(CASES)))
    assert good == {i for i, (_, why) in enumerate(CASES) if not why}


def test_conform_projects_by_name(spark):
    values = ['{"need":1,"s":"x","other":1,"i":2.0,"n":{"a": [1]}}', '{"need":1,"need":2}']
    got = conform(decode_json(topic(spark, values)), SCHEMA, keep=["offset"]).orderBy("offset").collect()
    assert tuple(got[0]) == (0, 2, None, "x", None, '{"a":[1]}', 1)
    assert got[1]["need"] == 2


@pytest.mark.parametrize(
    "value, why",
    [
        ('{"need":"7"}', ""),
        ('{"need":7.0}', ""),
        ('{"need":"7.5"}', "need:wrong_type"),
        ('{"need":1,"d":"1.5"}', ""),
        ('{"need":1,"d":"Infinity"}', "d:not_finite"),
        ('{"need":1,"b":"true"}', ""),
        ('{"need":1e2}', ""),
        ('{"need":1.5}', "need:fraction"),
        ('{"need":1e30}', "need:out_of_range"),
    ],
)
def test_lenient_reading(spark, value, why):
    checked = validate(decode_json(topic(spark, [value])), SCHEMA, coerce=True)
    assert checked.select(reason_text(F.col("violations"))).first()[0] == why


def test_lenient_values(spark):
    decoded = decode_json(topic(spark, ['{"need":1e2,"d":1e2}', '{"need":"7","d":"1.5"}', '{"need":7.0,"d":2}']))
    got = conform(decoded, SCHEMA, coerce=True).select("need", "d").collect()
    assert sorted(map(tuple, got)) == [(7, 1.5), (7, 2.0), (100, 100.0)]


def test_dead_letters_keep_bytes_that_are_no_text(spark):
    records = topic(spark, ["x"]).withColumn("value", F.unhex(F.lit("FFFE7B00")))
    bad = rejected(validate(decode_json(records), SCHEMA))
    at, early = (F.lit(f"2024-01-01 {h}:00:00").cast("timestamp_ntz") for h in ("10", "09"))
    letters = dead_letters(bad, at, F.lit("p"), F.lit("team"))
    assert bytes(replay(letters, "DESERIALIZATION", early, at, binary=True).first()["value"]) == bytes.fromhex("FFFE7B00")


def test_keys_and_headers_that_are_no_text_come_back(spark):
    given = [b"k", bytes.fromhex("FFFE00"), b"base64:k", b"", None]
    rows = [("t", 0, i, k, "x", [("a", k), ("b", b"1"), ("a", b"2" if i == 0 else k)]) for i, k in enumerate(given)]
    shape = "topic string, partition int, offset long, key binary, value string, headers array<struct<key: string, value: binary>>"
    records = spark.createDataFrame(rows, shape).withColumn("headers", header_map(F.col("headers")))
    at, early = (F.lit(f"2024-01-01 {h}:00:00").cast("timestamp_ntz") for h in ("10", "09"))
    letters = dead_letters(rejected(validate(decode_json(records), SCHEMA)), at, F.lit("p"), F.lit("team"))
    assert letters.filter("original_offset = 0").first()["original_key"] == "k"
    got = replay(letters, "DESERIALIZATION", early, at, binary=True).orderBy("offset").collect()
    assert [r["key"] if r["key"] is None else bytes(r["key"]) for r in got] == given
    for r, (*_, headers) in zip(got, rows):
        back = {h["key"]: None if h["value"] is None else bytes(h["value"]) for h in r["headers"]}
        assert back.pop("dlq.original.failure") == b"$:not_json" and back.pop("dlq.replay.time")
        assert back == dict(headers)


def test_unknown_keys(spark):
    values = ['{"need":1,"x":1,"y":2}', '{"need":1,"x":1}', "[1]", '{"x":']
    got = unknown_keys(decode_json(topic(spark, values)), SCHEMA).collect()
    assert sorted((r["key"], r["records"]) for r in got) == [("x", 2), ("y", 1)]


def test_dead_letters_replay_the_original_bytes(spark):
    values = ['{"need":"é😀"}', '{"need":', '{"need":' + "1" * 300 + "x"]
    bad = rejected(validate(decode_json(topic(spark, values)), SCHEMA))
    at = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    letters = dead_letters(bad, at, F.lit("p"), F.lit("team"))
    assert letters.filter("original_payload LIKE '%\\n%'").count() == 0
    early, late = F.lit("2024-01-01 09:00:00").cast("timestamp_ntz"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    got = replay(letters, "DESERIALIZATION", early, at).orderBy("offset").collect()
    assert [r["value"] for r in got] == values[1:]
    assert got[0]["headers"] == {"dlq.replay.time": "2024-01-01 10:00:00", "dlq.original.failure": "$:not_json"}
    assert [r["value"] for r in replay(letters, "VALIDATION", early, at).collect()] == values[:1]
    assert replay(letters, "DESERIALIZATION", late, at).count() == 0
