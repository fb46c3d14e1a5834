"""P18 message keys and S8 feed cleaning."""

import pytest
from pyspark.sql import functions as F

from conftest import raw_df
from tidemark.functions.keys import with_message_key
from tidemark.sources.feed import clean_feed, publishable

KEY_CASES = [
    ('{"meta":{"id":"u-1"},"id":5}', "u-1"),
    ('{"meta":{"id":""},"id":5}', "5"),
    ('{"meta":null,"id":0}', None),
    ('{"id":"0"}', "0"),
    ('{"meta":{"id":0},"id":"x"}', "x"),
    ('{"id":1.5}', "1.5"),
    ('{"id":true}', "True"),
    ('[1]', None),
    ('bad', None),
    ('{"id":false}', None),
    ('{}', None),
    ('{"id":1,"id":2}', "2"),
    ('{"id":NaN}', "nan"),
    ('{"id":-Infinity}', "-inf"),
    ('{"id":1.0}', "1.0"),
    ('{"id":0.0}', None),
    ('{"id":1e20}', "1e+20"),
    ('{"id":-1.5E300}', "-1.5e+300"),
    ('{"id":12345678.5}', "12345678.5"),
    ('{"id":1e-7}', "1e-07"),
    ('{"id":0.0005}', "0.0005"),
    ('{"id":12345678901234567890123456789012345678901234567890}', "12345678901234567890123456789012345678901234567890"),
    ('{"id":12345678901234567890123456789012345678901234567891}', "12345678901234567890123456789012345678901234567891"),
    ('{"meta":"text","id":7}', "7"),
    ('{"meta":{"id":[]},"id":"false"}', "false"),
    ('{"id":{}}', None),
    ('{"id":1} rest', None),
    ("{'id':1}", None),
    ('{"id":1},{"id":2}', None),
]


def test_message_key(spark):
    out = with_message_key(raw_df(spark, [r for r, _ in KEY_CASES]))
    got = {r["raw"]: r["message_key"] for r in out.collect()}
    assert got == dict(KEY_CASES)


def test_feed_clean_rules(spark):
    lines = spark.createDataFrame(
        [
            ("message", '{"wiki":"a"}'),
            ("", ' {"wiki":"b"} '),
            (None, '{"wiki":"c"}'),
            ("ping", '{"wiki":"d"}'),
            ("message", "   "),
            ("message", "[DONE]"),
            ("message", "{bad"),
            (" message ", "[1]"),
            ("\u00a0message", '\u2003{"id":1,"id":2}\u00a0'),
            ("message", '{"id":NaN}'),
            ("message", '{"id":1} rest'),
            ("message", "{'id':1}"),
        ],
        "event string, data string",
    )
    got = [(r["accepted"], r["reject_reason"], r["raw"]) for r in clean_feed(lines).collect()]
    assert got == [
        (True, None, '{"wiki":"a"}'),
        (True, None, '{"wiki":"b"}'),
        (True, None, '{"wiki":"c"}'),
        (False, "event", '{"wiki":"d"}'),
        (False, "blank", ""),
        (False, "done", "[DONE]"),
        (False, "bad_json", "{bad"),
        (True, None, "[1]"),
        (True, None, '{"id":1,"id":2}'),
        (True, None, '{"id":NaN}'),
        (False, "bad_json", '{"id":1} rest'),
        (False, "bad_json", "{'id':1}"),
    ]


def test_publishable_quarantines_non_objects(spark):  # B8
    lines = spark.createDataFrame(
        [("message", '{"meta":{"id":"k"}}'), ("message", "[1]"), ("message", "[DONE]")], "event string, data string"
    )
    messages, quarantine = publishable(lines)
    assert [(r["raw"], r["message_key"]) for r in messages.collect()] == [('{"meta":{"id":"k"}}', "k")]
    assert sorted(r["reject_reason"] for r in quarantine.collect()) == ["done", "not_object"]


def test_kafka_payload_shape(spark):
    from tidemark.sources.kafka import kafka_payload

    df = spark.createDataFrame([("k", '{"a":1}'), (None, "{}")], "message_key string, raw string")
    out = kafka_payload(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["binary", "binary"]
    assert out.filter(F.col("key").isNull()).count() == 1
