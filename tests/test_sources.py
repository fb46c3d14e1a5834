"""S5 lookup CSV, V1/V2 preflight, P1 bytes -> text, K6 file payload."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.parse import raw_text
from tidemark.operators.checks import ensure_table
from tidemark.sources.lookup import ensure_lookup_readable, read_lookup_csv

# the seven dimension rows (fixed values of the lookup file)
LOOKUP_CSV = """wiki_key,wiki_label,language
enwiki,English Wikipedia,en
commonswiki,Wikimedia Commons,multilingual
dewiki,German Wikipedia,de
ruwiki,Russian Wikipedia,ru
zhwiki,Chinese Wikipedia,zh
frwiki,French Wikipedia,fr
wikidatawiki,Wikidata,dataspace
"""


def test_lookup_csv_read_by_name(spark, tmp_dir):
    path = f"{tmp_dir}/lookup.csv"
    # columns in a different order: selection is by header name, not position
    lines = LOOKUP_CSV.splitlines()
    with open(path, "w") as fh:
        fh.write("language,wiki_label,wiki_key\n")
        for line in lines[1:]:
            k, label, lang = line.split(",")
            fh.write(f"{lang},{label},{k}\n")
    ensure_lookup_readable(spark, path)
    df = read_lookup_csv(spark, path)
    assert df.columns == ["lk_wiki_key", "lk_wiki_label", "lk_language"]
    got = {r["lk_wiki_key"]: (r["lk_wiki_label"], r["lk_language"]) for r in df.collect()}
    assert got["wikidatawiki"] == ("Wikidata", "dataspace") and len(got) == 7


def test_lookup_preflight_fails_fast(spark, tmp_dir):
    with pytest.raises(RuntimeError, match="missing or unreadable"):
        ensure_lookup_readable(spark, f"{tmp_dir}/nope.csv")
    bad = f"{tmp_dir}/bad.csv"
    with open(bad, "w") as fh:
        fh.write("key,label\na,b\n")
    with pytest.raises(RuntimeError, match="lacks columns"):
        ensure_lookup_readable(spark, bad)


def test_table_preflight(spark, tmp_dir):
    with pytest.raises(RuntimeError, match="missing"):
        ensure_table(spark, f"{tmp_dir}/no_table")
    spark.range(3).write.parquet(f"{tmp_dir}/t")
    ensure_table(spark, f"{tmp_dir}/t")


def test_bytes_to_text(spark):
    df = spark.createDataFrame([(bytearray('{"wiki":"é"}', "utf-8"),)], "value binary")
    assert df.select(raw_text("value")).first()[0] == '{"wiki":"é"}'


def test_publish_payload_files(spark, tmp_dir):
    from tidemark.sinks.kafka import write_files

    lines = spark.createDataFrame(
        [("message", '{"meta":{"id":"a"},"id":1}'), ("ping", "{}"), ("message", "[DONE]")], "event string, data string"
    )
    write_files(lines, f"{tmp_dir}/out", f"{tmp_dir}/q")
    out = spark.read.parquet(f"{tmp_dir}/out")
    r = out.select(F.col("key").cast("string").alias("k"), F.col("value").cast("string").alias("v")).first()
    assert (r["k"], r["v"]) == ("a", '{"meta":{"id":"a"},"id":1}')
    assert spark.read.parquet(f"{tmp_dir}/q").count() == 2
