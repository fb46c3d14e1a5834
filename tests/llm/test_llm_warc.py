"""WARC bundles: round trip, seek table, index, equal payloads."""

import base64
import hashlib
import io

import pytest
import zstandard
from llm_tables import write

from tidemark.llm import warc
from tidemark.llm.queries import op5_warc

PAGES = [
    (5, "http://a", "<p>same</p>"),
    (3, "http://b", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (3, "http://b", "<p>same</p>"),
    (1, "http://c\r\nX-Evil: 1", "ünï\r\n\r\nWARC/1.1\r\n"),
    (2, "http://d", None),
    (4, "http://e", ""),
    (None, "http://f", "null id"),
    (None, "http://f", "<p>same</p>"),
    (7, "http://g", "x" * 700_000),
]


def want(pages):
    body = [(p, (h or "").encode()) for p, _, h in pages]
    first = {}
    for p, b in body:
        if p is not None:
            first[b] = min(p, first.get(b, p))
    rows = []
    for p, b in body:
        again = b in first and first[b] != p
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        rows.append((p, len(b), digest, "revisit" if again else "response", first[b] if again else None))
    return sorted(rows, key=str)


def test_edges(spark, tmp_dir):
    got = [tuple(r) for r in op5_warc(spark, write(tmp_dir, pages=PAGES)).collect()]
    assert sorted(got, key=str) == want(PAGES)
    assert op5_warc(spark, write(tmp_dir)).collect() == []


def test_bundles_and_index(spark, tmp_dir):
    pages = [(i, f"http://h/{i}", f"page {i % 50} " * (i % 40)) for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    folder = f"{tmp_dir}/bundles"
    index = warc.write_bundles(df, folder, frame_bytes=4000, bundle_bytes=1500)
    rows = index.collect()
    assert len(rows) == 300 and len({r.bundle for r in rows}) > 3 and max(r.frame for r in rows) > 2
    got = warc.read_bundles(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=str) == want(pages)
    for r in rows[::37]:
        head, payload = warc.fetch_record(folder, r.bundle, r.frame, r.frame_offset)
        assert head["warc-record-id"] == r.record_id and int(head["x-page-id"]) == r.page_id
        if head["warc-type"] == "response":
            assert payload.decode() == pages[r.page_id][2]


def test_any_decoder_reads_a_bundle():
    class Sink(io.BytesIO):
        def close(self):
            pass

    sink = Sink()
    writer = warc.BundleWriter(sink, frame_bytes=100)
    records = [warc.build_record(i, "u", b"p" * i, i, "D", None) for i in range(5)]
    places = [writer.add(r) for r in records]
    writer.close()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(sink.getvalue()), read_across_frames=True).read()
    assert plain == b"".join(records)
    table = warc.seek_table(sink, len(sink.getvalue()))
    for record, (frame, offset) in zip(records, places):
        assert warc.read_frame(sink, table[frame])[offset:].startswith(record)


def test_damage_is_found():
    with pytest.raises(ValueError):
        warc._parsed(warc.build_record(1, "u", b"abc", 3, "WRONG", None), "b", 0)


def test_least_bytes(spark, tmp_dir):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    rows = {r.page_id: r.record_type for r in warc.archive(df, least_bytes=4).collect()}
    assert rows == {1: "response", 2: "response", 3: "response", 4: "revisit"}
