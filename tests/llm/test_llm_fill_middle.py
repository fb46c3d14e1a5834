"""Fill-in-the-middle against a plain version with string slices, and the round trip."""

import hashlib

import duckdb
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tables import EDGE_DOCS, write

from tidemark.llm import fill_middle
from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.queries import op13_fill_middle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_version(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def piece(text):
    data = text.encode()
    return fill_middle.Piece(memoryview(data), 0, len(data))


TEXTS = st.text(alphabet=st.sampled_from("ab<PSM> \nä世\U0001f600"), max_size=40)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(-5, 10**6) | st.none())
def test_every_arrangement(text, doc_id):
    n, form, prefix, middle, out = fill_middle.arrange(piece(text), doc_id)
    output = fill_middle.joined(out).decode()
    assert (n, form, prefix, middle, output) == plain_version(doc_id, text)
    assert fill_middle.sha256(out) == sha(output)
    assert fill_middle.restore_text(output, form) == text


def test_cuts_beyond_one_stretch(monkeypatch):
    monkeypatch.setattr(fill_middle, "_STRETCH", 7)
    for doc_id in range(60):
        text = "ä世b😀" * 20 + "x" * doc_id
        _, _, _, _, out = fill_middle.arrange(piece(text), doc_id)
        assert fill_middle.joined(out).decode() == plain_version(doc_id, text)[4]


def test_output_without_its_sentinels_is_an_error():
    with pytest.raises(ValueError):
        fill_middle.restore_text("text", "psm")
    with pytest.raises(ValueError):
        fill_middle.restore_text("<P>text<M>", "psm")


def test_slices_of_a_batch():
    column = pa.array(["skipped", "äb", None, "", "c"]).slice(1)
    assert [fill_middle.joined([p]).decode() for p in fill_middle._texts(column)] == ["äb", "", "", "c"]


def test_edges(spark, tmp_dir):
    docs = [*EDGE_DOCS, (9, "has <S> inside", "en", "a", 1), (10, "y" * 3_000_000 + "ß", "en", "a", 1), (-3, "minus", "en", "a", 1)]
    folder = write(tmp_dir, docs)
    rows = op13_fill_middle(spark, folder).collect()
    want = [(d[0], *plain_version(d[0], d[1])[:4], sha(plain_version(d[0], d[1])[4]), sha(d[1] or "")) for d in docs]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    frame = fill_middle.fill_in_middle(spark.read.parquet(f"{folder}/documents.parquet"))
    assert all(sha(r.output) == r.output_sha256 and sha(fill_middle.restore_text(r.output, r.form)) == r.restored_sha256 for r in frame.collect())
    assert op13_fill_middle(spark, write(tmp_dir)).collect() == []


def test_whole_table_equals_sql(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    res = con.sql(ORACLE_SQL["op13_fill_middle"])
    df = op13_fill_middle(spark, "/root/testdata/sf0.01").select(*res.columns)
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, res.fetchall()))
