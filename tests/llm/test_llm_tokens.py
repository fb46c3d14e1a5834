"""Token blocks: round trips, and ids against the library's own."""

import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tables import EDGE_DOCS, thue_morse, write

from tidemark.llm import token_blocks as tb
from tidemark.llm.queries import op8_token_blocks, tokenizer_path

TEXTS = [
    "", " ", "Hello, world", "l'été d'où ÉCOLE ÀÇÊ straße ×÷ naïve", "it's we'll I'VE don't 's", "a1b22 3.14 x_y--z #$%&",
    "<|endoftext|> a<|startoftext|>b | || <|", "é ́a Å Å", "日本語テキスト 한국어 עברית", "\xa0nbsp em　 \x85",
    "ǅ İstanbul ΣΑΣ ﬁ", "emoji 😀👍🏽 x", "tab\tnew\nline\r\x0b\x0c", "\x00\x01\x7f", "ÿþ Þ ß ẞ", "don’t “q” …", "aaa" * 3000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def encoded(pieces, texts):
    data = [t.encode() for t in texts]
    lengths, ids = pieces.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    return [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]


def test_ids_are_the_library_s(library):
    pieces = tb.PieceEncoder(tokenizer_path())
    want = [library.encode(t, add_special_tokens=False).ids + [1] for t in TEXTS]
    assert encoded(pieces, TEXTS) == want
    assert encoded(pieces, TEXTS[::-1]) == want[::-1]  # remembered


def test_words_that_hash_alike(library, monkeypatch):
    words = [thue_morse(0), thue_morse(1), "some", "words"]
    want = [library.encode(t, add_special_tokens=False).ids + [1] for t in words]
    assert encoded(tb.PieceEncoder(tokenizer_path()), words) == want
    hashes = tb.word_hashes
    monkeypatch.setattr(tb, "word_hashes", lambda *a, table=0, **k: hashes(*a, table=table, **k) if table else hashes(*a, **k) * 0)
    pieces = tb.PieceEncoder(tokenizer_path())  # all first hashes are equal: the second one tells
    assert encoded(pieces, words) == want and encoded(pieces, words[::-1]) == want[::-1]


def test_another_tokenizer_gets_whole_texts(tmp_dir):
    """A tokenizer that keeps capitals and splits at white space only."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    other = Tokenizer(models.WordLevel({"[UNK]": 0, "Hello,": 5, "hello,": 6, "World": 7}, unk_token="[UNK]"))
    other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    other.save(f"{tmp_dir}/other.json")
    assert encoded(tb.PieceEncoder(f"{tmp_dir}/other.json"), ["Hello, World", "", "hello, world"]) == [[5, 7, 1], [1], [6, 0, 1]]
    assert tb.cuts_alike(Tokenizer.from_file(tokenizer_path())) and not tb.cuts_alike(other)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=6))
def test_any_text(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    assert encoded(tb.encoder(tokenizer_path()), texts) == [library.encode(t, add_special_tokens=False).ids + [1] for t in texts]


@pytest.mark.parametrize("high", [1, 2, 300, 2**16, 2**32])
def test_block_round_trip(high):
    rng = np.random.default_rng(high)
    for n in (1, 7, 4096):
        ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
        ids[rng.integers(0, n, n // 20 + 1)] = high - 1
        data = b"xx" + tb.pack_block(ids)
        assert (tb.unpack_block(data, 2) == ids).all()


def test_outliers_are_exceptions():
    ids = np.full(4096, 5, np.uint32)
    ids[::100] = 40_000
    assert len(tb.pack_block(ids)) < 300


class Sink(io.BytesIO):
    def close(self):
        pass


def test_file_random_access():
    rng = np.random.default_rng(0)
    lengths = rng.integers(0, 3000, 50)
    ids = rng.integers(0, 49408, int(lengths.sum())).astype(np.uint32)
    sink = Sink()
    writer = tb.BlockWriter(sink)
    cut = int(lengths[:20].sum())
    writer.add(list(range(20)), lengths[:20], ids[:cut])
    writer.add([None, *range(21, 50)], lengths[20:], ids[cut:])
    writer.close()
    reader = tb.BlockReader(sink, len(sink.getvalue()))
    assert reader.doc_ids == [*range(20), None, *range(21, 50)] and reader.ids == len(ids)
    for i in (0, 3, 20, 49):
        first = int(lengths[:i].sum())
        assert (reader.read(first, int(lengths[i])) == ids[first : first + lengths[i]]).all()


def want_rows(library, docs):
    rows, at = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, zlib.crc32((d[1] or "").encode()))):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        rows.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return sorted(rows, key=str)


def test_edges(spark, tmp_dir, library):
    docs = EDGE_DOCS + [(100 + i, t, "en", "a", 1) for i, t in enumerate(TEXTS)]
    got = [tuple(r) for r in op8_token_blocks(spark, write(tmp_dir, docs)).collect()]
    assert sorted(got, key=str) == want_rows(library, [d[:2] for d in docs])
    assert op8_token_blocks(spark, write(tmp_dir)).collect() == []


def test_small_files(spark, tmp_dir, library):
    df = spark.createDataFrame([(i, TEXTS[i % len(TEXTS)]) for i in range(90)], "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    files = tb.write_token_files(df, f"{tmp_dir}/out", tokenizer_path(), file_ids=500)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files.count() > 5
    got = [tuple(r) for r in tb.read_token_files(files, f"{tmp_dir}/out").collect()]
    assert sorted(got, key=str) == want_rows(library, [(i, TEXTS[i % len(TEXTS)]) for i in range(90)])
