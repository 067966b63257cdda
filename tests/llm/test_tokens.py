"""Byte-level BPE, binary records and separator scan, against the libraries themselves."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skewdex.llm import byte_bpe, files, queries, records, separator_scan, word_bpe

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
TEXTS = [
    None, "", " ", "\n\n \t", "It's we'll 're' ''ll 12345", "Ünï cödé 😀 日本語  x　y \x1c\x1f z",
    "word " * 400, "x" * 2000, "  " * 900 + "end", "áé " * 200, "tail'", "mixed1a2b3c!!??  \n  ok" * 40,
    "<|endoftext|> is one id", "he said <|endoftext|> and", "a<|endoftext|>b <|startoftext|>! <|EndOfText|> <|endoftext|><|endoftext|>", "<|endof text|> word,|> é<|endoftext|>,",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 3 else None, t, i, "e") for i, t in enumerate(TEXTS)]
    rows += [(4, TEXTS[4], 0, "again"), (5, "other text of the same id", 0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids int, row string").repartition(3)


def want(docs, one):
    return sorted(((r.doc_id, *one(r.text or "")) for r in docs.collect()), key=str)


@pytest.mark.parametrize("chunk", [byte_bpe.CHUNK, 100, 7])
def test_encoding_of_chunks_is_that_of_whole_texts(docs, chunk):
    bpe = byte_bpe.encoding(RANKS, PATTERN)
    encoded = byte_bpe.encode(docs, "doc_id", "text", RANKS, PATTERN, chunk=chunk, overlap=5)
    got = byte_bpe.decode(encoded, RANKS, PATTERN).collect()
    assert sorted(((r.doc_id, list(r.ids), bytes(r.bytes)) for r in got), key=str) == want(
        docs, lambda t: (bpe.encode_ordinary(t), t.encode())
    )


def test_encoding_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(none, "doc_id", "text", RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_chunks_end_where_both_readings_have_a_boundary():
    text = "ab" * 50 + " " + "cd " * 100
    spans = byte_bpe.chunks_of(text, 20, 3)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(b[0] == a[0] + 20 and a[1] >= b[0] for a, b in zip(spans, spans[1:]))


def test_words_are_encoded_as_the_library_does():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        content = file.read()
    library = Tokenizer.from_str(content)
    encoder = word_bpe.piece_encoder(content)
    for text in TEXTS[1:]:
        assert np.frombuffer(encoder(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_records_hold_what_was_written(spark):
    tokens = {0: [], 1: [1, 2, 3], 2: [70000, 5], None: [9], 7: [1] * 5000}
    rows = [(k, np.array(v, "<u4").tobytes()) for k, v in tokens.items()] + [(8, None), (1, b"")]
    df = records.ordered(spark.createDataFrame(rows, "doc_id long, tokens binary"), "doc_id", "tokens")
    folder = files.new_folder(spark, "records")
    records.write(df, "doc_id", "tokens", folder)
    for seed in (None, 5):
        got = sorted(records.read(spark, folder, seed).collect(), key=lambda r: r.start + 0.1 * bool(r.tokens))
        assert sorted((str(r.doc_id), bytes(r.tokens)) for r in got) == sorted((str(k), v or b"") for k, v in rows)
        place = 0
        for r in got:
            assert r.start == place
            place += len(r.tokens) // 4
        ids = [r.doc_id for r in sorted(got, key=lambda r: (r.file, r.record))]
        assert ids == sorted(ids, key=lambda k: (k is not None, k))


def test_damage_is_seen():
    framed = records.frame(b"payload")
    assert records.unframe(framed) == b"payload"
    for at in range(len(framed)):
        broken = bytearray(framed)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(broken))


def test_scan_of_flat_files_in_any_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(separator_scan, "GROUP", 3)
    rng, expected = np.random.default_rng(0), set()
    for i, n in enumerate((1000, 0, 1, 57, 64)):
        ids = rng.integers(0, 9, n).astype("<u2")
        ids.tofile(tmp_path / f"p{i}.bin")
        start = ordinal = 0
        for at, value in enumerate(ids):
            if value == 7:
                expected.add((f"p{i}.bin", ordinal, start, at - start, True))
                start, ordinal = at + 1, ordinal + 1
        if start < n:
            expected.add((f"p{i}.bin", ordinal, start, n - start, False))
    for block in (8, 1 << 20):
        assert {tuple(r) for r in separator_scan.scan(spark, f"file://{tmp_path}", 7, block=block).collect()} == expected


def test_flat_files_refuse_ids_that_do_not_fit(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    with pytest.raises(Exception, match="does not fit"):
        separator_scan.write_flat(docs, "doc_id", "text", RANKS, PATTERN, 70_000, files.new_folder(spark, "flat"))


@pytest.fixture(scope="module")
def tables(docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{folder}/documents.parquet")
    return folder


def test_op1(spark, docs, tables):
    bpe = byte_bpe.encoding(RANKS, PATTERN)

    def one(text):
        ids = bpe.encode_ordinary(text)
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    assert sorted(map(tuple, queries.op1_byte_bpe(spark, tables).collect()), key=str) == want(docs, one)


def test_op6(spark, docs, tables):
    bpe = byte_bpe.encoding(RANKS, PATTERN)
    got = queries.op6_separator_scan(spark, tables).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == want(docs, lambda t: (len(bpe.encode_ordinary(t)),))


def test_op9(spark, docs, tables):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    def one(text):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        return len(ids), zlib.crc32(ids.tobytes())

    got = queries.op9_binary_records(spark, tables).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == want(docs, one)
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
