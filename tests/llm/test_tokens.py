"""BPE, token files and word-piece counts against the library and brute force."""

import hashlib
import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from linkrank.llm import bpe, chunks, token_files, wordpiece
from linkrank.llm.queries import tokenizer_path
from linkrank.llm.text import strings
from pyspark.sql import functions as F
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(tokenizer_path())
    found.no_truncation()
    found.no_padding()
    return lambda text: found.encode(text or "", add_special_tokens=False).ids, found


@pytest.fixture(scope="module")
def content():
    with open(tokenizer_path(), "rb") as f:
        return f.read()


def random_texts(n):
    draw = random.Random(1)
    letters = ["ab", "the", " ", " ", "  ", "\n", "\t", "'s", "é", "è ", " ", "　", "漢", "9", "!", ".", "\x1c", "\x85", "😀", "<|endoftext|>"]
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 25))) for _ in range(n)]


def test_encoder_equals_library(library, content):
    encode, tokenizer = library
    own = bpe.Bpe(content.decode())
    texts = random_texts(3000) + ["a" * 3000, "é é" * 500]
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        assert ids == encode(text)
        assert own.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False)


def test_invalid_bytes_are_replaced_in_decoding(library, content):
    own = bpe.Bpe(content.decode())
    ids = own.encode("漢字")[:-1]
    assert own.decode(ids) == library[1].decode(ids, skip_special_tokens=False)


def test_chunks_keep_the_tokens(content):
    own = bpe.Bpe(content.decode())
    texts = random_texts(3000)
    distinct, codes, starts = chunks.distinct(strings(pa.array(texts)))
    assert all(
        "".join(distinct[c] for c in codes[a:b]) == t
        for t, a, b in zip(texts, starts[:-1], starts[1:], strict=True)
    )
    encoded = own.encode_all(distinct)
    for whole, a, b in zip(own.encode_all(texts), starts[:-1], starts[1:], strict=True):
        assert whole == [i for c in codes[a:b] for i in encoded[c]]


def test_remembered_values_survive_turnover():
    asked = []
    remembered = chunks.Remembered(lambda new: asked.extend(new) or [len(x) for x in new], size=3)
    for _ in range(3):
        for word in ("a", "bb", "ccc", "dddd", "eeeee"):
            assert remembered([word, "a"]) == [len(word), 1]
    assert len(remembered.young) <= 4 and len(remembered.old) <= 4


def test_round_trip_rows(odd_docs, odd_rows, library):
    encode, tokenizer = library
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = [
        (i, len(encode(t)), sha(",".join(map(str, encode(t)))), sha(tokenizer.decode(encode(t), skip_special_tokens=False)))
        for i, t in odd_rows
    ]
    found = [tuple(r) for r in bpe.round_trip(odd_docs, tokenizer_path()).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_encode_and_decode_tables_keep_other_columns(odd_docs):
    encoded = bpe.encode_table(odd_docs, tokenizer_path())
    assert encoded.columns == ["doc_id", "text", "lang", "source", "score", "kept", "ids"]
    decoded = bpe.decode_table(encoded, tokenizer_path())
    assert decoded.filter(F.col("decoded") != F.coalesce("text", F.lit(""))).count() == 0
    assert decoded.count() == odd_docs.count()


def test_empty_tables(spark, no_docs):
    assert bpe.round_trip(no_docs, tokenizer_path()).count() == 0
    assert bpe.encode_table(no_docs, tokenizer_path()).count() == 0
    assert token_files.checksums(no_docs, tokenizer_path()).count() == 0
    assert wordpiece.token_counts(no_docs, tokenizer_path()).count() == 0


@pytest.mark.parametrize("joined", [2, 1000])
def test_token_files(odd_docs, odd_rows, library, monkeypatch, joined):
    monkeypatch.setattr(token_files, "JOINED", joined)
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, start = [], 0
    for i, text in ordered:
        ids = [*library[0](text), 0]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = [tuple(r) for r in token_files.checksums(odd_docs, tokenizer_path()).collect()]
    assert sorted(found, key=lambda r: r[1]) == expected


def test_library_chunks_in_one_call(library, content):
    remembered, width = token_files.worker_tokenizer(content)
    texts = random_texts(2500)
    found = remembered(texts)
    assert [np.frombuffer(x, token_files.number_type(width)).tolist() for x in found] == [library[0](t) for t in texts]


def greedy(word, vocabulary):
    longest, n, i = max(map(len, vocabulary)), 0, 0
    while i < len(word):
        j = next((j for j in range(min(len(word), i + longest), i, -1) if word[i:j] in vocabulary), None)
        if j is None:
            return 1
        n, i = n + 1, j
    return n


def test_automaton_equals_greedy():
    draw = random.Random(2)
    for _ in range(200):
        vocabulary = {bytes(draw.choices(b"abc", k=draw.randint(1, 5))) for _ in range(draw.randint(1, 12))}
        automaton = wordpiece.Automaton(vocabulary)
        for _ in range(50):
            word = bytes(draw.choices(b"abcd", k=draw.randint(1, 12)))
            assert automaton.count(word) == greedy(word, vocabulary), (vocabulary, word)


def test_token_counts(odd_docs, odd_rows, content):
    vocabulary = wordpiece.byte_vocabulary(content.decode())
    expected = []
    for i, text in odd_rows:
        own = (text or "").encode().split()
        expected.append((i, len(own), sum(greedy(b" " + w, vocabulary) for w in own)))
    found = [tuple(r) for r in wordpiece.token_counts(odd_docs, tokenizer_path()).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_wrong_ids_are_found_where_they_are_made(spark, odd_docs, monkeypatch, content):
    own = bpe.Bpe(content.decode())
    texts = pa.array(["one two", "é漢", ""])
    flat, lengths = own.encode_flat(texts.to_pylist())
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    bpe._confirm(own, texts, flat, bounds, pa.array([1, 2, 3]))
    flat[-1] += 1
    with pytest.raises(ValueError, match="doc_id 2"):
        bpe._confirm(own, texts, flat, bounds, pa.array([1, 2, 3]))
    encoded = bpe.encode_table(odd_docs, tokenizer_path(), check=True).select("doc_id", "ids")
    plain = bpe.encode_table(odd_docs, tokenizer_path()).select("doc_id", "ids")
    assert sorted(map(tuple, encoded.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_token_files_are_read_by_many_tasks(spark, odd_docs, monkeypatch, tmp_path):
    monkeypatch.setattr(token_files, "READ_BYTES", 20_000)
    docs = odd_docs.filter("doc_id IS NOT NULL").unionByName(odd_docs.withColumn("doc_id", F.lit(90).cast("long") + F.rand(1) * 90))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    token_files.write_token_files(docs, tokenizer_path(), str(tmp_path))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = token_files.read_token_files(spark, str(tmp_path), zlib.crc32)
    shards = spark.read.parquet(f"{tmp_path}/manifest").count()
    used = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    assert shards > 1 and used > 1


def test_plain_chunks_go_to_the_library_without_marks(monkeypatch, content):
    """They are cut apart by the bytes of their ids; chunks that hold a special token go alone."""
    import tokenizers

    given = []

    class Noted:
        def __init__(self, inner):
            self.inner = inner

        @staticmethod
        def from_str(text):
            return Noted(Tokenizer.from_str(text))

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode_batch_fast(self, texts, **more):
            given.extend(texts)
            return self.inner.encode_batch_fast(texts, **more)

    monkeypatch.setattr(tokenizers, "Tokenizer", Noted)
    monkeypatch.setattr(token_files, "_libraries", {})
    remembered, width = token_files.worker_tokenizer(content)
    one_by_one = lambda parts: [np.array(x.ids, token_files.number_type(width)).tobytes() for x in Tokenizer.from_str(content.decode()).encode_batch_fast(parts, add_special_tokens=False)]
    plain = [f" w{i}é" for i in range(2_500)] + [" été\n\t", " a b", " Ж'll", " !?  "]
    assert remembered(plain) == one_by_one(plain)
    assert len(given) == 3 and not any("<|endoftext|>" in t for t in given)
    odd = list(dict.fromkeys(chunks.distinct(strings(pa.array(random_texts(3000))))[0])) + ["", " x<|endoftext|>", "no blank"]
    assert remembered(odd) == one_by_one(odd)


def test_chunks_cut_at_marks_keep_the_tokens(library):
    """Words with and without a sign are one chunk, and no token is cut."""
    encode, _ = library
    distinct, codes, _ = chunks.distinct(strings(pa.array(["one two, two one.\nTwo é1! é1"])), chunks.MARKS)
    assert distinct == ["one", " two", ",", " one", ".\n", "Two", " é1", "!"] and codes.tolist() == [0, 1, 2, 1, 3, 4, 5, 6, 7, 6]
    draw = random.Random(6)
    letters = [*"a Z9.,;:!?)(-'\n\r\té×÷ЖλßŽ\u0301漢😀\x85\u3000", "\xa0", " ", "\n", ",", ".", "'s", "'ll", "<|endoftext|>", "\x1c"]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 14))) for _ in range(6_000)]
    distinct, codes, starts = chunks.distinct(strings(pa.array(texts)), chunks.MARKS)
    encoded = [encode(c) for c in distinct]
    for text, a, b in zip(texts, starts[:-1], starts[1:], strict=True):
        assert encode(text) == [i for c in codes[a:b] for i in encoded[c]], text


def test_words_are_merged_once_with_and_without_a_sign(spark, content, monkeypatch):
    """Each word, whatever sign follows it, and each sign are encoded once by a round trip."""
    given = []

    class Noted(bpe.Bpe):
        def encode_all(self, texts):
            given.extend(texts)
            return super().encode_all(texts)

    monkeypatch.setattr(bpe, "Bpe", Noted)
    monkeypatch.setattr(bpe, "_encoders", {})
    docs = spark.createDataFrame([(1, "one two, two. two! one")], "doc_id long, text string")
    run = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: run.append(f) or self)
    found = bpe.round_trip(docs, tokenizer_path())
    rows = [r for b in run[0](found.toArrow().to_batches()) for r in b.to_pylist()]
    assert sorted(given) == sorted(["one", " two", " one", ",", ".", "!"])
    assert rows[0]["n_tokens"] == 8


def test_marks_of_a_special_token_are_not_cut_at(spark, tmp_path, content):
    described = json.loads(content)
    described["added_tokens"] = [described["added_tokens"][0] | {"content": "<a.b,c>"}]
    described["model"]["vocab"]["<a.b,c>"] = described["model"]["vocab"].pop("<|endoftext|>", len(described["model"]["vocab"]))
    (tmp_path / "t.json").write_text(json.dumps(described))
    text = "x <a.b,c> y.z<a.b,c>, a.b"
    expected = [*Tokenizer.from_file(str(tmp_path / "t.json")).encode(text, add_special_tokens=False).ids, 0]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = token_files.checksums(docs, str(tmp_path / "t.json")).collect()
    assert row.n_tokens == len(expected) and row.ids_crc32 == zlib.crc32(np.array(expected, "<u4").tobytes())


def test_the_pipeline_stage_remembers_little(spark, monkeypatch):
    """Before, a worker kept 400,000 parts of texts, whatever stage of the pipeline it came from."""
    with open(tokenizer_path(), encoding="utf-8") as f:
        small = bpe.Bpe(f.read(), 100)
    parts = [f"word{i} of {i * 7}" for i in range(2000)]
    ids = [small.encode(p) for p in parts]
    assert len(small.words.young) + len(small.words.old) <= 200
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "CHECKED_BYTES", 64)
    docs = spark.createDataFrame([*enumerate(parts), (None, None), (None, "")], "doc_id long, text string")
    found = bpe.encode_table(docs, tokenizer_path(), check=True).collect()
    assert sorted((r.doc_id, r.ids) for r in found if r.doc_id is not None) == list(enumerate(ids))
    assert [r.ids for r in found if r.doc_id is None] == [[], []]
