import functools
import json
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sidelines.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, "Hello, World!! It's the 2nd 'test'...", "a\tb\x0bc\x0c d\r\n\ne\u00a0f\u2003g", "<|endoftext|> x<|startoftext|>y",
         "E\u0301tude \u0130stanbul \u03a3\u03a3 \u1e9e stra\u00dfe", "x" * 5000, "word " * 9000, "né,né. né; (né) né's", "....", "a.b.c",
         "\u0301x y\u0301", "日本語 のテキスト。", "l'été d'or 'S 'LL we'll", "\x1c\x1d x\x1fy"]


@pytest.fixture(scope="module")
def tokenizer():
    return packing.read_tokenizer(PATH)


@functools.cache
def loaded(tokenizer):
    return Tokenizer.from_str(tokenizer)


def expected(tokenizer, text):
    return [*loaded(tokenizer).encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, ids_by_doc, size=2048):
    """Every id lies in exactly one piece, sequences are gapless, and none needs padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(ids_by_doc)
    for doc, ids in ids_by_doc.items():
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            own = ids[at:at + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
            at += p["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == size or at & (at - 1) == 0 and at < size


def test_words_are_tokenized_as_whole_texts_are(tokenizer):
    ids_of = packing.WordIds(tokenizer, most_words=8)
    for _ in range(2):  # the second time from the table
        for text, ids in zip(TEXTS, ids_of([t or "" for t in TEXTS])):
            assert np.frombuffer(ids, "<u4").tolist() == expected(tokenizer, text)[:-1], text


def test_random_texts_are_tokenized_as_whole_texts_are(tokenizer):
    random = np.random.default_rng(5)
    chars = list("aAbBéÉßΣσİ \n\t\x0b.,!?'’-_0123٣½\u0301\u200d漢字<|>\u00a0")
    texts = ["".join(random.choice(chars, random.integers(0, 60))) for _ in range(800)]
    for text, ids in zip(texts, packing.WordIds(tokenizer)(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == expected(tokenizer, text)[:-1], repr(text)


def test_documents_are_packed_whole(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = packing.pack(docs, tokenizer).collect()
    check(pieces, {r["doc_id"]: expected(tokenizer, r["text"]) for r in docs.collect()})


def test_odd_rows_and_columns(spark, tokenizer):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, length string").repartition(2)
    pieces = packing.pack(docs, tokenizer, with_ids=True).collect()
    check(pieces, {i: expected(tokenizer, t) for i, t, _ in rows})
    assert all(len(p["ids"]) == 4 * p["length"] for p in pieces)
    twice = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string").coalesce(1)
    found = packing.pack(twice, tokenizer).collect()
    assert sum(p["length"] for p in found) == 8 and {p["doc_id"] for p in found} == {None}
    assert packing.pack(docs.limit(0), tokenizer).count() == 0


def test_many_small_windows_and_few_open(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("text", F.left("text", F.lit(300)))
    pieces = packing.pack(docs, tokenizer, size=128, most_open=3).collect()
    check(pieces, {r["doc_id"]: expected(tokenizer, r["text"]) for r in docs.collect()}, 128)


def test_pieces_go_where_the_sum_of_squares_is_least():
    random = np.random.default_rng(1)
    windows, size = packing.Windows(20), 20
    for length in random.integers(1, 20, 2000).tolist():
        counts = [len(w) for w in windows.by_level]
        sums = {}
        for level in range(size - length + 1):
            if level == 0 or counts[level]:
                after = list(counts)
                if level:
                    after[level] -= 1
                if level + length < size:
                    after[level + length] += 1
                sums[level] = sum(c * c for c in after[1:])
        windows.place((0, 0, bytes(4 * length), length), length)
        after = [len(w) for w in windows.by_level]
        assert sum(c * c for c in after[1:]) == min(sums.values())
        moved = next((level for level in range(1, size) if after[level] < counts[level]), 0)
        assert moved == max(level for level, s in sums.items() if s == min(sums.values())) or counts == after
        assert windows.n == sum(after) and all(windows.there[i] == bool(after[i]) for i in range(1, size))


def test_whole_documents_are_rarely_cut(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    pieces = packing.pack(docs, tokenizer)
    short = pieces.filter("doc_tokens < 2048")
    assert short.filter("length < doc_tokens").select("doc_id").distinct().count() < 0.1 * short.select("doc_id").distinct().count()


def test_the_vocabulary_marks_ends_of_words(tokenizer):
    assert json.loads(tokenizer)["model"]["end_of_word_suffix"] == "</w>"


def test_the_pipelines_workers_keep_fewer_words(monkeypatch):
    """The words that a worker keeps outlive the stage; in the pipeline other stages need that memory."""
    import corpus_pipeline

    seen = {}
    monkeypatch.setattr(packing, "pack", lambda docs, tokenizer, **more: seen.update(more))
    corpus_pipeline.packed(None, None, "")
    assert seen["most_words"] <= 50_000
    packing.word_ids.cache_clear()
    assert packing.word_ids(packing.read_tokenizer(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")), 7).most_words == 7


def test_words_before_punctuation_are_learned_together(tokenizer, monkeypatch):
    """A word that ends in any letter is learned with others, not by a call of its own, with and without punctuation after it."""
    calls, encode = [], packing.WordIds._encode
    monkeypatch.setattr(packing.WordIds, "_encode", lambda self, text, by=None: calls.append(text) or encode(self, text, by))
    texts = ["viè. ertzß### éonréré. entrée, Ärger! plain, it's; l'été. x9è. 7è!", "é. ́. naïve; straße? ñ", "viè, plain. naïve!", "İ, aİ. ক়! 字, É. ÀÉ!"]
    ids_of = packing.WordIds(tokenizer)
    found = [ids_of([text])[0] for text in texts]
    assert not {"viè.", "viè", "ertzß###", "éonréré.", "entrée,", "naïve;", "straße?"} & set(calls)
    whole = packing.Tokenizer.from_str(tokenizer)
    assert [list(packing.np.frombuffer(f, "<u4")) for f in found] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
