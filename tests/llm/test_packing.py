import random
import zlib
from array import array
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm.packing import _text_ids, _words, best_fit_decreasing, pack_documents, padding
from feedloom.llm.registry import op8_pack, tokenizer_path

SCHEMA = "doc_id long, text string, length string, rank int"


def ids_of(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, window=2048):
    """Pieces tile their documents and sequences without gaps, with the tokenizer's own ids."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids, at = ids_of(text), 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            piece = ids[at : at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(array("I", piece).tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    return len(by_sequence)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    packed = pack_documents(docs, tokenizer_path())
    rows = packed.collect()
    n = check(rows, {r["doc_id"]: r["text"] for r in docs.collect()})
    tokens = sum(r["length"] for r in rows)
    assert n <= tokens / 2048 * 1.02 + 1
    assert padding(packed).agg(F.sum("used")).first()[0] == tokens


def test_odd_rows(spark):
    texts = {1: None, 2: "", 3: " ", 4: "a  b   c \n\n d", 5: "<|endoftext|> x", 6: "é" * 5000, 7: "word " * 9000, 8: "\t a b\n", 9: "x", 10: "x", 11: "a \nb  ", 12: "n b   c", 13: "don't I'll we've"}
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in texts.items()], SCHEMA)
    check(pack_documents(docs, tokenizer_path()).collect(), texts)
    assert pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_blanks_inside_runs_of_white_space(spark):
    texts = {1: "a \u00a0 \u00a0 b", 2: "price: \u00a0 \u00a0 \u00a0 \u00a0 10", 3: "a\u00a0 ", 4: " \u00a0 x", 5: "a\u3000 \u3000b", 6: "a \n \n b\n ", 7: "\u00a0 \u00a0"}
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in texts.items()], SCHEMA)
    check(pack_documents(docs, tokenizer_path()).collect(), texts)


def test_word_wise_ids_are_those_of_the_whole_text():
    from tokenizers import Tokenizer

    rng, words, whole = random.Random(1), _words(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    for _ in range(3000):
        text = "".join(rng.choice("ab1.,'s \u00a0\u00a0 \t\n\r\u2003\x1c") for _ in range(rng.randrange(1, 30)))
        assert list(array("I", _text_ids(text, words))) == whole.encode(text, add_special_tokens=False).ids


def test_registered_queries_give_ids_of_the_plain_call(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = {1: "<|endoftext|> x", 2: "x <|endoftext|>y <|endoftext|>", 3: "a<|endoftext|><|endoftext|>", 4: "plain words", 5: "<|endoftext", 6: "w " * 3000 + "<|endoftext|>", 7: "a \u00a0 \u00a0<|endoftext|>  b"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    whole = Tokenizer.from_file(tokenizer_path())
    stored = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for packed in (op8_pack(spark, str(tmp_path)), corpus_pipeline.packed(spark, stored, str(tmp_path))):
        pieces = {(r["doc_id"], r["start"]): r for r in packed.collect()}
        for doc_id, text in texts.items():
            ids = whole.encode(text, add_special_tokens=False).ids + [1]
            for start in range(0, len(ids), 2048):
                r = pieces.pop((doc_id, start))
                assert r["doc_tokens"] == len(ids)
                assert r["ids_crc32"] == zlib.crc32(array("I", ids[start : start + 2048]).tobytes())
        assert not pieces


def naive(counts, window):
    """One piece after another, longest first, into the fullest window that has room."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [i for i, r in enumerate(rooms) if r >= length]
            if fits:
                rooms[min(fits, key=lambda i: rooms[i])] -= length
            else:
                rooms.append(window - length)
    return sorted(rooms)


@pytest.mark.parametrize("counts", [{5: 3, 4: 7, 3: 9, 1: 2}, {16: 4}, {9: 1, 8: 2, 7: 5, 2: 40}, {1: 100}, {6: 10, 5: 10, 4: 10}, {}])
def test_best_fit_equals_one_by_one(counts):
    rooms, ranks = defaultdict(lambda: 16), defaultdict(list)
    for length, first, pieces, sequence, used, each in best_fit_decreasing(counts, 16):
        for k in range(pieces):
            at = sequence + k // each
            assert used + (k % each) * length == 16 - rooms[at]
            rooms[at] -= length
            ranks[length].append(first + k)
    assert all(sorted(ranks[n]) == list(range(c)) for n, c in counts.items())
    assert sorted(rooms.values()) == naive(counts, 16)
