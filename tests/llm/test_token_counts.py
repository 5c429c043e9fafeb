"""Token counts against the tokenizers library on whole texts."""

import json
import random
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from partwise.llm import queries, token_counts
from tokenizers import Tokenizer

FILE = P.path("byte_bpe_50k.json")
JSON = Path(FILE).read_text(encoding="utf-8")
#: Letters, numbers, marks, blanks of several kinds, characters that Unicode versions class differently, contractions, special tokens.
ODD = [*"abst'revlmd' \t\n\r  '!?1²٣é日́\u3000\u00a0\x85\u2028sA<|>", "<|endoftext|>", " 's", "'ll", "'re", "\U0001f600", "\u2009", "\u200b", "\u0558", "\u088f", "\x00", "\x1c"]


def library(texts, special_as_text=False):
    tokenizer = Tokenizer.from_str(JSON)
    tokenizer.encode_special_tokens = special_as_text
    return [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("special_as_text", [False, True])
def test_every_cut_is_the_library_s(special_as_text):
    rng = random.Random(11)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(6000)]
    table = token_counts.LengthTable([b" a", b"'s"], [1, 1])
    found = token_counts.Counter(token_counts.Cutter(JSON, special_as_text), table).texts(pa.array(texts))
    assert found.tolist() == library(texts, special_as_text)


def test_texts_longer_than_a_slab_are_cut_where_no_token_runs_over(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(3000)), "x" * 5000, " " * 3000 + "end", None, "", "a b " * 2000 + "<|endoftext|>" * 50, "<|endoftext|>" * 300]
    monkeypatch.setattr(token_counts, "_SLAB", 64)
    small = lambda raw, at, most=64: slabs(raw, at, 64)
    slabs = token_counts.slabs
    monkeypatch.setattr(token_counts, "slabs", small)
    counter = token_counts.Counter(token_counts.Cutter(JSON), token_counts.LengthTable([], []))
    assert counter.texts(pa.array(texts)).tolist() == library(texts)


def test_length_table_finds_its_keys_and_nothing_else():
    keys = [b"w%d" % i for i in range(5000)] + [b" ", b"\xc3\xa9"]
    table = token_counts.LengthTable(keys, list(range(len(keys))))
    asked = pa.array([*keys, b"w5000", b"w", b"w1 "], pa.large_binary())
    assert table.find(asked).tolist() == [*range(len(keys)), -1, -1, -1]
    assert token_counts.LengthTable([], []).find(asked).tolist() == [-1] * len(asked)


def test_what_the_table_holds_is_not_encoded_again():
    texts = pa.array([" common word" * 50, "rare thing"])
    cutter = token_counts.Cutter(JSON)
    words = [b" common", b" word"]
    counter = token_counts.Counter(cutter, token_counts.LengthTable(words, cutter.counts(words)))
    assert counter.texts(texts).tolist() == library(texts.to_pylist())
    assert counter.encoded == 2 and counter.texts(texts).tolist() == library(texts.to_pylist()) and counter.encoded == 2


def test_rows_of_any_kind(spark):
    rows = [(1, "It's 12 o'clock, isn't it?", "x"), (2, None, "x"), (3, "", "x"), (None, "no id", "x"), (1, "It's 12 o'clock, isn't it?", "x"), (4, "word " * 600, None), (5, "a<|endoftext|>b", "x"), (6, "日本語 ñ" * 100_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = sorted(map(tuple, token_counts.count_tokens(docs, FILE).collect()), key=str)
    want = [(i, len((t or "").encode()), n, n > 512) for (i, t, _), n in zip(rows, library([r[1] for r in rows]))]
    assert found == sorted(want, key=str)
    without_table = token_counts.count_tokens(docs, FILE, table_rows=0)
    assert sorted(map(tuple, without_table.collect()), key=str) == found
    assert token_counts.count_tokens(docs.limit(0), FILE).collect() == []


def test_frequent_table_is_bounded_and_right(spark):
    docs = spark.createDataFrame([(i, f"the cat{i % 7} sat") for i in range(300)], "doc_id long, text string")
    table = token_counts.frequent(docs.repartition(3), JSON, size=40)
    assert 3 <= len(table.keys) <= 40 and {b"the", b" cat", b" sat"} <= set(table.keys.to_pylist())
    assert table.lengths.tolist() == token_counts.Cutter(JSON).counts(table.keys.to_pylist())


def test_files_of_another_kind_are_refused():
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        with pytest.raises(ValueError):
            token_counts.Cutter(json.dumps(json.loads(JSON) | change))


def test_query_over_the_whole_table(spark, sf_small):
    found = {r.doc_id: r for r in queries.op13_token_counts(spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    n = library([d.text for d in docs])
    assert len(found) == len(docs)
    assert all((found[d.doc_id].n_tokens, found[d.doc_id].n_bytes, found[d.doc_id].over_limit) == (k, len((d.text or "").encode()), k > 512) for d, k in zip(docs, n))
    assert np.sum(n) == sum(r.n_tokens for r in found.values())
