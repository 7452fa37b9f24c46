import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstone.llm import bpe

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def both():
    own = bpe.encoder()
    return own, tiktoken.Encoding("check", pat_str=bpe.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


ODD = ["", " ", "   ", "\x1c\x1d a\x1e", "y\x85y", "a" * 20_000, "ab" * 10_000, "<|endoftext|> hi", "　全角　", "\xa0\xa0x", "😀😀 é̀", "\t\n\r\x0b\x0c z", "١٢٣ ²½ Ⅷ", "don't WE'LL 'S", "᠎​ x", "­﻿q", "\0", "x" + " " * 5000 + "y"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(both, text):
    own, other = both
    assert list(own.encode(text)) == other.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_any_text(both, text):
    own, other = both
    assert list(own.encode(text)) == other.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=127), max_size=200))
def test_any_ascii_text(both, text):
    own, other = both
    assert list(own.encode(text)) == other.encode_ordinary(text)


def test_every_entry_of_the_vocabulary_has_its_slot(both):
    table = both[0].table
    assert sorted(table.lookup(both[0].keys).tolist()) == list(range(table.n)) and table.lookup(both[0].keys).tolist() == list(range(table.n))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000])
def test_perfect_hash_of_any_size(n):
    keys = [f"k{i}".encode() for i in range(n)]
    assert sorted(bpe.PerfectHash(keys).lookup(keys).tolist()) == list(range(n))


def test_merges_agree_with_a_plain_loop(both):
    ranks = both[0].ranks
    rng = random.Random(3)

    def plain(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    for _ in range(300):
        piece = bytes(rng.choice(b"abcdehinorst \xc3\xa9") for _ in range(rng.randrange(1, 40)))
        assert bpe.merge_bytes(piece, ranks) == plain(piece)


def test_long_texts_in_runs_equal_one_run(both, monkeypatch):
    own, other = both
    text = "Some words, 12 of them.\n" * 3000
    monkeypatch.setattr(bpe, "PIECE_CHARS", 100)
    assert list(own.encode(text)) == other.encode_ordinary(text)


def test_memo_stays_bounded(both, monkeypatch):
    own = bpe.Encoder(b"\n".join(__import__("base64").b64encode(bytes([i])) + b" " + str(i).encode() for i in range(256)))
    monkeypatch.setattr(bpe, "MEMO", 10)
    assert [list(own.encode(" ".join(f"w{i}" for i in range(j, j + 8)))) for j in range(50)] and len(own.memo) <= 10


def test_over_spark(spark, both):
    texts = [None, "", "  ", "Plain text.", "Plain text.", "x" * 3000, *ODD]
    df = spark.createDataFrame([(i if i != 3 else None, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)
    got = {r.doc_id: r.ids for r in bpe.encode(df, "doc_id", "text").collect()}
    want = {i if i != 3 else None: ([] if not t else both[1].encode_ordinary(t)) for i, t in enumerate(texts)}
    assert got == want
    assert {r.doc_id: r.n_tokens for r in bpe.lengths(df, "doc_id", "text").collect()} == {k: len(v) for k, v in want.items()}
    assert bpe.encode(df.limit(0), "doc_id", "text").count() == 0


def test_parts_cut_by_text_size():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 10, None, "b" * 25, "", "c", "d" * 9])], names=["k", "t"])
    parts = list(bpe._parts(batch, 20))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(6)) and len(parts) > 1
    assert np.array([p.num_rows for p in bpe._parts(batch.slice(0, 0), 20)]).sum() == 0
