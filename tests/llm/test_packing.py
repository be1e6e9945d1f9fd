import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpus_pipeline import TOKENIZER
from linefold.llm import packing as P
from linefold.llm.tokens import Encoder
from llm_data import EDGES, documents, prose


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return lambda text: np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


BITS = ["it's", "'s", " ", "  ", "\n", "\n\n", "\t", "a", "Zé", "ß9", "12", "…", "!?", "'ll", "don't", "<|endoftext|>", "\u00a0", "日本", "\U0001f600",
        "\x00", "\x1c", "'", "''re", "İ", "ɐ", "é", "\r\n", "_", "×", "ª", "µ", " x", " 7", "\u0085", "\u2028"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=12))
def test_ids_equal_the_tokenizers(parts):
    e = test_ids_equal_the_tokenizers
    if not hasattr(e, "own"):
        e.own, e.whole = Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
        e.whole.encode_special_tokens = True
    text = "".join(parts)
    assert np.frombuffer(e.own.encode(text), "<u4").tolist() == e.whole.encode(text, add_special_tokens=False).ids


def placed(histogram, runs):
    """sequence -> (offset, length) of all pieces"""
    out = defaultdict(list)
    for length, n in histogram.items():
        own = runs[runs[:, 0] == length]
        for rank in range(n):
            _, first, each, seq, at = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            out[int(seq + (rank - first) // each)].append((int(at + (rank - first) % each * length), length))
    return out


def gapless(sequences, capacity):
    for pieces in sequences.values():
        end = 0
        for at, length in sorted(pieces):
            assert at == end
            end += length
        assert end <= capacity


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20), st.sampled_from([1, 3, 4096]))
def test_plan_places_every_piece_once(histogram, groups):
    found = placed(histogram, P.plan(histogram, 64, groups))
    assert sum(map(len, found.values())) == sum(histogram.values())
    gapless(found, 64)


def test_plan_is_near_the_lower_bound():
    x = np.minimum(2047, np.exp(np.random.default_rng(1).normal(6.7, 0.8, 30_000)).astype(int))
    histogram = {int(a): int(b) for a, b in zip(*np.unique(x, return_counts=True))}
    assert len(placed(histogram, P.plan(histogram, 2048))) <= 1.005 * x.sum() / 2048 + 1


def test_pack(spark, edge_docs, no_docs, reference):
    got = [tuple(r) for r in P.pack(edge_docs, TOKENIZER, capacity=2048).collect()]
    want = []
    for doc_id, text in EDGES:
        ids = reference(text or "") + b"\0\0\0\0"
        n = len(ids) // 4
        cuts = [0, *range(n % 2048 or 2048, n + 1, 2048)]
        want += [(doc_id, k, s, e - s, zlib.crc32(ids[4 * s:4 * e])) for k, (s, e) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((r[:5] for r in got), key=key) == sorted(want, key=key)
    sequences = defaultdict(list)
    for r in got:
        sequences[r[5]].append((r[6], r[3]))
    gapless(sequences, 2048)
    assert P.pack(no_docs, TOKENIZER, capacity=2048).count() == 0


def test_a_hot_length_is_ranked_in_salted_groups(spark, monkeypatch):
    monkeypatch.setattr(P, "RANKED_TOGETHER", 7)
    rows = P.pack(documents(spark, [(k, prose(1, 30)) for k in range(100)]), TOKENIZER, capacity=256).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    gapless(sequences, 256)
    assert sum(map(len, sequences.values())) == 100 and len(sequences) == -(-100 // (256 // rows[0]["length"]))


def test_strings_of_added_tokens_get_the_plain_calls_ids(spark):
    plain = Tokenizer.from_file(TOKENIZER)
    texts = ["a<|endoftext|> b", "<|endoftext|>", "one\n<|endoftext|>\u00a0two " + prose(1, 30), "<|endoftext| >", prose(2, 30)]
    assert 50256 in plain.encode(texts[0], add_special_tokens=False).ids
    want = []
    for k, text in enumerate(texts):
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want.append((k, 0, 0, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(tuple(r)[:5] for r in P.pack(documents(spark, list(enumerate(texts))), TOKENIZER, capacity=2048).collect()) == want
