import random

import numpy as np
import pyarrow as pa

from linefold.llm import repeats as R
from llm_data import EDGES, documents, prose


def brute(rows, length=50):
    first = {}
    texts = [(2 ** 63 - 1 if d is None else d, (t or "").encode()) for d, t in rows]
    for d, t in texts:
        for i in range(len(t) - length + 1):
            s = t[i:i + length]
            first[s] = min(d, first.get(s, d))
    out = []
    for (doc_id, _), (d, t) in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if first[t[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        spans = sum(bool(x) for x in bytes(gone).split(b"\0"))
        out.append((doc_id, len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def found(docs):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in R.remove_repeats(docs).collect()), key=str)


def rows_with_passages():
    r = random.Random(7)
    passage = prose(50, 40)
    rows = []
    for k in range(60):
        text = prose(100 + k, 30)
        at = r.randrange(len(text))
        cut = r.randrange(0, 30)
        rows.append((k * 3 % 61, text[:at] + passage[cut:len(passage) - r.randrange(30)] + text[at:]))
    rows += [(100, rows[0][1]), (101, passage * 3), (102, "ab" * 60), (103, "b" + "ab" * 60), (104, "é" * 40), (105, "x" + "é" * 40)]
    rows += [(106, rows[5][1][:49]), (107, "y" * 49), (108, "y" * 50), (109, "y" * 120), (5, prose(9, 50)), (5, prose(9, 50)), (6, prose(9, 50))]
    return rows


def test_equals_brute_force(spark, monkeypatch):
    rows = rows_with_passages()
    assert found(documents(spark, rows)) == brute(rows)
    # small blocks, and anchors split into single strings
    monkeypatch.setattr(R, "MOST_CONTEXTS", 3)
    monkeypatch.setattr(R, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(R, "SHARD_CONTEXTS", 2)
    assert found(documents(spark, rows)) == brute(rows)


def test_edges(spark, edge_docs, no_docs):
    short = [(i, t) for i, t in EDGES if t is None or len(t) < 100_000]
    assert found(documents(spark, short)) == brute(short)
    got = R.remove_repeats(edge_docs)
    assert got.count() == len(EDGES) and got.columns == ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    assert R.remove_repeats(no_docs).count() == 0


def test_a_very_long_text_of_equal_bytes_is_judged_in_batches(spark, monkeypatch):
    n = 1_000_000
    got = found(documents(spark, [(1, "y" * 60), (2, "y" * n), (3, "z" * n), (4, "a" * 30 + "z" * 70)]))
    assert [x[:4] for x in got] == [(1, 60, 0, 0), (2, n, n, 1), (3, n, 0, 0), (4, 100, 70, 1)] and got[3][4] == b"a" * 30
    monkeypatch.setattr(R, "SOME_PLACES", 7)
    rows = rows_with_passages()
    assert found(documents(spark, rows)) == brute(rows)


def test_shareable_parts_hold_every_shared_string():
    r = random.Random(1)
    some = lambda n: bytes(r.randrange(97, 123) for _ in range(n))
    for _ in range(200):
        gram, left, right = bytes(r.choice(b"ab") for _ in range(R.GRAM)), some(26), some(26)
        texts = []
        for _ in range(8):
            a, b = r.randrange(27), r.randrange(27)
            x, y = some(26 - a) + left[26 - a:], right[:b] + (gram[:26 - b] if r.random() < 0.1 else some(26 - b))
            texts.append((x[r.randrange(26):] if r.random() < 0.3 else x) + gram + (y[:r.randrange(26)] if r.random() < 0.3 else y))
        texts = [t for t in dict.fromkeys(texts) if len(t) >= 50]
        before = np.array([t.find(gram) for t in texts])
        first, last = R.shared_parts(np.array(texts, dtype=object), before, 50)
        for i, t in enumerate(texts):
            for k in range(max(before[i] + R.GRAM - 50, 0), min(before[i], len(t) - 50) + 1):  # strings with the gram at its place
                places = ((u, before[j] - before[i] + k) for j, u in enumerate(texts) if j != i)
                assert first[i] <= k <= last[i] or not any(at >= 0 and u[at:at + 50] == t[k:k + 50] for u, at in places)


def test_every_string_has_one_anchor_that_its_bytes_decide():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 3, 400).astype(np.uint8)
    first, last, at, found = R.anchors(text, 50)
    assert [s for a, b in zip(first, last) for s in range(a, b + 1)] == list(range(351))
    for a, b, p, h in zip(first, last, at, found):
        for s in range(a, b + 1):
            assert [x.tolist() for x in R.anchors(text[s:s + 50].copy(), 50)] == [[0], [0], [p - s], [h]]


def test_texts_hashed_in_a_row_and_in_parts_have_their_own_anchors(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, rng.integers(1, 9), n).astype(np.uint8).tobytes() for n in (50, 51, 300, 50, 3000, 120, 76, 75, 2049, 50)]

    def of_each_string(parts):
        return {(r, s): (p, h) for rows in parts for r, a, b, p, h in zip(*rows) for s in range(a, b + 1)}

    want = of_each_string((np.full(len(x[0]), r), *x) for r, x in enumerate(R.anchors(np.frombuffer(t, np.uint8), 50) for t in texts))
    assert len(want) == sum(len(t) - 49 for t in texts)
    for chunk in (60, 200, 1000, 1 << 15):
        monkeypatch.setattr(R, "CHUNK", chunk)
        assert of_each_string(R.anchors_of(pa.array([b"x", *texts], pa.binary())[1:], 50)) == want
    assert not list(R.anchors_of(pa.array([], pa.binary()), 50))


def test_filter_of_shared_anchors(spark):
    """Every shared anchor has its bit, few others do, also where bits run short."""
    rng = np.random.default_rng(1)
    met = rng.integers(-2 ** 63, 2 ** 63 - 1, 3_000)
    met[:3] = [0, -1, 2 ** 63 - 1]
    table = spark.createDataFrame([(int(x),) for x in met], "anchor bigint")
    others = rng.integers(-2 ** 63, 2 ** 63 - 1, 20_000)
    for most, share in ((R.MOST_BITS, 0.1), (R.BUCKET_BITS, 0.15)):
        bits = R.anchor_filter(table, most)
        assert 8 * len(bits) <= max(most, R.BUCKET_BITS)
        assert R.may_be_in(met, bits).all()
        assert R.may_be_in(others, bits).mean() < share
    assert not R.may_be_in(others, R.anchor_filter(table.limit(0))).any()
