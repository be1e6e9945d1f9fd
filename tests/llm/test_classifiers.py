import math
import random
import re
import zlib

import numpy as np

from linefold.llm import quality_classifier as C
from linefold.llm import toxicity as X
from llm_data import documents, prose


def accuracy(rows, truth):
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 20
    return sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held)


def test_quality(spark):
    r = random.Random(0)
    rows, truth = [], {}
    for k in range(240):
        bad = r.random() < 0.3
        text = prose(k, 60 + k % 80)
        rows.append((k, text.replace(" ", r.choice([" | ", "%%% "])) if bad else text))
        truth[k] = int(not bad)
    labels = spark.createDataFrame([(k, y) for k, y in truth.items()], "doc_id bigint, quality int")
    got = C.classify(documents(spark, rows), labels, held_out=0, folds=5).collect()
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0) for x in got)
    assert accuracy(got, truth) > 0.97
    # held-out labels have no part in the scores
    other = spark.createDataFrame([(k, 1 - y if zlib.crc32(str(k).encode()) % 5 == 0 else y) for k, y in truth.items()], "doc_id bigint, quality int")
    again = C.classify(documents(spark, rows), other, held_out=0, folds=5).collect()
    assert {x["doc_id"]: round(x["score"], 9) for x in got} == {x["doc_id"]: round(x["score"], 9) for x in again}


def test_toxicity_finds_documents_and_sentences(spark):
    r = random.Random(1)
    rows, truth, where = [], {}, {}
    for k in range(300):
        parts = [prose(1000 * k + j, 8).strip().replace("\n", " ") for j in range(6)]
        truth[k] = int(r.random() < 0.3)
        if truth[k]:
            at = r.randrange(6)
            parts[at] = "You are a " + r.choice(["vilekin", "vilesome", "grotmuck"]) + " and such."
            where[k] = parts[at]
        rows.append((k, "\n".join(parts)))
    labels = spark.createDataFrame(list(truth.items()), "doc_id bigint, toxic int")
    got = X.detect(documents(spark, rows), labels, held_out=1, folds=3).collect()
    assert accuracy(got, truth) > 0.97
    texts = dict(rows)
    for x in got:
        if x["predicted"]:
            best = max(x["sentences"], key=lambda s: s["score"])
            assert texts[x["doc_id"]].encode()[best["start"]:best["end"]].decode().strip() in where[x["doc_id"]]


def test_quality_equals_a_plain_discriminant(spark):
    r = random.Random(5)
    rows, truth = [], {}
    for k in range(120):
        words = [r.choice(["the", "of", "Longer", "x|y", "12", "end."]) for _ in range(r.randrange(1, 90))]
        rows.append((k, " ".join(words) + ("\n" + " ".join(words) if k % 4 == 0 else "")))
        truth[k] = int(r.random() < (0.8 if k % 4 else 0.3))
    labels = spark.createDataFrame(list(truth.items()), "doc_id bigint, quality int")
    got = {x["doc_id"]: x["score"] for x in C.classify(documents(spark, rows), labels, held_out=0, folds=5).collect()}

    f = np.array([C.features(t.encode()) for _, t in rows])
    y = np.array([truth[k] for k, _ in rows])
    train = np.array([zlib.crc32(str(k).encode()) % 5 != 0 for k, _ in rows])
    shift, scale = f[train].mean(axis=0), np.sqrt(np.maximum(f[train].var(axis=0), 1e-12))
    z = (f - shift) / scale
    density = []
    for c in (0, 1):
        own = z[train & (y == c)]
        cov = np.cov(own.T, bias=True)
        cov = (1 - C.SHRINKAGE) * cov + C.SHRINKAGE * np.trace(cov) / len(cov) * np.eye(len(cov))
        away = z - own.mean(axis=0)
        far = np.einsum("ij,ij->i", away, np.linalg.solve(cov, away.T).T)
        density.append(np.log((train & (y == c)).sum() / train.sum()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * far)
    want = 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))
    assert np.allclose([got[k] for k, _ in rows], want, atol=1e-6)


def test_toxicity_equals_a_plain_noisy_or(spark, monkeypatch):
    monkeypatch.setattr(X, "STEPS", 40)
    monkeypatch.setattr(X.train_noisy_or, "__defaults__", (40,))
    r = random.Random(9)
    rows, truth = [], {}
    for k in range(90):
        parts = [" ".join(r.choice(["the", "plain", "wordy", "of", "other"]) for _ in range(r.randrange(1, 5))) for _ in range(r.randrange(1, 4))]
        truth[k] = int(r.random() < 0.4)
        if truth[k]:
            parts[0] += " " + r.choice(["vile", "vilest", "grot"])
        rows.append((k, ". ".join(parts)))
    labels = spark.createDataFrame(list(truth.items()), "doc_id bigint, toxic int")
    got = {x["doc_id"]: x["score"] for x in X.detect(documents(spark, rows), labels, held_out=1, folds=3).collect()}

    def bags(text):  # features of each sentence with a word, a feature as often as words have it
        out = []
        for s in re.split(r"[.!?\n]+", text.lower()):
            words = set(re.findall(r"[a-z]+", s))
            if words:
                out.append([f for w in words for f in ["=" + w, *(w[:n] for n in X.BEGINNINGS if n < len(w))]])
        return out

    learned, seen = [], set()
    for k, t in rows:  # equal texts are one row of the sample, labelled by their majority
        if zlib.crc32(str(k).encode()) % 3 != 1 and t not in seen:
            seen.add(t)
            same = [truth[i] for i, u in rows if u == t and zlib.crc32(str(i).encode()) % 3 != 1]
            learned.append((bags(t), int(2 * sum(same) >= len(same))))
    n1 = sum(y for _, y in learned)
    n0 = len(learned) - n1
    docs_with = {}
    for b, y in learned:
        for f in {f for s in b for f in s}:
            docs_with.setdefault(f, []).append(y)
    known = [f for f, ys in docs_with.items() if len(ys) >= X.MIN_DOCS]
    assert len(known) <= X.VOCABULARY  # all of them are in the model
    w, bias = dict.fromkeys(known, 0.0), -4.0
    m, v = dict.fromkeys([*known, None], 0.0), dict.fromkeys([*known, None], 0.0)
    for step in range(1, 41):
        grad = {f: X.RIDGE * w[f] for f in known} | {None: 0.0}
        for b, y in learned:
            p = [1 / (1 + math.exp(-bias - sum(w.get(f, 0.0) for f in s))) for s in b]
            none = math.prod(1 - q for q in p)  # no sentence is toxic
            pull = (-none / (1 - none) if y else 1.0) / len(learned)
            for q, s in zip(p, b):
                grad[None] += pull * q
                for f in s:
                    if f in w:
                        grad[f] += pull * q
        for f, x in grad.items():
            m[f], v[f] = 0.9 * m[f] + 0.1 * x, 0.999 * v[f] + 0.001 * x * x
            move = X.RATE * (m[f] / (1 - 0.9 ** step)) / (math.sqrt(v[f] / (1 - 0.999 ** step)) + 1e-8)
            if f is None:
                bias -= move
            else:
                w[f] -= move
    for k, t in rows:
        want = 1 - math.prod(1 - 1 / (1 + math.exp(-bias - sum(w.get(f, 0.0) for f in s))) for s in bags(t))
        assert abs(got[k] - want) < 1e-6
    assert n0 and n1


def test_edges(spark, edge_docs, no_docs, labels):
    for run in (lambda d, y: C.classify(d, y, 0, 5), lambda d, y: X.detect(d, y, 1, 3)):
        got = run(edge_docs, labels).collect()
        assert len(got) == edge_docs.count()
        assert all(0 <= r["score"] <= 1 and r["held_out"] is not None and r["predicted"] in (0, 1) for r in got)
        one_class = run(edge_docs, labels.filter("quality = 1 and toxic = 1")).collect()
        assert {r["score"] for r in one_class} <= {0.0, 1.0, 0.5}
        none = run(edge_docs, labels.filter("doc_id < -99")).collect()
        assert len({r["score"] for r in none}) == 1
        assert run(no_docs, labels).count() == 0
