"""The pipeline against a plain version of its five stages."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from linefold.llm import simhash
from linefold.llm.textstats import word_counts
from llm_data import DOCS, documents, prose
from test_line_dedup import brute as brute_lines
from test_packing import gapless
from test_simhash import brute as brute_groups


def corpus():
    r = random.Random(3)
    rows = [(k, prose(k, 40 + k % 60, 9), r.choice(["en", "de"]), r.choice(["a", "a", "a", "b", None])) for k in range(150)]
    shared = prose(999, 18, 99).strip()
    rows += [(200 + k, prose(k, 40 + k % 60, 9), "en", "b") for k in range(5)]  # exact copies
    rows += [(210 + k, rows[k][1].replace("the", "tha", 1), "en", "a") for k in range(20, 40)]  # near copies
    rows += [(300 + k, shared + "\n" + prose(500 + k, 60, 9), "en", "b") for k in range(6)]  # a shared line
    rows += [(400 + k, prose(600 + k, 60).replace(" ", " | "), "en", "a") for k in range(6)]  # marks
    rows += [(500, "few words", "en", "a"), (501, None, "en", "a"), (502, "", None, None), (503, "again and again " * 40, "en", "a"),
             (504, prose(700, 4000, 9), "de", "b"), (None, prose(800, 90, 9), "en", "a")]
    return rows


def brute_rules(rows):
    base = math.log(1.01 / 0.99)
    counts = [word_counts((t or "").encode()) for _, t, _, _ in rows]
    fine = [n >= 20 and 100 * rep <= 30 * n for n, _, _, _, rep, _ in counts]
    stats = [(c / n, s / n, d / k) if ok else None for (n, c, s, d, _, k), ok in zip(counts, fine)]

    def quantile(values, q):
        buckets = Counter(math.ceil(math.log(v) / base) if v >= 1e-6 else -math.inf for v in values)
        left = q * len(values)
        for b in sorted(buckets):
            left -= buckets[b]
            if left <= 0:
                return 0.0 if b == -math.inf else 2 * (1.01 / 0.99) ** b / (1.01 / 0.99 + 1)

    def group(row, size):
        levels = ([i for i, o in enumerate(rows) if fine[i] and o[2:] == row[2:]], [i for i, o in enumerate(rows) if fine[i] and o[2] == row[2]],
                  [i for i in range(len(rows)) if fine[i]])
        return next((x for x in levels if len(x) >= size), levels[-1])

    out = []
    for i, row in enumerate(rows):
        if fine[i]:
            own = group(row, 100)
            inside = True
            for k, (least, low) in enumerate(((0.1, True), (0.02, False), (0.05, False))):
                q1, q2, q3 = (quantile([stats[j][k] for j in own], q) for q in (0.25, 0.5, 0.75))
                reach = 8 * max(q3 - q1, least)
                inside &= stats[i][k] <= q2 + reach and (not low or stats[i][k] >= q2 - reach)
            if inside:
                out.append(row)
    return out


def brute_line_stage(rows):
    left = defaultdict(list)
    for d, text, gone in brute_lines([r[:2] for r in rows]):
        left[d].append((text, gone))
    out = []
    for d, _, lang, source in rows:
        (text, gone), = left[d]
        if not gone or text.strip():
            out.append((d, text, lang, source))
    return out


def brute_near(rows):
    prints = [simhash.fingerprint((t or "").encode(), 3) for _, t, _, _ in rows]
    groups = brute_groups([(2 ** 62 if d is None else d, f) for (d, *_), f in zip(rows, prints)])
    return [r for r, f in zip(rows, prints) if groups[f] == (2 ** 62 if r[0] is None else r[0])]


def brute_mix(rows, limit):
    tokens = [-(-len((t or "").encode()) // 4) + 1 for _, t, _, _ in rows]
    total, number = Counter(), Counter(s for *_, s in rows)
    for (*_, s), n in zip(rows, tokens):
        total[s] += n
    high, low = max(total.values()), min(total.values())
    a = max(0.0, 1 - math.log(limit) / math.log(high / low))
    md5 = lambda *x: hashlib.md5("/".join(x).encode()).hexdigest()
    out = []
    for s in total:
        budget = int((total[s] / high) ** a * high + 1e-3)
        whole, part = divmod(budget, total[s])
        blocks = math.ceil(math.sqrt(number[s]))
        by = defaultdict(list)
        for r, n in zip(rows, tokens):
            if r[3] == s:
                h = md5("0", "" if r[0] is None else str(r[0]))
                by[int(h[:7], 16) % blocks].append((h, n, r))
        for b in sorted(by, key=lambda b: md5("0", s or "", str(b))):
            size = sum(n for _, n, _ in by[b])
            used = 0
            for _, n, r in sorted(by[b], key=lambda x: x[:2]):
                used += n
                out += [r] * (whole + (size <= part or used <= part))
            part = max(part - size, 0) if size <= part else 0
    return out


def test_stages_equal_the_plain_version(spark, tmp_path):
    rows = corpus()
    docs = documents(spark, rows).withColumn("kept", F.lit("own column"))
    want, steps = rows, {0: brute_rules, 1: brute_line_stage, 2: brute_near, 3: lambda x: brute_mix(x, P.MAX_REPEATS)}
    key = lambda r: tuple((x is None, x) for x in r)
    for k, (name, stage) in enumerate(P.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, "").write.parquet(path)
        got = spark.read.parquet(path)
        if k == 4:
            break
        want = steps[k](want)
        assert got.columns == docs.columns
        assert sorted(((r["doc_id"], r["text"], r["lang"], r["source"]) for r in got.collect()), key=key) == sorted(want, key=key), name
        docs = got
    ids = Tokenizer.from_file(P.TOKENIZER)
    pieces, sequences = Counter(), defaultdict(list)
    for d, text, *_ in want:
        x = np.array(ids.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        cuts = [0, *range((len(x) - 1) % 2048 + 1, len(x) + 1, 2048)]
        pieces.update((d, n, s, e - s, zlib.crc32(x[s:e].tobytes())) for n, (s, e) in enumerate(zip(cuts, cuts[1:])))
    rows = got.collect()
    assert Counter(tuple(r)[:5] for r in rows) == pieces
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    gapless(sequences, 2048)


def test_an_empty_table_runs_through(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    out = P.run(spark, str(tmp_path))
    assert out.count() == 0 and "sequence_id" in out.columns
    assert [len(x) for x in P.STAGES] == [2] * 5 and P.ORACLE_SQL is None
