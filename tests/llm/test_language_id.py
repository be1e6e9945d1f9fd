import random
import unicodedata
import zlib
from collections import Counter

from linefold.llm import language_id as L
from llm_data import documents

SYLLABLES = {"aa": "ka lo mi tu re san", "bb": "schu ber gen ich wer tön", "cc": "où les ment eau çon ré"}


def text_of(lang, seed, n=40):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang].split()) for _ in range(r.randrange(1, 4))).capitalize() for _ in range(n)) + "."


def plain_counts(text):
    chars = [c if unicodedata.category(c)[0] in "LM" else " " for c in text]
    words = "".join(c.lower() if len(c.lower()) == 1 else c for c in chars).split()
    out = Counter()
    for w in words:
        w = f" {w} "
        for n in (1, 2, 3):
            out.update(g for g in (w[k:k + n] for k in range(len(w) - n + 1)) if g.strip())
    return out


def plain_profile(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:size]]


def code(gram):
    n = 0
    for c in gram:
        n = n << 21 | ord(c)
    return n


def plain_answer(text, learned, size=L.PROFILE):
    if not any(map(str.isalpha, text or "")) or not learned:
        return "und", 0.0
    own = plain_profile(plain_counts(text), size)
    best = min((sum(abs(k - p.index(g)) if g in p else size for k, g in enumerate(own)), lang) for lang, p in learned.items())
    return best[1], (size * len(own) - best[0]) / (size * len(own))


def test_counts_of_any_chunk_equal_a_plain_count():
    r = random.Random(3)
    for k in range(200):
        text = "".join(r.choice("aAbB éÉß1_-\ńİ日\U0001d400\ud800 ") for _ in range(r.randrange(0, 60)))
        want = {code(g): n for g, n in plain_counts(text).items()}
        for chunk in (1, 2, 3, 7, 1000):
            codes, counts = L.gram_counts(text, chunk)
            assert dict(zip(codes.tolist(), counts.tolist())) == want, (text, chunk)
            assert (codes[1:] > codes[:-1]).all()


def test_profile_cuts_ties_by_code():
    import numpy as np
    codes = np.arange(10, 110)
    counts = np.array([1, 5] * 50)
    assert L.profile(codes, counts, 60).tolist() == [*range(11, 110, 2), *range(10, 30, 2)]


def test_equals_brute_force(spark):
    rows = [(k, text_of(lang, k, 3 + k % 30), lang, "s") for k, lang in enumerate(list(SYLLABLES) * 30)]
    rows += [(500, None, "aa", "s"), (501, "", "aa", "s"), (502, "12 34 !?", "bb", "s"), (503, text_of("aa", 1), None, "s"), (None, text_of("bb", 2), "bb", "s"),
             (504, "x", "cc", "s"), (505, text_of("cc", 5), "", "s"), (505, text_of("cc", 5), "", "s"), (506, text_of("aa", 6, 60_000), "aa", "s")]
    held = {k: zlib.crc32(str(k).encode()) % 5 == 0 for k, *_ in rows}
    total = {}
    for k, t, lang, _ in rows:
        if k is not None and not held[k] and lang is not None and t:
            total.setdefault(lang, Counter()).update(plain_counts(t))
    learned = {lang: plain_profile(c, L.PROFILE) for lang, c in total.items() if c}
    got = L.identify(documents(spark, rows), held_out=0, folds=5).collect()
    want = sorted(((k, k is not None and held[k], *plain_answer(t, learned)) for k, t, _, _ in rows), key=str)
    assert sorted(((r["doc_id"], r["held_out"], r["lang_pred"], r["score"]) for r in got), key=str) == want
    judged = [(r["lang_pred"], lang) for r in got for k, _, lang, _ in rows[:90] if r["doc_id"] == k and r["held_out"]]
    assert len(judged) > 8 and all(a == b for a, b in judged)


def test_edges(spark, edge_docs, no_docs):
    got = L.identify(edge_docs, 0, 5).collect()
    assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by[3] == by[4] == by[5] == "und" and by[1] == "en"
    assert {r["lang_pred"] for r in L.identify(edge_docs.withColumn("lang", edge_docs["n_words"].substr(100, 1)).fillna("zz", ["lang"]), 0, 5).collect()} <= {"und", ""}
    assert {r["lang_pred"] for r in L.identify(edge_docs.filter("doc_id IS NULL"), 0, 5).collect()} == {"und"}  # nothing to learn from
    assert L.identify(no_docs, 0, 5).count() == 0


def test_equal_distances_go_to_the_smaller_name_and_few_languages_are_kept(spark):
    import numpy as np
    same = L.Profiles(["bb", "cc"], np.array([97]), np.array([[0, 400], [0, 400]]), 400)
    assert L.judge(same, "a")[0] == "bb"
    rows = [(k, text_of(lang, k), lang, "s") for k, lang in enumerate(["aa"] * 3 + ["bb"] * 2 + ["cc"])]
    assert L.fit(documents(spark, rows), max_languages=2).langs == ["aa", "bb"]
