import random

from linefold.llm import line_dedup as L
from llm_data import documents, prose


def near(a, b):
    """at most one character inserted, deleted or replaced"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k:] == b[k + 1:] or a[k + 1:] == b[k + 1:]


def brute(rows, min_chars=L.MIN_CHARS):
    places = {}
    for d, t in rows:
        for k, line in enumerate((t or "").split("\n") if t is not None else []):
            if len(line) >= min_chars:
                at = (2 ** 63 if d is None else d, k)
                places[line] = min(at, places.get(line, at))
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None, 0))
            continue
        lines = t.split("\n")
        gone = {k for k, x in enumerate(lines) if x in places and any(
            p < (2 ** 63 if d is None else d, k) if y == x else p < places[x] and near(x, y) for y, p in places.items())}
        out.append((d, "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)))
    return sorted(out, key=str)


def found(docs):
    return sorted(((r["doc_id"], r["text"], r["__removed"]) for r in L.dedup_lines(docs).collect()), key=str)


def edited(line, r):
    k = r.randrange(len(line) + 1)
    return r.choice([line[:k] + "é" + line[k:], line[:max(k - 1, 0)] + line[k:], line[:max(k - 1, 0)] + "Q" + line[k:]])


def test_equals_brute_force(spark):
    r = random.Random(11)
    base = [prose(k, 12, 99).replace("\n", " ") for k in range(8)] + ["é" * 60, "ab" * 30]
    rows = []
    for k in range(60):
        lines = [r.choice(base)]
        for _ in range(3):
            lines.append(edited(r.choice(base), r) if r.random() < 0.7 else edited(edited(r.choice(base), r), r))
        lines += ["short", "", lines[0] if r.random() < 0.2 else "also short"]
        rows.append((r.randrange(1000), "\n".join(lines)))
    rows += [(2000, None), (2001, ""), (2002, "\n"), (None, base[0]), (2003, base[1] + "!"), (2004, prose(99, 3000, 5000)), (2005, prose(99, 3000, 5000)[1:])]
    assert found(documents(spark, rows)) == brute(rows)


def test_edges(spark, edge_docs, no_docs):
    got = L.dedup_lines(edge_docs)
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["__removed"] > 0 and by[-5][0]["__removed"] == 0  # -5 comes first
    assert len(by[2]) == 2 and by[2][0]["text"] == by[2][1]["text"]
    assert by[3][0]["text"] is None and by[4][0]["text"] == "" and by[8][0]["__removed"] == 29  # 30 equal lines and an empty one
    kept = L.keep_unique_lines(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = kept.collect()
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in rows) and {3, 4, 5} <= {r["doc_id"] for r in rows}
    assert L.keep_unique_lines(no_docs).count() == 0


def test_rows_with_equal_id_and_text_are_treated_alike(spark):
    text = prose(1, 40)
    assert {r["__removed"] for r in L.dedup_lines(documents(spark, [(1, text), (1, text)])).collect()} == {0}


def test_lines_of_every_length_are_judged(spark):
    base = prose(5, 20, 99).strip()[:50]
    assert len(base) == 50
    docs = documents(spark, [
        (1, "\n".join(["MIT License.", "}", "ab", " ", "", base])),
        (2, "\n".join(["MIT License.", "}", "{", "abc", " ", "", base[:-1]])),  # 49 characters beside 50
        (3, "\n".join(["MIT Licence.", "a", "\t", "}", "Other.", "Other."])),
    ])
    got = {r["doc_id"]: (r["text"], r["__removed"]) for r in L.dedup_lines(docs).collect()}
    assert got[1] == ("\n".join(["MIT License.", "}", "ab", " ", "", base]), 0)
    assert got[2] == ("\n".join(["{", " ", ""]), 4)
    assert got[3] == ("\n".join(["\t", "Other."]), 4)


def test_short_lines_equal_brute_force(spark):
    r = random.Random(12)
    rows = [(k, "\n".join("".join(r.choice("aéb 1") for _ in range(r.choice([0, 1, 1, 2, 3, 5, 7, 11, 12]))) for _ in range(4))) for k in range(60)]
    places = {}
    for d, t in rows:
        for k, line in enumerate(t.split("\n")):
            if line.strip():
                places[line] = min((d, k), places.get(line, (d, k)))
    same = lambda x, y, at: y != x and at < places[x] and near(x, y) and len(x) + len(y) > 2
    want = []
    for d, t in rows:
        lines = t.split("\n")
        left = [x for k, x in enumerate(lines) if not x.strip() or (places[x] == (d, k) and not any(same(x, y, at) for y, at in places.items()))]
        want.append((d, "\n".join(left), len(lines) - len(left)))
    assert found(documents(spark, rows)) == sorted(want, key=str)
