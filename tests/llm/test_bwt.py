import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from linefold.llm.bwt import merge, transform

TEXT = st.binary(min_size=1, max_size=40).map(lambda b: bytes(b"ab\x00\xc3"[x % 4] for x in b))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(TEXT, min_size=1, max_size=4), min_size=1, max_size=5), st.sampled_from([2, 7, 50]))
def test_merge_orders_suffixes_and_finds_common_prefixes(collections, depth):
    shards = [transform(t) for t in collections]
    rows, common = merge(shards, depth)
    base = np.cumsum([0] + [len(s.symbols) for s in shards])
    assert sorted(rows) == list(range(base[-1]))

    def suffix(r):
        z = np.searchsorted(base, r, side="right") - 1
        return collections[z][shards[z].text[r - base[z]]][shards[z].start[r - base[z]]:]

    for a, b, c in zip(map(suffix, rows), map(suffix, rows[1:]), common[1:]):
        same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert c == min(same, depth) and a[:depth] <= b[:depth]
