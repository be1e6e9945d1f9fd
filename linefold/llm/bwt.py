"""Burrows-Wheeler transforms of small text collections, and their merge.

A shard's transform is the symbol before each of its suffixes, suffixes in
order. Transforms are merged by refining an interleave: which row of which
shard each row of the merged transform is. It starts from the shards' rows
merged by their first ``SEED`` characters, which each shard has in order; rows
that are equal so far form blocks. A step puts the rows of each block in the
order of the blocks in which their suffixes less one character stand, a place
that the transforms tell (the step from a suffix to the one that is a
character longer, backwards), after which they are in the order of one
character more. Rows alone in their block are decided and rest, so a step
costs what is still undecided. Block edges stay where they are once found, so
the step that finds an edge tells the common prefix there. No suffix is sorted
again, and beyond the seed the texts are not needed.

Symbols are bytes plus one (UTF-8 text has no byte 255), 0 ends a text, and
ends are all different: a suffix equals no shorter one.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


SEED = 24


class Shard(NamedTuple):
    symbols: np.ndarray  # of each suffix in order, the symbol before it
    text: np.ndarray  # of each suffix in order, its text
    start: np.ndarray  # and where it starts
    head: np.ndarray  # its first SEED symbols, the end and what follows as 0


def transform(texts: list[bytes]) -> Shard:
    """The transform of one shard, by sorting its suffixes."""
    size = np.array([len(t) for t in texts])
    width = max(int(size.max()) + 1, SEED)
    cells = np.zeros((len(texts), 2 * width), np.uint8)
    for i, t in enumerate(texts):
        cells[i, :len(t)] = np.frombuffer(t, np.uint8) + 1
    text = np.repeat(np.arange(len(texts)), size + 1)
    start = np.arange(len(text)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    views = np.lib.stride_tricks.sliding_window_view(cells, width, axis=1)
    suffixes = np.ascontiguousarray(views[text, start])
    order = np.argsort(suffixes.view(f"S{width}").ravel(), kind="stable")
    text, start = text[order], start[order]
    symbols = np.where(start > 0, cells[text, np.maximum(start - 1, 0)], 0).astype(np.uint8)
    return Shard(symbols, text, start, suffixes[order, :SEED])


def shorter(shards: list[Shard]) -> np.ndarray:
    """Of each row of the concatenated shards, the row of its suffix less the
    first character; the row itself where that is an end."""
    out, base = [], 0
    for s in shards:
        longer = np.argsort(s.symbols, kind="stable")  # in the order of the suffixes that the symbols make longer
        ends = int(np.count_nonzero(s.symbols == 0))  # nothing is before the start of a text; as many rows are ends
        out += [np.arange(base, base + ends), base + longer[ends:]]
        base += len(s.symbols)
    return np.concatenate(out).astype(np.int32)


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged order of all suffixes, to ``depth`` characters, and common
    prefixes.

    Returns rows (numbers into the concatenated shards) in order, and for each
    the length of its common prefix with the row before, at most ``depth``.
    """
    after = shorter(shards)
    n = len(after)
    # the seed: rows by their heads; a head that holds an end equals no other
    heads = np.concatenate([s.head for s in shards])
    rows = np.argsort(heads.view(f"S{SEED}").ravel(), kind="stable").astype(np.int32)  # merges runs that are in order
    heads = heads[rows]
    other = (heads[1:] != heads[:-1]) | (heads[1:] == 0)
    common = np.append(0, np.where(other.any(axis=1), np.minimum(other.argmax(axis=1), depth), depth)).astype(np.int32)
    edge = np.append(True, other.any(axis=1))
    first = np.flatnonzero(edge)
    block = np.empty(n, np.int32)  # of each row: where its block starts in the merged order
    block[rows] = np.repeat(first, np.diff(np.append(first, n)))
    place = np.flatnonzero(~(edge & np.append(edge[1:], True)))  # of rows not alone in their block
    for step in range(SEED + 1, depth + 1):
        if not len(place):
            break
        mine = rows[place]
        key = block[mine].astype(np.int64) << 32
        key |= block[after[mine]]
        order = np.argsort(key, kind="stable")  # of equal rows those of an earlier shard come first
        mine, key = mine[order], key[order]
        rows[place] = mine
        edge = np.append(True, key[1:] != key[:-1])
        found = place[edge]
        common[found[common[found] == depth]] = step - 1
        block[mine] = found.astype(np.int32)[np.cumsum(edge) - 1]
        place = place[~(edge & np.append(edge[1:], True))]
    return rows.astype(np.int64), common


__all__ = ["Shard", "transform", "shorter", "merge"]
