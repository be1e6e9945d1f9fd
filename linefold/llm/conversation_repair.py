"""Conversation repair: the cheapest edits that make roles alternate.

A conversation's rows, in order of turn (nulls first, then role, then text),
are to read ``(s?(ua)+)?`` by the initials of their roles. Keep costs nothing,
Rerole to user or assistant 2, Delete 3, Insert of an empty user or assistant
row 2; blank and repeated rows must go, and a truncated row that stays adds 1.
Rows and the four states of the pattern (nothing yet, after the system row,
after a user row, after an assistant row) span a lattice; Dijkstra's algorithm
runs on it from both ends at once, on one heap each, until the two frontiers
together exceed the best crossing, so that every crossing of that cost has been
seen; of equal costs the least edit string is taken (D < I < K < R).

A conversation may be of any length: the rows are range partitioned and sorted
by (conversation, turn, ...), numbered, and cut into blocks of at most
``BLOCK`` numbers. Each block is solved on its own: one search for a
conversation of one block (nearly all are), else one from each state to each
state. In a block that another follows, a path ends with an edit of a row;
rows inserted after it belong to the next block. Two such paths from one state
read the same rows, so neither edit string begins with the other, and which is
less is decided within the block: what links the blocks of a conversation are
only costs and ranks, 16 numbers each. Repeats are found by an aggregate of
first places per (conversation, role, hash of the text).

Nulls and edge cases: a null role or text counts as one space (a null text is
blank), null turns come first, rows with a null conversation id are one
conversation, a role other than s..., u... or a... cannot be kept. Among rows
of one turn the order is role, text (first 64 characters, then md5). Equal rows
are repeats of the first. Empty tables give empty results. Other columns are
not read. Texts are never cut; the digest reads a conversation as a stream.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import written

BLOCK = 1024
WHITE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
RULES = {"K": 0, "R": 2, "D": 3, "I": 2}  # costs
TRUNCATED = 1
# states: 0 nothing yet, 1 after the system row, 2 after user, 3 after assistant
FRESH = {0: 2, 1: 2, 2: 3, 3: 2}  # a user or assistant row, whichever the state asks for
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NAMES = {2: "user", 3: "assistant"}
ACCEPT = (0, 3)


def steps_from(rows: str, last: bool, i: int, q: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges out of (i, q): cost, edit, node. ``rows`` holds two characters a
    row: its initial and x (must go), t (truncated) or a point."""
    n = len(rows) // 2
    if i < n or last:
        yield RULES["I"], "I", i, FRESH[q]
    if i < n:
        initial, state = rows[2 * i], rows[2 * i + 1]
        yield RULES["D"], "D", i + 1, q
        if state != "x":
            extra = TRUNCATED * (state == "t")
            if q in KEPT.get(initial, ()):
                yield RULES["K"] + extra, "K", i + 1, KEPT[initial][q]
            yield RULES["R"] + extra, "R", i + 1, FRESH[q]


def steps_to(rows: str, last: bool, i: int, q: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges into (i, q): cost, edit, node they come from."""
    for p in FRESH:
        if FRESH[p] == q and (2 * i < len(rows) or last):
            yield RULES["I"], "I", i, p
    if i:
        initial, state = rows[2 * i - 2], rows[2 * i - 1]
        yield RULES["D"], "D", i - 1, q
        if state != "x":
            extra = TRUNCATED * (state == "t")
            for p in FRESH:
                if KEPT.get(initial, {}).get(p) == q:
                    yield RULES["K"] + extra, "K", i - 1, p
                if FRESH[p] == q:
                    yield RULES["R"] + extra, "R", i - 1, p


def meet(rows: str, start: int, ends: tuple[int, ...], last: bool) -> tuple[int, str] | None:
    """Cost and edit string of the best path from state ``start`` before the
    rows to one of ``ends`` after them; None if there is none.

    At equal cost nodes are settled in order of their distance from the end
    they are searched from, so an edge without cost is followed before the node
    it leads to is settled, and labels of a node are final when it is.
    """
    n = len(rows) // 2
    ahead, back = [(0, 0, "", start)], [(0, 0, "", q) for q in ends]
    done_ahead: dict[tuple[int, int], tuple[int, str]] = {}
    done_back: dict[tuple[int, int], tuple[int, str]] = {}
    best: tuple[int, str] | None = None
    while ahead or back:
        a, b = ahead[0][0] if ahead else 0, back[0][0] if back else 0
        if best is not None and a + b > best[0]:
            break
        forward = bool(ahead) and (not back or a <= b)
        cost, far, edits, q = heapq.heappop(ahead if forward else back)
        i = far if forward else n - far
        done, other = (done_ahead, done_back) if forward else (done_back, done_ahead)
        if (i, q) in done:
            continue
        done[i, q] = cost, edits
        for w, edit, j, p in (steps_from if forward else steps_to)(rows, last, i, q):
            if forward:
                heapq.heappush(ahead, (cost + w, j, edits + edit, p))
            else:
                heapq.heappush(back, (cost + w, n - j, edit + edits, p))
            if (j, p) in other:
                rest, tail = other[j, p]
                whole = (cost + w + rest, edits + edit + tail if forward else tail + edit + edits)
                best = whole if best is None else min(best, whole)
    return best


@lru_cache(maxsize=1 << 15)
def solve(rows: str, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, edits) of a block, per state before in
    order of the edits; after the last row the state is 0 by convention."""
    out = []
    for start in (0,) if first else FRESH:
        found = [(q, meet(rows, start, ends, last)) for q, ends in ([(0, ACCEPT)] if last else [(q, (q,)) for q in FRESH])]
        out += sorted(((start, q, *x) for q, x in found if x), key=lambda x: x[3])
    return out


class Links:
    """Which path of each block of a conversation to take, the last block
    first. Keeps a number and four pairs of bytes a block."""

    def __init__(self) -> None:
        self.cost, self.blocks, self.choices = {0: 0}, array("q"), bytearray()

    def add(self, block: int, paths: list[tuple[int, int, int]]) -> None:
        """``paths``: (before, after, cost), per state before in order of rank."""
        best: dict[int, tuple[int, int]] = {}
        choice = bytearray(8)
        for rank, (p, q, c) in enumerate(paths):
            if q in self.cost and (p not in best or (c + self.cost[q], rank) < best[p]):
                best[p] = c + self.cost[q], rank
                choice[2 * p:2 * p + 2] = bytes((rank, q))
        self.cost = {p: x[0] for p, x in best.items()}
        self.blocks.append(block)
        self.choices += choice

    def taken(self) -> Iterator[tuple[int, int]]:
        """(block, rank) from the first block on."""
        q = 0
        for k in reversed(range(len(self.blocks))):
            rank, q = self.choices[8 * k + 2 * q], self.choices[8 * k + 2 * q + 1]
            yield self.blocks[k], rank


def pieces(rows: str, start: int, edits: str) -> list[list[tuple[str, str | None]]]:
    """Per row the edits that end with its own, each with the role it gives (no
    role for Keep and Delete). Rows inserted at the end go with the last row."""
    out: list[list[tuple[str, str | None]]] = [[]]
    i, q = 0, start
    for e in edits:
        if out[-1] and out[-1][-1][0] != "I" and i < len(rows) // 2:
            out.append([])
        q = FRESH[q] if e in "IR" else KEPT[rows[2 * i]][q] if e == "K" else q
        out[-1].append((e, NAMES[q] if e in "IR" else None))
        i += e != "I"
    return out


def numbered(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows in order, with their number ``at``: written, so that it is fixed."""
    r = rows.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                    F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    r = r.select("*", F.left("role", F.lit(64)).alias("k1"), F.left("text", F.lit(64)).alias("k2"), F.md5(F.col("text").cast("binary")).alias("h"))
    keys = ["conv", "turn", "k1", "k2", "h"]
    ordered = r.repartitionByRange(*keys).sortWithinPartitions(*keys)
    tail = F.rtrim("text", F.lit(WHITE))
    return written(ordered.select("conv", "turn", "role", "text", "h", F.monotonically_increasing_id().alias("at"), (tail == "").alias("blank"),
                                  (~F.right(tail, F.lit(1)).isin(*ENDS)).alias("truncated")), "conversation-rows")


def blocks_of(rows: DataFrame) -> DataFrame:
    """(conv, block, at0, first, last, rows): the block's rows as ``solve``
    reads them. At most ``BLOCK`` rows in one."""
    firsts = rows.groupBy("conv", "role", "h").agg(F.min("at").alias("at")).select("at", F.lit(False).alias("again"))
    state = F.when(F.col("blank") | F.coalesce(F.col("again"), F.lit(True)), "x").when(F.col("truncated"), "t").otherwise(".")
    initial = F.left("role", F.lit(1))
    coded = rows.select("conv", "at", "blank", "truncated", "role").join(firsts, "at", "left").select(
        "conv", "at", F.concat(F.when(initial.isin(*KEPT), initial).otherwise("-"), state).alias("code"))
    block = F.expr(f"at div {BLOCK}")
    made = coded.groupBy("conv", block.alias("block")).agg(F.min("at").alias("at0"), F.sort_array(F.collect_list(F.struct("at", "code"))).alias("rows"))
    made = made.withColumn("rows", F.array_join(F.col("rows.code"), ""))
    ends = made.groupBy("conv").agg(F.min("block").alias("b0"), F.max("block").alias("b1"))
    ends = ends.withColumnRenamed("conv", "conv_of")
    return made.join(ends, F.col("conv").eqNullSafe(F.col("conv_of"))).select(
        "conv", "block", "at0", "rows", (F.col("block") == F.col("b0")).alias("first"), (F.col("block") == F.col("b1")).alias("last"))


def solved(blocks: DataFrame) -> DataFrame:
    """Blocks with ``paths``: array of (before, after, cost, edits)."""
    paths = "array<struct<p:int,q:int,cost:bigint,edits:string>>"
    schema = blocks.select("*", F.lit(None).cast(paths).alias("paths")).schema
    kind = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))
    places = [blocks.columns.index(c) for c in ("rows", "first", "last")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[dict(zip(("p", "q", "cost", "edits"), x)) for x in solve(*r)] for r in zip(*(b.column(k).to_pylist() for k in places))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, kind)], names=schema.names)

    return blocks.mapInArrow(run, schema)


def python_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as Python values, a slice at a time."""
    for b in batches:
        for at in range(0, b.num_rows, 256):
            yield from b.slice(at, 256).to_pylist()


def in_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while part := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(part, schema=schema)


def by_conversation(df: DataFrame, work: Callable[[Iterator[dict]], Iterator[dict]], fields: list[tuple[str, pa.DataType]], *order: str | Column) -> DataFrame:
    """``work`` on the rows of ``df``, those of a conversation one after the
    other in ``order``, as a stream; its dicts hold ``conv`` and ``fields``."""
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string"}
    schema = df.select("conv", *[F.lit(None).cast(names[t]).alias(c) for c, t in fields]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = next(batches, None)
        if head is not None:
            yield from in_batches(work(python_rows(chain([head], batches))), pa.schema([head.schema.field("conv"), *fields]))

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, "conv").sortWithinPartitions("conv", *order).mapInArrow(run, schema)


def chosen(paths: DataFrame) -> DataFrame:
    """(conv, block, path): the path of each block of the conversations that
    have several. A task holds a few bytes a block, not its rows."""
    narrow = paths.filter("NOT (first AND last)").select("conv", "block", "first", F.transform(
        "paths", lambda p: F.struct(p["p"].alias("p"), p["q"].alias("q"), p["cost"].alias("cost"))).alias("paths"))

    def work(rows: Iterator[dict]) -> Iterator[dict]:
        links = Links()
        for r in rows:
            links.add(r["block"], [(p["p"], p["q"], p["cost"]) for p in r["paths"]])
            if r["first"]:
                yield from ({"conv": r["conv"], "block": x, "path": k} for x, k in links.taken())
                links = Links()

    return by_conversation(narrow, work, [("block", pa.int64()), ("path", pa.int32())], F.desc("block"))


def with_pieces(found: DataFrame) -> DataFrame:
    """(conv, block, at0, rows, pieces) from rows with ``p`` and ``edits`` too."""
    schema = found.select("conv", "block", "at0", "rows", F.lit(None).cast("array<array<struct<edit:string,role:string>>>").alias("pieces")).schema
    kind = pa.list_(pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string())])))
    keep = [found.columns.index(c) for c in ("conv", "block", "at0", "rows")]
    read = [found.columns.index(c) for c in ("rows", "p", "edits")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[[{"edit": e, "role": r} for e, r in piece] for piece in pieces(*x)] for x in zip(*(b.column(k).to_pylist() for k in read))]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(out, kind)], names=schema.names)

    return found.mapInArrow(run, schema)


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The edits, one row each: conversation id, turn, ``was`` (role before),
    role (after), text, ``edit`` (K, R, D or I), ``fault`` (blank, duplicate,
    truncated or null) and, for the order, ``at`` and ``step``. Deleted rows
    are among them; the repaired conversation is the rest."""
    placed = numbered(rows, conv_id, turn, role, text)
    paths = written(solved(blocks_of(placed)), "conversation-paths")
    one = paths.filter("first AND last").withColumn("path", F.lit(0))
    picks = chosen(paths).select(F.col("conv").alias("c2"), F.col("block").alias("b2"), "path")
    many = paths.filter("NOT (first AND last)").join(picks, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("block") == F.col("b2"))).drop("c2", "b2")
    path = F.col("paths")[F.col("path")]
    taken = one.unionByName(many).select("conv", "block", "at0", "rows", path["p"].alias("p"), path["edits"].alias("edits"))
    found = with_pieces(taken).select(F.col("conv").alias("c2"), F.col("block").alias("b2"), "at0", "rows", "pieces")
    all_rows = placed.join(found, F.col("conv").eqNullSafe(F.col("c2")) & (F.expr(f"at div {BLOCK}") == F.col("b2")))
    own = (F.col("at") - F.col("at0")).cast("int")
    state = F.substring("rows", 2 * own + 2, F.lit(1))
    fault = F.when(F.col("blank"), "blank").when(state == "x", "duplicate").when(state == "t", "truncated")
    steps = all_rows.select("conv", "turn", "role", "text", "at", fault.alias("fault"), F.posexplode(F.col("pieces")[own]).alias("step", "s"))
    new = F.col("s.edit") == "I"
    return steps.select(F.col("conv").alias(conv_id), F.when(~new, F.col("turn")).alias(turn), F.when(~new, F.col("role")).alias("was"),
                        F.coalesce("s.role", "role").alias(role), F.when(new, "").otherwise(F.col("text")).alias(text), F.col("s.edit").alias("edit"),
                        F.when(~new, F.col("fault")).alias("fault"), "at", "step")


COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def summaries(rows: Iterator[dict]) -> Iterator[dict]:
    """One dict per conversation of a stream of edits in order."""
    conv = n = previous = None
    audit, digest, empty = [], sha256(), True
    for row in rows:
        if n is None or row["conv"] != conv:
            if n is not None:
                yield {"conv": conv, **n, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
            conv, n, previous = row["conv"], dict.fromkeys(COUNTS, 0), None
            audit, digest, empty = [], sha256(), True
        edit = row["edit"]
        audit.append(edit)
        n["cost"] += RULES[edit]
        if edit != "I":
            n["illegal"] += previous is not None and previous + row["was"] not in ("su", "ua", "au")
            previous = row["was"]
            if row["fault"]:
                n[row["fault"]] += 1
                n["cost"] += TRUNCATED * (row["fault"] == "truncated" and edit != "D")
        if edit != "D":
            digest.update((("" if empty else "\n") + row["line"]).encode("utf-8", "surrogatepass"))
            empty = False
    if n is not None:
        yield {"conv": conv, **n, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def report(edits: DataFrame, conv_id: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation of ``edits``: counts of faults, ``illegal`` (adjacent
    rows before repair whose initials are not su, ua or au), cost, ``audit``
    (the edits) and the sha256 of the repaired ``role:text`` lines. A hash is
    sequential, so one task reads a conversation, but as a stream."""
    r = edits.select(F.col(conv_id).alias("conv"), "at", "step", "edit", "fault", F.left("was", F.lit(1)).alias("was"),
                     F.when(F.col("edit") != "D", F.concat_ws(":", F.col(role), F.col(text))).alias("line"))
    fields = [*[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())]
    return by_conversation(r, summaries, fields, "at", "step").withColumnRenamed("conv", conv_id)


def gaps(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Turns missing between the first and the last of each conversation."""
    turns = rows.groupBy(conv_id, turn).agg(F.lit(1).alias("one")).groupBy(conv_id)
    n = F.max(turn) - F.min(turn) + 1 - F.count(turn)
    return turns.agg(F.coalesce(n, F.lit(0)).cast("long").alias("gaps"))


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults dealt by crc32 of ``id:turn`` modulo 20: dropped,
    emptied, without sentence ends, twice, or as user (nulls: one space)."""
    as_text: Column = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn)])
    r = rows.select(F.col(conv_id), F.col(turn), *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in (role, text)],
                    F.pmod(F.crc32(as_text.cast("binary")), F.lit(20)).alias("__deal")).filter("__deal <> 0")
    deal = F.col("__deal")
    return r.select(conv_id, turn, F.when(deal == 4, "user").otherwise(F.col(role)).alias(role),
                    F.when(deal == 1, "").when(deal == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text)).alias(text),
                    F.explode(F.array_repeat(F.lit(0), F.when(deal == 3, 2).otherwise(1))).alias("__copy")).drop("__copy")


__all__ = ["repair", "report", "gaps", "damaged", "meet", "solve", "Links", "pieces"]
