"""Line dedup: exact copies and lines one edit apart, by a deletion-neighbourhood
join. DataFrame operations only.

A line that holds a character other than white space, of whatever length, is
removed where an equal line, or one within one edit (a character inserted,
deleted or replaced), occurs earlier in the corpus, by document id and line
number. Lines of one character are no copies of other such lines: an edit that
leaves nothing of a line says nothing. Lines are judged on the input, not on
what is left. ``min_chars`` leaves shorter lines alone, if a caller asks.

Near lines are found among distinct lines by their variants, the line without
one character:

* a replacement: both lines without character p are equal, same p;
* an insertion: the longer line without some character is the shorter line.

A variant's key is the hash of its text, its length and, for a replacement, p;
equal keys are joined, the earliest line of each key is the candidate, and its
edit distance is checked on the texts. As the earliest line serves for all
lines of a key, a key shared by very many lines costs a minimum, not pairs.

Emitting a variant per character of the corpus would be several times its
size. So a line is first cut into two blocks, then (if it survives) into about
the square root of its length: lines one edit apart agree in everything but
one block, so only lines that share such a context with another line go on,
and only the variants of that block are emitted. This loses nothing; a line of
n characters costs about n ** 1.5 at most.

Nulls and edge cases: null and empty texts have no lines to remove and stay as
they are; null ids come after all others; rows with equal id are told apart by
their texts, and rows with equal id and text are treated alike (a line is no
copy of itself); a text that loses all lines is empty. All columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import under_own_names, written

MIN_CHARS = 1  # no line is too short
LAST = "9223372036854775808"  # in the order of ids: after every bigint


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def occurrences(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(d, th, line_no, line, h1, h2, at): lines long enough and not blank, with
    two hashes and their place in the corpus' order."""
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.xxhash64(text).alias("th"), F.posexplode(split_lines(F.col(text))).alias("line_no", "line"))
    at = (F.coalesce(F.col("d").cast("decimal(20,0)"), F.lit(LAST).cast("decimal(20,0)")) * F.lit("4294967296").cast("decimal(10,0)")
          + F.col("line_no").cast("decimal(10,0)")).cast("decimal(38,0)")
    return rows.filter((F.length("line") >= min_chars) & F.col("line").rlike(r"\S")).select(
        "d", "th", "line_no", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"), at.alias("at"))


def contexts(line: str, size: str) -> Column:
    """Per block of the line: the hash of all else, as a line of its own
    length (``own``) and as one that is a character longer than another.

    size: SQL for the block size of a line of ``n`` characters.
    """
    def blocks(own: bool) -> str:
        n, more = (f"char_length({line})", 0) if own else (f"(char_length({line}) - 1)", 1)
        width = f"int({size.replace('n', n)})"
        return f"""transform(sequence(0, int(ceil({n} / {width})) - 1), j -> named_struct(
            'own', {str(own).lower()},
            'ctx', xxhash64({n}, j, substring({line}, 1, j * {width}), '|', substring({line}, (j + 1) * {width} + {more + 1})),
            'block', substring({line}, j * {width} + 1, {width} + {more}), 'whole', char_length({line})))"""

    return F.expr(f"if(char_length({line}) > 1, concat({blocks(True)}, {blocks(False)}), {blocks(True)})")  # no line is shorter than one character


def halves(line: str) -> list[Column]:
    """Hashes of the first and the second half of the line, as a line of its
    own length and as one that is a character longer than another: lines one
    edit apart share at least one."""
    out = []
    for more in (0, 1):
        n = F.length(line) - more
        cut = F.floor(n / 2).cast("int")
        out += [F.xxhash64(n, F.lit(0), F.substring(F.col(line), F.lit(1), cut)),
                F.xxhash64(n, F.lit(1), F.substring(F.col(line), cut + (more + 1), n))]
    return out


def near_lines(docs: DataFrame, distinct: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line one edit away."""
    halves = distinct.select("h1", "h2", "at", F.explode("halves").alias("ctx"))
    met = halves.groupBy("ctx").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("ctx")
    some = halves.join(met, "ctx", "left_semi").select("h1", "h2", "at").distinct()
    lines = written(occurrences(docs, doc_id, text, min_chars).select("h1", "h2", "at", "line")
                    .join(some, ["h1", "h2", "at"], "left_semi").distinct(), "near-lines")

    cut = lines.select("h1", "h2", "at", F.explode(contexts("line", "ceil(sqrt(n))")).alias("c")).select("h1", "h2", "at", "c.*")
    met = cut.groupBy("ctx").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("own")).filter("n > 1 and own").select("ctx")
    kept = cut.join(met, "ctx", "left_semi")
    # a line of one character has no variant but the empty one
    without = "transform(sequence(1, char_length(block)), p -> named_struct('kind', '{0}', 'key', xxhash64(ctx, {1}, concat(substring(block, 1, p - 1), substring(block, p + 1)))))"
    keys = F.when(F.col("own"), F.expr(f"concat(if(whole > 1, {without.format('replaced', 'p')}, array()), array(named_struct('kind', 'shorter', 'key', xxhash64(ctx, 0, block))))")) \
        .otherwise(F.expr(without.format("longer", "0")))
    variants = written(kept.select("at", F.explode(keys).alias("v")).select("at", "v.*"), "variants")
    least = variants.groupBy("key").agg(*[F.min(F.when(F.col("kind") == k, F.col("at"))).alias(k) for k in ("replaced", "shorter", "longer")])
    other = F.when(F.col("kind") == "replaced", F.col("replaced")).when(F.col("kind") == "shorter", F.col("longer")).otherwise(F.col("shorter"))
    pairs = variants.join(least, "key").select("at", other.alias("before")).filter("before < at").distinct()
    checked = (pairs.join(lines.select("h1", "h2", "at", "line"), "at")
               .join(lines.select(F.col("at").alias("before"), F.col("line").alias("first_line")), "before")
               .filter(F.levenshtein("line", "first_line", 1) == 1))
    return checked.select("h1", "h2").distinct()


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(d, th, removed): line numbers to remove of each text that has any."""
    found = occurrences(docs, doc_id, text, min_chars)
    keyed = found.select("h1", "h2", "at", *[k.alias(f"k{i}") for i, k in enumerate(halves("line"))])
    distinct = written(keyed.groupBy("h1", "h2").agg(F.min("at").alias("at"), *[F.max(f"k{k}").alias(f"k{k}") for k in range(4)])
                       .select("h1", "h2", "at", F.array("k0", "k1", "k2", "k3").alias("halves")), "lines")
    near = near_lines(docs, distinct, doc_id, text, min_chars).withColumn("near", F.lit(True))
    verdict = distinct.select("h1", "h2", F.col("at").alias("first")).join(near, ["h1", "h2"], "left")
    gone = (found.select("d", "th", "line_no", "h1", "h2", "at").join(verdict, ["h1", "h2"])
            .filter((F.col("at") > F.col("first")) | F.col("near")))
    # the lines of one text, whose size bounds the set
    return gone.groupBy("d", "th").agg(F.collect_set("line_no").alias("removed"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with ``text`` less the removed lines, and ``__lines`` and
    ``__removed``, the numbers of lines and of removed ones."""
    gone = written(removals(docs, doc_id, text, min_chars), "removals").withColumnsRenamed({"d": "__d", "th": "__th", "removed": "__gone"})
    rows = docs.join(gone, F.col(doc_id).cast("long").eqNullSafe(F.col("__d")) & (F.xxhash64(text) == F.col("__th")), "left")
    n = F.coalesce(F.size(split_lines(F.col(text))), F.lit(0))
    left = F.array_except(F.sequence(F.lit(0), n - 1), F.col("__gone"))
    # the text is split once, not once for each line that is left
    kept = F.transform(F.array(split_lines(F.col(text))), lambda lines: F.transform(left, lambda i: F.get(lines, i)))[0]
    return rows.select(*docs.columns, n.cast("long").alias("__lines"), F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("__removed"),
                       F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias("__kept")) \
        .withColumn(text, F.col("__kept")).drop("__kept")


def keep_unique_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars",
                      min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with their lines deduplicated, ``n_chars`` (if there is such a
    column) recounted where lines went; a document of which nothing but white
    space is left is dropped."""
    def work(d: DataFrame, doc_id: str, text: str, n_chars: str) -> DataFrame:
        rows = dedup_lines(d, doc_id, text, min_chars)
        if n_chars in d.columns:
            rows = rows.withColumn(n_chars, F.when(F.col("__removed") > 0, F.length(text)).otherwise(F.col(n_chars)).cast(d.schema[n_chars].dataType))
        return rows.filter((F.col("__removed") == 0) | F.col(text).rlike(r"\S"))

    return under_own_names(docs, work, doc_id=doc_id, text=text, n_chars=n_chars)


__all__ = ["MIN_CHARS", "occurrences", "contexts", "near_lines", "removals", "dedup_lines", "keep_unique_lines"]
