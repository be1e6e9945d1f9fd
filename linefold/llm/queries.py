"""The operators of this package on the driver's tables: one query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefold.llm import centroid_clustering, conversation_repair, language_id, line_dedup, mixing, packing, quality_classifier, quality_rules, repeats, simhash, topk, toxicity, url_filter
from linefold.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
MAX_REPEATS = 1.5
URL_RULES = [url_filter.Rule(*r) for r in (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
                                           ("allow", "com", "/fr/"), ("block", "com", "/de/"))]

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.quality_rules(docs, keep=["doc_id", "lang", "source"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reason")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, capacity=2048)


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out=1, folds=3)
    return found.select("doc_id", "held_out", "score", "predicted", F.size("sentences").cast("long").alias("n_sentences"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.readings(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), max_repeats=MAX_REPEATS).select(
        "doc_id", "source", mixing.estimated_tokens(F.col("text")).alias("n_tokens"), F.col("__copies").alias("copies"),
        F.col("__epoch").alias("epoch"), F.col("__rank").alias("block"), F.col("__place").alias("place"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out=0, folds=5)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), held_out=0, folds=5)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    rows = conversation_repair.damaged(given)
    found = conversation_repair.report(conversation_repair.repair(rows)).withColumnRenamed("conv_id", "c1")
    gaps = conversation_repair.gaps(rows).withColumnRenamed("conv_id", "c2")
    out = given.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("c1")), "left").join(gaps, F.col("conv_id").eqNullSafe(F.col("c2")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *conversation_repair.COUNTS)]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_clustering.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024, seed=3)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid_clustering.centroid_digest(F.col("centroid")).alias("centroid_sha256"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_quality_rules, op2_simhash, op3_packing, op4_top_k, op5_repeats, op6_toxicity, op7_line_dedup, op8_url_filter, op9_mixing, op10_quality_classifier,
    op11_language_id, op12_conversation_repair, op13_centroid_clustering)}

#: crc32 of a text of ASCII characters, bit by bit for the table of bytes, which rows join as ``crc``
CRC_TABLE = "crc AS (SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: if(c % 2 = 1, xor(c // 2, 3988292384), c // 2)) AS v FROM range(256) r(i)))"


def crc32_sql(text: str) -> str:
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)), lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1])))"


def clustering_sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Plain Lloyd rounds, one after the other; sums below 2**53 in doubles are exact."""
    assign = """a{n} AS MATERIALIZED (
            SELECT r, arg_min(k, d * 16 + k) AS k, min(d)::BIGINT AS d FROM (
                SELECT r, k, list_inner_product(x, x) + list_inner_product(c, c) - 2 * list_inner_product(x, c) AS d FROM v, c{n}) GROUP BY r)"""
    move = """c{m} AS MATERIALIZED (
            SELECT k, coalesce(c2, c) AS c FROM c{n} LEFT JOIN (
                SELECT k, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS c2 FROM (
                    SELECT k, i, sum(y)::BIGINT AS s, count(*) AS n FROM (SELECT k, unnest(x)::BIGINT AS y, generate_subscripts(x, 1) AS i FROM a{n} JOIN v USING (r))
                    GROUP BY k, i) GROUP BY k) USING (k))"""
    steps = [s.format(n=n, m=n + 1) for n in range(rounds) for s in (assign, move)] + [assign.format(n=rounds)]
    return f"""
        WITH v AS MATERIALIZED (
            SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS x FROM embeddings
            WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c0 AS MATERIALIZED (
            SELECT (row_number() OVER (ORDER BY h, x) - 1)::INT AS k, x AS c
            FROM (SELECT sha256('{seed}:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT {k})),
        {", ".join(steps)}
        SELECT vec_id, k AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(list_transform(c, lambda y: y::BIGINT::VARCHAR), ',')) AS centroid_sha256
        FROM v JOIN a{rounds} USING (r) JOIN c{rounds} USING (k)"""


#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    # quantiles of the sketch's buckets by running counts; the levels are sums of the leaves
    "op1_quality_rules": r"""
        WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
        w AS (
            SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                   list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
        runs AS (SELECT doc_id, i, words[i:i + 7] AS run FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
        again AS (SELECT doc_id, run FROM runs GROUP BY ALL HAVING count(*) > 1),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
            SELECT r.doc_id, unnest(range(r.i, r.i + 8)) AS p FROM runs r SEMI JOIN again a ON a.doc_id = r.doc_id AND a.run = r.run) GROUP BY doc_id),
        c AS (
            SELECT doc_id, lang, source, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                   (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
            FROM w LEFT JOIN covered USING (doc_id)),
        b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
        stats AS (
            SELECT doc_id, lang, source, unnest([{'stat': 'word_length', 'x': word_chars / n_words}, {'stat': 'symbol_share', 'x': n_symbols / n_words},
                {'stat': 'dup_line_share', 'x': n_dup_lines / n_lines}], recursive := true) FROM b WHERE NOT base_failed),
        leaf AS (SELECT lang, source, stat, if(x >= 1e-6, ceil(ln(x) / ln(1.01 / 0.99)), -2147483648)::BIGINT AS bucket, count(*) AS n FROM stats GROUP BY ALL),
        groups AS (SELECT DISTINCT lang, source, stat FROM leaf),
        levels AS (
            SELECT g.*, 1 AS level, l.bucket, sum(l.n) AS n FROM groups g JOIN leaf l ON l.stat = g.stat AND l.lang IS NOT DISTINCT FROM g.lang
              AND l.source IS NOT DISTINCT FROM g.source GROUP BY ALL
            UNION ALL SELECT g.*, 2, l.bucket, sum(l.n) FROM groups g JOIN leaf l ON l.stat = g.stat AND l.lang IS NOT DISTINCT FROM g.lang GROUP BY ALL
            UNION ALL SELECT g.*, 3, l.bucket, sum(l.n) FROM groups g JOIN leaf l ON l.stat = g.stat GROUP BY ALL),
        upto AS (
            SELECT *, sum(n) OVER (PARTITION BY lang, source, stat, level ORDER BY bucket) AS below, sum(n) OVER (PARTITION BY lang, source, stat, level) AS total,
                   if(bucket = -2147483648, 0, 2 * pow(1.01 / 0.99, bucket) / (1.01 / 0.99 + 1)) AS x FROM levels),
        quartiles AS (
            SELECT lang, source, stat, level, total, min(x) FILTER (below >= 0.25 * total) AS q1, min(x) FILTER (below >= 0.5 * total) AS q2,
                   min(x) FILTER (below >= 0.75 * total) AS q3 FROM upto GROUP BY ALL),
        fences AS (
            SELECT lang, source, stat, arg_min({'q2': q2, 'reach': 8 * greatest(q3 - q1, CASE stat WHEN 'word_length' THEN 0.1 WHEN 'symbol_share' THEN 0.02 ELSE 0.05 END)}, level) AS f
            FROM quartiles WHERE total >= 100 OR level = 3 GROUP BY ALL),
        out AS (
            SELECT s.doc_id, list_sort(list(if(s.stat = 'word_length', '1', if(s.stat = 'symbol_share', '2', '3')) || s.stat)
                FILTER (s.x > t.f.q2 + t.f.reach OR s.stat = 'word_length' AND s.x < t.f.q2 - t.f.reach))[1][2:] AS reason
            FROM stats s JOIN fences t ON t.stat = s.stat AND t.lang IS NOT DISTINCT FROM s.lang AND t.source IS NOT DISTINCT FROM s.source GROUP BY s.doc_id)
        SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND o.reason IS NULL AS kept,
               if(base_failed, 'base', o.reason) AS reason
        FROM b LEFT JOIN out o USING (doc_id)""",
    # the exponent has a closed form for a repetition limit
    "op9_mixing": """
        WITH d AS (SELECT doc_id, source, (ceil(strlen(coalesce(text, '')) / 4) + 1)::BIGINT AS n_tokens, md5('0/' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        s AS (SELECT source, sum(n_tokens) AS total, count(*) AS n FROM d GROUP BY source),
        a AS (SELECT greatest(0, 1 - if(max(total) = min(total), 1, ln(1.5) / ln(max(total) / min(total)))) AS a, max(total) AS high FROM s),
        budget AS (SELECT source, total, ceil(sqrt(n))::BIGINT AS blocks, floor(pow(total / high, a) * high + 0.001)::BIGINT AS tokens FROM s, a),
        parts AS (SELECT *, tokens // total AS whole, tokens % total AS part FROM budget),
        dealt AS (SELECT d.*, p.whole, p.part, ('0x' || left(h, 7))::BIGINT % blocks AS block FROM d JOIN parts p ON p.source IS NOT DISTINCT FROM d.source),
        blocks AS (
            SELECT source, block, sum(t) OVER (PARTITION BY source ORDER BY md5('0/' || coalesce(source, '') || '/' || block), block) - t AS before, t
            FROM (SELECT source, block, sum(n_tokens) AS t FROM dealt GROUP BY ALL)),
        placed AS (
            SELECT d.*, b.before, b.t, sum(n_tokens) OVER (PARTITION BY d.source, d.block ORDER BY h, n_tokens ROWS UNBOUNDED PRECEDING) AS upto
            FROM dealt d JOIN blocks b ON b.source IS NOT DISTINCT FROM d.source AND b.block = d.block),
        copied AS (
            SELECT *, (whole + (before + t <= part OR before + upto <= part)::INT)::BIGINT AS copies,
                   row_number() OVER (PARTITION BY source, block ORDER BY h, n_tokens) AS place FROM placed),
        epochs AS (SELECT DISTINCT source, block, unnest(range(whole::BIGINT + 1)) AS epoch FROM copied),
        ranks AS (
            SELECT *, row_number() OVER (PARTITION BY source, epoch ORDER BY md5('0' || if(epoch = 0, '', '.' || epoch) || '/' || coalesce(source, '') || '/' || block), block) AS rank
            FROM epochs),
        read AS (SELECT *, unnest(range(if(copies > whole, 0, 1), whole::BIGINT + 1)) AS epoch FROM copied WHERE copies > 0)
        SELECT doc_id, r.source, n_tokens, copies, r.epoch::INT AS epoch, rank::INT AS block, place::INT AS place
        FROM read r JOIN ranks k ON k.source IS NOT DISTINCT FROM r.source AND k.block = r.block AND k.epoch = r.epoch""",
    "op4_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    # every character of every line is left out in turn; no blocks, no hashes but for the join;
    # lines of one character each are no near copies
    "op7_line_dedup": r"""
        WITH texts AS (SELECT DISTINCT doc_id, text FROM documents),
        lines AS (
            SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM texts),
        judged_lines AS (SELECT line, min(struct_pack(d := doc_id, l := line_no)) AS place FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line),
        shorter AS (
            SELECT line, place, p, substring(line, 1, p - 1) || substring(line, p + 1) AS rest
            FROM (SELECT line, place, unnest(range(1, length(line) + 1)) AS p FROM judged_lines)),
        near AS (
            SELECT a.line FROM shorter a JOIN shorter b ON md5(a.rest) = md5(b.rest) AND a.p = b.p AND a.rest = b.rest WHERE b.place < a.place AND length(a.line) > 1
            UNION SELECT a.line FROM shorter a JOIN judged_lines b ON a.rest = b.line WHERE b.place < a.place
            UNION SELECT a.line FROM judged_lines a JOIN shorter b ON b.rest = a.line WHERE b.place < a.place),
        judged AS (
            SELECT l.doc_id, l.text, l.line, l.line_no,
                   coalesce(g.place IS NOT NULL AND (struct_pack(d := l.doc_id, l := l.line_no) > g.place OR l.line IN (SELECT line FROM near)), FALSE) AS gone
            FROM lines l LEFT JOIN judged_lines g ON l.line = g.line),
        kept AS (
            SELECT doc_id, text, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
                   coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS rest
            FROM judged GROUP BY doc_id, text)
        SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, md5(k.rest) AS kept_md5
        FROM documents d LEFT JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND d.text IS NOT DISTINCT FROM k.text""",
    # every run of every text, ranks by window, distances by join
    "op11_language_id": f"""
        WITH {CRC_TABLE},
        d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce({crc32_sql("doc_id::VARCHAR")} % 5 = 0, FALSE) AS held_out, coalesce(text, '') AS text FROM documents, crc),
        chars AS (
            SELECT r, list_transform(string_split(' ' || trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{M}}]+', ' ', 'g')) || ' ', ''), lambda x: unicode(x)::BIGINT) AS c
            FROM d WHERE regexp_matches(text, '\\p{{L}}')),
        spots AS (SELECT r, c, unnest(range(1, len(c) + 1)) AS i FROM chars),
        abc AS (SELECT r, c[i] AS x, c[i + 1] AS y, c[i + 2] AS z FROM spots),
        runs AS (
            SELECT r, x AS g FROM abc WHERE x <> 32
            UNION ALL SELECT r, x * 2097152 + y FROM abc WHERE y IS NOT NULL
            UNION ALL SELECT r, (x * 2097152 + y) * 2097152 + z FROM abc WHERE z IS NOT NULL AND y <> 32),
        counted AS (SELECT r, g, count(*) AS n FROM runs GROUP BY ALL),
        own AS (SELECT * FROM (SELECT r, g, row_number() OVER (PARTITION BY r ORDER BY n DESC, g) - 1 AS rank FROM counted) WHERE rank < 400),
        learned AS (
            SELECT * FROM (
                SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, g) - 1 AS rank FROM counted JOIN d USING (r)
                WHERE lang IS NOT NULL AND doc_id IS NOT NULL AND NOT held_out GROUP BY lang, g) WHERE rank < 400),
        dist AS (
            SELECT r, o.size * 400 AS most, l.lang, o.size * 400 - sum(coalesce(400 - abs(a.rank - b.rank), 0))::BIGINT AS dist
            FROM (SELECT r, count(*) AS size FROM own GROUP BY r) o CROSS JOIN (SELECT DISTINCT lang FROM learned) l
            JOIN own a USING (r) LEFT JOIN learned b ON b.lang = l.lang AND b.g = a.g GROUP BY r, o.size, l.lang),
        best AS (SELECT r, most, row_number() OVER (PARTITION BY r ORDER BY dist, lang) AS k, lang, dist FROM dist)
        SELECT doc_id, held_out, coalesce(b.lang, 'und') AS lang_pred, coalesce((most - dist)::DOUBLE / most, 0) AS score FROM d LEFT JOIN best b ON b.r = d.r AND b.k = 1""",
    # the lattice row by row: least (cost, edits) per state, inserts before each row and at the end
    "op12_conversation_repair": f"""
        WITH RECURSIVE {CRC_TABLE},
        raw AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS deal FROM conversations, crc),
        dealt AS (
            SELECT conv_id, turn, if(deal = 4, 'user', role) AS role, CASE deal WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(if(deal = 3, 2, 1))) AS copy FROM raw WHERE deal <> 0),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, role[1] AS initial,
                   NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS open FROM dealt),
        f AS (
            SELECT *, CASE WHEN blank THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN open THEN 'truncated' ELSE '' END AS fault,
                   lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair, count(*) OVER (PARTITION BY conv_id) AS size FROM r),
        ins(p, q, edits, cost, lines) AS (VALUES (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''), (0, 2, 'I', 2, chr(10) || 'user:'),
            (1, 2, 'I', 2, chr(10) || 'user:'), (2, 3, 'I', 2, chr(10) || 'assistant:'), (3, 2, 'I', 2, chr(10) || 'user:'),
            (0, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:')),
        own(p, q, edit, cost, initial) AS (VALUES (0, 0, 'D', 3, ''), (1, 1, 'D', 3, ''), (2, 2, 'D', 3, ''), (3, 3, 'D', 3, ''), (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'),
            (1, 2, 'K', 0, 'u'), (3, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a'), (0, 2, 'R', 2, ''), (1, 2, 'R', 2, ''), (2, 3, 'R', 2, ''), (3, 2, 'R', 2, '')),
        edge AS (SELECT ins.p, own.q, ins.edits || edit AS edits, edit, ins.cost + own.cost AS cost, initial, lines, if(own.q = 3, 'assistant', 'user') AS named FROM ins JOIN own ON ins.q = own.p),
        walk AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0::BIGINT, 'edits': '', 'lines': ''}} AS b FROM f
            UNION ALL
            SELECT w.conv_id, f.i, e.q, min({{'cost': w.b.cost + e.cost + if(edit <> 'D' AND fault = 'truncated', 1, 0), 'edits': w.b.edits || e.edits,
                       'lines': w.b.lines || e.lines || CASE edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || named || ':' || text END}})
            FROM walk w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN edge e ON e.p = w.q
            WHERE (edit = 'D' OR fault NOT IN ('blank', 'duplicate')) AND e.initial IN ('', f.initial) GROUP BY w.conv_id, f.i, e.q),
        done AS (
            SELECT w.conv_id, min({{'cost': b.cost + ins.cost, 'edits': b.edits || ins.edits, 'lines': b.lines || ins.lines}}) AS b
            FROM walk w JOIN (SELECT DISTINCT conv_id, size FROM f) s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.size = w.i JOIN ins ON ins.p = w.q WHERE ins.q IN (0, 3) GROUP BY w.conv_id),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
        SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
               coalesce(illegal, 0)::BIGINT AS illegal, coalesce(d.b.cost, 0)::BIGINT AS cost, coalesce(d.b.edits, '') AS audit, sha256(coalesce(d.b.lines[2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM a.conv_id""",
    "op13_centroid_clustering": clustering_sql(),
}
