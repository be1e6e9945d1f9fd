"""URL filter: fixed rules, and gradient-boosted trees for what they leave.

Host and path come from the text of the url. A rule (verdict, host, path) fits
a url whose host is the rule's or a subdomain of it and whose path starts with
the rule's; the longest rule (host and path together) wins.

The method's verdict comes from boosted regression trees on lexical features:
length, depth, digit ratio, character entropy, parameter count, and the
labelled block rates of the host's last label and of its whole suffix below
it. Labelled rows are dealt into folds by url and get the rates of the other
folds, so the trees cannot read a row's label off its suffix. Features are whole numbers from 0 to 31 (fixed steps, so nothing depends
on order), equal feature vectors are one weighted training row, and each level
of a tree is one aggregate: gradient sums per node, feature and step, of which
the driver sees at most nodes x features x 32 rows. A trained model is a
column expression, so scoring stays inside the scan's stage.

Nulls and edge cases: a null url or one without "://" has empty host and path,
fits no rule and is judged by the method; repeated rows are judged each;
without labelled urls the method allows all, with one class only it gives that
class. Only the id and url columns are read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import sum_of, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEPS = 32
ROUNDS = 10
DEPTH = 3
RATE = 0.4
RIDGE = 1.0
FOLDS = 5  # of the labelled urls, for rates that do not see their own rows
PRIOR_WEIGHT = 10.0  # rows' worth of overall rate in a suffix's rate
SMALL_TABLE = 50_000  # rows of a suffix table that may be broadcast


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: str) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = None
    for r in sorted(rules, key=lambda r: -len(r.text)):
        value = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits(r, host, path), value) if out is None else out.when(fits(r, host, path), value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def _step(x: Column, width: float) -> Column:
    return F.least(F.greatest(F.floor(F.coalesce(x, F.lit(0.0)) / width), F.lit(0)), F.lit(STEPS - 1)).cast("int")


def lexical(url: str) -> dict[str, Column]:
    """Lexical features of the column named ``url`` as steps."""
    text = F.coalesce(F.col(url), F.lit(""))
    n = F.length(text)
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(text, r"[^0-9]", ""))
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    entropy = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda a, c: a - F.when(c == "", 0.0).otherwise(
        share(c) * F.log2(F.greatest(share(c), F.lit(1e-12)))))
    return {
        "length": _step(n.cast("double"), 6.0),
        "depth": _step(F.size(F.split(text, "/")) - F.lit(1.0), 1.0),
        "digits": _step(digits / F.greatest(n, F.lit(1)), 1 / STEPS),
        "entropy": _step(entropy, 6.0 / STEPS),
        "params": _step(F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")), 1.0),
    }


def suffixes(host: Column) -> dict[str, Column]:
    return {"top": F.regexp_extract(host, r"([^.]*)$", 1), "suffix": F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1)}


FEATURES = ("length", "depth", "digits", "entropy", "params", "top", "suffix")


class Split(NamedTuple):
    feature: str
    at: int  # steps up to this one go left
    left: object  # Split or leaf value
    right: object


def column_of(tree: Split | float) -> Column:
    if not isinstance(tree, Split):
        return F.lit(float(tree))
    return F.when(F.col(tree.feature) <= tree.at, column_of(tree.left)).otherwise(column_of(tree.right))


def fit(train: DataFrame, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE) -> tuple[float, list[Split | float]] | None:
    """Start value and trees from rows (FEATURES..., n, blocked); the sum of
    their columns is the log odds of a block."""
    total = train.agg(F.sum("n").alias("n"), F.sum("blocked").alias("b")).first()
    if not total["n"]:
        return None
    if total["b"] in (0, total["n"]):
        return (30.0 if total["b"] else -30.0), []
    start = math.log(total["b"] / (total["n"] - total["b"]))
    trees: list[Split | float] = []
    for _ in range(rounds):
        odds = sum_of([F.lit(start), *[column_of(t) for t in trees]])
        rows = train.withColumn("p", 1 / (1 + F.exp(-odds))).select(
            *FEATURES, (F.col("blocked") - F.col("n") * F.col("p")).alias("g"), (F.col("n") * F.col("p") * (1 - F.col("p"))).alias("h"))
        chosen: dict[int, tuple[str, int]] = {}  # heap-numbered nodes: 1 is the root, 2k and 2k + 1 the children of k
        value: dict[int, float] = {1: 0.0}
        for level in range(depth):
            node = F.lit(1)
            for _ in range(level):
                step = F.lit(0)
                for k, (f, at) in chosen.items():
                    step = F.when(node == k, F.when(F.col(f) <= at, 2 * k).otherwise(2 * k + 1)).otherwise(step)
                node = F.when(step > 0, step).otherwise(F.lit(0))
            cells = (rows.select(node.alias("node"), "g", "h", F.explode(F.array(*[
                F.struct(F.lit(f).alias("f"), F.col(f).alias("s")) for f in FEATURES])).alias("x"))
                .filter("node > 0").groupBy("node", "x.f", "x.s").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())
            sums: dict[int, dict[str, dict[int, tuple[float, float]]]] = {}
            for c in cells:  # at most nodes x features x steps rows
                sums.setdefault(c["node"], {}).setdefault(c["f"], {})[c["s"]] = (c["g"], c["h"])
            for k, by in sums.items():
                if k < 2 ** level:
                    continue
                g, h = (sum(x[i] for x in by[FEATURES[0]].values()) for i in (0, 1))
                best = (1e-6, "", 0)
                for f in FEATURES:
                    left_g = left_h = 0.0
                    for s in sorted(by[f])[:-1]:
                        left_g, left_h = left_g + by[f][s][0], left_h + by[f][s][1]
                        gain = left_g ** 2 / (left_h + RIDGE) + (g - left_g) ** 2 / (h - left_h + RIDGE) - g ** 2 / (h + RIDGE)
                        if gain > best[0] + 1e-9:
                            best = (gain, f, s)
                            halves = (left_g / (left_h + RIDGE), (g - left_g) / (h - left_h + RIDGE))
                if level == 0:
                    value[1] = g / (h + RIDGE)
                if best[1]:
                    chosen[k] = best[1:]
                    value[2 * k], value[2 * k + 1] = halves

        def grown(k: int) -> Split | float:
            return Split(*chosen[k], grown(2 * k), grown(2 * k + 1)) if k in chosen else rate * value[k]

        trees.append(grown(1))
    return start, trees


def rates(labelled: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(key, fold, step) of labelled rows (key, fold, blocked): the smoothed
    block rate of each key without the rows of the fold, and with all rows
    under fold -1. A row that a tree learns from so never sees its own label."""
    per = written(labelled.groupBy("key", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("b")), "rates")
    whole = per.groupBy("key").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
    seen = {r["fold"]: (r["n"], r["b"]) for r in per.groupBy("fold").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).collect()}  # folds rows
    n, b = (sum(x[i] for x in seen.values()) for i in (0, 1))
    overall = {f: (b - seen.get(f, (0, 0))[1], n - seen.get(f, (0, 0))[0]) for f in (-1, *range(folds))}
    rate = F.create_map(*[F.lit(x) for f, (y, z) in overall.items() for x in (f, y / z if z else 0.5)])[F.col("fold")]
    out = per.join(whole, "key").select("key", "fold", (F.col("all_n") - F.col("n")).alias("n"), (F.col("all_b") - F.col("b")).alias("b"))
    both = out.unionByName(whole.select("key", F.lit(-1).alias("fold"), F.col("all_n").alias("n"), F.col("all_b").alias("b")))
    return both.select("key", "fold", _step((F.col("b") + PRIOR_WEIGHT * rate) / (F.col("n") + PRIOR_WEIGHT), 1 / STEPS).alias("step"))


def with_rates(rows: DataFrame, key: str, folds: int = FOLDS) -> DataFrame:
    """``rows`` (``key``_key, fold, blocked: null if not labelled) with the step
    of the key's rate as ``key``; an unknown key has the middle step."""
    own = F.col(f"{key}_key")
    of = written(rates(rows.filter("blocked IS NOT NULL").select(own.alias("key"), "fold", "blocked"), folds), "rate-steps")
    of = of.select(F.col("key").alias("__of"), F.col("fold").alias("__f"), F.col("step").alias("__step"))
    if of.count() <= SMALL_TABLE:
        of = F.broadcast(of)
    seen = F.when(F.col("blocked").isNull(), F.lit(-1)).otherwise(F.col("fold"))
    return (rows.join(of, (own == F.col("__of")) & (seen == F.col("__f")), "left")
            .withColumn(key, F.coalesce("__step", F.lit(STEPS // 2))).drop("__of", "__f", "__step"))


def judge(pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict and
    ``score`` (the method's probability of a block). The urls that a rule
    decides are the labelled ones."""
    host, path = host_and_path("url")
    rows = (pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
            .select("page_id", "url", host.alias("host"), path.alias("path"))
            .select("*", longest_rule(rules, F.col("host"), F.col("path")).alias("ruled"), *[c.alias(f"{k}_key") for k, c in suffixes(F.col("host")).items()])
            .select("page_id", "host", "path", "ruled", "top_key", "suffix_key", F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int").alias("fold"),
                    *[c.alias(k) for k, c in lexical("url").items()]))
    full = written(rows, "urls").withColumn("blocked", (F.col("ruled.verdict") == "block").cast("long"))
    for key in ("top", "suffix"):
        full = with_rates(full, key)
    train = full.filter("blocked IS NOT NULL").groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("blocked"))
    model = fit(written(train, "url-train"))
    odds = F.lit(-30.0) if model is None else sum_of([F.lit(model[0]), *[column_of(t) for t in model[1]]])
    return full.withColumn("score", 1 / (1 + F.exp(-odds))).select(
        "page_id", "host", "path", F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")


__all__ = ["Rule", "host_and_path", "longest_rule", "lexical", "suffixes", "FEATURES", "Split", "column_of", "fit", "rates", "with_rates", "judge"]
