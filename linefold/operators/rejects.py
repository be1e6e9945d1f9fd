"""The lookups a staged line must pass, and the lines that fail.

The two tests are the original's; they are not a partition of the stage:
a line with a null ``fulfillmenttype`` and no shop is in neither (trap 4,
kept; ``null_as_reject=True`` puts it with the rejects).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from linefold.functions import constants as K
from linefold.operators.joins import few_keys, join_narrow, of_keys, spread
from linefold.operators.stage import STAGE_COLUMNS, STAGE_TYPES, stage_select

REJECT_COLUMNS = tuple(c for c in STAGE_COLUMNS if c != "gcp_insert") + ("comments", "gcp_insert")


def reject_schema() -> str:
    """DDL of the reject table."""
    return ", ".join(f"`{c}` {STAGE_TYPES.get(c, 'string')}" for c in REJECT_COLUMNS)


def lookup_joins(staged: DataFrame, art: DataFrame, emp: DataFrame, shop: DataFrame,
                 art_how: str = "left", articles: DataFrame | None = None, source: DataFrame | None = None) -> DataFrame:
    """Staged lines with the article, employee-of-the-day and shop lookups.

    Added columns: ``combinedarticleid``, ``pk_article``, ``__art`` (article
    found), ``__emp_upn``, ``store_emp``, ``__service``, ``__shop``. ``articles``:
    the ``few_keys`` of the lines' articles if they have been worked out already.
    ``source``: the lines that ``staged`` are (some of), if those are dealt by
    order (``joins.dealt_by_order``); they then stay so.
    """
    articles = few_keys(staged, "articleid") if articles is None else articles
    a = of_keys(art.select("articleId", "combinedarticleid", "pk_article"), "articleId", articles)
    a = a.withColumnRenamed("articleId", "__art")
    e = emp.select(F.col("userprincipalname").alias("__emp_upn"), F.col("date_of_day").alias("__emp_day"),
                   F.col("service").alias("__service"), F.col("id_store").cast("bigint").alias("store_emp"))
    s = shop.select(F.col("merchantname").alias("__shop_m"), F.col("shopid").cast("bigint").alias("__shop"))
    j = staged.join(a, spread("articleid", ("ordernumber", "positionNumber")) == F.col("__art"), art_how)
    by = ("ordernumber", "articleid", "positionNumber")
    if source is None:
        j = j.join(e, (spread("affected_employee", by) == F.col("__emp_upn")) & (F.col("order_date") == F.col("__emp_day")),
                   "left")
    else:
        j = join_narrow(j, source, e, {"affected_employee": "__emp_upn", "order_date": "__emp_day"})
    return j.join(s, spread("merchantname", by) == F.col("__shop_m"), "left").drop("__emp_day", "__shop_m")


def _employee_ok() -> Column:
    return F.col("affected_employee").isNull() | F.col("__emp_upn").isNotNull()


def _shop_ok(marketplace_type: str) -> Column:
    return (F.col("fulfillmenttype") != marketplace_type) | F.col("__shop").isNotNull()


def _reasons(marketplace_type: str) -> list[tuple[Column, str]]:
    """The tests a line can fail, in the order in which they count."""
    return [(F.col("__art").isNull(), K.REASON_ARTICLE),
            (F.col("affected_employee").isNotNull() & F.col("__emp_upn").isNull(), K.REASON_EMPLOYEE),
            ((F.col("fulfillmenttype") == marketplace_type) & F.col("__shop").isNull(), K.REASON_SHOP)]


def _first_reason(reasons: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(cond, F.lit(text)) for cond, text in reasons])


def _as_rejects(lines: DataFrame, reason: Column) -> DataFrame:
    out = (lines.withColumn("reject_insert", F.coalesce(F.col("reject_insert"), F.col("gcp_insert")))
           .withColumn("comments", reason))
    return stage_select(out, REJECT_COLUMNS)


def reject_lines(staged: DataFrame, art: DataFrame, emp: DataFrame, shop: DataFrame,
                 marketplace_type: str = K.MARKETPLACE_TYPE, null_as_reject: bool = False,
                 source: DataFrame | None = None) -> DataFrame:
    """Lines failing a lookup, with the first reason that holds; the
    first reject time of a retried line is kept. ``source``: as in ``lookup_joins``."""
    j = lookup_joins(staged, art, emp, shop, source=source)
    reasons = _reasons(marketplace_type)
    cond = reasons[0][0] | reasons[1][0] | reasons[2][0]
    if null_as_reject:
        cond = F.coalesce(cond, F.lit(True))
    return _as_rejects(j.filter(cond), _first_reason(reasons))


ACCEPTED, REJECTED, NEITHER = "accepted", "rejected", "neither"


def judge_lines(staged: DataFrame, art: DataFrame, emp: DataFrame, shop: DataFrame,
                marketplace_type: str = K.MARKETPLACE_TYPE, null_as_reject: bool = False,
                source: DataFrame | None = None) -> DataFrame:
    """D20 and D21 in one pass: every staged line with its lookups, the
    ``verdict`` (accepted, rejected or, where both tests are null, neither) and
    the ``reason`` of a rejected one. Each lookup is joined once; write the
    result and read both outputs from it. ``source``: as in ``lookup_joins``."""
    j = lookup_joins(staged, art, emp, shop, source=source)
    reasons = _reasons(marketplace_type)
    ok = F.col("__art").isNotNull() & _employee_ok() & _shop_ok(marketplace_type)
    bad = F.lit(False)
    for cond, _ in reasons:
        bad = bad | cond
    if null_as_reject:
        bad = F.coalesce(bad, F.lit(True))
    verdict = F.when(ok, ACCEPTED).when(bad, REJECTED).otherwise(NEITHER)
    return j.select("*", verdict.alias("verdict"), F.when(verdict == REJECTED, _first_reason(reasons)).alias("reason"))


def accepted_lines(judged: DataFrame) -> DataFrame:
    """The accepted lines of ``judge_lines``, as ``accept_lines`` gives them."""
    return judged.filter(F.col("verdict") == ACCEPTED).drop("verdict", "reason")


def rejected_lines(judged: DataFrame) -> DataFrame:
    """The rejected lines of ``judge_lines``, as ``reject_lines`` gives them."""
    return _as_rejects(judged.filter(F.col("verdict") == REJECTED), F.col("reason"))


def counted(judged: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``judged`` with an observation: when it is written, the numbers of
    accepted, rejected and other lines and of all are known without a scan."""
    watch = Observation(name)
    kinds = [F.count_if(F.col("verdict") == v).alias(v) for v in (ACCEPTED, REJECTED, NEITHER)]
    return judged.observe(watch, *kinds, F.count(F.lit(1)).alias("lines")), watch


def accept_lines(staged: DataFrame, art: DataFrame, emp: DataFrame, shop: DataFrame,
                 marketplace_type: str = K.MARKETPLACE_TYPE, articles: DataFrame | None = None,
                 source: DataFrame | None = None) -> DataFrame:
    """Lines whose article is known (inner join), whose employee is null
    or known that day, and whose shop is known if marketplace. Keeps the
    lookup columns for D30. ``source``: as in ``lookup_joins``."""
    j = lookup_joins(staged, art, emp, shop, art_how="inner", articles=articles, source=source)
    return j.filter(_employee_ok() & _shop_ok(marketplace_type))


__all__ = ["REJECT_COLUMNS", "reject_schema", "lookup_joins", "reject_lines", "accept_lines", "judge_lines",
           "accepted_lines", "rejected_lines", "counted", "ACCEPTED", "REJECTED", "NEITHER"]
