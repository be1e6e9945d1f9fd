"""Scalar helpers and row rules. Every function returns a ``Column``.

All built from ``pyspark.sql.functions``: they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from linefold.functions import constants as K


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Casts and nulls
# --------------------------------------------------------------------------

def safe_bigint(c) -> Column:
    """SAFE_CAST(x AS INT64): '12' and ' 12 ' give 12; '12x', '1.5', '' give null."""
    return col(c).try_cast("bigint")


def safe_double(c) -> Column:
    return col(c).try_cast("double")


def null_of(type_name: str) -> Column:
    """Typed null (``SAFE_CAST(NULL AS STRING)``)."""
    return F.lit(None).cast(type_name)


def empty_to_null(c) -> Column:
    """'' becomes null, anything else stays."""
    return F.nullif(col(c), F.lit(""))


def lit_ts(value: dt.datetime | str) -> Column:
    """Timestamp literal without zone (F16)."""
    if isinstance(value, str):
        return F.lit(value).cast("timestamp_ntz")
    return F.lit(value).cast("timestamp_ntz")


def lit_date(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


# --------------------------------------------------------------------------
# Time (F9-F20)
# --------------------------------------------------------------------------

def parse_iso_millis(c) -> Column:
    """PARSE_DATETIME('%FT%R:%E3SZ'): text with milliseconds and 'Z', else null.

    The result is the UTC wall clock as ``timestamp_ntz`` (the session zone is
    UTC, see ``session.py``).
    """
    return F.try_to_timestamp(col(c), F.lit(K.ISO_MILLIS_Z)).cast("timestamp_ntz")


def wall_clock(ts_utc, tz: str = K.PARIS) -> Column:
    """UTC wall clock -> wall clock of ``tz``, cut to whole seconds."""
    return F.date_trunc("second", _local(ts_utc, tz)).cast("timestamp_ntz")


def _local(ts_utc, tz: str) -> Column:
    """The wall clock of ``tz``. The zone is looked up once, where
    ``convert_timezone`` does so for each row; the casts keep the clock, as the
    session zone is UTC."""
    return F.from_utc_timestamp(col(ts_utc).cast("timestamp"), tz).cast("timestamp_ntz")


def local_date(ts_utc, tz: str = K.PARIS) -> Column:
    """Day of a UTC instant in ``tz``."""
    return F.to_date(_local(ts_utc, tz))


def ts_text(ts) -> Column:
    """FORMAT_TIMESTAMP('%F %T') of a wall clock."""
    return F.date_format(col(ts), K.TS_TEXT)


def day_number(ts) -> Column:
    """yyyyMMdd as bigint."""
    return F.date_format(col(ts), "yyyyMMdd").cast("bigint")


def month_number(ts) -> Column:
    """yyyyMM as bigint."""
    return F.date_format(col(ts), "yyyyMM").cast("bigint")


def hour_minute(ts) -> Column:
    """'%R' = HH:mm."""
    return F.date_format(col(ts), "HH:mm")


def creation_day(creation_text, ingest_ts, tz: str = K.PARIS) -> Column:
    """Paris day of the parsed creation time, else of the ingestion time."""
    return F.coalesce(local_date(parse_iso_millis(creation_text), tz), local_date(ingest_ts, tz))


# --------------------------------------------------------------------------
# Money (F7, A3)
# --------------------------------------------------------------------------

def round_sum(c, scale: int = 2) -> Column:
    """ROUND(SUM(x), 2) without float noise: exact decimal sum, then double."""
    return F.round(F.sum(col(c).cast("decimal(28,9)")), scale).cast("double")


# --------------------------------------------------------------------------
# Maps and text
# --------------------------------------------------------------------------

def priority(c, mapping: Mapping[str, int], default: int = 0) -> Column:
    """Simple CASE status -> number; unknown and null give ``default``."""
    expr = None
    for key, val in mapping.items():
        expr = (F.when(col(c) == key, F.lit(val)) if expr is None
                else expr.when(col(c) == key, F.lit(val)))
    return expr.otherwise(F.lit(default))


def json_text(c, path: str) -> Column:
    """Value at a JSON path as text, no quotes; numbers as their text."""
    return F.get_json_object(col(c), path)


def dash_parts(c) -> Column:
    """Number of '-' separated parts; null for null."""
    return F.size(F.split(col(c), "-"))


def dash_part(c, index: int) -> Column:
    """Part ``index`` (0-based) of a '-' separated text; null out of range."""
    return F.get(F.split(col(c), "-"), F.lit(index))


# --------------------------------------------------------------------------
# Rules (D15, D16, D28, D29, D39-D42)
# --------------------------------------------------------------------------

def affected_employee(article, n_emp_combi, basket_user, validated, n_emp_order,
                      emp_order, fee_prefix: str = K.FEE_ARTICLE_PREFIX) -> Column:
    """Who the line is booked on.

    Null for fee lines of orders with two or more employees, else the user who
    put the article in the basket, else the validating user, else the only
    employee of the order.
    """
    return (F.when(col(article).like(fee_prefix + "%") & (col(n_emp_combi) >= 2), null_of("string"))
            .when(col(basket_user).isNotNull(), col(basket_user))
            .when(col(validated).isNotNull(), col(validated))
            .when(col(n_emp_order) == 1, col(emp_order))
            .otherwise(col(basket_user)))


def mask_external_employee(c, domains: Iterable[str]) -> Column:
    """Null for accounts of the external mail domains, which the caller names."""
    out = None
    for d in domains:
        cond = col(c).like("%" + d + "%")
        out = F.when(cond, null_of("string")) if out is None else out.when(cond, null_of("string"))
    return out.otherwise(col(c)) if out is not None else col(c)


def service_of(service) -> Column:
    """Service of the employee, 'CUSTOMER' when unknown."""
    return F.coalesce(col(service), F.lit(K.DEFAULT_SERVICE))


def attribute_store(service, emp_store, pref_store, home_store,
                    excluded: Iterable[int] = K.NON_ATTRIBUTABLE_STORES,
                    remap: Mapping[int, int] = K.STORE_REMAP) -> Column:
    """Managing store of a line.

    The employee's store for a store employee outside the excluded ids, else
    the customer's preferred store, else the home store (147 booked on 32).
    """
    out = (F.when((service_of(service) == K.STORE_SERVICE)
                  & ~col(emp_store).isin(list(excluded)) & col(emp_store).isNotNull(),
                  col(emp_store))
           .when(col(pref_store).isNotNull(), col(pref_store)))
    for src, dst in remap.items():
        out = out.when(col(home_store) == src, F.lit(dst).cast("bigint"))
    return out.otherwise(col(home_store))


def is_backorder_number(ordernumber) -> Column:
    """More than two '-' parts (null for null)."""
    return dash_parts(ordernumber) > 2


def order_kind(ordernumber) -> Column:
    """2 for a backorder number, else 1."""
    return F.when(is_backorder_number(ordernumber), F.lit(2)).otherwise(F.lit(1)).cast("bigint")


def original_key(ordernumber, prefix: str = K.BACKORDER_PREFIX) -> Column:
    """Key of the original order, '9-' + second part; null without one."""
    return F.concat(F.lit(prefix), dash_part(ordernumber, 1))


def is_rekeyed_backorder(ordernumber, prefix: str = K.BACKORDER_PREFIX) -> Column:
    """Backorder whose number starts with the prefix: takes the original's data."""
    return is_backorder_number(ordernumber) & col(ordernumber).startswith(prefix)


def rekey_backorder(ordernumber, own, original, prefix: str = K.BACKORDER_PREFIX) -> Column:
    """The original's value for '9-' backorders, else the line's own."""
    return F.when(is_rekeyed_backorder(ordernumber, prefix), col(original)).otherwise(col(own))


def split_backorder_measure(ordernumber, measure, to_backorder: bool,
                            prefix: str = K.BACKORDER_PREFIX) -> Column:
    """A measure goes to the backorder column for '9-' backorders, 0 elsewhere."""
    bo = is_rekeyed_backorder(ordernumber, prefix)
    if to_backorder:
        return F.when(bo, col(measure)).otherwise(F.lit(0)).cast("double")
    return F.when(bo, F.lit(0)).otherwise(col(measure)).cast("double")


def classify_backorder(ordernumber, orig_article, orig_qty, qty) -> Column:
    """D41: 'Ajout', 'Reliquat', 'Minoration', 'Autre' for backorders, else null."""
    bo = is_backorder_number(ordernumber)
    return (F.when(bo & col(orig_article).isNull(), F.lit(K.BACKORDER_ADDED))
            .when(bo & col(orig_article).isNotNull() & (col(orig_qty) == col(qty)),
                  F.lit(K.BACKORDER_REMAINDER))
            .when(bo & col(orig_article).isNotNull() & (col(orig_qty) > col(qty)),
                  F.lit(K.BACKORDER_REDUCED))
            .when(bo, F.lit(K.BACKORDER_OTHER))
            .otherwise(null_of("string")))


def final_employee(ordernumber, orig_article, orig_employee, order_date, employee,
                   corrected, start: dt.date = K.EMPLOYEE_CORRECTION_START) -> Column:
    """original's employee for backorders, the staged one before the start
    of the guarantee correction, else the corrected one, else the staged one."""
    return (F.when(is_backorder_number(ordernumber) & col(orig_article).isNotNull(), col(orig_employee))
            .when(col(order_date) < lit_date(start), col(employee))
            .otherwise(F.coalesce(col(corrected), col(employee))))
