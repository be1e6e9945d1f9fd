"""Small builders of DuckDB SQL text for the oracles (independent of the
Spark code path; they only restate the same semantics in SQL)."""

from __future__ import annotations

import datetime as dt

from linefold.functions import constants as K


def parse(t: str) -> str:
    return f"try_strptime({t}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def paris(ts: str) -> str:
    return f"date_trunc('second', timezone('{K.PARIS}', timezone('UTC', {ts})))"


def pdate(ts: str) -> str:
    return f"CAST(timezone('{K.PARIS}', timezone('UTC', {ts})) AS DATE)"


def txt(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def dtxt(d: str) -> str:
    return f"CAST({d} AS VARCHAR)"


def d(v: dt.date) -> str:
    return f"DATE '{v}'"


def ts(v: dt.datetime) -> str:
    return f"TIMESTAMP '{v.strftime('%Y-%m-%d %H:%M:%S')}'"


def money(x: str) -> str:
    return f"CAST(ROUND(SUM(CAST({x} AS DECIMAL(28,9))), 2) AS DOUBLE)"


def case_map(c: str, mapping: dict, default="0") -> str:
    parts = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {c} {parts} ELSE {default} END"


def order_prio(c: str) -> str:
    return case_map(c, K.ORDER_STATUS_PRIORITY)


def invoice_prio(c: str) -> str:
    return case_map(c, K.INVOICE_STATUS_PRIORITY)


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def dash_parts(c: str) -> str:
    return f"len(string_split({c}, '-'))"
