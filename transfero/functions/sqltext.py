"""DuckDB text for the same rules as ``functions.text``, used by the oracle queries.

The oracle states the semantics independently; these helpers only avoid retyping long expressions.
"""

from __future__ import annotations


def title(expr: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({expr}, '\\p{{L}}+|\\P{{L}}+'), "
            f"lambda x: upper(x[1]) || lower(x[2:])), '')")


def capitalize(expr: str) -> str:
    return f"(upper(substring({expr}, 1, 1)) || lower(substring({expr}, 2)))"


def zfill(expr: str, n: int) -> str:
    s = f"cast({expr} as varchar)"
    return f"lpad({s}, cast(greatest({n}, length({s})) as integer), '0')"


def keep_right(expr: str, n: int) -> str:
    return f"right('{'0' * n}' || cast({expr} as varchar), {n})"


def doc_pad_a(s: str) -> str:
    return (f"(case length({s}) when 12 then '00' || {s} when 13 then '0' || {s} "
            f"when 10 then '0' || {s} else {s} end)")


def doc_pad_b(s: str) -> str:
    return (f"(case when length({s}) > 11 and length({s}) < 14 then lpad({s}, 14, '0') "
            f"when length({s}) < 11 then lpad({s}, 11, '0') else {s} end)")


def doc_type(s: str) -> str:
    return f"(case length({s}) when 11 then '02' when 14 then '01' else '03' end)"


def doc_mask(s: str) -> str:
    return (f"(case length({s}) "
            f"when 11 then substring({s},1,3)||'.'||substring({s},4,3)||'.'||substring({s},7,3)||'-'||substring({s},10,2) "
            f"when 14 then substring({s},1,2)||'.'||substring({s},3,3)||'.'||substring({s},6,3)||'/'"
            f"||substring({s},9,4)||'-'||substring({s},13,2) "
            f"else {s} end)")


def decimal14_text(expr: str) -> str:
    return f"cast(cast({expr} as decimal(14,0)) as varchar)"


def lot_item_number(lot: str, item: str, lots: str | None = None) -> str:
    base = f"cast({item} as varchar)" if lots is None else (
        f"case when {lots} = 1 then cast({item} as varchar) else cast({lot} as varchar) || cast({item} as varchar) end")
    return (f"cast(case when {lot} > 9 or {item} > 99 then cast({lot} as varchar) || '0' || cast({item} as varchar) "
            f"else {base} end as bigint)")
