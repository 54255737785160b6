"""Plain-SQL renderings of rule documents, for oracle queries run by DuckDB.

The oracle evaluates the same rule *data* in an independent engine; only the
rule tables are shared, never the Spark expressions.
"""

from __future__ import annotations


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def sql_code(col: str) -> str:
    return f"CAST({col} AS VARCHAR)"


def sql_recode(col: str, spec: dict, source: str | None = None) -> str:
    s = sql_code(source or col)
    whens = [f"WHEN {s} IN ({', '.join(_q(c) for c in codes)}) THEN {_q(label)}"
             for label, codes in spec.get("modalities", {}).items()]
    if spec.get("to_nan"):
        whens.append(f"WHEN {s} IN ({', '.join(_q(c) for c in spec['to_nan'])}) THEN '-1'")
    expr = f"CASE {' '.join(whens)} ELSE {s} END" if whens else s
    if spec.get("dtype") == "int64":
        expr = f"TRY_CAST({expr} AS BIGINT)"
    return expr


def sql_any_in(cols: list[str], codes) -> str:
    ors = " OR ".join(f"{c} IN ({', '.join(str(x) for x in codes)})" for c in cols)
    return f"CASE WHEN {ors} THEN 1 ELSE 0 END"


def sql_clip(col: str, lo=None, hi=None) -> str:
    parts = []
    if lo is not None:
        parts.append(f"WHEN {col} < {lo} THEN {lo}")
    if hi is not None:
        parts.append(f"WHEN {col} > {hi} THEN {hi}")
    return f"CASE {' '.join(parts)} ELSE {col} END"


def sql_pad(col: str, width: int = 2) -> str:
    return (f"CASE WHEN regexp_matches(CAST({col} AS VARCHAR), '^[0-9]{{1,{width - 1}}}$') "
            f"THEN lpad(CAST({col} AS VARCHAR), {width}, '0') ELSE CAST({col} AS VARCHAR) END")
