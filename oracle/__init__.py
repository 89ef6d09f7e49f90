"""DuckDB oracle statements, one per ``queries()`` key (test side only).

``ROUND(x, d)`` in the statements is rewritten to ``ROUND(x * 10^d) / 10^d`` on DOUBLE —
the rounding rule the Spark side uses — so both engines round the same double the same way.
"""

from __future__ import annotations


def _rewrite_round(sql: str) -> str:
    out, i = [], 0
    key = "ROUND("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k, comma = 1, j + len(key), -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner = sql[j + len(key): k - 1]
        if comma < 0:
            out.append(f"ROUND({_rewrite_round(inner)})")
        else:
            expr = _rewrite_round(sql[j + len(key): comma])
            digits = int(sql[comma + 1: k - 1].strip())
            scale = f"{10 ** digits}.0::DOUBLE"
            out.append(f"(ROUND(CAST({expr} AS DOUBLE) * {scale}) / {scale} + 0.0::DOUBLE)")
        i = k


def _rewrite_avg(sql: str) -> str:
    """``AVG(x)`` -> exact decimal sum / count as DOUBLE (the Spark side's ``exact_avg``)."""
    import re

    out, i = [], 0
    pattern = re.compile(r"(?<![A-Za-z_])AVG\(")
    while True:
        m = pattern.search(sql, i)
        if not m:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:m.start()])
        depth, k = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = _rewrite_avg(sql[m.end(): k - 1])
        out.append(f"(CAST(SUM(CAST({inner} AS DECIMAL(38,9))) AS DOUBLE) / NULLIF(CAST(COUNT({inner}) AS DOUBLE), 0))")
        i = k


def _load() -> dict[str, str]:
    from oracle import cleaning, dashboards, kpis, marts, profiles, reports

    merged: dict[str, str] = {}
    for module in (reports, cleaning, marts, kpis, dashboards, profiles):
        merged.update(module.Q)
    return {k: _rewrite_round(_rewrite_avg(v)) for k, v in merged.items()}


ORACLE_SQL: dict[str, str] = _load()
