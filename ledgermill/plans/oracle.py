"""Assembles the reference SQL of a query: its text plus the CTEs it names."""

from __future__ import annotations

import re

from ledgermill.plans.inputs import INPUTS, references

VIEWS: dict[str, str] = {
    name: text.format(**{r: r for r in references(text)}) for name, text in INPUTS.items()
}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql


def _named(text: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text))
    return [name for name in VIEWS if name in words]


def assemble(sql: str) -> str:
    ordered: list[str] = []

    def visit(text: str, above: tuple[str, ...]) -> None:
        for name in _named(text):
            if name not in ordered and name not in above:
                visit(VIEWS[name], (*above, name))
                ordered.append(name)

    visit(sql, ())
    if not ordered:
        return sql
    # the sets of triples are unions of many scans: evaluate them once
    kept = {"quads", "tset"}
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in kept else ''}({VIEWS[n]})" for n in ordered)
    body = sql.strip()
    if re.match(r"(?i)with\s+recursive\s", body):
        return f"WITH RECURSIVE {ctes},\n{body[body.lower().index('recursive') + 9:]}"
    if re.match(r"(?i)with\s", body):
        return f"WITH {ctes},\n{body[4:]}"
    return f"WITH {ctes}\n{body}"
