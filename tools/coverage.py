"""Write COVERAGE.md: every SURVEY section-2 operator id -> implementing
functions (from docstrings / comments naming the id) -> registered queries."""

from __future__ import annotations

import ast
import pathlib
import re
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

IDS = ([f"S{i}" for i in range(1, 16)] + [f"P{i}" for i in range(1, 15)] + [f"J{i}" for i in range(1, 9)]
       + [f"A{i}" for i in range(1, 23)] + [f"W{i}" for i in range(1, 7)] + ["T2", "T3", "T4", "T5", "T7"]
       + ["U1", "U2", "U3"] + [f"F{i}" for i in range(1, 12)] + [f"F{i}" for i in range(13, 19)]
       + [f"M{i}" for i in range(1, 18)] + ["R1", "R2", "R3", "R4", "R6"])


def mentions(text: str) -> set[str]:
    found = set(re.findall(r"\b([SPJAWTUFMR]\d{1,2})\b", text))
    for m in re.finditer(r"\b([SPJAWTUFMR])(\d{1,2})-\1?(\d{1,2})\b", text):
        found |= {f"{m.group(1)}{k}" for k in range(int(m.group(2)), int(m.group(3)) + 1)}
    return found


def _index():
    """Per function: its ids, and the functions it calls (aliases resolved)."""
    ids: dict[str, set[str]] = {}
    calls: dict[str, set[str]] = {}
    for path in sorted((ROOT / "revlens").rglob("*.py")):
        if "llm" in path.parts:        # its operators are numbered on their own
            continue
        mod = ".".join(path.relative_to(ROOT).with_suffix("").parts)
        src = path.read_text()
        tree = ast.parse(src)
        alias = {}
        for node in ast.walk(tree):
            if isinstance(node, ast.ImportFrom) and node.module and node.module.startswith("revlens"):
                for a in node.names:
                    full = f"{node.module}.{a.name}"
                    alias[a.asname or a.name] = full
            elif isinstance(node, ast.Import):
                for a in node.names:
                    if a.name.startswith("revlens"):
                        alias[a.asname or a.name] = a.name
        for node in tree.body:
            if not isinstance(node, ast.FunctionDef):
                continue
            key = f"{mod}.{node.name}"
            ids[key] = mentions(ast.get_source_segment(src, node) or "")
            out = set()
            for sub in ast.walk(node):
                if isinstance(sub, ast.Call):
                    fn = sub.func
                    if isinstance(fn, ast.Attribute) and isinstance(fn.value, ast.Name) \
                            and fn.value.id in alias:
                        out.add(f"{alias[fn.value.id]}.{fn.attr}")
                    elif isinstance(fn, ast.Name):
                        out.add(alias.get(fn.id, f"{mod}.{fn.id}"))
            calls[key] = out
    return ids, calls


def functions() -> dict[str, list[str]]:
    ids, _ = _index()
    where: dict[str, list[str]] = {}
    for key, found in ids.items():
        if key.split(".")[-1].startswith("_"):
            continue
        for i in found:
            where.setdefault(i, []).append(f"`{key}`")
    return where


def queries() -> dict[str, list[str]]:
    """Ids reached from each registered query through the static call graph."""
    from revlens.plans.catalog import REGISTRY
    ids, calls = _index()
    where: dict[str, list[str]] = {}
    for name, fn in REGISTRY.items():
        start = f"{fn.__module__}.{fn.__name__}"
        seen, todo = set(), [start]
        while todo:
            k = todo.pop()
            if k in seen or k not in ids:
                continue
            seen.add(k)
            todo.extend(calls.get(k, ()))
        reached = set().union(*(ids[k] for k in seen)) if seen else set()
        for i in reached:
            where.setdefault(i, []).append(f"`{name}`")
    return where


def main() -> None:
    fns, qs = functions(), queries()
    out = ["# Operator coverage (SURVEY section 2)", "",
           "Generated by `tools/coverage.py` from the code. Functions name the ids they implement in",
           "their docstrings; queries are the registered `__spark_entry__` queries that reach such a function",
           "through the static call graph (module aliases resolved).", "",
           "| Id | Functions | Queries |", "|---|---|---|"]
    missing = []
    for i in IDS:
        f = ", ".join(sorted(set(fns.get(i, [])))) or "-"
        q = ", ".join(sorted(set(qs.get(i, [])))) or "library / tests only"
        if f == "-":
            missing.append(i)
        out.append(f"| {i} | {f} | {q} |")
    (ROOT / "COVERAGE.md").write_text("\n".join(out) + "\n")
    print("ids without a named function:", missing)


if __name__ == "__main__":
    main()
