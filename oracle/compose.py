"""Assemble a checking query from named steps: only the steps it needs, in order."""

from __future__ import annotations

import re


def compose(steps: dict[str, str], final: str) -> str:
    wanted: list[str] = []

    def visit(sql: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_][a-z0-9_]*\b", sql)):
            if word in steps and word not in wanted and word not in _visiting:
                _visiting.add(word)
                visit(steps[word])
                wanted.append(word)

    _visiting: set[str] = set()
    visit(final)
    if not wanted:
        return final.strip()
    body = ",\n".join(f"{name} AS (\n{steps[name].strip()}\n)" for name in wanted)
    return f"WITH {body}\n{final.strip()}"
