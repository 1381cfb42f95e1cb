"""Repeatable draws: a hash of (key, purpose) instead of a random generator.

Every row can be drawn on its own, in any order and on any executor, and a lost
task draws the same values again. All functions take and return SQL text: long
word lists become one parsed expression instead of hundreds of calls to the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def literal(value: str | int) -> str:
    """A value as SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def draw(key: str, purpose: str, seed: int | None = None) -> str:
    """A value in 0 .. 2^32-1 that depends only on key, purpose and seed."""
    tail = f":{purpose}" if seed is None else f":{seed}:{purpose}"
    digest = f"md5(concat(cast({key} AS STRING), {literal(tail)}))"
    return f"cast(conv(substring({digest}, 1, 8), 16, 10) AS BIGINT)"


def pick(values: Sequence[str | int], drawn: str) -> str:
    """One of the values by a drawn number."""
    listed = ", ".join(literal(value) for value in values)
    return f"element_at(array({listed}), cast({drawn} % {len(values)} + 1 AS INT))"


def pick_by(label: str, values: Mapping[str, Sequence[str | int]], drawn: str) -> str:
    """One of the values listed for the row's label; null for other labels."""
    cases = [f"WHEN {literal(name)} THEN {pick(options, drawn)}" for name, options in values.items()]
    return f"CASE {label} {' '.join(cases)} END"


def pick_weighted(names: Sequence[str], percents: Sequence[int], drawn: str) -> str:
    """One of the names, each drawn as often as its percentage says."""
    cases, upto = [], 0
    for name, percent in zip(names, percents):
        if percent:
            upto += percent
            cases.append(f"WHEN {drawn} % 100 < {upto} THEN {literal(name)}")
    return f"CASE {' '.join(cases)} END"


def fill(template: str, slots: Mapping[str, str]) -> str:
    """Replace each ``{slot}``; a slot without a value stays as it is.

    One aggregation over the slots rather than a chain of calls: a chain of all
    slots, inlined with their draws, becomes a generated method that the JVM
    does not compile (over 8,000 bytes).
    """
    if not slots:
        return template
    pairs = []
    for name, value in slots.items():
        marker = literal("{" + name + "}")
        pairs.append(f"named_struct('marker', {marker}, 'value', coalesce({value}, {marker}))")
    return f"aggregate(array({', '.join(pairs)}), {template}, (text, slot) -> replace(text, slot.marker, slot.value))"
