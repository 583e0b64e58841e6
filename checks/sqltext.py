"""Small helpers that write DuckDB text for the reference checks."""

from __future__ import annotations


def lit(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def pick(*cases: tuple[object, str], default: object = None) -> str:
    """First label whose condition holds."""
    body = " ".join(f"WHEN {cond} THEN {lit(label)}" for label, cond in cases)
    return f"CASE {body} ELSE {lit(default)} END"


def bands(x: str, *table: tuple[object, object, object], default: object = "unknown") -> str:
    """``(label, low, high)``: no low means ``x < high``, no high means ``x >= low``; a text low is used as is."""
    cases = []
    for label, low, high in table:
        if isinstance(low, str):
            cond = f"{x} {low}"
        elif low is None:
            cond = f"{x} < {high}"
        elif high is None:
            cond = f"{x} >= {low}"
        else:
            cond = f"{x} >= {low} AND {x} <= {high}"
        cases.append((label, cond))
    return pick(*cases, default=default)


def words(x: str, default: object = "unknown", **table: str) -> str:
    """``label="word, word"`` lists."""
    return pick(*[(k, f"list_contains(string_split({lit(v)}, ', '), {x})") for k, v in table.items()], default=default)


def yes(cond: str) -> str:
    return f"coalesce(({cond}), false)"


def one(cond: str, n: int = 1) -> str:
    return f"{n} * coalesce(({cond}), false)::int"


def total(*terms: str) -> str:
    return "(" + " + ".join(terms) + ")::int"


def listed(*terms: tuple[str, str], empty: str | None = None) -> str:
    """Comma-joined labels of the conditions that hold."""
    items = ", ".join(f"if({cond}, {lit(label)}, NULL)" for label, cond in terms)
    joined = f"array_to_string(list_filter([{items}], lambda v: v IS NOT NULL), ', ')"
    if empty is None:
        return joined
    return f"if({joined} = '', {lit(empty)}, {joined})"


def half_up(expr: str, digits: int) -> str:
    """Round the shortest decimal form of a double half away from zero."""
    return f"round(({expr})::varchar::decimal(38,18), {digits})::double"


def pct(part: str, whole: str, digits: int = 2) -> str:
    """Percentage with exact integer half-up rounding, so no tie can land differently."""
    scale = 10**digits
    return f"(({part})::hugeint * {200 * scale} + ({whole})::hugeint) // (2 * ({whole})::hugeint) / {scale}.0::double"


def tier(source: str, columns: dict[str, str]) -> str:
    return f"SELECT *, " + ",\n  ".join(f"{expr} AS {name}" for name, expr in columns.items()) + f"\nFROM {source}"


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS (\n{body}\n)" for name, body in ctes) + f"\n{final}"
