"""SQL twins of the portable split hash (``operators.sampling.hash64``)."""

from __future__ import annotations


def h_sql(seed: int, *keys: str) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {parts})), 1, 15) AS BIGINT)"


def split_sql(seed: int, keys: list[str], fractions: dict[str, float]) -> str:
    """CASE expression equal to ``hash_split`` (same float cut points)."""
    u = f"(({h_sql(seed, *keys)}) % 1000000) / 1000000.0"
    acc, parts = 0.0, []
    items = list(fractions.items())
    for name, f in items[:-1]:
        acc += f
        parts.append(f"WHEN {u} < {acc!r} THEN '{name}'")
    return "CASE " + " ".join(parts) + f" ELSE '{items[-1][0]}' END"
