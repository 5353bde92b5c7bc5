"""Key ranges of about equal size, as predicates that any SQL source understands."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.plans.keyed_table import check_identifier

#: Sampled keys for each chunk; the size of a chunk then strays by about a fourteenth of it.
SAMPLED = 200


def literal(value) -> str:
    """A key value as an SQL literal."""
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "''") + "'"


def at_least(key: Sequence[str], cut: Sequence) -> str:
    """The predicate of rows whose key is the cut or comes after it, column by column."""
    parts = []
    for n, name in enumerate(key):
        equal = [f"{k} = {literal(v)}" for k, v in zip(key[:n], cut[:n])]
        last = ">=" if n == len(key) - 1 else ">"
        parts.append(" AND ".join([*equal, f"{name} {last} {literal(cut[n])}"]))
    return "(" + " OR ".join(f"({p})" for p in parts) + ")"


def range_predicates(key: Sequence[str], cuts: list[Sequence]) -> list[str]:
    """One predicate for each range between cuts in ascending order; every row, null keys too, has exactly one.

    Ranges are differences of nested sets. So they are disjoint and complete even where the source orders text
    differently from the cuts: a row then is only counted in another range.
    """
    for name in key:
        check_identifier(name)
    after = [at_least(key, c) for c in cuts]
    if not after:
        return ["1 = 1"]
    inside = [f"{a} AND COALESCE(NOT {b}, 1 = 1)" for a, b in zip(after, after[1:])]
    return [f"COALESCE(NOT {after[0]}, 1 = 1)", *inside, after[-1]]


def cuts_of(sample: list[tuple], chunks: int) -> list[tuple]:
    """The quantiles of ordered sampled keys that open the second and every later chunk."""
    at = sorted({len(sample) * n // chunks for n in range(1, chunks)} - {0})
    out: list[tuple] = []
    for n in at:
        if n < len(sample) and (not out or out[-1] != sample[n]) and sample[n] != sample[0]:
            out.append(sample[n])
    return out


def key_splits(rows: DataFrame, key: list[str], chunks: int, sampled: int = SAMPLED) -> list[str]:
    """Predicates that cut ``rows`` into about ``chunks`` ranges of the ordered key, which may have several columns, texts too.

    The rows are counted, then keys are sampled by their hash: about ``chunks * sampled`` of them reach the driver.
    Rows of one key always lie in one range.
    """
    keys = rows.select(*key).where(" AND ".join(f"`{k}` IS NOT NULL" for k in key))
    share = min(1.0, chunks * sampled / max(1, keys.count()))
    some = keys.where(F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < int(share * (1 << 30)))
    return range_predicates(key, cuts_of([tuple(r) for r in some.orderBy(*key).collect()], chunks))


def quantile_query(table: str, key: list[str], chunks: int) -> str:
    """The statement that lets a source itself cut its key index: every chunk's first key, in the source's own order."""
    names = ", ".join(check_identifier(k) for k in key)
    numbered = f"SELECT {names}, ROW_NUMBER() OVER (ORDER BY {names}) AS n, COUNT(*) OVER () AS total FROM {table}"
    first = f"FLOOR(n * {int(chunks)}.0 / (total + 1)) > FLOOR((n - 1) * {int(chunks)}.0 / (total + 1))"
    return f"SELECT {names} FROM ({numbered}) numbered WHERE {first} AND n > 1 ORDER BY n"
