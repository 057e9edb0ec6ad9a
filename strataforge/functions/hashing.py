"""Hash draws: deterministic, independent of partitioning, order and retries.

A draw is the first eight bytes of a SHA-256, read as an unsigned 64-bit integer. Spark has no such
type, so it is held as ``decimal(20, 0)``, and all comparisons stay in integers.
"""

from __future__ import annotations

import uuid
from decimal import Decimal
from fractions import Fraction
from math import ceil

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 1 << 64

def _wide(n: int) -> Column:
    """A literal beyond 64 signed bits."""
    return F.lit(Decimal(n)).cast("decimal(20,0)")


def payload(*parts: Column | str, sep: str = ":") -> Column:
    """Parts joined by ``sep``; string arguments are literals, so that domains can be told apart."""
    return F.concat_ws(sep, *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def json_payload(*parts: Column | str) -> Column:
    """Parts as a compact JSON list of strings."""
    return F.to_json(F.array(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts)))


def nul_payload(*parts: Column | str) -> Column:
    """Parts joined by NUL."""
    return payload(*parts, sep="\x00")


def u64_hex(data: Column) -> Column:
    """The draw as 16 hexadecimal digits; they sort as the integer does."""
    return F.substring(F.sha2(data, 256), 1, 16)


def u64(data: Column) -> Column:
    """The draw as decimal(20, 0)."""
    return F.conv(u64_hex(data), 16, 10).cast("decimal(20,0)")


def uniform(data: Column) -> Column:
    """The draw over 2^64, as a double in [0, 1); decide with ``u64``, not with this."""
    return u64(data).cast("double") / float(SPAN)


def below(data: Column, total: Column) -> Column:
    """Integer draw in [0, total), exact: draw * total div 2^64. Null for a total that is not positive."""
    scaled = u64(data).cast("decimal(20,0)") * total.cast("decimal(17,0)")
    # the quotient's 64 binary places are cut after the whole part: subtract the remainder, then divide exactly
    span = _wide(SPAN)
    return F.when(total > 0, ((scaled - scaled % span) / span).cast("long"))


def threshold(p: Fraction | str | float) -> int:
    """Least integer t with t / 2^64 >= p, so that ``draw < t`` has probability p. A float counts as what it holds in binary, text as the decimal."""
    return ceil(Fraction(p) * SPAN)


def bernoulli(data: Column, p: Fraction | str | float) -> Column:
    """True with probability p."""
    t = threshold(p)
    return F.lit(True) if t >= SPAN else u64(data) < _wide(t)


def pick(data: Column, items: Column) -> Column:
    """One element of an array, by the draw modulo its size; null for an empty or null array."""
    n = F.size(items)
    at = F.when(n > 0, (u64(data) % n.cast("decimal(20,0)")).cast("int"))
    return F.get(items, at)


def rate_label(data: Column, rates: list[tuple[str, str]], rest: str) -> Column:
    """Label by cumulative decimal rates, in the order given; ``rest`` takes what remains."""
    draw, total, steps = u64(data), Fraction(0), []
    for label, rate in rates:
        total += Fraction(rate)
        steps.append((label, min(ceil(total * SPAN), SPAN)))
    out = F.lit(rest)
    for label, limit in reversed(steps):
        out = F.when(draw < _wide(limit), F.lit(label)).otherwise(out)
    return out


def rate_label_by(stratum: Column, data: Column, tables: dict[str, list[tuple[str, str]]], rest: str, unknown: str = "unknown") -> Column:
    """``rate_label`` with a table for each stratum; a stratum without a table, or null, is ``unknown``."""
    out = F.lit(unknown)
    for name, rates in sorted(tables.items()):
        out = F.when(stratum == name, rate_label(data, rates, rest)).otherwise(out)
    return out


def compatible_label(data: Column, weights: dict[str, int], allowed: Column) -> Column:
    """Weighted label among those in the array ``allowed``, weights renormalised; null if none is allowed."""
    fit = {k: F.when(F.array_contains(allowed, k), F.lit(w)).otherwise(F.lit(0)) for k, w in weights.items()}
    total = sum(fit.values(), F.lit(0))
    at, run, out = below(data, total), F.lit(0), F.lit(None).cast("string")
    steps = []
    for k in fit:
        run = run + fit[k]
        steps.append((k, run))
    for k, limit in reversed(steps):
        out = F.when(at < limit, F.lit(k)).otherwise(out)
    return out


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """Name-based UUID: SHA-1 of namespace and name with version and variant set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.element_at(F.array(*map(F.lit, "89ab")), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1)
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))
