"""Rows at given positions of an order, by selection instead of sorting.

Quintiles need four cut rows a column, a percentile two. ``rows_at`` finds them
by sampled splitters: a bracket (two rows, both outside it) is kept for every
wanted position; a round takes a sample of each bracket, picks the two sampled rows
that most likely enclose the position, counts the rows below and at them, and
narrows the bracket, until it holds at most ``sample`` rows, which are fetched and
sorted. A round is two scans of the narrow columns without a shuffle of rows; what
reaches the driver is about ``sample`` rows a bracket and a few counts. With n rows
a round leaves a share of about 6 / sqrt(sample) of a bracket, so a thousand
million rows take five rounds. The rows found don't depend on the samples: counts
are exact and a wrong guess only costs another round. A row that many equal rows
repeat is found by its count, it never has to be fetched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import floor, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Row = tuple  # (value, key)


@dataclass
class _Bracket:
    metric: str
    position: int                  # 1-based, in the whole order
    low: Row | None = None         # the rows between low and high, both left out
    high: Row | None = None
    before: int = 0                # rows up to and with ``low``
    size: int = 0                  # rows inside
    found: Row | None = None


def _below(v: str, k: str, row: Row) -> Column:
    return (F.col(v) < F.lit(row[0])) | ((F.col(v) == F.lit(row[0])) & (F.col(k) < F.lit(row[1])))


def _equal(v: str, k: str, row: Row) -> Column:
    return (F.col(v) == F.lit(row[0])) & (F.col(k) == F.lit(row[1]))


def _inside(b: _Bracket, v: str, k: str) -> Column:
    cond = F.col(v).isNotNull()
    if b.low is not None:
        cond = cond & ~_below(v, k, b.low) & ~_equal(v, k, b.low)
    return cond & _below(v, k, b.high) if b.high is not None else cond


def _guess(sampled: list[Row], b: _Bracket) -> tuple[Row, Row]:
    """The two sampled rows around the position, three deviations apart on each side."""
    m = len(sampled)
    at = (b.position - b.before - 0.5) / b.size * m
    spread = 3.0 * sqrt(m) / 2.0 + 1.0
    return sampled[max(0, min(m - 1, floor(at - spread)))], sampled[max(0, min(m - 1, floor(at + spread)))]


def rows_at(table: DataFrame, key: str, metrics: list[str], positions: Callable[[int], list[int]],
            sample: int = 20_000, seed: int = 42) -> dict[str, tuple[int, dict[int, Row]]]:
    """For each metric: how many rows have a value, and the (value, key) rows at
    the 1-based ``positions(that number)`` of the order (value, key). Nulls are
    ignored; keys must not be null. ``table`` is read several times, so it should be
    a written one. A metric without values has no positions and an empty result."""
    counts = table.agg(*[F.count(m).alias(m) for m in metrics]).first()
    wanted = {m: [p for p in positions(counts[m]) if 1 <= p <= counts[m]] for m in metrics}
    brackets = [_Bracket(m, p, size=counts[m]) for m in metrics for p in sorted(set(wanted[m]))]
    round_no = 0
    while todo := [b for b in brackets if b.found is None]:
        # equal brackets share one sample
        groups: dict[tuple, list[_Bracket]] = {}
        for b in todo:
            groups.setdefault((b.metric, b.low, b.high), []).append(b)
        drawn = _draw(table, key, [g[0] for g in groups.values()], sample, seed + round_no)
        narrowed = []
        for got, group in zip(drawn, groups.values()):
            for b in group:
                if b.size <= sample:
                    b.found = got[b.position - b.before - 1]
                elif got:
                    narrowed.append((b, *_guess(got, b)))
        if narrowed:
            _narrow(table, key, narrowed)
        round_no += 1
    out: dict[str, tuple[int, dict[int, Row]]] = {m: (counts[m], {}) for m in metrics}
    for b in brackets:
        out[b.metric][1][b.position] = b.found
    return out


def _draw(table: DataFrame, key: str, brackets: list[_Bracket], sample: int, seed: int) -> list[list[Row]]:
    """Per bracket its rows in order: all, if at most ``sample``, else about as many at random."""
    u = table.select(key, *sorted({b.metric for b in brackets})).withColumn("_u", F.rand(seed))
    entries = [F.when(_inside(b, b.metric, key) & (F.col("_u") < F.lit(min(1.0, sample / b.size) if b.size > sample else 2.0)),
                      F.struct(F.lit(i).alias("i"), F.col(b.metric).alias("v"), F.col(key).alias("k"))) for i, b in enumerate(brackets)]
    rows = u.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*").collect()
    out: list[list[Row]] = [[] for _ in brackets]
    for r in rows:
        out[r["i"]].append((r["v"], r["k"]))
    return [sorted(some) for some in out]


def _narrow(table: DataFrame, key: str, tried: list[tuple[_Bracket, Row, Row]]) -> None:
    aggs = []
    for i, (b, low, high) in enumerate(tried):
        for name, row in (("l", low), ("h", high)):
            aggs += [F.count_if(_below(b.metric, key, row)).alias(f"{name}{i}"), F.count_if(_equal(b.metric, key, row)).alias(f"{name}e{i}")]
    c = table.agg(*aggs).first()
    for i, (b, low, high) in enumerate(tried):
        end = b.before + b.size
        for row, under, same in ((low, c[f"l{i}"], c[f"le{i}"]), (high, c[f"h{i}"], c[f"he{i}"])):
            if under < b.position <= under + same:
                b.found = row
            elif under + same < b.position:        # the row lies above
                if b.low is None or row > b.low:
                    b.low, b.before = row, under + same
            elif b.high is None or row < b.high:   # below
                b.high, end = row, under
        b.size = end - b.before


def quintile_cuts(n: int, k: int = 5) -> list[int]:
    """Positions of the last row of bins 1 .. k - 1 of ``rules.quintile``."""
    return [1 + j * (n - 1) // k for j in range(1, k)] if n else []


def bin_of(metric: str, key: str, cuts: list[Row]) -> Column:
    """1 + the number of cut rows below a row."""
    above = [(~_below(metric, key, c) & ~_equal(metric, key, c)).cast("int") for c in cuts]
    return sum(above, F.lit(1)).cast("int")


def quantile_positions(n: int, q: float) -> list[int]:
    low = floor(q * (n - 1)) + 1
    return [low, min(low + 1, n)] if n else []


def quantile(n: int, rows: dict[int, Row], q: float, scale: int = 1) -> float | None:
    """Linear interpolation between the two rows, as NumPy writes it; values
    are integers of 1/``scale``."""
    if not n:
        return None
    a, b = (rows[p][0] / scale for p in quantile_positions(n, q))
    t = q * (n - 1) - floor(q * (n - 1))
    return b - (b - a) * (1.0 - t) if t >= 0.5 else a + (b - a) * t
