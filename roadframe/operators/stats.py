"""Exact order statistics without a global sort or a whole-column collect.

``kth_smallest`` finds the k-th smallest value of a column (optionally per
group) by narrowing brackets, in two aggregates for up to some million rows a group:

1. every (group, rank) starts with the bracket (-inf, +inf); one aggregate gives each
   bracket's size, ends and approximate quantiles;
2. the quantiles around the wanted ranks become split points. The next aggregate counts
   the rows equal to every point and strictly between neighbours, and gives the values
   of the ranges in which the ranks must lie, if these hold at most about ``max_collect``
   rows. A rank on a point or in a fetched range is solved; any other goes on with its range.

A hot value is a quantile of its bracket, so it becomes a point of its own and
never fills a range. Every range leaves out all split points, and a round whose
range is not smaller than its bracket raises an error: the driver never fetches
more than about ``max_collect`` pairs. Rounds grow with the logarithm of the row count to the
base ``buckets``; each is a column-pruned scan and a map-side-combined aggregate.

Values known to be spread evenly (hashes) in groups of known size need no first aggregate: the
rank's place follows from the size, and a window of eight standard deviations is fetched at once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import add

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GROUP = "__g"
_VAL = "__v"
_BID = "__bid"
_CODE = "__code"
#: Split points of a bracket up to which a row's place is a sum of comparisons.
_COMPARED_POINTS = 24


@dataclass
class _Bracket:
    group: object
    lo: object          # exclusive lower bound, None = -inf
    hi: object          # exclusive upper bound, None = +inf
    below: int          # rows of the group with value <= lo
    ranks: list         # 0-based ranks (within the group) to resolve here
    rows: int | None    # rows in the bracket, None before the first count


@dataclass
class _Cut:
    """What one pass does to a bracket: count at ``points``, fetch the values in the ranges named ``fetched``."""
    bracket: _Bracket
    points: list
    fetched: set        # codes: 2 j is the open range below point j and above the one before, 2 j + 1 is point j
    rows: int = 0       # rows that the fetched ranges should hold
    sure: bool = True   # some point is a value of the bracket


def _in_bracket(b: _Bracket, has_group: bool) -> Column:
    cond = F.col(_VAL).isNotNull()
    if has_group:
        cond = cond & (F.col(_GROUP) == F.lit(b.group)) if b.group is not None else cond & F.col(_GROUP).isNull()
    if b.lo is not None:
        cond = cond & (F.col(_VAL) > F.lit(b.lo))
    if b.hi is not None:
        cond = cond & (F.col(_VAL) < F.lit(b.hi))
    return cond


def _tag(data: DataFrame, brackets: list[_Bracket], has_group: bool) -> DataFrame:
    """Attach the bracket id of each row (brackets are disjoint); rows in no bracket are dropped."""
    own = F.coalesce(*[F.when(_in_bracket(b, has_group), F.lit(i)) for i, b in enumerate(brackets)])
    return data.select(own.alias(_BID), F.col(_VAL)).filter(F.col(_BID).isNotNull())


def kth_smallest(df: DataFrame, value_col: str, ranks, group_col: str | None = None,
                 buckets: int = 256, max_collect: int = 20000, uniform: bool = False) -> dict:
    """Exact k-th smallest values.

    ``ranks``: list of 0-based ranks (no groups) or ``{group: [ranks]}``; a
    group's ranks may be a function of its size. ``uniform``: the values are
    spread evenly, so the first round splits by equal width.
    Returns ``{(group, rank): value}`` (group is None without ``group_col``).
    """
    found = kth_with_counts(df, value_col, ranks, group_col, buckets, max_collect, uniform)
    return {k: v for k, (v, _, _) in found.items()}


def kth_with_counts(df: DataFrame, value_col: str, ranks, group_col: str | None = None, buckets: int = 256,
                    max_collect: int = 20000, uniform: bool = False, hash_sizes: dict | None = None) -> dict:
    """``kth_smallest`` with counts: ``{(group, rank): (value, rows below the value, rows equal to it)}``.

    ``hash_sizes``: the groups' row counts, if the values are 64-bit hashes without NULLs.
    """
    has_group = group_col is not None
    data = df.select((F.col(group_col) if has_group else F.lit(None)).alias(_GROUP),
                     F.col(value_col).alias(_VAL)).filter(F.col(_VAL).isNotNull())
    active = [_Bracket(g, None, None, 0, rs if callable(rs) else sorted({int(r) for r in rs}), None)
              for g, rs in (ranks if isinstance(ranks, dict) else {None: ranks}).items() if callable(rs) or rs]
    result: dict = {}
    if hash_sizes is not None:
        cuts, budget = [], max_collect
        for b in active:
            b.rows = hash_sizes[b.group]
            _check_ranks(b, b.rows)
            cuts.append(_hash_windows(b, budget))
            budget -= cuts[-1].rows
        active = _pass(data, cuts, has_group, max_collect, result) if cuts else []
    if not active:
        return result
    # the narrow (group, value) projection is scanned a few times: keep it
    # (memory, spilling to disk) so upstream joins are not re-run every round;
    # a lost block is recomputed from lineage
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _refine(data, active, has_group, buckets, max_collect, uniform and hash_sizes is None, result)
    finally:
        data.unpersist()


def _check_ranks(b: _Bracket, n: int) -> None:
    if b.ranks[-1] - b.below >= n or b.ranks[0] < 0:
        raise ValueError(f"rank {b.ranks[-1]} out of range for group {b.group!r}")


def _refine(data: DataFrame, active: list[_Bracket], has_group: bool, buckets: int, max_collect: int, uniform: bool, result: dict) -> dict:
    first = True
    while active:
        known = [b for b in active if b.rows is not None and b.rows <= max_collect]
        if known:
            sums = accumulate(b.rows for b in known)
            part = [b for b, s in zip(known, sums) if s <= max_collect]
            left = _pass(data, [_Cut(b, [], {0}, b.rows) for b in part], has_group, max_collect, result)
            if left:
                raise RuntimeError("the data changed between two passes")
            active = [b for b in active if not any(b is x for x in part)]
            continue
        even = uniform and first
        found = {r[_BID]: r for r in _tag(data, active, has_group).groupBy(_BID).agg(
            F.count(F.lit(1)).alias("n"), F.min(_VAL).alias("lo"), F.max(_VAL).alias("hi"),
            *([] if even else [F.percentile_approx(_VAL, [j / buckets for j in range(1, buckets)], 10 * buckets).alias("q")])).collect()}
        cuts, later, budget = [], [], max_collect
        for i, b in enumerate(active):
            n = found[i]["n"] if i in found else 0
            if callable(b.ranks):
                b.ranks = sorted({int(r) for r in b.ranks(n)})
            if not b.ranks:
                continue
            _check_ranks(b, n)
            if b.rows is not None and b.rows != n:
                raise RuntimeError("the data changed between two passes")
            b.rows = n
            if n <= max_collect and n > budget:
                later.append(b)
                continue
            cuts.append(_Cut(b, [], {0}, n) if n <= budget else _near_ranks(b, _grid(found[i], buckets, even), budget))
            budget -= cuts[-1].rows
        active = later + (_pass(data, cuts, has_group, max_collect, result) if cuts else [])
        first = False
    return result


def _grid(row, buckets: int, even: bool) -> list:
    """A bracket's smallest value, its quantiles (or even steps between its ends) and its largest one."""
    lo, hi = row["lo"], row["hi"]
    if not even:
        return [lo, *row["q"], hi]
    if isinstance(lo, int):
        return [lo + (hi - lo) * j // buckets for j in range(buckets + 1)]
    return [lo, *(lo + (hi - lo) * j / buckets for j in range(1, buckets)), hi]


def _near_ranks(b: _Bracket, grid: list, budget: int) -> _Cut:
    """The grid's points around each wanted rank, and its ends; the ranges between the former are fetched if that fits."""
    steps = len(grid) - 1
    spans = [(max(0, at - 1), min(steps, at + 2)) for at in ((k - b.below) * steps // b.rows for k in b.ranks)]
    near = sorted({i for lo, hi in spans for i in range(lo, hi + 1)} | {0, steps})
    points = sorted({grid[i] for i in near if grid[0] <= grid[i] <= grid[-1]})
    place = {p: j for j, p in enumerate(points)}
    gaps = {i for lo, hi in spans for i in range(lo, hi)}
    rows = math.ceil(1.2 * b.rows * len(gaps) / steps)
    if rows > budget:
        return _Cut(b, points, set())
    return _Cut(b, points, {2 * j for i in gaps for j in range(place[grid[i]] + 1, place[grid[i + 1]] + 1)}, rows)


def _hash_windows(b: _Bracket, budget: int) -> _Cut:
    """Where 64-bit hashes put the wanted ranks: within eight standard deviations of the rank."""
    low, n = -(1 << 63), b.rows
    half = ((4 * math.isqrt(n) + 16) << 64) // n
    ends = [(max(low, at - half), min(-low - 1, at + half)) for at in (low + (k << 64) // n for k in b.ranks)]
    points = sorted({x for e in ends for x in e})
    fetched = {2 * j for j in range(1, len(points)) if any(lo <= points[j - 1] and points[j] <= hi for lo, hi in ends)}
    rows = min(n, len(ends) * 2 * (4 * math.isqrt(n) + 16))
    return _Cut(b, points, fetched, rows, sure=False) if rows <= budget else _Cut(b, points, set(), sure=False)


def _code(points: list) -> Column:
    """2 j: strictly below point j and above the one before; 2 j + 1: equal to point j."""
    v = F.col(_VAL)
    if not points:
        return F.lit(0)
    if len(points) <= _COMPARED_POINTS:
        return reduce(add, [(v > F.lit(p)).cast("int") + (v >= F.lit(p)).cast("int") for p in points])
    arr = F.array(*[F.lit(p) for p in points])
    return 2 * F.size(F.filter(arr, lambda x: x < v)) + F.array_contains(arr, v).cast("int")


def _pass(data: DataFrame, cuts: list[_Cut], has_group: bool, max_collect: int, result: dict) -> list[_Bracket]:
    """Count rows on and between the cuts' points, fetch the named ranges; solves ranks, returns the ranges that hold the others."""
    tagged = _tag(data, [c.bracket for c in cuts], has_group)
    code = reduce(lambda e, x: e.when(F.col(_BID) == x[0], _code(x[1].points)), enumerate(cuts[1:], 1), F.when(F.col(_BID) == 0, _code(cuts[0].points)))
    wanted = [(F.col(_BID) == i) & F.col(_CODE).isin(sorted(c.fetched)) for i, c in enumerate(cuts) if c.fetched]
    coded = tagged.withColumn(_CODE, code)
    sizes = sum(2 * len(c.points) + 1 for c in cuts)
    if wanted:
        shown = F.when(reduce(lambda x, y: x | y, wanted), F.col(_VAL))
        limit = 2 * max_collect + sizes
        rows = coded.groupBy(_BID, _CODE, shown.alias(_VAL)).agg(F.count(F.lit(1)).alias("c")).limit(limit + 1).collect()
        if len(rows) > limit:  # the approximation was far off: count alone
            return _pass(data, [_Cut(c.bracket, c.points, set(), sure=c.sure) if c.points else c for c in cuts], has_group, max_collect, result)
    else:
        rows = coded.groupBy(_BID, _CODE).agg(F.count(F.lit(1)).alias("c")).withColumn(_VAL, F.lit(None)).collect()
    per: dict = {}
    for r in rows:
        per.setdefault((r[_BID], r[_CODE]), []).append((r[_VAL], r["c"]))
    out = []
    for i, cut in enumerate(cuts):
        b, at, left = cut.bracket, cut.bracket.below, list(cut.bracket.ranks)
        for code_ in range(2 * len(cut.points) + 1):
            runs = per.get((i, code_), [])
            if code_ in cut.fetched or code_ % 2:
                for v, c in sorted(runs, key=lambda t: t[0]) if code_ in cut.fetched else [(cut.points[code_ // 2], c) for _, c in runs]:
                    while left and left[0] < at + c:
                        result[b.group, left.pop(0)] = (v, at, c)
                    at += c
                continue
            c = sum(c for _, c in runs)
            inside = [k for k in left if k < at + c]
            left = left[len(inside):]
            if inside:
                if cut.sure and c >= b.rows:
                    raise RuntimeError("a round made no progress")
                j = code_ // 2
                out.append(_Bracket(b.group, b.lo if j == 0 else cut.points[j - 1], b.hi if j == len(cut.points) else cut.points[j], at, inside, c))
            at += c
        if left:
            raise RuntimeError("the data changed between two passes")
    return out


def exact_medians(df: DataFrame, cols: list[str], **kw) -> dict[str, float | None]:
    """Exact medians (mean of the two middle values) of several columns.

    The columns are unpivoted into (name, value) so all of them share the
    same refinement rounds: one scan per round, not one per column.
    """
    return stacked_medians(stack(df, cols), cols, **kw) if cols else {}


def stack(df: DataFrame, cols: list[str]) -> DataFrame:
    """(name, value): one row for each value of the columns that is not NULL."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols
    ]))).filter(F.col("value").isNotNull())


def stacked_medians(stacked: DataFrame, names: list[str], **kw) -> dict[str, float | None]:
    """Exact median of each name's values in a (name, value) table, which may hold columns of several tables."""
    sizes: dict[str, int] = {}

    def mid(name):
        def fn(n):
            sizes[name] = n
            return sorted({(n - 1) // 2, n // 2}) if n > 0 else []
        return fn

    vals = kth_smallest(stacked, "value", {c: mid(c) for c in names}, group_col="name", **kw)
    out: dict[str, float | None] = {}
    for c in names:
        n = sizes.get(c, 0)
        if n == 0:
            out[c] = None
            continue
        a, b = vals[(c, (n - 1) // 2)], vals[(c, n // 2)]
        out[c] = (float(a) + float(b)) / 2.0
    return out


def medians_by_value(df: DataFrame, cols: list[str], max_values: int = 20000) -> dict[str, float | None]:
    """Exact medians of columns with few distinct values (clipped ones): one job that counts each value.

    At most ``max_values`` pairs reach the driver; more distinct values raise an error (use ``exact_medians``).
    """
    stacked = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols])))
    rows = stacked.filter(F.col("value").isNotNull()).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n")).limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"more than {max_values} distinct values")
    out: dict[str, float | None] = {}
    for c in cols:
        pairs = sorted((r["value"], r["n"]) for r in rows if r["name"] == c)
        n = sum(k for _, k in pairs)
        at = [0, *accumulate(k for _, k in pairs)]
        mid = [next(v for (v, _), end in zip(pairs, at[1:]) if r < end) for r in ((n - 1) // 2, n // 2)] if n else None
        out[c] = sum(mid) / 2 if mid else None
    return out


def exact_median(df: DataFrame, col: str, **kw) -> float | None:
    return exact_medians(df, [col], **kw)[col]


def fill_with_medians(df: DataFrame, cols: list[str], median_source: dict[str, str] | None = None,
                      **kw) -> tuple[DataFrame, dict]:
    """NULL -> median, for every column in ``cols``.

    ``median_source`` lets a column borrow another column's median (the
    original pipeline fills ``jour`` with the median of ``mois``).
    Filled columns become double, like a numeric column holding NaN.
    """
    median_source = median_source or {}
    need = sorted({median_source.get(c, c) for c in cols})
    med = exact_medians(df, need, **kw)
    out = df
    for c in cols:
        m = med[median_source.get(c, c)]
        out = out.withColumn(c, F.coalesce(F.col(f"`{c}`").cast("double"),
                                           F.lit(m).cast("double")))
    return out, med

