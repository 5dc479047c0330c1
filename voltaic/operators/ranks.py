"""Exact order statistics without a global sort or a single-partition window.

``select_ranks`` returns, for each request ``(order_cols, k)``, the k-th
smallest (1-based) value of ``order_cols`` (a tuple, ordered
lexicographically) among rows whose first column is not NULL.

1. One pass counts the non-NULL rows of each request.
2. While a request's candidate range holds more than ``max_bracket`` rows,
   narrow it: ``percentile_approx`` (rank error at most m/accuracy for m rows
   in range) brackets rank k between two values of the first column, and one
   counting pass fixes how many rows fall below the bracket. Each round
   shrinks the range by about accuracy/4, and all requests share every pass.
3. One aggregate collects each request's remaining candidates - at most
   ``max_bracket``, whatever the table size - and picks the one at rank
   ``k - below``. A search that does not get there raises.

Only scalars reach the driver.
"""
from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic.functions.exprs import lit_for


def disc_rank(p: float, n: int) -> int:
    """Rank (1-based) of the discrete ``p`` quantile of ``n`` values:
    ``max(1, ceil(p * n))`` with ``p`` taken as the decimal it is written as."""
    return max(1, math.ceil(Fraction(str(p)) * n)) if n > 0 else 0


def _bracket(df: DataFrame, col: str, b: dict) -> Column:
    """Rows of ``col`` inside the bracket ``b`` (open bounds after a narrowing round)."""
    c = F.col(col)
    cond = c.isNotNull()
    if b["lo"] is not None:
        lo = lit_for(df, col, b["lo"])
        cond = cond & ((c > lo) if b["lo_open"] else (c >= lo))
    if b["hi"] is not None:
        hi = lit_for(df, col, b["hi"])
        cond = cond & ((c < hi) if b["hi_open"] else (c <= hi))
    return cond


def count_nonnull(df: DataFrame, cols: Sequence[str]) -> dict:
    uniq = list(dict.fromkeys(cols))
    row = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(uniq)]).first()
    return {c: int(row[f"n{i}"]) for i, c in enumerate(uniq)}


def select_ranks(
    df: DataFrame,
    requests: Sequence[tuple[Sequence[str], int]],
    *,
    accuracy: int = 10000,
    max_bracket: int = 1_000,
    max_rounds: int = 40,
    counts: dict | None = None,
) -> list:
    """Exact k-th values; ``None`` for ``k <= 0`` or ``k`` beyond the rows.

    Ties are handled without ever gathering a tie group: when rank k falls on
    a value of the first column shared by many rows, that value is the answer
    for the first column and the search continues on the next column among
    the tied rows only (recursively). Brackets that exclude their edge values
    are open, so a hot value never stays inside a bracket it is not part of.
    """
    reqs = [(tuple(cols), int(k)) for cols, k in requests]
    counts = counts or count_nonnull(df, [c[0] for c, _ in reqs])
    st = [{"lo": None, "hi": None, "lo_open": False, "hi_open": False, "below": 0,
           "inside": counts[c[0]], "margin": 2} for c, _ in reqs]
    answers: dict[int, tuple] = {}
    ties: dict[int, tuple] = {}   # request -> (first value, rank among the tied rows)
    live = [i for i, (c, k) in enumerate(reqs) if 0 < k <= counts[c[0]]]

    for _ in range(max_rounds):
        wide = [i for i in live if i not in ties and st[i]["inside"] > max_bracket]
        if not wide:
            break
        aggs = []
        for i in wide:
            (cols, k), b = reqs[i], st[i]
            m, r = b["inside"], k - b["below"]
            margin = b["margin"] * math.ceil(m / accuracy) + 2
            qs = [max(0.0, (r - margin) / m), min(1.0, (r + margin) / m)]
            inside = F.when(_bracket(df, cols[0], b), F.col(cols[0]))
            aggs.append(F.percentile_approx(inside, qs, accuracy).alias(f"q{i}"))
        qrow = df.agg(*aggs).first()
        cnt = []
        for i in wide:
            lo, hi = qrow[f"q{i}"]
            name = reqs[i][0][0]
            c, lo_l, hi_l = F.col(name), lit_for(df, name, lo), lit_for(df, name, hi)
            cnt += [F.count_if(c < lo_l).alias(f"lt{i}"), F.count_if(c == lo_l).alias(f"eqlo{i}"),
                    F.count_if(c <= hi_l).alias(f"le{i}"), F.count_if(c == hi_l).alias(f"eqhi{i}")]
        crow = df.agg(*cnt).first()
        for i in wide:
            lo, hi = qrow[f"q{i}"]
            k = reqs[i][1]
            lt, eq_lo = int(crow[f"lt{i}"]), int(crow[f"eqlo{i}"])
            le, eq_hi = int(crow[f"le{i}"]), int(crow[f"eqhi{i}"])
            if not (lt < k <= le):          # outside the approximate bracket: widen and retry
                st[i]["margin"] *= 4
            elif k <= lt + eq_lo:           # rank k falls on the value lo
                ties[i] = (lo, k - lt)
            elif k > le - eq_hi:            # rank k falls on the value hi
                ties[i] = (hi, k - (le - eq_hi))
            else:                           # strictly between: open bracket (lo, hi)
                st[i].update(lo=lo, hi=hi, lo_open=True, hi_open=True, below=lt + eq_lo,
                             inside=le - eq_hi - lt - eq_lo)

    stuck = [reqs[i] for i in live if i not in ties and st[i]["inside"] > max_bracket]
    if stuck:
        raise RuntimeError(f"rank search did not narrow {stuck} in {max_rounds} rounds")

    for i, (value, r) in ties.items():
        cols = reqs[i][0]
        if len(cols) == 1:
            answers[i] = (value,)
        else:
            rest = select_ranks(df.filter(F.col(cols[0]) == lit_for(df, cols[0], value)), [(cols[1:], r)],
                                accuracy=accuracy, max_bracket=max_bracket, max_rounds=max_rounds)[0]
            answers[i] = None if rest is None else (value, *rest)

    final = [i for i in live if i not in ties]
    if final:
        # One scan for all requests: each gathers its few candidates in order.
        picks = []
        for i in final:
            cols, k = reqs[i]
            key = F.struct(*[F.col(c).alias(f"c{j}") for j, c in enumerate(cols)])
            inside = F.sort_array(F.collect_list(F.when(_bracket(df, cols[0], st[i]), key)))
            picks.append(F.try_element_at(inside, F.lit(k - st[i]["below"])).alias(f"r{i}"))
        row = df.agg(*picks).first()
        answers.update({i: tuple(row[f"r{i}"]) for i in final if row[f"r{i}"] is not None})
    return [answers.get(i) for i in range(len(reqs))]


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], **kw) -> dict:
    """Discrete quantiles (``percentile_disc`` semantics) of several columns:
    ``{(col, p): value}``; NULLs ignored; ``None`` for an all-NULL column."""
    counts = count_nonnull(df, cols)
    pairs = [(c, p) for c in cols for p in probs]
    vals = select_ranks(df, [((c,), disc_rank(p, counts[c])) for c, p in pairs], counts=counts, **kw)
    return {pair: (v[0] if v is not None else None) for pair, v in zip(pairs, vals)}
