"""Column expressions (all JVM-side, inside whole-stage codegen).

Each function takes and returns ``Column`` objects so it can be used in
``select``/``withColumn``/``filter`` on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric(c) -> Column:
    """A column as double with NaN as NULL: the one cast all statistics read through."""
    x = col_of(c).cast("double")
    return F.when(~F.isnan(x), x)


# ---------------------------------------------------------------- predicates

def threshold_flag(c, t: float) -> Column:
    """``c <= t`` as boolean; a NULL value gives False (as a pandas comparison with NaN)."""
    return F.coalesce(col_of(c) <= F.lit(t), F.lit(False))


def not_equal_keep_null(c, value) -> Column:
    """True for rows that are not equal to ``value``; NULL rows are kept (True)."""
    return ~col_of(c).eqNullSafe(F.lit(value))


def between_expr(c, lo=None, hi=None, closed: str = "both") -> Column:
    """Range predicate with open/closed ends; ``closed`` in {'both','left','right','neither'}."""
    x = col_of(c)
    parts = []
    if lo is not None:
        parts.append(x >= lo if closed in ("both", "left") else x > lo)
    if hi is not None:
        parts.append(x <= hi if closed in ("both", "right") else x < hi)
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def all_of(preds: Iterable[Column]) -> Column:
    """Row passes only if every predicate passes (NULL counts as failing)."""
    preds = [F.coalesce(p, F.lit(False)) for p in preds]
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def starts_with(c, prefix: str) -> Column:
    return col_of(c).startswith(prefix)


# ---------------------------------------------------------------- recoding

def replace_expr(c, mapping: Mapping) -> Column:
    """Many-to-one value replacement; values not in ``mapping`` are kept."""
    x = col_of(c)
    if not mapping:
        return x
    out = None
    for k, v in mapping.items():
        out = (F.when(x == F.lit(k), F.lit(v)) if out is None else out.when(x == F.lit(k), F.lit(v)))
    return out.otherwise(x)


def prefix_expr(c, rules: Sequence[tuple[str, str]]) -> Column:
    """First matching prefix wins; unmatched and NULL values are kept."""
    x = col_of(c)
    out = None
    for prefix, label in rules:
        cond = x.startswith(prefix)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return x if out is None else out.otherwise(x)


def groups_expr(c, groups: Mapping[str, Sequence]) -> Column:
    """Map every listed code to its group label; unlisted values are kept."""
    x = col_of(c)
    out = None
    for label, values in groups.items():
        cond = x.isin(list(values))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return x if out is None else out.otherwise(x)


def cut_expr(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(e[i], e[i+1]]`` -> labels[i]; at/below the first edge,
    above the last edge and NULL -> NULL (pandas ``cut`` semantics)."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    x = col_of(c)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def rules_expr(rules: Sequence[tuple[Column, object]]) -> Column:
    """Ordered (condition, label) rules; first true wins, no match -> NULL."""
    out = None
    for cond, lab in rules:
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def mean_bins_expr(c, mean: float, labels) -> Column:
    """(zero, small, big) labels: 0 -> zero, 0 < x < mean -> small, x >= mean -> big, else NULL."""
    x = numeric(c)
    zero, small, big = labels
    return (F.when(x == 0, F.lit(zero))
            .when((x > 0) & (x < F.lit(mean)), F.lit(small))
            .when(x >= F.lit(mean), F.lit(big)))


def presence_expr(c, yes=1, no=0) -> Column:
    """NULL -> ``no``, anything else -> ``yes``."""
    return F.when(col_of(c).isNull(), F.lit(no)).otherwise(F.lit(yes))


def nonzero_expr(c, one=1) -> Column:
    """x != 0 -> ``one``; 0 stays 0; NULL stays NULL."""
    x = col_of(c)
    return F.when(x != 0, F.lit(one)).otherwise(x)


def extract_group(c, pattern: str, idx: int = 1) -> Column:
    """First match's group ``idx``; '' when there is no match (or NULL input -> NULL)."""
    return F.regexp_extract(col_of(c), pattern, idx)


# ---------------------------------------------------------------- numeric

def safe_log1p(c) -> Column:
    """ln(1+x); x <= -1 -> NULL (numpy would give -inf/NaN)."""
    x = col_of(c)
    return F.when(x > -1, F.log1p(x))


def swish(c) -> Column:
    """x / (1 + e^-x)."""
    x = col_of(c)
    return x / (F.lit(1.0) + F.exp(-x))


def zscore_expr(c, mean: float, std: float) -> Column:
    """(x - mean) / std with population std; zero variance -> 0."""
    x = numeric(c)
    if std == 0 or std is None:
        return F.when(x.isNotNull(), F.lit(0.0))
    return (x - F.lit(mean)) / F.lit(std)


def argmax_index(arr) -> Column:
    """0-based index of the largest element; first one on ties; empty/NULL -> NULL."""
    a = col_of(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def one_hot_array(c, k: int) -> Column:
    """Label 0..k-1 -> length-k array of 0.0/1.0."""
    x = col_of(c)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                       lambda i: F.when(i == x, F.lit(1.0)).otherwise(F.lit(0.0)))


def sum_of(cols: Sequence) -> Column:
    return reduce(lambda a, b: a + b, [col_of(c) for c in cols])
