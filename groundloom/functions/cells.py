"""Expressions over label columns, sentinels and small value lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundloom.functions.indices import as_col

MISSING_VOTE = -99
NO_CONSENSUS = -9999
NO_RANGE = 99


def fill_sentinel(c: Column | str, sentinel: int = MISSING_VOTE) -> Column:
    return F.coalesce(as_col(c).cast("int"), F.lit(sentinel))


def true_label(c: Column | str, positive: str) -> Column:
    """Class text to 1 for the positive class and 0 for any other; NULL stays NULL."""
    return (as_col(c) == positive).cast("int")


def round_floats(df: DataFrame, digits: int = 7) -> DataFrame:
    """Floating-point columns rounded half to even; other columns unchanged."""
    return df.select(*[F.bround(c, digits).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


def recode(classes: Sequence[str], codes: Mapping[str, int]) -> Column:
    """Code of the class column with the largest value, the first one on a tie."""
    values = F.array(*[F.col(c) for c in classes])
    best = F.array_position(values, F.array_max(values)).cast("int")
    code_list = F.array(*[F.lit(codes[c]) for c in classes])
    return F.when(best > 0, F.element_at(code_list, F.greatest(best, F.lit(1))))


def check_exclusive(classes: Sequence[str], total: int = 100) -> dict[str, Column]:
    """Class columns that become NULL in rows where they do not add up to ``total``."""
    row_sum = sum((F.coalesce(F.col(c), F.lit(0)) for c in classes), F.lit(0))
    return {c: F.when(row_sum == total, F.col(c)) for c in classes}


def robust_range(elevations: Sequence[str], mean: Column | str, sd: Column | str) -> Column:
    """Max minus min of the elevations within two deviations of the mean; 99 if none is."""
    mean, sd = as_col(mean), as_col(sd)
    values = [F.col(c).cast("double") for c in elevations]
    kept = [F.when((e <= mean + 2 * sd) & (e >= mean - 2 * sd), e) for e in values]
    return F.coalesce(F.greatest(*kept) - F.least(*kept), F.lit(float(NO_RANGE)))


def bits_clear(flags: Column | str, bits: Sequence[int] = (3, 5)) -> Column:
    """Whether all listed bits of a quality flag are 0."""
    ok = F.lit(True)
    for b in bits:
        ok = ok & (F.getbit(as_col(flags), F.lit(b)) == 0)
    return ok
