"""Per-pixel index, calibration and score expressions. All are plain Column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published eight-band model (intercept, eight band weights, L-RVI, C-RVI).
BAND_MODEL_INTERCEPT = 24.199260536
BAND_MODEL_WEIGHTS = [-27.817542580, 11.724057104, 0.002757478, -17.933519020, -18.064926884,
                      -0.012282095, 30.887101573, -0.037257098, -9.236119539, -47.321276739]

# Prior means of the example run, in the order vcf, c_rvi, ndvi, l_rvi_mosaic.
PRIOR_MEAN = [0.06491638, -26.63132179, 0.05590800, -29.64091620]
DEFAULT_SCORE_INTERCEPT = 6.07

STACK_BANDS = ["c_vv", "c_vh", "c_inc", "l_hh", "l_hv", "l_inc", "ndvi", "tc"]


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rvi(co: Column | str, cross: Column | str) -> Column:
    """Radar vegetation index 4x/(co+x); NULL where the denominator is 0."""
    co, cross = as_col(co), as_col(cross)
    return F.try_divide(F.lit(4.0) * cross, co + cross)


def ndvi(nir: Column | str, red: Column | str) -> Column:
    """Normalised difference of two reflectances; NULL for negative input or zero sum."""
    nir, red = as_col(nir), as_col(red)
    return F.when((nir >= 0) & (red >= 0), F.try_divide(nir - red, nir + red))


def condense(value: Column | str, scale: int = 100, nodata: int = -9999) -> Column:
    """Value times ``scale``, rounded half to even, as SMALLINT; NULL becomes ``nodata``."""
    return F.coalesce(F.rint(as_col(value) * scale).cast("smallint"), F.lit(nodata).cast("smallint"))


def dn_to_gamma0(dn: Column | str) -> Column:
    """Digital number of an L-band mosaic to linear backscatter (calibration -83 dB)."""
    dn = as_col(dn).cast("double")
    return dn * dn * F.lit(10 ** (-83 / 10))


def incidence_degrees(angle: Column | str) -> Column:
    return F.degrees(as_col(angle))


def linear_score(intercept: float, weights: Sequence[float], terms: Sequence[Column | str]) -> Column:
    z = F.lit(float(intercept))
    for w, t in zip(weights, terms, strict=True):
        z = z + F.lit(float(w)) * as_col(t)
    return z


def logistic(z: Column) -> Column:
    """1/(1+exp(-z)), which stays finite where exp(z)/(1+exp(z)) overflows."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def logit_score(intercept: float, weights: Sequence[float], terms: Sequence[Column | str]) -> Column:
    """Probability of presence from a linear predictor."""
    return logistic(linear_score(intercept, weights, terms))


def stack_terms(bands: Sequence[str] = STACK_BANDS) -> list[Column]:
    """The eight bands followed by the L-band and C-band vegetation indices."""
    c_vv, c_vh, _, l_hh, l_hv = bands[:5]
    return [F.col(b) for b in bands] + [rvi(l_hh, l_hv), rvi(c_vv, c_vh)]


def band_model_score(bands: Sequence[str] = STACK_BANDS) -> Column:
    return logit_score(BAND_MODEL_INTERCEPT, BAND_MODEL_WEIGHTS, stack_terms(bands))


def logit_score_byte(bands: Sequence[str] = STACK_BANDS, intercept: float = BAND_MODEL_INTERCEPT,
                     weights: Sequence[float] = BAND_MODEL_WEIGHTS) -> Column:
    """Probability in whole percent, truncated; 255 marks no data.

    No data means a band that is 0 or missing, or a probability that is exactly 0 or undefined
    before truncation. The overflow of the exponential counts as undefined here.
    """
    z = linear_score(intercept, weights, stack_terms(bands))
    pct = F.try_divide(F.exp(z), F.lit(1.0) + F.exp(z)) * 100
    has_all = F.lit(True)
    for b in bands:
        has_all = has_all & F.coalesce(F.col(b) != 0, F.lit(False))
    usable = has_all & pct.isNotNull() & ~F.isnan(pct) & (pct != 0)
    return F.when(usable, pct.cast("smallint")).otherwise(F.lit(255).cast("smallint"))


def threshold_class(p: Column | str, threshold: float = 0.5) -> Column:
    return F.when(as_col(p) >= threshold, F.lit(1)).when(as_col(p) < threshold, F.lit(0))
