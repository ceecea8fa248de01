"""Column-level helpers. Every function returns a ``Column`` built from
built-in Spark expressions, so it stays inside whole-stage codegen."""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# --- fixed values (must equal the reference's results) -----------------------
# Text used in place of NULL when a surrogate key is built, and the separator
# between the key parts.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
# Meteorological seasons by month number; any other month (and NULL) is Autumn.
SEASON_MONTHS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
SEASON_FALLBACK = "Autumn"
SEASON_ORDER = ["Winter", "Spring", "Summer", "Autumn"]
# Mean Earth radius used by the great-circle distance, in km.
EARTH_RADIUS_KM = 6371.0
# Dashboard band label for one AQI value: upper bounds (exclusive) and labels.
AQI_LABEL_UPPER = [(20, "GOOD"), (40, "FAIR"), (60, "MODERATE"), (80, "POOR"), (100, "VERY POOR")]
AQI_LABEL_TOP = "EXTREME"
AQI_LABEL_MISSING = "NO DATA"
# Temperature class upper bounds (exclusive) used by the season cards.
TEMP_CLASS_UPPER = [(6, "cold"), (12, "cool"), (18, "mild"), (24, "warm")]
TEMP_CLASS_TOP = "hot"
# Comfort score class lower bounds (inclusive) used by the city table bars.
SCORE_CLASS_LOWER = [(50, "high"), (25, "medium")]
SCORE_CLASS_BOTTOM = "low"
# -----------------------------------------------------------------------------


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 over the '-'-joined text of the columns, NULL replaced by a token.

    Integer, date and timestamp text is identical in Spark and in SQL engines
    that print ISO forms; doubles are not (``1.0E10``), so never key on them.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def season_from_date(date_col: ColumnOrName) -> Column:
    """Winter/Spring/Summer by month lists, everything else (NULL too) Autumn."""
    m = F.month(_col(date_col))
    expr = None
    for name, months in SEASON_MONTHS.items():
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(SEASON_FALLBACK))


def season_ordinal(season_col: ColumnOrName) -> Column:
    """1-based position in Winter, Spring, Summer, Autumn (0 if unknown)."""
    return F.array_position(F.array(*[F.lit(s) for s in SEASON_ORDER]), _col(season_col))


def sql_round(c: ColumnOrName, digits: int = 0) -> Column:
    """Round half away from zero on the double ``x * 10^d``, then scale back.

    This equals C ``round(x * 10^d) / 10^d``, which is how SQL engines round
    DOUBLE values. ``F.round(x, d)`` rounds the decimal expansion of ``x``
    itself and differs on values such as 0.285 (0.285 * 100 is
    28.499999999999996); it also builds a BigDecimal per row, which is slow.
    Here the scaled value is split into whole and fractional parts with
    ``% 1.0`` (exact for doubles), so the tie test sees the exact value and
    everything stays in double arithmetic. Magnitudes from 2^52 up are
    already whole (and infinities / NaN pass through). A zero result keeps
    the input's sign (-0.001 -> -0.0), as ``signum`` carries it.
    """
    scale = F.lit(float(10 ** digits))
    y = _col(c) * scale
    a = F.abs(y)
    frac = a % F.lit(1.0)
    r = F.signum(y) * (a - frac + F.when(frac >= F.lit(0.5), F.lit(1.0)).otherwise(F.lit(0.0)))
    return F.when(a < F.lit(float(2 ** 52)), r).otherwise(y) / scale


def ratio_pct(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """100 * num / den as DOUBLE, NULL when the denominator is 0."""
    return F.lit(100.0) * _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def clamp(c: ColumnOrName, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (greatest/least would skip it)."""
    x = _col(c)
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(out)


def haversine_km(lat1: ColumnOrName, lon1: ColumnOrName,
                 lat2: ColumnOrName, lon2: ColumnOrName,
                 radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km between two points in degrees."""
    la1, lo1, la2, lo2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    return F.lit(2 * radius_km) * F.asin(F.sqrt(a))


def unit_vector(lat: ColumnOrName, lon: ColumnOrName) -> tuple[Column, Column, Column]:
    """Point on the unit sphere; chord length is monotone in great-circle distance."""
    la, lo = F.radians(_col(lat)), F.radians(_col(lon))
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


@lru_cache(maxsize=1)
def _ascii_fold_tables() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition keeps ASCII parts.

    Built by rule from the Unicode database (NFKD, keep ASCII code points) over all planes, so
    folds match Python's ``normalize('NFKD', s).encode('ascii', 'ignore')`` character by
    character. Returns (from, to) for single-letter folds and the multi-letter folds.
    """
    src, dst, multi = [], [], {}
    for cp in range(0x80, 0x110000):
        ch = chr(cp)
        if not unicodedata.decomposition(ch):
            continue
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif folded:
            multi[ch] = folded
    return "".join(src), "".join(dst), multi


def ascii_fold(c: ColumnOrName) -> Column:
    """Accent-strip to ASCII where a compatibility decomposition exists.

    Characters without an ASCII decomposition are left in place; callers that
    want only ASCII remove the rest (see ``slug``).
    """
    src, dst, multi = _ascii_fold_tables()
    table = F.create_map(*[F.lit(x) for pair in multi.items() for x in pair])
    spelled = F.transform(F.split(F.translate(_col(c), src, dst), ""), lambda ch: F.when(
        ch > "\x7f", F.coalesce(F.element_at(table, ch), ch)).otherwise(ch))
    return F.array_join(spelled, "")


# Spark's translate reads U+0000 in the target as "delete", so the marker is a
# Unicode noncharacter instead (a text that already has one takes the slow path)
_MARK = "\ufdd0"


def slug(c: ColumnOrName) -> Column:
    """Lower-case ASCII letters and digits only, accents folded first.

    One ``translate`` pass folds single letters and maps every multi-letter fold character to a
    marker. Texts without the marker (nearly all) are done; only texts that have one (a
    multi-letter fold character, or a marker already in the text) look their non-ASCII characters
    up one by one. Both paths give the same result.
    """
    src, dst, multi = _ascii_fold_tables()
    x = _col(c)
    fast = F.translate(x, src + "".join(multi), dst + _MARK * len(multi))

    def finish(folded: Column) -> Column:
        return F.regexp_replace(F.lower(folded), r"[^a-z0-9]+", "")

    return F.when(F.instr(fast, _MARK) > F.lit(0), finish(ascii_fold(x))).otherwise(finish(fast))


def band_label(value: ColumnOrName) -> Column:
    """Piecewise AQI label for one value; NULL gives NO DATA."""
    v = _col(value)
    expr = F.when(v.isNull(), F.lit(AQI_LABEL_MISSING))
    for hi, label in AQI_LABEL_UPPER:
        expr = expr.when(v < F.lit(hi), F.lit(label))
    return expr.otherwise(F.lit(AQI_LABEL_TOP))


def temperature_class(value: ColumnOrName) -> Column:
    v = _col(value)
    expr = F.when(v.isNull(), F.lit("none"))
    for hi, label in TEMP_CLASS_UPPER:
        expr = expr.when(v < F.lit(hi), F.lit(label))
    return expr.otherwise(F.lit(TEMP_CLASS_TOP))


def score_class(value: ColumnOrName) -> Column:
    v = _col(value)
    expr = None
    for lo, label in SCORE_CLASS_LOWER:
        cond = v >= F.lit(lo)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(SCORE_CLASS_BOTTOM))


def path_safe_timestamp(c: ColumnOrName) -> Column:
    """ISO timestamp text with ':' replaced so it can name a folder."""
    return F.translate(_col(c).cast("string"), ":", "-")


def min_max_norm(c: ColumnOrName, lo: Column, hi: Column, invert: bool = False) -> Column:
    """Scale to 0..100 against (lo, hi); a constant column maps to 50."""
    x = _col(c).cast("double")
    z = F.when(hi > lo, (x - lo) / (hi - lo) * F.lit(100.0)).otherwise(
        F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(50.0)))
    return F.lit(100.0) - z if invert else z


def any_not_null(*cols: ColumnOrName) -> Column:
    return reduce(lambda a, b: a | b, [_col(c).isNotNull() for c in cols])
