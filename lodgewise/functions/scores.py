"""Score formulas of the model table, one function each."""

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Factor that brings each platform's rating to 0-10.
RATING_FACTOR = {"booking.com": 1.0, "tripadvisor.com": 2.0, "google_maps": 2.0}


def rating10(rating, platform, factors=RATING_FACTOR) -> Column:
    factor = F.lit(None).cast("double")
    for name, value in factors.items():
        factor = F.when(_col(platform) == name, F.lit(value)).otherwise(factor)
    return _col(rating).cast("double") * factor


def popularity(rating_10, reviews) -> Column:
    return _col(rating_10) * F.log1p(_col(reviews).cast("double"))


def log_price(price) -> Column:
    return F.when(_col(price) > 0, F.ln(_col(price).cast("double")))


def facilities_score(flags) -> Column:
    """100 x flags that are true / flags."""
    flags = list(flags)
    total = F.lit(0)
    for f in flags:
        total = total + F.coalesce(_col(f), F.lit(False)).cast("int")
    return total * F.lit(100.0) / F.lit(float(len(flags)))


def price_per_facility(price, facilities) -> Column:
    return F.when(_col(facilities) > 0, _col(price).cast("double") / _col(facilities))


def value_score(score, price) -> Column:
    return F.when(_col(price) > 0, _col(score) / (_col(price).cast("double") / F.lit(1e5)))


def accessibility_score(distance_km) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + _col(distance_km))


def experience_score(rating_10, sentiment) -> Column:
    return F.lit(0.7) * _col(rating_10) + F.lit(0.3) * (F.lit(5.0) + F.lit(5.0) * _col(sentiment))


def review_consistency(a_10, b_10) -> Column:
    return F.lit(1.0) - F.abs(_col(a_10) - _col(b_10)) / F.lit(10.0)


def freshness(collected, as_of, scale_days: float = 180.0) -> Column:
    age = F.greatest(F.datediff(_col(as_of), _col(collected)), F.lit(0))
    return F.exp(-age.cast("double") / F.lit(scale_days))


def market_segment(price, low, high) -> Column:
    price, low, high = _col(price), _col(low), _col(high)
    return F.when(price <= low, F.lit("budget")).when(price <= high, F.lit("mid-range")).when(price > high, F.lit("luxury"))


def platform_source(in_a, in_b, a="booking", b="tripadvisor", both="merged") -> Column:
    return F.when(in_a & in_b, F.lit(both)).when(in_a, F.lit(a)).when(in_b, F.lit(b))
