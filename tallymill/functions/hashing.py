"""Portable, seeded row hashing.

MD5 is the one hash that every SQL engine computes alike, so splits and samples
made here can be reproduced outside Spark.  Fixed-width lower-case hex orders
like the number it spells, which lets membership tests compare strings and skip
base conversion.
"""

from pyspark.sql import functions as F

_LANE = 8                  # hex digits per lane: 32 bits
PRIME = 2 ** 31 - 1


def digest(key, *salt):
    """MD5 of ``key|salt...`` as 32 hex digits."""
    parts = [F.lit(s) if isinstance(s, (str, int)) else s for s in salt]
    return F.md5(F.concat_ws("|", F.col(key).cast("string"),
                             *[p.cast("string") for p in parts]))


def lane(hexdigest, i):
    return F.substring(hexdigest, i * _LANE + 1, _LANE)


def threshold(fraction):
    """Hex bound below which a uniform lane falls with probability ``fraction``."""
    if not 0.0 <= fraction < 1.0:
        raise ValueError("fraction must be in [0, 1)")
    return format(round(fraction * 16 ** _LANE), f"0{_LANE}x")


def in_fraction(key, fraction, salt):
    """True for a reproducible ``fraction`` of keys."""
    return lane(digest(key, salt), 0) < threshold(fraction)


def lane_int(hexdigest, i, modulo):
    """Lane ``i`` as an integer in ``[0, modulo)``."""
    return F.conv(lane(hexdigest, i), 16, 10).cast("bigint") % modulo


def coefficients(hexdigest):
    """The digest as four integers below ``PRIME``."""
    return F.array(*[lane_int(hexdigest, i, PRIME) for i in range(4)])


def polynomial(c, point):
    """Cubic polynomial over the prime field at an integer point.

    With random coefficients its values at different points are 4-wise
    independent and uniform in ``[0, PRIME)``: one digest serves many draws for
    the cost of a few multiplications each. Every step is reduced, so any point
    below ``PRIME`` stays within 64 bits.
    """
    r = point.cast("bigint")
    value = c[3]
    for i in (2, 1, 0):
        value = (value * r + c[i]) % PRIME
    return value
