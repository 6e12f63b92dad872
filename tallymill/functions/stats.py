"""Test statistics on a handful of numbers (applied to already reduced rows)."""

import math
from statistics import NormalDist

import numpy as np


def _beta_fraction(a, b, x):
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def incomplete_beta(a, b, x):
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t, dof):
    """Two-sided p-value of Student's t."""
    if t is None or dof is None or math.isnan(t) or math.isnan(dof) or dof <= 0:
        return float("nan")
    return incomplete_beta(dof / 2.0, 0.5, dof / (dof + t * t))


# Polynomial coefficients published by Royston (1995), algorithm AS R94.
_W_LAST = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
_W_NEXT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
_MU_SMALL = (0.5440, -0.39978, 0.025054, -6.714e-4)
_SD_SMALL = (1.3822, -0.77857, 0.062767, -0.0020322)
_MU_LARGE = (-1.5861, -0.31082, -0.083751, 0.0038915)
_SD_LARGE = (-0.4803, -0.082676, 0.0030302)
_GAMMA = (-2.273, 0.459)
SHAPIRO_MAX = 5000


def _poly(coefficients, x):
    return sum(c * x ** i for i, c in enumerate(coefficients))


def shapiro_wilk(values):
    """Shapiro-Wilk W and p-value by Royston's approximation, made for at most ``SHAPIRO_MAX``
    values and extrapolated beyond. NaN below three values."""
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    if n < 3:
        return math.nan, math.nan
    centred = x - x.mean()
    spread = float(centred @ centred)
    if spread == 0.0:
        return 1.0, 1.0
    norm = NormalDist()
    m = np.array([norm.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    mm = float(m @ m)
    if n == 3:
        a = np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    else:
        u = 1.0 / math.sqrt(n)
        tail = 2 if n > 5 else 1
        ends = [m[-1 - k] / math.sqrt(mm) + _poly(c, u)
                for k, c in zip(range(tail), (_W_LAST, _W_NEXT))]
        rest = mm - 2.0 * sum(m[-1 - k] ** 2 for k in range(tail))
        phi = rest / (1.0 - 2.0 * sum(e * e for e in ends))
        a = m / math.sqrt(phi)
        for k, e in enumerate(ends):
            a[-1 - k], a[k] = e, -e
    w = min(float(a @ x) ** 2 / spread, 1.0)
    if n == 3:
        p = 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return w, max(p, 0.0)
    if w == 1.0:
        return w, 1.0
    y = math.log1p(-w)
    if n <= 11:
        gamma = _poly(_GAMMA, n)
        if y >= gamma:
            return w, 1e-99
        z = (-math.log(gamma - y) - _poly(_MU_SMALL, n)) / math.exp(_poly(_SD_SMALL, n))
    else:
        ln = math.log(n)
        z = (y - _poly(_MU_LARGE, ln)) / math.exp(_poly(_SD_LARGE, ln))
    return w, 1.0 - norm.cdf(z)
