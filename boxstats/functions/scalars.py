"""Column expressions that the operators share."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Constants of the units in use.
LIGHT_SPEED = 2.99792458e5  # km/s
RHO_CRITICAL = 2.775366e11  # h^2 Msun/Mpc^3
HUBBLE_TIME = 9.784619421  # Gyr/h
DELTA_COLLAPSE = 1.686
TINY = 1e-15  # added to denominators
NOT_SO_TINY = 1e-8


def wrap(x: Column, box: float) -> Column:
    """Into [0, box)."""
    return F.pmod(x, F.lit(float(box)))


def min_image(d: Column, box: float) -> Column:
    """The shortest distance along one axis of a periodic box."""
    return F.least(F.abs(d), F.lit(float(box)) - F.abs(d))


def signed_min_image(d: Column, box: float) -> Column:
    """The shortest difference along one axis, with its sign: in [-box / 2, box / 2)."""
    return F.pmod(d + box / 2, F.lit(float(box))) - box / 2


def distance(box: float | None, *pairs: tuple[str, str]) -> Column:
    """Of points (a columns, b columns), periodic unless box is None. Squares are added in the
    order given."""
    sides = [min_image(F.col(a) - F.col(b), box) if box else F.col(a) - F.col(b) for a, b in pairs]
    squares = [d * d for d in sides]
    total = squares[0]
    for s in squares[1:]:
        total = total + s
    return F.sqrt(total)


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def heaviside(x: Column) -> Column:
    return (F.signum(x) + 1) / 2


def sinc(x: Column) -> Column:
    """sin(pi x) / (pi x), 1 at 0."""
    return F.when(x == 0, 1.0).otherwise(F.sin(math.pi * x) / (math.pi * F.when(x == 0, 1.0).otherwise(x)))


def expansion(z: Column, om: float, ol: float, w0: float = -1.0, wa: float = 0.0) -> Column:
    """E(z) = H(z) / H0, with dark energy of w(a) = w0 + wa (1 - a) by an effective exponent."""
    a = 1 / (1 + z)
    flat = F.abs(a - 1) < 1e-12
    weff = F.when(flat, w0).otherwise(w0 + wa - wa * (a - 1) / F.log(F.when(flat, 2.0).otherwise(a)))
    return F.sqrt(om * F.pow(1 + z, F.lit(3.0)) + (1 - om - ol) * F.pow(1 + z, F.lit(2.0)) + ol * F.pow(a, -3 * (1 + weff)))


def redshift(scale: Column) -> Column:
    return 1 / scale - 1


def legendre(ell: int, mu: Column) -> Column:
    m2 = mu * mu
    return {0: F.lit(1.0), 2: (3 * m2 - 1) / 2, 4: (35 * m2 * m2 - 30 * m2 + 3) / 8}[ell]


def stretch(x: Column, alpha: float = 0.99) -> Column:
    """A stretch of [-1, 1] that gives small values more room."""
    return F.tanh(x / alpha) / math.tanh(1 / alpha)


def unstretch(y: Column, alpha: float = 0.99) -> Column:
    return alpha * F.atanh(y * math.tanh(1 / alpha))


def perfect_power(n: int, p: int) -> bool:
    return round(n ** (1 / p)) ** p == n


def file_number(x: float) -> str:
    """A small number as part of a file's name: 0.0007 is 7p00em4."""
    mantissa, exponent = f"{x:.2e}".split("e")
    power = int(exponent)
    return f"{mantissa.replace('.', 'p')}e{'m' if power < 0 else ''}{abs(power)}"


def template(name: str, **values: object) -> str:
    """``<snap>`` and the like filled in."""
    return re.sub(r"<(\w+)>", lambda m: str(values.get(m[1], m[0])), name)
