"""Column functions of stellar and planetary physics, and of the sphere. Null or impossible inputs give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Habitable-zone flux limits: coefficients in (teff - 5780) K, lowest power first (fixed values).
HZ = {
    "RecentVenus": (1.776, 2.136e-4, 2.533e-8, -1.332e-11, -3.097e-15),
    "RunawayGreenhouse": (1.107, 1.332e-4, 1.580e-8, -8.308e-12, -1.931e-15),
    "MaximumGreenhouse": (0.356, 6.171e-5, 1.698e-9, -3.198e-12, -5.575e-16),
    "EarlyMars": (0.320, 5.547e-5, 1.526e-9, -2.874e-12, -5.011e-16),
}
SUN_TEFF = 5780.0
#: Constants in SI units (fixed values).
G, M_EARTH, R_EARTH = 6.67430e-11, 5.972e24, 6.371e6
#: Parallax zero point in milliarcseconds (fixed value).
ZERO_POINT = 0.017


def _c(x: Column | str | float) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def linear_luminosity(lum) -> Column:
    """Values up to zero are logarithms to base ten."""
    lum = _c(lum)
    return F.when(lum > 0, lum).when(lum <= 0, F.pow(F.lit(10.0), lum))


def hz_flux(teff, limit: str) -> Column:
    """Flux at a limit by Horner's rule; an unknown limit is a KeyError."""
    s0, a, b, c, d = HZ[limit]
    t = _c(teff) - SUN_TEFF
    return s0 + t * (a + t * (b + t * (c + t * d)))


def hz_distance(teff, lum, limit: str) -> Column:
    """Distance in AU at which ``lum`` (linear or logarithm) gives a limit's flux."""
    flux, linear = hz_flux(teff, limit), linear_luminosity(lum)
    return F.when((flux > 0) & (linear > 0) & (linear < float("inf")), F.sqrt(linear / flux))


def stellar_flux(lum, sma) -> Column:
    return F.try_divide(linear_luminosity(lum), _c(sma) * _c(sma))


def equilibrium_temperature(teff, rad, sma, albedo=0.3, redistribution=1.0) -> Column:
    ratio = F.try_divide(_c(rad), 2.0 * _c(sma))
    t = F.when(ratio >= 0, _c(teff) * F.sqrt(ratio) * F.pow(1.0 - _c(albedo), F.lit(0.25)) * F.pow(_c(redistribution), F.lit(0.25)))
    return F.when(t.between(0, 2.0e4), t)


def surface_gravity(mass, radius) -> Column:
    metres = _c(radius) * R_EARTH
    g = F.try_divide(G * _c(mass) * M_EARTH, metres * metres)
    return F.when(g.between(0, 2.0e3), g)


def escape_velocity(mass, radius) -> Column:
    square = F.try_divide(2 * G * _c(mass) * M_EARTH, _c(radius) * R_EARTH)
    v = F.when(square >= 0, F.sqrt(square) / 1000.0)
    return F.when(v <= 100.0, v)


def hz_position(sma, inner, outer) -> Column:
    return F.try_divide(_c(sma) - _c(inner), _c(outer) - _c(inner))


def separation(ra1, dec1, ra2, dec2) -> Column:
    """Haversine separation in radians of positions in degrees."""
    a1, d1, a2, d2 = (F.radians(_c(x)) for x in (ra1, dec1, ra2, dec2))
    sin_d, sin_a = F.sin((d2 - d1) / 2), F.sin((a2 - a1) / 2)
    h = sin_d * sin_d + F.cos(d1) * F.cos(d2) * sin_a * sin_a
    return 2 * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def moved(ra, dec, pm_ra, pm_dec, years: float) -> tuple[Column, Column]:
    """Position after ``years`` of proper motion in mas a year."""
    step = years / 3.6e6
    return _c(ra) + F.try_divide(_c(pm_ra) * step, F.cos(F.radians(_c(dec)))), _c(dec) + _c(pm_dec) * step
