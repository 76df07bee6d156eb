"""Dutch national grid (RD) and WGS84, as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The grid's origin and the published coefficients (power of x, power of y, factor).
X0, Y0, PHI0, LAMBDA0 = 155000, 463000, 52.15517440, 5.38720621
TO_PHI = (
    (0, 1, 3235.65389), (2, 0, -32.58297), (0, 2, -0.24750), (2, 1, -0.84978), (0, 3, -0.06550), (2, 2, -0.01709),
    (1, 0, -0.00738), (4, 0, 0.00530), (2, 3, -0.00039), (4, 1, 0.00033), (1, 1, -0.00012),
)
TO_LAMBDA = (
    (1, 0, 5260.52916), (1, 1, 105.94684), (1, 2, 2.45656), (3, 0, -0.81885), (1, 3, 0.05594), (3, 1, -0.05607),
    (0, 1, 0.01199), (3, 2, -0.00256), (1, 4, 0.00128), (0, 2, 0.00022), (2, 0, -0.00022), (5, 0, 0.00026),
)
TO_X = ((0, 1, 190094.945), (1, 1, -11832.228), (2, 1, -114.221), (0, 3, -32.391), (1, 0, -0.705), (3, 1, -2.34), (1, 3, -0.608), (0, 2, -0.008), (2, 3, 0.148))
TO_Y = ((1, 0, 309056.544), (0, 2, 3638.893), (2, 0, 73.077), (1, 2, -157.984), (3, 0, 59.788), (0, 1, 0.433), (2, 2, -6.439), (1, 1, -0.032), (0, 4, 0.092), (1, 4, -0.054))


def polynomial(terms: tuple[tuple[int, int, float], ...], x: Column, y: Column) -> Column:
    """Sum of factor * x**p * y**q; powers are products, so that every engine gives the same digits."""

    def term(p: int, q: int, factor: float) -> Column:
        out = F.lit(factor)
        for _ in range(p):
            out = out * x
        for _ in range(q):
            out = out * y
        return out

    out = term(*terms[0])
    for t in terms[1:]:
        out = out + term(*t)
    return out


def rd_to_wgs(x: Column, y: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of grid coordinates."""
    dx, dy = (x.cast("double") - X0) * 1e-5, (y.cast("double") - Y0) * 1e-5
    return polynomial(TO_PHI, dx, dy) / 3600 + PHI0, polynomial(TO_LAMBDA, dx, dy) / 3600 + LAMBDA0


def wgs_to_rd(latitude: Column, longitude: Column) -> tuple[Column, Column]:
    a, b = (latitude.cast("double") - PHI0) * 0.36, (longitude.cast("double") - LAMBDA0) * 0.36
    return polynomial(TO_X, a, b) + X0, polynomial(TO_Y, a, b) + Y0


def valid(x: Column, y: Column) -> Column:
    """Whether grid coordinates are there; a place at or below 1 stands for none."""
    return x.isNotNull() & y.isNotNull() & ~F.isnan(x.cast("double")) & ~F.isnan(y.cast("double")) & (x > 1)


def location(x: Column, y: Column) -> Column:
    """struct<lon, lat> of valid grid coordinates, else null."""
    latitude, longitude = rd_to_wgs(x, y)
    return F.when(valid(x, y), F.struct(longitude.alias("lon"), latitude.alias("lat")))


def point(first: Column, second: Column) -> Column:
    """A point as struct<type, coordinates>."""
    return F.struct(F.lit("Point").alias("type"), F.array(first.cast("double"), second.cast("double")).alias("coordinates"))
