"""Grid, area and projection maths as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metres per degree, the shared pixel, the lattice origin, the coarse cell.
NORTH_M, EAST_M = 111132.0, 111320.0
PIXEL = 8.983152841195216e-05
ORIGIN_LON, ORIGIN_LAT = -180.00001488697754, 78.0100585990529
COARSE = 0.001
MERCATOR_R = 6378137.0

#: Where the derived cells of the test tables lie.
TEST_LAT, TEST_LON = 28.1, -15.5


def pixel_area(lat: Column, px: float = PIXEL) -> Column:
    """Square metres of a pixel centred at a latitude."""
    return F.lit(px * NORTH_M * px * EAST_M) * F.cos(F.radians(lat))


def row_area(row: Column, north: float = TEST_LAT, px: float = PIXEL) -> Column:
    """Square metres of a pixel of a row; areas follow latitude, never a nominal pixel."""
    return pixel_area(F.lit(north) - px * (row + 0.5), px)


def km2(area: Column) -> Column:
    return F.round(area / 1e6, 6)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole where a whole of 0 is no error: 0 / 0 is NaN, anything else over 0 infinite, null stays null."""
    part, whole = part.cast("double"), whole.cast("double")
    return F.when(whole == 0, part * float("inf")).otherwise(part / F.nullif(whole, F.lit(0.0)))


def snapped(lo: Column, hi: Column, origin: float, px: float = PIXEL) -> tuple[Column, Column]:
    """First index and number of lattice steps of an interval, snapped outward."""
    first = F.floor((lo - origin) / px)
    return first, F.ceil((hi - origin) / px) - first


def same_grid(a: Column, b: Column, tolerance: float = 1e-9) -> Column:
    """Whether two coefficient arrays agree."""
    return (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) < tolerance), lambda ok: ok)


def row_of(lat: Column, north: float = TEST_LAT, px: float = PIXEL) -> Column:
    return F.floor((F.lit(north) - lat) / px).cast("int")


def col_of(lon: Column, west: float = TEST_LON, px: float = PIXEL) -> Column:
    return F.floor((lon - west) / px).cast("int")


def lat_of(row: Column, north: float = TEST_LAT, px: float = PIXEL) -> Column:
    return F.lit(north) - (row + 0.5) * px


def lon_of(col: Column, west: float = TEST_LON, px: float = PIXEL) -> Column:
    return F.lit(west) + (col + 0.5) * px


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * MERCATOR_R, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * MERCATOR_R


def tile_xy(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Web map tile numbers."""
    n = float(1 << zoom)
    y = (1 - F.asinh(F.tan(F.radians(lat))) / math.pi) / 2 * n
    return F.floor((lon + 180) / 360 * n).cast("int"), F.floor(y).cast("int")


def tile_north(y: Column, zoom: int) -> Column:
    """Latitude of a tile's upper edge."""
    return F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * y / float(1 << zoom)))))


def ground_resolution(lat: Column, zoom: int, tile: int = 256) -> Column:
    return F.cos(F.radians(lat)) * (2 * math.pi * MERCATOR_R / (tile << zoom))


def utm(lon: Column, lat: Column, central: float = -15.0) -> tuple[Column, Column]:
    """Transverse Mercator on WGS 84 (northern zones), by Krueger's series to the third order."""
    a, f = 6378137.0, 1 / 298.257223563
    n = f / (2 - f)
    big = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, dl = F.radians(lat), F.radians(lon - central)
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(dl)), F.atanh(F.sin(dl) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, c in enumerate(alpha, 1):
        x = x + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.lit(500000.0) + x * (0.9996 * big), y * (0.9996 * big)


def interpolated(table: list[float], start: float, step: float, x: Column) -> Column:
    """Linear interpolation in an evenly spaced table, held at the edges; null and NaN raise."""
    values = F.array(*[F.lit(float(v)) for v in table])
    at = F.least(F.greatest((x - start) / step, F.lit(0.0)), F.lit(len(table) - 1.0))
    low = F.least(F.floor(at), F.lit(len(table) - 2)).cast("int")
    line = F.get(values, low) + (at - low) * (F.get(values, low + 1) - F.get(values, low))
    return F.when(x.isNull() | F.isnan(x), F.raise_error(F.lit("latitude is not finite")).cast("double")).otherwise(line)


# The ellipsoid GRS 80 and the centre and false origin of the European equal-area projection.
LAEA_A, LAEA_F, LAEA_LON, LAEA_LAT, LAEA_X, LAEA_Y = 6378137.0, 1 / 298.257222101, 10.0, 52.0, 4321000.0, 3210000.0


def laea_constants() -> dict[str, float]:
    """e2, e, qp (the authalic function at the pole), b1 (the centre's authalic latitude), rq (the sphere's radius), d (the stretch between both axes)."""
    e2 = LAEA_F * (2 - LAEA_F)
    e, centre = math.sqrt(e2), math.radians(LAEA_LAT)
    q_of = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
    qp = q_of(1.0)
    b1, rq = math.asin(q_of(math.sin(centre)) / qp), LAEA_A * math.sqrt(qp / 2)
    return {"e2": e2, "e": e, "qp": qp, "b1": b1, "rq": rq, "d": LAEA_A * math.cos(centre) / (math.sqrt(1 - e2 * math.sin(centre) ** 2) * rq * math.cos(b1))}


def _authalic(s: Column, k: dict[str, float]) -> Column:
    return (1 - k["e2"]) * (s / (1 - k["e2"] * s * s) - F.log((1 - k["e"] * s) / (1 + k["e"] * s)) / (2 * k["e"]))


def laea(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Lambert azimuthal equal-area metres of Europe (GRS 80, centre 10 E 52 N, false origin 4,321,000, 3,210,000)."""
    k = laea_constants()
    b1, d = k["b1"], k["d"]
    beta, dl = F.asin(F.least(_authalic(F.sin(F.radians(lat)), k) / k["qp"], F.lit(1.0))), F.radians(lon - LAEA_LON)
    b = F.sqrt(2 / (1 + math.sin(b1) * F.sin(beta) + math.cos(b1) * F.cos(beta) * F.cos(dl))) * k["rq"]
    x = F.lit(LAEA_X) + b * d * F.cos(beta) * F.sin(dl)
    y = F.lit(LAEA_Y) + b / d * (math.cos(b1) * F.sin(beta) - math.sin(b1) * F.cos(beta) * F.cos(dl))
    return x, y


def laea_inverse(x: Column, y: Column, rounds: int = 4) -> tuple[Column, Column]:
    """Longitude and latitude of European equal-area metres; the latitude by Newton's rounds from the authalic one (four leave less than 1e-12 degrees)."""
    k = laea_constants()
    b1, d, rq, e2 = k["b1"], k["d"], k["rq"], k["e2"]
    u, v = (x - LAEA_X) / d, (y - LAEA_Y) * d
    rho = F.hypot(u, v)
    ce = 2 * F.asin(F.least(rho / (2 * rq), F.lit(1.0)))
    sin_beta = F.cos(ce) * math.sin(b1) + F.when(rho == 0, F.lit(0.0)).otherwise(v * F.sin(ce) * math.cos(b1) / F.nullif(rho, F.lit(0.0)))
    lon = F.lit(LAEA_LON) + F.degrees(F.atan2(u * F.sin(ce), rho * math.cos(b1) * F.cos(ce) - v * math.sin(b1) * F.sin(ce)))
    q = F.least(F.greatest(sin_beta, F.lit(-1.0)), F.lit(1.0)) * k["qp"]

    def closer(phi: Column) -> Column:
        s = F.sin(phi)
        w = 1 - e2 * s * s
        return phi + w * w * (q - _authalic(s, k)) / (2 * (1 - e2) * F.cos(phi))

    start = F.asin(F.least(F.greatest(sin_beta, F.lit(-1.0)), F.lit(1.0)))
    # Each round is computed once: it is the state of an aggregation over the rounds' numbers.
    phi = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda s, _: closer(s))
    return F.when(rho == 0, F.lit(LAEA_LON)).otherwise(lon), F.degrees(phi)


def mercator_cell(x: Column, y: Column, px: float = PIXEL, north: float = TEST_LAT, west: float = TEST_LON) -> tuple[Column, Column]:
    """Row and column of the grid under a point in web map metres."""
    lon, lat = F.degrees(x / MERCATOR_R), F.degrees(2 * F.atan(F.exp(y / MERCATOR_R)) - math.pi / 2)
    return row_of(lat, north, px), col_of(lon, west, px)


def grid_for(x0: Column, y0: Column, x1: Column, y1: Column, px: float = PIXEL) -> Column:
    """The grid of a box, snapped outward to the shared lattice: a, b, c, d, e, f, height, width."""
    col, width = snapped(x0, x1, ORIGIN_LON, px)
    row = F.floor((F.lit(ORIGIN_LAT) - y1) / px)
    height = F.ceil((F.lit(ORIGIN_LAT) - y0) / px) - row
    zero = F.lit(0.0)
    return F.struct(
        F.lit(px).alias("a"), zero.alias("b"), (ORIGIN_LON + col * px).alias("c"), zero.alias("d"), F.lit(-px).alias("e"), (ORIGIN_LAT - row * px).alias("f"),
        height.cast("int").alias("height"), width.cast("int").alias("width"))


def grid_box(grid: Column) -> list[Column]:
    """west, south, east, north of a grid."""
    return [grid["c"].alias("west"), (grid["f"] + grid["e"] * grid["height"]).alias("south"), (grid["c"] + grid["a"] * grid["width"]).alias("east"), grid["f"].alias("north")]


def chip_box(lon: Column, lat: Column, metres: float, north_m: float = NORTH_M) -> list[Column]:
    """The box of an image of so many metres round a point, latitude first. Maps on screen take 111,132 m a degree northward, review sheets 110,540."""
    dy, dx = F.lit(metres / 2 / north_m), metres / 2 / (EAST_M * F.cos(F.radians(lat)))
    return [(lat - dy).alias("south"), (lon - dx).alias("west"), (lat + dy).alias("north"), (lon + dx).alias("east")]


def projected_km2(pixels: Column, metres: float) -> Column:
    """Area of pixels of an equal-area grid: constant, without a correction for latitude."""
    return pixels * (metres * metres / 1e6)
