"""Points, vectors and affines as arrays of doubles. An affine has 16 numbers, row by row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _at(p: Column, i: int) -> Column:
    return F.get(p, F.lit(i))


def minus(p: Column, q: Column) -> Column:
    return F.zip_with(p, q, lambda x, y: x - y)


def dot(p: Column, q: Column) -> Column:
    return F.aggregate(F.zip_with(p, q, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def length(p: Column) -> Column:
    return F.sqrt(dot(p, p))


def distance(p: Column, q: Column) -> Column:
    """NULL if a point is."""
    return length(minus(p, q))


def midpoint(p: Column, q: Column) -> Column:
    return F.zip_with(p, q, lambda x, y: (x + y) / 2)


def rejection(v: Column, normal: Column) -> Column:
    """The part of v in the plane with this normal; v itself if the normal has no length."""
    n = dot(normal, normal)
    k = F.when(n > 0, dot(v, normal) / n).otherwise(0.0)
    return F.zip_with(v, normal, lambda x, y: x - k * y)


def angle(p: Column, q: Column) -> Column:
    """Degrees between two vectors; NULL if one has no length."""
    n = length(p) * length(q)
    return F.when(n > 0, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(p, q) / n)))))


def world(affine: Column, i: Column, j: Column, k: Column) -> Column:
    """The place of a voxel."""
    row = lambda r: _at(affine, 4 * r) * i + _at(affine, 4 * r + 1) * j + _at(affine, 4 * r + 2) * k + _at(affine, 4 * r + 3)
    return F.array(row(0), row(1), row(2))


def determinant(affine: Column) -> Column:
    a = [[_at(affine, 4 * r + c) for c in range(3)] for r in range(3)]
    minor = lambda x, y: a[1][x] * a[2][y] - a[1][y] * a[2][x]
    return a[0][0] * minor(1, 2) - a[0][1] * minor(0, 2) + a[0][2] * minor(0, 1)


def inverse(affine: Column) -> Column:
    """The affine that leads back; NULL numbers if there is none."""
    a = [[_at(affine, 4 * r + c) for c in range(3)] for r in range(3)]
    det = F.nullif(determinant(affine), F.lit(0.0))
    part = lambda r, c: a[(r + 1) % 3][(c + 1) % 3] * a[(r + 2) % 3][(c + 2) % 3] - a[(r + 1) % 3][(c + 2) % 3] * a[(r + 2) % 3][(c + 1) % 3]
    back = [[part(c, r) / det for c in range(3)] for r in range(3)]
    shift = [-(back[r][0] * _at(affine, 3) + back[r][1] * _at(affine, 7) + back[r][2] * _at(affine, 11)) for r in range(3)]
    return F.array(*[x for r in range(3) for x in (*back[r], shift[r])], *[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)])


def spacing(affine: Column) -> Column:
    return F.array(*[F.sqrt(sum((_at(affine, 4 * r + c) * _at(affine, 4 * r + c) for r in range(3)), F.lit(0.0))) for c in range(3)])


def valid_affine(affine: Column) -> Column:
    """Sixteen finite numbers, no axis without length, and volume."""
    finite = F.forall(affine, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    axes = F.forall(spacing(affine), lambda x: x > 1e-6)
    return F.coalesce((F.size(affine) == 16) & finite & axes & (F.abs(determinant(affine)) > 1e-6), F.lit(False))


def valid_shape(shape: Column, least: int = 10) -> Column:
    """Three axes of at least `least` voxels; scouts have fewer."""
    return F.coalesce((F.size(shape) >= 3) & (F.array_min(F.slice(shape, 1, 3)) >= least), F.lit(False))


def same_grid(a: Column, b: Column, shift: float, turn: float) -> Column:
    """Whether two affines have origins within `shift` and axes whose cosines reach `turn`."""
    origin = lambda x: F.array(_at(x, 3), _at(x, 7), _at(x, 11))
    axis = lambda x, c: F.array(*[_at(x, 4 * r + c) for r in range(3)])
    cosine = lambda c: F.abs(dot(axis(a, c), axis(b, c))) / (length(axis(a, c)) * length(axis(b, c)))
    near = distance(origin(a), origin(b)) <= shift
    return near & (cosine(0) >= turn) & (cosine(1) >= turn) & (cosine(2) >= turn)


def pelvic_angles(hips: Column, plate: Column, front: Column, back: Column, up: Column) -> dict[str, Column]:
    """Incidence, tilt and slope in degrees. hips: the midpoint of the femoral heads; plate: the middle of the sacral plate, front
    and back its edges; up: the vertical. Incidence is tilt plus slope for upright axes."""
    along = minus(front, back)
    to_hips = minus(hips, plate)
    normal = minus(up, F.transform(along, lambda x: x * (dot(up, along) / dot(along, along))))
    slope = 90 - angle(along, up)
    return {"incidence": angle(F.transform(normal, lambda x: -x), to_hips), "tilt": angle(F.transform(up, lambda x: -x), to_hips), "slope": F.abs(slope)}
