"""Column builders for boxes (x1, y1, x2, y2): overlap measures, padding, scaling, crops and angles."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @classmethod
    def of(cls, row: Column | None = None, prefix: str = "") -> Box:
        """The box of the fields of a struct, or of the columns of a table."""
        get = (lambda n: row[n]) if row is not None else F.col
        return cls(*(get(prefix + n) for n in ("x1", "y1", "x2", "y2")))

    @property
    def width(self) -> Column:
        return F.greatest(F.lit(0), self.x2 - self.x1)

    @property
    def height(self) -> Column:
        return F.greatest(F.lit(0), self.y2 - self.y1)

    @property
    def area(self) -> Column:
        return self.width * self.height

    @property
    def cx(self) -> Column:
        return (self.x1 + self.x2) / 2

    @property
    def cy(self) -> Column:
        return (self.y1 + self.y2) / 2

    def named(self) -> list[Column]:
        return [c.alias(n) for c, n in zip(self, ("x1", "y1", "x2", "y2"), strict=True)]


def intersection(a: Box, b: Box) -> Column:
    w = F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)
    h = F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)
    return F.greatest(F.lit(0), w) * F.greatest(F.lit(0), h)


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 without an intersection."""
    i = intersection(a, b)
    return F.when(i > 0, i / (a.area + b.area - i)).otherwise(F.lit(0.0))


def over_smaller(a: Box, b: Box) -> Column:
    """Intersection over the smaller area (at least 1); 0 without an intersection."""
    i = intersection(a, b)
    area = lambda x: F.greatest(F.lit(1), (x.x2 - x.x1) * (x.y2 - x.y1))
    return F.when(i > 0, i / F.least(area(a), area(b))).otherwise(F.lit(0.0))


def x_overlap(a: Box, b: Box) -> Column:
    """The horizontal overlap as a share of the narrower box."""
    return F.greatest(F.lit(0), F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)) / F.greatest(F.lit(1), F.least(a.x2 - a.x1, b.x2 - b.x1))


def centre_inside(a: Box, b: Box) -> Column:
    """Whether the centre of ``a`` is in ``b``, its border included."""
    return (b.x1 <= a.cx) & (a.cx <= b.x2) & (b.y1 <= a.cy) & (a.cy <= b.y2)


def belongs(line: Box, box: Box, share: float) -> Column:
    return centre_inside(line, box) | (over_smaller(line, box) >= F.lit(share))


def expand(b: Box, width: Column, height: Column, ratio: float) -> Box:
    """Padded by a share of the page, four pixels at least, and cut at the page's border."""
    px = F.greatest(F.lit(4), (width * F.lit(ratio)).cast("int"))
    py = F.greatest(F.lit(4), (height * F.lit(ratio)).cast("int"))
    return Box(F.greatest(F.lit(0), b.x1 - px), F.greatest(F.lit(0), b.y1 - py), F.least(width, b.x2 + px), F.least(height, b.y2 + py))


def from_thousandths(b: Box, width: Column, height: Column) -> Column:
    """Struct (x1, y1, x2, y2) in pixels of a box given in thousandths of the page, null where it is too small."""
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1000.0), c.cast("double")))
    x1, x2, y1, y2 = clamp(b.x1), clamp(b.x2), clamp(b.y1), clamp(b.y2)
    pixel = lambda c, side: F.bround(c * side / 1000).cast("int")
    p = Box(pixel(F.least(x1, x2), width), pixel(F.least(y1, y2), height), pixel(F.greatest(x1, x2), width), pixel(F.greatest(y1, y2), height))
    w, h = p.x2 - p.x1, p.y2 - p.y1
    ok = (w >= 8) & (h >= 8) & (w * h / F.greatest(F.lit(1), width * height) >= F.lit(0.002))
    return F.when(ok, F.struct(*p.named()))


def from_model(b: Box, scale_x: Column, scale_y: Column, width: Column, height: Column, top: Column) -> Column:
    """Struct (x1, y1, x2, y2, share): a box in a model's picture of a tile as pixels of the page, on which the tile begins
    at row ``top``. It is cut at the tile's border and one pixel wide and high at least; share is its part of the tile."""
    at = lambda c, scale, most: F.greatest(F.lit(0), F.least(most, F.bround(c * scale).cast("int")))
    x1, y1 = at(b.x1, scale_x, width - 1), at(b.y1, scale_y, height - 1)
    x2, y2 = F.greatest(x1 + 1, at(b.x2, scale_x, width)), F.greatest(y1 + 1, at(b.y2, scale_y, height))
    share = (x2 - x1) * (y2 - y1) / F.greatest(F.lit(1), width * height)
    return F.struct(x1.alias("x1"), (y1 + top).alias("y1"), x2.alias("x2"), (y2 + top).alias("y2"), share.alias("share"))


def normalize_angle(c: Column) -> Column:
    """The same direction between -45 and 45 degrees; each border keeps its side."""
    half = F.when((c > -90) & (c <= 90), c).otherwise(-F.pmod(-(c + 90), F.lit(180.0)) + 90)
    return F.when(half < -45, half + 90).when(half > 45, half - 90).otherwise(half)


def fit_canvas(w: Column, h: Column, width: int = 1022, height: int = 182) -> Column:
    """Struct (new_width, new_height, x, y): how a line of this size is put on a canvas."""
    mx, my = max(8, int(width * 0.015)), max(6, int(height * 0.08))
    scale = F.least(F.lit(float(width - 2 * mx)) / F.greatest(F.lit(1), w), F.lit(float(height - 2 * my)) / F.greatest(F.lit(1), h))
    nw, nh = (F.greatest(F.lit(1), F.bround(x * scale).cast("int")) for x in (w, h))
    return F.struct(nw.alias("new_width"), nh.alias("new_height"), F.floor((F.lit(width) - nw) / 2).cast("int").alias("x"), F.floor((F.lit(height) - nh) / 2).cast("int").alias("y"))


def resize_long_side(w: Column, h: Column, most: int) -> Column:
    """Struct (new_width, new_height) with the longer side at ``most``."""
    scale = F.lit(float(most)) / F.greatest(w, h)
    return F.struct(*(F.greatest(F.lit(1), F.bround(x * scale).cast("int")).alias(n) for x, n in ((w, "new_width"), (h, "new_height"))))


def safe_crop(ink: Box, width: Column, height: Column, ratio_x: float = 0.03, ratio_y: float = 0.03) -> Column:
    """Struct (applied, x1, y1, x2, y2, retained): the crop around the ink, unless it would cut too much."""
    px, py = F.greatest(F.lit(24), (width * F.lit(ratio_x)).cast("int")), F.greatest(F.lit(20), (height * F.lit(ratio_y)).cast("int"))
    c = Box(F.greatest(F.lit(0), ink.x1 - px), F.greatest(F.lit(0), ink.y1 - py), F.least(width, ink.x2 + 1 + px), F.least(height, ink.y2 + 1 + py))
    w, h = c.x2 - c.x1, c.y2 - c.y1
    kept = w * h / F.greatest(F.lit(1), width * height)
    bad = (w < width * F.lit(0.30)) | (h < height * F.lit(0.20)) | (kept < F.lit(0.10))
    whole = Box(F.lit(0), F.lit(0), width, height)
    pick = Box(*(F.when(bad, x).otherwise(y) for x, y in zip(whole, c, strict=True)))
    return F.struct((~bad).alias("applied"), *pick.named(), F.when(~bad, kept).alias("retained"))


def line_crop(b: Box, width: Column, height: Column, pad_y: float = 0.30, pad_x: float = 0.018) -> Column:
    """Struct (x1, y1, x2, y2, kernel): the crop of a line, padded by shares of its height and width and cut at the tile's
    border, and the odd side of the square by which its mask grows."""
    w, h = F.greatest(F.lit(1), b.x2 - b.x1), F.greatest(F.lit(1), b.y2 - b.y1)
    py = F.greatest(F.lit(4), (h * F.lit(pad_y)).cast("int"))
    px = F.greatest(F.lit(8), F.greatest(h * F.lit(0.55), w * F.lit(pad_x)).cast("int"))
    side = F.greatest(F.lit(3), F.bround(h * F.lit(0.08)).cast("int"))
    crop = Box(F.greatest(F.lit(0), b.x1 - px), F.greatest(F.lit(0), b.y1 - py), F.least(width, b.x2 + px), F.least(height, b.y2 + py))
    return F.struct(*crop.named(), F.when(side % 2 == 0, side + 1).otherwise(side).alias("kernel"))


def trimmed(ink: Box, width: Column, height: Column) -> Column:
    """Struct (x1, y1, x2, y2): a line's picture cut to its ink, whose ends are exclusive, with a small border."""
    px = F.greatest(F.lit(4), ((ink.x2 - ink.x1) * F.lit(0.02)).cast("int"))
    py = F.greatest(F.lit(3), ((ink.y2 - ink.y1) * F.lit(0.12)).cast("int"))
    return F.struct(*Box(F.greatest(F.lit(0), ink.x1 - px), F.greatest(F.lit(0), ink.y1 - py), F.least(width, ink.x2 + px), F.least(height, ink.y2 + py)).named())
