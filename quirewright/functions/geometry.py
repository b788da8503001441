"""Boxes, polygons and page frames as Column expressions; a box is an array [x0, y0, x1, y1]."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How far a box may stick out of its page, in points.
TOLERANCE = 0.01


def coerced(box: Column, exact: bool = False) -> Column:
    """The first four numbers of a box; null unless there are four (exactly four, if ``exact``), none null."""
    four = F.transform(F.slice(box, 1, 4), lambda x: x.cast("double"))
    right = (F.size(box) == 4) if exact else (F.size(box) >= 4)
    return F.when(right & ~F.exists(four, lambda x: x.isNull()), four)


def from_polygon(polygon: Column) -> Column:
    xs, ys = F.transform(polygon, lambda p: p[0]), F.transform(polygon, lambda p: p[1])
    return F.when(F.size(polygon) > 0, F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))


def first_box(*boxes: Column) -> Column:
    return F.coalesce(*[coerced(b) for b in boxes])


def area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b[2] - b[0]) * F.greatest(F.lit(0.0), b[3] - b[1])


def overlap(a: Column, b: Column) -> Column:
    width = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    height = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0.0), width) * F.greatest(F.lit(0.0), height)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; null for boxes without area."""
    both = overlap(a, b)
    return F.when((area(a) > 0) & (area(b) > 0), both / (area(a) + area(b) - both))


def word_in_region(word: Column, region: Column) -> Column:
    """Share of the word covered, plus 2 if its centre lies in the region; null if neither that nor half is covered."""
    cx, cy = (word[0] + word[2]) / 2, (word[1] + word[3]) / 2
    inside = cx.between(region[0], region[2]) & cy.between(region[1], region[3])
    covered = F.when(area(word) > 0, overlap(word, region) / area(word)).otherwise(0.0)
    return F.when(inside | (covered >= 0.5), covered + F.when(inside, 2.0).otherwise(0.0))


def to_points(x: Column, y: Column, raster: Column, rotation: Column | None = None, matrix: Column | None = None) -> Column:
    """A raster point in the points of the page as it lies unrotated; null without positive sizes.

    The point is scaled to the page as it was rendered, then turned back: by a six-element affine ``matrix`` where there
    is one, else by ``rotation`` (0, 90, 180 or 270 degrees, none for null) about the page's box.
    """
    box = raster["pdf_bbox"]
    good = (raster["raster_width"] > 0) & (raster["raster_height"] > 0) & (F.size(box) == 4)
    width, height = box[2] - box[0], box[3] - box[1]
    turn = F.coalesce(F.pmod(rotation, F.lit(360)), F.lit(0)) if rotation is not None else F.lit(0)
    lying = turn.isin(90, 270)
    px = x * F.when(lying, height).otherwise(width) / raster["raster_width"]
    py = y * F.when(lying, width).otherwise(height) / raster["raster_height"]
    own = F.when(turn == 90, F.array(py, height - px)).when(turn == 180, F.array(width - px, height - py)).when(turn == 270, F.array(width - py, px)).otherwise(F.array(px, py))
    placed = F.array(box[0] + own[0], box[1] + own[1])
    if matrix is not None:
        placed = F.when(F.size(matrix) == 6, derotated(F.array(box[0] + px, box[1] + py), matrix)).otherwise(placed)
    return F.when(good, placed)


def derotated(point: Column, matrix: Column) -> Column:
    """A point through a six-element affine matrix; unchanged without one of six elements."""
    moved = F.array(point[0] * matrix[0] + point[1] * matrix[2] + matrix[4], point[0] * matrix[1] + point[1] * matrix[3] + matrix[5])
    return F.when(F.size(matrix) == 6, moved).otherwise(point)


def box_to_points(box: Column, raster: Column, rotation: Column | None = None, matrix: Column | None = None) -> Column:
    """The envelope of a raster box's four corners in page points."""
    b = coerced(box)
    corners = [to_points(b[i], b[j], raster, rotation, matrix) for i, j in ((0, 1), (2, 1), (2, 3), (0, 3))]
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    return F.when(b.isNotNull() & corners[0].isNotNull(), F.array(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)))


def polygon_to_points(polygon: Column, raster: Column, rotation: Column | None = None, matrix: Column | None = None) -> Column:
    """Each point moved; null if any can't be."""
    moved = F.transform(polygon, lambda p: to_points(p[0], p[1], raster, rotation, matrix))
    return F.when(~F.exists(moved, lambda p: p.isNull() | F.exists(p, lambda v: v.isNull())), moved)


def items_to_points(items: Column, raster: Column, rotation: Column | None = None, frame: str = "page") -> Column:
    """Items (structs with text and bbox) moved to page points: text, bbox, source_bbox, coordinate_space, coordinate_frame."""
    return F.transform(
        items,
        lambda i: F.struct(i["text"].alias("text"), box_to_points(i["bbox"], raster, rotation).alias("bbox"), i["bbox"].alias("source_bbox"), F.lit("pdf_points").alias("coordinate_space"), F.lit(frame).alias("coordinate_frame")),
    )


def envelope(boxes: Column) -> Column:
    """The smallest box around an array of boxes, those that aren't boxes left out; null without any."""
    good = F.filter(boxes, lambda b: coerced(b, exact=True).isNotNull())
    side = lambda i: F.transform(good, lambda b: b[i])
    return F.when(F.size(good) > 0, F.array(F.array_min(side(0)), F.array_min(side(1)), F.array_max(side(2)), F.array_max(side(3))))


def inside_page(box: Column, page: Column) -> Column:
    """Whether a box is finite, ordered and within the page."""
    finite = ~F.exists(box, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    checks = [F.size(box) == 4, finite, box[0] <= box[2], box[1] <= box[3], box[0] >= page[0] - TOLERANCE, box[1] >= page[1] - TOLERANCE, box[2] <= page[2] + TOLERANCE, box[3] <= page[3] + TOLERANCE]
    return F.coalesce(reduce(lambda a, b: a & b, checks), F.lit(False))


def geometry_status(left: Column, right: Column) -> Column:
    """Whether two boxes' frames can be compared; each side is a struct of coordinate_space, frame, page_bbox and bbox."""
    same = F.size(left["page_bbox"]) == F.size(right["page_bbox"])
    same &= ~F.exists(F.zip_with(left["page_bbox"], right["page_bbox"], lambda a, b: F.abs(a - b)), lambda d: d.isNull() | (d > TOLERANCE))
    return (
        F.when(left.isNull() | right.isNull(), "missing_geometry_metadata")
        .when(~(left["coordinate_space"].eqNullSafe("pdf_points") & right["coordinate_space"].eqNullSafe("pdf_points")), "non_normalized_coordinate_space")
        .when(left["frame"].isNull() | right["frame"].isNull(), "missing_coordinate_frame")
        .when(left["frame"] != right["frame"], "different_coordinate_frames")
        .when(~F.coalesce(same, F.lit(False)), "different_or_missing_page_bbox")
        .when(coerced(left["bbox"]).isNull() | coerced(right["bbox"]).isNull(), "missing_block_bbox")
        .otherwise("compatible_normalized_pdf_points")
    )
