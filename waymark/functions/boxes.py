"""Boxes: percent boxes to a 0-1000 grid, zones, relations and their phrases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.text import collapse_whitespace, int_list_repr

#: Centre distance of a relation, and the cuts of the 3 x 3 screen zones.
NEAR, LOW, HIGH = 80, 333, 667


def _grid(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1000.0), F.rint(value))).cast("int")


def normalize_bbox(box: Column) -> Column:
    """[xmin, ymin, xmax, ymax] in 0-1000 of a percent box (x, y, width, height); halves
    round to even."""
    x, y, w, h = (box[c] for c in ("x", "y", "width", "height"))
    return F.array(_grid(x * 10), _grid(y * 10), _grid((x + w) * 10), _grid((y + h) * 10))


def pixel_bbox(box: Column, width: Column, height: Column) -> Column:
    """[xmin, ymin, xmax, ymax] in 0-1000 of a pixel box in an image of that size."""
    return F.array(
        *[_grid(box[i] * 1000.0 / (width if i % 2 == 0 else height)) for i in range(4)]
    )


def bbox_center(box: Column) -> Column:
    """struct(cx, cy) of a grid box."""
    return F.struct(
        ((box[0] + box[2]) / 2).alias("cx"), ((box[1] + box[3]) / 2).alias("cy")
    )


def bbox_relation(reference: Column, other: Column) -> Column:
    """Where ``other`` lies as seen from ``reference``; within the threshold it is near."""
    dx = bbox_center(other)["cx"] - bbox_center(reference)["cx"]
    dy = bbox_center(other)["cy"] - bbox_center(reference)["cy"]
    across = F.when(dx > NEAR, "right").when(dx < -NEAR, "left")
    down = F.when(dy > NEAR, "below").when(dy < -NEAR, "above")
    place = F.concat_ws("-", down, across)
    return F.when(place == "", "near").otherwise(F.concat(place, F.lit(" of")))


def bbox_zone(box: Column) -> Column:
    """The part of the view that holds the box's centre."""
    x, y = bbox_center(box)["cx"], bbox_center(box)["cy"]
    across = F.when(x < LOW, "left").when(x > HIGH, "right").otherwise("center")
    down = F.when(y < LOW, "upper").when(y > HIGH, "lower").otherwise("middle")
    return (
        F.when((across == "center") & (down == "middle"), "center of the view")
        .when(across == "center", F.concat(down, F.lit(" center of the view")))
        .when(down == "middle", F.concat(across, F.lit(" side of the view")))
        .otherwise(F.concat(down, F.lit("-"), across, F.lit(" area of the view")))
    )


def object_name(item: Column) -> Column:
    """A label in one line; ``object`` if it is missing or blank."""
    return F.coalesce(F.nullif(collapse_whitespace(item["label"]), F.lit("")), F.lit("object"))


def format_annotated_objects(objects: Column) -> Column:
    """One phrase per object; all but the first also tell their relation to the first."""
    first = F.get(objects, F.lit(0))
    base = normalize_bbox(first["bbox"])

    def phrase(item: Column, i: Column) -> Column:
        box = normalize_bbox(item["bbox"])
        own = F.concat(
            F.lit("'"), object_name(item), F.lit("' at "), int_list_repr(box),
            F.lit(" ("), bbox_zone(box), F.lit(")"),
        )
        relation = F.concat(
            F.lit(", "), bbox_relation(base, box), F.lit(" '"), object_name(first), F.lit("'")
        )
        return F.when(i == 0, own).otherwise(F.concat(own, relation))

    text = F.array_join(F.transform(objects, phrase), "; ")
    return F.when(F.coalesce(F.size(objects), F.lit(0)) > 0, text).otherwise(F.lit("[]"))


def format_object_names(objects: Column) -> Column:
    """``no annotated objects``, ``'a'``, or ``'a', 'b' and 'c'``."""
    names = F.transform(objects, lambda o: F.concat(F.lit("'"), object_name(o), F.lit("'")))
    n = F.coalesce(F.size(objects), F.lit(0))
    return (
        F.when(n <= 0, F.lit("no annotated objects"))
        .when(n == 1, F.get(names, F.lit(0)))
        .otherwise(
            F.concat(
                F.array_join(F.slice(names, F.lit(1), F.greatest(n - 1, F.lit(0))), ", "),
                F.lit(" and "),
                F.get(names, n - 1),
            )
        )
    )
