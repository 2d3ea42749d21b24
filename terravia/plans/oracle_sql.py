"""SQL text of the planar formulas, for the oracle side of spatial queries."""

from __future__ import annotations


def point_point(ax, ay, bx, by):
    return f"(({ax}-{bx})*({ax}-{bx}) + ({ay}-{by})*({ay}-{by}))"


def point_segment(px, py, x1="x1", y1="y1", x2="x2", y2="y2"):
    length2 = f"(({x2}-{x1})*({x2}-{x1}) + ({y2}-{y1})*({y2}-{y1}))"
    t = (
        f"(case when {length2} = 0 then 0 else greatest(0, least(1, "
        f"(({px}-{x1})*({x2}-{x1}) + ({py}-{y1})*({y2}-{y1})) / {length2})) end)"
    )
    ex, ey = f"({px}-({x1}+{t}*({x2}-{x1})))", f"({py}-({y1}+{t}*({y2}-{y1})))"
    return f"({ex}*{ex} + {ey}*{ey})"


def point_box(px, py, xmin="xmin", ymin="ymin", xmax="xmax", ymax="ymax"):
    dx, dy = f"greatest({xmin}-{px}, 0, {px}-{xmax})", f"greatest({ymin}-{py}, 0, {py}-{ymax})"
    return f"({dx}*{dx} + {dy}*{dy})"


def box_near_segment(radius, xmin="xmin", ymin="ymin", xmax="xmax", ymax="ymax"):
    return (
        f"({xmin} <= greatest(x1,x2)+{radius} and {xmax} >= least(x1,x2)-{radius} "
        f"and {ymin} <= greatest(y1,y2)+{radius} and {ymax} >= least(y1,y2)-{radius})"
    )


CORNERS = (("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"))


def box_meets_segment():
    sides = ", ".join(f"((x2-x1)*({cy}-y1) - (y2-y1)*({cx}-x1))" for cx, cy in CORNERS)
    return f"({box_near_segment(0)} and least({sides}) <= 0 and greatest({sides}) >= 0)"


def box_segment():
    terms = [point_box("x1", "y1"), point_box("x2", "y2")]
    terms += [point_segment(cx, cy) for cx, cy in CORNERS]
    return f"(case when {box_meets_segment()} then 0 else least({', '.join(terms)}) end)"
