"""Uniform grid cells: the equi-join key that turns spatial predicates into
shuffle joins.

A geometry is *covered* by the cells its (expanded) bounding box touches.
Long segments are cut into pieces no longer than one cell before their cover
is taken, so a diagonal road costs O(length / cell) cells instead of
O((length / cell)^2).

Shapes of mixed sizes live on grids of several levels, each ``FACTOR`` times
as wide as the one below: a shape stands on the lowest level whose cells are
as wide as itself, so it covers four cells at most, however large it is (those
wider than a cell of the top level cover more there).
"""

from __future__ import annotations


def cell_of(v: str, size: float) -> str:
    return f"cast(floor(cast({v} AS double) / {float(size)}) AS bigint)"


def box_cover(xmin: str, ymin: str, xmax: str, ymax: str, size: float, margin: float | str = 0.0) -> str:
    """Array of ``struct(cx, cy)`` for every cell meeting the box expanded by margin (a number or SQL)."""
    m = f"({margin})" if isinstance(margin, str) else float(margin)
    return (f"flatten(transform(sequence({cell_of(f'({xmin}) - {m}', size)}, {cell_of(f'({xmax}) + {m}', size)}), "
            f"cx -> transform(sequence({cell_of(f'({ymin}) - {m}', size)}, {cell_of(f'({ymax}) + {m}', size)}), "
            f"cy -> named_struct('cx', cx, 'cy', cy))))")


def segment_cover(x1: str, y1: str, x2: str, y2: str, size: float, margin: float | str = 0.0) -> str:
    """Cells within ``margin`` of a segment, taken piecewise (pieces <= one cell).

    The cover is conservative: the margin is widened by a relative 1e-9 so
    interpolated piece ends never lose a cell to rounding.
    """
    m = f"({margin}) * (1 + 1e-9) + 1e-9" if isinstance(margin, str) else float(margin) * (1 + 1e-9) + 1e-9
    n = (f"greatest(1, cast(ceil(sqrt(cast((({x2})-({x1}))*(({x2})-({x1})) + (({y2})-({y1}))*(({y2})-({y1})) AS double)) "
         f"/ {float(size)}) AS int))")
    px0 = f"(({x1}) + (({x2})-({x1})) * i / n)"
    px1 = f"(({x1}) + (({x2})-({x1})) * (i + 1) / n)"
    py0 = f"(({y1}) + (({y2})-({y1})) * i / n)"
    py1 = f"(({y1}) + (({y2})-({y1})) * (i + 1) / n)"
    piece = box_cover(f"least({px0}, {px1})", f"least({py0}, {py1})",
                      f"greatest({px0}, {px1})", f"greatest({py0}, {py1})", size, m)
    return (f"element_at(transform(array({n}), "
            f"n -> array_distinct(flatten(transform(sequence(0, n - 1), i -> {piece})))), 1)")


#: How many times wider the cells of a level are than those of the level below.
FACTOR = 8


def level_sizes(size: float, levels: int) -> list[float]:
    return [float(size) * FACTOR ** i for i in range(levels)]


def level_of(extent: str, sizes: list[float]) -> str:
    """The lowest level whose cells are at least ``extent`` (SQL) wide, else the top one."""
    steps = " ".join(f"WHEN ({extent}) <= {s} THEN {i}" for i, s in enumerate(sizes[:-1]))
    return f"CASE {steps} ELSE {len(sizes) - 1} END" if steps else "0"
