"""SQL snippets shared by oracles: segment rows, running lengths and
interpolated points computed with window functions."""

from __future__ import annotations


def seg_sql(vertices: str, id_col: str, where: str = "") -> str:
    """Segment rows (id, seg, x1, y1, x2, y2, len) from vertex rows (id, k, x, y)."""
    w = f" where {where}" if where else ""
    return (f"select a.{id_col} as id, a.k as seg, a.x as x1, a.y as y1, b.x as x2, b.y as y2, "
            f"sqrt(cast((b.x-a.x)*(b.x-a.x)+(b.y-a.y)*(b.y-a.y) as double)) as len "
            f"from (select * from {vertices}{w}) a join (select * from {vertices}{w}) b "
            f"on a.{id_col} = b.{id_col} and b.k = a.k + 1")


def cum_sql(segs: str) -> str:
    """Adds acc (length before the segment) and total (line length)."""
    return (f"select *, coalesce(sum(len) over (partition by id order by seg rows between unbounded preceding "
            f"and 1 preceding), 0) as acc, sum(len) over (partition by id) as total from {segs}")


def interp_sql(cums: str, frac: str = "0.5") -> str:
    """(id, x, y): point at ``frac`` of each line, unrounded."""
    return (f"select id, x1 + (x2 - x1) * (case when len = 0 then 0 else ({frac} * total - acc) / len end) as x, "
            f"y1 + (y2 - y1) * (case when len = 0 then 0 else ({frac} * total - acc) / len end) as y "
            f"from (select *, row_number() over (partition by id order by seg) as rn from {cums} "
            f"where acc + len >= {frac} * total) p where rn = 1")


def line_ctes(prefix: str, vertices: str, id_col: str, where: str = "") -> tuple:
    """CTEs ``{prefix}_seg``, ``{prefix}_cum``, ``{prefix}_mid`` for one line table."""
    return ((f"{prefix}_seg", seg_sql(vertices, id_col, where)),
            (f"{prefix}_cum", cum_sql(f"{prefix}_seg")),
            (f"{prefix}_mid", interp_sql(f"{prefix}_cum")))
