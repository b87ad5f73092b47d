"""Distance from incidents to sites: the assigned site, and the nearest site.

``assigned_site`` is an inner equi-join on the site number; Spark picks the
strategy by size, and AQE splits skewed partitions.

``nearest_site`` finds, for every point, the closest site strictly within
``max_km``; ties go to the smallest site key. One lazy plan serves any number
of sites and points:

- points are reduced to distinct coordinates, and sites to one row per distinct
  location (the smallest key wins there); both aggregates collapse hot places
  map-side;
- locations are bucketed into cubes of the unit-sphere embedding, on a fixed
  ladder of edges, each an eighth of the one above; a cube carries the cell of
  one of its locations, its representative;
- the cubes of the top level, a number bounded by geometry, are compared with
  each other: for each of them, the cubes that may hold the nearest location of
  any place in it. A place joins those of its own cube;
- then it descends: at each level it joins the children of a cube, one array,
  and keeps those whose near side is no farther than the nearest representative:
  of this cube's children before anything is shuffled by place, of all the place's
  cubes after it. In the last level's cubes it meets the locations themselves, those
  no farther than that. A place that is down to one cube carries one row;
- the answer joins back to the points on the coordinates, null-safe.

A far point thus keeps only the cubes on the near rim of a cluster, and a dense
cluster is cut down to the last level's cubes. Nothing is written or counted
while the plan is built.

Where Spark estimates the locations at no more than ``FOLD_BYTES`` (from file
sizes; no job runs), each point instead folds over the array of all locations:
the same answers from a plan without a shuffle. A streaming table allows no
chain of aggregates and is always searched that way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.geo import EARTH_RADIUS_KM, haversine_km, haversine_term, km_of_haversine
from blotter.functions.typed import ref

# Edges of the cubes, in radii: 1593 km down to 49 m. Powers of two keep the
# bucketing exact, so a cube's parent holds it.
_EDGES = tuple(2.0 ** -(2 + 3 * k) for k in range(6))
# Edge of the cells that number places (12 m), and the bits of a number for each
# axis, whose middle is the centre of the sphere.
_CELL, _BITS, _HALF = 2.0**-19, 21, 2**20
# Estimated size of the locations up to which they are one array in the plan.
FOLD_BYTES = 32_768
# Slack of the pruning test (squared chords), far above rounding error.
_SLACK, _LEAST = 1e-9, 1e-18


def assigned_site(
    points: DataFrame,
    sites: DataFrame,
    point_key: str,
    site_key: str,
    point_lat: str,
    point_lon: str,
    site_lat: str,
    site_lon: str,
    distance_col: str = "distance",
    radius: float = EARTH_RADIUS_KM,
) -> DataFrame:
    """Inner-join each point to the site whose key equals its key, with the
    distance between them (32-bit, like the stored coordinates).

    When ``point_key == site_key`` the key appears once in the output.
    """
    if point_key == site_key:
        joined = points.join(sites, on=point_key, how="inner")
    else:
        joined = points.join(sites, ref(point_key) == sites[f"`{site_key}`"], "inner")
    distance = haversine_km(ref(point_lat), ref(point_lon), ref(site_lat), ref(site_lon), radius)
    return joined.withColumn(distance_col, distance.cast("float"))


def site_locations(sites: DataFrame, site_key: str, site_lat: str, site_lon: str, site_cols: Sequence[str] = ()) -> DataFrame:
    """One row per distinct site location, carrying the smallest-key site there.

    Columns: ``_lat``, ``_lon`` (doubles) and ``_site`` (struct of key and
    ``site_cols``). Sites with a null coordinate can never be nearest and are
    left out.
    """
    payload = F.struct(ref(site_key).alias("key"), *[ref(c).alias(c) for c in site_cols])
    located = sites.select(
        ref(site_lat).cast("double").alias("_lat"),
        ref(site_lon).cast("double").alias("_lon"),
        payload.alias("_site"),
    ).filter(F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
    return located.groupBy("_lat", "_lon").agg(F.min("_site").alias("_site"))


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df``; runs nothing."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def nearest_site(
    points: DataFrame,
    sites: DataFrame,
    point_lat: str,
    point_lon: str,
    site_key: str,
    site_lat: str,
    site_lon: str,
    site_cols: Sequence[str] = (),
    max_km: float | None = 1000.0,
    distance_col: str = "distance",
    site_key_as: str | None = None,
    radius: float = EARTH_RADIUS_KM,
    search: str = "auto",
) -> DataFrame:
    """Every point with its nearest site strictly within ``max_km``.

    Adds the site key (as ``site_key_as``, default ``site_key``), the
    ``site_cols`` and the distance (32-bit). A point with a null coordinate,
    or with no site in range, is kept with nulls there. ``max_km=None``
    searches the whole sphere. ``search`` names the way: ``fold``, ``descent``,
    or ``auto``, which folds over few locations; the answers are the same.
    """
    if search not in ("auto", "fold", "descent"):
        raise ValueError("search must be auto, fold or descent")
    locations = site_locations(sites, site_key, site_lat, site_lon, site_cols)
    key_out = site_key_as or site_key
    if points.isStreaming or search == "fold" or search == "auto" and estimated_bytes(locations) <= FOLD_BYTES:
        found = _nearest_by_fold(points, locations, point_lat, point_lon, max_km, radius)
        return _expand(found, key_out, site_cols, distance_col)
    lat, lon = ref(point_lat).cast("double"), ref(point_lon).cast("double")
    places = points.select(lat.alias("_plat"), lon.alias("_plon")).filter("_plat is not null and _plon is not null").distinct()
    spots = sites.select(ref(site_lat).cast("double").alias("_lat"), ref(site_lon).cast("double").alias("_lon"))
    best = _nearest_by_descent(places, locations, max_km, radius, spots.filter("_lat is not null and _lon is not null"))
    joined = points.join(best, lat.eqNullSafe(F.col("_plat")) & lon.eqNullSafe(F.col("_plon")), "left").drop("_plat", "_plon")
    return _expand(joined, key_out, site_cols, distance_col)


def _expand(df: DataFrame, key_out: str, site_cols: Sequence[str], distance_col: str) -> DataFrame:
    best = F.col("_best")
    return df.select(
        *[ref(c) for c in df.columns if c != "_best"],
        best["site"]["key"].alias(key_out),
        *[best["site"][c].alias(c) for c in site_cols],
        best["d"].cast("float").alias(distance_col),
    )


def _nearest_by_fold(points: DataFrame, locations: DataFrame, point_lat: str, point_lon: str, max_km, radius) -> DataFrame:
    """``points`` plus ``_best``: struct ``(d, site)`` of the nearest location, or null."""
    phi, lam = F.radians(F.col("_lat")), F.radians(F.col("_lon"))
    table = locations.agg(
        F.sort_array(
            F.collect_list(F.struct(F.col("_site").alias("site"), phi.alias("phi"), lam.alias("lam"), F.cos(phi).alias("cphi")))
        ).alias("arr")
    )
    # Uncorrelated scalar subqueries: each computed once, then a constant of the
    # plan. The fold carries the angles alone; the site is fetched by position.
    angles = table.select(F.transform("arr", lambda s: F.struct(s["phi"], s["lam"], s["cphi"])).alias("angles")).scalar()
    names = table.select(F.col("arr.site").alias("names")).scalar()
    # Per-point radians and cosine are computed once, outside the fold.
    p_phi = F.radians(ref(point_lat).cast("double"))
    keep = [ref(c) for c in points.columns]
    staged = points.select(
        *keep, angles.alias("_sites"), p_phi.alias("_pphi"), F.radians(ref(point_lon).cast("double")).alias("_plam"), F.cos(p_phi).alias("_pcos")
    )
    # (a, position) per location: ``a`` ranks like the distance, and position
    # follows key order, so the struct minimum is the nearest location with
    # the smallest key among equals.
    scored = F.transform(
        F.col("_sites"),
        lambda s, i: F.struct(
            haversine_term(s["phi"] - F.col("_pphi"), s["lam"] - F.col("_plam"), F.col("_pcos"), s["cphi"]).alias("a"),
            i.alias("i"),
        ),
    )
    # The fold runs once, in its own projection; the next one only reads it.
    folded = staged.select(*keep, F.array_min(scored).alias("_w"))
    d = km_of_haversine(F.col("_w.a"), radius)
    in_range = d < max_km if max_km is not None else d.isNotNull()
    best = F.when(in_range, F.struct(d.alias("d"), F.get(names, F.col("_w.i")).alias("site")))
    return folded.select(*keep, best.alias("_best"))


def _unit_xyz(lat: str, lon: str, names: str) -> list[str]:
    """The place on the unit sphere, as SQL. The builders below write SQL text:
    a level is some hundred column calls otherwise, each a trip to the JVM."""
    x, y, z = names.split()
    return [
        f"cos(radians({lat})) * cos(radians({lon})) AS {x}", f"cos(radians({lat})) * sin(radians({lon})) AS {y}", f"sin(radians({lat})) AS {z}",
    ]


def _cell(names: str) -> str:
    """Number of the place's cell, the smallest of all cubes. A cube at a level
    is the cells that agree in the upper bits of each axis."""
    x, y, z = (f"({_HALF} + floor({n} * {1 / _CELL!r}D))" for n in names.split())
    return f"if(isnan({names.split()[1]}), 0L, ({x} * {2**_BITS} + {y}) * {2**_BITS} + {z})"


def _cube(cell: str, edge: float) -> str:
    """Number of the cube around a cell: the cell at its corner."""
    axis = 2**_BITS - int(edge / _CELL)
    return f"({cell} & {axis << 2 * _BITS | axis << _BITS | axis}L)"


def _corner(cell: str) -> list[str]:
    return [f"(((shiftright({cell}, {_BITS * k}) & {2**_BITS - 1}L) - {_HALF}) * {_CELL!r}D)" for k in (2, 1, 0)]


def _levels(spots: DataFrame) -> list[DataFrame]:
    """For each edge the cubes that hold locations (``cell``), by the cube above
    (``parent``; none above the top): of each cube one cell that holds a location,
    its representative, with its middle (``x y z``), as ``reps``. Each level is
    made from the one below."""
    middle = ", ".join(f"{c} + {_CELL / 2!r}D AS {n}" for n, c in zip("xyz", _corner("c")))
    cells = spots.groupBy(F.expr(_cube("cell", _EDGES[-1])).alias("cube")).agg(F.min("cell").alias("cell"))
    out = []
    for above in reversed(_EDGES[:-1]):
        held = cells.groupBy(F.expr(_cube("cell", above)).alias("parent")).agg(F.collect_list("cell").alias("reps"))
        held = held.filter("parent IS NOT NULL")  # as the join infers it: one shuffle serves both uses
        out.append(held.selectExpr("parent", f"transform(reps, c -> struct(c AS cell, {middle})) AS reps"))
        cells = held.select(F.array_min("reps").alias("cell"))
    return [cells, *reversed(out)]


def _squares(terms: Sequence[str]) -> str:
    return " + ".join(f"pow({t}, 2D)" for t in terms)


def _near(cube: str, edge: float) -> str:
    """Lower bound of the squared chord between a place and those in a cube."""
    return _squares([f"greatest(0D, {c} - p{n}, p{n} - {c} - {edge!r}D)" for n, c in zip("xyz", _corner(cube))])


def _closer(rows: DataFrame, kept: Sequence[str], edge: float) -> DataFrame:
    """The cubes of ``reps`` (as ``cube``) whose lower bound is no more than
    ``most``, nor than the least upper bound among them, which becomes ``most``.
    It is computed below the explode, once for each row."""
    least = f"array_min(transform(reps, r -> {_squares([f'r.{n} - p{n}' for n in 'xyz'])}))"
    high = f"pow(sqrt({least}) + {_CELL * math.sqrt(0.75)!r}D, 2D) * {1 + _SLACK!r}D + {_LEAST!r}D"
    bounded = rows.selectExpr(*kept, "reps.cell AS cells", f"least(most, {high}) AS most")
    cubes = bounded.selectExpr(*kept, "most", "explode_outer(cells) AS cell").selectExpr(*kept, "most", f"{_cube('cell', edge)} AS cube")
    return cubes.filter(f"{_near('cube', edge)} <= most")


def _nearest_by_descent(places: DataFrame, locations: DataFrame, max_km, radius: float, spots: DataFrame | None = None) -> DataFrame:
    """``_plat``, ``_plon`` → ``_best`` for the places with a location in range.
    ``spots`` are the places of the locations, repeated or not: the cubes are
    found from them, so the locations themselves are shuffled once."""
    far = 4.0 if max_km is None else (2.0 * math.sin(min(max_km / (2.0 * radius), math.pi / 2))) ** 2
    far = far * (1 + _SLACK) + _LEAST
    spots = locations if spots is None else spots
    levels = _levels(spots.selectExpr(*_unit_xyz("_lat", "_lon", "x y z")).selectExpr(f"{_cell('x y z')} AS cell"))

    # Pairs of top cubes: all those that meet the sphere (indices -1/edge to
    # 1/edge) with those that hold locations, both bounded by geometry.
    top, side = _EDGES[0], int(2 / _EDGES[0]) + 1
    homes = locations.sparkSession.range(side**3).selectExpr(
        *[f"(id div {side**i} % {side} - {int(1 / top)}) * {top!r}D AS h{n}" for i, n in enumerate("xyz")]
    )
    gap = _squares([f"greatest(0D, abs({c} - h{n}) - {top!r}D)" for n, c in zip("xyz", _corner(_cube("cell", top)))])
    reach = _squares([f"greatest(abs({c} + {_CELL!r}D - h{n}), abs({c} - h{n} - {top!r}D))" for n, c in zip("xyz", _corner("cell"))])
    pairs = homes.join(F.broadcast(levels[0]), F.expr(f"{gap} <= {far!r}D")).selectExpr(f"{_cell('hx hy hz')} AS home", "cell", f"{gap} AS low", f"{reach} AS high")
    # the least is a window's, so no condition on it can be moved below what computes the bounds
    pairs = pairs.selectExpr("*", f"least(min(high) OVER (PARTITION BY home) * {1 + _SLACK!r}D + {_LEAST!r}D, {far!r}D) AS most")
    middle = ", ".join(f"{c} + {_CELL / 2!r}D AS {n}" for n, c in zip("xyz", _corner("cell")))
    home = pairs.filter("low <= most").groupBy("home").agg(F.expr(f"collect_list(struct(cell, {middle})) AS reps"))

    place = ["_plat", "_plon"]
    kept = [*place, "px", "py", "pz"]
    at = places.selectExpr("_plat", "_plon", *_unit_xyz("_plat", "_plon", "px py pz"), f"{far!r}D AS most")
    rows = at.selectExpr("*", f"{_cube(_cell('px py pz'), top)} AS home").join(F.broadcast(home), "home")
    rows = _closer(rows, kept, top)
    for edge, level in zip(_EDGES[1:], levels[1:]):
        rows = _closer(rows.withColumnRenamed("cube", "parent").join(level, "parent"), kept, edge)
        # the bound of all cubes of the place
        rows = rows.selectExpr(*kept, "cube", "min(most) OVER (PARTITION BY _plat, _plon) AS most").filter(f"{_near('cube', edge)} <= most")
    located = locations.selectExpr("_site", "_lat", "_lon", *_unit_xyz("_lat", "_lon", "x y z"))
    located = located.selectExpr("_site", "_lat", "_lon", f"{_cube(_cell('x y z'), _EDGES[-1])} AS cube")
    met = rows.join(located, "cube")
    phi, lam, pphi, plam = (F.radians(F.col(c)) for c in ("_lat", "_lon", "_plat", "_plon"))
    a = haversine_term(phi - pphi, lam - plam, F.cos(pphi), F.cos(phi))
    # a squared chord is four times the haversine term
    met = met.withColumn("a", a).filter(4 * F.col("a") <= F.col("most"))
    best = met.groupBy("_plat", "_plon").agg(F.min(F.struct("a", F.col("_site").alias("site"))).alias("w"))
    d = km_of_haversine(F.col("w.a"), radius)
    found = best.select("_plat", "_plon", F.struct(d.alias("d"), F.col("w.site").alias("site")).alias("_best"))
    return found if max_km is None else found.filter(F.col("_best.d") < max_km)
