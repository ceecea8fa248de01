"""Nearest-location join and the distance-adjusted proxy series.

Nearest neighbour without pairing every query point with every candidate:
points are placed on the unit sphere, distances are chords. Small candidate
sets are broadcast as arrays per cell (``_nearest_broadcast``). Larger ones are
kept in a tree of cubic cells, each split in 4 x 4 x 4 until it holds few
points, with the number of points and one representative point per cell:

* A query's finest own cell that holds any point gives an upper bound of its
  distance: the distance to that cell's representative. Everything within the
  bound lies in the at most 8 cells of twice that width that touch it.
* From there the query goes down: cells farther away than its bound are left,
  representatives of the others lower the bound, and cells with many points
  are replaced by their children. A dense cluster is never paired as a whole:
  only its cells at the query's distance are opened.
* The points of the few cells that remain are compared exactly.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayframe.functions import clamp, haversine_km, sql_round, unit_vector
from dayframe.sources.sinks import stored

# Cell edges in chord units, finest first; ends at the sphere's diameter.
DEFAULT_LEVELS = (2.0 / 4 ** 5, 2.0 / 4 ** 4, 2.0 / 4 ** 3, 2.0 / 4 ** 2, 2.0 / 4, 2.0)
# Candidate sets up to this many points (after merging shared coordinates) are
# broadcast as per-cell arrays, each point listed in the 27 cells around its
# own: about 27 x 60 bytes per point, so at most ~16 MB.
MAX_BROADCAST_CANDIDATES = 10_000
_OFFSETS = list(itertools.product((-1, 0, 1), repeat=3))
# The cell tree: the root covers the sphere, every level has a quarter of the edge (the last
# one some 20 cm); cells with more than LEAF points are split.
ROOT_EDGE, LAST_LEVEL, LEAF = 4.0, 13, 16
CELL = ["__cx", "__cy", "__cz"]
# Bounds carry rounding errors of some 1e-16; nothing within this margin is left out.
SLACK = 1e-9
# Places meet days in blocks: at most BLOCK_DAYS days of a series and as many of its places as make
# about BLOCK_ROWS rows. A task has two blocks on average, more beyond MAX_TASKS tasks.
BLOCK_DAYS, BLOCK_ROWS, MAX_TASKS = 1 << 12, 1 << 17, 1 << 14


def start_levels(levels, n_candidates: int):
    """Skip grids much finer than the candidates' typical spacing.

    n points spread over the unit sphere (area 4 pi) are about
    sqrt(4 pi / n) apart; grids with cells under half of that would mostly
    find empty neighbourhoods and only add passes. Exactness does not depend
    on the choice (the last grid always resolves every point).
    """
    if n_candidates <= 0:
        return levels[-1:]
    spacing = math.sqrt(4 * math.pi / n_candidates)
    kept = [c for c in levels if c >= spacing / 2]
    return tuple(kept) if kept else levels[-1:]


def _cells(x: Column, y: Column, z: Column, c: float) -> list[Column]:
    return [F.floor(v / F.lit(c)).cast("long") for v in (x, y, z)]


def nearest(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
            left_lat: str = "lat", left_lon: str = "lon",
            right_lat: str = "latitude", right_lon: str = "longitude",
            levels=DEFAULT_LEVELS, max_broadcast: int = MAX_BROADCAST_CANDIDATES,
            counted: dict | None = None) -> DataFrame:
    """For each left row: the closest right row by great-circle distance.

    Returns (left_id, right_id, distance_km). Ties on distance go to the
    smaller right id. Right rows sharing coordinates are reduced to the
    smallest id first, so piles of duplicates do not multiply candidates.
    Every left row with coordinates gives one row, whatever its id (NULL and
    repeated ids too).

    When the exact count of candidates is at most ``max_broadcast``, the
    candidate side is the one spread over the 27 neighbouring cells and
    collected into one array per cell; that table is broadcast and each query
    takes the minimum over its own cell's array, so no level shuffles the
    queries or their pairs. Larger candidate sets use the cell tree, on the
    distinct query places; its tables are written as it goes down (one small
    job a level). ``counted`` receives the number of pairs of a place and a cell or
    point that were compared.
    """
    if levels[-1] < 2.0:
        raise ValueError("the last level must have cell edge >= 2 so every point resolves")
    r = (right.filter(F.col(right_lat).isNotNull() & F.col(right_lon).isNotNull())
         .groupBy(F.col(right_lat).alias("__rlat"), F.col(right_lon).alias("__rlon"))
         .agg(F.min(right_id).alias("__rid")))
    n_candidates = r.count()
    levels = start_levels(levels, n_candidates)
    rx, ry, rz = unit_vector("__rlat", "__rlon")
    r = r.withColumns({"__rx": rx, "__ry": ry, "__rz": rz})

    q = left.select(F.col(left_id).alias("__lid"), F.col(left_lat).alias("__llat"),
                    F.col(left_lon).alias("__llon")).filter(
        F.col("__llat").isNotNull() & F.col("__llon").isNotNull())
    qx, qy, qz = unit_vector("__llat", "__llon")
    pending = q.withColumns({"__qx": qx, "__qy": qy, "__qz": qz})

    offsets = F.array(*[F.array(*[F.lit(o) for o in off]) for off in _OFFSETS])
    if n_candidates <= max_broadcast:
        out = _nearest_broadcast(pending, r, levels, offsets)
        return out.select(F.col("__lid").alias(left_id), F.col("__rid").alias(right_id),
                          F.col("__d").alias("distance_km"))
    # one row per place: neither repeated ids nor repeated places multiply the pairs
    place = ["__llat", "__llon"]
    places = stored(pending.drop("__lid").distinct().withColumn(
        "__q", F.monotonically_increasing_id()), "nearest-places")
    best = _nearest_in_tree(places, stored(r, "nearest-points"), counted)
    out = q.join(places.join(best, "__q").select(*place, "__rid", "__d"), place)
    return out.select(F.col("__lid").alias(left_id), F.col("__rid").alias(right_id),
                      F.col("__d").alias("distance_km"))


def _edge(level: int) -> float:
    return ROOT_EDGE / 4 ** level


def _cell(x: str, y: str, z: str, level: int) -> dict[str, Column]:
    """The cell of a point at a level (the root is cell 0, 0, 0)."""
    return {name: F.floor((F.col(c) + ROOT_EDGE / 2) / _edge(level)).cast("int")
            for name, c in zip(CELL, (x, y, z))}


def _chord(*pairs: tuple[Column, Column]) -> Column:
    return F.sqrt(reduce(lambda a, b: a + b, [F.pow(x - y, 2) for x, y in pairs]))


def _cell_tree(points: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Cells (level, cell, number of points, a representative) from the root down to cells of at most
    ``LEAF`` points; the points with their leaf cell; and the deepest level."""
    cells, leaves = [], []
    left = points
    for level in range(LAST_LEVEL + 1):
        here = left.withColumns(_cell("__rx", "__ry", "__rz", level))
        nodes = stored(here.groupBy(*CELL).agg(
            F.count("*").alias("__n"), F.min(F.struct("__rid", "__rx", "__ry", "__rz")).alias("__rep"))
            .select(F.lit(level).alias("__level"), *CELL, "__n", F.col("__rep.__rx").alias("__px"),
                    F.col("__rep.__ry").alias("__py"), F.col("__rep.__rz").alias("__pz"),
                    ((F.col("__n") <= LEAF) | F.lit(level == LAST_LEVEL)).alias("__leaf")),
            "nearest-cells")
        cells.append(nodes)
        split = here.join(nodes.select(*CELL, "__leaf"), CELL)
        leaves.append(split.where("__leaf").drop("__leaf").withColumn("__level", F.lit(level)))
        if nodes.where("not __leaf").isEmpty():
            break
        left = stored(split.where("not __leaf").drop("__leaf", *CELL), "nearest-left")
    return reduce(DataFrame.unionByName, cells), stored(
        reduce(DataFrame.unionByName, leaves), "nearest-leaves"), level


def _measured(pairs: DataFrame) -> DataFrame:
    """Pairs of a query and a cell, with the query's bound lowered by the cells' representatives and
    without the cells beyond it."""
    edge = F.lit(ROOT_EDGE) / F.pow(F.lit(4.0), F.col("__level"))
    gaps = []
    for c, x in zip(CELL, ("__qx", "__qy", "__qz")):
        low = F.col(c) * edge - ROOT_EDGE / 2
        gaps.append(F.greatest(low - F.col(x), F.col(x) - (low + edge), F.lit(0.0)))
    near = reduce(lambda a, b: a + b, [F.pow(g, 2) for g in gaps])
    to_rep = _chord((F.col("__qx"), F.col("__px")), (F.col("__qy"), F.col("__py")),
                    (F.col("__qz"), F.col("__pz")))
    seen = pairs.withColumns({"__near": F.sqrt(near), "__rep_at": to_rep})
    bounds = seen.groupBy("__q").agg(F.least(F.min("__rep_at"), F.min("__bound")).alias("__lower"))
    return seen.join(bounds, "__q").where(F.col("__near") <= F.col("__lower") + SLACK).withColumn(
        "__bound", F.col("__lower")).drop("__lower", "__near", "__rep_at")


def _nearest_in_tree(places: DataFrame, points: DataFrame, counted: dict | None) -> DataFrame:
    """(__q, __rid, __d) for every place, by going down the cell tree."""
    cells, leaves, depth = _cell_tree(points)
    compared = 0
    if places.isEmpty() or points.isEmpty():
        return places.select("__q", F.lit(None).alias("__rid"), F.lit(None).cast("double").alias(
            "__d")).limit(0)
    # the finest own cell that holds a point bounds the distance
    own = F.array(*[F.struct(F.lit(level).alias("__level"), *[c.alias(n) for n, c in _cell(
        "__qx", "__qy", "__qz", level).items()]) for level in range(depth + 1)])
    keys = ["__level", *CELL]
    held = places.select("__q", F.inline(own)).join(cells.select(*keys, "__px", "__py", "__pz"), keys)
    finest = held.groupBy("__q").agg(F.max_by(
        F.struct("__px", "__py", "__pz"), "__level").alias("__rep"))
    bounded = places.join(finest, "__q").withColumn("__bound", _chord(
        *[(F.col(f"__q{c}"), F.col(f"__rep.__p{c}")) for c in "xyz"])).drop("__rep")
    # start at the finest level at which at most 2 x 2 x 2 cells touch the ball of that radius, and
    # with the leaves above it that do
    level = F.lit(0)
    for k in range(1, depth + 1):
        level = F.when(2 * (F.col("__bound") + SLACK) <= _edge(k), F.lit(k)).otherwise(level)

    def touching(j: Column) -> Column:
        edge = F.lit(ROOT_EDGE) / F.pow(F.lit(4.0), j)
        def at(x: str, sign: int) -> Column:
            return F.floor((F.col(x) + sign * (F.col("__bound") + SLACK) + ROOT_EDGE / 2) / edge).cast(
                "int")
        return F.array(*[F.struct(j.alias("__level"), *[at(x, sign).alias(n) for n, x, sign in zip(
            CELL, ("__qx", "__qy", "__qz"), signs)]) for signs in itertools.product((-1, 1), repeat=3)])

    start = bounded.withColumn("__start", level).withColumn("__touch", F.array_distinct(F.flatten(
        F.transform(F.sequence(F.lit(0), F.col("__start")), touching))))
    start = start.select(*[c for c in start.columns if c != "__touch"], F.inline("__touch"))
    pairs = start.join(cells, keys).where(
        F.col("__leaf") | (F.col("__level") == F.col("__start"))).drop("__start")
    open_pairs = stored(_measured(pairs), "nearest-pairs")
    done = [open_pairs.where("__leaf").select("__q", *keys)]
    while True:
        if counted is not None:
            compared += open_pairs.count()
        inner = open_pairs.where("not __leaf")
        if inner.isEmpty():
            break
        child = cells.select("*", *[F.floor(F.col(c) / 4).cast("int").alias(f"__u{c[-1]}")
                                    for c in CELL], (F.col("__level") - 1).alias("__above"))
        parent = inner.select("__q", "__qx", "__qy", "__qz", "__bound", F.col("__level").alias(
            "__above"), *[F.col(c).alias(f"__u{c[-1]}") for c in CELL])
        open_pairs = stored(_measured(parent.join(child, ["__above", "__ux", "__uy", "__uz"]).drop(
            "__above", "__ux", "__uy", "__uz")), "nearest-pairs")
        done.append(open_pairs.where("__leaf").select("__q", *keys))
    final = reduce(DataFrame.unionByName, done).select("__q", *keys)
    matched = final.join(leaves, keys).join(places, "__q")
    if counted is not None:
        counted["pairs"] = compared + matched.count()
    return matched.withColumn("__km", haversine_km("__llat", "__llon", "__rlat", "__rlon")).groupBy(
        "__q").agg(F.min(F.struct("__km", "__rid")).alias("__b")).select(
        "__q", F.col("__b.__rid").alias("__rid"), F.col("__b.__km").alias("__d"))


def _nearest_broadcast(pending: DataFrame, r: DataFrame, levels, offsets: Column) -> DataFrame:
    """Per level: broadcast cell -> candidate array, best per query by
    ``array_min`` (map-only); unresolved queries go on to the next level."""
    results = []
    keys = ["__cx", "__cy", "__cz"]
    for c in levels:
        cx, cy, cz = _cells(F.col("__rx"), F.col("__ry"), F.col("__rz"), c)
        cand = (r.select(cx.alias("__ox"), cy.alias("__oy"), cz.alias("__oz"),
                         F.struct("__rx", "__ry", "__rz", "__rid", "__rlat", "__rlon").alias("__p"))
                .withColumn("__off", F.explode(offsets))
                .groupBy((F.col("__ox") + F.col("__off")[0]).alias("__cx"),
                         (F.col("__oy") + F.col("__off")[1]).alias("__cy"),
                         (F.col("__oz") + F.col("__off")[2]).alias("__cz"))
                .agg(F.collect_list("__p").alias("__ps")))
        own = dict(zip(keys, _cells(F.col("__qx"), F.col("__qy"), F.col("__qz"), c)))
        best = F.array_min(F.transform("__ps", lambda p: F.struct(
            haversine_km(F.col("__llat"), F.col("__llon"), p["__rlat"], p["__rlon"]).alias("__d"),
            p["__rid"].alias("__rid"),
            F.sqrt(F.pow(F.col("__qx") - p["__rx"], 2) + F.pow(F.col("__qy") - p["__ry"], 2)
                   + F.pow(F.col("__qz") - p["__rz"], 2)).alias("__chord"))))
        level = (pending.withColumns(own).join(F.broadcast(cand), keys, "left")
                 .withColumn("__b", best).drop("__ps", *keys))
        done = F.col("__b.__chord") <= F.lit(c)
        resolved = level.filter(done).select(
            "__lid", F.col("__b.__rid").alias("__rid"), F.col("__b.__d").alias("__d"))
        results.append(resolved)
        if c >= 2.0:
            break
        pending = level.filter(F.col("__b").isNull() | ~done).drop("__b")
    out = results[0]
    for extra in results[1:]:
        out = out.unionByName(extra)
    return out


def number_days(days: DataFrame, source_id: str, day_col: str) -> DataFrame:
    """``day_number``: the 0-based place of a day among its source's days (one exchange on the
    source; a source has at most one row a calendar day)."""
    return days.withColumn("day_number", F.row_number().over(
        Window.partitionBy(source_id).orderBy(day_col)) - 1)


def number_all_days(days: DataFrame, source_id: str, day_col: str) -> DataFrame:
    """``day_number`` over the days of all sources together, by day, then source. The number of rows
    of each earlier day (one row a calendar day) gives a day's offset."""
    per_day = days.groupBy(day_col).agg(F.count("*").alias("__n"))
    offset = per_day.select(F.col(day_col).alias("__day"), F.coalesce(F.sum("__n").over(
        Window.orderBy(day_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy(day_col).orderBy(source_id)) - 1
    return days.join(offset, days[day_col] == offset["__day"]).withColumn(
        "day_number", (F.col("__before") + place).cast("int")).drop("__day", "__before")


def fan_out(places: DataFrame, days: DataFrame) -> DataFrame:
    """Every place with every day of its series (``__series`` on both sides).

    ``places`` are stored, with an id a row (``__place``) and the number of days of the place's series
    (``__days``); ``day_number`` counts a series' days from 0. A few series may have all the places, so
    the rows are dealt to tasks by the number of rows they become, not by series.
    """
    n, some = F.count("*"), F.max("__days")
    sizes = stored(places.groupBy("__series").agg((n * some).alias("__rows"), F.greatest(
        F.lit(1), F.ceil(some / BLOCK_DAYS)).alias("__blocks"), F.greatest(
        F.lit(1), F.ceil(n * F.least(some, F.lit(BLOCK_DAYS)) / BLOCK_ROWS)).alias("__chunks")),
        "proxy-sizes")
    rows = sizes.agg(F.sum("__rows")).first()[0] or 0
    tasks = max(1, min(MAX_TASKS, -(-rows // (2 * BLOCK_ROWS))))
    keys = ["__series", "__block", "__chunk"]
    left = places.join(sizes, "__series").withColumns({
        "__chunk": F.pmod(F.xxhash64("__place"), F.col("__chunks")),
        "__block": F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))})
    right = days.join(sizes.select("__series", "__chunks"), "__series").withColumns({
        "__block": F.floor(F.col("day_number") / BLOCK_DAYS),
        "__chunk": F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1))})
    return left.drop("__rows", "__blocks", "__chunks", "__days", "__place").repartition(
        tasks, *keys).join(right.drop("__chunks").repartition(tasks, *keys), keys).drop(*keys)


def proxy_series(atlas: DataFrame, source_map: DataFrame, sources: DataFrame, source_days: DataFrame,
                 atlas_key: str = "s_suppkey", atlas_id: str = "city", atlas_lat: str = "lat",
                 atlas_lon: str = "lon", atlas_region: str = "region",
                 source_id: str = "location_id", source_name: str = "city_name",
                 source_lat: str = "latitude", day_col: str = "weather_date",
                 temp_col: str = "temperature_2m_mean", rain_col: str = "precipitation_sum",
                 coast_regions=(), ref_lat: float = 40.4) -> DataFrame:
    """Estimate a daily series for unmeasured places from their nearest source.

    ``source_map``: (atlas_key, source_id, distance_km), one row a place.
    ``sources``: (source_id, source_name, source_lat). ``source_days`` holds the
    sources' series (source_id, day, temperature, rain), filtered to the dates wanted; ``day_number`` is the
    0-based ordinal of the day within its source. A place whose source has no
    day is given the days of all sources, by day and source, numbered through;
    its source stays the nearest one.
    temp = source temp + (ref_lat - lat) * 0.42 + coast (-0.8 near lon 0 or in a
    coastal region) + (source lat - lat) * 0.12 + 0.9 * sin(0.92 * day + phase),
    phase from a stable hash of the name; rain scales with distance (capped at
    850 km); comfort = clamp(100 - 5.2 |temp - 22| - 7 rain, 0, 100).
    """
    day = source_days.select(source_id, day_col, temp_col, rain_col)
    days = number_days(day, source_id, day_col).withColumn(
        "__series", F.concat(F.lit("="), F.col(source_id).cast("string"))).drop(source_id)
    # per-place constants, computed once per place before the fan-out to days
    coast = F.when((F.abs(F.col(atlas_lon)) < 1.0) | F.col(atlas_region).isin(*coast_regions)
                   if coast_regions else (F.abs(F.col(atlas_lon)) < 1.0),
                   F.lit(-0.8)).otherwise(F.lit(0.0))
    # stable phase per place: first 32 bits of md5(name) mod 628, over 100
    phase = (F.conv(F.substring(F.md5(F.col(atlas_id).cast("string")), 1, 8), 16, 10).cast("long")
             % 628) / F.lit(100.0)
    measured = day.groupBy(F.col(source_id).alias("__has")).agg(F.count("*").alias("__days"))
    located = atlas.join(source_map, atlas_key).join(
        sources.select(source_id, source_name, source_lat), source_id)
    places = located.join(measured, located[source_id] == measured["__has"], "left").select(
        *[F.col(c) for c in (atlas_id, atlas_region, atlas_lat, atlas_lon, source_name)],
        F.concat(F.lit("="), F.col("__has").cast("string")).alias("__series"), "__days",
        F.monotonically_increasing_id().alias("__place"),
        ((F.lit(ref_lat) - F.col(atlas_lat)) * 0.42 + coast
         + (F.col(source_lat) - F.col(atlas_lat)) * 0.12).alias("__shift"),
        phase.alias("__phase"),
        (F.lit(1.0) + F.least(F.col("distance_km"), F.lit(850.0)) / 2400.0).alias("__rain_factor"),
        sql_round(F.col("distance_km"), 0).alias("signal_distance_km"))
    places = stored(places, "proxy-places")  # read for their sizes and for the fan-out
    if not places.where("__series is null").isEmpty():
        # all days for each of these places, as one more series
        every = number_all_days(day, source_id, day_col).drop(source_id)
        days = days.unionByName(every.withColumn("__series", F.lit("*")))
        places = places.withColumns({
            "__series": F.coalesce("__series", F.lit("*")),
            "__days": F.coalesce("__days", F.lit(source_days.count()))})
    joined = fan_out(places, days.withColumn("frame", F.date_format(day_col, "dd MMM")))
    out = joined.withColumns({
        "__t": F.col(temp_col) + F.col("__shift")
        + F.sin(F.col("day_number") * 0.92 + F.col("__phase")) * 0.9,
        "__r": F.greatest(F.lit(0.0), F.col(rain_col) * F.col("__rain_factor"))})
    comfort = clamp(F.lit(100.0) - F.abs(F.col("__t") - 22.0) * 5.2 - F.col("__r") * 7.0, 0.0, 100.0)
    return out.select(
        F.col(atlas_id).alias("city"), F.col(atlas_region).alias("region"),
        F.col(atlas_lat).alias("lat"), F.col(atlas_lon).alias("lon"),
        F.col(day_col).alias("weather_date"),
        "frame", "day_number",
        sql_round(F.col("__t"), 1).alias("temperature_c"),
        sql_round(F.col("__r"), 1).alias("rain_mm"),
        sql_round(comfort, 1).alias("comfort"),
        F.col(source_name).alias("signal_city"),
        "signal_distance_km",
        F.greatest(F.lit(7.0), F.lit(13.0) + F.col("__r") * 3.2
                   + F.greatest(F.lit(0.0), F.col("__t") - 25.0) * 0.5).alias("pulse_size"),
    )
