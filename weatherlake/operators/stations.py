"""Stations: the station dictionary, station files and the nearest station to
a query position.

``nearest_station`` has two rules, applied in this order:

1. if some stations lie closer than ``eps`` to the query, the first of them
   in the dictionary's order (``ord``) is taken, with the query's own
   coordinates;
2. otherwise the nearest station is taken (lowest ``ord`` among equal
   distances), with the station's coordinates.

It searches down a tree over the stations.  A level cuts every cell that holds
more than ``LEAF`` positions at quantiles, into ``FACTOR`` strips by longitude
and each of them into ``FACTOR`` by latitude, so the cells follow where the
stations are: one station far out takes its place in a cell and leaves the
others as they are.  There is one row per cell: the bounding box of its
stations and their lowest ``ord``.  At each level a query keeps the
cells that can still hold its answer (their box is not farther than the best
distance some other box guarantees, or meets the circle of ``eps`` and has a
low enough ``ord``) and goes on to their children by an equi-join.  The number
of levels grows with the logarithm of the number of positions, and only the
children of kept cells become candidates.  No side is broadcast by hint; Spark
decides by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weatherlake import schema
from weatherlake.functions.exprs import half_even, planar_distance
from weatherlake.session import materialize

FACTOR = 4  # strips per axis that a cell is cut into
MAX_DEPTH = 15  # cell numbers have four bits per level; ten levels hold 10^13 positions
LEAF = 16  # positions in a cell that need no finer level


def load_stations(spark: SparkSession, path: str, *, swapped: bool = True) -> DataFrame:
    """Read a station dictionary CSV (``station,lat,lon`` header).

    The shipped dictionary holds longitude under ``lat`` and latitude under
    ``lon``; ``swapped=True`` puts them right.  ``ord`` keeps the file order
    (path, split, row) without a sort.  Columns: station, lat, lon, ord.
    """
    raw = (spark.read.option("header", True).option("escape", '"')
           .schema("station string, lat double, lon double").csv(path))
    lat, lon = ("lon", "lat") if swapped else ("lat", "lon")
    return raw.select(
        "station", F.col(lat).alias("lat"), F.col(lon).alias("lon"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("offset"),
                 F.monotonically_increasing_id().alias("row")).alias("ord"))


def write_stations(stations: DataFrame, path: str, *, swapped: bool = True, mode: str = "overwrite") -> None:
    """Write a dictionary as one CSV file with the ``station,lat,lon`` header,
    in the shipped column convention when ``swapped``.

    Rows are in the order of ``ord`` if the frame has it, else of (lat, lon,
    station), so a dictionary that is written and read again keeps its order
    and with it the answers of ``nearest_station``.  One file: the order of a
    dictionary is its row order, and it holds one row per station.
    """
    order = ["ord"] if "ord" in stations.columns else ["lat", "lon", "station"]
    lat, lon = ("lon", "lat") if swapped else ("lat", "lon")
    (stations.orderBy(*order).select("station", F.col(lat).alias("lat"), F.col(lon).alias("lon"))
     .coalesce(1).write.mode(mode).option("header", True).option("escape", '"').csv(path))


def station_dictionary(obs: DataFrame, *, digits: int = 4) -> DataFrame:
    """One station per distinct stored position: the station of the earliest
    report there (ties by station name), coordinates rounded half-even to
    ``digits``.  Columns: station, lat, lon.

    The earliest time of every position and station is a hash aggregate of one
    packed long; only that small result is compared as structs.  Time parts
    beyond the packed range (1,022 for month, day and hour, 510 for minute) count as
    equal to it; a missing part comes first.
    """
    packed = F.lit(0).cast("long")
    for part, bits in zip(schema.TIME_PARTS, (24, 10, 10, 10, 9)):
        value = F.least(F.greatest(F.coalesce(F.col(part) + 1, F.lit(0)), F.lit(0)), F.lit((1 << bits) - 1)).cast("long")
        packed = F.shiftleft(packed, bits).bitwiseOR(value)
    first = (obs.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
             .groupBy("lat", "lon", "station").agg(F.min(packed).alias("t")))
    per_pos = first.groupBy("lat", "lon").agg(F.min(F.struct("t", "station")).alias("f"))
    return per_pos.select(F.col("f.station").alias("station"), half_even("lat", digits).alias("lat"), half_even("lon", digits).alias("lon"))


def _finite(*cols: str) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce(ok, F.lit(False))


def _gap(q: str, lo: str, hi: str) -> Column:
    """Distance along one axis from the query to an interval."""
    return F.greatest(F.col(lo) - F.col(q), F.col(q) - F.col(hi), F.lit(0.0))


def _bounds(c: str) -> tuple[Column, Column, Column]:
    """For a query and a box: no station in it is closer than the first, some
    station is at most at the second, all are at most at the third.  Each face
    of a bounding box touches a station, which gives the second."""
    def far(q: str, axis: str) -> Column:
        return F.greatest(F.abs(F.col(q) - F.col(f"{c}.{axis}0")), F.abs(F.col(q) - F.col(f"{c}.{axis}1")))

    def near_face(q: str, axis: str) -> Column:
        return F.least(F.abs(F.col(q) - F.col(f"{c}.{axis}0")), F.abs(F.col(q) - F.col(f"{c}.{axis}1")))

    least = F.hypot(_gap("q_lon", f"{c}.x0", f"{c}.x1"), _gap("q_lat", f"{c}.y0", f"{c}.y1"))
    some = F.least(F.hypot(near_face("q_lon", "x"), far("q_lat", "y")), F.hypot(near_face("q_lat", "y"), far("q_lon", "x")))
    return least, some, F.hypot(far("q_lon", "x"), far("q_lat", "y"))


def _level(positions: DataFrame, cell: str, new: str) -> DataFrame:
    """Every cell with more than ``LEAF`` positions cut at quantiles; column
    ``new`` numbers the parts.  Quantiles combine before their shuffle, so the
    first cell, which has all positions, is no task's alone."""
    at = F.array(*[F.lit(k / FACTOR) for k in range(1, FACTOR)])

    def strip(axis: str, cuts: str) -> Column:
        return F.coalesce(F.size(F.filter(cuts, lambda x: x < F.col(axis))), F.lit(0))

    by_lon = positions.groupBy(cell).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("s_lon", at, 1000).alias("_x"))
    out = (positions.join(by_lon, cell)
           .withColumn("_strip", F.when(F.col("_n") > LEAF, strip("s_lon", "_x")).otherwise(0)).drop("_x"))
    by_lat = out.groupBy(cell, "_strip").agg(F.percentile_approx("s_lat", at, 1000).alias("_y"))
    part = F.col("_strip") * FACTOR + F.when(F.col("_n") > LEAF, strip("s_lat", "_y")).otherwise(0)
    return out.join(by_lat, [cell, "_strip"]).withColumn(new, F.col(cell) * (FACTOR * FACTOR) + part).drop("_n", "_strip", "_y")


def _tree(positions: DataFrame) -> tuple[DataFrame, int]:
    """Positions with their cell at every level, ``c1`` to ``c<depth>``."""
    depth, out = 0, positions.withColumn("c0", F.lit(0).cast("long"))
    while depth < MAX_DEPTH:
        depth += 1
        out = materialize(_level(out, f"c{depth - 1}", f"c{depth}"))
        # one small job per level; the answer is one number
        if out.groupBy(f"c{depth}").count().agg(F.max("count")).first()[0] <= LEAF:
            break
    return out, depth


def _candidates(q: DataFrame, st: DataFrame, eps: float) -> DataFrame:
    """The pairs of query and station whose distance is computed: for every
    query the stations of the finest cells it kept."""
    tree, depth = _tree(st)

    def cells(d: int) -> DataFrame:
        return (tree.groupBy(f"c{d}", f"c{d - 1}")
                .agg(F.min("s_lon").alias("x0"), F.max("s_lon").alias("x1"), F.min("s_lat").alias("y0"), F.max("s_lat").alias("y1"),
                     F.min("s_ord").alias("ord"))
                .select(F.col(f"c{d - 1}").alias("above"), F.struct(F.col(f"c{d}").alias("cell"), "x0", "x1", "y0", "y1", "ord").alias("c")))

    def can_hold(best: Column, hit: Column) -> Column:
        """The cell may hold the answer, given the best guarantee of all cells
        and the lowest ``ord`` of a cell that lies within eps as a whole."""
        may_hit = (F.col("lo") < eps * (1 + 1e-12)) & (hit.isNull() | (F.col("c.ord") <= hit))
        return may_hit | (hit.isNull() & (F.col("lo") <= best * (1 + 1e-12)))

    least, some, all_ = _bounds("c")
    inside = F.when(F.col("all") < eps * (1 - 1e-12), F.col("c.ord"))
    per_query = Window.partitionBy("qid", "q_lon", "q_lat")
    # at most FACTOR * FACTOR cells on the first level, as one array
    live = q.select("*", F.explode(cells(1).agg(F.collect_list("c").alias("cs")).scalar()).alias("c"))
    for d in range(1, depth + 1):
        bounded = live.withColumn("lo", least).withColumn("some", some).withColumn("all", all_)
        kept = (bounded.withColumn("_best", F.min("some").over(per_query)).withColumn("_hit", F.min(inside).over(per_query))
                .filter(can_hold(F.col("_best"), F.col("_hit"))).select("qid", "q_lon", "q_lat", F.col("c.cell").alias("above")))
        if d < depth:
            live = kept.join(cells(d + 1), "above").select("qid", "q_lon", "q_lat", "c")
    return (kept.join(tree.withColumnRenamed(f"c{depth}", "above"), "above")
            .withColumn("d", planar_distance(F.col("q_lon"), F.col("q_lat"), F.col("s_lon"), F.col("s_lat"))))


def nearest_station(queries: DataFrame, stations: DataFrame, *, eps: float = 1e-3, qid: str = "qid") -> DataFrame:
    """Snap query positions to stations (see the module notes for the rules).

    ``queries``: ``qid`` (unique), lon, lat.  ``stations``: station, lon, lat,
    ord (any orderable dictionary order).  Pass distinct query positions and
    join the answer back when many rows share a position.
    Columns: qid, station, lon, lat, distance, within_eps.  Stations whose
    position is null, NaN or infinite are ignored; a query at such a position,
    or without any station, gets NULLs.
    """
    if eps <= 0:
        raise ValueError("eps must be positive")
    st = stations.select("station", F.col("lon").cast("double").alias("s_lon"),
                         F.col("lat").cast("double").alias("s_lat"), F.col("ord").alias("s_ord"))
    # one row per position: the first in order answers for all of them
    st = materialize(st.filter(_finite("s_lon", "s_lat")).groupBy("s_lon", "s_lat")
                     .agg(F.min(F.struct("s_ord", "station")).alias("s")).select("s_lon", "s_lat", "s.s_ord", "s.station"))
    n = st.count()
    q = queries.select(F.col(qid).alias("qid"), F.col("lon").cast("double").alias("q_lon"),
                       F.col("lat").cast("double").alias("q_lat"))
    usable = _finite("q_lon", "q_lat")
    unanswered = (q.filter(~usable) if n else q).select(
        "qid", F.lit(None).cast("string").alias("station"), F.lit(None).cast("double").alias("lon"),
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("distance"),
        F.lit(None).cast("boolean").alias("within_eps"))
    if not n:
        return unanswered

    found = _candidates(q.filter(usable), st, eps)
    pick = F.struct("station", "s_lon", "s_lat", "d")
    best = found.groupBy("qid", "q_lon", "q_lat").agg(
        F.min_by(pick, F.struct("d", "s_ord")).alias("near"),
        F.min_by(pick, F.when(F.col("d") < eps, F.col("s_ord"))).alias("hit"))
    inside = F.col("hit").isNotNull()
    return best.select(
        "qid", F.when(inside, F.col("hit.station")).otherwise(F.col("near.station")).alias("station"),
        F.when(inside, F.col("q_lon")).otherwise(F.col("near.s_lon")).alias("lon"),
        F.when(inside, F.col("q_lat")).otherwise(F.col("near.s_lat")).alias("lat"),
        F.when(inside, F.col("hit.d")).otherwise(F.col("near.d")).alias("distance"),
        inside.alias("within_eps")).unionByName(unanswered)


def snap_position(stations: DataFrame, lon: float, lat: float, *, eps: float = 1e-3,
                  stored: bool = False) -> tuple[float, float, str]:
    """One position snapped to the dictionary: ``(lon, lat, station)``.

    One aggregate over the stations, no join.  The query's own coordinates
    come back when a station lies within ``eps`` (the first such in dictionary
    order), else the nearest station's.  ``stored`` gives the station's
    position in both cases: the one to look up observations with.
    """
    d = planar_distance(F.lit(float(lon)), F.lit(float(lat)), F.col("lon").cast("double"), F.col("lat").cast("double"))
    rows = stations.filter(_finite("lon", "lat")).select("station", "lon", "lat", "ord", d.alias("d"), (d < eps).alias("hit"))
    r = rows.agg(F.min_by(F.struct("station", "lon", "lat", "hit"),
                          F.struct(~F.col("hit"), F.when(F.col("hit"), 0.0).otherwise(F.col("d")), "ord")).alias("r")).first().r
    if r is None:
        raise ValueError("the station dictionary is empty")
    if r.hit and not stored:
        return float(lon), float(lat), r.station
    return float(r.lon), float(r.lat), r.station
