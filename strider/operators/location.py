"""Predicted route per half-hour slot, lookups with fallbacks, and nearby points."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strider.functions.geo import DEG_TO_RAD, EARTH_RADIUS_M, haversine_m
from strider.functions.timecols import SLOTS_PER_DAY, slot_text

# Fallback position when a slot has no prediction, and the default grid
# (slot i at base + i * step in both coordinates).
DEFAULT_LAT = 50.8231
DEFAULT_LNG = -0.1383
DEFAULT_STEP = 0.01
NO_TIME = "N/A"
# Markers are drawn only south of this latitude.
MAX_PLAUSIBLE_LAT = 50.9
# Nearby-place search radius (m) and number of places kept.
NEARBY_RADIUS_M = 1500.0
RIDGE = 1e-6                            # of the position regressions
NEARBY_TOP_K = 10
# Grid of the nearest places: places per cell that end its splitting (in sides of SPLIT), the
# deepest level (cells of centimetres), and room for rounding of distances (m).
LEAF_PLACES, SPLIT, DEEPEST, SLACK_M = 64, 4, 7, 0.05
# Packing of two order columns: the first within 4e18 either way (else Spark reports an
# overflow), the second any long; nulls before all.
INTEGERS = ("byte", "short", "integer", "long")
NULL_ORDER = -2 ** 62
ORDER_SHIFT = "cast('20000000000000000000' as decimal(20,0))"


def route_by_slot(predictions: DataFrame, lat_col: str = "Predicted_Latitude",
                  lng_col: str = "Predicted_Longitude", slot_col: str = "half_hour_interval",
                  order_cols: tuple[str, ...] = ("Time", "event_id")) -> DataFrame:
    """One location per slot: the latest prediction wins (``order_cols``), slot text added.

    One scan and one hash aggregate over the 48 valid slots, so a slot holding most rows is
    one row per task.  ``order_cols`` (one or two integer columns, nulls first; at least one
    must exist) are packed into one decimal that orders as they do.
    """
    present = [c for c in order_cols if c in predictions.columns]
    if not present:
        raise ValueError(f"no order column {order_cols}: the latest prediction is not defined")
    if len(present) > 2 or any(predictions.schema[c].dataType.typeName() not in INTEGERS for c in present):
        raise ValueError(f"order columns must be one or two integer columns: {present}")
    wide = [F.coalesce(F.col(c).cast("decimal(38,0)"), F.expr(f"cast('{NULL_ORDER}' as decimal(38,0))")) for c in present]
    last = reduce(lambda high, low: (high * F.expr(ORDER_SHIFT) + low).cast("decimal(38,0)"), wide)
    base = predictions.select(F.col(slot_col).alias("half_hour_interval"), F.col(lat_col).alias("lat"),
                              F.col(lng_col).alias("lng"), last.alias("last"))
    return (base.where(F.col("half_hour_interval").between(0, SLOTS_PER_DAY - 1))
            .groupBy("half_hour_interval").agg(F.max_by("lat", "last").alias("lat"), F.max_by("lng", "last").alias("lng"))
            .select("lat", "lng", "half_hour_interval", slot_text("half_hour_interval").alias("time"))
            .orderBy("half_hour_interval"))


def plausible(route: DataFrame, max_lat: float = MAX_PLAUSIBLE_LAT) -> DataFrame:
    """Positions south of ``max_lat``."""
    return route.where(F.col("lat") < max_lat)


def route_json(route: DataFrame) -> DataFrame:
    """JSON text per slot, keys in the order lat, lng, half_hour_interval, time."""
    return route.select("half_hour_interval",
                        F.to_json(F.struct("lat", "lng", "half_hour_interval", "time")).alias("location_json"))


def default_grid(spark: SparkSession, base_lat: float = DEFAULT_LAT, base_lng: float = DEFAULT_LNG,
                 step: float = DEFAULT_STEP) -> DataFrame:
    """The 48-slot sample route used when there are no predictions."""
    i = F.col("id")
    return spark.range(SLOTS_PER_DAY).select(
        (F.lit(base_lat) + i * F.lit(step)).alias("lat"),
        (F.lit(base_lng) + i * F.lit(step)).alias("lng"),
        i.cast("int").alias("half_hour_interval"),
        slot_text(i).alias("time"))


def route_or_default(route: DataFrame) -> DataFrame:
    """The rows of ``route`` in the 48 valid slots, or the default grid when there are none.

    The route (after ``route_by_slot`` 48 rows at most) is computed once and kept as a literal table.
    """
    spark = route.sparkSession
    rows = route.where(F.col("half_hour_interval").between(0, SLOTS_PER_DAY - 1)).limit(SLOTS_PER_DAY + 1).collect()
    if len(rows) > SLOTS_PER_DAY:
        raise ValueError("a route has one row per slot; call route_by_slot first")
    return spark.createDataFrame(rows, route.schema) if rows else default_grid(spark).select(*route.columns)


def lookup_slots(route: DataFrame, slots: DataFrame, slot_col: str = "half_hour_interval",
                 default_lat: float = DEFAULT_LAT, default_lng: float = DEFAULT_LNG) -> DataFrame:
    """Location of each requested slot; a miss gives the fallback position and time ``N/A``.

    Only the 48 valid slots of ``route`` are kept (one row each after ``route_by_slot``),
    so the broadcast side has a fixed bound whatever the input.
    """
    valid = route.where(F.col("half_hour_interval").between(0, SLOTS_PER_DAY - 1))
    found = F.broadcast(valid.select(F.col("half_hour_interval").alias(slot_col), "lat", "lng", "time"))
    return (slots.select(F.col(slot_col).cast("int").alias(slot_col)).join(found, slot_col, "left")
            .select(F.coalesce("lat", F.lit(default_lat)).alias("lat"),
                    F.coalesce("lng", F.lit(default_lng)).alias("lng"),
                    F.col(slot_col).alias("half_hour_interval"),
                    F.coalesce("time", F.lit(NO_TIME)).alias("time")))


def lookup_now(route: DataFrame) -> DataFrame:
    """Location of the current half-hour slot (UTC clock), with the usual fallback."""
    from strider.functions.timecols import half_hour_slot
    now_ms = F.unix_millis(F.current_timestamp())
    slot = route.sparkSession.range(1).select(half_hour_slot(now_ms).alias("half_hour_interval"))
    return lookup_slots(route, slot)


def today_text(spark: SparkSession) -> DataFrame:
    """One row: today's date as ``December 1st, 2026``."""
    from strider.functions.dates import ordinal_date_text
    return spark.range(1).select(ordinal_date_text(F.current_date()).alias("formatted_date"))


def nearby(origins: DataFrame, places: DataFrame, radius_m: float = NEARBY_RADIUS_M,
           k: int | None = NEARBY_TOP_K, origin_cols: tuple[str, str] = ("lat", "lng"),
           place_cols: tuple[str, str] = ("lat", "lng"), place_key: str = "poi_id") -> DataFrame:
    """Places within ``radius_m`` of each origin, nearest first, ``k`` per origin.

    A range join done as an equi-join on grid cells.  Rows of cells are ``radius`` tall; the
    cells of a row divide the whole circle and are as wide as two points can be apart there
    within the radius, so a row near a pole is one cell and cells meet at ±180°.  Each place is
    copied to the up to 3 x 3 cells around it (the origins, the side that grows, are not), and
    exact haversine distance filters the candidates.  Ties in distance (at centimetre
    precision) go to the smaller place key.

    With ``k``, of the places of one position only the first ``k`` by key can be wanted, and
    cells of many places are split (``_closest_cells``), so that the candidates of an origin
    follow ``k``, not the places around it.
    """
    dist = haversine_m(*[f"origin_{c}" for c in origin_cols], *place_cols)
    pairs = _candidates(origins, places, radius_m, k, origin_cols, place_cols, place_key)
    pairs = pairs.withColumn("distance_m", F.round(dist, 2)).where(F.col("distance_m") <= radius_m)
    if k is None:
        return pairs
    w = Window.partitionBy(*[f"origin_{c}" for c in origins.columns]).orderBy("distance_m", place_key)
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _candidates(origins: DataFrame, places: DataFrame, radius_m: float, k: int | None,
                origin_cols: tuple[str, str], place_cols: tuple[str, str], place_key: str) -> DataFrame:
    """Origins with the places of the cells that may hold one of the places asked for."""
    o_lat, o_lng = origin_cols
    p_lat, p_lng = place_cols
    reach = radius_m / EARTH_RADIUS_M * 1.0001           # angle, with room for rounding
    height = reach / DEG_TO_RAD
    fine = SPLIT ** DEEPEST

    def cells(row: Column) -> Column:
        """Number of cells of a row."""
        edge = F.greatest(F.abs(row), F.abs(row + 1)) * F.lit(reach)
        wide = F.asin(F.least(F.lit(math.sin(min(reach, math.pi / 2))) / F.cos(edge), F.lit(1.0)))
        near_pole = edge + F.lit(reach) >= F.lit(math.pi / 2)
        return F.when(near_pole, F.lit(1)).otherwise(F.greatest(F.floor(F.lit(2 * math.pi) / wide), F.lit(1))).cast("long")

    def cell(lng: Column, count: Column) -> Column:
        return F.least(F.floor(F.pmod(lng + 180.0, F.lit(360.0)) / 360.0 * count), count - 1).cast("long")

    o = origins.select(*[F.col(c).alias(f"origin_{c}") for c in origins.columns])
    o = o.withColumn("_cy", F.floor(F.col(f"origin_{o_lat}") / height).cast("long"))
    o = o.withColumn("_cx", cell(F.col(f"origin_{o_lng}"), cells(F.col("_cy"))))
    row = F.floor(F.col(p_lat) / height).cast("long")
    if k is not None:
        places = _first_of_position(places, k, p_lat, p_lng, place_key)
    p = places.select("*", F.explode(F.array(row - 1, row, row + 1)).alias("_cy"))
    p = p.withColumn("_n", cells(F.col("_cy")))
    p = p.withColumn("_x", cell(F.col(p_lng), F.col("_n")))
    p = p.withColumn("_cx", F.explode(F.array_distinct(F.array(
        *[F.pmod(F.col("_x") + d, F.col("_n")) for d in (-1, 0, 1)]))))
    on = ["_cy", "_cx"]
    if k is not None:
        p = p.withColumns({"_fy": F.floor(F.col(p_lat) / height * fine).cast("long"),
                           "_fx": cell(F.col(p_lng), F.col("_n") * fine)})
        depth = _grid_depth(p.where((F.col("_cy") == row) & (F.col("_cx") == F.col("_x"))), max(LEAF_PLACES, k))
        if depth:
            o = _closest_cells(o, p, depth, radius_m, k, [f"origin_{c}" for c in origins.columns],
                               (f"origin_{o_lat}", f"origin_{o_lng}"), place_cols)
            p, on = p.withColumns(_at_level(depth)), [*on, "_ly", "_lx"]
        p = p.drop("_fy", "_fx")
    return o.join(p.drop("_n", "_x"), on, "inner").drop(*on)


def _first_of_position(places: DataFrame, k: int, p_lat: str, p_lng: str, place_key: str) -> DataFrame:
    """The first ``k`` places by key of every position: from any origin the others come after them."""
    known = reduce(lambda a, b: a & b, [F.abs(F.col(c)) < F.lit(float("inf")) for c in (p_lat, p_lng)])
    first = F.row_number().over(Window.partitionBy(p_lat, p_lng).orderBy(place_key))
    return places.where(known).withColumn("_nth", first).where(F.col("_nth") <= k).drop("_nth")


def _at_level(level: int, y: str = "_ly", x: str = "_lx") -> dict[str, Column]:
    """Cell of a level of the split grid: the leading digits of the finest cell, so levels nest."""
    size = F.lit(SPLIT ** (DEEPEST - level))
    return {y: F.floor(F.col("_fy") / size).cast("long"), x: F.floor(F.col("_fx") / size).cast("long")}


def _grid_depth(own: DataFrame, leaf: int) -> int:
    """The first level without a cell of more than ``leaf`` of the places ``own`` (else the deepest): one job."""
    levels = F.array(*[F.struct(F.lit(i).alias("level"), *[c.alias(n) for n, c in _at_level(i).items()])
                       for i in range(DEEPEST + 1)])
    counted = own.select("_cy", "_cx", F.inline(levels)).groupBy("_cy", "_cx", "level", "_ly", "_lx").count()
    full = counted.where(F.col("count") > leaf).agg(F.max("level").alias("level")).first().level
    return 0 if full is None else min(full + 1, DEEPEST)


def _closest_cells(o: DataFrame, p: DataFrame, depth: int, radius_m: float, k: int, keys: list[str],
                   origin_cols: tuple[str, str], place_cols: tuple[str, str]) -> DataFrame:
    """Origins with the cells of level ``depth`` (``_ly``, ``_lx``) that may hold one of their ``k`` nearest places.

    Level by level the cells at hand are split, and those farther than the radius or than the k-th
    place at worst are left out.  A cell knows its number of places and a circle around them: all
    are within the distance to its centre less and plus its radius.
    """
    lat, lng = (F.col(c) for c in place_cols)
    mid_lat, mid_lng = (F.min(lat) + F.max(lat)) / 2, (F.min(lng) + F.max(lng)) / 2
    arc = (F.max(lat) - F.min(lat) + F.abs(F.cos(mid_lat * DEG_TO_RAD)) * (F.max(lng) - F.min(lng))) / 2
    on = ["_cy", "_cx"]
    for level in range(1, depth + 1):
        parent = [] if level == 1 else ["_py", "_px"]
        at = _at_level(level) | (_at_level(level - 1, *parent) if parent else {})
        nodes = p.withColumns(at).groupBy("_cy", "_cx", *parent, "_ly", "_lx").agg(
            F.count(F.lit(1)).alias("_places"), mid_lat.alias("_mid_lat"), mid_lng.alias("_mid_lng"),
            (arc * F.lit(DEG_TO_RAD * EARTH_RADIUS_M)).alias("_around"))
        if parent:
            o = o.withColumnsRenamed({"_ly": "_py", "_lx": "_px"})
        o = o.join(nodes, [*on, *parent], "inner")
        o = o.withColumn("_off", haversine_m(*origin_cols, "_mid_lat", "_mid_lng"))
        o = o.where(F.col("_off") - F.col("_around") <= F.lit(radius_m + SLACK_M))
        worst = F.col("_off") + F.col("_around")
        within = F.sum("_places").over(Window.partitionBy(*keys).orderBy(worst))
        o = o.withColumn("_within", within)
        kth = F.min(F.when(F.col("_within") >= k, worst)).over(Window.partitionBy(*keys))
        o = o.withColumn("_kth", kth)
        o = o.where(F.col("_kth").isNull() | (F.col("_off") - F.col("_around") <= F.col("_kth") + F.lit(SLACK_M)))
        o = o.select(*keys, *on, "_ly", "_lx")
    return o


# Optional inputs beside the positions, and what they are divided by (None: z-scored).
EXTRA_INPUTS = {"Altitude": None, "half_hour_interval": 47.0, "day_of_week": 7.0}


def next_location(locations: DataFrame, n: int = 10, fraction: float = 0.8,
                  partition_cols: tuple[str, ...] = ("user_id",),
                  order_cols: tuple[str, ...] = ("Time", "event_id"),
                  model: str = "linear", block_rows: int | None = 1 << 20,
                  inputs: tuple[str, ...] = (), epochs: int | None = None) -> DataFrame:
    """Predict the next (Latitude, Longitude) from the ``n`` previous positions.

    Positions are z-scored (mean and population std over all rows), each row gets its
    ``n`` predecessors per key as features, the first ``fraction`` of sequences in time
    order train the model (squared loss), and the remaining ones are predicted, unscaled and
    tagged with the half-hour slot of the predicted row.  ``model``:

    * ``linear``: least squares per coordinate by normal equations, one distributed pass, with a
      small ridge term (positions that move together make the plain equations singular);
    * ``gbt``: gradient-boosted trees per coordinate;
    * ``recurrent``: 50 long short-term memory cells, ``epochs`` passes of data-parallel descent;
    * ``stay``: the previous position, the bar the others must clear.

    ``inputs`` adds earlier values of ``Altitude`` (a column), ``half_hour_interval`` or
    ``day_of_week`` (from the first order column) to every step of the history.
    Rows without a position, or without an altitude where it is an input, are left out.
    """
    from strider.functions.timecols import half_hour_slot, iso_weekday
    from strider.operators.features import chronological_split, lag_sequences, unscale, zscores
    from strider.session import materialize

    if model not in ("linear", "gbt", "recurrent", "stay"):
        raise ValueError(f"unknown model {model!r}")
    if unknown := set(inputs) - set(EXTRA_INPUTS):
        raise ValueError(f"unknown inputs {sorted(unknown)}; known: {sorted(EXTRA_INPUTS)}")
    keys = list(dict.fromkeys([*partition_cols, *order_cols]))
    scaled = ["Latitude", "Longitude", *[c for c in inputs if EXTRA_INPUTS[c] is None]]
    z, fit = zscores(locations, scaled, keep=keys)
    clock = {"half_hour_interval": half_hour_slot(order_cols[0]), "day_of_week": iso_weekday(order_cols[0])}
    z = z.withColumns({f"{c}_z": clock[c] / F.lit(EXTRA_INPUTS[c]) for c in inputs if c in clock})
    values = ["Latitude_z", "Longitude_z", *[f"{c}_z" for c in inputs]]
    seqs = lag_sequences(z, values, n, partition_cols, order_cols, block_rows=block_rows)
    seqs = chronological_split(materialize(seqs), fraction, order_cols)
    lag_cols = [f"{v}_lag{j}" for j in range(n, 0, -1) for v in values]
    predict = {"recurrent": _recurrent, "stay": _stay}.get(model, _regressed)
    out = predict(seqs, lag_cols, keys, model, n, epochs)
    return out.select(
        *keys,
        unscale(F.col("_lat_z"), fit, "Latitude").alias("Predicted_Latitude"),
        unscale(F.col("_lng_z"), fit, "Longitude").alias("Predicted_Longitude"),
        unscale(F.col("Latitude_z"), fit, "Latitude").alias("Latitude"),
        unscale(F.col("Longitude_z"), fit, "Longitude").alias("Longitude"),
        half_hour_slot(order_cols[0]).alias("half_hour_interval"))


def _stay(seqs: DataFrame, lag_cols: list[str], keys: list[str], model: str, n: int, epochs: int | None) -> DataFrame:
    """Test rows with the previous position as the prediction."""
    return seqs.where(F.col("split") == "test").withColumns(
        {"_lat_z": F.col("Latitude_z_lag1"), "_lng_z": F.col("Longitude_z_lag1")})


def _recurrent(seqs: DataFrame, lag_cols: list[str], keys: list[str], model: str, n: int, epochs: int | None) -> DataFrame:
    """Test rows with the predictions of a recurrent model fitted to the training rows."""
    from strider.operators import recurrent
    shape = recurrent.Shape(n, len(lag_cols) // n, recurrent.UNITS, 2)
    rows = seqs.select(*keys, "split", "Latitude_z", "Longitude_z", F.array(*lag_cols).alias("seq"))
    train = rows.where(F.col("split") == "train").select(*keys, "seq", F.array("Latitude_z", "Longitude_z").alias("target"))
    flat = recurrent.fit(train, shape, keys, recurrent.EPOCHS if epochs is None else epochs)
    return recurrent.apply(rows.where(F.col("split") == "test"), shape, flat, ["_lat_z", "_lng_z"])


def _regressed(seqs: DataFrame, lag_cols: list[str], keys: list[str], model: str, n: int, epochs: int | None) -> DataFrame:
    """Test rows with the predictions of one regressor per coordinate."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, LinearRegression

    data = VectorAssembler(inputCols=lag_cols, outputCol="features").transform(seqs)
    train = data.where(F.col("split") == "train")

    def fit_one(target_pred: tuple[str, str]):
        target, pred = target_pred
        if model == "gbt":
            est = GBTRegressor(featuresCol="features", labelCol=target, predictionCol=pred, seed=42)
        else:
            est = LinearRegression(featuresCol="features", labelCol=target, predictionCol=pred,
                                   solver="normal", regParam=RIDGE)
        return est.fit(train)
    with ThreadPoolExecutor(max_workers=2) as pool:       # the two coordinates fit side by side
        models = list(pool.map(fit_one, (("Latitude_z", "_lat_z"), ("Longitude_z", "_lng_z"))))
    out = data.where(F.col("split") == "test")
    for fitted in models:
        out = fitted.transform(out)
    return out


def prediction_error(predicted: DataFrame) -> DataFrame:
    """One row: rows, and the mean squared distance (m²) between predicted and true positions."""
    off = haversine_m("Predicted_Latitude", "Predicted_Longitude", "Latitude", "Longitude")
    return predicted.agg(F.count(F.lit(1)).alias("rows"), F.avg(off * off).alias("mean_squared_m"))


def whole_route_json(route: DataFrame) -> DataFrame:
    """One row: the whole route as one JSON array, by slot; an empty route is ``[]``.

    The route holds at most 48 slots, so one row is its natural size.
    """
    entry = F.struct("lat", "lng", "half_hour_interval", "time")
    valid = route.where(F.col("half_hour_interval").between(0, SLOTS_PER_DAY - 1))
    ordered = F.sort_array(F.collect_list(F.struct("half_hour_interval", entry.alias("entry"))))
    return valid.agg(F.to_json(F.transform(ordered, lambda x: x["entry"])).alias("locations_json"))
