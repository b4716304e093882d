"""Registered queries: each binds operators to the driver tables of one folder.

Every callable takes ``(spark, base_dir)`` and returns a DataFrame over the whole tables.
Models, quantiles, scaling and ordered sequences run jobs when called; the rest is lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strider.functions.dates import parse_day
from strider.operators import clean, stats
from strider.sources.bindings import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries.
RANGE_START_MS = 1704866400000          # 2024-01-10 06:00:00 UTC
SELECTED_DAY = "150124"                 # 15 Jan 2024, folder form
EXPECTED_LABELS = 9
EXPECTED_DAYS = 91
TOP_ROWS = 5
SEQUENCE_LENGTH = 10
TRAIN_FRACTION = 0.8
HISTOGRAM_BINS = 50
CONTAMINATION = 0.05
LOOKUP_SLOTS = (0, 17, 99)
CHOSEN_DEPTH = 5                        # depth whose metrics are looked up in the sweep


def register(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return wrap


# --- activity statistics -------------------------------------------------------------

@register("dataset_activity_stats")
def q_dataset_activity_stats(spark, base):
    return stats.dataset_activity_stats(Tables(spark, base).labels)


@register("daily_activity_stats")
def q_daily_activity_stats(spark, base):
    return stats.daily_activity_stats(Tables(spark, base).labels)


@register("range_activity_stats")
def q_range_activity_stats(spark, base):
    return stats.range_activity_stats(Tables(spark, base).labels, RANGE_START_MS)


@register("dataset_total_time")
def q_dataset_total_time(spark, base):
    return stats.total_time(Tables(spark, base).labels)


@register("daily_stats_for_date")
def q_daily_stats_for_date(spark, base):
    daily = stats.daily_activity_stats(Tables(spark, base).labels, detailed=True)
    return stats.stats_for_date(daily, SELECTED_DAY,
                                exclude=("CoarseLabel", "Count", "TotalInstances", "TotalTimeMs"))


@register("distinct_dates")
def q_distinct_dates(spark, base):
    return stats.distinct_dates(Tables(spark, base).labels)


@register("expectation_checks")
def q_expectation_checks(spark, base):
    t = Tables(spark, base)
    return clean.expectation_checks([
        ("transportation_types", t.labels, "CoarseLabel", EXPECTED_LABELS),
        ("dates", t.motion, "date", EXPECTED_DAYS),
    ])


# --- cleaning ---------------------------------------------------------------------------

@register("clean_motion")
def q_clean_motion(spark, base):
    return clean.clean_motion(Tables(spark, base).motion)


@register("standardize_dates")
def q_standardize_dates(spark, base):
    labels = Tables(spark, base).labels
    d = F.col("date")
    variant = F.pmod(F.col("event_id"), F.lit(4))
    # Four spellings derived from each row's day: raw, dashed, already standard, 7 digits.
    raw = (F.when(variant == 0, d)
           .when(variant == 1, F.concat_ws("-", F.substring(d, 1, 2), F.substring(d, 3, 2), F.substring(d, 5, 2)))
           .when(variant == 2, F.date_format(parse_day(d), "MM/dd/yyyy"))
           .otherwise(F.concat(d, F.lit("7"))))
    inputs = labels.select("event_id", raw.alias("date_in"), raw.alias("date"))
    return clean.standardize_dates(inputs)


# --- sources -----------------------------------------------------------------------------

@register("parse_sensor_lines")
def q_parse_sensor_lines(spark, base):
    from strider.sources.sensor_files import parse_sensor_lines
    return parse_sensor_lines(Tables(spark, base).lines, "Location")


@register("top_rows")
def q_top_rows(spark, base):
    return Tables(spark, base).location.orderBy("Time", "event_id").limit(TOP_ROWS)


# --- features -----------------------------------------------------------------------------

@register("label_motion_join")
def q_label_motion_join(spark, base):
    from strider.operators.features import label_motion_join
    t = Tables(spark, base)
    return label_motion_join(t.labels, clean.clean_motion(t.motion))


@register("motion_magnitudes")
def q_motion_magnitudes(spark, base):
    from strider.operators.features import MAGNITUDES, label_motion_join, with_magnitudes
    t = Tables(spark, base)
    joined = with_magnitudes(label_motion_join(t.labels, clean.clean_motion(t.motion)))
    return joined.select("date", "Time", "event_id", "motion_event_id", "CoarseLabel", *MAGNITUDES)


@register("half_hour_features")
def q_half_hour_features(spark, base):
    from strider.operators.features import half_hour_features
    loc = Tables(spark, base).location.select("event_id", "Time")
    return half_hour_features(loc)


@register("ordinal_date")
def q_ordinal_date(spark, base):
    from strider.functions.dates import ordinal_date_text
    days = stats.distinct_dates(Tables(spark, base).labels)
    return days.select("date", ordinal_date_text(parse_day("date")).alias("formatted_date"))


@register("scaled_features")
def q_scaled_features(spark, base):
    from strider.operators.features import scale_features
    from strider.schemas import ANOMALY_FEATURES
    motion = clean.clean_motion(Tables(spark, base).motion)
    scaled = scale_features(motion, ANOMALY_FEATURES, keep=("event_id",))
    return scaled.select("event_id", *[F.round(c, 6).alias(c) for c in ANOMALY_FEATURES])


@register("location_zscores")
def q_location_zscores(spark, base):
    from strider.operators.features import zscores
    z, _ = zscores(Tables(spark, base).location, keep=("event_id",))
    return z.select("event_id", *[F.round(c, 6).alias(c) for c in ("Latitude_z", "Longitude_z")])


@register("location_sequences")
def q_location_sequences(spark, base):
    from strider.operators.features import lag_sequences
    loc = Tables(spark, base).location.select("user_id", "event_id", "Time", "Latitude", "Longitude")
    return lag_sequences(loc, ["Latitude", "Longitude"], n=SEQUENCE_LENGTH)


@register("chronological_split")
def q_chronological_split(spark, base):
    from strider.operators.features import chronological_split
    loc = Tables(spark, base).location.select("event_id", "Time")
    return chronological_split(loc, TRAIN_FRACTION).select("event_id", "split")


# --- distributions ------------------------------------------------------------------------

@register("histogram_50")
def q_histogram_50(spark, base):
    from strider.operators.quantiles import histogram
    h = histogram(Tables(spark, base).raw("events"), "value", HISTOGRAM_BINS)
    return h.select("bin", F.round("bin_start", 6).alias("bin_start"),
                    F.round("bin_end", 6).alias("bin_end"), "count")


@register("contamination_cut")
def q_contamination_cut(spark, base):
    from strider.operators.quantiles import exact_quantile
    events = Tables(spark, base).raw("events")
    threshold = exact_quantile(events, "value", CONTAMINATION)
    return events.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("value") < F.lit(threshold), 1)).alias("n_below"),
    ).select(F.round(F.lit(threshold), 6).alias("threshold"), "n_rows", "n_below")


# --- location ------------------------------------------------------------------------------

def _route_input(t: Tables) -> DataFrame:
    """Stand-in for the predictions table: every position with its clock slot."""
    from strider.functions.timecols import half_hour_slot
    return t.location.select(
        "event_id", "Time", "date",
        F.col("Latitude").alias("Predicted_Latitude"),
        F.col("Longitude").alias("Predicted_Longitude"),
        half_hour_slot("Time").alias("half_hour_interval"))


@register("predicted_route")
def q_predicted_route(spark, base):
    from strider.operators.location import plausible, route_by_slot
    return plausible(route_by_slot(_route_input(Tables(spark, base))))


@register("route_json")
def q_route_json(spark, base):
    from strider.operators.location import route_by_slot, route_json
    return route_json(route_by_slot(_route_input(Tables(spark, base))))


@register("next_location_lookup")
def q_next_location_lookup(spark, base):
    from strider.operators.location import lookup_slots, route_by_slot
    route = route_by_slot(_route_input(Tables(spark, base)))
    slots = spark.range(1).select(
        F.explode(F.array(*[F.lit(s).cast("int") for s in LOOKUP_SLOTS])).alias("half_hour_interval"))
    return lookup_slots(route, slots)


@register("train_test_split")
def q_train_test_split(spark, base):
    from strider.operators.activity import SPLIT_SEED, hash_split
    rows = Tables(spark, base).labels.select("event_id", "date", "Time")
    train, test = hash_split(rows, ("date", "Time"), TRAIN_FRACTION, SPLIT_SEED)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@register("bootstrap_weights")
def q_bootstrap_weights(spark, base):
    from strider.operators.activity import NUM_TREES, poisson_weight
    rows = Tables(spark, base).labels
    return rows.select("event_id", *[poisson_weight(("date", "Time"), i).alias(f"w{i}") for i in range(NUM_TREES)])


def _flagged_motion(spark, base):
    """Cleaned motion rows with a computed stand-in for the forest's prediction."""
    rows = clean.clean_motion(Tables(spark, base).motion)
    return rows.withColumn("prediction", F.when(F.col("event_id") % 20 == 3, -1).otherwise(1))


@register("anomalies_only")
def q_anomalies_only(spark, base):
    from strider.operators.anomaly import anomalies
    return anomalies(_flagged_motion(spark, base)).select("event_id", "date", "Time", "Pressure", "prediction")


@register("feature_summary")
def q_feature_summary(spark, base):
    from strider.operators.anomaly import anomaly_by_feature
    return anomaly_by_feature(_flagged_motion(spark, base)).withColumn("mean", F.round("mean", 6))


@register("feature_series")
def q_feature_series(spark, base):
    from strider.operators.anomaly import feature_series
    return feature_series(_flagged_motion(spark, base))


@register("half_hour_grid")
def q_half_hour_grid(spark, base):
    from strider.operators.location import route_by_slot, route_or_default
    return route_or_default(route_by_slot(_route_input(Tables(spark, base))))


@register("whole_route_json")
def q_whole_route_json(spark, base):
    from strider.operators.location import route_by_slot, whole_route_json
    return whole_route_json(route_by_slot(_route_input(Tables(spark, base))))


@register("nearby_top_k")
def q_nearby_top_k(spark, base):
    from strider.operators.location import NEARBY_RADIUS_M, NEARBY_TOP_K, nearby
    t = Tables(spark, base)
    origins = t.location.select(F.col("Latitude").alias("lat"), F.col("Longitude").alias("lng")).distinct()
    near = nearby(origins, t.pois, NEARBY_RADIUS_M, NEARBY_TOP_K)
    return near.select("origin_lat", "origin_lng", "rank", "poi_id", "name", "distance_m")


# --- activity recognition ------------------------------------------------------------------

@register("classification_metrics")
def q_classification_metrics(spark, base):
    from strider.operators.activity import classification_metrics
    labels = Tables(spark, base).labels
    pred = F.pmod(F.col("CoarseLabel") + (F.pmod(F.col("event_id"), F.lit(4)) == 0).cast("int"), F.lit(9))
    m = classification_metrics(labels.withColumn("prediction", pred), "CoarseLabel", "prediction")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@register("vote_fold")
def q_vote_fold(spark, base):
    from strider.functions.vectors import array_sum, majority_vote
    events = Tables(spark, base).raw("events")
    c = F.col("user_id") % 9
    k = F.get_json_object("props", "$.k").cast("int")
    e = F.col("event_id")
    votes = F.array(*[x.cast("double") for x in (c, k % 9, e % 9, c, e % 3)])
    return events.select("event_id", votes.alias("votes")).select(
        "event_id", majority_vote("votes").alias("final_prediction"),
        array_sum("votes").alias("prediction_sum"))


def _joined_magnitudes(t: Tables) -> DataFrame:
    from strider.operators.features import label_motion_join, with_magnitudes
    return with_magnitudes(label_motion_join(t.labels, clean.clean_motion(t.motion)))


@register("tree_metrics")
def q_tree_metrics(spark, base):
    from strider.operators.activity import REPORT_DEPTH, tree_reports
    from strider.schemas import MAGNITUDE_FEATURES
    return tree_reports(_joined_magnitudes(Tables(spark, base)), MAGNITUDE_FEATURES,
                        depths=(REPORT_DEPTH,), key_cols=("event_id", "motion_event_id"),
                        with_tree=True)


@register("tree_depth_sweep")
def q_tree_depth_sweep(spark, base):
    from strider.operators.activity import SWEEP_DEPTHS, tree_reports
    from strider.schemas import MAGNITUDE_FEATURES
    return tree_reports(_joined_magnitudes(Tables(spark, base)), MAGNITUDE_FEATURES,
                        depths=SWEEP_DEPTHS, key_cols=("event_id", "motion_event_id"))


def _histogram_tree(spark, base):
    """One tree of the deepest depth on the hash split: every registered depth is read off it."""
    from strider.operators.activity import SWEEP_DEPTHS
    from strider.operators.histogram_tree import fitted
    from strider.schemas import MAGNITUDE_FEATURES
    return fitted(_joined_magnitudes(Tables(spark, base)), MAGNITUDE_FEATURES, max_depth=max(SWEEP_DEPTHS),
                  key_cols=("event_id", "motion_event_id"))


@register("histogram_tree_nodes")
def q_histogram_tree_nodes(spark, base):
    from strider.operators.histogram_tree import NODES
    found = _histogram_tree(spark, base)
    nodes = found[0].nodes(spark) if found else spark.createDataFrame([], NODES)
    return nodes.withColumn("threshold", F.round("threshold", 6))


@register("histogram_tree_sweep")
def q_histogram_tree_sweep(spark, base):
    from strider.operators.histogram_tree import METRICS, depth_sweep
    found = _histogram_tree(spark, base)
    sweep = depth_sweep(*found) if found else spark.createDataFrame([], METRICS)
    return sweep.select("Depth", *[F.round(c, 6).alias(c) for c in ("Accuracy", "Precision", "Recall")])


@register("metrics_for_depth")
def q_metrics_for_depth(spark, base):
    from strider.operators.activity import metrics_for_depth
    return metrics_for_depth(q_histogram_tree_sweep(spark, base), CHOSEN_DEPTH)


@register("bagged_trees")
def q_bagged_trees(spark, base):
    from strider.operators.activity import bagged_trees
    from strider.operators.features import label_motion_join
    from strider.schemas import AXIS_FEATURES
    t = Tables(spark, base)
    joined = label_motion_join(t.labels, clean.clean_motion(t.motion))
    return bagged_trees(joined, AXIS_FEATURES, key_cols=("event_id", "motion_event_id"),
                        keep=("date", "Time", "event_id"))


# --- anomaly detection -----------------------------------------------------------------------

def _scored_motion(spark, base) -> DataFrame:
    from strider.operators.anomaly import isolation_forest
    from strider.schemas import ANOMALY_FEATURES
    motion = clean.clean_motion(Tables(spark, base).motion)
    return isolation_forest(motion, ANOMALY_FEATURES, key_cols=("event_id",),
                            keep=("event_id", "date", "Time", *ANOMALY_FEATURES))


@register("forest_sample")
def q_forest_sample(spark, base):
    from strider.operators.anomaly import forest_sample
    return forest_sample(clean.clean_motion(Tables(spark, base).motion))


@register("isolation_forest")
def q_isolation_forest(spark, base):
    return _scored_motion(spark, base).select("event_id", "date", "Time", "score", "prediction")


@register("anomaly_by_feature")
def q_anomaly_by_feature(spark, base):
    from strider.operators.anomaly import anomaly_by_feature
    return anomaly_by_feature(_scored_motion(spark, base))


@register("kmeans_outliers")
def q_kmeans_outliers(spark, base):
    from strider.operators.anomaly import kmeans_outliers
    return kmeans_outliers(clean.clean_motion(Tables(spark, base).motion))


# --- location prediction ---------------------------------------------------------------------

def _positions(spark, base) -> DataFrame:
    return Tables(spark, base).location.select("user_id", "event_id", "Time", "Latitude", "Longitude", "Altitude")


@register("next_location")
def q_next_location(spark, base):
    from strider.operators.location import next_location
    return next_location(_positions(spark, base), SEQUENCE_LENGTH, TRAIN_FRACTION)


@register("next_location_recurrent")
def q_next_location_recurrent(spark, base):
    from strider.operators.location import next_location
    return next_location(_positions(spark, base), SEQUENCE_LENGTH, TRAIN_FRACTION, model="recurrent")


def _predicted_route(spark, base, model: str) -> DataFrame:
    """Predictions → latest per slot → plausible ones."""
    from strider.operators.location import next_location, plausible, route_by_slot
    return plausible(route_by_slot(next_location(_positions(spark, base), SEQUENCE_LENGTH, TRAIN_FRACTION, model=model)))


@register("predictions_to_route")
def q_predictions_to_route(spark, base):
    from strider.operators.location import route_or_default
    return route_or_default(_predicted_route(spark, base, "linear"))


@register("predictions_to_next_stop")
def q_predictions_to_next_stop(spark, base):
    from strider.operators.location import lookup_slots
    slots = spark.range(1).select(
        F.explode(F.array(*[F.lit(s).cast("int") for s in LOOKUP_SLOTS])).alias("half_hour_interval"))
    stops = lookup_slots(_predicted_route(spark, base, "stay"), slots)
    return stops.select(F.round("lat", 9).alias("lat"), F.round("lng", 9).alias("lng"), "half_hour_interval", "time")
