import math
import random

from strider.functions.geo import EARTH_RADIUS_M
from strider.operators.location import (default_grid, lookup_slots, nearby, route_by_slot,
                                        route_json, route_or_default)


def _hav(lat1, lng1, lat2, lng2):
    r = math.pi / 180
    a = math.sin((lat2 - lat1) * r / 2) ** 2 + math.cos(lat1 * r) * math.cos(lat2 * r) * math.sin((lng2 - lng1) * r / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(a))


def test_nearby_matches_brute_force(spark):
    rnd = random.Random(11)
    places = [(i, f"p{i}", 50.8 + rnd.random() * 0.1, -0.2 + rnd.random() * 0.15) for i in range(300)]
    origins = [(50.8 + rnd.random() * 0.1, -0.2 + rnd.random() * 0.15) for _ in range(40)]
    p = spark.createDataFrame(places, "poi_id long, name string, lat double, lng double")
    o = spark.createDataFrame(origins, "lat double, lng double")
    got = {}
    for r in nearby(o, p, 1500.0, 10).collect():
        got.setdefault((r.origin_lat, r.origin_lng), []).append((r.rank, r.poi_id))
    for lat, lng in origins:
        cands = sorted((round(_hav(lat, lng, pl[2], pl[3]), 2), pl[0]) for pl in places)
        want = [(i + 1, pid) for i, (d, pid) in enumerate([c for c in cands if c[0] <= 1500][:10])]
        assert sorted(got.get((lat, lng), [])) == want


def test_route_latest_wins_and_fallbacks(spark):
    preds = spark.createDataFrame(
        [(1.0, 1.0, 3, 10, 1), (2.0, 2.0, 3, 20, 2), (5.0, 5.0, 0, 5, 3)],
        "Predicted_Latitude double, Predicted_Longitude double, half_hour_interval int, Time long, event_id long")
    route = route_by_slot(preds)
    assert [(r.half_hour_interval, r.lat, r.time) for r in route.collect()] == [(0, 5.0, "12:00 AM"), (3, 2.0, "1:30 AM")]
    slots = spark.createDataFrame([(3,), (99,)], "half_hour_interval int")
    got = sorted(tuple(r) for r in lookup_slots(route, slots).collect())
    assert got == [(2.0, 2.0, 3, "1:30 AM"), (50.8231, -0.1383, 99, "N/A")]
    assert route_or_default(route).count() == 2
    empty = route.where("lat > 100")
    grid = route_or_default(empty).collect()
    assert len(grid) == 48 and grid[0].time == "12:00 AM"
    assert abs(grid[47].lat - (50.8231 + 47 * 0.01)) < 1e-12
    assert default_grid(spark).count() == 48
    assert route_json(route).first().location_json == '{"lat":5.0,"lng":5.0,"half_hour_interval":0,"time":"12:00 AM"}'


def test_next_location_invariants(spark):
    from pyspark.sql import functions as F

    from strider.operators.location import next_location
    rnd = random.Random(4)
    rows, e = [], 0
    for user in range(6):
        lat, lng = 50.8 + user / 100, -0.1
        for step in range(120):                          # steady drift plus noise per user
            lat += 0.001 + rnd.gauss(0, 0.0001)
            lng += 0.0005 + rnd.gauss(0, 0.0001)
            rows.append((user, e, 1_700_000_000_000 + step * 60_000, lat, lng))
            e += 1
    df = spark.createDataFrame(rows, "user_id long, event_id long, Time long, Latitude double, Longitude double")
    out = next_location(df, n=10, fraction=0.8)
    n_seq = 6 * (120 - 10)
    assert out.count() == n_seq - int(0.8 * n_seq)
    pdf = out.toPandas()
    assert pdf.half_hour_interval.between(0, 47).all()
    model_err = ((pdf.Predicted_Latitude - pdf.Latitude) ** 2).mean()
    # "stay at the previous point" errs by the drift (0.001 per step) squared
    assert model_err < 0.5 * (0.001 ** 2)
    assert out.where(F.col("Predicted_Latitude").isNull()).count() == 0


def test_now_lookup_and_today_text(spark):
    import datetime as dt

    from strider.operators.location import lookup_now, today_text
    preds = spark.createDataFrame([(1.0, 2.0, s, 1, s) for s in range(48)],
                                  "Predicted_Latitude double, Predicted_Longitude double, half_hour_interval int, Time long, event_id long")
    row = lookup_now(route_by_slot(preds)).first()
    now = dt.datetime.now(dt.timezone.utc)
    assert row.lat == 1.0 and row.time != "N/A"
    assert abs(row.half_hour_interval - (now.hour * 2 + now.minute // 30)) <= 1
    assert today_text(spark).first().formatted_date.endswith(str(dt.date.today().year))


def test_nearby_dense_cluster_and_ties(spark):
    rnd = random.Random(13)
    places = [(i, f"p{i}", 50.85, -0.15) for i in range(60)]                    # 60 places on one spot
    places += [(100 + i, f"q{i}", 50.85 + rnd.gauss(0, 0.003), -0.15 + rnd.gauss(0, 0.003)) for i in range(400)]
    origins = [(50.85 + rnd.gauss(0, 0.004), -0.15 + rnd.gauss(0, 0.004)) for _ in range(30)] + [(50.85, -0.15)]
    p = spark.createDataFrame(places, "poi_id long, name string, lat double, lng double")
    o = spark.createDataFrame(origins, "lat double, lng double")
    got = {}
    for r in nearby(o, p, 1500.0, 10).collect():
        got.setdefault((r.origin_lat, r.origin_lng), []).append((r.rank, r.poi_id, r.distance_m))
    for lat, lng in origins:
        cands = sorted((round(_hav(lat, lng, pl[2], pl[3]), 2), pl[0]) for pl in places)
        want = [(i + 1, pid, d) for i, (d, pid) in enumerate([c for c in cands if c[0] <= 1500][:10])]
        assert sorted(got[(lat, lng)]) == want


def test_nearby_meets_at_the_date_line_and_the_poles(spark):
    import math
    import random

    from strider.operators.location import nearby
    rng = random.Random(12)
    points = [(0.0, 179.999), (0.0, -179.999), (89.9, 10.0), (89.9, 14.0), (90.0, 0.0), (-90.0, 50.0), (-89.999, -120.0)]
    for lat0, lng0 in ((0.0, 180.0), (89.99, 0.0), (-89.99, 90.0), (60.0, -180.0), (50.0, 0.0)):
        points += [(max(-90.0, min(90.0, lat0 + rng.uniform(-.02, .02))), (lng0 + rng.uniform(-.05, .05) + 540) % 360 - 180)
                   for _ in range(40)]
    o = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id long, lat double, lng double")
    p = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "poi_id long, lat double, lng double")
    got = {(r.origin_id, r.poi_id) for r in nearby(o, p, 1500.0, None).collect()}

    def metres(a, b):
        x, y = (tuple(math.cos(math.radians(t)) * f(math.radians(g)) for f in (math.cos, math.sin)) + (math.sin(math.radians(t)),)
                for t, g in (a, b))
        return 2 * 6371000 * math.asin(min(1.0, math.dist(x, y) / 2))
    want = {(i, j) for i, a in enumerate(points) for j, b in enumerate(points) if metres(a, b) <= 1499.9}
    edge = {(i, j) for i, a in enumerate(points) for j, b in enumerate(points) if metres(a, b) <= 1500.1}
    assert want <= got <= edge and (0, 1) in got and (2, 3) in got


def test_route_or_grid_through_the_registered_query(spark, tmp_path):
    from strider.plans.queries import QUERIES
    base = "/root/testdata/sf0.001"
    route = QUERIES["half_hour_grid"](spark, base)
    assert 0 < route.count() <= 48 and route.where("lat < 50.79").count() == 0
    spark.read.parquet(f"{base}/events.parquet").limit(0).write.parquet(str(tmp_path / "events.parquet"))
    grid = QUERIES["half_hour_grid"](spark, str(tmp_path))
    assert grid.count() == 48 and grid.where("half_hour_interval = 0").first().lat == 50.8231


def test_route_orders_by_packed_columns(spark):
    import pytest
    kind = "Predicted_Latitude double, Predicted_Longitude double, half_hour_interval int, Time long, event_id long"
    preds = spark.createDataFrame(
        [(1.0, 1.5, 0, None, 7), (2.0, 2.5, 0, None, 9), (3.0, 3.5, 1, None, 2 ** 62), (4.0, 4.5, 1, -5, -2 ** 62),
         (5.0, 5.5, 2, 10, 2 ** 62), (6.0, 6.5, 2, 11, -2 ** 62), (7.0, 7.5, 3, 10, 8), (8.0, 8.5, 3, 10, None),
         (9.0, 9.5, 48, 10, 1), (9.0, 9.5, None, 10, 1)], kind)
    got = [(r.half_hour_interval, r.lat, r.lng) for r in route_by_slot(preds).collect()]
    assert got == [(0, 2.0, 2.5), (1, 4.0, 4.5), (2, 6.0, 6.5), (3, 7.0, 7.5)]
    with pytest.raises(ValueError):
        route_by_slot(preds.drop("Time", "event_id"))
    plan = route_by_slot(preds)._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "Join" not in plan


def test_nearby_candidates_follow_k_in_a_dense_cell(spark):
    import numpy as np

    from strider.operators.location import _candidates
    rng = np.random.default_rng(21)
    lat = np.concatenate([np.full(3000, 50.85), 50.851 + rng.normal(0, 2e-4, 6000), 50.853 + rng.uniform(0, 1e-6, 1000),
                          50.8 + rng.uniform(0, 0.1, 300)])
    lng = np.concatenate([np.full(3000, 179.9999), -179.9995 + rng.normal(0, 2e-4, 6000), 179.995 + rng.uniform(0, 1e-6, 1000),
                          (179.95 + rng.uniform(0, 0.1, 300) + 180) % 360 - 180])
    at = list(zip(rng.permutation(len(lat)).tolist(), lat.tolist(), lng.tolist()))
    odd = [(20000, None, 1.0), (20001, 50.85, None), (20002, float("nan"), 1.0), (20003, 50.85, float("inf"))]
    p = spark.createDataFrame(at + odd, "poi_id long, lat double, lng double")
    spots = [(50.85, 179.9999), (50.851, -179.9995), (50.853, 179.995), (50.86, 179.99), (50.84, -179.99), (50.0, 0.0), (None, 1.0)]
    spots += [(50.85 + float(a), (179.9999 + float(b) + 180) % 360 - 180) for a, b in rng.normal(0, 0.003, (23, 2))]
    o = spark.createDataFrame(spots, "lat double, lng double")
    got = {}
    for r in nearby(o, p, 1500.0, 10).collect():
        got.setdefault((r.origin_lat, r.origin_lng), []).append((r.rank, r.poi_id, r.distance_m))
    for a, b in spots:
        cands = sorted((round(_hav(a, b, y, x), 2), i) for i, y, x in at) if a is not None else []
        want = [(n + 1, i, d) for n, (d, i) in enumerate([c for c in cands if c[0] <= 1500][:10])]
        assert sorted(got.get((a, b), [])) == want
    pairs = _candidates(o, p, 1500.0, 10, ("lat", "lng"), ("lat", "lng"), "poi_id")
    assert pairs.count() <= 200 * len(spots)             # a cell holds 10,000 places
