"""DuckDB text of the histogram tree: every level is one more set of common table expressions."""

from __future__ import annotations

from strider.plans.views_sql import CLEAN_MOTION_VIEW, LABEL_VIEW, MOTION_VIEW, with_views

_NAMES = ("AccelerationMagnitude", "MagnetometerMagnitude", "LinearAccelerationMagnitude")
_AXES = ("Acceleration", "Magnetometer", "LinearAcceleration")


def _bin(i: int) -> str:
    return (f"CASE WHEN w{i} = 0 THEN 0 ELSE "
            f"CAST(greatest(0, least(31, floor((x{i} - lo{i}) / w{i}))) AS INTEGER) END")


def _level(d: int) -> str:
    """Best cut per node of depth ``d``, then the training and test cells one level down."""
    return f""",
c{d} AS (SELECT node, f, bins[f + 1] AS bin, label, CAST(sum(n) AS BIGINT) AS n
           FROM train{d}, (VALUES (0), (1), (2)) v(f) WHERE node >= {1 << d} GROUP BY ALL),
r{d} AS (SELECT node, f, bin, n, CAST(sum(n) OVER (PARTITION BY node, f, label ORDER BY bin) AS HUGEINT) AS after,
                CAST(sum(n) OVER (PARTITION BY node, f, label) AS HUGEINT) AS whole FROM c{d}),
b{d} AS (SELECT node, f, bin, CAST(sum(n) AS BIGINT) AS n, sum(after * after - (after - n) * (after - n)) AS gone,
                sum((whole - after) * (whole - after) - (whole - after + n) * (whole - after + n)) AS kept
           FROM r{d} GROUP BY ALL),
g{d} AS (SELECT node, f, bin, CAST(sum(n) OVER up AS BIGINT) AS nl, CAST(sum(n) OVER line AS BIGINT) AS total,
                CAST(sum(gone) OVER up AS DOUBLE) AS sl, CAST(sum(gone) OVER line AS DOUBLE) AS s,
                CAST(sum(gone) OVER line + sum(kept) OVER up AS DOUBLE) AS sr
           FROM b{d} WINDOW line AS (PARTITION BY node, f), up AS (PARTITION BY node, f ORDER BY bin)),
s{d} AS MATERIALIZED (SELECT node, f, bin FROM (
           SELECT *, row_number() OVER (PARTITION BY node ORDER BY score DESC, f, bin) AS best
             FROM (SELECT *, sl / nl + sr / (total - nl) AS score FROM g{d} WHERE nl < total) q) p
          WHERE best = 1 AND score - s / total > 1e-9 * total),
train{d + 1} AS MATERIALIZED ({_down(d, 'train')}),
test{d + 1} AS MATERIALIZED ({_down(d, 'test')})"""


def _down(d: int, part: str) -> str:
    return f"""SELECT t.bins, t.label, t.n, CASE WHEN s.node IS NULL THEN t.node
                  ELSE 2 * t.node + CAST(t.bins[s.f + 1] > s.bin AS INTEGER) END AS node
             FROM {part}{d} t LEFT JOIN s{d} s ON s.node = t.node"""


def grown(depth: int) -> str:
    """Common table expressions up to ``train<depth>``, ``test<depth>`` and ``marks`` (label and rows per node)."""
    magnitudes = ", ".join(f"sqrt(m.{a}X * m.{a}X + m.{a}Y * m.{a}Y + m.{a}Z * m.{a}Z) AS x{i}" for i, a in enumerate(_AXES))
    ends = ", ".join(f"min(x{i}) AS lo{i}, (max(x{i}) - min(x{i})) / 32 AS w{i}" for i in range(3))
    every = " UNION ".join(f"SELECT * FROM train{d}" for d in range(depth + 1))
    return with_views(LABEL_VIEW, MOTION_VIEW, CLEAN_MOTION_VIEW) + f""", joined AS MATERIALIZED (
  SELECT l.CoarseLabel AS label, {magnitudes},
         CAST('0x' || substr(md5(l.event_id || ':' || m.event_id || ':1234'), 1, 13) AS BIGINT) / 4503599627370496.0 < 0.8 AS train
    FROM label_view l JOIN clean_motion m ON l.date = m.date AND l.Time = m.Time),
ends AS MATERIALIZED (SELECT {ends} FROM joined WHERE train),
cells AS MATERIALIZED (SELECT train, label, [{', '.join(_bin(i) for i in range(3))}] AS bins, count(*) AS n
                         FROM joined, ends GROUP BY ALL),
train0 AS (SELECT bins, label, n, 1 AS node FROM cells WHERE train),
test0 AS (SELECT bins, label, n, 1 AS node FROM cells WHERE NOT train)""" + "".join(map(_level, range(depth))) + f""",
per_label AS (SELECT node, label, CAST(sum(n) AS BIGINT) AS n FROM ({every}) e GROUP BY ALL),
marks AS MATERIALIZED (SELECT node, label, total FROM (
  SELECT *, CAST(sum(n) OVER (PARTITION BY node) AS BIGINT) AS total,
         row_number() OVER (PARTITION BY node ORDER BY n DESC, label) AS best FROM per_label) q WHERE best = 1)"""


def nodes_sql(depth: int) -> str:
    cuts = " UNION ALL ".join(f"SELECT * FROM s{d}" for d in range(depth))
    name = "CASE c.f " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_NAMES)) + " END"
    at = "CASE c.f " + " ".join(f"WHEN {i} THEN lo{i} + (c.bin + 1) * w{i}" for i in range(3)) + " END"
    return grown(depth) + f"""
SELECT m.node, CAST(floor(log2(m.node)) AS INTEGER) AS depth, {name} AS feature, round({at}, 6) AS threshold,
       m.total AS rows, CAST(m.label AS INTEGER) AS label
  FROM marks m LEFT JOIN ({cuts}) c ON c.node = m.node, ends"""


def sweep_sql(depths: tuple[int, ...]) -> str:
    guesses = " UNION ALL ".join(
        f"SELECT {d} AS depth, t.label AS l, m.label AS p, CAST(sum(t.n) AS BIGINT) AS n "
        f"FROM test{d} t JOIN marks m ON m.node = t.node GROUP BY ALL" for d in depths)
    return grown(max(depths)) + f"""
SELECT CAST(depth AS INTEGER) AS Depth,
       round(sum(n) FILTER (l = p) / any_value(total), 6) AS Accuracy,
       round(coalesce(sum(n / n_p * n_l) FILTER (l = p), 0) / any_value(total), 6) AS Precision,
       round(coalesce(sum(n) FILTER (l = p), 0) / any_value(total), 6) AS Recall
  FROM (SELECT *, sum(n) OVER (PARTITION BY depth, l) AS n_l, sum(n) OVER (PARTITION BY depth, p) AS n_p,
               sum(n) OVER (PARTITION BY depth) AS total FROM ({guesses}) g) x
 GROUP BY depth"""
