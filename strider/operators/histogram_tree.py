"""Decision tree out of integer counts over fixed bins; one fit serves every depth.

1. Every feature is cut into ``bins`` equal parts between its smallest and largest training value.
2. One grouped count turns all rows into cells: (training or test, bin per feature, label, rows).
   There are never more cells than rows, and no more than bins^features * labels * 2.  Partial
   counts are made before the shuffle, so a cell that holds a third of all rows is no hot key.
3. A level is one job over the cells: counts per node, feature, bin and label, whose running
   squares give the Gini score of every cut.  Only the best cut per node comes back, so the driver
   holds at most 2^max_depth rows whatever the input.
4. The tree of depth d is the same node table cut at d, so a depth sweep is one more count.

Nodes are numbered 1 for the root, 2i and 2i + 1 below node i.  All counts are whole numbers and
every tie has a rule (cut: lowest feature, then lowest bin; node's label: lowest label), so the
result depends neither on partitioning nor on row order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strider.operators.activity import (REPORT_DEPTH, SPLIT_SEED, SWEEP_DEPTHS, TRAIN_FRACTION, confusion_metrics,
                                        uniform_hash)
from strider.session import materialize

BINS = 32
#: The node arrays travel with the plan as literals: 2^(depth + 1) entries.
DEEPEST = 14
#: A cut must raise the share of the score per row by more than rounding.
MIN_GAIN = 1e-9
_WHOLE = "decimal(19,0)"
NODES = "node int, depth int, feature string, threshold double, rows long, label int"
METRICS = "Depth int, Accuracy double, Precision double, Recall double"


@dataclass(frozen=True)
class HistogramTree:
    """Fixed size: three numbers per node, two per feature."""
    features: tuple[str, ...]
    lows: tuple[float, ...]
    widths: tuple[float, ...]
    bins: int
    max_depth: int
    split: tuple[int, ...]      # per node the feature's position, -1 for a leaf
    cut: tuple[int, ...]        # per node the last bin that goes left
    label: tuple[int, ...]      # per node its most frequent label
    rows: tuple[int, ...]       # per node its training rows, 0 for a node that does not exist

    def binned(self) -> Column:
        """Bin per feature; values beyond the training range fall into the outer bins."""
        return F.array(*[bin_of(F.col(f), lo, w, self.bins) for f, lo, w in zip(self.features, self.lows, self.widths)])

    def path(self, bins: Column, depth: int) -> Column:
        """Node at depth 0, 1, ... ``depth``; a leaf above repeats."""
        root = F.array(F.lit(1))
        if not depth:
            return root
        split, cut = _literal(self.split), _literal(self.cut)

        def step(nodes: Column, _: Column) -> Column:
            node = F.element_at(nodes, -1)
            feature = F.get(split, node)
            below = node * 2 + (F.get(bins, feature) > F.get(cut, node)).cast("int")
            return F.concat(nodes, F.array(F.when(feature >= 0, below).otherwise(node)))
        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), root, step)

    def predict(self, rows: DataFrame, depth: int | None = None, column: str = "prediction") -> DataFrame:
        """Add the label of the tree cut at ``depth``; null where a feature is null."""
        complete = F.lit(True)
        for f in self.features:
            complete = complete & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
        node = F.element_at(self.path(self.binned(), self.max_depth if depth is None else min(depth, self.max_depth)), -1)
        return rows.withColumn(column, F.when(complete, F.get(_literal(self.label), node)))

    def nodes(self, spark) -> DataFrame:
        """The tree as a table; a leaf has neither feature nor threshold."""
        found = []
        for node, count in enumerate(self.rows):
            if count:
                f = self.split[node]
                at = None if f < 0 else self.lows[f] + (self.cut[node] + 1) * self.widths[f]
                found.append((node, node.bit_length() - 1, None if f < 0 else self.features[f], at, count, self.label[node]))
        return spark.createDataFrame(found, NODES)

    def text(self, node: int = 1) -> str:
        """Indented dump of the tree for a report."""
        pad, f = "  " * (node.bit_length() - 1), self.split[node]
        if f < 0:
            return f"{pad}Predict: {self.label[node]}\n"
        at = f"{self.lows[f] + (self.cut[node] + 1) * self.widths[f]:.6f}"
        name = self.features[f]
        return f"{pad}If ({name} < {at})\n{self.text(2 * node)}{pad}Else ({name} >= {at})\n{self.text(2 * node + 1)}"


def _literal(values: tuple[int, ...]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def bin_of(value: Column, low: float, width: float, bins: int) -> Column:
    if not width:
        return F.lit(0)
    at = F.floor((value.cast("double") - F.lit(low)) / F.lit(width))
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), at)).cast("int")


def best_cuts(counts: DataFrame) -> DataFrame:
    """(node, f, bin): the cut of each node that leaves the purest halves, if any gains.

    ``counts`` has node, f, bin, label and n.  A half's score is the sum of its squared label counts
    over its rows.  From one bin to the next only the labels in that bin change, so differences of
    squares, summed along the bins, give both halves without a dense table.  All windows and groups
    below are parts of a node, so one shuffle by node serves them all; a node has at most features *
    bins * labels rows here.
    """
    kinds = Window.partitionBy("node", "f", "label")
    after, whole = F.col("after").cast(_WHOLE), F.col("whole").cast(_WHOLE)
    before = (F.col("after") - F.col("n")).cast(_WHOLE)
    steps = (counts.repartition("node").withColumn("after", F.sum("n").over(kinds.orderBy("bin"))).withColumn("whole", F.sum("n").over(kinds))
             .groupBy("node", "f", "bin").agg(
                 F.sum("n").alias("n"), F.sum(after * after - before * before).alias("left"),
                 F.sum((whole - after) * (whole - after) - (whole - before) * (whole - before)).alias("right")))
    line = Window.partitionBy("node", "f")
    run = line.orderBy("bin")
    sums = steps.select(
        "node", "f", "bin", F.sum("n").over(run).alias("n_left"), F.sum("n").over(line).alias("rows"),
        F.sum("left").over(run).cast("double").alias("left"), F.sum("left").over(line).cast("double").alias("parent"),
        (F.sum("left").over(line) + F.sum("right").over(run)).cast("double").alias("right"))
    scored = sums.where("n_left < rows").withColumn(
        "score", F.col("left") / F.col("n_left") + F.col("right") / (F.col("rows") - F.col("n_left")))
    first = Window.partitionBy("node").orderBy(F.desc("score"), "f", "bin")
    return (scored.withColumn("rank", F.row_number().over(first))
            .where((F.col("rank") == 1) & (F.col("score") - F.col("parent") / F.col("rows") > MIN_GAIN * F.col("rows")))
            .select("node", "f", "bin"))


def cells_of(df: DataFrame, features: list[str] | tuple[str, ...], label_col: str, key_cols: tuple[str, ...], bins: int,
             fraction: float, seed: int) -> tuple[DataFrame, tuple[float, ...], tuple[float, ...]] | None:
    """(train, bins, label, n) and the bins' starts and widths; None without training rows."""
    complete = F.col(label_col).isNotNull()
    for f in features:
        complete = complete & (F.abs(F.col(f).cast("double")) < float("inf"))
    rows = materialize(df.where(complete).select(
        (uniform_hash(key_cols, seed) < fraction).alias("train"), F.col(label_col).cast("int").alias("label"),
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]))
    ends = rows.where("train").agg(*[g(f"x{i}") for i in range(len(features)) for g in (F.min, F.max)]).first()
    if ends[0] is None:
        return None
    lows = tuple(ends[2 * i] for i in range(len(features)))
    widths = tuple((ends[2 * i + 1] - lows[i]) / bins for i in range(len(features)))
    named = [bin_of(F.col(f"x{i}"), lows[i], widths[i], bins).alias(f"b{i}") for i in range(len(features))]
    counted = rows.select("train", "label", *named).groupBy("train", "label", *[f"b{i}" for i in range(len(features))]).agg(
        F.count(F.lit(1)).alias("n"))
    cells = counted.select("train", "label", "n", F.array(*[f"b{i}" for i in range(len(features))]).alias("bins"))
    return materialize(cells), lows, widths


def fit(cells: DataFrame, lows: tuple[float, ...], widths: tuple[float, ...], features: list[str] | tuple[str, ...],
        bins: int = BINS, max_depth: int = REPORT_DEPTH) -> HistogramTree:
    """Grow the tree level by level over the training cells."""
    if not 0 <= max_depth <= DEEPEST:
        raise ValueError(f"max_depth must be from 0 to {DEEPEST}")
    size = 2 << max_depth
    split, cut, none = [-1] * size, [0] * size, (0,) * size
    train = cells.where("train")

    def tree(label=none, rows=none) -> HistogramTree:
        return HistogramTree(tuple(features), lows, widths, bins, max_depth, tuple(split), tuple(cut), label, rows)

    for level in range(max_depth):
        node = F.element_at(tree().path(F.col("bins"), level), -1)
        live = train.withColumn("node", node).where(F.col("node") >= 1 << level)
        counts = (live.select("node", "label", "n", F.posexplode("bins").alias("f", "bin"))
                  .groupBy("node", "f", "bin", "label").agg(F.sum("n").alias("n")))
        found = best_cuts(counts).collect()
        for r in found:
            split[r.node], cut[r.node] = r.f, r.bin
        if not found:
            break
    per_label = (train.select("label", "n", F.explode(F.array_distinct(tree().path(F.col("bins"), max_depth))).alias("node"))
                 .groupBy("node", "label").agg(F.sum("n").alias("n")))
    per_node = per_label.groupBy("node").agg(
        F.sum("n").alias("rows"), F.max(F.struct("n", (-F.col("label")).alias("lowest"))).alias("top"))
    label, rows = [0] * size, [0] * size
    for r in per_node.collect():
        label[r.node], rows[r.node] = -r.top.lowest, r["rows"]
    return tree(tuple(label), tuple(rows))


def fitted(df: DataFrame, features: list[str] | tuple[str, ...], label_col: str = "CoarseLabel",
           max_depth: int = REPORT_DEPTH, key_cols: tuple[str, ...] = ("date", "Time"), bins: int = BINS,
           fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED) -> tuple[HistogramTree, DataFrame] | None:
    """The tree of the hash split's training rows, and the cells; None without training rows.

    Rows with a null label, or a null, NaN or infinite feature, take no part.  Labels are integers.
    """
    found = cells_of(df, features, label_col, key_cols, bins, fraction, seed)
    if found is None:
        return None
    cells, lows, widths = found
    return fit(cells, lows, widths, features, bins, max_depth), cells


def depth_sweep(model: HistogramTree, cells: DataFrame, depths: tuple[int, ...] = SWEEP_DEPTHS) -> DataFrame:
    """Depth, Accuracy, Precision, Recall over the test cells, all depths from one count."""
    path, label = model.path(F.col("bins"), model.max_depth), _literal(model.label)
    guesses = [F.struct(F.lit(d).alias("Depth"), F.get(label, F.get("path", F.lit(min(d, model.max_depth)))).alias("p"))
               for d in depths]
    cells = (cells.where("NOT train").withColumn("path", path).select("label", "n", F.explode(F.array(*guesses)).alias("g"))
             .groupBy("g.Depth", F.col("label").cast("double").alias("l"), F.col("g.p").cast("double").alias("p"))
             .agg(F.sum("n").alias("n")))
    return confusion_metrics(cells, "Depth").select(
        "Depth", F.col("accuracy").alias("Accuracy"), F.col("weighted_precision").alias("Precision"),
        F.col("weighted_recall").alias("Recall"))
