"""Boosted trees for quantiles: histograms of pinball gradients per node are summed in Spark, splits chosen on the driver.

Values are cut into bins once. Each level of a tree is one aggregation over (quantile, node, column, bin), summed up in the
tasks first, so what reaches the driver depends on the numbers of nodes, columns and bins and not on the rows. All
quantiles are fitted in the same passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideloom.workspace import cut_lineage

#: Rounds after which the sums of the trees so far are written beside the bins, which bounds the size of expressions.
WRITE_EVERY = 5


@dataclass
class Tree:
    """Splits by node (column number, largest bin that goes left) and values by leaf; the root is 1, children 2n and 2n + 1."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def node(self, at: int = 1) -> Column:
        """The leaf of a row of bins."""
        if at not in self.splits:
            return F.lit(at)
        column, left = self.splits[at]
        return F.when(F.col(f"b{column}") <= left, self.node(2 * at)).otherwise(self.node(2 * at + 1))

    def value(self, at: int = 1) -> Column:
        if at not in self.splits:
            return F.lit(float(self.values.get(at, 0.0)))
        column, left = self.splits[at]
        return F.when(F.col(f"b{column}") <= left, self.value(2 * at)).otherwise(self.value(2 * at + 1))


@dataclass
class QuantileTrees:
    """For each quantile a first value and trees that are added to it, on log1p(trips)."""

    columns: list[str]
    limits: list[list[float]]
    quantiles: list[float]
    first: list[float]
    trees: list[list[Tree]]

    def binned(self, df: DataFrame, *others: Column) -> DataFrame:
        """Bin 0 holds nulls and NaN, bin i the values above i - 1 limits."""
        def place(name: str, limits: list[float]) -> Column:
            x = F.col(name).cast("double")
            above = sum([(x > limit).cast("int") for limit in limits], F.lit(1))
            return F.when(x.isNull() | F.isnan(x), 0).otherwise(above)

        bins = [place(c, limits).alias(f"b{i}") for i, (c, limits) in enumerate(zip(self.columns, self.limits, strict=True))]
        return df.select(*others, *bins)

    def sum_of(self, quantile: int, rounds: int | None = None, since: int = 0) -> Column:
        return sum([tree.value() for tree in self.trees[quantile][since:rounds]], F.lit(0.0))


def _best_split(cells: list, least_rows: int) -> tuple[int, int] | None:
    """The column and bin whose cut lowers the squared error of the gradients most; ties go to the first."""
    by_column: dict[int, list] = {}
    for c in sorted(cells, key=lambda c: (c["feature"], c["bin"])):
        by_column.setdefault(c["feature"], []).append(c)
    best, found = 1e-9, None
    for column, bins in by_column.items():
        n, total = sum(c["n"] for c in bins), sum(c["g"] for c in bins)
        left_n = left_g = 0
        for c in bins[:-1]:
            left_n += c["n"]
            left_g += c["g"]
            if min(left_n, n - left_n) < least_rows:
                continue
            gain = left_g**2 / left_n + (total - left_g) ** 2 / (n - left_n) - total**2 / n
            if gain > best:
                best, found = gain, (column, c["bin"])
    return found


def _pull(rest: Column, a: float) -> Column:
    """Gradient of the pinball loss; a row that is met exactly, as counts often are, pulls nowhere."""
    return F.when(F.abs(rest) < 1e-9, 0.0).when(rest < 0, a - 1.0).otherwise(a)


def fit_quantile_trees(
    train: DataFrame, valid: DataFrame, cols: Sequence[str], quantiles: Sequence[float] = (0.1, 0.9),
    rounds: int = 30, depth: int = 4, step: float = 0.2, bins: int = 32, least_rows: int = 20,
) -> QuantileTrees:
    """Trees for each quantile of log1p(trips), each cut at the round that serves the validation rows best.

    A leaf holds the quantile of its residuals, times ``step``. All rows count; those without ``trips`` are left out.
    """
    cols = list(cols)
    label = F.log1p(F.col("trips").cast("double")).alias("y")
    known = train.filter("trips is not null")
    limits = known.approxQuantile(cols, [i / bins for i in range(1, bins)], 0.001)
    model = QuantileTrees(cols, [sorted(set(x)) for x in limits], list(quantiles), [], [[] for _ in quantiles])
    model.first = known.agg(F.percentile_approx(label, list(quantiles), 10_000)).first()[0]
    if model.first is None:
        raise ValueError("no rows to train on")
    sums = [F.lit(float(v)).alias(f"p{q}") for q, v in enumerate(model.first)]
    kept = ["y", *[f"b{i}" for i in range(len(cols))]]
    table = cut_lineage(model.binned(known, label).select(*kept, *sums), "quantile-bins")
    written = 0
    for turn in range(rounds):
        if turn - written == WRITE_EVERY:
            table = cut_lineage(table.select(*kept, *[
                (F.col(f"p{q}") + model.sum_of(q, since=written)).alias(f"p{q}") for q in range(len(quantiles))]), "quantile-bins")
            written = turn
        now = [F.col(f"p{q}") + model.sum_of(q, since=written) for q in range(len(quantiles))]
        grown = [Tree() for _ in quantiles]
        for _ in range(depth):
            sides = F.array(*[F.struct(
                F.lit(q).alias("q"), grown[q].node().alias("node"), _pull(F.col("y") - now[q], a).alias("g"))
                for q, a in enumerate(quantiles)])
            places = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"b{i}").alias("bin")) for i in range(len(cols))])
            cells = table.select(F.explode(sides).alias("s"), places.alias("at")).select("s.*", F.explode("at").alias("f"))
            found: dict[tuple[int, int], list] = {}
            for r in cells.groupBy("q", "node", "f.feature", "f.bin").agg(F.count("*").alias("n"), F.sum("g").alias("g")).collect():
                found.setdefault((r["q"], r["node"]), []).append(r)
            for (q, node), cell in found.items():
                if split := _best_split(cell, least_rows):
                    grown[q].splits[node] = split
        leaves = F.array(*[F.struct(F.lit(q).alias("q"), grown[q].node().alias("node"), (F.col("y") - now[q]).alias("rest")) for q in range(len(quantiles))])
        rests = table.select(F.explode(leaves).alias("s")).groupBy("s.q", "s.node").agg(F.percentile_approx("s.rest", list(quantiles), 10_000).alias("v"))
        for r in rests.collect():
            grown[r["q"]].values[r["node"]] = step * r["v"][r["q"]]
        for q, tree in enumerate(grown):
            model.trees[q].append(tree)
    return _cut_at_best(model, model.binned(valid.filter("trips is not null"), label))


def _cut_at_best(model: QuantileTrees, rows: DataFrame) -> QuantileTrees:
    """Keep the trees up to the round with the least pinball loss on ``rows``; one pass scores all rounds."""
    rounds = len(model.trees[0])
    losses = []
    for q, a in enumerate(model.quantiles):
        staged = rows.select("y", *[tree.value().alias(f"v{i}") for i, tree in enumerate(model.trees[q])])
        at = F.lit(float(model.first[q]))
        for i in range(rounds + 1):
            rest = F.col("y") - at
            losses.append(F.avg(F.greatest(rest * a, rest * (a - 1))).alias(f"l{i}"))
            at = at + F.col(f"v{i}") if i < rounds else at
        row = staged.agg(*losses).first()
        losses = []
        best = min(range(rounds + 1), key=lambda i: (row[i] is None, row[i]))
        model.trees[q] = model.trees[q][:best]
    return model


def predict_band(model: QuantileTrees, df: DataFrame) -> DataFrame:
    """``df`` with ``q_lo`` and ``q_hi``: the first and the last quantile in trips, 0 <= q_lo <= q_hi."""
    kept = [c for c in df.columns if c not in ("q_lo", "q_hi")]
    value = lambda q: F.greatest(F.lit(0.0), F.expm1(F.lit(float(model.first[q])) + model.sum_of(q)))
    binned = model.binned(df, *[F.col(c).alias(f"keep_{c}") for c in kept])
    banded = binned.select(*[F.col(f"keep_{c}").alias(c) for c in kept], value(0).alias("q_lo"), value(-1).alias("q_hi"))
    return banded.withColumn("q_hi", F.greatest("q_lo", "q_hi"))
