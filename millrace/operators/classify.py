"""Logistic models on sparse rows (label, indices, values), and their evaluation. With a column n, a row
stands for n equal ones."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.functions.scores import log_loss, probability
from millrace.operators.joins import spread_join
from millrace.operators.ordering import running_totals
from millrace.session import stage

#: weights (models x places that occur) of which the driver and every task hold a copy; with more
#: the weights stay a table
HELD_WEIGHTS = 1 << 20
#: rows of a packed piece, about
PIECE_ENTRIES = 1 << 19
#: gradients that meet in one task or on the driver
MEETING = 16
INTERCEPT = -1
Settings = list[tuple[float, float]]


@dataclass(frozen=True)
class LogisticModel:
    """Weights of `places` (rising; all others are 0), or of the places 0, 1, 2, ... without them."""

    weights: np.ndarray
    intercept: float
    places: np.ndarray | None = None

    def dense(self, width: int) -> np.ndarray:
        out = np.zeros(width)
        out[slice(len(self.weights)) if self.places is None else self.places] = self.weights
        return out


@dataclass(frozen=True)
class ModelTable:
    """Models as a table: weights (slot, w), w holding a weight a model, INTERCEPT for a slot too."""

    weights: DataFrame
    models: int


def _packed(rows: DataFrame) -> DataFrame:
    """The rows (label, indices, values) in pieces of binary columns, equal ones as one with their
    number: (piece, touched, labels, counts, lengths, at, values). `touched` are the places that
    a piece's rows have, rising, and `at` says which of them each value belongs to."""

    def pack(batches):
        piece = TaskContext.get().partitionId() << 32
        for whole in batches:
            entries = whole.column("indices").flatten()
            rows = max(1, whole.num_rows * PIECE_ENTRIES // max(len(entries), 1))
            for first in range(0, whole.num_rows, rows):
                batch = whole.slice(first, rows)
                lengths = batch.column("indices").value_lengths().to_numpy(zero_copy_only=False).astype("<i4")
                index = batch.column("indices").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                touched, at = np.unique(index, return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "piece": [piece], "touched": pa.array([touched], pa.list_(pa.int64())),
                    "labels": [batch.column("label").to_numpy().astype("<f8").tobytes()],
                    "counts": [batch.column("n").to_numpy().astype("<f8").tobytes()],
                    "lengths": [lengths.tobytes()], "at": [at.astype("<i4").tobytes()],
                    "values": [batch.column("values").flatten().to_numpy(zero_copy_only=False).astype("<f8").tobytes()],
                })
                piece += 1

    known = rows.select(
        F.col("label").cast("double").alias("label"), F.col("indices").cast("array<bigint>").alias("indices"),
        F.col("values").cast("array<double>").alias("values"), *(["n"] if "n" in rows.columns else []),
    ).filter("label is not null and indices is not null and values is not null")
    counted = known if "n" in rows.columns else known.groupBy("label", "indices", "values").agg(F.count(F.lit(1)).alias("n"))
    return stage(counted.mapInArrow(
        pack, "piece long, touched array<long>, labels binary, counts binary, lengths binary, at binary, values binary"), "packed-rows")


def _gradients(piece: dict, weights: np.ndarray) -> np.ndarray:
    """The gradients of a piece's rows. weights: a row a model, a column a touched place, the intercept last."""
    y, counts, values = (np.frombuffer(piece[c], dtype="<f8") for c in ("labels", "counts", "values"))
    at = np.frombuffer(piece["at"], dtype="<i4")
    row = np.repeat(np.arange(len(y)), np.frombuffer(piece["lengths"], dtype="<i4"))
    out = np.empty(weights.shape)
    for m, w in enumerate(weights):
        score = np.bincount(row, values * w[at], len(y)) + w[-1]
        residual = (1.0 / (1.0 + np.exp(-np.clip(score, -700, 700))) - y) * counts
        out[m, :-1] = np.bincount(at, values * residual[row], len(w) - 1)
        out[m, -1] = residual.sum()
    return out


def descend(
    rows: DataFrame, settings: Settings, iterations: int, held: int = HELD_WEIGHTS
) -> list[LogisticModel] | ModelTable:
    """Full-batch logistic descent with L2 and an intercept, one model per (step, reg).

    Weights start at 0 and the intercept at 1; at t the step is step / sqrt(t) and the
    intercept is shrunk like any weight. Only places that occur have weights; others stay 0.
    Rows without a label or features take no part; equal rows are one counted row. Up to `held`
    weights are held by every task; beyond, they are a table that each piece of rows gets its own
    part of, with the same iterates.
    """
    packed = _packed(rows)
    places = packed.select(F.explode("touched").alias("slot")).distinct()
    if places.limit(held // len(settings) + 1).count() * len(settings) > held:
        return _descend_table(packed, places, settings, iterations)
    slots = np.array(sorted(r["slot"] for r in places.collect()), dtype=np.int64)
    return _descend_held(packed, slots, settings, iterations)


def _descend_held(packed: DataFrame, slots: np.ndarray, settings: Settings, iterations: int) -> list[LogisticModel]:
    """One pass a step: a task adds up its pieces' gradients and sends them as one binary row; many
    tasks' rows are added in levels, so that few meet on the driver."""
    models = len(settings)
    shape = (models, len(slots) + 1)
    steps, regs = (np.array(x)[:, None] for x in zip(*settings, strict=True))
    weights = np.zeros(shape)
    weights[:, -1] = 1.0
    data = packed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = _count(data)
        tasks = data.rdd.getNumPartitions()
        context = packed.sparkSession.sparkContext
        for t in range(1, iterations + 1):
            shared = context.broadcast((slots, weights)) if weights.nbytes > 1 << 16 else None
            sent = data.mapInArrow(_task_gradients(shared, None if shared else (slots, weights)), "g binary")
            groups = tasks
            while groups > MEETING:
                groups = -(-groups // MEETING)
                sent = sent.repartition(groups).mapInArrow(_add_up, "g binary")
            gradient = np.zeros(shape)
            for r in sent.collect():
                gradient += np.frombuffer(r["g"]).reshape(shape)
            rate = steps / np.sqrt(t)
            weights = weights * (1 - rate * regs) - rate * gradient / max(n, 1)
            if shared:
                shared.destroy()
    finally:
        data.unpersist()
    return [LogisticModel(w[:-1], float(w[-1]), slots) for w in weights]


def _count(packed: DataFrame) -> int:
    """How many rows the pieces stand for."""

    def count(batches):
        total = sum(np.frombuffer(x, dtype="<f8").sum() for b in batches for x in b.column("counts").to_pylist())
        yield pa.RecordBatch.from_pydict({"n": pa.array([int(total)], pa.int64())})

    return packed.mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0


def _task_gradients(shared, own):
    def gradients(batches):
        slots, weights = shared.value if shared else own
        total = np.zeros(weights.shape)
        for batch in batches:
            for piece in batch.to_pylist():
                place = np.append(np.searchsorted(slots, piece["touched"]), len(slots)).astype(np.int64)
                total[:, place] += _gradients(piece, weights[:, place])
        yield pa.RecordBatch.from_pydict({"g": pa.array([total.tobytes()], pa.binary())})

    return gradients


def _add_up(batches):
    total = None
    for batch in batches:
        for raw in batch.column("g").to_pylist():
            total = np.frombuffer(raw) + (0.0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_pydict({"g": pa.array([total.tobytes()], pa.binary())})


def _descend_table(packed: DataFrame, places: DataFrame, settings: Settings, iterations: int) -> ModelTable:
    """A step joins the weights to the pieces that touch them, hands each piece its own, and adds the
    gradients up per place. Pieces are laid out by their number once and stay; no step collects
    what grows with the places. A place that all rows have is a row a piece."""
    models = len(settings)
    parts = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    data = packed.repartition(parts, "piece").persist(StorageLevel.MEMORY_AND_DISK)
    n = max(_count(packed), 1)
    touch = stage(packed.select("piece", F.explode(F.concat("touched", F.array(F.lit(INTERCEPT).cast("bigint")))).alias("slot")), "touched")
    start = F.array(*[F.when(F.col("slot") == INTERCEPT, 1.0).otherwise(0.0) for _ in settings])
    weights = touch.select("slot").distinct().withColumn("w", start)

    def hand(left: pa.Table, right: pa.Table) -> pa.Table:
        piece = left.to_pylist()[0]
        slots = right["slot"].to_numpy()
        order = np.argsort(np.where(slots == INTERCEPT, np.iinfo(np.int64).max, slots))
        w = np.array(right["w"].to_pylist(), dtype=float)[order].T
        found = _gradients(piece, w)
        return pa.table({"slot": slots[order], "g": pa.array(list(found.T), pa.list_(pa.float64()))})

    try:
        for t in range(1, iterations + 1):
            handed = touch.join(weights, "slot")
            sent = data.groupBy("piece").cogroup(handed.groupBy("piece")).applyInArrow(hand, "slot long, g array<double>")
            summed = sent.groupBy("slot").agg(F.array(*[F.sum(F.get("g", F.lit(m))) for m in range(models)]).alias("g"))
            moved = F.array(*[
                F.get("w", F.lit(m)) * (1 - step / np.sqrt(t) * reg) - F.get("g", F.lit(m)) * (step / np.sqrt(t) / n)
                for m, (step, reg) in enumerate(settings)
            ])
            weights = stage(weights.join(summed, "slot").select("slot", moved.alias("w")), "weights")
    finally:
        data.unpersist()
    return ModelTable(weights, models)


def with_raw_scores(rows: DataFrame, models: list[LogisticModel] | ModelTable, names: list[str]) -> DataFrame:
    """Add each model's raw score, the sparse dot product plus the intercept."""
    if isinstance(models, ModelTable):
        return _table_scores(rows, models, names)
    shared = rows.sparkSession.sparkContext.broadcast([(m.weights, float(m.intercept), m.places) for m in models])

    def score(batches):
        for batch in batches:
            lists = batch.column("indices")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), lengths)
            index = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            value = batch.column("values").flatten().to_numpy(zero_copy_only=False)
            raw = []
            for w, b, places in shared.value:
                at, known = index, None
                if places is not None:
                    at = np.minimum(np.searchsorted(places, index), max(len(places) - 1, 0))
                    known = places[at] == index if len(places) else np.zeros(len(index), dtype=bool)
                weight = w[at] if len(w) else np.zeros(len(index))
                raw.append(np.bincount(row, value * weight * (1.0 if known is None else known), batch.num_rows) + b)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, raw)], names=[*batch.schema.names, *names]
            )

    schema = StructType([*rows.schema.fields, *[StructField(n, DoubleType()) for n in names]])
    return rows.mapInArrow(score, schema)


def _table_scores(rows: DataFrame, models: ModelTable, names: list[str]) -> DataFrame:
    """Scores by a join of the rows' places with the weights; a place of very many rows is dealt."""
    numbered = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered-rows")
    entries = numbered.select("_row", F.inline(F.arrays_zip(F.col("indices").cast("array<bigint>").alias("slot"), F.col("values").alias("value"))))
    met = spread_join(entries, models.weights, ["slot"], ["_row"])
    sums = met.groupBy("_row").agg(*[F.sum(F.col("value") * F.get("w", F.lit(m))).alias(f"_s{m}") for m in range(models.models)])
    bias = models.weights.filter(F.col("slot") == INTERCEPT).select("w").scalar()
    return numbered.join(sums, "_row", "left").select(
        *rows.columns, *[(F.coalesce(f"_s{m}", F.lit(0.0)) + F.get(bias, F.lit(m))).alias(name) for m, name in enumerate(names)])


def with_raw_score(rows: DataFrame, model: LogisticModel | list[LogisticModel] | ModelTable) -> DataFrame:
    return with_raw_scores(rows, [model] if isinstance(model, LogisticModel) else model, ["raw_score"])


def mean_log_loss(scored: DataFrame) -> Column:
    """Aggregate over (label, raw_score): mean log loss of the held sigmoid."""
    return _mean(scored, log_loss(probability(F.col("raw_score")), F.col("label")))


def _mean(rows: DataFrame, value: Column) -> Column:
    """Aggregate over `rows`: the mean of `value`, NULLs left out, a counted row n times."""
    if "n" not in rows.columns:
        return F.avg(value)
    return F.try_divide(F.sum(value * F.col("n")), F.sum(F.when(value.isNotNull(), F.col("n"))))


def model_log_losses(rows: DataFrame, models: list[LogisticModel] | ModelTable) -> list[float]:
    names = [f"_raw{k}" for k in range(models.models if isinstance(models, ModelTable) else len(models))]
    scored = with_raw_scores(rows, models, names)
    return list(scored.agg(*[_mean(scored, log_loss(probability(F.col(n)), F.col("label"))) for n in names]).first())


def positive_share(rows: DataFrame) -> Column:
    """Share of label-1 rows as a one-value subquery."""
    return rows.agg(_mean(rows, (F.col("label") == 1).cast("double"))).scalar()


def baseline_log_loss(parts: DataFrame) -> DataFrame:
    """(split, n, loss) of always predicting the positive share of the 'train' rows."""
    share = positive_share(parts.filter("split = 'train'"))
    number = F.sum("n") if "n" in parts.columns else F.count(F.lit(1))
    return parts.withColumn("_share", share).groupBy("split").agg(
        number.alias("n"), _mean(parts, log_loss(F.col("_share"), F.col("label"))).alias("loss")
    )


def one_model(models: list[LogisticModel] | ModelTable, k: int) -> list[LogisticModel] | ModelTable:
    """The k-th model alone."""
    if isinstance(models, ModelTable):
        return ModelTable(models.weights.select("slot", F.array(F.get("w", F.lit(k))).alias("w")), 1)
    return models[k : k + 1]


def logistic_grid(
    train: DataFrame, validation: DataFrame, settings: Settings, iterations: int = 500, held: int = HELD_WEIGHTS,
) -> tuple[DataFrame, list[LogisticModel] | ModelTable]:
    """(step, reg, loss, best) on the validation part, and the best model alone."""
    models = descend(train, settings, iterations, held)
    losses = model_log_losses(validation, models)
    best = min(range(len(losses)), key=lambda k: losses[k])
    rows = [
        (float(step), float(reg), float(losses[k]), k == best)
        for k, (step, reg) in enumerate(settings)
    ]
    schema = "step double, reg double, loss double, best boolean"
    return train.sparkSession.createDataFrame(rows, schema), one_model(models, best)


def area_under_curve(scored: DataFrame, score: str, label: str) -> DataFrame:
    """(positives, negatives, auc): the share of (positive, negative) pairs in which the positive row
    has the higher score, equal scores counting half. Rows meet as counts per score."""
    positive = (F.col(label) == 1).cast("bigint")
    counts = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("_score")).agg(
        F.sum(positive).alias("_p"), F.sum(1 - positive).alias("_n"))
    below = running_totals(counts, [F.asc("_score")], {"_below": F.col("_n")})
    won = F.sum(F.col("_p") * (F.col("_below") - F.col("_n") / 2))
    return below.agg(
        F.coalesce(F.sum("_p"), F.lit(0)).alias("positives"), F.coalesce(F.sum("_n"), F.lit(0)).alias("negatives"),
        F.try_divide(won, F.sum("_p").cast("double") * F.sum("_n")).alias("auc"),
    )


def roc_points(scored: DataFrame, score: str, label: str, tie: str) -> DataFrame:
    """Running true and false positives and their rates, highest score first; rows with
    equal scores go in `tie` order."""
    rows = scored.select(tie, score, F.col(label).cast("bigint").alias(label))
    sums = rows.agg(
        F.struct(F.sum(label).alias("positives"), F.count(F.lit(1)).alias("rows"))
    ).scalar()
    tallied = running_totals(
        rows,
        [F.desc(score), F.asc(tie)],
        {"tp": F.col(label), "fp": F.lit(1) - F.col(label)},
    )
    return tallied.select(
        "*",
        F.try_divide(F.col("tp"), sums["positives"]).alias("tpr"),
        F.try_divide(F.col("fp"), sums["rows"] - sums["positives"]).alias("fpr"),
    )
