"""Reconstruction errors: black-box scorers, a linear reconstruction, daily roll-ups."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline import schema
from wakeline.functions import geo
from wakeline.functions import values as V
from wakeline.operators.features import apply_min_max, fit_min_max
from wakeline.operators.joins import marked
from wakeline.operators.sequences import flatten_sequences, number_sequences, pad_sequences, to_sequences

Scorer = Callable[[np.ndarray], np.ndarray]


def reconstruct_sequences(padded: DataFrame, model: Scorer, *, out: str = "rebuilt") -> DataFrame:
    """Run a model over equally long sequences, one Arrow batch at a time.

    ``model`` maps ``(n, rows, features)`` to the same shape. It is shipped with
    the task and must not depend on how sequences fall into batches.
    """
    result = T.StructType(
        [*padded.schema.fields, T.StructField(out, T.ArrayType(T.ArrayType(T.DoubleType())))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                steps = batch.column("seq").flatten()
                rows = len(steps) // n
                values = steps.flatten().to_numpy(zero_copy_only=False).astype("float64")
                rebuilt = np.asarray(model(values.reshape(n, rows, -1)), dtype="float64")
                width = rebuilt.shape[2]
                inner = pa.ListArray.from_arrays(
                    pa.array(np.arange(n * rows + 1) * width, pa.int32()), pa.array(rebuilt.reshape(-1))
                )
                outer = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * rows, pa.int32()), inner)
                yield pa.RecordBatch.from_arrays([*batch.columns, outer], [*batch.schema.names, out])

    return padded.mapInArrow(run, result)


def reconstruct_rows(
    df: DataFrame, features: Sequence[str], model: Scorer, *, suffix: str = "_rebuilt"
) -> DataFrame:
    """Run a row-wise model, ``(n, features)`` to the same shape, keys kept on the row."""
    names = list(features)
    extra = [T.StructField(f + suffix, T.DoubleType()) for f in names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rebuilt = np.asarray(model(batch[names].to_numpy(dtype="float64")))
            for i, f in enumerate(names):
                batch[f + suffix] = rebuilt[:, i]
            yield batch

    return df.mapInPandas(run, T.StructType([*df.schema.fields, *extra]))


def sequence_errors(
    df: DataFrame,
    features: Sequence[str],
    model: Scorer,
    *,
    keys: Sequence[str] = ("node_name", "TRIP_ID"),
    ts: str = "ts",
    tie: Sequence[str] = (),
    carry: Sequence[str] = ("date",),
    rows: int = schema.SEQUENCE_ROWS,
) -> DataFrame:
    """Squared reconstruction error of every row; keys travel inside the sequence."""
    sequences = to_sequences(df, rows, features, keys=keys, ts=ts, tie=tie, carry=[*carry, *tie])
    rebuilt = reconstruct_sequences(
        pad_sequences(sequences, length=rows, width=len(features)), model
    )
    pairs = F.transform(
        F.arrays_zip(F.col("seq"), F.col("rebuilt")),
        lambda p: F.zip_with(p["seq"], p["rebuilt"], lambda a, b: (a - b) * (a - b)),
    )
    return flatten_sequences(rebuilt.withColumn("seq", pairs), features, keys=keys)


def squared_errors(df: DataFrame, features: Sequence[str], suffix: str = "_rebuilt") -> DataFrame:
    return _residuals(df, features, suffix, V.squared_residual)


def absolute_errors(df: DataFrame, features: Sequence[str], suffix: str = "_rebuilt") -> DataFrame:
    return _residuals(df, features, suffix, V.absolute_residual)


def _residuals(df, features, suffix, how) -> DataFrame:
    done = df.withColumns({f: how(f, f + suffix) for f in features})
    return done.drop(*(f + suffix for f in features))


def daily_errors(
    errors: DataFrame, features: Sequence[str], *, keys: Sequence[str] = ("node_name", "date")
) -> DataFrame:
    """Mean error per vessel and day."""
    return errors.groupBy(*keys).agg(*(F.avg(f).alias(f) for f in features))


# --- linear reconstruction -------------------------------------------------------------


def fit_reconstruction(df: DataFrame, features: Sequence[str], k: int = 2) -> PipelineModel:
    """Centre and project on the ``k`` main directions: a linear bottleneck of ``k`` units."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False),
        PCA(k=k, inputCol="_centred", outputCol="latent"),
    ]
    return Pipeline(stages=stages).fit(df.select(*features))


def load_reconstruction(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_reconstruction(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_bundle(model: PipelineModel, ranges: DataFrame, threshold: float, path: str) -> None:
    """A model with the ranges its inputs are scaled by and the threshold of its verdicts, in one folder."""
    save_reconstruction(model, f"{path}/model")
    ranges.withColumn("_threshold", F.lit(float(threshold))).write.mode("overwrite").parquet(f"{path}/ranges")


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame, float]:
    saved = spark.read.parquet(f"{path}/ranges")
    return load_reconstruction(f"{path}/model"), saved.drop("_threshold"), saved.first()["_threshold"]


def _weights(model: PipelineModel, k: int | None = None):
    assembler, centre, pca = model.stages
    pc = pca.pc.toArray()[:, :k]
    return assembler.getInputCols(), centre.mean.toArray(), pc @ pc.T


def _rebuilt(model: PipelineModel, k: int | None = None) -> dict[str, Column]:
    features, mean, weights = _weights(model, k)
    out = {}
    for j, name in enumerate(features):
        column = F.lit(float(mean[j]))
        for i, f in enumerate(features):
            column = column + F.lit(float(weights[j, i])) * (F.col(f) - F.lit(float(mean[i])))
        out[name] = column
    return out


def reconstruct_linear(
    df: DataFrame, model: PipelineModel, *, k: int | None = None, suffix: str = "_rebuilt"
) -> DataFrame:
    """Rebuild every feature from the latent space with column arithmetic only.

    ``k`` may be smaller than the model's: directions are ordered by variance.
    """
    return df.withColumns({f + suffix: c for f, c in _rebuilt(model, k).items()})


def validation_errors(
    train: DataFrame, validation: DataFrame, features: Sequence[str], ks: Sequence[int]
) -> DataFrame:
    """Mean squared error on the later rows for each bottleneck size, ``(k, error)``.

    The directions are nested, so one fit and one pass over the validation rows
    answer for all sizes.
    """
    model = fit_reconstruction(train, features, max(ks))

    def error(k: int) -> Column:
        parts = [V.squared_residual(f, c) for f, c in _rebuilt(model, k).items()]
        return F.avg(sum(parts[1:], parts[0])) / len(parts)

    per_k = F.array(*(F.struct(F.lit(k).alias("k"), error(k).alias("error")) for k in ks))
    return validation.agg(per_k.alias("_e")).select(F.inline("_e"))


def best_bottleneck(errors: DataFrame) -> int:
    """Smallest size with the least validation error."""
    return errors.agg(F.min(F.struct("error", "k"))["k"].alias("k")).first()["k"]


# --- disrupted positions -----------------------------------------------------------------

# Fixed value: the order of the model's inputs.
GPS_FEATURES = ("LAT_Delta", "LON_Delta", "RPM", "COG", "SOG", "CELL")


def gps_ranges(df: DataFrame) -> DataFrame:
    """Least and greatest of the scaled features, one row, to be kept with a model."""
    return fit_min_max(_gps_copies(df), _gps_scaled())


def _gps_scaled() -> list[str]:
    return [f"{f}_x" for f in GPS_FEATURES if f != "COG"]


def gps_features(df: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Model columns: running flag, cosine of the course, the rest scaled to 0..1.

    Results get the suffix ``_x``; the originals stay for the map. ``ranges`` are those the model was trained
    with; without them the rows at hand give theirs.
    """
    copies = _gps_copies(df)
    return apply_min_max(copies, fit_min_max(copies, _gps_scaled()) if ranges is None else ranges, _gps_scaled())


def _gps_copies(df: DataFrame) -> DataFrame:
    present = V.ensure_columns(df, ["RPM"], 0.0)
    scaled = [f for f in GPS_FEATURES if f != "COG"]
    return present.withColumns(
        {
            **{f"{f}_x": F.col(f).cast("double") for f in scaled if f != "RPM"},
            "RPM_x": V.is_running("RPM").cast("double"),
            "COG_x": geo.cos_degrees("COG"),
        }
    )


def score_windows(
    df: DataFrame,
    model: Scorer,
    *,
    rows: int = schema.GPS_WINDOW_ROWS,
    keys: Sequence[str] = ("node_name", "tripID"),
    ts: str = "ts",
    threshold: float = schema.GPS_SCORE_THRESHOLD,
    number: str | None = None,
) -> DataFrame:
    """Score of each whole window of ``rows`` rows: ``score`` and the 0/1 ``anomaly``.

    ``model`` maps ``(n, rows, features)`` to ``n`` scores. Windows never cross
    trips, so a window's trip is its key. ``number`` names the place in the trip of rows that are trimmed to whole windows already.
    """
    names = [f"{f}_x" for f in GPS_FEATURES]
    windows = to_sequences(df, rows, names, keys=keys, ts=ts, whole_only=True, number=number).select(
        *keys, "seq_id", "seq"
    )
    fields = [f for f in windows.schema.fields if f.name != "seq"]
    result = T.StructType([*fields, T.StructField("score", T.DoubleType())])
    kept, width = [f.name for f in fields], len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("seq").flatten().flatten().to_numpy(zero_copy_only=False)
                cube = flat.reshape(batch.num_rows, rows, width)
                score = np.asarray(model(cube), dtype="float64").reshape(batch.num_rows)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(score)], [*kept, "score"])

    scored = windows.mapInArrow(run, result)
    return scored.withColumn("anomaly", V.flag_score("score", threshold))


def flagged_trips(scored: DataFrame, keys: Sequence[str] = ("node_name", "tripID")) -> DataFrame:
    """Trips with at least one anomalous window."""
    return scored.filter("anomaly = 1").select(*keys).distinct()


def mark_flagged(
    df: DataFrame, flagged: DataFrame, *, keys: Sequence[str] = ("node_name", "tripID"), name: str = "anomalous"
) -> DataFrame:
    """Rows with a column that tells those of flagged trips from all others."""
    return marked(df, flagged, keys, name)


def window_trips(
    df: DataFrame, rows: int, *, trip: str = "tripID", keys: Sequence[str] = ("node_name", "tripID"),
    ts: str = "ts",
) -> DataFrame:
    """Trip of the first row of every whole window."""
    numbered = number_sequences(df, rows, keys=keys, ts=ts, whole_only=True)
    return numbered.groupBy(*keys, "seq_id").agg(F.min_by(F.col(trip), F.col("row_no")).alias("first_trip"))
