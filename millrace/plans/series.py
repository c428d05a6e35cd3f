"""Series operators, covariance and principal components."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import arrays as A
from millrace.operators import components as P
from millrace.operators import moments as M
from millrace.plans import inputs as I
from millrace.sources import lines as S

PERIOD = 16
RUN = 8


def _spelled(rows, column, digits=6):
    return rows.select("x", "y", F.posexplode(column).alias("pos", "v")).select(
        "x", "y", "pos", F.round("v", digits).alias("v")
    )


def series_lines_parse(spark, sf_dir):
    """Series written as blank-separated lines and read back."""
    lines = I.series(spark, sf_dir).select(
        F.concat_ws(" ", "x", "y", F.concat_ws(" ", F.transform("series", lambda v: v.cast("string"))))
        .alias("value")
    )
    parsed = S.parse_series(lines).filter(F.col("status") == S.VALID)
    return parsed.select(
        "x", "y", F.size("series").alias("n"), F.round(A.array_sum(F.col("series")), 6).alias("total")
    )


def series_minmax(spark, sf_dir):
    return I.series(spark, sf_dir).agg(
        F.min(F.array_min("series")).alias("low"), F.max(F.array_max("series")).alias("high")
    )


def series_std_filter(spark, sf_dir):
    """Series that vary: population deviation above 0.12."""
    spread = I.series(spark, sf_dir).withColumn("sd", A.array_std(F.col("series")))
    return spread.filter(F.col("sd") > 0.12).select("x", "y", F.round("sd", 6).alias("sd"))


def _rescaled(spark, sf_dir):
    return I.series(spark, sf_dir).withColumn("series", A.rescale(F.col("series")))


def series_rescale(spark, sf_dir):
    return _spelled(_rescaled(spark, sf_dir), "series")


def series_fold(spark, sf_dir):
    return _spelled(_rescaled(spark, sf_dir), A.fold(F.col("series"), PERIOD))


def series_blocks(spark, sf_dir):
    return _spelled(_rescaled(spark, sf_dir), A.block_sums(F.col("series"), RUN))


def vector_mean(spark, sf_dir):
    means = M.column_means(I.vectors(spark, sf_dir))
    return means.select("pos", F.round("mean", 9).alias("mean"))


def centre(spark, sf_dir):
    rows = I.vectors(spark, sf_dir)
    means = A.literal_array(M.mean_vector(rows))
    moved = rows.select("vec_id", F.posexplode(A.centred(F.col("features"), means)).alias("pos", "v"))
    return moved.select("vec_id", "pos", F.round("v", 6).alias("v"))


def covariance(spark, sf_dir):
    return M.covariance(I.vectors(spark, sf_dir)).select("i", "j", F.round("cov", 9).alias("cov"))


def pca(spark, sf_dir):
    """Scores of every row on the two leading directions."""
    rows = I.vectors(spark, sf_dir)
    scored = P.with_scores(rows, P.fit_components(rows, 2))
    spelt = scored.select("vec_id", F.posexplode("scores").alias("component", "score"))
    return spelt.withColumn("score", F.round("score", 6))


def eigenvalue_sums(spark, sf_dir):
    """Sums of the first to fourth powers of all eigenvalues."""
    found = P.fit_components(I.vectors(spark, sf_dir), 1)
    rows = [(p, float((found.eigenvalues**p).sum())) for p in range(1, 5)]
    return spark.createDataFrame(rows, "power int, total double").withColumn("total", F.round("total", 9))


def variance_shares(spark, sf_dir):
    """Shares of the variance along the first three directions, one after the other."""
    found = P.fit_components(I.vectors(spark, sf_dir), 3)
    rows = [(k, found.variance_explained(k)) for k in range(1, 4)]
    return spark.createDataFrame(rows, "k int, share double").withColumn("share", F.round("share", 9))


def variance_explained(spark, sf_dir):
    found = P.fit_components(I.vectors(spark, sf_dir), 3)
    rows = [(k, found.variance_explained(k)) for k in range(1, len(found.eigenvalues) + 1)]
    return spark.createDataFrame(rows, "k int, share double")


def project_back(spark, sf_dir):
    """Rows laid onto the first direction through the mean."""
    rows = I.vectors(spark, sf_dir)
    first = P.fit_components(rows, 1).directions[:, 0]
    means = A.literal_array(M.mean_vector(rows))
    laid = A.project_back(F.col("features"), means, A.literal_array(first))
    return rows.select("vec_id", F.posexplode(laid).alias("pos", "v")).withColumn("v", F.round("v", 6))


def _series_pca(rows):
    found = P.fit_components(rows, 3, "series")
    spelt = P.with_scores(rows, found, "series").select("x", "y", F.posexplode("scores").alias("component", "score"))
    return spelt.withColumn("score", F.round("score", 6))


def pca_rescaled(spark, sf_dir):
    return _series_pca(_rescaled(spark, sf_dir))


def pca_folded(spark, sf_dir):
    return _series_pca(_rescaled(spark, sf_dir).withColumn("series", A.fold(F.col("series"), PERIOD)))


def pca_blocks(spark, sf_dir):
    return _series_pca(_rescaled(spark, sf_dir).withColumn("series", A.block_sums(F.col("series"), RUN)))


QUERIES = {
    f.__name__: f
    for f in (
        series_lines_parse, series_minmax, series_std_filter, series_rescale, series_fold,
        series_blocks, vector_mean, centre, covariance, pca, variance_explained, variance_shares, eigenvalue_sums, project_back,
        pca_rescaled, pca_folded, pca_blocks,
    )
}
