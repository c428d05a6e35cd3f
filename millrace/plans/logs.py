"""Web access-log reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.ordering import top_rows, with_share
from millrace.plans import inputs as I
from millrace.session import shared_folder
from millrace.sources import lines as S

FIELDS = ["host", "client_identd", "user_id", "date_time", "method", "endpoint", "protocol",
          "response_code", "content_size"]


def hits(rows, key):
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def by_day(rows):
    return rows.withColumn("day", F.dayofmonth("date_time"))


def _errors(spark, sf_dir):
    return I.good_log(spark, sf_dir).filter(F.col("response_code") == 404)


def _shown(rows):
    return rows.select(*FIELDS).withColumn("date_time", F.col("date_time").cast("string"))


def log_parse(spark, sf_dir):
    strict = I.access_log(spark, sf_dir, S.LOG_STRICT)
    return _shown(strict.filter(F.col("status") == S.VALID))


def log_parse_relaxed(spark, sf_dir):
    return _shown(I.good_log(spark, sf_dir))


def log_load_counts(spark, sf_dir):
    return S.status_counts(I.access_log(spark, sf_dir))


def log_file_counts(spark, sf_dir):
    """Log lines written to text files and read back, per status."""
    folder = shared_folder(spark, "log-lines")
    I.log_lines(spark, sf_dir).write.text(folder)
    return S.status_counts(S.parse_log(S.read_lines(spark, folder)))


def log_rejects(spark, sf_dir):
    return S.rejects(I.access_log(spark, sf_dir, S.LOG_STRICT), 0, 20)


def content_size_stats(spark, sf_dir):
    return I.good_log(spark, sf_dir).agg(
        F.expr("sum(content_size) div count(1)").alias("mean_size"),
        F.min("content_size").alias("min_size"),
        F.max("content_size").alias("max_size"),
    )


def response_code_counts(spark, sf_dir):
    return hits(I.good_log(spark, sf_dir), "response_code")


def response_code_share(spark, sf_dir):
    shared = with_share(response_code_counts(spark, sf_dir), "n")
    return shared.select("response_code", F.round("share", 9).alias("share"))


def hosts_over_n(spark, sf_dir):
    busy = hits(I.good_log(spark, sf_dir), "host").filter(F.col("n") > 10)
    return busy.select("host").orderBy("host").limit(20)


def endpoint_hits(spark, sf_dir):
    return hits(I.good_log(spark, sf_dir), "endpoint")


def top_endpoints(spark, sf_dir):
    return top_rows(endpoint_hits(spark, sf_dir), "n", ["endpoint"], 10)


def _failing(spark, sf_dir):
    failed = I.good_log(spark, sf_dir).filter(F.col("response_code") != 200)
    return hits(failed, "endpoint")


def top_failing_endpoints(spark, sf_dir):
    return top_rows(_failing(spark, sf_dir), "n", ["endpoint"], 10)


def failing_endpoint_count(spark, sf_dir):
    return _failing(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_endpoints"))


def unique_hosts(spark, sf_dir):
    return I.good_log(spark, sf_dir).agg(F.countDistinct("host").alias("n_hosts"))


def daily_hosts(spark, sf_dir):
    days = by_day(I.good_log(spark, sf_dir)).groupBy("day")
    return days.agg(F.countDistinct("host").alias("n_hosts")).orderBy("day")


def daily_avg_requests(spark, sf_dir):
    """Requests per distinct host and day of month, cut to whole numbers; both counts
    come from one grouping instead of a join of two."""
    days = by_day(I.good_log(spark, sf_dir)).groupBy("day")
    return days.agg(F.expr("count(1) div count(distinct host)").alias("mean_requests")).orderBy("day")


def errors_404(spark, sf_dir):
    return _shown(_errors(spark, sf_dir))


def distinct_404_endpoints(spark, sf_dir):
    return _errors(spark, sf_dir).select("endpoint").distinct().orderBy("endpoint").limit(40)


def top_404_endpoints(spark, sf_dir):
    return top_rows(hits(_errors(spark, sf_dir), "endpoint"), "n", ["endpoint"], 20)


def top_404_hosts(spark, sf_dir):
    return top_rows(hits(_errors(spark, sf_dir), "host"), "n", ["host"], 25)


def daily_404(spark, sf_dir):
    return hits(by_day(_errors(spark, sf_dir)), "day").orderBy("day")


def top_404_days(spark, sf_dir):
    return top_rows(hits(by_day(_errors(spark, sf_dir)), "day"), "n", ["day"], 5)


def hourly_404(spark, sf_dir):
    errors = _errors(spark, sf_dir).withColumn("hour", F.hour("date_time"))
    return hits(errors, "hour").orderBy("hour")


QUERIES = {
    f.__name__: f
    for f in (
        log_parse, log_parse_relaxed, log_load_counts, log_file_counts, log_rejects, content_size_stats,
        response_code_counts, response_code_share, hosts_over_n, endpoint_hits, top_endpoints,
        top_failing_endpoints, failing_endpoint_count, unique_hosts, daily_hosts,
        daily_avg_requests, errors_404, distinct_404_endpoints, top_404_endpoints, top_404_hosts,
        daily_404, top_404_days, hourly_404,
    )
}
