"""Line sources and their parsers.

Each `parse_*` takes a DataFrame with one line per row in `value` (batch or streaming)
and adds typed columns plus `status`; rows that do not parse stay in the result, so the
good rows and the reject channel come from one scan. `VALID` is 1 throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions import text as T
from millrace.functions.arrays import bind
from millrace.session import stage

VALID = 1

# The line grammars whose results we match. `(?d)` makes the dot stop at
# line feeds only.
LOG_STRICT = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)'
LOG_RELAXED = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*\s*)" (\d{3}) (\S+)'
PRODUCT = '(?d)^(.+),"(.+)",(.*),(.*),(.*)'
PRODUCT_HEADER = '"id"'
GOLD = "(?d)^(.+),(.+)"
GOLD_HEADER = '"idAmazon"'
MONTHS = {"Jan": 1, "Feb": 2, "Mar": 3, "Apr": 4, "May": 5, "Jun": 6,
          "Jul": 7, "Aug": 8, "Sep": 9, "Oct": 10, "Nov": 11, "Dec": 12}


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Text lines as `value`. Splits follow spark.sql.files.maxPartitionBytes; a
    partition count is for inputs that cannot be split, such as gzip files."""
    lines = spark.read.text(path)
    return lines.repartition(partitions) if partitions else lines


def read_compressed_lines(spark: SparkSession, path: str, rows_per_piece: int = 1 << 18) -> DataFrame:
    """The lines, as `value`, of files that can't be split, such as gzip ones.

    The one task that can inflates a file once, from start to end, and writes its lines as pieces of
    so many rows to the shared folder; the pieces are then read by as many tasks, however often.
    """
    return stage(spark.read.text(path), "inflated-lines", rows_per_piece)


def _records(lines: DataFrame, parts: Column, record) -> DataFrame:
    """Add the fields of `record(parts)`, a struct, to each line.

    The parts are worked out once per line inside a generator, so a filter on `status`
    or on a field does not run the grammar again.
    """
    return lines.select(*lines.columns, F.inline(F.transform(F.array(parts), record)))


def log_time(field: Column) -> Column:
    """`dd/Mon/yyyy:HH:mm:ss` at the start of the field as a zone-less timestamp;
    the zone offset behind it is not read. NULL when any part is wrong."""
    month = F.try_element_at(
        F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair]),
        F.substring(field, 4, 3),
    )

    def number(start: int, length: int) -> Column:
        return F.substring(field, start, length).try_cast("int")

    return F.try_make_timestamp_ntz(
        number(8, 4), month, number(1, 2), number(13, 2), number(16, 2),
        number(19, 2).cast("decimal(16,6)"),
    )


def parse_log(lines: DataFrame, pattern: str = LOG_RELAXED) -> DataFrame:
    """Web access-log lines; status 1 = parsed, 0 = rejected (the line stays in `value`)."""

    def record(parts: Column) -> Column:
        def group(i: int) -> Column:
            return T.captured(parts, pattern, i)

        size = F.when(group(9) == "-", F.lit(0).cast("bigint")).otherwise(
            group(9).try_cast("bigint")
        )
        return bind(
            F.struct(
                log_time(group(4)).alias("time"),
                group(8).try_cast("int").alias("code"),
                size.alias("size"),
            ),
            lambda typed: F.struct(
                group(1).alias("host"),
                group(2).alias("client_identd"),
                group(3).alias("user_id"),
                typed["time"].alias("date_time"),
                group(5).alias("method"),
                group(6).alias("endpoint"),
                group(7).alias("protocol"),
                typed["code"].alias("response_code"),
                typed["size"].alias("content_size"),
                _valid_or(0, typed["time"], typed["code"], typed["size"]),
            ),
        )

    return _records(lines, T.captures(F.col("value"), pattern), record)


def parse_products(lines: DataFrame) -> DataFrame:
    """Quoted product lines to `id`, `text`; status 1 = record, 0 = header, -1 = invalid."""
    return _with_header(
        lines,
        PRODUCT,
        PRODUCT_HEADER,
        lambda g: {"id": T.remove_quotes(g(1)), "text": F.concat_ws(" ", g(2), g(3), g(4))},
    )


def parse_gold(lines: DataFrame) -> DataFrame:
    """Pair mapping lines to `a_id`, `g_id`; status as for products."""
    return _with_header(
        lines,
        GOLD,
        GOLD_HEADER,
        lambda g: {"a_id": T.remove_quotes(g(1)), "g_id": T.remove_quotes(g(2))},
    )


def _with_header(lines: DataFrame, pattern: str, header: str, fields) -> DataFrame:
    def record(parts: Column) -> Column:
        def group(i: int) -> Column:
            return T.captured(parts, pattern, i)

        status = (
            F.when(group(1).isNull(), -1).when(group(1) == header, 0).otherwise(VALID)
        )
        return F.struct(
            status.alias("status"),
            *[F.when(status == VALID, c).alias(name) for name, c in fields(group).items()],
        )

    return _records(lines, T.captures(F.col("value"), pattern), record)


def _valid_or(bad: int, *needed: Column) -> Column:
    """VALID when every needed field is there, else `bad`."""
    missing = F.lit(False)
    for field in needed:
        missing = missing | field.isNull()
    return F.when(missing, bad).otherwise(VALID).alias("status")


def parse_ratings(lines: DataFrame) -> DataFrame:
    """`user::item::rating::...` to typed columns; -1 marks a line that does not fit."""

    def record(f: Column) -> Column:
        usr = F.get(f, F.lit(0)).try_cast("int")
        item = F.get(f, F.lit(1)).try_cast("int")
        rating = F.get(f, F.lit(2)).try_cast("double")
        return F.struct(
            usr.alias("usr"), item.alias("item"), rating.alias("rating"),
            _valid_or(-1, usr, item, rating),
        )

    return _records(lines, F.split("value", "::"), record)


def parse_items(lines: DataFrame) -> DataFrame:
    """`item::title::...` to typed columns."""

    def record(f: Column) -> Column:
        item, title = F.get(f, F.lit(0)).try_cast("int"), F.get(f, F.lit(1))
        return F.struct(item.alias("item"), title.alias("title"), _valid_or(-1, item, title))

    return _records(lines, F.split("value", "::"), record)


def _fits(f: Column, fixed: int, width: int | None) -> Column:
    """Whether a line has `width` fields besides its first `fixed` ones; any number without a width."""
    return F.lit(True) if width is None else F.size(f) == fixed + width


def parse_labelled(lines: DataFrame, width: int | None = None) -> DataFrame:
    """Comma-separated doubles, label first; with `width`, lines of another number of features
    are bad ones."""

    def record(f: Column) -> Column:
        return F.struct(
            F.get(f, F.lit(0)).alias("label"),
            F.slice(f, 2, F.size(f)).alias("features"),
            F.when(F.exists(f, lambda x: x.isNull()) | ~_fits(f, 1, width), -1).otherwise(VALID).alias("status"),
        )

    doubles = F.transform(F.split("value", ","), lambda x: x.try_cast("double"))
    return _records(lines, doubles, record)


def parse_clicks(lines: DataFrame, width: int | None = None) -> DataFrame:
    """Label-first rows of categories, tab or comma separated; `feats` holds
    (position, category) with empty categories kept. With `width`, lines of another number of
    categories are bad ones."""

    def record(f: Column) -> Column:
        label = F.get(f, F.lit(0)).try_cast("double")
        feats = F.transform(
            F.slice(f, 2, F.size(f)),
            lambda cat, pos: F.struct(pos.alias("idx"), cat.alias("cat")),
        )
        fitting = F.when(_fits(f, 1, width), label)
        return F.struct(label.alias("label"), feats.alias("feats"), _valid_or(-1, fitting))

    return _records(lines, F.split(T.strip(T.tabs_to_commas(F.col("value"))), ","), record)


def parse_series(lines: DataFrame, width: int | None = None) -> DataFrame:
    """`x y v1 v2 ...` separated by single blanks; with `width`, series of another length are bad."""

    def record(f: Column) -> Column:
        x, y = F.get(f, F.lit(0)).try_cast("int"), F.get(f, F.lit(1)).try_cast("int")
        series = F.transform(F.slice(f, 3, F.size(f)), lambda v: v.try_cast("double"))
        return bind(
            series,
            lambda s: F.struct(
                x.alias("x"), y.alias("y"), s.alias("series"),
                F.when(
                    x.isNull() | y.isNull() | F.exists(s, lambda v: v.isNull()) | ~_fits(f, 2, width), -1
                ).otherwise(VALID).alias("status"),
            ),
        )

    return _records(lines, F.split(T.strip(F.col("value")), " "), record)


def status_counts(parsed: DataFrame) -> DataFrame:
    """Rows per status: the figures of a load report."""
    return parsed.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def rejects(parsed: DataFrame, bad_status: int, limit: int) -> DataFrame:
    """A repeatable sample of rejected lines for the load report."""
    bad = parsed.filter(F.col("status") == bad_status)
    return bad.select("value").orderBy("value").limit(limit)
