"""Access-log parsing and the report built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The common access-log line, nine captured fields, protocol
# optional; and the names and order of those fields.
ACCESS_LINE = (
    r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)'
)
FIELDS = ("host", "client", "user", "stamp", "method", "endpoint", "protocol", "status", "size")

_MARK = "\u0001"


def _parts(column: str) -> Column:
    """The nine captures as an array, or an array of one if nothing matched."""
    marked = _MARK.join(f"${i}" for i in range(1, 10))
    return F.split(F.regexp_replace(F.col(column), ACCESS_LINE + r"[\s\S]*$", marked), _MARK)


def _split(df: DataFrame, column: str) -> DataFrame:
    # The one-element explode keeps the filter and the fields below from each
    # evaluating the regex again when projections are collapsed.
    parsed = df.select("*", F.explode(F.array(_parts(column))).alias("__parts"))
    size = F.get("__parts", F.lit(8))
    parsed = parsed.withColumn("__size", F.when(size == "-", F.lit(0).cast("long")).otherwise(size.try_cast("long")))
    return parsed.withColumn("__good", (F.size("__parts") == 9) & F.col("__size").isNotNull())


def parse_access_log(df: DataFrame, column: str) -> DataFrame:
    """Typed columns of every well-formed line: one regex pass, no Python."""
    good = _split(df, column).filter("__good")
    fields = [F.get("__parts", F.lit(i)).alias(name) for i, name in enumerate(FIELDS[:-1])]
    keep = [c for c in df.columns if c != column]
    return good.select(*keep, *fields, F.col("__size").alias("size"))


def bad_access_lines(df: DataFrame, column: str) -> DataFrame:
    """The lines ``parse_access_log`` leaves out."""
    return _split(df, column).filter(~F.col("__good")).select(*df.columns)


def log_to_pairs(logs: DataFrame) -> DataFrame:
    """One (field, value) row per parsed field."""
    pairs = F.array(
        *[F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("value")) for name in FIELDS]
    )
    return logs.select(F.explode(pairs).alias("p")).select("p.field", "p.value")


def day_of(column: str = "stamp") -> Column:
    """The date at the head of the log time stamp; a month's days don't fall together with another's."""
    return F.to_date(F.substring(column, 1, 11), "dd/MMM/yyyy")


def content_stats(logs: DataFrame) -> DataFrame:
    return logs.agg(
        F.floor(F.avg("size")).cast("long").alias("avg_size"),
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
    )


def counts_by(logs: DataFrame, column: str) -> DataFrame:
    return logs.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def top_by_count(logs: DataFrame, column: str, k: int, over: int = 0) -> DataFrame:
    """The k most frequent values seen more than ``over`` times."""
    return counts_by(logs, column).filter(F.col("n") > over).orderBy(F.desc("n"), column).limit(k)


def unique_hosts(logs: DataFrame) -> DataFrame:
    return logs.agg(F.countDistinct("host").alias("hosts"))


def daily_hosts(logs: DataFrame) -> DataFrame:
    return logs.groupBy(day_of().alias("day")).agg(F.countDistinct("host").alias("hosts"))


def daily_requests(logs: DataFrame) -> DataFrame:
    return logs.groupBy(day_of().alias("day")).agg(F.count(F.lit(1)).alias("requests"))


def daily_requests_per_host(logs: DataFrame) -> DataFrame:
    """Requests div hosts per day, from one grouping instead of a join."""
    daily = logs.groupBy(day_of().alias("day")).agg(
        F.count(F.lit(1)).alias("requests"), F.countDistinct("host").alias("hosts")
    )
    return daily.select("day", F.floor(F.col("requests") / F.col("hosts")).cast("long").alias("per_host"))


def errors(logs: DataFrame, status: str = "404") -> DataFrame:
    return logs.filter(F.col("status") == status)


def bytes_for_host(logs: DataFrame, host: str) -> DataFrame:
    return logs.filter(F.col("host") == host).agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
