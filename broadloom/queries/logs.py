"""Access-log report over lines rendered from the events table."""

from pyspark.sql import functions as F

from broadloom.operators import logs as L
from broadloom.queries.registry import query

LINES = """
WITH lines AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'garbled ' || props ELSE
  'host' || user_id || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "' ||
  CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END || ' /' || event_type || '/' || event_id % 40 ||
  CASE WHEN event_id % 11 = 0 THEN '' ELSE ' HTTP/1.0' END || '" ' || CASE event_type WHEN 'error' THEN '404' WHEN 'signup' THEN '302' ELSE '200' END ||
  ' ' || CASE WHEN event_id % 13 = 0 THEN '-' ELSE floor(value * 100)::BIGINT::VARCHAR END END AS line FROM events)"""
PATTERN = r"""'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)'"""
LOGS = LINES + f""",
 logs AS (SELECT event_id, g.host AS host, g.client AS client, g.usr AS "user", g.stamp AS stamp, g.method AS method, g.endpoint AS endpoint,
   g.protocol AS protocol, g.status AS status, CASE WHEN g.size = '-' THEN 0 ELSE g.size::BIGINT END AS size
   FROM (SELECT event_id, regexp_extract(line, {PATTERN}, ['host', 'client', 'usr', 'stamp', 'method', 'endpoint', 'protocol', 'status', 'size']) AS g
         FROM lines WHERE regexp_matches(line, {PATTERN})))
"""


def lines(t):
    e = t.events
    n = F.col("event_id")
    method = F.when(F.col("event_type") == "purchase", "POST").otherwise("GET")
    status = F.when(F.col("event_type") == "error", "404").when(F.col("event_type") == "signup", "302").otherwise("200")
    size = F.when(n % 13 == 0, "-").otherwise(F.floor(F.col("value") * 100).cast("string"))
    good = F.concat(
        F.lit("host"), F.col("user_id").cast("string"), F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "'),
        method, F.lit(" /"), F.col("event_type"), F.lit("/"), (n % 40).cast("string"), F.when(n % 11 == 0, "").otherwise(" HTTP/1.0"),
        F.lit('" '), status, F.lit(" "), size,
    )
    return e.select("event_id", F.when(n % 97 == 0, F.concat(F.lit("garbled "), "props")).otherwise(good).alias("line"))


def logs(t):
    return L.parse_access_log(lines(t), "line")


@query("parse_access_log", LOGS + "SELECT * FROM logs")
def _(t):
    return logs(t)


@query("bad_access_lines", LINES + f"SELECT event_id, line FROM lines WHERE NOT regexp_matches(line, {PATTERN})")
def _(t):
    return L.bad_access_lines(lines(t), "line")


@query("log_to_pairs", LOGS + " UNPIVOT (SELECT host, client, \"user\", stamp, method, endpoint, protocol, status, size::VARCHAR AS size FROM logs) ON COLUMNS(*) INTO NAME field VALUE value")
def _(t):
    return L.log_to_pairs(logs(t))


@query("log_content_stats", LOGS + "SELECT floor(avg(size))::BIGINT AS avg_size, min(size) AS min_size, max(size) AS max_size FROM logs")
def _(t):
    return L.content_stats(logs(t))


@query("log_status_counts", LOGS + "SELECT status, count(*) AS n FROM logs GROUP BY 1")
def _(t):
    return L.counts_by(logs(t), "status").orderBy("status")


@query("log_hosts_over", LOGS + "SELECT host, count(*) AS n FROM logs GROUP BY 1 HAVING count(*) > 10 ORDER BY n DESC, host LIMIT 20")
def _(t):
    return L.top_by_count(logs(t), "host", 20, over=10)


@query("log_top_endpoints", LOGS + "SELECT endpoint, count(*) AS n FROM logs GROUP BY 1 ORDER BY n DESC, endpoint LIMIT 10")
def _(t):
    return L.top_by_count(logs(t), "endpoint", 10)


@query("log_unique_hosts", LOGS + "SELECT count(DISTINCT host) AS hosts FROM logs")
def _(t):
    return L.unique_hosts(logs(t))


@query("log_daily_hosts", LOGS + "SELECT strptime(substr(stamp, 1, 11), '%d/%b/%Y')::DATE AS day, count(DISTINCT host) AS hosts FROM logs GROUP BY 1")
def _(t):
    return L.daily_hosts(logs(t))


@query("log_daily_requests", LOGS + "SELECT strptime(substr(stamp, 1, 11), '%d/%b/%Y')::DATE AS day, count(*) AS requests FROM logs GROUP BY 1")
def _(t):
    return L.daily_requests(logs(t))


@query("log_daily_avg_per_host", LOGS + "SELECT strptime(substr(stamp, 1, 11), '%d/%b/%Y')::DATE AS day, (count(*) // count(DISTINCT host))::BIGINT AS per_host FROM logs GROUP BY 1")
def _(t):
    return L.daily_requests_per_host(logs(t))


@query("log_errors", LOGS + "SELECT * FROM logs WHERE status = '404'")
def _(t):
    return L.errors(logs(t))


@query("log_error_hosts", LOGS + "SELECT host, count(*) AS n FROM logs WHERE status = '404' GROUP BY 1 ORDER BY n DESC, host LIMIT 5")
def _(t):
    return L.top_by_count(L.errors(logs(t)), "host", 5)


@query("log_error_endpoints", LOGS + "SELECT endpoint, count(*) AS n FROM logs WHERE status = '404' GROUP BY 1 ORDER BY n DESC, endpoint LIMIT 5")
def _(t):
    return L.top_by_count(L.errors(logs(t)), "endpoint", 5)


@query("log_bytes_for_host", LOGS + "SELECT coalesce(sum(size), 0)::BIGINT AS bytes FROM logs WHERE host = 'host8'")
def _(t):
    return L.bytes_for_host(logs(t), "host8")
