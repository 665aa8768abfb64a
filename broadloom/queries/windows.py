"""Window and ranking queries."""

from pyspark.sql import functions as F

from broadloom.operators import ordered as O
from broadloom.operators import topk as K
from broadloom.operators import windows as W
from broadloom.operators.aggregates import winners_by_symbol
from broadloom.queries.registry import query

# Position rows: a return counts as a sale, anything else as a purchase.  Prices
# are whole cents, so sums and products are exact in any order of addition.
TRADES = """
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, year(l_shipdate)::INTEGER AS expiry, l_shipdate AS day,
       (CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END)::BIGINT AS chg,
       floor(l_extendedprice * 100 / l_quantity)::BIGINT AS px FROM lineitem
"""
ROW = ["l_partkey", "l_orderkey", "l_linenumber", "l_suppkey"]
RUNNING = f"""
SELECT *, (sum(chg) OVER w)::BIGINT AS oi, (sum(chg * px) OVER w)::BIGINT AS outlay FROM ({TRADES}) WINDOW w AS (PARTITION BY l_partkey, expiry ORDER BY day)
"""
TAIL = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]


def _trades(t):
    sold = F.col("l_returnflag") == "R"
    return t.lineitem.select(
        *ROW, F.year("l_shipdate").alias("expiry"), F.col("l_shipdate").alias("day"),
        F.when(sold, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("long").alias("chg"),
        F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("long").alias("px"),
    )


def _settled(t, limit=O.GROUP_LIMIT):
    return W.pl_settlement(_trades(t), ["l_partkey", "expiry"], "day", F.col("chg"), F.col("px"), group_limit=limit)


@query("win_running_sum", f"SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, day, oi AS open_interest FROM ({RUNNING})")
def _(t):
    out = O.with_tie_functions(_trades(t), ["l_partkey", "expiry"], ["day"], {"open_interest": O.running_sum("chg")})
    return out.select(*ROW, "day", "open_interest")


@query("win_running_value", f"""
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, oi AS open_interest, outlay FROM ({RUNNING})""")
def _(t):
    out = W.running_positions(_trades(t), ["l_partkey", "expiry"], ["day"], F.col("chg"), F.col("px"))
    return out.select(*ROW, "open_interest", "outlay")


_SETTLED = f"""
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, expiry, day, oi AS open_interest, outlay,
       outlay - px * oi AS final_status
FROM (SELECT *, max(day) OVER (PARTITION BY l_partkey, expiry) AS last FROM ({RUNNING})) WHERE day = last
"""


def _settled_columns(df):
    return df.select(*ROW, "expiry", "day", "open_interest", "outlay", "final_status")


@query("pl_settlement", _SETTLED)
def _(t):
    return _settled_columns(_settled(t))


@query("pl_settlement_chunked", _SETTLED)
def _(t):
    return _settled_columns(_settled(t, limit=0))


#: Half of the rows fall in one group: beyond the limit at every scale, so it alone is cut.
_SKEWED = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate AS day,
       CASE WHEN l_orderkey % 2 = 0 THEN -1 ELSE l_partkey END AS grp, l_quantity::BIGINT AS chg, floor(l_extendedprice * 100 / l_quantity)::BIGINT AS px
FROM lineitem"""


def skewed(t):
    group = F.when(F.col("l_orderkey") % 2 == 0, F.lit(-1)).otherwise(F.col("l_partkey"))
    return t.lineitem.select(
        *ROW, F.col("l_shipdate").alias("day"), group.alias("grp"), F.col("l_quantity").cast("long").alias("chg"),
        F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("long").alias("px"))


_HOT_SUMS = f"""
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, grp, (sum(chg) OVER w)::BIGINT AS oi, (sum(chg * px) OVER w)::BIGINT AS outlay
FROM ({_SKEWED}) WINDOW w AS (PARTITION BY grp ORDER BY day)"""


def _hot_sums(t, limit):
    moves = W.running_positions(skewed(t), ["grp"], ["day"], F.col("chg"), F.col("px"), limit)
    return moves.select(*ROW, "grp", F.col("open_interest").alias("oi"), "outlay")


@query("win_running_sum_hot", _HOT_SUMS)
def _(t):
    return _hot_sums(t, 2_000)


@query("win_running_sum_hot_plain", _HOT_SUMS)
def _(t):
    return _hot_sums(t, O.GROUP_LIMIT)


_HOT_AVG = f"""
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, grp,
       avg(px) OVER (PARTITION BY grp ORDER BY day, l_orderkey, l_linenumber, l_suppkey, l_partkey ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS mv
FROM ({_SKEWED})"""


def _hot_average(t, limit):
    order = ["day", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
    return W.moving_average(skewed(t), ["grp"], order, "px", {"mv": 5}, limit).select(*ROW, "grp", "mv")


@query("win_moving_avg_hot", _HOT_AVG)
def _(t):
    return _hot_average(t, 2_000)


@query("win_moving_avg_hot_plain", _HOT_AVG)
def _(t):
    return _hot_average(t, O.GROUP_LIMIT)


@query("winners_by_symbol", f"""
WITH s AS ({_SETTLED}),
     w AS (SELECT l_partkey, count(*) FILTER (final_status < 0) AS buyer_wins, count(*) FILTER (final_status > 0) AS seller_wins FROM s GROUP BY 1),
     a AS (SELECT l_partkey, avg(l_quantity) AS avg_qty FROM lineitem WHERE year(l_shipdate) BETWEEN 1997 AND 1999 GROUP BY 1)
SELECT l_partkey, buyer_wins, seller_wins, avg_qty FROM w JOIN a USING (l_partkey)""")
def _(t):
    wins = winners_by_symbol(_settled_columns(_settled(t)), ["l_partkey"], "final_status")
    rows = t.lineitem.filter(F.year("l_shipdate").between(1997, 1999))
    return wins.join(rows.groupBy("l_partkey").agg(F.avg("l_quantity").alias("avg_qty")), "l_partkey")


_CENTS = "round(l_extendedprice * 100)::BIGINT"
_MOVING = """
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey,
       avg({cents}) OVER (PARTITION BY {part} ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_partkey
             ROWS BETWEEN {a} PRECEDING AND CURRENT ROW) AS mv_{x}
       {more} FROM lineitem"""
_MORE = f""", avg({_CENTS}) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_partkey
             ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS mv_21"""


def _moving(t, part, preceding, **options):
    rows = t.lineitem.select("l_returnflag", *TAIL, F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    return W.moving_average(rows, part, TAIL, "cents", preceding, **options).select(*ROW, *preceding)


@query("win_moving_avg", _MOVING.format(cents=_CENTS, part="l_partkey", a=5, x=6, more=_MORE))
def _(t):
    return _moving(t, ["l_partkey"], {"mv_6": 5, "mv_21": 20})


@query("win_moving_avg_df", _MOVING.format(cents=_CENTS, part="l_partkey", a=3, x=4, more=""))
def _(t):
    return _moving(t, ["l_partkey"], {"mv_4": 3})


@query("win_moving_avg_blocks", _MOVING.format(cents=_CENTS, part="l_returnflag", a=5, x=6, more=""))
def _(t):
    return _moving(t, ["l_returnflag"], {"mv_6": 5}, group_limit=0)


_OVER = "OVER (PARTITION BY {part} ORDER BY {order})"


def _ranked(function, part="l_suppkey", order="l_quantity DESC", name="r", cast=""):
    over = _OVER.format(part=part, order=order)
    return f"SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, round({function} {over}, 9){cast} AS {name} FROM lineitem"


@query("win_row_number", f"""
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(TAIL)}) AS position FROM lineitem""")
def _(t):
    return O.with_position(t.lineitem, ["l_suppkey"], TAIL).select(*ROW, "position")


@query("win_row_number_chunked", f"""
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY {', '.join(TAIL)}) AS position FROM lineitem""")
def _(t):
    return O.with_position(t.lineitem, ["l_returnflag"], TAIL, group_limit=0).select(*ROW, "position")


@query("win_rank", _ranked("rank()", cast="::INTEGER"))
def _(t):
    return O.with_tie_functions(t.lineitem, ["l_suppkey"], ["l_quantity desc"], {"r": O.rank()}).select(*ROW, "r")


@query("win_dense_rank", """
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, (rank() OVER w)::INTEGER AS r, (dense_rank() OVER w)::INTEGER AS d
FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_quantity DESC)""")
def _(t):
    outputs = {"r": O.rank(), "d": O.dense_rank()}
    return O.with_tie_functions(t.lineitem, ["l_suppkey"], ["l_quantity desc"], outputs).select(*ROW, "r", "d")


@query("win_cume_dist", _ranked("cume_dist()", name="cd"))
def _(t):
    out = O.with_tie_functions(t.lineitem, ["l_suppkey"], ["l_quantity desc"], {"cd": O.cume_dist()})
    return out.select(*ROW, F.round("cd", 9).alias("cd"))


@query("win_percent_rank", _ranked("percent_rank()", name="pr"))
def _(t):
    out = O.with_tie_functions(t.lineitem, ["l_suppkey"], ["l_quantity desc"], {"pr": O.percent_rank()})
    return out.select(*ROW, F.round("pr", 9).alias("pr"))


_GLOBAL = """
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, round(percent_rank() OVER (ORDER BY {order}), 9) AS p_rank FROM lineitem"""


@query("win_percent_rank_global", _GLOBAL.format(order="l_extendedprice"))
def _(t):
    out = O.with_tie_functions(t.lineitem, [], ["l_extendedprice"], {"p_rank": O.percent_rank()})
    return out.select(*ROW, F.round("p_rank", 9).alias("p_rank"))


@query("percent_rank_distributed", _GLOBAL.format(order="l_extendedprice"))
def _(t):
    return W.percent_rank_distributed(t.lineitem, ["l_extendedprice"]).select(*ROW, F.round("p_rank", 9).alias("p_rank"))


@query("percent_rank_skewed", """
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, grp,
       round(percent_rank() OVER (PARTITION BY grp ORDER BY l_extendedprice), 9) AS p_rank
FROM (SELECT *, CASE WHEN l_partkey % 50 = 0 THEN l_partkey ELSE -1 END AS grp FROM lineitem)""")
def _(t):
    grp = F.when(F.col("l_partkey") % 50 == 0, F.col("l_partkey")).otherwise(F.lit(-1))
    out = W.percent_rank_skewed(t.lineitem.withColumn("grp", grp), ["grp"], ["l_extendedprice"])
    return out.select(*ROW, "grp", F.round("p_rank", 9).alias("p_rank"))


@query("max_percentile_by_key", """
SELECT l_suppkey, round(max(p), 9) AS best FROM
 (SELECT l_suppkey, percent_rank() OVER (ORDER BY l_extendedprice) AS p FROM lineitem) GROUP BY 1""")
def _(t):
    return K.max_percentile_by_key(t.lineitem, "l_suppkey", ["l_extendedprice"]).withColumn("best", F.round("best", 9))


_BOUNDS = f"""
SELECT l_returnflag, tile, min(l_extendedprice) AS low, max(l_extendedprice) AS high, count(*) AS n FROM
 (SELECT l_returnflag, l_extendedprice, (ntile(20) OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice, {', '.join(TAIL)}))::INTEGER AS tile FROM lineitem)
GROUP BY 1, 2"""


def _bounds(t, **options):
    tiled = O.with_ntile(t.lineitem, ["l_returnflag"], ["l_extendedprice", *TAIL], 20, **options)
    return tiled.groupBy("l_returnflag", "tile").agg(
        F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"), F.count(F.lit(1)).alias("n")
    )


@query("win_ntile_bounds", _BOUNDS)
def _(t):
    return _bounds(t)


@query("win_ntile_bounds_chunked", _BOUNDS)
def _(t):
    return _bounds(t, group_limit=0)


_LAGS = """
SELECT event_id, user_id, value, lag(value, 2) OVER w AS lag2, lag(value, 1) OVER w AS lag1,
       lead(value, 1) OVER w AS lead1, lead(value, 2) OVER w AS lead2
FROM events WINDOW w AS (PARTITION BY {part} ORDER BY ts)"""
_OFFSETS = {"lag2": -2, "lag1": -1, "lead1": 1, "lead2": 2}


@query("win_lead_lag", f"SELECT * FROM ({_LAGS.format(part='user_id')}) WHERE user_id % 3 = 0")
def _(t):
    out = W.neighbours(t.events, ["user_id"], ["ts"], "value", _OFFSETS)
    return out.filter(F.col("user_id") % 3 == 0).select("event_id", "user_id", "value", *_OFFSETS)


@query("win_lead_lag_blocks", _LAGS.format(part="event_type"))
def _(t):
    out = W.neighbours(t.events, ["event_type"], ["ts"], "value", _OFFSETS, group_limit=0)
    return out.select("event_id", "user_id", "value", *_OFFSETS)


@query("win_max_over", """
SELECT event_id, event_type, value, max(value) OVER (PARTITION BY event_type) AS top, lag(value) OVER (PARTITION BY event_type ORDER BY ts) AS previous
FROM events""")
def _(t):
    rows = W.neighbours(t.events.select("event_id", "event_type", "ts", "value"), ["event_type"], ["ts"], "value", {"previous": -1})
    return O.with_group_value(rows, ["event_type"], {"top": F.max("value")}).drop("ts")


@query("topk_two_phase", """
SELECT DISTINCT l_partkey, p_rank FROM (SELECT l_partkey, percent_rank() OVER (ORDER BY l_extendedprice) AS p_rank FROM lineitem)
ORDER BY p_rank DESC, l_partkey LIMIT 100""")
def _(t):
    return K.topk_percent_ranks(t.lineitem.select("l_partkey", "l_extendedprice"), "l_partkey", ["l_extendedprice"], 100)


@query("monotonic_id", "SELECT count(*) AS n, count(*) AS ids, true AS by_price FROM lineitem")
def _(t):
    """The ids are distinct and follow the order: no price has an id below one of a smaller price."""
    ordered = t.lineitem.select("l_extendedprice").orderBy("l_extendedprice").withColumn("id", F.monotonically_increasing_id())
    spans = ordered.groupBy("l_extendedprice").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"))
    before = W.neighbours(spans, [], ["l_extendedprice"], "high", {"previous": -1})
    return before.agg(
        F.sum("n").alias("n"), F.sum(F.col("high") - F.col("low") + 1).alias("ids"),
        F.every(F.col("previous").isNull() | (F.col("previous") < F.col("low"))).alias("by_price"))
