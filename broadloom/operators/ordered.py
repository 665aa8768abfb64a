"""Ordered window functions over groups of any size.

A plain ``Window.partitionBy(key).orderBy(x)`` sorts each key in one task, which
fails when a single key (or an empty partition list) holds a large share of the
rows.  Every operator here counts the groups first.  Groups within
``group_limit`` are plain windows.  Larger ones, and only these, are cut into
chunks of the order's values, in the same plan and the same shuffle:

* cut points come from a sample of the large groups and are written as a table,
  one row per group, so the chunk of a row is a lookup by its values and task
  retries cannot move rows; the table is bounded by the rows over the limit;
* a value that fills chunks of its own is a chunk by itself and is dealt to many
  tasks: its rows are equal in the order, so they need no sorting;
* functions run inside (key, chunk) and the totals of the earlier chunks, one row
  per chunk, are added by a broadcast lookup; ROWS frames and lag/lead cut large
  groups into blocks of consecutive positions and copy the few rows a frame
  reaches across a block edge.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadloom.session import materialised

GROUP_LIMIT = 4_000_000
BLOCK_ROWS = 500_000
#: Rows a group is cut at, where no limit says so.
_LEAST_CHUNK = 1_000
_SAMPLES_PER_CHUNK = 32
#: Chunks a task gets on average, where no limit says so: with a few only, hashing leaves some tasks with a multiple of others.
_TASK_CHUNKS = 8
_CASE_CUTS = 16
#: Tasks a value that fills a chunk is dealt to, at most.
_SPREAD = 64
#: What tells a chunk or an uncut group, the number that differs most first: sorts compare it before all else.
_LOCAL = ["__chunk", "__gid", "__cold"]


@dataclass(frozen=True)
class OrderKey:
    """One ORDER BY item; nulls come first ascending and last descending."""

    name: str
    ascending: bool = True

    @property
    def sort(self) -> Column:
        column = F.col(f"`{self.name}`")
        return column.asc() if self.ascending else column.desc()


def order_keys(order: Sequence[str]) -> list[OrderKey]:
    """Parse ``["day", "qty desc"]`` into order keys."""
    keys = []
    for item in order:
        name, _, direction = item.strip().partition(" ")
        direction = direction.strip().lower()
        if direction not in ("", "asc", "desc"):
            raise ValueError(f"unknown sort direction in {item!r}")
        keys.append(OrderKey(name, direction != "desc"))
    return keys


def ordered_window(part: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*part).orderBy(*[key.sort for key in order_keys(order)])


# --------------------------------------------------------------------------
# group sizes and cut points


@dataclass(frozen=True)
class GroupStats:
    total: int
    largest: int


def group_stats(df: DataFrame, part: Sequence[str], group_limit: int = 0) -> GroupStats:
    """Row total and largest group: counts only, one row to the driver.

    A plain count comes first (parquet footers answer it); grouping follows only
    if the total leaves room for a group beyond a positive ``group_limit``.
    Otherwise the total stands in as the bound of the largest group.
    """
    total = df.count()
    if not part or group_limit <= 0 or total <= group_limit:
        return GroupStats(total, total)
    counts = df.groupBy(*part).agg(F.count(F.lit(1)).alias("n"))
    return GroupStats(total, counts.agg(F.max("n")).first()[0])


@dataclass(frozen=True)
class Cuts:
    """``table``: __key, __gid (a number of its own) and __cuts (in order: the values r0, r1, … as ``_runs`` has them and
    whether one value fills chunks) of every group that is cut; ``most``: a bound of the cuts of one group; ``total``: all
    rows, of cut groups and others."""

    table: DataFrame
    most: int
    total: int


def hot_cuts(df: DataFrame, part: Sequence[str], order: Sequence[str], group_limit: int = GROUP_LIMIT, chunks: int | None = None) -> Cuts | None:
    """Cut points of the groups beyond ``group_limit`` (as the sample estimates them), None if there is none.

    Chunks have about half the limit's rows; ``chunks`` asks for so many of the
    whole table instead (for tests).  Without a limit, chunks are as large as
    keeps all tasks busy.  Two jobs: the row total (from the files' footers, where
    there are any), which settles most tables, and a sample of about
    ``_SAMPLES_PER_CHUNK`` rows a chunk, which tells the large groups and places
    their cuts.  Every row is still processed, wherever the cuts lie.
    """
    spark, total = df.sparkSession, df.count()
    if chunks:
        rows = max(1, total // chunks)
    elif group_limit > 0:
        rows = max(1, group_limit // 2)
    else:
        rows = max(_LEAST_CHUNK, total // (_TASK_CHUNKS * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))
    limit = max(group_limit, rows)
    if total <= limit:
        return None
    names = [key.name for key in order_keys(order)]
    rate = min(1.0, _SAMPLES_PER_CHUNK / rows)
    step = max(1, round(rate * rows))
    sample = df.select(*{c: F.col(f"`{c}`") for c in [*part, *names]}.values())
    if rate < 1:
        sample = sample.sample(fraction=rate, seed=17)
    values = [f"v{i}" for i in range(len(names))]
    sort = [F.col(v).asc() if key.ascending else F.col(v).desc() for v, key in zip(values, order_keys(order))]
    keyed = with_key(sample, part).select("__key", *[F.col(f"`{n}`").alias(v) for v, n in zip(values, names)])
    picked = keyed.withColumn("at", F.row_number().over(Window.partitionBy("__key").orderBy(*sort))).filter(F.col("at") % step == 0)
    each = picked.groupBy("__key", *values).agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("picks"))
    cut = F.struct("at", *_runs(order, values), (F.col("picks") > 1).alias("fills"))
    lists = each.groupBy("__key").agg(F.sum("picks").alias("picks"), F.array_sort(F.collect_list(cut)).alias("__cuts"))
    table = materialised(lists.filter(F.col("picks") >= max(1, limit // rows)).select(
        "__key", F.monotonically_increasing_id().alias("__gid"), "__cuts"), "cuts")
    # A sample of s rows has its size within s / 2 + 64, as good as always.
    return None if table.isEmpty() else Cuts(table, int(1.5 * total / rows) + 64, total)


def _directions(order: Sequence[str]) -> list[tuple[bool, list[int]]]:
    """Neighbouring order keys of one direction: (ascending, their numbers)."""
    return [(up, [i for i, _ in run]) for up, run in groupby(enumerate(order_keys(order)), lambda item: item[1].ascending)]


def _runs(order: Sequence[str], columns: Sequence[str]) -> list[Column]:
    """The columns of the order keys as one struct for each run of one direction, r0, r1, …

    Two structs compare as their rows sort, by one short function of compiled code; a test of every
    column, written out, is too long for the compiler to translate and took ten times as long a row."""
    return [F.struct(*[F.col(f"`{columns[i]}`").alias(f"v{i}") for i in run]).alias(f"r{k}") for k, (_, run) in enumerate(_directions(order))]


def _reached(order: Sequence[str], cut: str) -> str:
    """SQL test that the row of the structs ``__r0``, ``__r1``, … sorts at or after the cut."""
    test = ""
    for k, (up, _) in reversed([*enumerate(_directions(order))]):
        here, there = f"__r{k}", f"{cut}.r{k}"
        test = (f"({there} {'<' if up else '>'} {here} OR ({there} <=> {here} AND {test}))" if test
                else f"{there} {'<=' if up else '>='} {here}")
    return test


def _placed(df: DataFrame, part: Sequence[str], order: Sequence[str], cuts: Cuts, spread: bool) -> DataFrame:
    """``df`` with __hot (its group is cut), __gid (that group's number), __cold (the key of any other group), __chunk and __salt.

    ``_LOCAL`` tells a chunk or an uncut group.  Keys are compared for each step of a sort: a cut group's is a number there,
    as comparing its key took most of a sort's time.  A chunk's number is even between cuts and odd for a value that fills chunks;
    ``spread`` deals the rows of the latter to several tasks."""
    runs = _runs(order, [key.name for key in order_keys(order)])
    rows = with_key(df, part).join(F.broadcast(cuts.table), "__key", "left").withColumn("__at", F.lit(0))
    # Search by two bits a step (one, if the tests are long).  The structs and each step are an element of their own,
    # so that they are compiled code and no rule of the optimizer puts the steps into each other.
    rows = rows.withColumn("__row", F.explode(F.array(F.struct(*runs)))).select("*", *[F.col(f"__row.r{k}").alias(f"__r{k}") for k in range(len(runs))])
    width = 2 if len(runs) <= 2 else 1
    for bit in reversed(range(0, cuts.most.bit_length(), width)):
        counted = []
        for k in range(1, 1 << width):
            ahead = k << bit
            test = _reached(order, f"get(__cuts, __at + {ahead - 1})")
            counted.append(f"CASE WHEN __at + {ahead} <= size(__cuts) AND {test} THEN {1 << bit} ELSE 0 END")
        rows = rows.withColumn("__next", F.explode(F.expr(f"array(__at + {' + '.join(counted)})"))).drop("__at").withColumnRenamed("__next", "__at")
    same = " AND ".join(f"__r{k} <=> get(__cuts, __at - 1).r{k}" for k in range(len(runs)))
    filled = F.expr(f"__at > 0 AND get(__cuts, __at - 1).fills AND {same}")
    rows = rows.select(
        *[F.col(f"`{c}`") for c in df.columns], F.col("__cuts").isNotNull().alias("__hot"),
        "__gid", F.when(F.col("__cuts").isNull(), F.col("__key")).alias("__cold"),
        (2 * F.col("__at") - F.when(filled, 1).otherwise(0)).alias("__chunk"))
    salt = F.when(F.col("__chunk") % 2 == 1, F.spark_partition_id() % _SPREAD) if spread else F.lit(0)
    return rows.withColumn("__salt", F.coalesce(salt, F.lit(0)))


def _literal(value, dtype: T.DataType) -> str:
    """SQL text of a sampled value (timestamps arrive as micros or text)."""
    if value is None:
        return "NULL"
    if isinstance(dtype, T.TimestampType):
        return f"timestamp_micros({int(value)}L)"
    text = str(value).lower() if isinstance(value, bool) else str(value)
    quoted = "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dtype, T.StringType):
        return quoted
    return f"CAST({quoted} AS {dtype.simpleString()})"


def _portable(name: str, dtype: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column).alias(name)
    if isinstance(dtype, (T.TimestampNTZType, T.DateType, T.DecimalType, T.FloatType)):
        return column.cast("string").alias(name)
    return column


def _at_or_after(keys: list[OrderKey], cut: Sequence[str]) -> str:
    """SQL test that the row sorts at or after the cut given as SQL terms."""
    name, term = f"`{keys[0].name}`", cut[0]
    if keys[0].ascending:
        after = f"({name} > {term} OR ({term} IS NULL AND {name} IS NOT NULL))"
    else:
        after = f"({term} IS NOT NULL AND ({name} < {term} OR {name} IS NULL))"
    same = f"{name} <=> {term}"
    if len(keys) > 1:
        same = f"({same} AND {_at_or_after(keys[1:], cut[1:])})"
    return f"({after} OR {same})"


def chunk_column(df: DataFrame, order: Sequence[str], cuts: list[tuple]) -> Column:
    """Number of cuts at or before the row, found by binary search.

    A few cuts become a balanced CASE.  Many travel as one folded array literal
    per order key, so the generated code does not grow with their number.
    """
    keys = order_keys(order)
    if not cuts:
        return F.lit(0)
    literals = [
        [_literal(cut[i], df.schema[key.name].dataType) for i, key in enumerate(keys)] for cut in cuts
    ]
    if len(cuts) <= _CASE_CUTS:
        return F.expr(_case(keys, literals, 0, len(cuts)))
    arrays = [f"'k{i}', array({', '.join(cut[i] for cut in literals)})" for i in range(len(keys))]
    terms = [f"get(__c.k{i}, __p + __s - 1)" for i in range(len(keys))]  # no lambda variable may hide a column
    steps = [str(1 << bit) for bit in reversed(range(len(cuts).bit_length()))]
    search = (
        f"aggregate(array({', '.join(steps)}), 0, (__p, __s) -> "
        f"CASE WHEN __p + __s <= {len(cuts)} AND {_at_or_after(keys, terms)} THEN __p + __s ELSE __p END)"
    )
    return F.expr(f"get(transform(array(named_struct({', '.join(arrays)})), __c -> {search}), 0)")


def _case(keys: list[OrderKey], literals: list[list[str]], low: int, high: int) -> str:
    if low == high:
        return str(low)
    middle = (low + high + 1) // 2
    test = _at_or_after(keys, literals[middle - 1])
    return f"CASE WHEN {test} THEN {_case(keys, literals, middle, high)} ELSE {_case(keys, literals, low, middle - 1)} END"


def with_key(df: DataFrame, columns: Sequence[str], name: str = "__key") -> DataFrame:
    """The columns as one struct, in which a NULL equals a NULL.

    Grouping, windows and joins on it share one partitioning: a null-safe join
    condition on the columns would shuffle all rows again after a window.
    """
    return df.withColumn(name, F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(0))


def join_back(df: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on null-safe keys, keeping ``df``'s key columns."""
    if not keys:
        raise ValueError("a join back needs keys")
    renamed = side.select(
        *[F.col(f"`{k}`").alias(f"__k_{k}") for k in keys],
        *[F.col(f"`{c}`") for c in side.columns if c not in keys],
    )
    condition = None
    for key in keys:
        test = df[f"`{key}`"].eqNullSafe(renamed[f"`__k_{key}`"])
        condition = test if condition is None else condition & test
    return df.join(renamed, condition).drop(*[f"__k_{k}" for k in keys])


# --------------------------------------------------------------------------
# functions whose value is shared by ties


@dataclass(frozen=True)
class TieFunction:
    """A ranking function or RANGE running sum, in plain and chunked form."""

    kind: str
    measure: Column | None = None

    def plain(self, window: WindowSpec) -> Column:
        if self.kind == "running_sum":
            return F.sum(self.measure).over(window)
        if self.kind == "group_max":
            return F.max(self.measure).over(window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        return getattr(F, self.kind)().over(window)


def rank() -> TieFunction:
    return TieFunction("rank")


def dense_rank() -> TieFunction:
    return TieFunction("dense_rank")


def percent_rank() -> TieFunction:
    return TieFunction("percent_rank")


def cume_dist() -> TieFunction:
    return TieFunction("cume_dist")


def running_sum(measure: Column | str) -> TieFunction:
    """Sum of ``measure`` from the group's start through the row's ties.

    Whole numbers and decimals add exactly, with the same type for groups of any
    size.  Sums of doubles depend on the order of addition in their last digits,
    in a plain window as in a chunked one: cast to a decimal where that matters.
    """
    return TieFunction("running_sum", F.col(measure) if isinstance(measure, str) else measure)


def group_max(measure: Column | str) -> TieFunction:
    """The greatest ``measure`` of the whole group."""
    return TieFunction("group_max", F.col(measure) if isinstance(measure, str) else measure)


def with_tie_functions(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    outputs: dict[str, TieFunction],
    group_limit: int = GROUP_LIMIT,
    chunks: int | None = None,
) -> DataFrame:
    """Add ranking functions / RANGE running sums to every row of ``df``.

    One shuffle of the rows.  Runs a count up front, and, if that leaves room for
    a group beyond ``group_limit``, the jobs of ``hot_cuts``.
    """
    cuts = hot_cuts(df, part, order, group_limit, chunks)
    if cuts is None:
        window = ordered_window(part, order)
        return df.select("*", *[fn.plain(window).alias(name) for name, fn in outputs.items()])
    names = [key.name for key in order_keys(order)]
    rows = _placed(df, part, order, cuts, spread=True)
    carried = _carried(rows, names, outputs)
    local = ordered_window([*_LOCAL, "__salt"], order)
    asked = {fn.kind for fn in outputs.values()}
    more = [F.rank().over(local).alias("__rank")] if asked & {"rank", "percent_rank"} else [F.lit(None).cast("int").alias("__rank")]
    more.append((F.count(F.lit(1)).over(local) if "cume_dist" in asked else F.lit(None).cast("long")).alias("__upto"))
    inside = rows.select("*", *more, *[fn.plain(local).alias(f"__in_{name}") for name, fn in outputs.items()])
    # One row per chunk of a large group: bounded by the rows over the limit.
    joined = inside.join(F.broadcast(carried), ["__gid", "__chunk"], "left")
    fills = F.col("__chunk") % 2 == 1
    first = F.col("__n_off") + F.col("__rank")
    formulas = {
        "rank": first.cast("int"),
        "percent_rank": F.when(F.col("__n_all") > 1, (first - 1) / (F.col("__n_all") - 1)).otherwise(F.lit(0.0)),
        "cume_dist": (F.col("__n_off") + F.when(fills, F.col("__n")).otherwise(F.col("__upto"))) / F.col("__n_all"),
    }
    kinds = dict(inside.dtypes)

    def value(name: str, fn: TieFunction) -> Column:
        plain = F.col(f"__in_{name}")
        if fn.kind == "dense_rank":
            cut = F.col("__d_off") + plain
        elif fn.kind == "group_max":
            cut = F.col(f"__all_{name}")
        elif fn.kind == "running_sum":
            here, before = F.when(fills, F.col(f"__m_{name}")).otherwise(plain), F.col(f"__off_{name}")
            cut = F.when(before.isNull(), here).when(here.isNull(), before).otherwise(here + before)
        else:
            cut = formulas[fn.kind]
        return F.when(F.col("__hot"), cut.cast(kinds[f"__in_{name}"])).otherwise(plain).alias(name)

    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[value(n, fn) for n, fn in outputs.items()])


def _carried(rows: DataFrame, names: Sequence[str], outputs: dict[str, TieFunction]) -> DataFrame:
    """Per chunk of a cut group: its totals, those of the chunks before it, and those of the whole group."""
    measures = {name: fn for name, fn in outputs.items() if fn.measure is not None}
    agg = {"running_sum": F.sum, "group_max": F.max}
    hot = rows.filter("__hot")
    distinct = any(fn.kind == "dense_rank" for fn in outputs.values())
    totals = [F.count(F.lit(1)).alias("__n"), *[agg[fn.kind](fn.measure).alias(f"__m_{n}") for n, fn in measures.items()]]
    if distinct:
        hot = hot.groupBy("__gid", "__chunk", *[F.col(f"`{n}`").alias(f"__v{i}") for i, n in enumerate(names)]).agg(*totals)
        totals = [F.sum("__n").alias("__n"), F.count(F.lit(1)).alias("__d"), *[agg[fn.kind](f"__m_{n}").alias(f"__m_{n}") for n, fn in measures.items()]]
    per_chunk = hot.groupBy("__gid", "__chunk").agg(*totals)
    group = Window.partitionBy("__gid")
    earlier = group.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    more = [F.coalesce(F.sum("__d").over(earlier), F.lit(0)).alias("__d_off")] if distinct else []
    for name, fn in measures.items():
        more.append(F.sum(f"__m_{name}").over(earlier).alias(f"__off_{name}") if fn.kind == "running_sum"
                    else F.max(f"__m_{name}").over(group).alias(f"__all_{name}"))
    return per_chunk.select(
        "__gid", "__chunk", "__n", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n_off"),
        F.sum("__n").over(group).alias("__n_all"), *[F.col(f"__m_{n}") for n in measures], *more)


# --------------------------------------------------------------------------
# positions on a unique order


def with_position(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    total: str | None = None,
    group_limit: int = GROUP_LIMIT,
    chunks: int | None = None,
) -> DataFrame:
    """1-based row number per group; ``order`` must identify a row.

    ``total`` names an optional column with the size of the row's group.
    """
    return _with_position(df, part, order, name, total, hot_cuts(df, part, order, group_limit, chunks))


def _with_position(df: DataFrame, part: Sequence[str], order: Sequence[str], name: str, total: str | None, cuts: Cuts | None) -> DataFrame:
    if cuts is None:
        window = ordered_window(part, order)
        extra = [F.count(F.lit(1)).over(Window.partitionBy(*part)).alias(total)] if total else []
        return df.select("*", F.row_number().over(window).cast("long").alias(name), *extra)
    rows = _placed(df, part, order, cuts, spread=False)
    size = [F.count(F.lit(1)).over(Window.partitionBy(*_LOCAL)).alias("__size")] if total else []
    numbered = _numbered(rows.select("*", *size), _carried(rows, [], {}), order, name)
    extra = [F.coalesce("__n_all", "__size").alias(total)] if total else []
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"`{name}`"), *extra)


def _numbered(rows: DataFrame, carried: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Placed rows with their position in the group."""
    inside = rows.select("*", F.row_number().over(ordered_window(_LOCAL, order)).alias("__rn"))
    joined = inside.join(F.broadcast(carried), ["__gid", "__chunk"], "left")
    return joined.withColumn(name, (F.col("__rn") + F.coalesce("__n_off", F.lit(0))).cast("long"))


def with_ntile(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    n: int,
    name: str = "tile",
    group_limit: int = GROUP_LIMIT,
    chunks: int | None = None,
) -> DataFrame:
    """Tile number 1..n; earlier tiles take the remainder, as in SQL."""
    rows = with_position(df, part, order, "__pos", "__size", group_limit, chunks)
    base = F.floor(F.col("__size") / n)
    spare = F.col("__size") % n
    zero_based = F.col("__pos") - 1
    in_large = spare * (base + 1)
    tile = F.when(zero_based < in_large, F.floor(zero_based / (base + 1))).otherwise(
        F.floor((zero_based - in_large) / F.greatest(base, F.lit(1))) + spare
    )
    return rows.withColumn(name, (tile + 1).cast("int")).drop("__pos", "__size")


# --------------------------------------------------------------------------
# ROWS frames, lag and lead


def with_row_frames(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    outputs: dict[str, Callable[[WindowSpec], Column]],
    before: int = 0,
    after: int = 0,
    group_limit: int = GROUP_LIMIT,
    block_rows: int = BLOCK_ROWS,
    chunks: int | None = None,
) -> DataFrame:
    """Add columns computed over frames reaching ``before``/``after`` rows.

    ``outputs`` maps a name to a function of the ordered window, for instance
    ``lambda w: F.avg("close").over(w.rowsBetween(-5, 0))``.
    """
    def plainly(rows: DataFrame) -> DataFrame:
        window = ordered_window(part, order)
        return rows.select("*", *[make(window).alias(name) for name, make in outputs.items()])

    cuts = hot_cuts(df, part, order, group_limit, chunks)
    if cuts is None:
        return plainly(df)
    rows = _placed(df, part, order, cuts, spread=False).where("__hot")
    carried = materialised(_carried(rows, [], {}), "carried")
    small = None
    # The chunks' totals tell whether there is an uncut group at all; looking for one would read all rows once more.
    if part and carried.agg(F.sum("__n")).first()[0] != cuts.total:
        hot = F.broadcast(cuts.table.select("__key"))
        small = plainly(with_key(df, part).join(hot, "__key", "left_anti").drop("__key"))
    block_rows = max(block_rows, before, after, 1)
    placed = _numbered(rows, carried, order, "__pos").select(*[F.col(f"`{c}`") for c in df.columns], "__gid", "__pos")
    zero_based = F.col("__pos") - 1
    block = F.floor(zero_based / block_rows)
    offset = zero_based % block_rows
    # Constant lists: an array made for each row, and cleared of its nulls, is interpreted code.
    to_next, to_previous = offset >= block_rows - before, (offset < after) & (block > 0)
    shifts = (
        F.when(to_next & to_previous, F.expr("array(0, 1, -1)")).when(to_next, F.expr("array(0, 1)"))
        .when(to_previous, F.expr("array(0, -1)")).otherwise(F.expr("array(0)")))
    spread = placed.withColumn("__shift", F.explode(shifts)).withColumn("__block", block + F.col("__shift"))
    window = ordered_window(["__block", "__gid"], ["__pos"])
    framed = spread.select("*", *[make(window).alias(name) for name, make in outputs.items()])
    kept = framed.filter(F.col("__shift") == 0).select(*[F.col(f"`{c}`") for c in df.columns], *outputs)
    return kept if small is None else small.unionByName(kept)


def with_group_value(df: DataFrame, part: Sequence[str], outputs: dict[str, Column]) -> DataFrame:
    """Attach whole-group aggregates to every row.

    Partial aggregation shrinks a hot group before the shuffle, and the join
    back can be split by adaptive execution; a window could not.
    """
    totals = df.groupBy(*part).agg(*[agg.alias(name) for name, agg in outputs.items()])
    return join_back(df, totals, list(part))
