"""Ordered scans per key that stay parallel inside a hot key.

A plain window ``partitionBy(key).orderBy(seq)`` hands all rows of a key to one
task. When one key owns a large share of the rows that task never ends. An
:class:`OrderedScan` therefore counts the keys first and cuts only the hot ones
into slices of consecutive positions. Each slice is scanned on its own, and what
the earlier slices contribute (a sum, a maximum, the last value, the last rows)
reaches it through a small carry table with one row per hot key and slice.

Without hot keys the plan is the plain window: one shuffle, one sort.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Defaults; a session may override them with the configuration keys below.
HOT_ROWS = 4_000_000  # a key with more rows than this is cut into slices of about that size
MAX_HOT = 10_000  # keys that may be cut; all others hold at most 1/MAX_HOT of the rows
MAX_SLICES = 4096  # slices of one key
CONF_HOT_ROWS = "tideline.scan.hotRows"

_SLICE = "_slice"


def epoch_micros(column: str | Column, data_type: T.DataType) -> Column:
    """Microseconds since the epoch; wall-clock timestamps count as UTC."""
    col = F.col(column) if isinstance(column, str) else column
    if isinstance(data_type, T.TimestampNTZType):
        days = F.unix_date(col.cast("date")).cast("long")
        clock = F.hour(col) * 3600 + F.minute(col) * 60
        fraction = (F.expr(f"extract(SECOND FROM {_sql_name(column)})") * 1_000_000).cast("long")
        return (days * 86_400 + clock) * F.lit(1_000_000).cast("long") + fraction
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(col)
    return col.cast("long")


def _sql_name(column: str | Column) -> str:
    if not isinstance(column, str):
        raise TypeError("a wall-clock timestamp must be given by column name")
    return f"`{column}`"


@dataclass(frozen=True)
class Sum:
    """Running sum, current row included; nulls count as nothing."""

    column: str

    def local(self, window):
        return F.sum(self.column).over(window.rowsBetween(Window.unboundedPreceding, 0))

    def total(self, order):
        return F.sum(self.column)

    def carry(self, total, before):
        return F.sum(total).over(before)

    def combine(self, local, carry, rank):
        return F.coalesce(local + carry, local, carry)


@dataclass(frozen=True)
class Count:
    """Running row count, current row included."""

    def local(self, window):
        return F.row_number().over(window).cast("long")

    def total(self, order):
        return F.count(F.lit(1))

    def carry(self, total, before):
        return F.sum(total).over(before)

    def combine(self, local, carry, rank):
        return local + F.coalesce(carry, F.lit(0).cast("long"))


@dataclass(frozen=True)
class Max:
    """Running maximum; ``before`` leaves the current row out."""

    column: str
    before: bool = False

    def local(self, window):
        end = -1 if self.before else 0
        return F.max(self.column).over(window.rowsBetween(Window.unboundedPreceding, end))

    def total(self, order):
        return F.max(self.column)

    def carry(self, total, before):
        return F.max(total).over(before)

    def combine(self, local, carry, rank):
        return F.greatest(local, carry)


@dataclass(frozen=True)
class Last:
    """Latest non-null value so far, current row included."""

    column: str

    def local(self, window):
        frame = window.rowsBetween(Window.unboundedPreceding, 0)
        return F.last(self.column, ignorenulls=True).over(frame)

    def total(self, order):
        pick = F.min_by if order.descending else F.max_by
        return pick(self.column, F.when(F.col(self.column).isNotNull(), F.struct(*order.columns)))

    def carry(self, total, before):
        return F.last(total, ignorenulls=True).over(before)

    def combine(self, local, carry, rank):
        return F.coalesce(local, carry)


@dataclass(frozen=True)
class Recent:
    """The last ``n`` values as an array, oldest first, current row included."""

    column: str
    n: int

    @property
    def tail(self):
        return self.n - 1

    def local(self, window):
        frame = window.rowsBetween(-(self.n - 1), 0)
        return F.collect_list(F.struct(F.col(self.column).alias("v"))).over(frame)

    def combine(self, local, carry, rank):
        both = local if carry is None else F.concat(F.coalesce(carry, F.array()), local)
        kept = F.slice(both, F.greatest(F.size(both) - self.n + 1, F.lit(1)), F.lit(self.n))
        return F.transform(kept, lambda x: x["v"])


@dataclass(frozen=True)
class Lag:
    """The value ``k`` rows earlier (later, in a descending scan), else null."""

    column: str
    k: int = 1

    @property
    def tail(self):
        return self.k

    def local(self, window):
        return F.lag(F.struct(F.col(self.column).alias("v")), self.k).over(window)

    def combine(self, local, carry, rank):
        if carry is None:
            return local["v"]
        # Row number r of the slice needs the (k - r + 1)-th last carried row.
        position = F.size(carry) - self.k + rank
        carried = F.when((rank <= self.k) & (position >= 1), F.get(carry, position.cast("int") - 1))
        return F.coalesce(local, carried)["v"]


@dataclass(frozen=True)
class _Order:
    columns: tuple[str, ...]
    descending: bool

    def by(self, reverse: bool = False) -> list[Column]:
        down = self.descending != reverse
        return [F.col(c).desc() if down else F.col(c).asc() for c in self.columns]


class OrderedScan:
    """Chainable running computations over one key and order.

    ``order`` must be total within a key (end it with a unique column) and start
    with a number or timestamp. ``descending`` scans from the last row back,
    which turns :class:`Lag` into a lead. Where ``df`` is costly to compute twice,
    ``measure`` names a cheaper relation with the keys and the first order column
    whose key counts and positions are about the same; it decides where to cut,
    never what the result is.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: list[str],
        order: list[str],
        *,
        descending: bool = False,
        measure: DataFrame | None = None,
        hot_rows: int | None = None,
        max_hot: int = MAX_HOT,
        max_slices: int = MAX_SLICES,
    ):
        spark = df.sparkSession
        limit = hot_rows or int(spark.conf.get(CONF_HOT_ROWS, str(HOT_ROWS)))
        self.keys = list(keys)
        self.order = _Order(tuple(order), descending)
        self.sliced, self.df = _cut_hot_keys(
            df, df if measure is None else measure, self.keys, order[0], limit, max_hot, max_slices
        )

    def add(self, **specs) -> "OrderedScan":
        """Adds one column per spec; later calls may use earlier columns."""
        group = self.keys + ([_SLICE] if self.sliced else [])
        window = Window.partitionBy(*group).orderBy(*self.order.by())
        out = self.df
        local = {f"_l_{name}": spec.local(window) for name, spec in specs.items()}
        if self.sliced:
            local["_rank"] = F.row_number().over(window)
        out = out.withColumns(local)
        if self.sliced:
            carry = self._carry(specs)
            out = out.join(carry, group, "left")
        done = {
            name: spec.combine(
                F.col(f"_l_{name}"),
                F.col(f"_c_{name}") if self.sliced else None,
                F.col("_rank") if self.sliced else None,
            )
            if self.sliced or hasattr(spec, "tail")
            else F.col(f"_l_{name}")
            for name, spec in specs.items()
        }
        kept = self.df.columns
        self.df = out.select(*kept, *[c.alias(n) for n, c in done.items()])
        return self

    def derive(self, **columns: Column) -> "OrderedScan":
        """Adds row-wise columns between two scans without losing the slices."""
        self.df = self.df.withColumns(columns)
        return self

    def result(self) -> DataFrame:
        return self.df.drop(_SLICE, "_hot")

    def _carry(self, specs) -> DataFrame:
        """What the earlier slices of each hot key hand to a slice."""
        hot = self.df.where("_hot")
        group = [*self.keys, _SLICE]
        totals = {n: s for n, s in specs.items() if not hasattr(s, "tail")}
        tails = {n: s for n, s in specs.items() if hasattr(s, "tail")}
        down = F.col(_SLICE).desc() if self.order.descending else F.col(_SLICE).asc()
        ordered = Window.partitionBy(*self.keys).orderBy(down)
        before = ordered.rowsBetween(Window.unboundedPreceding, -1)
        parts = []
        if totals:
            sums = hot.groupBy(*group).agg(
                *[s.total(self.order).alias(f"_t_{n}") for n, s in totals.items()]
            )
            parts.append(
                sums.select(
                    *group, *[s.carry(f"_t_{n}", before).alias(f"_c_{n}") for n, s in totals.items()]
                )
            )
        if tails:
            depth = max(s.tail for s in tails.values())
            # Spark pushes the rank filter below the shuffle (WindowGroupLimit).
            last = Window.partitionBy(*group).orderBy(*self.order.by(reverse=True))
            values = {n: F.struct(F.col(s.column).alias("v")) for n, s in tails.items()}
            ends = (
                hot.select(*group, *self.order.columns, *[v.alias(f"_v_{n}") for n, v in values.items()])
                .withColumn("_back", F.row_number().over(last))
                .where(F.col("_back") <= depth)
                .groupBy(*group)
                .agg(
                    F.sort_array(
                        F.collect_list(
                            F.struct((-F.col("_back")).alias("_p"), *[F.col(f"_v_{n}") for n in tails])
                        )
                    ).alias("_ends")
                )
            )
            # The last rows before a slice lie in the last `depth` slices that have rows.
            frame = ordered.rowsBetween(-depth, -1)
            lists = ends.select(*group, F.flatten(F.collect_list("_ends").over(frame)).alias("_ends"))
            parts.append(
                lists.select(
                    *group,
                    *[F.col("_ends").getField(f"_v_{n}").alias(f"_c_{n}") for n in tails],
                )
            )
        return parts[0] if len(parts) == 1 else parts[0].join(parts[1], group)


def _cut_hot_keys(df, measure, keys, position, limit, max_hot, max_slices):
    """Adds ``_slice`` and ``_hot`` when some key of ``measure`` has more than ``limit`` rows."""
    counted = F.count(F.lit(1)).alias("_n")
    if keys:
        present = [F.col(k).isNotNull() for k in keys]
        counts = measure.groupBy(*keys).agg(counted).where(F.col("_n") > limit)
        for condition in present:
            counts = counts.where(condition)
        # At most max_hot rows reach the driver, however many keys there are.
        top = counts.orderBy(F.desc("_n")).limit(max_hot).collect()
    else:
        top = [row for row in measure.agg(counted).collect() if row["_n"] > limit]
    if not top:
        return False, df

    spark = df.sparkSession
    kind = df.schema[position].dataType
    pos = epoch_micros(position, kind) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.col(position)
    key_fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    most = max(r["_n"] for r in top)
    fine = max(2, min(max_slices, math.ceil(most / limit)))
    fractions = [i / fine for i in range(1, fine)]
    hot = spark.createDataFrame(
        [tuple(r[k] for k in keys) + (max(1, round(fine * r["_n"] / most)),) for r in top],
        T.StructType([*key_fields, T.StructField("_parts", T.IntegerType())]),
    )
    ranked = measure.select(*keys, pos.alias("_pos"))
    if keys:
        ranked = ranked.join(F.broadcast(hot), keys)  # bounded by max_hot rows
    else:
        ranked = ranked.withColumn("_parts", F.lit(fine))
    bounds = (
        ranked.groupBy(*keys, "_parts")
        .agg(F.percentile_approx("_pos", fractions, 8 * fine).alias("_b"))
        .select(
            *keys,
            F.expr(
                f"array_sort(array_distinct(filter(_b, (b, i) -> "
                f"floor((i + 1) * _parts / {fine}) > floor(i * _parts / {fine}))))"
            ).alias("_b"),
        )
        .collect()
    )
    rows = []
    for row in bounds:
        cuts = row["_b"]
        step = max(1, math.isqrt(len(cuts)))
        groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
        rows.append((*[row[k] for k in keys], [g[-1] for g in groups], groups, step))
    pos_type = ranked.schema["_pos"].dataType
    array = T.ArrayType(pos_type)
    lookup = spark.createDataFrame(
        rows,
        T.StructType(
            [
                *key_fields,
                T.StructField("_ends", array),
                T.StructField("_groups", T.ArrayType(array)),
                T.StructField("_step", T.IntegerType()),
            ]
        ),
    )
    out = df.withColumn("_pos", pos)
    if keys:
        out = out.join(F.broadcast(lookup), keys, "left")
    else:
        only = rows[0]
        out = out.withColumns(
            {
                "_ends": F.lit(only[0]),
                "_groups": F.array(*[F.lit(g) for g in only[1]]),
                "_step": F.lit(only[2]),
            }
        )
    # Two steps of about sqrt(slices) comparisons: the group first, then the cut inside it.
    group = F.size(F.filter("_ends", lambda e: e < F.col("_pos")))
    inner = F.size(
        F.filter(F.coalesce(F.get("_groups", F.col("_g")), F.array().cast(array)), lambda b: b < F.col("_pos"))
    )
    out = (
        out.withColumn("_hot", F.col("_ends").isNotNull())
        .withColumn("_g", group)
        .withColumn(_SLICE, F.when(F.col("_hot"), F.col("_g") * F.col("_step") + inner).otherwise(F.lit(0)))
    )
    return True, out.select(*df.columns, "_hot", _SLICE)
