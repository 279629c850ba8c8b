"""What a row can be told of those before it, in runs of any length: parts of a run are checked at once and joined by summaries.

Rows are dealt by ranges of (run, order), so a part holds neighbours and a long
run has many parts. Within a part Spark's windows do the work; a part's summary
(its first and last run, the last row, the running value of the last run) is one
row, and a scan over the summaries of all parts gives each part what comes in
from those before. No task and no window holds more than a part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.operators.storage import stored

_PART, _RUN, _ORDER = "__part", "__run", "__order"


def parts_of(df: DataFrame, run: list[str], order: str | Column) -> DataFrame:
    """``df`` in parts by ranges, with the part's number, the run and the order as columns."""
    order = F.col(order) if isinstance(order, str) else order
    rows = df.withColumn(_RUN, F.struct(*[F.col(f"`{c}`") for c in run], F.lit(0).alias("__one"))).withColumn(_ORDER, F.struct(order.alias("o")))
    return stored(rows.repartitionByRange(_RUN, _ORDER).withColumn(_PART, F.spark_partition_id()), "parts")


def _bare(df: DataFrame) -> DataFrame:
    return df.drop(_PART, _RUN, _ORDER)


def with_previous(df: DataFrame, run: list[str], order: str | Column, values: list[str], name: str = "before") -> DataFrame:
    """Add ``name``: the struct of ``values`` of the row before in the run; null for a run's first row."""
    parts = parts_of(df, run, order)
    last = parts.groupBy(_PART).agg(F.max_by(F.struct(F.col(_RUN).alias("run"), F.struct(*[f"`{v}`" for v in values]).alias("row")), F.struct(_RUN, _ORDER)).alias("last"))
    came = last.select(_PART, F.lag("last").over(Window.orderBy(_PART)).alias("__came"))  # a row for each part
    own = Window.partitionBy(_PART).orderBy(_RUN, _ORDER)
    row = F.struct(F.col(_RUN).alias("run"), F.struct(*[f"`{v}`" for v in values]).alias("row"))
    joined = parts.withColumns({"__lag": F.lag(row).over(own)}).join(F.broadcast(came), _PART)
    before = F.coalesce("__lag", "__came")
    return _bare(joined.withColumn(name, F.when(before["run"].eqNullSafe(F.col(_RUN)), before["row"])).drop("__lag", "__came"))


def with_running(df: DataFrame, run: list[str], order: str | Column, value: Column, how: str, name: str = "running", following: bool = False) -> DataFrame:
    """Add ``name``: the ``max`` or ``min`` of ``value`` over the rows before in the run (after, with ``following``); null if there are none."""
    most, pick = (F.max, F.greatest) if how == "max" else (F.min, F.least)
    parts = parts_of(df.withColumn("__value", value), run, order)
    edge = F.min if following else F.max
    ends = parts.groupBy(F.col(_PART).alias("__p")).agg(edge(_RUN).alias("__out"), (F.max if following else F.min)(_RUN).alias("__in"))
    sums = parts.groupBy(_PART, _RUN).agg(most("__value").alias("__sum"))
    out = sums.join(F.broadcast(ends), (F.col(_PART) == F.col("__p")) & F.col(_RUN).eqNullSafe(F.col("__out"))).select(_PART, "__out", "__in", "__sum")  # a row for each part
    along = F.desc(_PART) if following else F.asc(_PART)
    scanned = out.withColumn("__sum", most("__sum").over(Window.partitionBy("__out").orderBy(along)))
    step = Window.orderBy(along)  # a row for each part
    came = scanned.select(_PART, F.col("__in"), F.lag("__out").over(step).alias("__from"), F.lag("__sum").over(step).alias("__came"))
    came = came.where(F.col("__from").eqNullSafe(F.col("__in"))).select(F.col(_PART).alias("__p"), "__in", "__came")
    window = Window.partitionBy(_PART, _RUN).orderBy(_ORDER)
    window = window.rowsBetween(1, Window.unboundedFollowing) if following else window.rowsBetween(Window.unboundedPreceding, -1)
    joined = parts.withColumn("__own", most("__value").over(window)).join(F.broadcast(came), (F.col(_PART) == F.col("__p")) & F.col(_RUN).eqNullSafe(F.col("__in")), "left")
    return _bare(joined.withColumn(name, pick("__own", "__came")).drop("__own", "__came", "__in", "__p", "__value"))
