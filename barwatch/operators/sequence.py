"""Ordered per-series windows without putting a whole series in one task.

``Window.partitionBy(symbol).orderBy(ts)`` sends every bar of a symbol to a
single task; if one symbol holds a third of the table, that task holds a
third of the table. Instead we number rows per series in bounded pieces and
cut the series into fixed-size row blocks that carry a *halo*: the last
``halo`` rows of block b are copied into block b+1, flagged ``_halo``. A
window frame reaching at most ``halo`` rows back is then exact inside each
(series, block) partition, and the halo copies are dropped afterwards.

Steps, all DataFrame operations:
1. ``_chunk`` = order value // chunk width. For a bar series with unique
   timestamps a chunk holds at most width/interval rows, so the local
   ``row_number`` over (series, chunk) is bounded.
2. rows per (series, chunk) -> running sum over the chunk table (a few rows
   per series per week) gives each chunk's offset; ``_seq`` = offset + local
   row number - 1 is the exact 0-based position in the whole series.
3. ``_blk`` = _seq // block_rows, halo copies appended to the next block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from barwatch.session import materialize

DEFAULT_BLOCK_ROWS = 100_000
DEFAULT_CHUNK_SECONDS = 7 * 24 * 3600
HELPER_COLUMNS = ["_chunk", "_lrn", "_off", "_seq", "_blk", "_halo"]


def _order_number(df: DataFrame, order_col: str, chunk_seconds: int) -> Column:
    dtype = df.schema[order_col].dataType
    c = F.col(order_col)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(chunk_seconds * 1_000_000)).cast("long")
    if isinstance(dtype, DateType):
        return F.floor(F.unix_date(c) / F.lit(max(chunk_seconds // 86400, 1))).cast("long")
    return F.floor(c / F.lit(chunk_seconds)).cast("long")


def _not_null(c: str) -> Column:
    """A text for each value and one for NULL, so that equality on it is NULL-safe."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def with_sequence(df: DataFrame, keys: list[str], order_col: str,
                  chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Add ``_seq``: 0-based row position per series ordered by ``order_col``.

    ``df`` is read twice and should be a written table. Its rows are shuffled once,
    for the numbering inside chunks: the chunks' offsets are written, so Spark
    broadcasts them when they are small, and joins them on the columns that the
    rows are already partitioned by when they are not."""
    keys = list(keys)
    x = df.withColumn("_chunk", _order_number(df, order_col, chunk_seconds))
    names = [f"_k{i}" for i in range(len(keys) + 1)]
    x = x.withColumns({n: _not_null(k) for n, k in zip(names, [*keys, "_chunk"])})
    counts = x.groupBy(*names).agg(F.min("_chunk").alias("_c"), F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*names[:-1]).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(counts.select(*names, F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off")), "offsets")
    x = x.withColumn("_lrn", F.row_number().over(Window.partitionBy(*names).orderBy(order_col)))
    x = x.join(offsets, names)
    return x.withColumn("_seq", (F.col("_off") + F.col("_lrn") - 1).cast("long")).drop("_lrn", "_off", *names)


def blocked(df: DataFrame, keys: list[str], order_col: str, halo: int,
            block_rows: int = DEFAULT_BLOCK_ROWS,
            chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> tuple[DataFrame, Window]:
    """Return (rows with ``_seq``/``_blk``/``_halo``, window spec over a block).

    Any frame ``rowsBetween(-halo, 0)`` (or ``lag`` up to ``halo``) over the
    returned spec equals the same frame over the whole series for rows with
    ``_halo = false``. Drop the halo rows with :func:`unblock`.
    """
    if halo < 0 or halo >= block_rows:
        raise ValueError(f"halo must be in [0, block_rows): {halo} vs {block_rows}")
    keys = list(keys)
    x = with_sequence(df, keys, order_col, chunk_seconds)
    blk = F.floor(F.col("_seq") / F.lit(block_rows)).cast("long")
    own = F.struct(blk.alias("_blk"), F.lit(False).alias("_halo"))
    nxt = F.struct((blk + 1).alias("_blk"), F.lit(True).alias("_halo"))
    in_tail = (F.col("_seq") % F.lit(block_rows)) >= F.lit(block_rows - halo)
    copies = F.when(F.lit(halo > 0) & in_tail, F.array(own, nxt)).otherwise(F.array(own))
    x = (x.withColumn("_copy", F.explode(copies))
          .withColumn("_blk", F.col("_copy._blk"))
          .withColumn("_halo", F.col("_copy._halo"))
          .drop("_copy", "_chunk"))
    w = Window.partitionBy(*keys, "_blk").orderBy("_seq")
    return x, w


def unblock(df: DataFrame, keep_seq: bool = False) -> DataFrame:
    out = df.filter(~F.col("_halo"))
    drop = [c for c in HELPER_COLUMNS if c in out.columns and not (keep_seq and c == "_seq")]
    return out.drop(*drop)
