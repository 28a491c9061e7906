"""Small shared pieces of the llm operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwatch.plans.catalog import table as read_table  # noqa: F401  (re-exported for the queries)

#: Words are runs of anything but these six ASCII blanks.
BLANKS = "[\\x20\\x09-\\x0D]+"


def words_of(text: Column) -> Column:
    """Array of the words of a text; NULL gives an empty array."""
    return F.coalesce(F.array_remove(F.split(text, BLANKS), ""), F.array().cast("array<string>"))


def crc_mod(id_col: Column, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m``."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(m)


def replace_columns(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns; an input column of the same name (in any case) gives way."""
    taken = {c.lower() for c in cols}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken],
                     *[c.alias(n) for n, c in cols.items()])


def held(cols: list[str]) -> Column:
    """Columns of the caller as one struct ``held``: an operator works beside it,
    so none of its own column names can meet one of the caller's. A struct needs a
    field, hence the first."""
    return F.struct(F.lit(True).alias("any"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)]).alias("held")


def held_type(src: DataFrame) -> str:
    """The ``held`` column as a field of a schema."""
    return f"held {src.schema['held'].dataType.simpleString()}"


def unheld(cols: list[str]) -> list[Column]:
    """The caller's columns out of ``held``, under their own names."""
    return [F.col(f"held.c{i}").alias(c) for i, c in enumerate(cols)]


def numbered(docs: DataFrame, *named: str) -> tuple[DataFrame, list[str]]:
    """(the table with its columns under the names c0, c1, ...; the new names of
    ``named``). For operators that stay in the JVM and add columns beside the
    caller's: none of theirs is called like that."""
    at = [c.lower() for c in docs.columns]
    return (docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]),
            [f"c{at.index(n.lower())}" for n in named])


def renamed(docs: DataFrame, results: dict[str, Column]) -> list[Column]:
    """The columns of ``docs`` back from :func:`numbered`, then the results; a column named like a result gives way."""
    taken = {r.lower() for r in results}
    return [*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in taken],
            *[c.alias(n) for n, c in results.items()]]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application; they need
    not find it on their own path."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="barwatch-")) / "barwatch.zip"       # the driver serves it from here
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)


def arrow_batch_rows(spark: SparkSession, rows: int) -> None:
    """Called before Python runs on executors: ships the package and sets the
    rows per Arrow batch, which bounds what one worker holds of long texts."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
