"""File sources: the directive CSV (SRC1), csv/json tables (SRC2), JSON with an
inferred schema (SRC3) and exported resource bundles (SRC6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from unitmesh.schemas import DIRECTIVE_COLUMNS


# The characters that Python's ``str.strip`` takes off.
_STRIPPED = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def trim_all(c) -> F.Column:
    """Strip leading/trailing whitespace of every kind (Python's ``str.strip``, Unicode
    spaces included), not only spaces as ``F.trim`` does."""
    return F.regexp_replace(c, rf"^{_STRIPPED}|{_STRIPPED}\z", "")


def read_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV as Python's csv module reads it: ``"`` quotes, ``""`` for a quote inside a
    quoted cell, line breaks inside quoted cells, no escape character. All columns text."""
    return (spark.read.option("header", header).option("quote", '"').option("escape", '"').option("multiLine", True)
            .option("encoding", "UTF-8").option("mode", "PERMISSIVE").csv(path))


def read_directives(spark: SparkSession, path: str, header: bool = True, extra_columns: int = 0) -> DataFrame:
    """SRC1: positional directive CSV (see :func:`read_csv`), every cell trimmed.

    Blank cells read as ''. Columns 0..8 are named as in :data:`DIRECTIVE_COLUMNS`; ``extra_columns`` more
    positional columns are kept as ``col9``... . A ``row_no`` column in the file
    gives the row order; without it the order is that of the read, which only a single
    file has (a quoted line break keeps it in one task), so several files raise an error.
    The reference's header sniffing always drops the first line, hence ``header=True``.
    """
    names = list(DIRECTIVE_COLUMNS) + [f"col{9 + i}" for i in range(extra_columns)]
    raw = read_csv(spark, path, header)
    has_row_no = "row_no" in raw.columns
    if not has_row_no and len(raw.inputFiles()) > 1:
        raise ValueError(f"{path} has several files and no row_no column: the order of the directives is unknown")
    cols = [c for c in raw.columns if c != "row_no"]
    renamed = [F.coalesce(trim_all(F.col(f"`{c}`")), F.lit("")).alias(names[i]) for i, c in enumerate(cols[:len(names)])]
    missing = [F.lit("").alias(n) for n in names[len(cols):]]
    row_no = (F.col("row_no").cast("long") if has_row_no else F.monotonically_increasing_id()).alias("row_no")
    return raw.select(row_no, *renamed, *missing)


def read_table(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """SRC2: csv (with header) or json; any other type gives an empty result."""
    if fmt == "csv":
        return read_csv(spark, path)
    if fmt == "json":
        return spark.read.json(path)
    return spark.createDataFrame([], T.StructType([]))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: JSON records with an inferred schema (see ``df.dtypes``)."""
    return spark.read.json(path)


def read_resources(spark: SparkSession, path: str, resource_type: str = "metadata") -> DataFrame:
    """SRC6: resources of one type from exported NDJSON bundles (``resourceType``)."""
    return spark.read.json(path).where(F.col("resourceType") == resource_type)


def read_store(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a table written by ``sinks.writers.store``. With the stored ``schema`` the
    partition columns keep their written type instead of an inferred one; filters
    on them prune folders."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)
