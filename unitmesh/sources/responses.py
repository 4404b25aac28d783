"""Service response shapes: ``{headers, rows}`` tables (SRC4) and paged lists (SRC5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


# Most different headers a collection of responses may have.
MAX_HEADERS = 10_000


def header_names(responses: DataFrame) -> list[str]:
    """Column names from the headers of all responses: those of the first response in its
    order, then the others by place and name. One aggregate; only the names come back."""
    each = responses.select(F.posexplode(F.col("headers").getField("name")).alias("pos", "n")).where(F.col("n").isNotNull())
    names = each.groupBy("n").agg(F.min("pos").alias("pos")).orderBy("pos", "n").limit(MAX_HEADERS + 1).collect()
    if len(names) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers: name the columns")
    first = responses.select(F.col("headers").getField("name").alias("n")).first()
    known = list(dict.fromkeys(n for n in (first["n"] if first and first["n"] else []) if n is not None))
    return known + [r["n"] for r in names if r["n"] not in known]


def from_headers_rows(responses: DataFrame, kind: str | None = None, names: list[str] | None = None) -> DataFrame:
    """SRC4: one output row per entry of ``rows``, one column per header (``names``, or the
    headers of all responses). Each response's own header order places its values; a
    header a response lacks is NULL. Kind ``AGGREGATE`` yields no columns, as in the
    reference."""
    if kind == "AGGREGATE":
        return responses.select(F.explode("rows").alias("_r")).select()
    cols = names if names is not None else header_names(responses)
    own = F.col("headers").getField("name").alias("_own")
    exploded = responses.select(own, F.explode("rows").alias("_r"))
    place = lambda n: F.nullif(F.array_position("_own", n), F.lit(0))
    return exploded.select(*[F.get("_r", (place(n) - 1).cast("int")).alias(n) for n in cols])


def unwrap(pages: DataFrame, list_col: str = "organisationUnits") -> DataFrame:
    """SRC5: the records of a paged list ``{pager, <list_col>: [...]}``, one row each;
    an empty list gives no rows. The pager stays in the input."""
    return pages.select(F.explode(list_col).alias("_r")).select("_r.*")
