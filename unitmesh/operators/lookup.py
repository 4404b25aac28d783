"""Document find by JSON filter (FIL7), JSON validity (FIL8), code-prefix search (FIL9)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from unitmesh.session import ship_package

_OPS = {"$gt": "__gt__", "$gte": "__ge__", "$lt": "__lt__", "$lte": "__le__"}


def _field(df: DataFrame, path: str) -> tuple[Column, T.DataType]:
    """A top-level column, a nested struct field (also of the structs in an array), or a
    field inside a JSON text column (``props.k`` where ``props`` holds JSON text); and its
    type. A field that is not there is NULL in every row."""
    head, _, rest = path.partition(".")
    found = head in df.columns
    if found and rest and isinstance(df.schema[head].dataType, T.StringType):
        return F.get_json_object(F.col(head), "$." + rest), T.StringType()
    kind = df.schema[head].dataType if found else None
    for name in rest.split(".") if found and rest else ():
        inner = kind.elementType if isinstance(kind, T.ArrayType) else kind
        if not isinstance(inner, T.StructType) or name not in inner.names:
            found = False
            break
        kind = T.ArrayType(inner[name].dataType) if isinstance(kind, T.ArrayType) else inner[name].dataType
    return (F.col(path), kind) if found else (F.lit(None).cast("string"), T.StringType())


def _is_number(v) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def _as(c: Column, kind: T.DataType, v) -> Column:
    """``c`` in the type of the value ``v``. What is not a number (or not a truth value) is
    NULL there and simply does not match; nor does a list or record equal a text."""
    if _is_number(v):
        return c.try_cast("double") if isinstance(kind, (T.NumericType, T.StringType)) else F.lit(None).cast("double")
    if isinstance(v, bool):
        if isinstance(kind, T.StringType):
            return F.when(c.isin("true", "false"), c == "true")
        return c if isinstance(kind, T.BooleanType) else F.lit(None).cast("boolean")
    return F.lit(None).cast("string") if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else c


def _matches(df: DataFrame, path: str, v, test) -> Column:
    """Whether the field, or any element of it where it is an array, passes ``test``."""
    c, kind = _field(df, path)
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.exists(c, lambda x: F.coalesce(test(_as(x, kind.elementType, v), F.lit(v)), F.lit(False))), F.lit(False))
    return F.coalesce(test(_as(c, kind, v), F.lit(v)), F.lit(False))


def _equal(df: DataFrame, path: str, v) -> Column:
    if v is None:
        c, kind = _field(df, path)
        return c.isNull() | F.coalesce(F.exists(c, lambda x: x.isNull()), F.lit(False)) if isinstance(kind, T.ArrayType) else c.isNull()
    if isinstance(v, dict):
        return filter_condition(df, {f"{path}.{k}": x for k, x in v.items()})
    if isinstance(v, list):
        c, kind = _field(df, path)
        if not isinstance(kind, T.ArrayType) or any(isinstance(x, (list, dict)) for x in v):
            return F.lit(False)
        same = F.size(c) == len(v)
        for k, x in enumerate(v):
            e = F.get(c, k)
            same = same & (e.isNull() if x is None else _as(e, kind.elementType, x) == F.lit(x))
        return F.coalesce(same, F.lit(False))
    return _matches(df, path, v, lambda left, right: left == right)


def filter_condition(df: DataFrame, flt: dict) -> Column:
    """Fold a filter document into one Column: equality per key (null matches a missing
    value, as all values of a field that does not exist are; a nested document matches
    field by field, a scalar an array that has it as an element, a list an array equal to
    it), implicit AND, dotted paths into structs or JSON text, and the operators $gt $gte
    $lt $lte $ne $in."""
    cond = F.lit(True)
    for key, spec in flt.items():
        if isinstance(spec, dict) and spec and all(k.startswith("$") for k in spec):
            for op, v in spec.items():
                if op == "$in":
                    c = F.lit(False)
                    for x in v:
                        c = c | _equal(df, key, x)
                elif op == "$ne":
                    c = ~_equal(df, key, v)
                elif op in _OPS:
                    c = _matches(df, key, v, lambda left, right, o=op: getattr(left, _OPS[o])(right))
                else:
                    raise ValueError(f"unsupported operator {op}")
                cond = cond & c
        else:
            cond = cond & _equal(df, key, spec)
    return cond


def find(df: DataFrame, filter_json: str | None = None) -> DataFrame:
    """FIL7: documents matching a JSON filter; without one all documents. A filter that is
    not a JSON object raises ValueError. The filter is a small parameter parsed on the
    driver; Spark evaluates it."""
    if not filter_json:
        return df
    flt = json.loads(filter_json)
    if not isinstance(flt, dict):
        raise ValueError("a filter is a JSON object")
    return df.where(filter_condition(df, flt))


def is_valid_json_text(s: str | None) -> bool:
    """Python's ``json.loads`` accepts it (so ``NaN`` is valid, trailing text is not). Text
    nested too deep for it and whole numbers of more digits than Python converts (4,300
    unless set otherwise), at which it raises, are not valid."""
    if s is None:
        return False
    try:
        json.loads(s)
    except (ValueError, RecursionError):
        return False
    return True


@F.pandas_udf(T.BooleanType())
def _json_loads_ok(s: pd.Series) -> pd.Series:
    return s.map(is_valid_json_text).astype(bool)


_BLANK = r"[ \t\n\r]*"
# Numbers and literals (Python's NaN and Infinity included), and texts without escapes.
_SIMPLE_JSON = rf'^{_BLANK}(?:-?(?:0|[1-9][0-9]{{0,4000}})(?:[.][0-9]+)?(?:[eE][+-]?[0-9]+)?|-?Infinity|NaN|true|false|null|"[^"\\\x00-\x1f]*+"){_BLANK}\z'
# How a list, a record or a text with escapes begins and ends; very long whole numbers.
_MAY_BE_JSON = rf'^{_BLANK}(?:\[(?s:.*)\]|\{{(?s:.*)\}}|"(?s:.*)"|-?[1-9][0-9]{{4000}}(?s:.*)){_BLANK}\z'


def is_valid_json(c: Column, exact: bool = True) -> Column:
    """FIL8: whether the text is valid JSON.

    ``exact`` (default) is what Python's ``json.loads`` says, as in the reference (see
    :func:`is_valid_json_text`). Scalars are settled by pattern, and so is what does not
    begin and end like JSON; only lists, records and texts with escapes go to Python, in
    Arrow batches. ``exact=False`` stays in the JVM with ``try_parse_json``, which differs
    on ``NaN`` (rejected) and on trailing text (accepted).
    """
    if exact:
        ship_package()
        simple = F.coalesce(c.rlike(_SIMPLE_JSON), F.lit(False))
        return simple | F.coalesce(_json_loads_ok(F.when(~simple & c.rlike(_MAY_BE_JSON), c)), F.lit(False))
    return F.try_parse_json(c).isNotNull()


def _values(df: DataFrame, columns: list[str], keep: list[str], test) -> DataFrame:
    """``keep``, ``property`` and ``value`` for the values of ``columns`` that pass ``test``;
    each element of an array column is a value of its own."""
    def hits(c: str) -> Column:
        values = F.col(c) if isinstance(df.schema[c].dataType, T.ArrayType) else F.array(F.col(c))
        found = F.filter(F.coalesce(values.cast("array<string>"), F.array().cast("array<string>")),
                         lambda x: F.coalesce(test(x), F.lit(False)))
        return F.transform(found, lambda x: F.struct(F.lit(c).alias("property"), x.alias("value")))

    return df.select(*keep, F.explode(F.concat(*map(hits, columns))).alias("_h")).select(*keep, "_h.property", "_h.value")


def code_search(df: DataFrame, prefix: str, columns: list[str], keep: list[str]) -> DataFrame:
    """FIL9: flat results: one row per value that starts with ``prefix``
    (case-insensitive), with its record and property; each element of an array column is
    a value of its own."""
    p = F.lit(prefix.lower())
    return _values(df, columns, keep, lambda x: F.startswith(F.lower(x), p))


# Column of a prefix index that it is sorted by.
INDEXED = "lowered"


def prefix_index(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """FIL9 as an index to be stored: a row for every value of ``columns``, dealt by ranges
    of the lower-cased value and sorted by it, so that each file and row group holds a
    range. The value takes part in the ranges' bounds with its record, so a value that a
    third of all records share is still several files."""
    values = _values(df, columns, keep, lambda x: x.isNotNull()).withColumn(INDEXED, F.lower("value"))
    return values.repartitionByRange(INDEXED, *keep).sortWithinPartitions(INDEXED)


def after_prefix(prefix: str) -> str | None:
    """The smallest text above all that start with ``prefix``, in order of code points
    (which is that of their UTF-8 bytes); None if there is none."""
    for k in range(len(prefix) - 1, -1, -1):
        c = ord(prefix[k])
        if c < 0x10FFFF:
            return prefix[:k] + chr(0xE000 if c == 0xD7FF else c + 1)
    return None


def prefix_search(index: DataFrame, prefix: str) -> DataFrame:
    """:func:`code_search` on a stored :func:`prefix_index`: the prefix becomes a range of
    the sorted column, which reaches the scan, so files and row groups outside it are not
    read."""
    low, high = prefix.lower(), after_prefix(prefix.lower())
    found = index.where(F.col(INDEXED) >= low)
    return (found if high is None else found.where(F.col(INDEXED) < high)).drop(INDEXED)
