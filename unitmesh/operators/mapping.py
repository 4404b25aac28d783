"""Format mapping between the reporting system and the warehouse (PRJ1-4), location
enrichment (JON8) and the value-set query (FIL2). All narrow (map-only) except
the lookups, which are joins broadcast behind a size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from unitmesh.functions.decimals import decimal_text, to_decimal
from unitmesh.plans.joins import join_small, prefilter

# Fixed values of the reference: column names on both sides and default field lists.
TO_WAREHOUSE = {"orgUnit": "location", "attributeOptionCombo": "attribution",
                "categoryOptionCombo": "disaggregation"}
FROM_WAREHOUSE = {"location": "orgUnit", "locationId": "orgUnit", "attribution": "attributeOptionCombo",
                  "id": "dataElement", "disaggregation": "categoryOptionCombo"}
DEFAULT_FIELDS = {
    "dataElements": ["id", "name", "code", "valueType", "formName"],
    "organisationUnits": ["id", "name", "code", "openingDate", "closingDate", "created", "lastUpdated"],
}
IDENTIFIER_TYPE = "dhis2"


def to_warehouse(df: DataFrame) -> DataFrame:
    """PRJ1: reporting names -> warehouse names; absent columns are ignored.
    ``dataElement`` keeps its name (the reference maps it only on the way back)."""
    return df.withColumnsRenamed({k: v for k, v in TO_WAREHOUSE.items() if k in df.columns})


def _rename_map(columns: list[str]) -> dict[str, str]:
    out: dict[str, str] = {}
    taken = set(columns)
    for src, dst in FROM_WAREHOUSE.items():
        if src in columns and dst not in taken:
            out[src] = dst
            taken.add(dst)
    return out


def from_warehouse(df: DataFrame) -> DataFrame:
    """PRJ2: warehouse names -> reporting names (location or locationId -> orgUnit,
    attribution, id -> dataElement, disaggregation); absent columns are ignored."""
    return df.withColumnsRenamed(_rename_map(df.columns))


def from_warehouse_payload(df: DataFrame, column: str = "dataValues") -> DataFrame:
    """PRJ2 on a nested payload: rename inside each ``dataValues`` record; a payload
    without that column is returned unchanged."""
    if column not in df.columns:
        return df
    elem = df.schema[column].dataType.elementType
    names = [f.name for f in elem.fields]
    ren = _rename_map(names)
    return df.withColumn(column, F.transform(
        column, lambda x: F.struct(*[x.getField(n).alias(ren.get(n, n)) for n in names])))


def select_fields(df: DataFrame, resource: str, fields: list[str] | str | None = None) -> DataFrame:
    """PRJ3: keep the requested fields (comma list or list); the resource's default
    list when none is given. Requested fields the data lacks come back as NULL."""
    if isinstance(fields, str):
        fields = [f.strip() for f in fields.split(",") if f.strip()] or None
    wanted = fields or DEFAULT_FIELDS[resource]
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in wanted])


def identifier_array(resource: str, host: str, id_col: str = "id", keys: tuple[str, ...] = ("id", "name", "code")) -> Column:
    """PRJ4: array of {value, property, system, type} for id, name and code, in input
    key order. Name and code need an id (their system URL contains it); NULL means
    absent, so a NULL value gives no entry. The URLs are not encoded."""
    base = F.concat(F.lit(f"{host}/api/{resource}/"), F.col(id_col))  # SCL7
    entries = []
    for k in keys:
        v = F.col(k).cast("string")
        if k == "id":
            system = base
            cond = v.isNotNull()
        else:
            system = F.concat(base, F.lit(f"?fields=id,{k}&filter={k}:eq:"), v)
            cond = v.isNotNull() & F.col(id_col).isNotNull()
        entries.append(F.when(cond, F.struct(v.alias("value"), F.lit(k).alias("property"),
                                             system.alias("system"), F.lit(IDENTIFIER_TYPE).alias("type"))))
    return F.filter(F.array(*entries), lambda e: e.isNotNull())


def to_identifiers(df: DataFrame, resource: str, host: str, keep: list[str] | None = None) -> DataFrame:
    """PRJ4: one record per input row with ``identifier``; a resource the payload
    lacks (no id column) gives zero records."""
    if "id" not in df.columns:
        return df.sparkSession.createDataFrame([], T.StructType([T.StructField("identifier", T.ArrayType(
            T.StructType([T.StructField(n, T.StringType()) for n in ("value", "property", "system", "type")])))]))
    keys = tuple(c for c in df.columns if c in ("id", "name", "code"))
    return df.select(*(keep or []), identifier_array(resource, host, keys=keys).alias("identifier"))


def payload_identifiers(payload: DataFrame, resource: str, host: str) -> DataFrame:
    """PRJ4 on a whole payload ``{<resource>: [records]}`` (FIL13: the resource must be
    present): one record with ``identifier`` per list entry; zero records when the
    payload lacks the resource."""
    if resource not in payload.columns:
        return to_identifiers(payload.select(), resource, host)
    recs = payload.select(F.explode(resource).alias("_r")).select("_r.*")
    return to_identifiers(recs, resource, host)


def enrich_location(docs: DataFrame, units: DataFrame, location_col: str = "location") -> DataFrame:
    """JON8: add ``path`` of the unit whose id equals ``location.id``. All documents
    are kept; no match leaves the path NULL. Duplicate unit ids: the last by
    ``row_no`` (if given) wins, as in a list scanned to the end."""
    if "row_no" in units.columns:
        lookup = units.groupBy("id").agg(F.max_by("path", "row_no").alias("_path"))
    else:
        lookup = units.groupBy("id").agg(F.max("path").alias("_path"))
    lookup = lookup.withColumnRenamed("id", "_loc_id")
    j = join_small(docs.withColumn("_loc_id", F.col(f"{location_col}.id")), lookup, "_loc_id", "left")
    return j.withColumn(location_col, F.col(location_col).withField("path", F.col("_path"))).drop("_loc_id", "_path")


def data_values(values: DataFrame, members: DataFrame, data_set: str, org_units: DataFrame,
                start_period: int, end_period: int) -> DataFrame:
    """FIL2: values of the data set's elements, for the given units (sourceid), with
    start <= periodid <= end (both bounds inclusive)."""
    elems = members.where(F.col("dataset_id") == data_set).select("dataelementid").distinct()
    units = org_units.select(F.col("organisationunitid").alias("sourceid")).distinct()
    v = values.where(F.col("periodid").between(start_period, end_period))
    v = prefilter(prefilter(v, "dataelementid", elems), "sourceid", units)
    v = join_small(v, elems, "dataelementid", "left_semi")
    return join_small(v, units, "sourceid", "left_semi")


def scale_values(values: DataFrame, factors: DataFrame, key: str = "dataelementid",
                 value_col: str = "value", factor_col: str = "factor", cast_mode: str = "ansi") -> DataFrame:
    """UDF2 of the reference (a per-partition multiply by a value from a shipped file),
    as a join: ``scaled`` = value x factor of the row's key, as canonical decimal text.
    Rows without a factor keep a NULL ``scaled``. The factor table is broadcast when
    proven small; no UDF is involved."""
    f = factors.select(key, F.col(factor_col).cast("decimal(18,6)").alias("_factor"))
    j = join_small(values, f, key, "left")
    scaled = decimal_text(to_decimal(F.col(value_col), cast_mode) * F.col("_factor"))
    return j.withColumn("scaled", scaled).drop("_factor")
