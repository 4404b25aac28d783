"""Schemas of the registry tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T

# Fact table: one reported value. Logical key within a site:
# (dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid).
DATAVALUE = T.StructType([
    T.StructField("dataelementid", T.IntegerType()),
    T.StructField("periodid", T.IntegerType()),
    T.StructField("sourceid", T.IntegerType()),
    T.StructField("categoryoptioncomboid", T.IntegerType()),
    T.StructField("value", T.StringType()),
    T.StructField("storedby", T.StringType()),
    T.StructField("lastupdated", T.TimestampNTZType()),
    T.StructField("comment", T.StringType()),
    T.StructField("followup", T.BooleanType()),
    T.StructField("attributeoptioncomboid", T.IntegerType()),
    T.StructField("created", T.TimestampNTZType()),
    T.StructField("deleted", T.BooleanType()),
])
DATAVALUE_COLUMNS = [f.name for f in DATAVALUE.fields]
VALUE_KEY = ["dataelementid", "periodid", "categoryoptioncomboid", "attributeoptioncomboid"]

ORGUNIT = T.StructType([
    T.StructField("organisationunitid", T.IntegerType()),
    T.StructField("uid", T.StringType()),
    T.StructField("parentid", T.IntegerType()),
])

DATAELEMENT = T.StructType([
    T.StructField("dataelementid", T.IntegerType()),
    T.StructField("valuetype", T.StringType()),
])

# Site directive file, positional: operation, uid, name, parent uid, new name,
# latitude, longitude, short name, code (all text), plus the row number.
DIRECTIVE_COLUMNS = ["op", "uid", "name", "parent_uid", "new_name", "lat", "lon", "shortname", "code"]
DIRECTIVE = T.StructType([T.StructField(c, T.StringType()) for c in DIRECTIVE_COLUMNS])

# Flat site snapshot used by the directive jobs (parent given by its uid).
SNAPSHOT_COLUMNS = ["id", "name", "shortName", "code", "parent_id", "openingDate",
                    "featureType", "coordinates", "created"]
