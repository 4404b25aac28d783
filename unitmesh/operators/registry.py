"""Facility registry build (REG1, PRJ5-9), admin-level report (PRJ11) and the
terminology mappings (PRJ10, JON7, SET2, REG2).

The registry record is built per unit with column expressions only (``struct``,
``array``, ``transform``), so the build is one narrow pass over the units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from unitmesh.plans.joins import join_small

# Fixed values of the reference's facility record.
SYSTEM = "DHIS2"
LOCATION_SYSTEM = "nbs"
STATUS_TYPES = ("regulatory", "operating", "validity", "activity")
LOCATION_TYPES = ("latitude", "longitude", "address", "telecom")
TRACKING_TYPES = ("openingDate", "closingDate", "maintenanceDate", "nextMaintenanceDate")
POPULATION_PERIOD = "2004"
MAPPING_TYPE = 1
MAPPING_SYSTEM = 1
MAPPING_GROUP = 1


def _tv(value: Column, type_: str, system: str | None = None, **extra: Column) -> Column:
    fields = [value.cast("string").alias("value"), F.lit(type_).alias("type")]
    if system is not None:
        fields.append(F.lit(system).alias("system"))
    fields += [c.alias(k) for k, c in extra.items()]
    return F.struct(*fields)


def system_id(id_col: Column) -> Column:
    """SCL16: deterministic stand-in for the reference's random uuid: a UUID-shaped hash of the id."""
    h = F.sha2(F.concat(F.lit("facility:"), id_col), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def _ident(type_: str, value: Column) -> Column:
    return F.struct(F.lit(type_).alias("type"), value.cast("string").alias("value"), F.lit(SYSTEM).alias("system"))


def to_facility(units: DataFrame, sort: bool = False) -> DataFrame:
    """REG1: facility records from org units with ``ancestors`` array<struct<level,id,
    code,name>> and ``organisationUnitGroups`` array<struct<id,code,name,...>>.

    Fixed blocks as the reference builds them (the code identifier value is always
    empty); ancestors become ``administrativeUnits`` (level plus id/code/name
    identifiers, absent ones skipped); groups become ``authority`` entries after the
    ownership entry; empty ancestors / groups pass through as ``[]``; every other
    column passes through unchanged. ``sort=True`` orders the export by id (a
    range-partitioned global sort).
    """
    anc = F.col("ancestors")
    grp = F.col("organisationUnitGroups")
    admin = F.transform(anc, lambda a: F.struct(
        F.lit("level").alias("type"), a.getField("level").alias("value"),
        F.filter(F.array(_ident("id", a.getField("id")), _ident("code", a.getField("code")),
                         _ident("name", a.getField("name"))),
                 lambda i: i.getField("value").isNotNull()).alias("identifier")))
    ident_t = "array<struct<type:string,value:string,system:string>>"
    ownership = F.struct(F.lit("").alias("value"), F.lit("ownership").alias("type"),
                         F.lit(None).cast(ident_t).alias("identifier"), F.lit(None).cast("string").alias("system"))
    groups = F.transform(grp, lambda g: F.struct(
        F.lit("Yes").alias("value"), g.getField("name").alias("type"),
        F.filter(F.array(_ident("id", g.getField("id")), _ident("code", g.getField("code"))),
                 lambda i: i.getField("value").isNotNull()).alias("identifier"),
        F.lit(SYSTEM).alias("system")))
    blank = F.lit("")
    record = [
        system_id(F.col("id")).alias("systemid"),
        F.array(_tv(blank, "code", SYSTEM), _tv(F.col("name"), "name", SYSTEM), _tv(F.col("id"), "id", SYSTEM)).alias("identifier"),
        F.coalesce(admin, F.array()).alias("administrativeUnits"),
        F.array().cast("array<string>").alias("endpoint"),
        F.concat(F.array(ownership), F.coalesce(groups, F.array())).alias("authority"),
        F.array(*[_tv(blank, t) for t in STATUS_TYPES]).alias("status"),
        F.struct(F.array(*[_tv(blank, t, LOCATION_SYSTEM) for t in LOCATION_TYPES]).alias("current"),
                 F.array(*[_tv(blank, t, LOCATION_SYSTEM) for t in LOCATION_TYPES]).alias("historic")).alias("location"),
        F.array(_tv(blank, "catchment", LOCATION_SYSTEM, period=F.lit(POPULATION_PERIOD))).alias("population"),
        F.array(*[_tv(blank, t) for t in TRACKING_TYPES]).alias("tracking"),
    ]
    # PRJ8: every other key passes through; SCL15 arrays built with array/concat/filter/transform
    rest = [c for c in units.columns if c not in ("ancestors", "organisationUnitGroups")]
    passthrough = [F.col(c) for c in rest]
    empty_anc = F.when(F.size(anc) == 0, anc).alias("ancestors")
    empty_grp = F.when(F.size(grp) == 0, grp).alias("organisationUnitGroups")
    out = units.select(*record, *passthrough, empty_anc, empty_grp)
    return out.orderBy("id") if sort else out  # PRJ9 / SRT2


def admin_report(units: DataFrame, levels: int = 4) -> DataFrame:
    """PRJ11: Admin_1_name .. Admin_n_name (ancestor names by level), name, id."""
    def at_level(n: int):
        return lambda a: a.getField("level") == n

    cols = [F.get(F.filter("ancestors", at_level(n)), 0).getField("name").alias(f"Admin_{n}_name")
            for n in range(1, levels + 1)]
    return units.select(*cols, "name", "id")


def to_mappings(elements: DataFrame, name_col: str = "dataelement", short_col: str = "shortname") -> DataFrame:
    """PRJ10: data elements -> terminology mappings (name, shortname, type, system, group)."""
    return elements.select(
        *[c for c in ("id",) if c in elements.columns],
        F.col(name_col).cast("string").alias("name"), F.col(short_col).cast("string").alias("shortname"),
        F.lit(MAPPING_TYPE).alias("type"), F.lit(MAPPING_SYSTEM).alias("system"), F.lit(MAPPING_GROUP).alias("group"))


def new_terms(stored: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """JON7 / FIL12: incoming mappings whose key is not stored yet (anti-join)."""
    return join_small(incoming, stored.select(key).distinct(), key, "left_anti")


def upsert_terms(stored: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """REG2 / SET2: the first run stores everything; later runs add what is missing."""
    return stored.unionByName(new_terms(stored, incoming, key).select(*stored.columns))
