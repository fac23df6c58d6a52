"""FHIR bundle files to one row per resource.

A bundle's text is parsed once, into a VARIANT; entries, types, ids and later the
columns of the flat tables are paths into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelattice.schemas import RESOURCE_DDL, TABLES
from carelattice.session import freed_shuffles, open_folders, settings
from carelattice.sources.large_bundles import large_entries

_ENTRY_DDL = "entry array<struct<resource:string>>, _broken string"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
# Files of more bytes are split at their entries. A VARIANT holds up to 128 MB.
LARGE_FILE = 64 << 20
# Small files count by their size, not as 4 MB each, so a task that lands them reads many.
_PACKED = {"spark.sql.files.openCostInBytes": str(64 << 10)}


def read_bundles(spark: SparkSession, folder: str, pattern: str = "*.json", up_to: int | None = None) -> DataFrame:
    """Every file named like ``pattern`` directly in ``folder`` as (bundle_id, value), one bundle per file.

    An empty folder gives an empty DataFrame. A bundle is one string value, so files
    of more than a few megabytes are better read by :func:`read_resources`; ``up_to``
    leaves out those with more bytes.
    """
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=pattern)
    if up_to is not None:
        files = files.where(F.col("_metadata.file_size") <= up_to)
    return files.select(F.col("_metadata.file_path").alias("bundle_id"), "value")


def _type_of(resource: Column) -> Column:
    return F.try_variant_get(resource, "$.resourceType", "string")


def _from_text(text: Column) -> Column:
    """A resource's text as a VARIANT of the declared fields; of a repeated name the last counts."""
    kind = F.get_json_object(text, "$.resourceType")
    declared = F.when(F.lit(False), F.lit(None).cast("variant"))
    for spec in TABLES.values():
        fields = F.from_json(text, f"resourceType string, {RESOURCE_DDL[spec.resource_type]}")
        declared = declared.when(kind == spec.resource_type, F.to_variant_object(fields))
    return F.coalesce(F.try_parse_json(text), declared)


def _parsed(bundles: DataFrame, fields: str = "variant") -> DataFrame:
    """(bundle_id, value, resources, broken): the resources of every bundle, or that it has none to give.

    A resource is read as ``fields``, straight from the parsed bundle. What no VARIANT can
    hold, such as an object that repeats a name, or what has another shape than a bundle,
    is judged by the lenient JSON reader.
    """
    entries = F.try_variant_get(F.try_parse_json("value"), "$.entry", f"array<struct<resource:{fields}>>")
    read = bundles.select("bundle_id", "value", entries.alias("entries"))
    odd = F.col("entries").isNull() | F.exists("entries", lambda e: e.isNull())
    lenient = F.when(odd, F.from_json("value", _ENTRY_DDL, _OPTIONS))

    def resource(text: Column) -> Column:
        return _from_text(text) if fields == "variant" else F.try_variant_get(_from_text(text), "$", fields)

    return read.withColumn("lenient", lenient).select(
        "bundle_id", "value", F.col("lenient._broken").isNotNull().alias("broken"),
        F.when(~odd, F.col("entries.resource"))
        .when(F.col("lenient._broken").isNull(), F.transform("lenient.entry", lambda e: resource(e["resource"])))
        .alias("resources"))


def explode_bundles(bundles: DataFrame, table: str | None = None) -> DataFrame:
    """Readable bundles as (bundle_id, bundle_patient_id, position, resource_type, resource).

    ``resource`` is a VARIANT. ``bundle_patient_id`` is the id of the bundle's first
    patient. It is taken from the entry array before the explode, so no join or
    shuffle is needed. With ``table`` there are only the resources of its type, and
    ``resource`` is a struct of the fields its flattener reads, for which no VARIANT of
    the single resource is built.
    """
    if table is not None:
        return _explode_typed(bundles, TABLES[table].resource_type)
    # The outer explode matters: for a plain one Spark adds a filter on the array
    # and evaluates the whole parse again inside it. Bundles without entries
    # give one row without a type, which every consumer filters out.
    entries = F.transform("resources", lambda r: F.struct(_type_of(r).alias("resource_type"), r.alias("resource")))
    patient = F.get(F.filter("entries", lambda e: e["resource_type"] == "Patient"), F.lit(0))
    return (
        _parsed(bundles)
        .select("bundle_id", entries.alias("entries"))
        .select("bundle_id", "entries", F.try_variant_get(patient["resource"], "$.id", "string").alias("bundle_patient_id"))
        .select("bundle_id", "bundle_patient_id", F.posexplode_outer("entries").alias("position", "entry"))
        .select("bundle_id", "bundle_patient_id", "position", "entry.resource_type", "entry.resource")
    )


def _explode_typed(bundles: DataFrame, resource_type: str) -> DataFrame:
    """:func:`explode_bundles` for one type. Every entry is read by the type's fields, which hold the patient's id too."""
    fields = T.StructType.fromDDL(f"resourceType string, {RESOURCE_DDL[resource_type]}").simpleString()
    patient = F.get(F.filter("resources", lambda r: r["resourceType"] == "Patient"), F.lit(0))
    return (
        _parsed(bundles, fields)
        .select("bundle_id", "resources", patient["id"].alias("bundle_patient_id"))
        .select("bundle_id", "bundle_patient_id", F.posexplode_outer("resources").alias("position", "resource"))
        .select("bundle_id", "bundle_patient_id", "position", F.col("resource.resourceType").alias("resource_type"), "resource")
        .where(F.col("resource_type") == resource_type)
    )


def quarantine(bundles: DataFrame) -> DataFrame:
    """Bundles whose text is not readable JSON: (bundle_id, reason, value)."""
    return _parsed(bundles).where("broken").select("bundle_id", F.lit("malformed bundle").alias("reason"), "value")


def read_resources(spark: SparkSession, folder: str, pattern: str = "*.json",
                   large_file: int = LARGE_FILE) -> tuple[DataFrame, DataFrame]:
    """All resources of the bundle files in ``folder``, and the files that are not readable JSON.

    The first is as :func:`explode_bundles` gives it, the second (bundle_id, reason).
    Files of more than ``large_file`` bytes are read by many tasks each. Their
    positions count the entries that have a resource.
    """
    small = read_bundles(spark, folder, pattern, up_to=large_file)
    entries, unreadable = large_entries(spark, folder, pattern, large_file)
    large = entries.withColumn("resource", _from_text(F.col("resource"))).select(
        "bundle_id", "bundle_patient_id", "position", _type_of(F.col("resource")).alias("resource_type"), "resource")
    return (explode_bundles(small).unionByName(large),
            quarantine(small).select("bundle_id", "reason").unionByName(unreadable))


def misshapen(resources: DataFrame) -> DataFrame:
    """Resources in which a field read by the flattener has another shape than declared.

    The flattener keeps such a row with NULL in the field; this lists them for review,
    with ``resource`` as text.
    """
    if resources.schema["resource"].dataType.typeName() == "variant":
        resources = resources.withColumn("resource", F.to_json("resource"))
    broken = F.lit(None).cast("string")
    for spec in TABLES.values():
        ddl = f"{RESOURCE_DDL[spec.resource_type]}, _broken string"
        parsed = F.from_json("resource", ddl, _OPTIONS)["_broken"]
        broken = F.when(F.col("resource_type") == spec.resource_type, parsed).otherwise(broken)
    return resources.where(broken.isNotNull()).withColumn("reason", F.lit("field of another shape"))


def land_resources(resources: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write the exploded resources once, split by type, and read them back.

    Flattening seven types straight from the bundles would parse every bundle
    seven times. From this layout each type reads only its own folder, and nothing is
    parsed again: resources are kept as VARIANT. They are written by the tasks that
    made them, without a shuffle: a bundle exploded from one text is no larger than a
    VARIANT, and entries of larger files come from many tasks already. A task leaves
    one file per type. With ``mode="append"`` what was landed before stays.
    """
    spark = resources.sparkSession
    with settings(spark, open_folders(16) | _PACKED | freed_shuffles()):
        (
            resources.where(F.col("resource_type").isNotNull())
            .write.mode(mode).option("partitionOverwriteMode", "static").option("compression", "zstd")
            .partitionBy("resource_type")
            .parquet(path)
        )
    schema = "bundle_id string, bundle_patient_id string, position int, resource variant, resource_type string"
    return spark.read.schema(schema).parquet(path)
