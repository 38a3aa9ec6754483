"""Field metadata of a dataset: the declared type mapping per column, joined
with what the data holds, as a table (one row per column).

The type map is small by construction (one entry per Spark type name), so
it is a broadcast lookup table; the data side is one aggregate over the
dataset followed by a ``stack`` into rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.typenames import type_key

# Default dataset type per Spark type name.
DEFAULT_TYPE_MAP: dict[str, dict[str, str]] = {
    "integer": {"dataset_type": "Numeric", "precision": "10", "scale": "0"},
    "long": {"dataset_type": "Numeric", "precision": "18", "scale": "0"},
    "float": {"dataset_type": "Numeric", "precision": "14", "scale": "4"},
    "double": {"dataset_type": "Numeric", "precision": "14", "scale": "4"},
    "short": {"dataset_type": "Numeric", "precision": "10", "scale": "0"},
    "date": {"dataset_type": "Date", "format": "yyyy-MM-dd"},
    "timestamp": {"dataset_type": "Date", "format": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"},
    "string": {"dataset_type": "Text"},
}
# Type of an unmapped Spark type, and the largest scale allowed.
FALLBACK_TYPE = "Text"
MAX_SCALE = 6

# What a type-map entry may say.
ENTRY_KEYS = {"dataset_type", "precision", "scale", "format", "defaultValue", "canTruncateValue"}

_MAP_SCHEMA = T.StructType(
    [
        T.StructField("type_name", T.StringType(), False),
        T.StructField("dataset_type", T.StringType(), True),
        T.StructField("precision", T.StringType(), True),
        T.StructField("scale", T.StringType(), True),
        T.StructField("format", T.StringType(), True),
        T.StructField("default_value", T.StringType(), True),
        T.StructField("can_truncate", T.StringType(), True),
    ]
)


def merged_type_map(user: str | dict | None = None) -> dict[str, dict[str, str]]:
    """Default map with the user's entries; a user entry replaces a whole type.
    An entry needs its ``dataset_type`` and may only have the known keys."""
    extra = json.loads(user) if isinstance(user, str) else dict(user or {})
    for name, entry in extra.items():
        if not isinstance(entry, dict) or not entry.get("dataset_type"):
            raise ValueError(f"type map: {name!r} has no dataset_type")
        if unknown := sorted(set(entry) - ENTRY_KEYS):
            raise ValueError(f"type map: {name!r} has unknown keys {unknown}")
    return {**DEFAULT_TYPE_MAP, **extra}


def type_map_table(spark: SparkSession, user: str | dict | None = None) -> DataFrame:
    m = merged_type_map(user)
    rows = [
        (name, e.get("dataset_type"), e.get("precision"), e.get("scale"), e.get("format"),
         e.get("defaultValue"), e.get("canTruncateValue"))
        for name, e in sorted(m.items())
    ]
    return spark.createDataFrame(rows, _MAP_SCHEMA)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _digits(v) -> F.Column:
    """Decimal digits of a non-negative integral value (null stays null)."""
    return F.length(v.cast("string"))


def _fraction_digits(text) -> F.Column:
    """Digits after the point of a number's shortest text, exponent included:
    ``1.25E-4`` has 6 (``0.000125``), ``1.5E10`` has 0."""
    mantissa = F.split_part(text, F.lit("E"), F.lit(1))
    digits = F.length(F.rtrim(F.split_part(mantissa, F.lit("."), F.lit(2)), F.lit("0")))
    exponent = F.when(text.contains("E"), F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")).otherwise(F.lit(0))
    return F.greatest(digits - exponent, F.lit(0))


def _stats(df: DataFrame) -> DataFrame:
    """One row per column: max text length, nulls, integer and fraction digits.

    Integral columns need only ``min`` and ``max``: text length and digit count
    grow with the magnitude, so the extremes give them without turning every
    value into text.  Other columns turn each value into text once (a
    projection the aggregate reads)."""
    texts, aggs, entries = [], [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"_n{i}"))
        if isinstance(f.dataType, _INTEGRAL):
            texts.append(c.cast("long").alias(f"_s{i}"))
            v = F.col(f"_s{i}")
            aggs += [F.min(v).alias(f"_lo{i}"), F.max(v).alias(f"_hi{i}")]
            lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
            length = F.greatest(F.length(lo.cast("string")), F.length(hi.cast("string")))
            whole = F.greatest(F.length(F.ltrim(lo.cast("string"), F.lit("-"))),
                               F.length(F.ltrim(hi.cast("string"), F.lit("-"))))
            frac = F.when(hi.isNotNull(), F.lit(0))
        else:
            texts.append(c.cast("string").alias(f"_s{i}"))
            v = F.col(f"_s{i}")
            aggs.append(F.max(F.length(v)).alias(f"_l{i}"))
            length = F.col(f"_l{i}")
            whole = frac = F.lit(None).cast("int")
            if isinstance(f.dataType, _FRACTIONAL):
                texts.append(F.abs(c).alias(f"_a{i}"))
                aggs += [F.max(F.col(f"_a{i}")).alias(f"_m{i}"), F.max(_fraction_digits(v)).alias(f"_f{i}")]
                whole = _digits(F.floor(F.col(f"_m{i}")).try_cast(T.DecimalType(38, 0)))
                frac = F.col(f"_f{i}")
        entries.append(
            F.struct(
                F.lit(f.name).alias("column"),
                length.cast("long").alias("max_length"),
                F.col(f"_n{i}").cast("long").alias("null_count"),
                whole.cast("long").alias("int_digits"),
                frac.cast("long").alias("frac_digits"),
            )
        )
    nulls_src = [F.col(f.name) for f in df.schema.fields]
    return (
        df.select(*nulls_src, *texts)
        .agg(*aggs)
        .select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
    )


def declared_fields(df: DataFrame, dataset: str, type_map: str | dict | None = None) -> DataFrame:
    """Per column, the declared mapping only (from the schema and the type
    map; no pass over the data)."""
    spark = df.sparkSession
    fields = spark.createDataFrame(
        [(i, f.name, f"{dataset}.{f.name}", type_key(f.dataType)) for i, f in enumerate(df.schema.fields)],
        "position int, column string, full_name string, type_name string",
    )
    tmap = type_map_table(spark, type_map)
    declared = fields.join(F.broadcast(tmap), "type_name", "left")
    has_precision = F.col("precision").isNotNull()
    return declared.select(
        "position",
        "column",
        "full_name",
        F.col("type_name").alias("spark_type"),
        F.coalesce(F.col("dataset_type"), F.lit(FALLBACK_TYPE)).alias("dataset_type"),
        F.col("precision").cast("int").alias("precision"),
        F.when(has_precision, F.coalesce(F.col("scale"), F.lit("0"))).cast("int").alias("scale"),
        F.when(has_precision, F.coalesce(F.col("default_value"), F.lit("0"))).alias("default_value"),
        "format",
        "can_truncate",
    )


def field_profile(df: DataFrame, dataset: str, type_map: str | dict | None = None) -> DataFrame:
    """Per column: declared mapping (dataset type, precision, scale, format,
    default, truncation flag) and data facts (max length, nulls, digits) with
    ``fits`` = the integer digits fit ``precision - scale``."""
    declared = declared_fields(df, dataset, type_map)
    prof = declared.join(_stats(df), "column")
    fits = F.when(
        F.col("dataset_type") == F.lit("Numeric"),
        F.coalesce(F.col("int_digits"), F.lit(0)) <= F.col("precision") - F.col("scale"),
    ).otherwise(F.lit(True))
    return prof.withColumn("fits", fits)


def scale_violations(profile: DataFrame) -> DataFrame:
    """Columns whose declared scale is above the allowed maximum."""
    return profile.where(F.col("scale") > F.lit(MAX_SCALE)).select("column", "scale")


def check_declared(schema: T.StructType, type_map: str | dict | None = None) -> None:
    """The same checks as ``check_profile`` from the schema and type map alone
    (metadata only, no Spark job)."""
    entries = declared_entries(schema, type_map)
    _refuse(sum((e["scale"] or 0) > MAX_SCALE for e in entries), sum(e["dataset_type"] == FALLBACK_TYPE for e in entries))


def _refuse(wide: int, texts: int) -> None:
    if wide:
        raise ValueError(f"{wide} numeric columns declare a scale of more than {MAX_SCALE} digits")
    if not texts:
        raise ValueError("a dataset needs at least one Text column")


def check_profile(profile: DataFrame) -> None:
    """Raise on a scale above the maximum, or when no column is Text."""
    row = profile.agg(
        F.count_if(F.col("scale") > F.lit(MAX_SCALE)).alias("bad_scale"),
        F.count_if(F.col("dataset_type") == F.lit("Text")).alias("texts"),
    ).first()
    _refuse(row["bad_scale"], row["texts"])


def metadata_document(profile: DataFrame, dataset: str, unique_ids: list[str] | None = None) -> DataFrame:
    """The metadata JSON document of a dataset as one row ``(json)``; the
    field list is bounded by the schema width.  Fields named in
    ``unique_ids`` are marked ``isUniqueId``."""
    field = F.struct(
        F.col("full_name").alias("fullyQualifiedName"),
        F.col("column").alias("label"),
        F.col("column").alias("name"),
        F.lit(False).alias("isSystemField"),
        F.col("column").isin(*(unique_ids or [])).alias("isUniqueId"),
        F.lit(False).alias("isMultiValue"),
        F.col("dataset_type").alias("type"),
        F.col("precision").alias("precision"),
        F.col("scale").alias("scale"),
        F.col("default_value").alias("defaultValue"),
        F.col("format").alias("format"),
        F.col("can_truncate").alias("canTruncateValue"),
    )
    fields = profile.agg(F.array_sort(F.collect_list(F.struct("position", field.alias("f")))).alias("fs"))
    doc = F.struct(
        F.struct(F.lit("UTF-8").alias("charsetName"), F.lit(",").alias("fieldsDelimitedBy"),
                 F.lit(0).alias("numberOfLinesToIgnore")).alias("fileFormat"),
        F.array(
            F.struct(
                F.lit(dataset).alias("fullyQualifiedName"),
                F.lit(dataset).alias("label"),
                F.lit(dataset).alias("name"),
                F.transform(F.col("fs"), lambda x: x["f"]).alias("fields"),
            )
        ).alias("objects"),
    )
    return fields.select(F.to_json(doc).alias("json"))


def declared_entries(schema: T.StructType, type_map: str | dict | None = None) -> list[dict]:
    """The declared mapping per field, on the driver (schema-level metadata)."""
    m = merged_type_map(type_map)
    out = []
    for f in schema.fields:
        e = m.get(type_key(f.dataType), {"dataset_type": FALLBACK_TYPE})
        has_precision = e.get("precision") is not None
        out.append({
            "name": f.name,
            "dataset_type": e.get("dataset_type") or FALLBACK_TYPE,
            "precision": int(e["precision"]) if has_precision else None,
            "scale": int(e.get("scale") or 0) if has_precision else None,
            "default_value": (e.get("defaultValue") or "0") if has_precision else None,
            "format": e.get("format"),
            "can_truncate": e.get("canTruncateValue"),
        })
    return out


def metadata_json(schema: T.StructType, dataset: str, type_map: str | dict | None = None,
                  unique_ids: list[str] | None = None) -> str:
    """The same document as ``metadata_document`` over ``declared_fields``,
    built on the driver from the schema and the type map (no Spark job)."""
    fields = []
    for e in declared_entries(schema, type_map):
        f = {
            "fullyQualifiedName": f"{dataset}.{e['name']}", "label": e["name"], "name": e["name"],
            "isSystemField": False, "isUniqueId": e["name"] in (unique_ids or []), "isMultiValue": False,
            "type": e["dataset_type"], "precision": e["precision"], "scale": e["scale"],
            "defaultValue": e["default_value"], "format": e["format"], "canTruncateValue": e["can_truncate"],
        }
        fields.append({k: v for k, v in f.items() if v is not None})
    doc = {
        "fileFormat": {"charsetName": "UTF-8", "fieldsDelimitedBy": ",", "numberOfLinesToIgnore": 0},
        "objects": [{"fullyQualifiedName": dataset, "label": dataset, "name": dataset, "fields": fields}],
    }
    return json.dumps(doc, separators=(",", ":"))


def write_metadata(profile: DataFrame, dataset: str, path: str, unique_ids: list[str] | None = None) -> None:
    """Write the metadata document (one small JSON file)."""
    metadata_document(profile, dataset, unique_ids).coalesce(1).write.mode("overwrite").text(path)


_FIELD_DOC = T.StructType(
    [T.StructField(n, T.StringType()) for n in
     ("fullyQualifiedName", "label", "name", "description", "type", "precision", "scale", "defaultValue", "format",
      "canTruncateValue")]
    + [T.StructField(n, T.BooleanType()) for n in ("isSystemField", "isUniqueId", "isMultiValue")]
)
METADATA_DOC = T.StructType(
    [
        T.StructField("fileFormat", T.StructType([
            T.StructField("charsetName", T.StringType()), T.StructField("fieldsDelimitedBy", T.StringType()),
            T.StructField("numberOfLinesToIgnore", T.LongType())])),
        T.StructField("objects", T.ArrayType(T.StructType([
            T.StructField("fullyQualifiedName", T.StringType()), T.StructField("label", T.StringType()),
            T.StructField("name", T.StringType()), T.StructField("fields", T.ArrayType(_FIELD_DOC))]))),
    ]
)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A metadata document given whole, as a field table
    ``(object, position, name, type, precision, scale, format, default_value)``.
    Read with a fixed document schema, so absent keys are nulls and numbers
    may be written bare or quoted."""
    doc = spark.read.schema(METADATA_DOC).option("multiLine", "true").json(path)
    obj = doc.select(F.explode("objects").alias("o"))
    return obj.select(F.col("o.name").alias("object"), F.posexplode("o.fields").alias("position", "f")).select(
        "object",
        F.col("position").cast("int"),
        F.col("f.name").alias("name"),
        F.col("f.type").alias("type"),
        F.col("f.precision").cast("int").alias("precision"),
        F.col("f.scale").cast("int").alias("scale"),
        F.col("f.format").alias("format"),
        F.col("f.defaultValue").cast("string").alias("default_value"),
        F.coalesce(F.col("f.isUniqueId"), F.lit(False)).alias("is_unique_id"),
    )
