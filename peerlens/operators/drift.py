"""How landed pages differ from the declared schema, read as VARIANT values beside it.

A declared schema reads what it knows: a new field is passed over, a dropped one is null, a retyped one becomes text.  The report
reads the same lines as VARIANT and tells, per field, in how many rows it is, with which types, and what that means.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens import schemas as S

#: JSON types that a declared type may come as without a change; fixed values.
EXPECTED = {
    "string": ("STRING",),
    "int": ("BIGINT",),
    "bigint": ("BIGINT",),
    "double": ("BIGINT", "DECIMAL", "DOUBLE"),
    "boolean": ("BOOLEAN",),
}


def read_lines(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Landed JSON lines as VARIANT values (``line``); null for lines that are no JSON."""
    return spark.read.text(landing_dir).where(F.length(F.trim("value")) > 0).select(F.try_parse_json("value").alias("line"))


def drift_report(lines: DataFrame, schema: T.StructType = S.PROGRAM_A_RAW) -> DataFrame:
    """One row per declared or found field: ``field``, ``declared``, ``found``, ``rows_with``, ``rows_total``, ``status``.

    ``found``: its JSON types, in order, with a plus between them (nulls are no type; a number's digits and an object's fields are left out).
    ``status``: ``unknown`` (not declared), ``missing`` (in no row), ``retyped`` (of another type in some row), ``partly missing`` (not
    in every row), ``ok``.  Lines that are no JSON object are counted in ``rows_total`` and hold no field.  One pass, pre-aggregated by field and type.
    """
    spark = lines.sparkSession
    total = lines.agg(F.count(F.lit(1))).scalar()
    fields = lines.lateralJoin(spark.tvf.variant_explode(F.col("line").outer())).where("key IS NOT NULL")
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    each = fields.groupBy(F.col("key").alias("field"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    found = each.groupBy("field").agg(
        F.sum("n").alias("rows_with"),
        F.array_sort(F.collect_set(F.when(F.col("kind") != "VOID", F.col("kind")))).alias("_kinds"),
    )
    known = spark.createDataFrame(
        [(f.name, f.dataType.simpleString(), list(EXPECTED.get(f.dataType.simpleString(), ()))) for f in schema.fields],
        "field string, declared string, _expected array<string>",
    )
    both = known.join(found, "field", "full").withColumn("rows_total", total)
    n = F.coalesce("rows_with", F.lit(0))
    status = (
        F.when(F.col("declared").isNull(), "unknown")
        .when(n == 0, "missing")
        .when(F.size(F.array_except("_kinds", "_expected")) > 0, "retyped")
        .when(n < F.col("rows_total"), "partly missing")
        .otherwise("ok")
    )
    return both.select(
        "field", "declared", F.coalesce(F.array_join("_kinds", "+"), F.lit("")).alias("found"), n.alias("rows_with"), "rows_total", status.alias("status")
    )
