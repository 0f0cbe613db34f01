"""Raw program A / program B inputs derived from the driver's star schema.

The claim files themselves are not available here, so both raw inputs are
derived, distributed, from ``lineitem``/``orders``/``customer``/``nation``/
``part``: a customer plays the provider, a brand plays the procedure code,
the return flag plays the place of service.

* program A = open lines (``l_linestatus = 'O'``) rolled up to provider x
  code x place, every column written as text (the paged feed is untyped);
* program B = finished lines (``l_linestatus = 'F'``), one row per line,
  the supplier playing the servicing provider.

Plan shape: lines of one status are joined to their order (customer key,
date) and part (brand).  Program A aggregates those lines first and joins
customer and nation (25 rows by the TPC-H definition, so broadcast) to the
aggregated rows only; program B needs just the customer key and keeps the
inner-join meaning with a semi join.  The line-status filter and the column
selection reach the lineitem scan.

The joins and rollups are dealt to as many tasks as the lines ask for
(:func:`line_parts`), where the session's shuffle partitions are fewer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens import schemas as S
from peerlens.sources.sizing import LINES_PER_TASK, dealt, parts_for

OPEN_STATUS = "O"
FINISHED_STATUS = "F"

# An NPI is a 10-digit text: 1,000,000,000 + customer key.
NPI_BASE = 1_000_000_000

# Parts of one provider x code x place group in the first rollup, so that a heavy group is no single task.
SPREAD = 16


# Declared (not inferred) schemas of the columns read from the driver's
# tables: no footer-reading job per scan, and a type drift fails loudly.
_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
INPUT_SCHEMAS: dict[str, T.StructType] = {
    "lineitem": T.StructType(
        [
            T.StructField(n, t)
            for n, t in [
                ("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_quantity", _D),
                ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                ("l_linestatus", _S),
            ]
        ]
    ),
    "orders": T.StructType(
        [T.StructField("o_orderkey", _L), T.StructField("o_custkey", _L),
         T.StructField("o_orderdate", T.TimestampNTZType())]
    ),
    "customer": T.StructType(
        [T.StructField("c_custkey", _L), T.StructField("c_name", _S), T.StructField("c_nationkey", _I),
         T.StructField("c_mktsegment", _S)]
    ),
    "nation": T.StructType([T.StructField("n_nationkey", _I), T.StructField("n_name", _S)]),
    "part": T.StructType([T.StructField("p_partkey", _L), T.StructField("p_brand", _S)]),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = INPUT_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def line_parts(spark: SparkSession, sf_dir: str, each: int = LINES_PER_TASK) -> int | None:
    """Tasks for the joins and rollups of the lines (row counts are in the file footers); None: the session's are enough."""
    return parts_for(spark, _table(spark, sf_dir, "lineitem").count(), each)


def line_facts(spark: SparkSession, sf_dir: str, line_status: str, parts: int | None = None) -> DataFrame:
    """Lines of one status with their order's customer and date and their part's brand.

    ``parts``: tasks of the two joins.  Only the smaller sides name it, so that a join is still broadcast where they are small.
    """
    lineitem = _table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == line_status)
    orders = dealt(_table(spark, sf_dir, "orders"), parts, "o_orderkey")
    part = dealt(_table(spark, sf_dir, "part"), parts, "p_partkey")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation's name (one row per customer)."""
    customer = _table(spark, sf_dir, "customer")
    # 25 rows by definition of the schema: a proven bound, safe to broadcast.
    nation = F.broadcast(_table(spark, sf_dir, "nation"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


def claim_lines(spark: SparkSession, sf_dir: str, line_status: str) -> DataFrame:
    """One row per line item with provider, code and place attributes."""
    return line_facts(spark, sf_dir, line_status).join(
        customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")
    )


def _npi(custkey: str = "c_custkey") -> F.Column:
    return (F.lit(NPI_BASE) + F.col(custkey)).cast("string")


def program_a_raw(spark: SparkSession, sf_dir: str, with_audit_cols: bool = True, each: int = LINES_PER_TASK) -> DataFrame:
    """Program A, raw: provider x code x place rows, every field as text; ``each``: see :func:`line_parts`."""
    parts = line_parts(spark, sf_dir, each)
    # Aggregate the lines first (keys: customer, brand, flag), then attach the
    # customer's attributes to the much smaller result: the shuffle carries
    # no customer strings, and the customer join sees one row per group.
    lines = line_facts(spark, sf_dir, OPEN_STATUS, parts)
    amount = F.col("l_extendedprice") * F.col("l_quantity")
    # Two levels instead of count(DISTINCT order): lines -> one row per
    # order within the group (partial sums), then -> one row per group.
    # Same values as the one-level averages (an average is a sum over a
    # count), without the Expand that doubles every line.
    keys = ["c_custkey", "p_brand", "l_returnflag"]
    lines = lines.withColumnRenamed("o_custkey", "c_custkey")
    measures = {
        "charge": amount * (1 + F.col("l_tax")),
        "allowed": amount,
        "payment": amount * (1 - F.col("l_discount")),
        "standardized": F.col("l_extendedprice") * (1 - F.col("l_discount")),
    }
    # Dealt by group and order beforehand: both levels below then run without an exchange of their own.
    spread = ["_spread"] if parts else []
    if parts:
        lines = dealt(lines.withColumn("_spread", F.pmod(F.xxhash64("l_orderkey"), F.lit(SPREAD))), parts, *keys, *spread)
    per_order = lines.groupBy(*keys, *spread, "l_orderkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.count(F.lit(1)).alias("lines"),
        *[F.sum(e).alias(f"s_{m}") for m, e in measures.items()],
        *[F.count(e).alias(f"n_{m}") for m, e in measures.items()],
    )
    orders = F.count(F.lit(1))
    if parts:
        sums = ["qty", "lines", *(f"{k}_{m}" for m in measures for k in "sn")]
        per_spread = per_order.groupBy(*keys, *spread).agg(orders.alias("orders"), *(F.sum(c).alias(c) for c in sums))
        per_order, orders = dealt(per_spread, parts, *keys), F.sum("orders")  # at most SPREAD rows of a group
    per_group = per_order.groupBy(*keys).agg(
        orders.alias("benes"),
        F.sum("qty").alias("services"),
        F.sum("lines").alias("bene_day_services"),
        *[(F.sum(f"s_{m}") / F.sum(f"n_{m}")).alias(m) for m in measures],
    )
    grouped = per_group.join(dealt(customers(spark, sf_dir), parts, "c_custkey"), "c_custkey")
    text = lambda c: F.col(c).cast("string")
    df = grouped.select(
        _npi().alias("Rndrng_NPI"),
        F.col("c_name").alias("Rndrng_Prvdr_Last_Org_Name"),
        F.substring("c_name", 1, 8).alias("Rndrng_Prvdr_First_Name"),
        F.lit("M.D.").alias("Rndrng_Prvdr_Crdntls"),
        F.col("c_mktsegment").alias("Rndrng_Prvdr_Type"),
        F.col("n_name").alias("Rndrng_Prvdr_State_Abrvtn"),
        F.concat(F.lit("CITY-"), F.col("c_nationkey").cast("string")).alias("Rndrng_Prvdr_City"),
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("Rndrng_Prvdr_Zip5"),
        F.lit("I").alias("Rndrng_Prvdr_Ent_Cd"),
        F.lit("Y").alias("Rndrng_Prvdr_Mdcr_Prtcptg_Ind"),
        F.col("p_brand").alias("HCPCS_Cd"),
        F.concat(F.lit("desc "), F.col("p_brand")).alias("HCPCS_Desc"),
        F.lit("N").alias("HCPCS_Drug_Ind"),
        F.col("l_returnflag").alias("Place_Of_Srvc"),
        text("benes").alias("Tot_Benes"),
        text("services").alias("Tot_Srvcs"),
        text("bene_day_services").alias("Tot_Bene_Day_Srvcs"),
        text("charge").alias("Avg_Sbmtd_Chrg"),
        text("allowed").alias("Avg_Mdcr_Alowd_Amt"),
        text("payment").alias("Avg_Mdcr_Pymt_Amt"),
        text("standardized").alias("Avg_Mdcr_Stdzd_Amt"),
    )
    if with_audit_cols:
        from peerlens.sources.tables import with_audit

        df = with_audit(df, S.SOURCE_TAG_A)
    return df


def program_b_raw(spark: SparkSession, sf_dir: str, with_audit_cols: bool = True) -> DataFrame:
    """Program B, raw: one row per billing x servicing provider x code x month."""
    # Only the customer key is needed; the semi join keeps the inner-join
    # meaning (lines of unknown customers or nations are dropped) without
    # carrying any customer column.
    parts = line_parts(spark, sf_dir)
    known = dealt(customers(spark, sf_dir).select("c_custkey"), parts, "c_custkey")
    lines = line_facts(spark, sf_dir, FINISHED_STATUS, parts).join(
        known, F.col("o_custkey") == F.col("c_custkey"), "left_semi"
    )
    df = lines.select(
        _npi("o_custkey").alias(S.B_BILLING_NPI),
        F.col("l_suppkey").cast("string").alias(S.B_SERVICING_NPI),
        F.col("p_brand").alias(S.B_CODE),
        F.date_format("o_orderdate", "yyyy-MM").alias(S.B_MONTH),
        F.col("l_quantity").cast("bigint").alias(S.B_PATIENTS),
        F.lit(1).cast("bigint").alias(S.B_CLAIM_LINES),
        F.col("l_extendedprice").alias(S.B_PAID),
    )
    if with_audit_cols:
        from peerlens.sources.tables import with_audit

        df = with_audit(df, S.SOURCE_TAG_B)
    return df


def soiled_program_a(raw: DataFrame) -> DataFrame:
    """Program A with faults by fixed rules on its keys (``k``: customer number, ``b``: brand number).

    Null and 9-character ids, null codes, ``'*'`` and ``'1,234'`` for numbers, negative payments, zero
    charges, second descriptions, null specialties and second states.
    """
    k = F.col("Rndrng_NPI").cast("bigint") % NPI_BASE
    b = F.substring("HCPCS_Cd", 7, 8).cast("int")
    none = F.lit(None).cast("string")
    return raw.withColumns(
        {
            "Rndrng_NPI": F.when((k % 29 == 0) & (b % 7 == 0), none).when(k % 19 == 0, F.expr("substring(Rndrng_NPI, 2)")).otherwise(F.col("Rndrng_NPI")),
            "HCPCS_Cd": F.when((k % 31 == 0) & (b % 5 == 0), none).otherwise(F.col("HCPCS_Cd")),
            "HCPCS_Desc": F.when((k % 23 == 0) & (F.col("Place_Of_Srvc") == "N"), F.concat(F.lit("other "), F.col("HCPCS_Cd"))).otherwise(F.col("HCPCS_Desc")),
            "Rndrng_Prvdr_Type": F.when(k % 37 == 0, none).otherwise(F.col("Rndrng_Prvdr_Type")),
            "Rndrng_Prvdr_State_Abrvtn": F.when((k % 41 == 0) & (b % 3 == 0), F.lit("XX")).otherwise(F.col("Rndrng_Prvdr_State_Abrvtn")),
            "Tot_Srvcs": F.when((k % 13 == 0) & (b % 2 == 0), F.lit("*")).otherwise(F.col("Tot_Srvcs")),
            "Avg_Sbmtd_Chrg": F.when((k % 17 == 0) & (b % 2 == 1), F.lit("1,234")).when(k % 47 == 0, F.lit("0")).otherwise(F.col("Avg_Sbmtd_Chrg")),
            "Avg_Mdcr_Pymt_Amt": F.when(k % 43 == 0, F.concat(F.lit("-"), F.col("Avg_Mdcr_Pymt_Amt"))).otherwise(F.col("Avg_Mdcr_Pymt_Amt")),
        }
    )


def soiled_program_b(raw: DataFrame) -> DataFrame:
    """Program B with faults by fixed rules: null billing ids and codes, negative paid, months of a wrong form."""
    k = F.col(S.B_BILLING_NPI).cast("bigint") % NPI_BASE
    b = F.substring(S.B_CODE, 7, 8).cast("int")
    return raw.withColumns(
        {
            S.B_BILLING_NPI: F.when(k % 53 == 0, F.lit(None).cast("string")).otherwise(F.col(S.B_BILLING_NPI)),
            S.B_CODE: F.when((k % 31 == 0) & (b % 5 == 0), F.lit(None).cast("string")).otherwise(F.col(S.B_CODE)),
            S.B_MONTH: F.when((k % 7 == 0) & (F.col(S.B_MONTH) == "1998-01"), F.lit("1998-1")).otherwise(F.col(S.B_MONTH)),
            S.B_PAID: F.when(k % 11 == 0, -F.col(S.B_PAID)).otherwise(F.col(S.B_PAID)),
        }
    )
