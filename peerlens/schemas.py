"""Declared schemas and the raw -> clean column map.

Program A (the per-service physician file) arrives as text; program B
(the monthly spending file) arrives typed.  Schemas are declared, never
inferred: inference sorts dict keys and fails on all-null page columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: program A raw column -> clean column, clean type ---------
# These names must equal the source file's header and the clean names the
# marts and reports use; the order is the source's order.
PROGRAM_A_COLUMNS: list[tuple[str, str, str]] = [
    ("Rndrng_NPI", "provider_npi", "string"),
    ("Rndrng_Prvdr_Last_Org_Name", "provider_last_org_name", "string"),
    ("Rndrng_Prvdr_First_Name", "provider_first_name", "string"),
    ("Rndrng_Prvdr_Crdntls", "provider_credentials", "string"),
    ("Rndrng_Prvdr_Type", "provider_specialty", "string"),
    ("Rndrng_Prvdr_State_Abrvtn", "provider_state", "string"),
    ("Rndrng_Prvdr_City", "provider_city", "string"),
    ("Rndrng_Prvdr_Zip5", "provider_zip", "string"),
    ("Rndrng_Prvdr_Ent_Cd", "provider_entity_type", "string"),
    ("Rndrng_Prvdr_Mdcr_Prtcptg_Ind", "medicare_participating", "string"),
    ("HCPCS_Cd", "hcpcs_code", "string"),
    ("HCPCS_Desc", "hcpcs_description", "string"),
    ("HCPCS_Drug_Ind", "hcpcs_drug_indicator", "string"),
    ("Place_Of_Srvc", "place_of_service", "string"),
    ("Tot_Benes", "total_beneficiaries", "int"),
    ("Tot_Srvcs", "total_services", "double"),
    ("Tot_Bene_Day_Srvcs", "total_beneficiary_day_services", "int"),
    ("Avg_Sbmtd_Chrg", "avg_submitted_charge", "double"),
    ("Avg_Mdcr_Alowd_Amt", "avg_medicare_allowed_amt", "double"),
    ("Avg_Mdcr_Pymt_Amt", "avg_medicare_payment_amt", "double"),
    ("Avg_Mdcr_Stdzd_Amt", "avg_medicare_standardized_amt", "double"),
]

# Program B raw columns the pipeline reads.  The servicing-provider column
# is below the billing grain; its name is this package's own.
B_BILLING_NPI = "BILLING_PROVIDER_NPI_NUM"
B_SERVICING_NPI = "SERVICING_PROVIDER_NPI_NUM"
B_CODE = "HCPCS_CODE"
B_MONTH = "CLAIM_FROM_MONTH"
B_PATIENTS = "TOTAL_PATIENTS"
B_CLAIM_LINES = "TOTAL_CLAIM_LINES"
B_PAID = "TOTAL_PAID"

# Audit columns added at landing.
INGESTED_AT = "_ingested_at"
SOURCE_TAG = "_source"
TRANSFORMED_AT = "_transformed_at"

# Default source tags and snapshot year (parameters everywhere).
DEFAULT_SNAPSHOT_YEAR = 2022
SOURCE_TAG_A = "program_a_provider_service"
SOURCE_TAG_B = "program_b_provider_spending"

# Page size of the program A paged feed.
PAGE_SIZE = 5000

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType()}

PROGRAM_A_RAW = T.StructType([T.StructField(raw, T.StringType(), True) for raw, _, _ in PROGRAM_A_COLUMNS])

PROGRAM_A_CLEAN = T.StructType(
    [T.StructField(clean, _TYPES[kind], True) for _, clean, kind in PROGRAM_A_COLUMNS]
)

PROGRAM_B_RAW = T.StructType(
    [
        T.StructField(B_BILLING_NPI, T.StringType(), True),
        T.StructField(B_SERVICING_NPI, T.StringType(), True),
        T.StructField(B_CODE, T.StringType(), True),
        T.StructField(B_MONTH, T.StringType(), True),
        T.StructField(B_PATIENTS, T.LongType(), True),
        T.StructField(B_CLAIM_LINES, T.LongType(), True),
        T.StructField(B_PAID, T.DoubleType(), True),
    ]
)
