"""Program B rollups that follow its months: a load changes the totals by what it changed, not by adding everything up again.

Two tables under one root:

* ``states``: the monthly rollup (provider x code x month), a partition per month;
* ``totals``: provider x code over all months, in ``parts`` partitions by a hash of the key.  Paid amounts are decimals, so that
  adding and taking away is exact in any order, and the months billed are a set of bits, so that the totals can be merged further (months
  active of a provider: the union of the bits).

Loading a month (the first time, or again with corrections) computes its new states from the month's raw rows alone, subtracts the month's old
states from them key by key, and merges that difference into the parts of the totals that hold a changed key.  Other months are not read,
other parts are not written.

While totals and states are being written a mark lies beside them.  A load that finds the mark of one that broke off makes the totals anew
from the states first, so a broken load can be repeated; :meth:`MonthlyTotals.consistent` compares both tables by control sums.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens import schemas as S
from peerlens.functions import year_of_month
from peerlens.operators.rollup import rollup_b_monthly
from peerlens.sources.files import Files
from peerlens.sources.reload import replace_partitions
from peerlens.sources.tables import write_and_read

KEYS = ["provider_npi", "hcpcs_code"]
MEASURES = ["total_patients", "total_claim_lines", "total_paid"]
PAID = "decimal(38,6)"
PART = "_part"
_MEASURED = f"provider_npi string, hcpcs_code string, total_patients bigint, total_claim_lines bigint, total_paid {PAID}"
STATES = f"{_MEASURED}, claim_month string"
TOTALS = f"{_MEASURED}, months int, {PART} string"
#: A month as a bit (January is the lowest).
_BIT = "shiftleft(1, int(substring(claim_month, 6, 2)) - 1)"


class MonthlyTotals:
    """The states and totals of one year's program B under ``root``."""

    def __init__(self, spark: SparkSession, root: str, snapshot_year: int = S.DEFAULT_SNAPSHOT_YEAR, parts: int = 64):
        """``parts`` must be the same for every load of a root (about the totals' bytes over the size of a file)."""
        self.spark, self.year, self.parts, self.root = spark, snapshot_year, parts, root.rstrip("/")
        self.states_path, self.totals_path, self.mark = (f"{self.root}/{n}" for n in ("states", "totals", "loading"))
        self.months = [f"{snapshot_year}-{m:02d}" for m in range(1, 13)]
        self.files = Files(spark, self.root)

    def _read(self, path: str, schema: str) -> DataFrame:
        if self.files.exists(path):
            return self.spark.read.schema(schema).parquet(path)
        return self.spark.createDataFrame([], schema)

    def states(self) -> DataFrame:
        """The monthly rollup: one row per provider, code and month."""
        return self._read(self.states_path, STATES)

    def totals(self) -> DataFrame:
        """One row per provider and code, with the months billed as bits."""
        return self._read(self.totals_path, TOTALS)

    def loaded(self) -> bool:
        """Whether anything was loaded under this root before."""
        return self.files.exists(self.states_path)

    def load(self, raw_b: DataFrame, months: Sequence[str]) -> int:
        """Take ``months`` from program B raw rows, in place of what was loaded for them; returns the totals' rows written.

        Rows of other months in ``raw_b`` are passed over; a month without rows is emptied.
        """
        unknown = sorted(set(months) - set(self.months))
        if unknown:
            raise ValueError(f"months {unknown} are not of the year {self.year}")
        if self.files.exists(self.mark):
            self.rebuild()
        mine = rollup_b_monthly(raw_b.where(F.col(S.B_MONTH).isin(list(months))), self.year)
        fresh = mine.select(*KEYS, *MEASURES[:2], F.col("total_paid").cast(PAID).alias("total_paid"), "claim_month")
        work = f"{self.root}/loads/{uuid.uuid4().hex[:12]}"
        # written once: read for the difference and for the states
        fresh, _ = write_and_read(fresh, f"{work}/states", observe_rows=False)
        changed, _ = write_and_read(self._difference(fresh, months), f"{work}/changed", observe_rows=False)
        self.spark.createDataFrame([(m,) for m in months], "claim_month string").write.mode("overwrite").parquet(self.mark)
        written = self._merge(changed, months)
        replace_partitions(fresh, self.states_path, "claim_month", months)
        self.files.delete(self.mark)
        self.files.delete(work)
        return written

    def _difference(self, fresh: DataFrame, months: Sequence[str]) -> DataFrame:
        """Per changed key: the new measures less the old ones, and the bits of the months that it has now."""
        old = self.states().where(F.col("claim_month").isin(list(months)))
        signed = fresh.withColumn("_new", F.lit(True)).unionByName(old.withColumn("_new", F.lit(False)))
        change = [F.sum(F.when(F.col("_new"), F.col(m)).otherwise(-F.col(m))).alias(m) for m in MEASURES]
        now = F.coalesce(F.expr(f"bit_or(CASE WHEN _new THEN {_BIT} END)"), F.lit(0)).alias("_now")
        return signed.groupBy(*KEYS).agg(*change, now).withColumn(PART, self._part())

    def _merge(self, changed: DataFrame, months: Sequence[str]) -> int:
        """Add the differences to the parts of the totals that they touch."""
        touched = [r[PART] for r in changed.select(PART).distinct().collect()]  # at most ``parts``
        if not touched:
            return 0
        others = ~sum(1 << (int(m[5:7]) - 1) for m in months)
        was = self.totals().where(F.col(PART).isin(touched)).drop(PART)
        add = changed.drop(PART).withColumnsRenamed({m: f"_{m}" for m in MEASURES})
        both = was.join(add, KEYS, "full")
        measures = [(F.coalesce(m, F.lit(0)) + F.coalesce(f"_{m}", F.lit(0))).cast(dict(was.dtypes)[m]).alias(m) for m in MEASURES]
        bits = F.coalesce("months", F.lit(0)).bitwiseAND(F.lit(others)).bitwiseOR(F.coalesce("_now", F.lit(0)))
        merged = both.select(*KEYS, *measures, bits.alias("months")).where("months != 0").withColumn(PART, self._part())
        return replace_partitions(merged, self.totals_path, PART, touched)

    def rebuild(self) -> int:
        """Make the totals anew from the states."""
        measures = [F.sum(m).alias(m) for m in MEASURES[:2]] + [F.sum("total_paid").cast(PAID).alias("total_paid")]
        totals = self.states().groupBy(*KEYS).agg(*measures, F.expr(f"bit_or({_BIT})").alias("months"))
        return replace_partitions(totals.withColumn(PART, self._part()), self.totals_path, PART, [str(p) for p in range(self.parts)])

    def _part(self):
        return F.pmod(F.xxhash64(*KEYS), F.lit(self.parts)).cast("string")

    def consistent(self) -> bool:
        """Whether totals and states agree in the number of billed months, the sums and the keys."""
        sums = [F.sum(m).alias(m) for m in MEASURES]
        key = F.xxhash64(*KEYS)
        one = self.states().agg(F.count(F.lit(1)).alias("n"), *sums, F.bit_xor(key).alias("keys")).first()
        odd = F.when(F.bit_count("months") % 2 == 1, key)  # a key of an even number of months cancels out
        two = self.totals().agg(F.sum(F.bit_count("months")).alias("n"), *sums, F.bit_xor(odd).alias("keys")).first()
        return [v or 0 for v in one] == [v or 0 for v in two]

    # -- what the totals give
    def monthly(self) -> DataFrame:
        """As :func:`~peerlens.operators.rollup.rollup_b_monthly` over all months loaded."""
        return self.states().select(
            *KEYS, "claim_month", *MEASURES[:2], F.col("total_paid").cast("double").alias("total_paid"),
            year_of_month("claim_month").alias("claim_year"), F.current_timestamp().alias(S.TRANSFORMED_AT),
        )

    def code_rollup(self) -> DataFrame:
        """As :func:`~peerlens.operators.rollup.rollup_b_code` over all months loaded."""
        return self.totals().select(
            *KEYS,
            F.col("total_patients").alias("medicaid_total_patients"),
            F.col("total_claim_lines").alias("medicaid_total_claim_lines"),
            F.col("total_paid").cast("double").alias("medicaid_total_paid"),
            F.bit_count("months").cast("bigint").alias("medicaid_months_billed"),
        )

    def provider_rollup(self) -> DataFrame:
        """Program B per provider, merged from the totals: sums, codes billed, months active."""
        return self.totals().groupBy("provider_npi").agg(
            F.sum("total_paid").cast("double").alias("medicaid_total_paid"),
            F.sum("total_patients").alias("medicaid_total_patients"),
            F.sum("total_claim_lines").alias("medicaid_total_claim_lines"),
            F.count(F.lit(1)).alias("medicaid_distinct_hcpcs_count"),
            F.bit_count(F.bit_or("months")).cast("bigint").alias("medicaid_months_active"),
        )
