"""The whole import as one job that can be taken up where it broke off.

Targets are written one after the other, each into a folder of its own, and
published by an entry of the manifest once their rows are complete. A run finds
what an earlier one has published and goes on at the first target that is not: the
keyed staging rows come first, so customers keep the numbers they were given. An
entry also tells how many rows its target has, counted while they were written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import RESERVE
from ..session import names_below
from . import importer as I

#: What the job reads.
SOURCES = ("staging", "quality_address", "quality_email", "loaded", "customer", "matchup", "zone")
#: What it writes, in this order; the first two are the rows all others start from.
TARGETS = (
    "staged", "mapped", "next_id", "primary_customer", "cust_keyword", "customer", "cust_interest",
    "ticket_history", "const_cust", "unmapped", "checks",
)
ENTRY = "target string, n_rows long, source long"


@dataclass(frozen=True)
class ImportJob:
    """The import of ``tables`` into the folder ``path`` of shared storage."""

    spark: SparkSession
    path: str
    tables: Mapping[str, DataFrame]
    base: int = 100_000

    def run(self) -> dict[str, DataFrame]:
        """Publish what is not yet published; all targets by name.

        Other staging rows than those a broken-off run began with are an error:
        their import needs a folder of its own.
        """
        source = self._source()
        for target in TARGETS:
            told = self.entry(target)
            if told is None:
                self._publish(target, source)
            elif told["source"] != source:
                raise ValueError(f"{self.path} holds the import of other staging rows")
        return {target: self.target(target) for target in TARGETS}

    def target(self, name: str) -> DataFrame:
        """A published target."""
        return self.spark.read.parquet(f"{self.path}/{name}")

    def entry(self, name: str):
        """The manifest's entry of a target, or None before it is published."""
        folder = f"{self.path}/manifest/{name}"
        if "_SUCCESS" not in names_below(self.spark, folder):
            return None
        return self.spark.read.schema(ENTRY).parquet(folder).first()

    def manifest(self) -> DataFrame:
        """The published targets with their numbers of rows."""
        done = [t for t in TARGETS if self.entry(t) is not None]
        if not done:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(*[f"{self.path}/manifest/{t}" for t in done])

    def _source(self) -> int:
        """A sum over the staging rows' digests, by which they are known again."""
        rows = self.tables["staging"]
        digest = F.xxhash64(*[F.col(c) for c in rows.columns]) % (1 << 40)
        return rows.agg(F.coalesce(F.sum(digest), F.lit(0)) + F.count(F.lit(1))).first()[0]

    def _publish(self, name: str, source: int) -> None:
        seen = Observation()
        rows = self._plans()[name]().observe(seen, F.count(F.lit(1)).alias("n_rows"))
        # Rows of a run that broke off before the entry was written are replaced.
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}")
        entry = self.spark.createDataFrame([(name, seen.get["n_rows"], source)], ENTRY)
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{name}")

    def _plans(self) -> dict[str, Callable[[], DataFrame]]:
        t = self.tables

        def mapped(which: int) -> DataFrame:
            return I.map_price_zone(self.target("staged"), t["matchup"], t["zone"])[which]

        def next_id() -> DataFrame:
            # From the keys that were given out, so that a later run tells the same.
            reserve = F.coalesce(F.max("customer_no"), F.lit(self.base)) + RESERVE
            return self.target("staged").agg(reserve.cast("long").alias("next_id"))

        return {
            "staged": lambda: I.assign_customer_no(I.clean_staging(t["staging"]), self.base)[0],
            "mapped": lambda: mapped(0),
            "next_id": next_id,
            "primary_customer": lambda: I.primary_customer_load(
                self.target("staged"), t["quality_address"], t["quality_email"], t["loaded"]
            ),
            "cust_keyword": lambda: I.legacy_keyword(self.target("staged")),
            "customer": lambda: I.preferences(t["customer"], self.target("staged")),
            "cust_interest": lambda: I.interests(t["customer"], self.target("staged")),
            "ticket_history": lambda: I.ticket_history(self.target("mapped")),
            "const_cust": lambda: I.constituency(self.target("staged")),
            "unmapped": lambda: self.target("mapped").where(F.col("price_type_no").isNull()),
            "checks": lambda: I.staging_checks(self.target("staged")),
        }
