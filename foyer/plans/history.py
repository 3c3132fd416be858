"""The seat history kept priced, so that a date range report reads its own days only.

Events are priced once, as their days arrive, and stored by load, in order of
their days. Beside them lies a summary for each performance, line item and price:
the highest payment and the first date. Both are the same whether the days came
one by one or together: a maximum of maxima is a maximum. A report reads the loads
that hold days of its range, in them what the files' statistics let through, and
looks earlier payments up in the summary.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import codes
from ..functions.dates import Moment, moment
from ..operators import select_into
from ..schemas import LONG, MOMENT, MONEY, table
from ..session import names_below
from ..sources import StoredTable
from . import report as R

DAY, LOAD = "event_day", "load"
SUMMARY = table(
    perf_no=LONG, order_no=LONG, sli_no=LONG, price=MONEY, sli_paid_amt=MONEY, orig_event_date=MOMENT
)


def combine_payments(rows: DataFrame) -> DataFrame:
    """Highest payment and first date of each performance, line item and price; combines its own results."""
    return rows.groupBy("perf_no", "order_no", "sli_no", "price").agg(
        F.max("sli_paid_amt").alias("sli_paid_amt"), F.min("orig_event_date").alias("orig_event_date")
    )


@dataclass(frozen=True)
class PricedHistory:
    """The stored history below ``path``."""

    spark: SparkSession
    path: str
    buckets: int = 64

    def add(
        self, events: DataFrame, load: int, perf: DataFrame, orders: DataFrame, perf_seat: DataFrame, nett: DataFrame
    ) -> None:
        """Price and store the events of whole days.

        Loads are numbered upward. One that runs again replaces its events and adds
        nothing to the summary; a day that was changed after it was loaded needs
        the summary to be built anew.
        """
        priced = R.priced_history(events, perf.hint("merge"), orders, perf_seat, nett)
        priced = select_into(priced.withColumns({DAY: F.col("event_date").cast("date"), LOAD: F.lit(load)}))
        days = priced.agg(F.min(DAY).alias("first_day"), F.max(DAY).alias("last_day"), F.lit(load).alias(LOAD))
        for rows, path in ((priced.repartitionByRange(DAY).sortWithinPartitions(DAY), self._events), (days, self._days)):
            writer = rows.write.mode("overwrite").partitionBy(LOAD)
            writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        paid = priced.where((F.col("event_code") != codes.EVENT_RESERVED) & F.col("nett_pmap").isNotNull()).select(
            "perf_no", "order_no", "sli_no", F.col("nett_price").alias("price"), "sli_paid_amt",
            F.col("event_date").alias("orig_event_date"),
        )
        self._summary.fold(combine_payments(paid), combine_payments, load)

    def events(self, start: Moment | None, end: Moment | None) -> DataFrame:
        """Priced events of the days of a range; only loads that hold some of them are read."""
        if not names_below(self.spark, self._days):
            raise ValueError("the history holds no days yet")
        low, high = (moment(x).cast("date") for x in (start or codes.RANGE_MIN, end or codes.RANGE_MAX))
        days = self.spark.read.parquet(self._days)
        # One number for each load in the range comes to the driver.
        loads = [r[0] for r in days.where((F.col("last_day") >= low) & (F.col("first_day") <= high)).select(LOAD).collect()]
        rows = self.spark.read.parquet(self._events)
        return rows.where(F.col(LOAD).isin(loads) & F.col(DAY).between(low, high))

    def original_payment(self, perfs: DataFrame) -> DataFrame:
        """As ``report.original_payment``, over all stored events of the performances."""
        own = self._summary.read().join(perfs.select("perf_no"), "perf_no", "left_semi")
        return own.groupBy("order_no", "sli_no", "price").agg(
            F.max("sli_paid_amt").alias("sli_paid_amt"), F.min("orig_event_date").alias("orig_event_date")
        )

    def sales_date_range(
        self, perfs: DataFrame, detail: DataFrame, start: Moment | None = None, end: Moment | None = None,
        collapse_equal_nett: bool = True, original_by: Sequence[str] = R.BY_LINE_ITEM,
    ) -> DataFrame:
        """As ``report.sales_date_range`` for the performances, from what is stored."""
        own = self.events(start, end).drop(DAY, LOAD).join(perfs.select("perf_no"), "perf_no", "left_semi")
        return R.sales_date_range(
            own, detail, self.original_payment(perfs), start, end, collapse_equal_nett, original_by
        )

    @property
    def _events(self) -> str:
        return f"{self.path}/events"

    @property
    def _days(self) -> str:
        return f"{self.path}/days"

    @property
    def _summary(self) -> StoredTable:
        return StoredTable(self.spark, f"{self.path}/payments", SUMMARY, ("sli_no",), self.buckets)
