"""The conversion funnel from a keyed per-member state, kept day by day.

The state has one row per member: order ids and order rows of completed
orders, and rows of paid coupons.  All three are counts, so a day's part of
them can be taken out again: next to the members (parts ``bucket-…``, by hash
of the member) the same snapshot table holds what every day contributed
(parts ``day-…``).  Computing a day anew subtracts its old contribution, adds
the new one, and rewrites the buckets of the members that differ, no others.
Both switch in one step, so a day counts once however often it is run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.timewin import DayPartition, as_datetime, days_before, time_window
from shoplens.operators.funnel import COMPLETED, paid_coupons
from shoplens.sources.snapshots import SnapshotTable, nullable

COUNTS = ("orders", "order_rows", "coupon_rows")
NO_DAY = "day-none"  # rows without a time


def _added(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts summed per key, without keys that count nothing."""
    total = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS])
    return total.filter(" OR ".join(f"{c} != 0" for c in COUNTS))


def member_days(orders: DataFrame, coupons: DataFrame, status: int = COMPLETED) -> DataFrame:
    """``d, member_id`` and the counts, per member and calendar day."""
    bought = orders.filter(F.col("order_status") == status).selectExpr(
        "to_date(create_time) AS d",
        "member_id",
        "CAST(order_id IS NOT NULL AS BIGINT) AS orders",
        "1L AS order_rows",
        "0L AS coupon_rows",
    )
    held = paid_coupons(coupons).selectExpr(
        "to_date(create_time) AS d", "member_id", "0L AS orders", "0L AS order_rows", "1L AS coupon_rows"
    )
    return _added(bought.unionByName(held), "d", "member_id")


class FunnelState:
    """The stored state; ``buckets`` and ``status`` are fixed when it is built."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256, status: int = COMPLETED):
        self.table = SnapshotTable(spark, path)
        self.settings = {"buckets": buckets, "status": status}

    def _base(self) -> dict | None:
        base = self.table.manifest()
        if base and {k: base["notes"][k] for k in self.settings} != self.settings:
            raise ValueError(f"the stored state was built with {base['notes']}, not {self.settings}")
        return base

    def _bucket(self) -> Column:
        number = F.pmod(F.xxhash64("member_id"), F.lit(self.settings["buckets"])).cast("string")
        return F.concat(F.lit("bucket-"), F.lpad(number, 6, "0"))

    # --- writing

    def rebuild(self, orders: DataFrame, coupons: DataFrame) -> int:
        """Build the state from all rows."""
        days = member_days(orders, coupons, self.settings["status"])
        base, columns = self._base(), ["member_id", *COUNTS]
        day = F.coalesce(F.concat(F.lit("day-"), F.date_format("d", "yyyy-MM-dd")), F.lit(NO_DAY))
        by_day = self.table.stage(days.select(*columns, day.alias("day")), F.col("day"))
        schema = nullable(days.select(*columns).schema)
        members = _added(self.table.read_staged(by_day, schema), "member_id")
        staged = by_day | self.table.stage(members, self._bucket())
        return self.table.commit(staged, schema, None, base, self.settings | {"closed_before": None})

    def replace_day(
        self, day, orders: DataFrame, coupons: DataFrame, partition_day: str | DayPartition | None = None
    ) -> int:
        """Compute one day anew from its rows; the first day starts the state."""
        base, day = self._base(), as_datetime(day)
        notes = (base or {}).get("notes") or self.settings | {"closed_before": None}
        if notes["closed_before"] and day.date().isoformat() < notes["closed_before"]:
            raise ValueError(f"days before {notes['closed_before']} are closed")
        window = time_window(day, days_before(day, -1), partition_day=partition_day)
        rows = member_days(orders.filter(window), coupons.filter(window), self.settings["status"])
        rows = rows.select("member_id", *COUNTS)
        schema, key = nullable(rows.schema), f"day-{day.date().isoformat()}"
        staged = self.table.stage(rows, F.lit(key))
        change = self.table.read_staged(staged, schema)  # the day is aggregated once
        if base is not None:
            old = self.table.read([key], base["version"])
            change = _added(change.unionByName(old.select("member_id", *[(-F.col(c)).alias(c) for c in COUNTS])), "member_id")
        touched = [r["b"] for r in change.select(self._bucket().alias("b")).distinct().collect()]  # at most ``buckets``
        if touched:
            if base is not None:
                change = _added(self.table.read(touched, base["version"]).unionByName(change), "member_id")
            staged |= self.table.stage(change, self._bucket())
        return self.table.commit(staged, schema, [key, *touched], base, notes)

    def close_days(self, before) -> int:
        """Forget what days before ``before`` contributed: their counts stay, they cannot be run again."""
        base, edge = self._base(), as_datetime(before).date().isoformat()
        if base is None:
            raise ValueError("no state to close")
        closed = [p for p in base["parts"] if p.startswith("day-") and p != NO_DAY and p < f"day-{edge}"]
        edge = max(edge, base["notes"]["closed_before"] or edge)
        schema = self.table.read([], base["version"]).schema
        return self.table.commit({}, schema, closed, base, base["notes"] | {"closed_before": edge})

    # --- reports

    def members(self, members: Sequence[int] | None = None) -> DataFrame:
        """``member_id, orders, order_rows, coupon_rows``; with ids only their buckets are read."""
        base = self._base()
        if base is None:
            raise ValueError(f"no state in {self.table.root}")
        if members is None:
            return self.table.read([p for p in base["parts"] if p.startswith("bucket-")], base["version"])
        ids = self.table.spark.createDataFrame([(m,) for m in members], "member_id long")
        buckets = [r["b"] for r in ids.select(self._bucket().alias("b")).distinct().collect()]
        return self.table.read(buckets, base["version"]).filter(F.col("member_id").isin(list(members)))

    def buyers(self) -> DataFrame:
        """:func:`~shoplens.operators.funnel.funnel_buyers` of all days in the state."""
        return self.members().filter("order_rows > 0").select("member_id")

    def repeat_buyers(self, min_orders: int = 2) -> DataFrame:
        """:func:`~shoplens.operators.funnel.funnel_repeat_buyers`."""
        return self.members().filter((F.col("orders") >= min_orders) & (F.col("order_rows") > 0)).select("member_id")

    def coupon_buyers(self) -> DataFrame:
        """:func:`~shoplens.operators.funnel.funnel_coupon_buyers`."""
        return self.members().filter("coupon_rows > 0").select("member_id")

    def repeat_and_coupon(self, min_orders: int = 2) -> DataFrame:
        """:func:`~shoplens.operators.funnel.funnel_repeat_and_coupon`."""
        known = F.col("member_id").isNotNull() & (F.col("coupon_rows") > 0)
        return self.members().filter((F.col("orders") >= min_orders) & known).select("member_id")

    def summary(self, view: int = 1000, click: int = 800, min_orders: int = 2) -> DataFrame:
        """:func:`~shoplens.operators.funnel.funnel_summary`."""
        repeat = F.col("orders") >= min_orders
        holder = F.col("member_id").isNotNull() & (F.col("coupon_rows") > 0)
        return self.members().agg(
            F.lit(view).cast("bigint").alias("view"),
            F.lit(click).cast("bigint").alias("click"),
            F.count(F.when(F.col("order_rows") > 0, True)).alias("order"),
            F.count(F.when(repeat, True)).alias("orderAgain"),
            F.count(F.when(repeat & holder, True)).alias("chargeCoupon"),
        )
