"""Figures of windows from mergeable states by day.

The state of a day is a row for each entity and supplier that signed on it, with
contracts and value. States merge by sums, and distinct entities and suppliers
are those with contracts left; so any window, and the one before it, is made from
its days' states and no contract is read again. When contracts change, the states
of the days they were signed on, before and now, are made anew, and no others.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from .cycles import _of, incoming_contracts, upsert_contracts
from .store import Store, Transaction

STATE = ["signed_on", "entity_id", "supplier_type", "supplier_number"]


def states(contracts: DataFrame) -> DataFrame:
    """The states of all days of contracts."""
    return _merged(_signed(contracts))


def _signed(contracts: DataFrame) -> DataFrame:
    return contracts.where("signed_on IS NOT NULL").select(*STATE, F.lit(1).cast("long").alias("contracts"), F.col("value"))


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*STATE).agg(F.sum("contracts").alias("contracts"), F.coalesce(F.sum("value"), F.lit(0)).cast("decimal(38,2)").alias("value"))


def derive(tx: Transaction, fresh: DataFrame, buckets: int = 64) -> None:
    """derive_contracts() and then the states of the days that the new versions touch, in the same commit."""
    came, known = incoming_contracts(tx, fresh, buckets), tx.has_rows("contract")
    if known:
        days = came.rows.select("signed_on").unionByName(_of(tx.read("contract"), came.rows, ["contract_id"]).select("signed_on"))
        days = tx.kept(days.where("signed_on IS NOT NULL").distinct(), "touched-days")
    upsert_contracts(tx, came, buckets)
    # of the first contracts all days are touched
    rows = _signed(_of(tx.read("contract"), days, ["signed_on"]) if known else tx.read("contract"))
    if known and tx.has_rows("day"):
        # what a day no longer has merges as nothing
        gone = _of(tx.read("day"), days, ["signed_on"]).select(*STATE, F.lit(0).cast("long").alias("contracts"), F.lit(None).cast(rows.schema["value"].dataType).alias("value"))
        rows = rows.unionByName(gone)
    tx.upsert("day", _merged(rows), STATE, buckets=buckets, by=["signed_on"])


def window(store: Store, first: date, last: date) -> DataFrame:
    """One row: contracts, value, entities and identified suppliers of a window, both days included."""
    days = store.read("day").where(F.col("signed_on").between(F.lit(first), F.lit(last)) & (F.col("contracts") > 0))
    identified = F.col("supplier_number").isNotNull() & (F.col("supplier_type") != V.JOINT_VENTURE)
    return days.agg(
        F.coalesce(F.sum("contracts"), F.lit(0)).alias("contracts"), F.coalesce(F.sum("value"), F.lit(0)).cast("double").alias("value"), F.countDistinct("entity_id").alias("entities"),
        F.count_distinct(F.when(identified, F.struct("supplier_type", "supplier_number"))).alias("suppliers"),
    )


def period_pair(store: Store, first: date, last: date) -> DataFrame:
    """window() of a period and of the equally long one just before it, as period now and before."""
    length = timedelta((last - first).days + 1)
    now, before = window(store, first, last), window(store, first - length, last - length)
    return now.withColumn("period", F.lit("now")).unionByName(before.withColumn("period", F.lit("before")))
