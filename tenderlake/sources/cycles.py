"""Ingest cycles over a store: rows, derived tables, watermark and cycle log in one commit."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import incremental, normalize, raw
from .derived import KEYS
from .store import Conflict, Incoming, Store, Transaction

#: The cycle log.
LOG = ("dataset string, state string, first date, last date, watermark_before date, watermark_after date, derived boolean, seen long, inserted long, new long, changed long, duplicates long,"
       " recovered long, short_window long, changed_on_edge long, cause string, finished_at timestamp")  # fmt: skip
#: What identifies a version of a raw row, and what the row.
VERSION, ROW = ["dataset", "row_id", "hash"], ["dataset", "row_id"]


def watermark(store: Store, dataset: str) -> date | None:
    said = store.values().get("watermark", {}).get(dataset)
    return date.fromisoformat(said["fact_on"]) if said else None


def run_cycle(
    store: Store, dataset: str, fetch: Callable[[date, date], DataFrame], until: date, overlap: int = incremental.OVERLAP_DAYS, start: date | None = None,
    derive: Callable[[Transaction, DataFrame, int], None] | None = None, now: datetime | None = None, times: int = 3, buckets: int = 64,
) -> dict:
    """One cycle: read a range, keep the versions that are new, derive tables, advance the watermark; its row of the log.

    fetch gives the source's rows (row_id, content, seen_at, fact_on) of a range
    of days, both included. Without start the range begins overlap days before
    the watermark. derive is given the transaction, the rows that were new and
    the number of buckets for tables that it makes.

    Everything is one commit: a cycle that is cut off leaves no trace but
    unreferenced files, and the same cycle run again does all of it. A cycle that
    fails is logged with its cause and leaves the watermark where it was. When
    another writer has committed meanwhile, the cycle begins again from there.
    The watermark never goes back.
    """
    for left in range(times, 0, -1):
        tx, before = store.begin(), watermark(store, dataset)
        first, last = incremental.ingest_range(before, until, overlap, start)
        at = now or datetime.now(timezone.utc).replace(tzinfo=None)
        entry = {"dataset": dataset, "first": first, "last": last, "watermark_before": before, "watermark_after": before, "derived": start is None, "finished_at": at}
        try:
            rows = fetch(first, last).select(F.lit(dataset).alias("dataset"), "row_id", raw.content_hash(F.col("content")).alias("hash"), "content", "seen_at", "fact_on")
            counted = rows.observe(seen := _observation(), F.count(F.lit(1)).alias("rows"))
            fresh = tx.insert("raw", counted, VERSION, ROW, buckets)
            counts = incremental.cycle(fresh, 0, before, first).first().asDict()
            counts["seen"] = seen.get["rows"]
            counts["duplicates"] = counts["seen"] - counts["inserted"]
            if derive:
                derive(tx, fresh, buckets)
            reached = max((d for d in (before, counts.pop("last_fact")) if d), default=None)
            if start is not None:  # only a derived range has an edge that says something of the overlap
                counts["short_window"] = counts["changed_on_edge"] = 0
            entry |= counts | {"state": "complete", "watermark_after": reached, "cause": None}
            tx.append("cycle", _log(store, entry))
            if reached:
                tx.put("watermark", dataset, {"fact_on": reached.isoformat(), "updated_at": at.isoformat()})
            tx.commit()
            return entry
        except Conflict:
            if left == 1:
                raise
        except Exception as e:
            tx.abort()
            failed = entry | {"state": "failed", "cause": f"{type(e).__name__}: {e}"[:2000]}
            store.retried(lambda t: t.append("cycle", _log(store, failed)))
            raise
    raise AssertionError


def _observation():
    from pyspark.sql import Observation

    return Observation()


def _log(store: Store, entry: dict) -> DataFrame:
    names = [c.split()[0] for c in LOG.split(", ")]
    return store.spark.createDataFrame([tuple(entry.get(n) for n in names)], LOG).coalesce(1)


def incoming_contracts(tx: Transaction, fresh: DataFrame, buckets: int = 64) -> Incoming:
    """The contracts of new raw versions, each once: the documents are read here and nowhere else."""
    newest = raw.latest(fresh, ROW, [F.desc("seen_at"), F.desc("content")])
    return tx.incoming("contract", normalize.contracts(newest), KEYS["contract"], [F.desc("seen_at"), F.col("row_id").desc()], buckets)


def derive_contracts(tx: Transaction, fresh: DataFrame, buckets: int = 64) -> None:
    """Upsert contracts from new raw versions, and the suppliers and name variants that they touch."""
    upsert_contracts(tx, incoming_contracts(tx, fresh, buckets), buckets)


def upsert_contracts(tx: Transaction, came: Incoming, buckets: int = 64) -> None:
    """Merge contracts, and count the suppliers and name variants that they touch.

    Suppliers are counted again from their contracts, those they had before and
    those they have now, so the tables equal a rewrite from all raw rows. A
    supplier or a variant that nothing has any longer stays with 0 contracts:
    tables are updated, never cut.
    """
    who, known = KEYS["supplier"], tx.has_rows("contract")
    if known:
        touched = came.rows.select(*who).unionByName(_of(tx.read("contract"), came.rows, ["contract_id"]).select(*who))
        touched = tx.kept(touched.where("supplier_number IS NOT NULL").distinct(), "touched-suppliers")
    tx.merge(came)
    # of the first contracts all suppliers are touched
    theirs = _of(tx.read("contract"), touched, who) if known else tx.read("contract")
    named = theirs.where("supplier_number IS NOT NULL").select(*who, F.col("supplier_name").alias("name"), F.lit(1).cast("long").alias("contracts"))
    if known and tx.has_rows("variant"):
        named = named.unionByName(_of(tx.read("variant"), touched, who).withColumn("contracts", F.lit(0).cast("long")))
    variants = tx.incoming("variant", named.groupBy(*KEYS["variant"]).agg(F.sum("contracts").alias("contracts")), KEYS["variant"], buckets=buckets)
    suppliers = normalize.suppliers(variants.rows.where("contracts > 0").select(*KEYS["variant"], "contracts"))
    if known and tx.has_rows("supplier"):
        none = variants.rows.groupBy(*who).agg(F.sum("contracts").alias("n")).where("n = 0")
        suppliers = suppliers.unionByName(_of(tx.read("supplier"), none, who).withColumns({"contracts": F.lit(0).cast("long"), "variants": F.lit(0).cast("long")}))
    tx.upsert("supplier", suppliers, KEYS["supplier"], buckets=buckets)
    tx.merge(variants)


def derive_processes(tx: Transaction, fresh: DataFrame, buckets: int = 64) -> None:
    """Upsert processes from new raw versions, the newest of each."""
    made = normalize.processes(raw.latest(fresh, ROW, [F.desc("seen_at"), F.desc("content")])).where("process_id IS NOT NULL")
    tx.upsert("process", made, KEYS["process"], [F.col("row_id").desc()], buckets)


def _of(df: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of df whose columns a row of keys has; nulls are alike."""
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in columns))
    return df.join(keys.select(*(F.col(c).alias(f"__r_{c}") for c in columns)), same, "left_semi")
