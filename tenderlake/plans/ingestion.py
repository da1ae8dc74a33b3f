"""Queries of the ingest side: cycles over a store, its tables, and what they must come to.

Each makes its own store in the shared folder. A session without such a folder,
on a cluster, is an error. Each is registered in the catalogue with its oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, table
from ..sources import cycles, days, pages
from ..sources.store import Store

from .catalog import QUERIES, query
from .reports import raw_contracts

#: The first day read, and the days until which the cycles read.
START, UNTIL = date(1995, 1, 1), (date(1997, 6, 30), date(1997, 12, 31), date(1998, 12, 31))
#: Buckets of a store's tables at least, and bytes of the orders' files for one of them.
BUCKETS, BUCKET_BYTES = 4, 4 << 20


def buckets(spark: SparkSession, sf: str) -> int:
    """As many buckets as keep a bucket's size the same however many orders there are."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf}/orders.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(BUCKETS, -(-size // BUCKET_BYTES))


def new_store(spark: SparkSession, name: str) -> Store:
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return Store(spark, f"{folder}/stores/{uuid.uuid4().hex}-{name}")


def published_contracts(spark: SparkSession, sf: str, first: date, last: date) -> DataFrame:
    """What the source gives for a range of days when asked on its last day: contracts appear up to 11 days after they were signed."""
    rows = raw_contracts(spark, sf, (first, last)).select("row_id", "content", "seen_at", F.col("signed_on").alias("fact_on"))
    appears = F.date_add(F.to_date("seen_at"), (F.col("row_id").cast("long") % 12).cast("int"))
    return rows.where(appears <= F.lit(last))


def three_cycles(spark: SparkSession, sf: str, derive: Callable = cycles.derive_contracts) -> Store:
    store, n = new_store(spark, "cycles"), buckets(spark, sf)
    for k, until in enumerate(UNTIL):
        cycles.run_cycle(
            store, "contracts", lambda first, last: published_contracts(spark, sf, first, last), until, start=None if k else START,
            derive=derive, now=datetime(until.year, until.month, until.day) + timedelta(1), buckets=n,
        )
    return store


#: The source's rows; then each cycle reads a range and keeps what is not in the ones before.
SOURCE = """WITH said AS (
  SELECT o_orderkey AS n, v, CAST(o_orderdate AS DATE) AS fact, CAST(o_orderdate AS DATE) + CAST(v AS INTEGER) + CAST(o_orderkey % 12 AS INTEGER) AS appears, o_custkey, CASE WHEN v = 1 THEN 'Z' ELSE o_orderstatus END AS state
  FROM orders, (VALUES (0), (1)) t(v) WHERE v = 0 OR o_orderkey % 9 = 0)"""


def _cycle_sql() -> str:
    out = [SOURCE, f"c0 AS (SELECT DATE '{START}' AS first, CAST(NULL AS DATE) AS mark)"]
    known = "SELECT n, v FROM said WHERE false"
    for k, until in enumerate(UNTIL, 1):
        if k > 1:
            out.append(f"c{k - 1} AS (SELECT mark - 45 AS first, mark FROM (SELECT greatest(max(fact), (SELECT mark FROM c{k - 2})) AS mark FROM new{k - 1}))")
        out.append(f"seen{k} AS (SELECT said.* FROM said, c{k - 1} WHERE fact BETWEEN first AND DATE '{until}' AND appears <= DATE '{until}')")
        out.append(f"new{k} AS (SELECT * FROM seen{k} WHERE (n, v) NOT IN ({known}))")
        out.append(f"ids{k} AS (SELECT DISTINCT n FROM ({known}))")
        known += f" UNION ALL SELECT n, v FROM new{k}"
    rows = []
    for k in range(1, len(UNTIL) + 1):
        edge = "fact = first" if k > 1 else "false"
        rows.append(f"""SELECT {k} AS cycle, first, (SELECT count(*) FROM seen{k}) AS seen, count(*) AS inserted, count(*) FILTER (WHERE n NOT IN (FROM ids{k})) AS new, count(*) FILTER (WHERE n IN (FROM ids{k})) AS changed,
          (SELECT count(*) FROM seen{k}) - count(*) AS duplicates, count(*) FILTER (WHERE fact < mark) AS recovered, count(*) FILTER (WHERE {edge} AND n NOT IN (FROM ids{k})) AS short_window,
          count(*) FILTER (WHERE {edge} AND n IN (FROM ids{k})) AS changed_on_edge, greatest(max(fact), any_value(mark)) AS watermark FROM new{k}, c{k - 1} GROUP BY first""")
    return ", ".join(out) + " " + " UNION ALL ".join(rows)


@query(_cycle_sql(), prelude=False)
def cycle_log(spark, sf):
    """Three cycles with an overlap of 45 days: what each saw, kept, recovered and missed at the edge, and its watermark."""
    log = three_cycles(spark, sf).read("cycle").where("state = 'complete'")
    number = sum(((F.col("last") > F.lit(u)).cast("int") for u in UNTIL), F.lit(1))
    return log.select(number.alias("cycle"), "first", "seen", "inserted", "new", "changed", "duplicates", "recovered", "short_window", "changed_on_edge", F.col("watermark_after").alias("watermark"))


@query(f"""{SOURCE}, last AS (SELECT max_by(struct_pack(n := n, o_custkey := o_custkey, state := state), v) AS r FROM said WHERE fact BETWEEN DATE '{START}' AND DATE '{UNTIL[-1]}' AND appears <= DATE '{UNTIL[-1]}' GROUP BY n),
  contract AS (SELECT r.n AS n, r.state AS state, CASE WHEN r.n % 19 = 0 THEN CASE WHEN r.n % 38 = 0 THEN 'G' END ELSE ['NIT', 'CC', 'NONE'][r.n % 3 + 1] END AS kind, CASE WHEN r.n % 38 = 0 THEN 'C' || r.n WHEN r.n % 19 <> 0 THEN lpad(r.o_custkey::VARCHAR, 6, '0') END AS number, r.o_custkey % 50 AS name FROM last)
  SELECT 'contract' AS name, count(*) AS rows, count(*) FILTER (WHERE state = 'Z') AS said FROM contract
  UNION ALL SELECT 'supplier', count(*), CAST(sum(c) AS BIGINT) FROM (SELECT count(*) AS c FROM contract WHERE number IS NOT NULL GROUP BY kind, number)
  UNION ALL SELECT 'variant', count(*), CAST(sum(c) AS BIGINT) FROM (SELECT count(*) AS c FROM contract WHERE number IS NOT NULL GROUP BY kind, number, name)
  UNION ALL SELECT 'process', count(*), count(*) FILTER (WHERE o_orderkey % 2 = 0) FROM orders WHERE o_orderkey % 4 <> 0""", prelude=False)
def store_tables(spark, sf):
    """The four derived tables after three cycles of upserts by bucket, and one of processes: as a rewrite from all rows would have them."""
    store = three_cycles(spark, sf)
    n = F.col("o_orderkey")
    said = F.to_json(F.struct(F.concat(F.lit("P"), n).alias("id_del_proceso"), F.when(n % 2 == 0, "Sí").otherwise("No").alias("adjudicado")))
    rows = table(spark, sf, "orders").where("o_orderkey % 4 <> 0").select(F.lpad(n.cast("string"), 12, "0").alias("row_id"), said.alias("content"), F.col("o_orderdate").cast("timestamp").alias("seen_at"), F.to_date("o_orderdate").alias("fact_on"))
    cycles.run_cycle(store, "processes", lambda first, last: rows.where(F.col("fact_on").between(F.lit(first), F.lit(last))), date(2100, 1, 1), start=date(1990, 1, 1), derive=cycles.derive_processes, now=datetime(2000, 1, 2), buckets=buckets(spark, sf))
    count = lambda name, said: store.read(name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), said.alias("said"))
    out = count("contract", F.count_if(F.col("state") == "Z")).unionByName(count("process", F.count_if("awarded")))
    return out.unionByName(count("supplier", F.sum("contracts"))).unionByName(count("variant", F.sum("contracts")))


def landed_folder(spark: SparkSession, name: str) -> str:
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder}/pages/{uuid.uuid4().hex}-{name}"


RANGE = date(1996, 2, 1), date(1996, 4, 30)


@query(f"SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS contracts, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' GROUP BY 1", prelude=False)
def paged_range(spark, sf):
    """A range of days read from landed pages: only the pages whose days meet the range are opened."""
    pages.register(spark)
    folder = landed_folder(spark, "range")
    n = F.col("o_orderkey")
    pages.land(table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), F.to_json(F.struct(n.alias("key"))).alias("content")), folder, 100)
    rows = spark.read.format("dated_pages").load(folder).where(F.col("day").between(*map(F.lit, RANGE)))
    return rows.groupBy("day").agg(F.count(F.lit(1)).alias("contracts"), F.sum(F.get_json_object("content", "$.key").cast("long")).alias("keys"))


def _stream_sql() -> str:
    out, marks, known = [SOURCE], ["NULL"], "SELECT n, v FROM said WHERE false"
    for k, until in enumerate(UNTIL, 1):
        first = f"mark{k - 1}.mark - 45" if k > 1 else "DATE '1900-01-01'"
        last = f", mark{k - 1}" if k > 1 else ""
        out.append(f"seen{k} AS (SELECT said.* FROM said{last} WHERE fact >= {first} AND appears <= DATE '{until}')")
        out.append(f"new{k} AS (SELECT * FROM seen{k} WHERE (n, v) NOT IN ({known}))")
        out.append(f"mark{k} AS (SELECT max(fact) AS mark FROM said WHERE appears <= DATE '{until}')")
        known += f" UNION ALL SELECT n, v FROM new{k}"
    rows = [f"SELECT {k - 1} AS batch, (SELECT count(*) FROM seen{k}) AS seen, count(*) AS inserted, {f'count(*) FILTER (WHERE fact < (FROM mark{k - 1}))' if k > 1 else 'CAST(0 AS BIGINT)'} AS recovered FROM new{k}" for k in range(1, len(UNTIL) + 1)]
    return ", ".join(out) + " " + " UNION ALL ".join(rows)


@query(_stream_sql(), prelude=False)
def paged_stream(spark, sf):
    """Three landings followed as a stream with an overlap of 45 days: rows read, rows kept, and those of them older than the watermark before."""
    pages.register(spark)
    folder, store, n = landed_folder(spark, "stream"), new_store(spark, "stream"), buckets(spark, sf)
    fact = F.to_date(F.substring(F.get_json_object("content", "$.fecha_de_firma"), 1, 10))
    appears = F.date_add(F.to_date("seen_at"), (F.col("row_id").cast("long") % 12).cast("int"))
    rows = raw_contracts(spark, sf).select(fact.alias("day"), appears.alias("appears"), F.to_json(F.struct("row_id", F.col("content").alias("said"))).alias("content"))

    def keep(batch: DataFrame, number: int) -> None:
        def change(tx) -> None:
            if tx.record["values"].get("batch", {}).get("last", -1) >= number:
                return  # this batch was committed before the stream was
            mark = tx.record["values"].get("watermark", {}).get("day")
            said = batch.select(F.get_json_object("content", "$.row_id").alias("row_id"), F.sha2("content", 256).alias("hash"), "day")
            fresh = tx.insert("raw", said.observe(seen := Observation(), F.count(F.lit(1)).alias("rows"), F.max("day").alias("day")), ["row_id", "hash"], ["row_id"], n)
            late = F.count_if(F.col("day") < F.lit(mark).cast("date")) if mark else F.lit(0)
            found = fresh.agg(F.count(F.lit(1)).alias("inserted"), late.cast("long").alias("recovered")).first()
            tx.append("batches", spark.createDataFrame([(number, seen.get["rows"], found.inserted, found.recovered)], "batch int, seen long, inserted long, recovered long").coalesce(1))
            day = seen.get["day"]
            tx.put("watermark", "day", max(filter(None, (mark, day and day.isoformat())), default=None))
            tx.put("batch", "last", number)

        store.retried(change)

    checkpoint = f"{folder}/checkpoint"
    for before, until in zip((None, *UNTIL), UNTIL):
        came = (F.col("appears") <= F.lit(until)) & (F.col("appears") > F.lit(before) if before else F.lit(True))
        pages.land(rows.where(came), folder, 200)
        stream = spark.readStream.format("dated_pages").option("overlap", "45").load(folder)
        stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return store.read("batches")


#: A window of which the last cycle changes days, and one of the first cycle.
WINDOW, OLD = (date(1997, 11, 15), date(1998, 1, 15)), (date(1995, 3, 1), date(1995, 6, 30))


def _window_sql(label: str, first: date, last: date) -> str:
    return f"""SELECT '{label}' AS window_, '{{period}}' AS period, count(*) AS contracts, coalesce(sum(value), 0)::DOUBLE AS value, count(DISTINCT entity) AS entities, count(DISTINCT (kind, number)) FILTER (WHERE number IS NOT NULL AND kind <> 'G') AS suppliers FROM contract WHERE fact BETWEEN DATE '{first}' AND DATE '{last}'"""


def _days_sql() -> str:
    rows = []
    for label, (first, last) in (("new", WINDOW), ("old", OLD)):
        length = timedelta((last - first).days + 1)
        rows += [_window_sql(label, first, last).format(period="now"), _window_sql(label, first - length, last - length).format(period="before")]
    return f"""{SOURCE}, last AS (SELECT DISTINCT n, fact, o_custkey AS entity FROM said WHERE fact BETWEEN DATE '{START}' AND DATE '{UNTIL[-1]}' AND appears <= DATE '{UNTIL[-1]}'),
      contract AS (SELECT last.*, CASE WHEN n % 11 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS value, CASE WHEN n % 19 = 0 THEN CASE WHEN n % 38 = 0 THEN 'G' END ELSE ['NIT', 'CC', 'NONE'][n % 3 + 1] END AS kind,
        CASE WHEN n % 38 = 0 THEN 'C' || n WHEN n % 19 <> 0 THEN lpad(entity::VARCHAR, 6, '0') END AS number FROM last JOIN orders ON o_orderkey = n) {" UNION ALL ".join(rows)}"""


@query(_days_sql(), prelude=False)
def windows_from_days(spark, sf):
    """Windows and the periods before them from states by day, after three cycles that remade the days they touched: as a full recomputation has them."""
    store = three_cycles(spark, sf, days.derive)
    both = [days.period_pair(store, *w).withColumn("window_", F.lit(label)) for label, w in (("new", WINDOW), ("old", OLD))]
    return both[0].unionByName(both[1])


NAMES = tuple(n for n, f in QUERIES.items() if f.__module__ == __name__)
