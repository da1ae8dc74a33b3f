"""The panel as one document, registered in the catalogue with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import blocks, quality, report
from . import bindings as b
from .catalog import CASES, EDGES, QUERIES, query

ORDER = ("window", "coverage", "errata", "suppliers", "suppliers_of_several_names", "ventures", "levels", "departments", "entities", "modalities", "buckets", "impossible_ventures", "largest", "by_day")
MODALITY = "(SELECT process_id, modality FROM process)"


def _groups_sql(name: str, fields: str, source: str, most: int, order: str = "v DESC") -> str:
    return f"""'"{name}":' || coalesce((SELECT '[' || string_agg(left(key, length(key) - 1) || ',"contracts":' || n || ',"value":' || v || '}}', ',' ORDER BY {order}, key) || ']' FROM
      (SELECT * FROM (SELECT to_json({{{fields}}})::VARCHAR AS key, count(*) AS n, CAST(coalesce(round(sum(value), 0), 0) AS BIGINT) AS v FROM {source} GROUP BY 1) ORDER BY {order}, key LIMIT {most})), 'null')"""


def _rows_sql(name: str, select: str, order: str, most: int) -> str:
    return f"""'"{name}":' || coalesce((SELECT to_json(list(t ORDER BY {order}))::VARCHAR FROM (SELECT * FROM ({select}) ORDER BY {order} LIMIT {most}) t), 'null')"""


WHOLE = "CAST(coalesce(round(sum(value){0}, 0), 0) AS BIGINT)"
SQL = f"""SELECT '{{' || concat_ws(',',
  '"window":' || (SELECT to_json(t)::VARCHAR FROM (SELECT min(signed_on)::VARCHAR AS first_day, max(signed_on)::VARCHAR AS last_day, count(*) AS contracts, {WHOLE.format('')} AS value, count(DISTINCT entity_id) AS entities, count(DISTINCT (supplier_type, supplier_number)) FILTER (WHERE provisional IS FALSE) AS suppliers FROM pub) t),
  '"coverage":' || (SELECT to_json(t)::VARCHAR FROM (SELECT count(*) AS contracts, count(*) FILTER (WHERE provisional IS FALSE) AS identified, count(*) FILTER (WHERE provisional) AS ventures, {WHOLE.format(' FILTER (WHERE provisional)')} AS ventures_value, count(*) FILTER (WHERE supplier_type IS NULL) AS without_identity,
    count(process_id) AS linked, count(*) FILTER (WHERE process_id IS NULL AND link_key IS NOT NULL) AS orphans, count(*) FILTER (WHERE department IS NULL) AS without_department, count(*) FILTER (WHERE admin_level IS NULL) AS without_level, count(*) FILTER (WHERE value IS NULL) AS without_value,
    count(*) FILTER (WHERE out_of_scale) AS impossible, {WHOLE.format(' FILTER (WHERE out_of_scale)')} AS impossible_value, count(*) FILTER (WHERE is_errata) AS errata, {WHOLE.format(' FILTER (WHERE is_errata)')} AS errata_value FROM c) t),
  {_rows_sql('errata', "SELECT contract_id, CAST(round(value, 0) AS BIGINT) AS value, CAST(round(base, 0) AS BIGINT) AS budget, zeros FROM (SELECT contract_id, c.value AS value, base, zeros FROM c JOIN errata USING (process_id))", "value DESC NULLS LAST, contract_id", 25)},
  {_groups_sql('suppliers', "name: supplier_name, kind: supplier_type, number: supplier_number", "(SELECT * FROM pub WHERE provisional IS FALSE)", 20)},
  {_rows_sql('suppliers_of_several_names', "SELECT supplier_type AS kind, supplier_number AS number, count(DISTINCT supplier_name) AS names, count(*) AS contracts FROM c WHERE supplier_number IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT supplier_name) > 1", "names DESC, contracts DESC, kind, number", 10)},
  {_rows_sql('ventures', "SELECT contract_id, entity_name AS entity, CAST(round(value, 0) AS BIGINT) AS value FROM pub WHERE provisional", "value DESC NULLS LAST, contract_id", 15)},
  {_groups_sql('levels', "level: coalesce(admin_level, 'SIN DECLARAR')", "pub", 10)}, {_groups_sql('departments', "department: department", "(SELECT * FROM pub WHERE department IS NOT NULL)", 12)}, {_groups_sql('entities', "id: entity_id, name: entity_name", "pub", 20)},
  {_groups_sql('modalities', "modality: coalesce(modality, 'Sin proceso enlazado')", f"(SELECT pub.*, modality FROM pub LEFT JOIN {MODALITY} USING (process_id))", 12, "n DESC")},
  {_groups_sql('buckets', f"bucket: CASE {CASES} ELSE {len(EDGES) + 1} END", "(SELECT * FROM pub WHERE value IS NOT NULL)", 10, "1")},
  {_rows_sql('impossible_ventures', "SELECT contract_id FROM c WHERE out_of_scale AND provisional AND value < 0", "contract_id", 5)},
  {_rows_sql('largest', "SELECT contract_id, CAST(round(value, 0) AS BIGINT) AS value, signed_on::VARCHAR AS signed_on, supplier_type AS kind FROM pub", "value DESC NULLS LAST, contract_id", 40)},
  {_groups_sql('by_day', "day: signed_on::VARCHAR", "(SELECT * FROM pub WHERE signed_on IS NOT NULL)", 4000, "1")}) || '}}' AS document"""


@query(SQL)
def panel_document(spark, sf):
    """The whole panel: figures, coverage, lists and groups in one document; a list without items is null."""
    every = quality.flagged(b.contracts(spark, sf), b.errata(spark, sf))
    shown = b.published(spark, sf)
    kinds = b.processes(spark, sf).select("process_id", "modality")
    rows = shown.join(kinds, "process_id", "left")
    value = F.round("value", 0).cast("long").alias("value")
    c, when = F.col, lambda name, condition: F.count_if(condition).alias(name)
    window = shown.agg(F.min("signed_on").cast("string").alias("first_day"), F.max("signed_on").cast("string").alias("last_day"), blocks.rows().alias("contracts"), report.whole(c("value")).alias("value"), F.countDistinct("entity_id").alias("entities"), F.count_distinct(F.when(blocks.real(), blocks.supplier())).alias("suppliers"))
    wrong, venture = F.coalesce("out_of_scale", F.lit(False)), F.coalesce("provisional", F.lit(False))
    of = lambda name, condition: report.whole(F.when(condition, c("value"))).alias(name)
    coverage = every.agg(
        blocks.rows().alias("contracts"), when("identified", blocks.real()), when("ventures", venture), of("ventures_value", venture), when("without_identity", c("supplier_type").isNull()), F.count("process_id").alias("linked"),
        when("orphans", c("process_id").isNull() & c("link_key").isNotNull()), when("without_department", c("department").isNull()), when("without_level", c("admin_level").isNull()), when("without_value", c("value").isNull()),
        when("impossible", wrong), of("impossible_value", wrong), when("errata", c("is_errata")), of("errata_value", c("is_errata")),
    )
    groups = report.of_groups(rows, {
        "suppliers": report.Groups({"name": c("supplier_name"), "kind": c("supplier_type"), "number": c("supplier_number")}, 20, blocks.real()),
        "levels": report.Groups({"level": F.coalesce("admin_level", F.lit("SIN DECLARAR"))}, 10), "departments": report.Groups({"department": c("department")}, 12, c("department").isNotNull()),
        "entities": report.Groups({"id": c("entity_id"), "name": c("entity_name")}, 20), "modalities": report.Groups({"modality": F.coalesce("modality", F.lit("Sin proceso enlazado"))}, 12, order="contracts"),
        "buckets": report.Groups({"bucket": V.bucket(c("value"), EDGES)}, 10, c("value").isNotNull(), "key"), "by_day": report.Groups({"day": c("signed_on").cast("string")}, 4000, c("signed_on").isNotNull(), "key"),
    })
    largest_first = [F.desc_nulls_last("value"), c("contract_id")]
    typed = b.contracts(spark, sf).join(b.errata(spark, sf).select("process_id", "base", "zeros"), "process_id").select("contract_id", value, F.round("base", 0).cast("long").alias("budget"), "zeros")
    names = b.contracts(spark, sf).where("supplier_number IS NOT NULL").groupBy(c("supplier_type").alias("kind"), c("supplier_number").alias("number")).agg(F.countDistinct("supplier_name").alias("names"), blocks.rows().alias("contracts")).where("names > 1")
    parts = [
        report.of_figures("window", window), report.of_figures("coverage", coverage), groups, report.of_rows("errata", typed, largest_first, 25),
        report.of_rows("suppliers_of_several_names", names, [F.desc("names"), F.desc("contracts"), c("kind"), c("number")], 10),
        report.of_rows("ventures", shown.where("provisional").select("contract_id", c("entity_name").alias("entity"), value), largest_first, 15),
        report.of_rows("impossible_ventures", every.where(wrong & venture & (c("value") < 0)).select("contract_id"), [c("contract_id")], 5),
        report.of_rows("largest", shown.select("contract_id", value, c("signed_on").cast("string").alias("signed_on"), c("supplier_type").alias("kind")), largest_first, 40),
    ]
    return report.document(parts, ORDER)


NAMES = tuple(n for n, f in QUERIES.items() if f.__module__ == __name__)
