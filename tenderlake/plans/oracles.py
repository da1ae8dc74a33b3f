"""DuckDB's form of bindings.py, which every oracle starts with."""

JOINT_VENTURE = "UNION TEMPORAL O CONSORCIO SIN DOCUMENTO"

PRELUDE = f"""
WITH snapshot AS (
  SELECT l_orderkey AS process_id, l_shipdate AS seen_at, l_linenumber AS line, l_partkey AS part_id, l_suppkey AS bidder, p_type AS modality,
    CAST(p_retailprice AS DECIMAL(18,2)) AS base,
    CAST(CASE WHEN l_orderkey % 5 = 0 AND l_linenumber % 3 = 0 THEN CAST(p_retailprice AS DECIMAL(18,2)) * 1000
      WHEN l_orderkey % 7 = 0 AND l_linenumber = 2 THEN CAST(p_retailprice AS DECIMAL(18,2)) * 100 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS award,
    l_returnflag <> 'N' AS awarded, CAST(l_shipdate AS DATE) AS published_on, l_quantity AS quantity, l_linenumber % 3 AS bidders, l_partkey % 1000 AS views, p_brand AS brand
  FROM lineitem JOIN part ON l_partkey = p_partkey
), process AS (
  SELECT * FROM snapshot QUALIFY row_number() OVER (PARTITION BY process_id ORDER BY seen_at DESC, line, part_id, bidder, award, quantity) = 1
), ratio AS (
  SELECT *, award::DOUBLE / base::DOUBLE AS ratio FROM snapshot WHERE awarded AND base > 0
  QUALIFY row_number() OVER (PARTITION BY process_id ORDER BY seen_at DESC, line, part_id, bidder, award, quantity) = 1
), errata AS (
  SELECT *, CAST(round(log10(ratio)) AS INTEGER) AS zeros FROM ratio WHERE ratio >= 100 AND abs(ratio / pow(10, round(log10(ratio))) - 1) < 0.001
), contract AS (
  SELECT o_orderkey AS contract_id, o_custkey AS entity_id, c_name AS entity_name, CAST(o_orderdate AS DATE) AS signed_on, o_orderstatus AS state,
    CAST(CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 499 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) * 1000000 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS value,
    CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey END AS link_key, process_id,
    CASE WHEN o_orderkey % 19 = 0 THEN '{JOINT_VENTURE}' WHEN bidder IS NOT NULL AND o_orderkey % 17 <> 0 THEN ['NIT', 'CEDULA DE CIUDADANIA', 'PASAPORTE'][bidder % 3 + 1] END AS supplier_type,
    CASE WHEN o_orderkey % 19 = 0 THEN o_orderkey::VARCHAR WHEN bidder IS NOT NULL AND o_orderkey % 17 <> 0 THEN lpad(bidder::VARCHAR, 6, '0') END AS supplier_number,
    CASE WHEN bidder % 23 = 0 THEN 'No Definido' ELSE s_name END AS supplier_name,
    ['NACIONAL', 'TERRITORIAL', NULL][n_regionkey % 3 + 1] AS admin_level, CASE WHEN o_custkey % 29 <> 0 THEN n_name END AS department
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT process_id, bidder FROM process) ON process_id = CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey END LEFT JOIN supplier ON bidder = s_suppkey
), c AS (
  SELECT *, supplier_type = '{JOINT_VENTURE}' AS provisional, value >= 1000000000 AS out_of_scale,
    process_id IS NOT NULL AND process_id IN (SELECT process_id FROM errata) AS is_errata FROM contract
), pub AS (SELECT * FROM c WHERE NOT is_errata AND out_of_scale IS NOT TRUE
), small AS (
  SELECT o_custkey % 200 AS entity_id, l_suppkey % 10 AS supplier_number, CAST(o_orderdate AS DATE) AS signed_on, CAST(l_extendedprice AS DECIMAL(18,2)) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity <= 10
), stay AS (
  SELECT o_custkey AS person, o_orderkey % 7 AS entity, o_orderkey AS stay_id, CAST(o_orderdate AS DATE) AS start, published_on AS end_
  FROM orders JOIN process ON o_orderkey = process_id WHERE published_on >= CAST(o_orderdate AS DATE)
), version AS (SELECT event_type AS dataset, user_id AS row_id, ts AS seen_at, props AS content, event_id, value FROM events)
"""
