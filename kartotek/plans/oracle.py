"""Common table expressions shared by the DuckDB twins of the registered queries."""


def code(prefix: str, number: str, width: int = 9) -> str:
    return f"('{prefix}' || lpad(({number})::varchar, {width}, '0'))"


KPI_ID = code("N", "p_partkey")
TABLE_ID = code("T", "p_partkey")


def own_id(every: int, prefix: str) -> str:
    """Table id; every so many rows have one that only their side knows."""
    return f"(CASE WHEN p_partkey % {every} = 0 THEN {code(prefix, 'p_partkey')} ELSE {TABLE_ID} END)"


FLAT_ID, WEB_ID, FOLDER_ID = own_id(5, "X"), own_id(4, "Y"), own_id(10, "Z")
ORDER_ID = code("O", "o_orderkey")
UNIT_ID = code("V", "s_suppkey")
AREA_ID = "lpad(n_nationkey::varchar, 4, '0')"

OBS = f"""obs AS (
  SELECT {code('N', 'l_partkey')} AS kpi, year(l_shipdate)::bigint AS period,
         lpad(s_nationkey::varchar, 4, '0') AS entity, l_returnflag AS gender,
         CASE WHEN l_linestatus = 'O' THEN l_quantity END AS value,
         l_discount >= 0.09::double AS isdeleted
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
LIVE = "live AS (SELECT * FROM obs WHERE value IS NOT NULL AND NOT isdeleted)"

KPIS = f"""kpis AS (
  SELECT p_partkey, {KPI_ID} AS kpi_id,
         p_name || CASE WHEN p_partkey % 50 = 0 THEN ' (-1998)' WHEN p_partkey % 11 = 0 THEN ' ( - 2030 )' ELSE '' END
           || CASE WHEN p_partkey % 13 = 0 THEN ' Källa: ' || p_type || '.' ELSE '' END AS title,
         CASE p_partkey % 5 WHEN 1 THEN 'Räknat per kilometer. Källa: Trafikverket, bl.a. VTI. Se ovan.' WHEN 2 THEN 'Ingen'
              WHEN 3 THEN 'Källor: ' || p_brand || '. Mer' WHEN 4 THEN 'Källa:' END AS description,
         p_size % 2 = 0 AS is_divided_by_gender, p_partkey % 4 = 0 AS has_ou_data,
         CASE p_partkey % 3 WHEN 1 THEN 'K' WHEN 2 THEN 'L' ELSE 'A' END AS scope_type,
         p_type AS operating_area, p_brand, p_size,
         CASE WHEN p_partkey % 5 = 1 THEN 'Trafikverket, bl.a. VTI' WHEN p_partkey % 5 = 3 THEN p_brand
              WHEN p_partkey % 13 = 0 THEN p_type ELSE 'Kolada' END AS source,
         CASE WHEN p_partkey % 5 IN (1, 3) THEN 'description'
              WHEN p_partkey % 13 = 0 THEN 'title' ELSE 'fallback' END AS origin,
         CASE WHEN p_partkey % 50 = 0 THEN 1998 WHEN p_partkey % 11 = 0 THEN 2030 END AS retired
  FROM part WHERE p_partkey % 97 <> 5)"""

AREAS = f"""areas AS (
  SELECT {AREA_ID} AS area_id, CASE WHEN n_nationkey % 10 = 3 THEN {AREA_ID} ELSE n_name END AS title,
         CASE WHEN n_regionkey < 3 THEN 'K' ELSE 'L' END AS type FROM nation)"""

UNITS = f"""units AS (
  SELECT {UNIT_ID} AS ou_id, CASE WHEN s_suppkey % 20 = 7 THEN {UNIT_ID} ELSE s_name END AS title,
         CASE WHEN s_suppkey % 30 = 11 THEN '9999' ELSE lpad(s_nationkey::varchar, 4, '0') END AS area_id
  FROM supplier WHERE s_suppkey % 25 <> 3)"""

GROUPS = f"""members AS (
  SELECT p_brand || '/' || (p_partkey // 100) AS group_id, 'Grupp ' || p_brand AS title, {KPI_ID} AS kpi_id
  FROM part WHERE NOT (p_brand = 'Brand#1' AND (p_partkey // 100) % 7 = 6)
  UNION
  SELECT p_brand || '/' || (p_partkey // 100), 'Grupp ' || p_brand, 'X' || (p_partkey // 100)
  FROM part WHERE NOT (p_brand = 'Brand#1' AND (p_partkey // 100) % 7 = 6))"""

STATE = f"""state AS (
  SELECT CASE WHEN o_orderkey % 10 = 9 THEN {code('X', 'o_orderkey')} ELSE {ORDER_ID} END AS dataset_code,
         CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 1 DAY
              WHEN o_orderkey % 19 <> 0 THEN o_orderdate END AS source_updated_at,
         CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate + INTERVAL 30 DAY END AS last_fetched_at,
         (o_orderstatus = 'F' AND o_orderkey % 3 = 0) AS has_error
  FROM orders)"""

CANDIDATES = f"""candidates AS (
  SELECT {ORDER_ID} AS dataset_code, o_orderdate AS updated, o_orderkey, o_orderstatus, o_custkey FROM orders)"""

SELECTION = """selection AS (
  SELECT c.*, s.dataset_code IS NOT NULL AS known, s.source_updated_at, s.last_fetched_at, s.has_error,
         (s.dataset_code IS NULL OR s.last_fetched_at IS NULL OR s.has_error OR s.source_updated_at IS NULL
          OR c.updated <> s.source_updated_at) AS should_fetch
  FROM candidates c LEFT JOIN state s USING (dataset_code))"""

OUTCOMES = f"""outcomes AS (
  SELECT strftime(ts, '%Y%m%d') AS run_id, ts, {code('D', 'user_id')} AS dataset_code,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'saved' WHEN event_type = 'error' THEN 'failed'
              ELSE 'skipped' END AS outcome,
         date_trunc('hour', ts) AS source_updated_at, event_id, value
  FROM events)"""

FLAT = f"""flat AS (
  SELECT CASE WHEN p_partkey % 2 = 0 THEN lower({FLAT_ID}) ELSE {FLAT_ID} END AS id, lower({FLAT_ID}) AS id_key,
         CASE WHEN p_partkey % 3 = 0 THEN '/' || p_type ELSE '/' || p_type || '/' || p_brand END AS path_key,
         CASE WHEN p_partkey % 6 <> 1 THEN p_name || ' ' || c.copy END AS title,
         CASE WHEN p_partkey % 4 = 1 THEN '2021-05-06T07:08:09Z' END AS updated, p_partkey, p_name, c.copy
  FROM part, (VALUES (0), (1)) c(copy) WHERE c.copy = 0 OR p_partkey % 7 = 0)"""

WEB = f"""web AS (
  SELECT {WEB_ID} AS table_id, lower({WEB_ID}) AS id_key, '/' || p_type || '/' || p_brand AS path_key,
         'Webb ' || p_name AS title, p_partkey, p_type, p_brand FROM part)"""

FOLDER = f"""folder AS (
  SELECT '/' || p_type || '/' || p_brand AS path_key, lower({FOLDER_ID}) AS id_key, 'Mapp ' || p_name AS text
  FROM part)"""

AXES = """axis_rows AS (
  SELECT *, (row_number() OVER (PARTITION BY dataset_code, pos ORDER BY cat_id) - 1)::bigint AS ordinal,
         count(*) OVER (PARTITION BY dataset_code, pos)::bigint AS n
  FROM (SELECT DISTINCT 'D' || (p_partkey // 50) AS dataset_code, p_partkey // 50 AS block, 0::bigint AS pos, 'Typ' AS dim_id,
               p_type AS cat_id, lower(p_type) AS label FROM part
        UNION ALL
        SELECT DISTINCT 'D' || (p_partkey // 50), p_partkey // 50, 1, 'ContentsCode', p_brand, p_brand || ' st' FROM part
        UNION ALL
        SELECT DISTINCT 'D' || (p_partkey // 50), p_partkey // 50, 2, 'Tid', (p_size + 1950)::varchar, (p_size + 1950)::varchar FROM part))"""

CHAIN = """pages_ AS (
  SELECT conv_id, turn, EXISTS (SELECT 1 FROM conversations d WHERE d.conv_id = c.conv_id AND d.turn = c.turn + 1) AS more
  FROM conversations c WHERE NOT (conv_id % 5 = 1 AND turn = 1)),
chain AS (SELECT conv_id, turn, CASE WHEN more THEN turn + 1 WHEN conv_id % 5 = 2 THEN 0 END AS nxt FROM pages_)"""

OCCURRENCES = f"""occ AS (
  SELECT {code('T', 'l_partkey')} AS id, '/s' || l_suppkey AS path, l_partkey, l_suppkey, l_shipdate, l_orderkey, l_linenumber
  FROM lineitem)"""

NAV = f"""nav_nation AS (SELECT n_nationkey, n_regionkey, '/R' || n_regionkey || '/N' || n_nationkey AS path FROM nation),
nav_customer AS (
  SELECT n.path AS path, 'c' || lpad(c_custkey::varchar, 9, '0') || '.px' AS id, c_custkey, c_name, n.n_nationkey, n.n_regionkey
  FROM customer JOIN nav_nation n ON c_nationkey = n_nationkey)"""
