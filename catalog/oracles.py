"""The SQL of each query, for DuckDB on the same tables."""

_INITCAP = (
    "array_to_string(list_transform(string_split(lower({0}), ' '), "
    "lambda w: upper(w[1]) || w[2:]), ' ')"
)

_CELLS = ", ".join(
    f"CAST(trunc(coalesce(sum(CASE WHEN l_returnflag = '{c}' THEN l_quantity END), 0)) AS BIGINT)"
    f" AS {c}"
    for c in "ANR"
)

_NULL_STATUS = "SELECT * REPLACE (nullif(l_linestatus, 'O') AS l_linestatus) FROM lineitem"

_TRAILING = """
  SELECT * FROM lineitem
  WHERE year(l_shipdate) > (SELECT max(year(l_shipdate)) FROM lineitem) - 3
    AND l_linestatus = 'O' AND l_quantity IS NOT NULL
"""

_MEANS = """
  SELECT l_suppkey, avg(l_quantity) AS mean_quantity,
         avg(CAST(l_linenumber AS DOUBLE)) AS mean_line
  FROM ({0}) GROUP BY l_suppkey
"""

_CUSTOMER_NULLS = (
    "SELECT * REPLACE (nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment) FROM customer"
)

_STATUS = """
  SELECT o_orderkey, o_orderstatus, label AS status
  FROM orders LEFT JOIN (VALUES ('F', 'Filled / shipped'), ('O', 'Open order')) AS d(code, label)
    ON o_orderstatus = code
"""

_DATES = """
  SELECT o_orderkey, dt, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month
  FROM (
    SELECT o_orderkey, dt, try_cast(dt AS DATE) AS d
    FROM (
      SELECT o_orderkey,
             CASE WHEN o_orderstatus = 'P' THEN 'no date P'
                  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dt
      FROM orders))
"""


def _join_back(keys: str, columns: str, null_safe: bool, distinct: bool) -> str:
    names = keys.split(", ")
    operator = "IS NOT DISTINCT FROM" if null_safe else "="
    condition = " AND ".join(f"b.{name} {operator} t.{name}" for name in names)
    return f"""
      WITH source AS ({_NULL_STATUS}),
           totals AS (SELECT {keys}, {_CELLS} FROM source GROUP BY {keys}),
           base AS (SELECT {"DISTINCT" if distinct else ""} {columns} FROM source)
      SELECT b.*, t.A, t.N, t.R FROM base b LEFT JOIN totals t ON {condition}
    """


def _gate() -> str:
    names = (
        "region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations"
    ).split()
    return " UNION ALL ".join(
        f'SELECT \'{name}\' AS "table", count(*) AS rows, count(*) >= 1 AS passed FROM {name}'
        for name in names
    )


def _audit() -> str:
    names = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return " UNION ALL ".join(
        f'SELECT \'{name}\' AS "column", count(*) AS rows, '
        f"count(*) FILTER ({name} IS NULL) AS nulls FROM ({_CUSTOMER_NULLS})"
        for name in names
    )


ORACLES = {
    "lookup_string_left": _STATUS,
    "lookup_numeric_text": """
        SELECT c_custkey, c_nationkey, n_name AS nation
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
    "lookup_number_forms": """
        WITH less AS (
          SELECT rtrim(CAST(p_partkey AS VARCHAR), '0') AS digits, max(p_name) AS name FROM part GROUP BY 1
        ), coded AS (
          SELECT p_partkey, p_name, CAST(p_partkey AS VARCHAR) AS t, p_partkey % 8 AS f FROM part
        )
        SELECT p_partkey,
          CASE f WHEN 0 THEN ' 000' || t || '.000 ' WHEN 1 THEN t || 'e0' WHEN 2 THEN t || '00E-2'
            WHEN 3 THEN '+' || t WHEN 4 THEN t || '.00000000001'
            WHEN 5 THEN '1' || lpad(t, 35, '0') || '0000' WHEN 6 THEN '0.000000000000' || t || 'e12'
            ELSE 'no. ' || t END AS code,
          CASE WHEN f < 4 THEN 'whole ' || p_name WHEN f = 5 THEN 'long ' || p_name
            WHEN f = 6 THEN 'less ' || name END AS part
        FROM coded LEFT JOIN less ON rtrim(t, '0') = digits
    """,
    "lookup_chain": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_returnflag, l_linestatus, l_shipdate,
               o_orderpriority AS priority, c_mktsegment AS segment, n_name AS nation,
               {_INITCAP.format("string_split(trim(r_name || ', ' || n_name), ',')[1]")} AS city
        FROM lineitem
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey
        WHERE NOT contains(o_orderpriority, 'NOT SPECIFIED') AND o_orderpriority IS NOT NULL
          AND NOT contains(n_name, 'NATION_1') AND n_name IS NOT NULL
          AND NOT contains(r_name, 'AFRICA') AND NOT contains(r_name, 'Collapsed')
          AND r_name IS NOT NULL AND c_mktsegment IS NOT NULL
    """,
    "lookup_hot_key": """
        SELECT l_orderkey, l_linenumber, partkey, p_name AS part
        FROM (SELECT l_orderkey, l_linenumber,
                     CAST(CASE WHEN l_linenumber <= 2 THEN 0
                               WHEN l_linenumber > 3 THEN l_partkey END AS BIGINT) AS partkey
              FROM lineitem)
        LEFT JOIN part ON partkey = p_partkey
    """,
    "lookup_required_shuffled": """
        SELECT l_orderkey, l_linenumber, l_partkey, p_name AS part
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 5
    """,
    "label_match_shares": f"""
        SELECT avg(CAST(status IS NOT NULL AS INTEGER)) AS status_share,
               avg(CAST(o_orderkey IS NOT NULL AS INTEGER)) AS key_share
        FROM ({_STATUS})
    """,
    "invalid_label_filter": """
        SELECT * FROM (SELECT * REPLACE (nullif(p_name, 'red widget') AS p_name) FROM part)
        WHERE NOT contains(p_name, 'blue') AND NOT contains(p_name, 'anvil')
          AND p_name IS NOT NULL
    """,
    "null_keys_dropped": f"""
        SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM ({_CUSTOMER_NULLS})
        WHERE c_mktsegment IS NOT NULL
    """,
    "null_key_audit": _audit(),
    "drop_columns": "SELECT * EXCLUDE (l_tax, l_discount, l_extendedprice) FROM lineitem",
    "city_from_label": f"""
        SELECT p_partkey, label,
               {_INITCAP.format("string_split(trim(label), ',')[1]")} AS city
        FROM (SELECT p_partkey, '  ' || upper(p_name) || ', ' || p_brand || ' ' AS label FROM part)
    """,
    "date_parts": _DATES,
    "wide_to_long": """
        SELECT c_custkey, 'c_name' AS code, c_name AS label FROM customer
        UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
        UNION ALL SELECT c_custkey, 'c.segment', c_mktsegment FROM customer
    """,
    "preview_limit": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20",
    "value_profile": 'SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type',
    "row_count_gate": _gate(),
    "category_pivot": f"SELECT l_orderkey, {_CELLS} FROM lineitem GROUP BY l_orderkey",
    "category_pivot_large": """
        SELECT l_linestatus,
          CAST(coalesce(sum(amount) FILTER (l_returnflag = 'A'), 0) AS BIGINT) AS A,
          CAST(coalesce(sum(amount) FILTER (l_returnflag = 'N'), 0) AS BIGINT) AS N,
          CAST(coalesce(sum(amount) FILTER (l_returnflag = 'R'), 0) AS BIGINT) AS R
        FROM (SELECT *, CAST(l_orderkey AS BIGINT) * 1000000007 + l_linenumber AS amount FROM lineitem)
        GROUP BY l_linestatus
    """,
    "code_map_multiline": """
        SELECT c_custkey, c_nationkey, n_name AS nation
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
    "label_files": """
        SELECT 'region' AS section, CAST(r_regionkey AS VARCHAR) AS code, r_name AS label FROM region
    """,
    "label_files_split": """
        WITH ranked AS (
          SELECT *, replace(p_brand, '#', '_') AS section,
            row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n,
            count(*) OVER (PARTITION BY p_brand) AS total
          FROM part)
        SELECT section, CAST(p_partkey AS VARCHAR) AS code, p_name || ' / it''s' AS label,
          CAST(3 * n - 1 AS INTEGER) AS line_no FROM ranked
        UNION ALL
        SELECT section, 'last', CAST(p_partkey AS VARCHAR), CAST(3 * n + 1 AS INTEGER) FROM ranked WHERE n = total
    """,
    "checked_output": "SELECT 'orders' AS output, true AS exists, count(*) AS rows FROM orders",
    "merged_dimension": "SELECT * FROM customer",
    "output_manifest": """
        SELECT 'same' AS status, count(*) AS rows FROM orders
        UNION ALL SELECT 'added', count(*) FROM orders WHERE o_orderstatus = 'O' HAVING count(*) > 0
    """,
    "gated_rewrite": """
        SELECT o_custkey, count(*) AS late FROM orders
        WHERE o_orderstatus <> 'F' AND o_orderdate >= DATE '1998-01-01' GROUP BY o_custkey
    """,
    "csv_quotes": """
        SELECT p_partkey,
          'Lowell "Field", ' || p_name || chr(10) || '"' || p_brand || '""' AS p_name, p_size
        FROM part
    """,
    "csv_quarantine": """
        WITH forms AS (
          SELECT p_partkey, p_name, p_size, p_partkey % 10 AS f,
            p_partkey || ',"' || p_name || chr(10) || '""x""' || chr(34) || ',' || p_size AS plain
          FROM part)
        SELECT CASE WHEN f NOT IN (3, 6, 9) THEN p_partkey END AS p_partkey,
          CASE WHEN f NOT IN (3, 6, 9) THEN p_name || chr(10) || '"x"' END AS p_name,
          CASE WHEN f NOT IN (3, 6, 9) THEN p_size END AS p_size,
          CASE WHEN f IN (3, 6) THEN 'cells' WHEN f = 9 THEN 'type: p_size' END AS reason,
          CASE f WHEN 3 THEN p_partkey || ',' || p_name WHEN 6 THEN plain || ',7'
            WHEN 9 THEN p_partkey || ',' || p_name || ',size ' || p_size END AS record
        FROM forms
    """,
    "category_pivot_nulls": """
        SELECT l_partkey,
          CAST(trunc(coalesce(sum(CASE WHEN flag IS NULL THEN quantity END), 0)) AS BIGINT)
            AS "null",
          CAST(trunc(coalesce(sum(CASE WHEN flag = 'A' THEN quantity END), 0)) AS BIGINT) AS A,
          CAST(trunc(coalesce(sum(CASE WHEN flag = 'R' THEN quantity END), 0)) AS BIGINT) AS R
        FROM (SELECT l_partkey, nullif(l_returnflag, 'N') AS flag,
                     nullif(l_quantity, 7.0) AS quantity FROM lineitem)
        GROUP BY l_partkey
    """,
    "sparse_pivot": """
        WITH cell AS (
            SELECT l_suppkey, l_partkey, CAST(trunc(SUM(l_quantity)) AS BIGINT) AS total
            FROM lineitem GROUP BY l_suppkey, l_partkey
        )
        SELECT l_suppkey, CAST(COUNT(*) AS INTEGER) AS n_cells,
               string_agg(l_partkey || '=' || total, ',' ORDER BY l_partkey) AS cells,
               CAST(COALESCE(SUM(total) FILTER (l_partkey = 1), 0) AS BIGINT) AS part_1
        FROM cell GROUP BY l_suppkey
    """,
    "sparse_pivot_merged": """
        WITH cell AS (
            SELECT l_suppkey, l_partkey, CAST(trunc(SUM(l_quantity)) AS BIGINT) AS total
            FROM lineitem GROUP BY l_suppkey, l_partkey
        )
        SELECT l_suppkey, string_agg(l_partkey || '=' || total, ',' ORDER BY l_partkey) AS cells,
               CAST(COALESCE(SUM(total) FILTER (l_partkey = 2), 0) AS BIGINT) AS part_2
        FROM cell GROUP BY l_suppkey
    """,
    "pivot_join_back": f"""
        SELECT *, l_linestatus || '_' || CAST(l_orderkey AS VARCHAR) AS "key" FROM (
        {_join_back("l_orderkey, l_linestatus",
                    "l_orderkey, l_linestatus, l_linenumber, l_partkey", True, False)})
    """,
    "pivot_distinct": _join_back(
        "l_suppkey, l_linestatus",
        "l_suppkey, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year",
        True,
        True,
    ),
    "pivot_null_keys": _join_back(
        "l_suppkey, l_linestatus", "l_suppkey, l_linestatus, l_linenumber", False, False
    ),
    "latest_year": """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS "count" FROM lineitem
        GROUP BY 1 ORDER BY 1 DESC NULLS LAST LIMIT 1
    """,
    "trailing_years": """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS "count" FROM lineitem
        WHERE year(l_shipdate) > (SELECT max(year(l_shipdate)) FROM lineitem) - 3
        GROUP BY 1
    """,
    "trailing_years_text": f"""
        WITH dates AS ({_DATES})
        SELECT * FROM dates WHERE year > (SELECT max(year) FROM dates) - 2
    """,
    "latest_per_location": """
        SELECT l_suppkey, l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_quantity
        FROM lineitem
        QUALIFY row_number() OVER (
          PARTITION BY l_suppkey, l_returnflag
          ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) = 1
    """,
    "trailing_avg": _MEANS.format(_TRAILING),
    "trailing_states": _MEANS.format(_TRAILING),
    "trailing_avg_latest": _MEANS.format(
        f"""{_TRAILING}
        QUALIFY row_number() OVER (
          PARTITION BY l_suppkey, l_returnflag
          ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) = 1"""
    ),
    "code_map_explode": """
        SELECT event_id, code, json_extract_string(props, '$."' || code || '"') AS label
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS code FROM events)
    """,
    "label_text_parse": """
        SELECT p_partkey, 'brand' AS section, p_brand AS code,
               p_name || ', IT''S / ' || p_type AS label, 4 AS line_no FROM part
        UNION ALL
        SELECT p_partkey, 'brand', 'x.y', p_type || '; checked', 6 FROM part
        UNION ALL
        SELECT p_partkey, 'size', CAST(p_size AS VARCHAR), 'Size ' || p_size, 10 FROM part
    """,
    "label_text_parity": """
        SELECT p_partkey, 'brand' AS section, p_brand AS code, p_name || '      ' AS label,
               8 AS line_no FROM part
        UNION ALL
        SELECT p_partkey, 'brand', 'x.y ', ' ' || p_type, 11 FROM part
        UNION ALL
        SELECT p_partkey, 'size', p_size || ' ', ' Size ' || p_size, 15 FROM part
    """,
    "line_filters": """
        WITH lines AS (
          SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS line_no
          FROM documents),
        kept AS (
          SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS n
          FROM lines WHERE NOT contains(line, '/'))
        SELECT doc_id, line_no, line FROM kept
        WHERE n > 5 AND length(line) >= 9 AND NOT contains(line, 'the ')
    """,
    "last_label_wins": """
        SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
        FROM orders GROUP BY o_custkey
    """,
    "new_keys_only": """
        SELECT c_custkey, c_name FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2001)
    """,
    "one_row_per_key": """
        SELECT c_nationkey, c_mktsegment, c_custkey, c_name, c_acctbal
        FROM (SELECT * REPLACE (nullif(c_nationkey, 3) AS c_nationkey) FROM customer)
        WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL
        QUALIFY row_number() OVER (
          PARTITION BY c_nationkey, c_mktsegment
          ORDER BY c_acctbal DESC, c_custkey DESC, c_name DESC) = 1
    """,
    "star_enrichment": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l.l_suppkey, l_quantity, A, N, R,
               mean_quantity, p_name, p_brand
        FROM lineitem l
        LEFT JOIN (SELECT l_suppkey, {_CELLS} FROM lineitem GROUP BY l_suppkey) s
          ON l.l_suppkey = s.l_suppkey
        LEFT JOIN ({_MEANS.format(_TRAILING)}) m ON l.l_suppkey = m.l_suppkey
        LEFT JOIN part ON l_partkey = p_partkey
    """,
    "star_enrichment_shuffled": """
        SELECT l_orderkey, l_linenumber, l_partkey, p_name
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    """,
    "csv_roundtrip": "SELECT * FROM orders",
    "csv_semicolon": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
               CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
        FROM ({_CUSTOMER_NULLS})
    """,
    "csv_without_header": "SELECT * FROM part",
    "append_roundtrip": """
        SELECT event_type, CAST(2 AS BIGINT) AS files, CAST(2 AS BIGINT) AS copies,
               CAST(2 * count(*) AS BIGINT) AS total
        FROM events GROUP BY event_type
    """,
    "write_if_absent": "SELECT * FROM supplier",
    "output_presence": """
        SELECT 'events' AS output, true AS "exists", count(*) AS rows FROM events
        UNION ALL SELECT 'part', true, count(*) FROM part
        UNION ALL SELECT 'missing', false, 0
    """,
    "dictionary_roundtrip": """
        SELECT p_type AS section, CAST(p_partkey AS VARCHAR) AS code, p_name AS label FROM part
    """,
}

# The same rows, however the dictionaries are joined.
ORACLES["lookup_chain_shuffled"] = ORACLES["lookup_chain"]
ORACLES["csv_quotes_split"] = ORACLES["csv_quotes"]
