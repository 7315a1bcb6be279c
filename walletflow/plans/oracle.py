"""DuckDB SQL for each registered query, computed relationally (no JSON).

Tables are the driver's pre-registered views.  The SQL restates the
fixture rules of ``walletflow.plans.fixtures`` directly on the tables, so
the two sides share no code.
"""

from __future__ import annotations

ADDR = "'0x' || lpad(lower(to_hex({k})), 40, '0')"

# Portfolio tokens: one row per (customer, network, part).
PORTFOLIO_TOKENS = f"""
t AS (
  SELECT o_custkey AS k,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'ethereum' WHEN '2-HIGH' THEN 'arbitrum_one'
              WHEN '3-MEDIUM' THEN 'base' WHEN '4-NOT SPECIFIED' THEN 'optimism'
              WHEN '5-LOW' THEN 'polygon' END AS network,
         l_partkey,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS usd
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2, 3),
tok AS (
  SELECT t.k, {ADDR.format(k='t.k')} AS address, t.network, t.l_partkey,
         p_name, CAST(t.qty AS VARCHAR) AS balance,
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
         CAST(t.usd AS VARCHAR) AS usd
  FROM t JOIN part ON t.l_partkey = p_partkey)
"""

PORTFOLIO_FLAT = f"""
WITH {PORTFOLIO_TOKENS}
SELECT CASE network WHEN 'arbitrum_one' THEN 'arbitrum' ELSE network END AS chain,
       address, p_name AS symbol, balance, price, usd
FROM tok WHERE network IN ('arbitrum_one', 'ethereum', 'base', 'optimism')
"""

# Label documents: customers x the seven candidate chains (document order i).
LABEL_BASE = f"""
ch(i, chain, prio) AS (VALUES (0, 'solana', 99), (1, 'bsc', 6), (2, 'base', 5), (3, 'optimism', 4),
                              (4, 'polygon', 3), (5, 'arbitrum_one', 2), (6, 'ethereum', 1)),
c AS (
  SELECT c_custkey AS k, {ADDR.format(k='c_custkey')} AS address, c_name, c_mktsegment,
         lower(n_name) AS nn
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
p AS (
  SELECT c.k, c.address, c.c_name, c.c_mktsegment, c.nn, ch.i, ch.chain, ch.prio,
         (c.k + ch.i) % 2 = 0 AS is_user, (c.k + ch.i) % 3 = 0 AS has_ent, (c.k + ch.i) % 4 = 0 AS has_lab
  FROM c JOIN ch ON c.k % (ch.i + 2) = 0),
prim AS (
  SELECT * FROM (SELECT p.*, row_number() OVER (PARTITION BY k ORDER BY prio, i) AS rn FROM p) q WHERE rn = 1),
lab AS (
  SELECT k, chain AS lchain FROM (
    SELECT k, chain, row_number() OVER (PARTITION BY k ORDER BY i) AS rn FROM p WHERE has_lab) q WHERE rn = 1),
flat AS (
  SELECT c.k, c.address,
    CASE WHEN prim.has_ent THEN c.c_name ELSE '' END AS name,
    CASE WHEN prim.has_ent THEN c.c_mktsegment ELSE '' END AS type,
    CASE WHEN prim.has_ent THEN 'https://' || c.nn || '.example' ELSE '' END AS website,
    CASE WHEN prim.has_ent AND c.k % 5 <> 0 THEN '@' || CAST(c.k AS VARCHAR) ELSE '' END AS twitter,
    '' AS crunchbase, '' AS linkedin,
    CASE WHEN prim.has_lab THEN prim.chain || '-' || c.c_mktsegment
         WHEN lab.lchain IS NOT NULL THEN lab.lchain || '-' || c.c_mktsegment ELSE '' END AS label,
    CASE WHEN prim.has_lab THEN prim.chain ELSE lab.lchain END AS label_chain,
    prim.chain AS primary_chain,
    coalesce(prim.is_user, false) AS is_user
  FROM c LEFT JOIN prim ON prim.k = c.k LEFT JOIN lab ON lab.k = c.k)
"""

ORACLE: dict[str, str] = {}

ORACLE["portfolio_flat"] = PORTFOLIO_FLAT

ORACLE["portfolio_chain_filter"] = f"""
WITH {PORTFOLIO_TOKENS}
SELECT address, network AS chain, CAST(count(*) AS BIGINT) AS n_tokens
FROM tok WHERE network IN ('arbitrum_one', 'ethereum', 'base', 'optimism')
GROUP BY address, network
"""

ORACLE["portfolio_ordered"] = f"""
WITH {PORTFOLIO_TOKENS}
SELECT CASE network WHEN 'arbitrum_one' THEN 'arbitrum' ELSE network END AS chain,
       address, p_name AS symbol, balance, price, usd,
       CAST(CASE network WHEN 'arbitrum_one' THEN 1 WHEN 'ethereum' THEN 2 WHEN 'base' THEN 3 ELSE 4 END AS BIGINT)
         AS chain_rank,
       CAST(row_number() OVER (PARTITION BY k, network ORDER BY CAST(l_partkey AS VARCHAR)) AS BIGINT) AS token_rank
FROM tok WHERE network IN ('arbitrum_one', 'ethereum', 'base', 'optimism')
"""

ORACLE["portfolio_valid"] = f"""
WITH {PORTFOLIO_TOKENS}
SELECT address, k % 7 <> 0 AS is_valid,
       CASE WHEN k % 7 <> 0 THEN CAST(count(DISTINCT network) AS BIGINT) END AS n_networks,
       CASE WHEN k % 7 <> 0 THEN CAST(count(*) AS BIGINT) END AS n_tokens
FROM tok GROUP BY k, address
"""

ORACLE["label_flat"] = f"""
WITH {LABEL_BASE}
SELECT address, name, type, website, twitter, crunchbase, linkedin, label, is_user AS "isUserAddress" FROM flat
"""

ORACLE["label_entity"] = f"""
WITH {LABEL_BASE}
SELECT address, name, type, website, twitter, crunchbase, linkedin FROM flat
"""

ORACLE["label_name"] = f"""
WITH {LABEL_BASE}
SELECT address, chain, chain || '-' || c_mktsegment AS label_name FROM p WHERE has_lab
"""

ORACLE["label_chains"] = f"""
WITH {LABEL_BASE}
SELECT address, chain, CAST(row_number() OVER (PARTITION BY k ORDER BY i) AS BIGINT) AS pos,
       is_user AS is_user_address, has_ent AS has_entity, has_lab AS has_label
FROM p
"""

ORACLE["label_primary"] = f"""
WITH {LABEL_BASE}
SELECT address, primary_chain FROM flat
"""

ORACLE["label_fallback"] = f"""
WITH {LABEL_BASE}
SELECT address, label, label_chain FROM flat
"""

ORACLE["label_record"] = f"""
WITH {LABEL_BASE}
SELECT address,
       CAST(json_object('address', address, 'name', name, 'type', type, 'website', website,
                        'twitter', twitter, 'crunchbase', crunchbase, 'linkedin', linkedin,
                        'label', label, 'isUserAddress', is_user) AS VARCHAR) AS record
FROM flat
"""

ORACLE["latest_result"] = f"""
SELECT {ADDR.format(k='c_custkey')} AS user_addr FROM customer WHERE c_acctbal >= 5000
"""

ORACLE["column_values"] = f"""
SELECT c_custkey AS row_id,
       CASE WHEN c_custkey % 9 = 1 THEN NULL ELSE {ADDR.format(k='c_custkey')} END AS user_addr
FROM customer WHERE c_custkey % 9 <> 0
"""

ORACLE["extract_stats"] = """
SELECT CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count(*) FILTER (WHERE c_custkey % 9 <> 0) AS BIGINT) AS values_extracted,
       CAST(count(*) FILTER (WHERE c_custkey % 9 NOT IN (0, 1)) AS BIGINT) AS non_null_values
FROM customer
"""

ORACLE["label_lookup"] = f"""
WITH {LABEL_BASE}
SELECT address, k % 11 <> 5 AS is_success,
       CASE WHEN k % 11 = 5 THEN 'API returned no data' END AS error_message,
       CASE WHEN k % 11 <> 5 THEN label END AS label
FROM flat
"""

ORACLE["portfolio_asof"] = """
SELECT user_id, event_id, epoch_us(ts) AS ts_us, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00') q
WHERE rn = 1
"""

# Stub service: key k fails its first k % 12 calls (status cycling by call
# number), at most 10 rounds.
FETCH_ATTEMPTS = f"""
keys AS (SELECT c_custkey AS k, {ADDR.format(k='c_custkey')} AS address FROM customer),
att AS (
  SELECT keys.k, keys.address, CAST(r.round AS BIGINT) AS round,
         r.round > keys.k % 12 AS ok,
         CASE WHEN r.round > keys.k % 12 THEN '200'
              ELSE ['429', '500', '400', '401', 'timeout', 'connection_error'][((r.round - 1) % 6) + 1] END AS status
  FROM keys JOIN range(1, 11) AS r(round) ON r.round <= least(keys.k % 12 + 1, 10))
"""

ORACLE["fetch_status"] = f"""
WITH {FETCH_ATTEMPTS}
SELECT address, round, status, ok AS is_success,
       CASE WHEN NOT ok THEN 'API returned no data' END AS error_message
FROM att
"""

ORACLE["round_split"] = f"""
WITH {FETCH_ATTEMPTS}
SELECT round, address, CASE WHEN ok THEN 'success' ELSE 'failure' END AS split FROM att
"""

ORACLE["retry_rounds"] = f"""
WITH {FETCH_ATTEMPTS}, {LABEL_BASE}
SELECT flat.address, att.round, flat.name, flat.label, flat.is_user AS "isUserAddress"
FROM att JOIN flat ON att.k = flat.k WHERE att.ok
"""

ORACLE["round_stats"] = f"""
WITH {FETCH_ATTEMPTS}
SELECT round, CAST(count(*) AS BIGINT) AS attempted,
       CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS succeeded,
       CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS failed
FROM att GROUP BY round
"""

ORACLE["dead_letters"] = f"""
WITH {FETCH_ATTEMPTS}
SELECT address, round AS attempts, status AS last_status, 'API returned no data' AS last_error,
       row_number() OVER (ORDER BY address) AS no
FROM att WHERE round = 10 AND NOT ok
"""

ORACLE["batch_summary"] = f"""
WITH {FETCH_ATTEMPTS}, s AS (
  SELECT CAST(count(DISTINCT k) AS BIGINT) AS total,
         CAST(count(DISTINCT k) FILTER (WHERE ok) AS BIGINT) AS succeeded FROM att)
SELECT total, succeeded, total - succeeded AS failed,
       CAST(round(succeeded * 100.0 / total, 1) AS DECIMAL(5,1)) AS success_rate
FROM s
"""

ORACLE["status_class"] = f"""
WITH {FETCH_ATTEMPTS}
SELECT status, CAST(count(*) AS BIGINT) AS calls FROM att GROUP BY status
"""

PORTFOLIO_FLAT_ROWS = """
flatp AS (
  SELECT k, CASE network WHEN 'arbitrum_one' THEN 'arbitrum' ELSE network END AS chain,
         address, p_name AS symbol, balance, price, usd
  FROM tok WHERE network IN ('arbitrum_one', 'ethereum', 'base', 'optimism'))
"""

ORACLE["dense_no"] = f"""
WITH {PORTFOLIO_TOKENS}, {PORTFOLIO_FLAT_ROWS}
SELECT chain, address, symbol, balance, price, usd,
       row_number() OVER (ORDER BY address, chain, symbol, balance, price, usd) AS no
FROM flatp
"""

ORACLE["label_table_rows"] = f"""
WITH {LABEL_BASE}
SELECT CAST(row_number() OVER (ORDER BY address) AS BIGINT) AS no, address, name, type, label,
       is_user AS isuseraddress, website, twitter, crunchbase, linkedin, '2024-01-15' AS update_date
FROM flat
"""

ORACLE["csv_roundtrip"] = PORTFOLIO_FLAT

# CSV cannot tell an empty cell from NULL: empty text reads back as NULL.
TYPED_LABEL_ROWS = """
SELECT CAST(row_number() OVER (ORDER BY address) AS BIGINT) AS no, substr(address, 3) AS address_hex,
       NULLIF(name, '') AS name, NULLIF(type, '') AS type, NULLIF(label, '') AS label,
       is_user AS isuseraddress, NULLIF(website, '') AS website, NULLIF(twitter, '') AS twitter,
       NULLIF(crunchbase, '') AS crunchbase, NULLIF(linkedin, '') AS linkedin,
       '{day}' AS update_date
FROM flat
"""

ORACLE["label_typed_load"] = f"WITH {LABEL_BASE} " + TYPED_LABEL_ROWS.format(day="2024-01-15")

ORACLE["rows_written"] = f"""
WITH {PORTFOLIO_TOKENS}, {PORTFOLIO_FLAT_ROWS}
SELECT CAST(count(*) AS BIGINT) AS rows_written FROM flatp
"""

ORACLE["address_binary"] = """
WITH a AS (SELECT c_custkey AS k, lpad(lower(to_hex(c_custkey)), 40, '0') AS digits FROM customer)
SELECT CASE k % 10 WHEN 0 THEN digits WHEN 1 THEN '0x' || digits || '0'
                   WHEN 2 THEN '0x' || substr(digits, 1, 39) || 'g' WHEN 3 THEN '0x' || upper(digits)
                   ELSE '0x' || digits END AS address,
       CASE WHEN k % 10 IN (0, 1, 2) THEN NULL ELSE digits END AS address_hex,
       CASE k % 10 WHEN 0 THEN 'missing 0x prefix' WHEN 1 THEN 'odd number of hex digits'
                   WHEN 2 THEN 'non-hex character' END AS problem
FROM a
"""

ORACLE["endpoint_key"] = f"""
WITH a AS (SELECT {ADDR.format(k='c_custkey')} AS address FROM customer)
SELECT address, '/intelligence/address/' || address || '/all' AS label_path,
       '/portfolio/address/' || address AS portfolio_path
FROM a
"""

ORACLE["export_name"] = """
WITH runs AS (SELECT user_id, max(ts) AS run_ts FROM events GROUP BY user_id)
SELECT user_id,
       'ArcHam_Intelligence_Report_' || strftime(run_ts, '%Y%m%d_%H%M%S') || '.csv' AS label_file,
       'ArcHam_portfolios_' || strftime(run_ts, '%Y%m%d_%H%M%S') || '.csv' AS portfolio_file,
       'whales_' || strftime(run_ts, '%Y%m%d') || '.csv' AS given_file,
       'whales_' || strftime(run_ts, '%Y%m%d') || '.csv' AS given_csv_file
FROM runs
"""

# A cell with a comma, quote or line end is quoted and its quotes doubled.
ORACLE["load_stats"] = f"""
WITH cells AS (
  SELECT unnest([chain, address, symbol, balance, price, usd]) AS cell FROM ({PORTFOLIO_FLAT}) AS f),
size AS (
  SELECT CAST(count(*) AS BIGINT) // 6 AS rows_written,
         CAST(sum(strlen(cell) + 1 + CASE WHEN regexp_matches(cell, '[,"\\n\\r]')
           THEN 2 + strlen(cell) - strlen(replace(cell, '"', '')) ELSE 0 END) AS BIGINT) AS bytes_written
  FROM cells)
SELECT rows_written, bytes_written,
       CAST(CAST(round(bytes_written / 1048576.0, 2) AS DECIMAL(20,2)) AS VARCHAR) AS megabytes
FROM size
"""

ORACLE["table_lifecycle"] = """
SELECT CAST(step_no AS BIGINT) AS step_no, step, ok, CAST(row_count AS BIGINT) AS row_count FROM (
  SELECT 1 AS step_no, 'create' AS step, true AS ok, NULL AS row_count
  UNION ALL SELECT 2, 'create_again', true, NULL
  UNION ALL SELECT 3, 'append', true, (SELECT count(*) FROM customer)
  UNION ALL SELECT 4, 'clear', true, 0
  UNION ALL SELECT 5, 'drop', true, NULL
  UNION ALL SELECT 6, 'drop_again', false, NULL) s
"""

ORACLE["append_load"] = (
    f"WITH {LABEL_BASE} "
    + TYPED_LABEL_ROWS.format(day="2024-01-14")
    + " UNION ALL "
    + TYPED_LABEL_ROWS.format(day="2024-01-15")
)

ORACLE["refresh_load"] = f"""
WITH {PORTFOLIO_TOKENS}
SELECT CASE network WHEN 'arbitrum_one' THEN 'arbitrum' ELSE network END AS chain,
       substr(address, 3) AS address_hex, p_name AS symbol, balance,
       CASE WHEN k % 7 = 3 THEN NULL ELSE price END AS price, usd
FROM tok WHERE network IN ('arbitrum_one', 'ethereum', 'base', 'optimism') AND k % 7 <> 0
"""

ORACLE["history_load"] = """
SELECT '2024-01-14' AS update_date, CAST(count(*) AS BIGINT) AS row_count FROM customer
UNION ALL
SELECT '2024-01-15', CAST(count(*) AS BIGINT) FROM customer WHERE c_acctbal >= 5000
"""

ORACLE["job_labels"] = f"""
WITH {LABEL_BASE}
SELECT CAST(row_number() OVER (ORDER BY flat.k % 12, flat.address) AS BIGINT) AS no,
       substr(flat.address, 3) AS address_hex,
       NULLIF(name, '') AS name, NULLIF(type, '') AS type, NULLIF(label, '') AS label,
       is_user AS isuseraddress, NULLIF(website, '') AS website, NULLIF(twitter, '') AS twitter,
       NULLIF(crunchbase, '') AS crunchbase, NULLIF(linkedin, '') AS linkedin,
       '2024-01-15' AS update_date
FROM flat JOIN customer ON customer.c_custkey = flat.k
WHERE customer.c_acctbal >= 5000 AND flat.k % 12 < 10
"""

ORACLE["job_portfolio"] = f"""
WITH {PORTFOLIO_TOKENS}
SELECT CASE network WHEN 'arbitrum_one' THEN 'arbitrum' ELSE network END AS chain,
       substr(address, 3) AS address_hex, p_name AS symbol, balance, price, usd
FROM tok JOIN customer ON customer.c_custkey = tok.k
WHERE customer.c_acctbal >= 5000 AND tok.k % 12 < 10
  AND network IN ('arbitrum_one', 'ethereum', 'base', 'optimism')
"""

ORACLE["export_labels"] = f"""
WITH {LABEL_BASE}
SELECT CAST(row_number() OVER (ORDER BY flat.k % 12, flat.address) AS VARCHAR) AS no, flat.address,
       NULLIF(name, '') AS name, NULLIF(type, '') AS type, NULLIF(label, '') AS label,
       CASE WHEN is_user THEN 'True' ELSE 'False' END AS isuseraddress, NULLIF(website, '') AS website,
       NULLIF(twitter, '') AS twitter, NULLIF(crunchbase, '') AS crunchbase, NULLIF(linkedin, '') AS linkedin
FROM flat JOIN customer ON customer.c_custkey = flat.k
WHERE customer.c_acctbal >= 5000 AND flat.k % 12 < 10
"""

ORACLE["export_portfolios"] = f"""
WITH {PORTFOLIO_TOKENS}
SELECT CASE network WHEN 'arbitrum_one' THEN 'arbitrum' ELSE network END AS chain,
       address, p_name AS symbol, balance, price, usd
FROM tok JOIN customer ON customer.c_custkey = tok.k
WHERE customer.c_acctbal >= 5000 AND tok.k % 12 < 10
  AND network IN ('arbitrum_one', 'ethereum', 'base', 'optimism')
"""

ORACLE["stream_landing"] = ORACLE["retry_rounds"]

ORACLE["portfolio_paged"] = PORTFOLIO_FLAT

ORACLE["audited_refresh"] = f"""
WITH {PORTFOLIO_TOKENS},
n AS (
  SELECT count(*) AS n, count(*) FILTER (k % 7 <> 0) AS fewer
  FROM tok WHERE network IN ('arbitrum_one', 'ethereum', 'base', 'optimism'))
SELECT 'first' AS step, true AS ok, n AS converted, 0 AS rejected, n AS in_table FROM n
UNION ALL SELECT 'all_rejected', false, 0, n, n FROM n
UNION ALL SELECT 'too_few', false, fewer, 0, n FROM n
UNION ALL SELECT 'check_broken', false, n, 0, n FROM n
UNION ALL SELECT 'fewer', true, fewer, 0, fewer FROM n
"""

ORACLE["repeated_load"] = """
WITH n AS (SELECT count(*) AS n, count(*) // 10 AS bad FROM customer)
SELECT 'first' AS step, true AS ok, false AS repeated, 0 AS rejected, n AS in_table FROM n
UNION ALL SELECT 'again', true, true, 0, n FROM n
UNION ALL SELECT 'refused', false, false, bad, n FROM n
UNION ALL SELECT 'repeated', true, false, bad, 2 * n - bad FROM n
UNION ALL SELECT 'repeated_again', true, true, 0, 2 * n - bad FROM n
UNION ALL SELECT 'rejects', true, false, bad, 2 * n - bad FROM n
"""

ORACLE["portfolio_asof_requests"] = """
WITH v AS (SELECT user_id, ts, max(event_id) AS event_id FROM events GROUP BY user_id, ts),
r AS (
  SELECT event_id AS request_id, user_id, ts + to_seconds((event_id * 7919) % 518400 - 259200) AS as_of FROM events)
SELECT r.request_id, r.user_id, v.event_id, epoch_us(v.ts) AS ts_us, e.value, e.props
FROM r ASOF LEFT JOIN v ON r.user_id = v.user_id AND r.as_of >= v.ts
LEFT JOIN events AS e ON e.event_id = v.event_id
"""

NUMBER_DOCUMENTS = """
li AS (
  SELECT '0x' || lpad(l_orderkey || 'f' || l_linenumber, 40, '0') AS address,
         rpad('1' || CAST(l_orderkey AS VARCHAR), 41, '7') AS long, CAST(l_linenumber AS VARCHAR) AS n, l_linenumber % 2 = 0 AS even
  FROM lineitem)
"""

ORACLE["portfolio_numbers"] = f"""
WITH {NUMBER_DOCUMENTS}
SELECT address, long AS balance, '-' || n || '.50' AS price, n || 'e400' AS usd,
       '-' || n || '.500000000000000000' AS price_decimal
FROM li
"""

ORACLE["label_numbers"] = f"""
WITH {NUMBER_DOCUMENTS}
SELECT address, long AS name, n || '.0' AS type, 'a: ' || n || '.0 "x": -1.50, 2' AS website,
       CASE WHEN even THEN '' ELSE n || '.10' END AS label
FROM li
"""

ORACLE["csv_splits"] = """
SELECT doc_id, lang, source, CAST(length(NULLIF(text, '')) AS BIGINT) AS chars, sha256(NULLIF(text, '')) AS text_sha256 FROM documents
"""

ORACLE["empty_guards"] = """
WITH n AS (SELECT count(*) AS n FROM customer WHERE c_acctbal >= 5000 AND c_custkey % 12 > 1)
SELECT 'no_keys' AS step, true AS nothing_done, false AS no_file, 0 AS dead_letters, 0 AS in_table
UNION ALL SELECT 'no_success', false, true, n, 0 FROM n
UNION ALL SELECT 'no_export', true, false, 0, 0
"""

ORACLE["default_asof"] = """
SELECT count(*) AS row_count, CAST(1 AS BIGINT) AS as_of_times, true AS not_before FROM customer WHERE c_acctbal >= 5000
"""

# All failing calls of rounds 1 and 7 are answered with 429, which halves the rate; other rounds raise it by a tenth.
ORACLE["paced_rounds"] = """
SELECT r.round, count(*) FILTER (c_custkey % 12 >= r.round - 1) AS attempted,
       CASE WHEN r.round % 6 = 1 THEN count(*) FILTER (c_custkey % 12 >= r.round) ELSE 0 END AS throttled,
       CAST(round(1000000 * CASE WHEN r.round = 1 THEN 1 WHEN r.round < 8 THEN 0.5 * pow(1.1, r.round - 2)
         ELSE 0.25 * pow(1.1, 5) * pow(1.1, r.round - 8) END) AS BIGINT) AS rate_ppm
FROM customer, range(1, 11) AS r(round) GROUP BY r.round
"""

ORACLE["run_sketches"] = """
SELECT r.round, count(*) AS attempts, count(*) FILTER (c_custkey % 12 < r.round) AS succeeded, count(*) AS exact_keys,
       true AS keys_near, true AS p50_near, true AS p90_near
FROM customer, range(1, 4) AS r(round) WHERE c_custkey % 12 >= r.round - 1 GROUP BY r.round
"""
