"""The same queries in SQL, for an independent engine over the same parquet tables.

Each text is the bank's tables (the mapping of FIXTURES.md) as common table expressions,
followed by one query. Nothing here is derived from the Spark code.
"""

from __future__ import annotations

TABLES = {
    "banking_customers": """
SELECT CAST(c_custkey AS STRING) AS id,
       'First' || CAST(c_custkey % 40 AS STRING) AS firstname,
       'Last' || CAST(c_custkey % 90 AS STRING) AS lastname,
       'c' || CAST(c_custkey AS STRING) || '@example.org' AS email,
       'N' || lpad(CAST(c_nationkey AS STRING), 2, '0') AS country
FROM customer
WHERE c_custkey % 50 <> 49
""",
    "country_coordinates": """
SELECT n_name AS country,
       chr(65 + n_nationkey) || chr(65 + n_regionkey) AS alpha2_code,
       'N' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS alpha3_code,
       n_nationkey AS numeric_code,
       CAST(n_nationkey * 3 - 36 AS DOUBLE) AS lat_avg,
       CASE WHEN n_nationkey % 10 = 7 THEN CAST(NULL AS DOUBLE)
            ELSE CAST(n_nationkey * 7 - 90 AS DOUBLE) END AS long_avg
FROM nation
WHERE n_nationkey < 24
""",
    "fraud_reports": """
SELECT CAST(o_orderkey AS STRING) AS id,
       CAST(CASE WHEN substr(o_orderpriority, 1, 1) = '1' AND o_orderkey % 5 = 0 THEN 1
                 WHEN substr(o_orderpriority, 1, 1) = '2' AND o_orderkey % 7 = 0 THEN 1
                 ELSE 0 END AS INT) AS is_fraud
FROM orders
WHERE o_orderstatus <> 'P'
""",
    "txn_base": """
SELECT o_orderkey AS k,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'TRANSFER' WHEN '2' THEN 'CASH_OUT'
            WHEN '3' THEN 'CASH_IN' WHEN '4' THEN 'PAYMENT' ELSE 'DEBIT' END AS type,
       o_totalprice AS amount,
       CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice ELSE o_totalprice * 4 END AS oldBalanceOrig,
       CASE WHEN o_orderkey % 3 = 0 THEN 0.0E0 ELSE o_totalprice * 2 END AS oldBalanceDest,
       o_custkey, c_nationkey
FROM orders JOIN customer ON o_custkey = c_custkey
""",
    "bronze_transactions": """
SELECT CAST(k AS STRING) AS id,
       CAST(k % 1000 AS INT) AS step, type, amount,
       CAST(o_custkey AS STRING) AS customer_id,
       'C' || CAST(o_custkey AS STRING) AS nameOrig,
       'D' || CAST(k % 997 AS STRING) AS nameDest,
       CASE WHEN k % 2 = 0 THEN '--' ELSE '' END || 'N'
         || lpad(CAST(c_nationkey AS STRING), 2, '0') AS countryOrig,
       CASE WHEN k % 3 = 0 THEN '--' ELSE '' END || 'N'
         || lpad(CAST((k * 7 + 3) % 25 AS STRING), 2, '0')
         || CASE WHEN k % 6 = 0 THEN '--' ELSE '' END AS countryDest,
       oldBalanceOrig,
       CASE WHEN type = 'CASH_IN' THEN oldBalanceOrig + amount
            ELSE oldBalanceOrig - amount END AS newBalanceOrig,
       oldBalanceDest,
       CASE WHEN k % 7 = 0 THEN oldBalanceDest ELSE oldBalanceDest + amount END AS newBalanceDest,
       'part-' || CAST(k % 4 AS STRING) || '.csv' AS source_file
FROM txn_base
""",
    "silver_transactions": """
SELECT t.id, step, type, amount, customer_id, nameOrig, nameDest, source_file,
       replace(countryOrig, '--', '') AS countryOrig,
       replace(countryDest, '--', '') AS countryDest,
       newBalanceOrig, oldBalanceOrig, newBalanceDest, oldBalanceDest,
       newBalanceOrig - oldBalanceOrig AS diffOrig,
       newBalanceDest - oldBalanceDest AS diffDest,
       f.is_fraud
FROM bronze_transactions t LEFT JOIN fraud_reports f ON t.id = f.id
""",
    "gold_transactions": """
SELECT t.id, t.step, t.type, t.customer_id, t.nameOrig, t.nameDest,
       t.newBalanceOrig, t.oldBalanceOrig, t.newBalanceDest, t.oldBalanceDest,
       t.diffOrig, t.diffDest, c.firstname, c.lastname, c.email, c.country,
       o.alpha3_code AS countryOrig, o.country AS countryOrig_name,
       o.long_avg AS countryLongOrig_long, o.lat_avg AS countryLatOrig_lat,
       d.alpha3_code AS countryDest, d.country AS countryDest_name,
       d.long_avg AS countryLongDest_long, d.lat_avg AS countryLatDest_lat,
       CAST(t.amount AS DOUBLE) AS amount,
       CAST(coalesce(t.is_fraud, 0) AS BOOLEAN) AS is_fraud
FROM silver_transactions t
JOIN country_coordinates o ON t.countryOrig = o.alpha3_code
JOIN country_coordinates d ON t.countryDest = d.alpha3_code
JOIN banking_customers c ON c.id = t.customer_id
""",
    "scored_transactions": """
SELECT event_id AS id, ts AS timestamp,
       CASE event_type WHEN 'error' THEN 'TRANSFER' WHEN 'purchase' THEN 'CASH_OUT'
            WHEN 'click' THEN 'PAYMENT' WHEN 'view' THEN 'DEBIT' ELSE 'CASH_IN' END AS type,
       value AS amount,
       CAST(user_id AS INT) AS customer_id,
       'N' || lpad(CAST(user_id % 25 AS STRING), 2, '0') AS country_orig,
       'N' || lpad(CAST(event_id % 25 AS STRING), 2, '0') AS country_dest,
       (event_type = 'error' AND value >= 50) AS fraud_prediction,
       least(value / 500, 1.0E0) AS fraud_probability,
       ts + INTERVAL 1 SECOND AS scored_at
FROM events
""",
    "live_history": """
SELECT k AS id, type, amount AS amount, oldBalanceOrig AS old_balance_orig, oldBalanceOrig - amount AS new_balance_orig,
       oldBalanceDest AS old_balance_dest, oldBalanceDest + amount AS new_balance_dest,
       'insert' AS _change_type, k * 10 AS _lsn FROM txn_base
UNION ALL
SELECT k AS id, type, amount AS amount, oldBalanceOrig AS old_balance_orig, oldBalanceOrig - amount AS new_balance_orig,
       oldBalanceDest AS old_balance_dest, oldBalanceDest + amount AS new_balance_dest,
       'update_preimage', k * 10 + 2 FROM txn_base WHERE k % 5 = 0
UNION ALL
SELECT k AS id, type, amount * 2 AS amount, oldBalanceOrig AS old_balance_orig, oldBalanceOrig - amount AS new_balance_orig,
       oldBalanceDest AS old_balance_dest, oldBalanceDest + amount AS new_balance_dest,
       'update_postimage', k * 10 + 3 FROM txn_base WHERE k % 5 = 0
UNION ALL
SELECT k AS id, type, amount AS amount, oldBalanceOrig AS old_balance_orig, oldBalanceOrig - amount AS new_balance_orig,
       oldBalanceDest AS old_balance_dest, oldBalanceDest + amount AS new_balance_dest,
       'delete', k * 10 + 5 FROM txn_base WHERE k % 11 = 0
""",
}

# Rule-score stages on any table ``txns`` with the collapsed columns.
STATS = """type_stats AS (
  SELECT type,
         round(avg(CASE WHEN is_fraud THEN 1.0E0 ELSE 0.0E0 END), 5) AS fraud_rate_type,
         quantile_disc(amount, 0.50) AS p50_amount_type,
         quantile_disc(amount, 0.90) AS p90_amount_type,
         quantile_disc(amount, 0.95) AS p95_amount_type,
         quantile_disc(amount, 0.99) AS p99_amount_type
  FROM gold_transactions GROUP BY type
)"""

RISK = STATS + """, txns AS (
  {txns}
), flags AS (
  SELECT t.*, s.fraud_rate_type, s.p50_amount_type, s.p90_amount_type, s.p95_amount_type,
         s.p99_amount_type,
         CAST(coalesce(fraud_rate_type, 0) >= 0.1E0 AS INT) AS flag_type_prior,
         CAST(coalesce(amount >= p95_amount_type, false) AS INT) AS flag_large_p95,
         CAST(coalesce(amount >= p99_amount_type, false) AS INT) AS flag_large_p99,
         CAST(coalesce(oldBalanceOrig > 0 AND amount >= 0.9E0 * oldBalanceOrig
                       AND newBalanceOrig <= 0.1E0 * oldBalanceOrig, false) AS INT) AS flag_drains_origin,
         CAST(coalesce(oldBalanceDest = 0
                       AND amount >= coalesce(p50_amount_type, 1000), false) AS INT) AS flag_empty_dest
  FROM txns t LEFT JOIN type_stats s ON t.type = s.type
), scored AS (
  SELECT *, CASE WHEN found_count = 0 THEN 0 ELSE
              CAST(least(100, 30 * flag_type_prior + 30 * flag_drains_origin + 20 * flag_empty_dest
                   + CASE WHEN flag_large_p99 = 1 THEN 20 WHEN flag_large_p95 = 1 THEN 10 ELSE 0 END)
              AS INT) END AS risk_score,
         ([x FOR x IN [
           CASE WHEN flag_type_prior = 1 THEN 'Transaction type ' || type || ' has an elevated fraud rate' END,
           CASE WHEN flag_drains_origin = 1 THEN
             'This transaction drains most of the origin account balance.' END,
           CASE WHEN flag_empty_dest = 1 THEN
             'Funds were sent to a destination account with no prior balance.' END,
           CASE WHEN flag_large_p99 = 1 THEN 'Amount is extreme for this type'
                WHEN flag_large_p95 = 1 THEN 'Amount is unusually large for this type' END
         ] IF x IS NOT NULL])[1:3] AS raised,
         ([x FOR x IN [
           CASE WHEN flag_type_prior = 1 THEN 'Transaction type ' || type || ' has an elevated fraud rate ('
             || CAST(CAST(round(CAST(fraud_rate_type AS DECIMAL(6,5)) * 100, 1) AS DECIMAL(9,1)) AS STRING) || '%).' END,
           CASE WHEN flag_drains_origin = 1 THEN
             'This transaction drains most of the origin account balance.' END,
           CASE WHEN flag_empty_dest = 1 THEN
             'Funds were sent to a destination account with no prior balance.' END,
           CASE WHEN flag_large_p99 = 1 THEN 'Amount is extreme for this type (>= p99 ≈ '
                  || CAST(round(p99_amount_type, 2) AS STRING) || ').'
                WHEN flag_large_p95 = 1 THEN 'Amount is unusually large for this type (>= p95 ≈ '
                  || CAST(round(p95_amount_type, 2) AS STRING) || ').' END
         ] IF x IS NOT NULL])[1:3] AS texts
  FROM flags
), told AS (
  SELECT *, CASE WHEN len(raised) > 0 THEN raised
                 ELSE ['No strong red flags from basic rules.'] END AS shown,
         CASE WHEN len(texts) > 0 THEN texts
              ELSE ['No strong red flags from basic rules.'] END AS full_texts
  FROM scored
)
"""

COLLAPSED = """count(*) AS found_count, max(type) AS type, max(amount) AS amount,
         max(oldBalanceOrig) AS oldBalanceOrig, max(newBalanceOrig) AS newBalanceOrig,
         max(oldBalanceDest) AS oldBalanceDest, max(newBalanceDest) AS newBalanceDest"""

CURRENT = """SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY _lsn DESC) AS rn FROM live_history
    WHERE _change_type IN ('insert', 'update_postimage', 'delete')
  ) WHERE rn = 1 AND _change_type <> 'delete'"""

LIVE_TXNS = f"""SELECT id, type, amount, old_balance_orig AS oldBalanceOrig,
         new_balance_orig AS newBalanceOrig, old_balance_dest AS oldBalanceDest,
         new_balance_dest AS newBalanceDest FROM ({CURRENT})"""

GOLD_RISK = RISK.format(
    txns=f"SELECT id, {COLLAPSED}, max(customer_id) AS customer_id FROM gold_transactions GROUP BY id"
)
LIVE_RISK = RISK.format(txns=f"SELECT id, {COLLAPSED} FROM ({LIVE_TXNS}) GROUP BY id")

# The queries that sum money see amounts with more decimals than the tables have.
FINE = "(amount * 1.00037E0)"
MONEY = f"CAST(sum(CAST({FINE} AS DECIMAL(28,10))) AS DOUBLE)"
LARGE = "amount > 350000"
FINE_LARGE = f"{FINE} > 350000"

DOUBTFUL = """SELECT * REPLACE (
    CASE WHEN type <> 'DEBIT' THEN customer_id END AS customer_id,
    CASE WHEN step <> 500 THEN amount - 50000 END AS amount) FROM bronze_transactions"""

FLOWS = f"""SELECT country_orig AS source, country_dest AS target, count(*) AS total_count,
  count(*) FILTER (fraud_prediction) AS fraud_count, round({MONEY}, 2) AS total_amount
FROM scored_transactions GROUP BY ALL ORDER BY total_count DESC, source, target LIMIT 30"""

BUCKETS = """SELECT CAST(floor(epoch_us(timestamp) / 1000000 / 10) * 10 AS BIGINT) AS timestamp,
  count(*) AS total, count(*) FILTER (fraud_prediction) AS fraud,
  count(*) FILTER (NOT fraud_prediction) AS legit
FROM scored_transactions GROUP BY 1"""

METRICS = f"""SELECT count(*) AS total_transactions,
  count(*) FILTER (fraud_prediction) AS fraud_count,
  count(*) FILTER (NOT fraud_prediction) AS legit_count,
  CASE WHEN count(*) > 0
       THEN round(count(*) FILTER (fraud_prediction) * 100.0E0 / count(*), 2) ELSE 0 END AS fraud_rate,
  coalesce(round({MONEY}, 2), 0) AS total_amount
FROM scored_transactions"""

COUNTS_FLOW = f"""SELECT countryOrig, countryDest, type, count(amount) AS value
FROM gold_transactions WHERE {LARGE} GROUP BY ALL
ORDER BY value DESC, countryOrig, countryDest, type LIMIT 20"""

PROFILED = ("amount", "newBalanceDest", "oldBalanceDest", "diffOrig", "diffDest")
PROFILE = ",\n  ".join(
    f"round(avg({f}), 3) AS {f}_mean, coalesce(round(stddev_samp({f}), 3), 0) AS {f}_stddev, "
    f"min({f}) AS {f}_min, max({f}) AS {f}_max, "
    + ", ".join(f"quantile_disc({f}, 0.{p}) AS {f}_p{p}" for p in (10, 25, 50, 75, 90))
    for f in PROFILED
)

BALANCES = "newBalanceOrig, oldBalanceOrig, newBalanceDest, oldBalanceDest"
TOLD = "array_to_string(shown, ' | ') AS signals"


def _explained(scores: str, known: str, missing: tuple[str, str]) -> str:
    """Answers for a known id and for one that is not there."""
    return scores + f""", ids AS (
  SELECT 'known' AS asked, '{known}' AS id UNION ALL SELECT 'unknown', '{missing[0]}'
) SELECT asked, coalesce(risk_score, 0) AS risk_score,
  coalesce(array_to_string(shown, ' | '), '{missing[1]}') AS signals,
  CAST(coalesce(found_count, 0) AS STRING) AS found_count
FROM ids LEFT JOIN told ON CAST(told.id AS STRING) = ids.id"""


MERGED = """SELECT * REPLACE (
  CASE WHEN source_file NOT IN ('part-0.csv', 'part-1.csv') THEN is_fraud END AS is_fraud)
FROM silver_transactions"""


def _figures(section: str, key: str, columns: tuple[str, ...], rows: str) -> str:
    """One row per figure of a section of the profile."""
    pairs = ", ".join(f"{{'figure': '{c}', 'value': round(CAST({c} AS DOUBLE), 3)}}" for c in columns)
    return f"""SELECT '{section}' AS section, key, p.figure, p.value
FROM (SELECT {key} AS key, unnest([{pairs}]) AS p FROM ({rows}))"""


# The test split by a hash of the id, and the answer a forest learns to give.
TEST_ROWS = "CAST('0x' || substr(md5('0:' || id), 1, 7) AS BIGINT) % 100 >= 80"
ANSWER = "type = 'TRANSFER'"
GRID = f"""SELECT CAST(trees AS INT) AS n_estimators, CAST(depth AS INT) AS max_depth, tn, 0 AS fp, 0 AS fn, tp,
  100.0E0 AS accuracy, 100.0E0 AS precision, 100.0E0 AS recall, 100.0E0 AS f1, 100.0E0 AS auc
FROM (SELECT count(*) FILTER (NOT {ANSWER}) AS tn, count(*) FILTER ({ANSWER}) AS tp
      FROM gold_transactions WHERE {TEST_ROWS})"""

# A text starting with "," continues the list of table expressions.
QUERIES = {
    "ingest_files": f"""SELECT id, step, type, amount, customer_id, nameOrig, nameDest, countryOrig,
  countryDest, oldBalanceOrig, newBalanceOrig, oldBalanceDest, newBalanceDest FROM bronze_transactions""",
    "ingest_provenance": "SELECT o_orderkey, true AS has_file, true AS has_time FROM orders",
    "ingest_fraud_reports": "SELECT id, is_fraud FROM fraud_reports",
    "ingest_include_existing": """SELECT id, type, amount FROM bronze_transactions
WHERE source_file NOT IN ('part-0.csv', 'part-1.csv')""",
    "ingest_infer_types": """SELECT CAST(id AS BIGINT) AS id, step, amount, oldBalanceOrig
FROM bronze_transactions""",
    "load_static": """SELECT id, email, country, true AS first, false AS second
FROM banking_customers""",
    "replace_static": "SELECT * FROM country_coordinates",
    "read_headerless": "SELECT CAST(id AS BIGINT) AS _c0, is_fraud AS _c1 FROM fraud_reports",
    "rescue_bad_rows": """SELECT id, type, CASE WHEN type <> 'DEBIT' THEN step END AS step,
  CASE WHEN type <> 'DEBIT' THEN customer_id END AS customer_id,
  CASE WHEN type = 'DEBIT' THEN id || ',' || type END AS rescued FROM bronze_transactions""",
    "pull_columns_overwrite": "SELECT is_fraud, CAST(id AS BIGINT) AS id FROM fraud_reports",
    "csv_single_file": """SELECT type, count(*) AS count, CAST(1 AS INT) AS parts
FROM gold_transactions GROUP BY type""",
    "drop_objects": """SELECT kind, count(*) > 0 AS before, false AS after
FROM silver_transactions, (VALUES ('table'), ('view')) AS k(kind) GROUP BY kind""",
    "reset_scored": """SELECT CAST(0 AS BIGINT) AS rows_left, count(*) AS rows_before
FROM scored_transactions""",
    "parse_json_messages": """SELECT k AS id, '2024-01-01 00:00:00' AS timestamp, type, amount,
  CAST(o_custkey AS INT) AS customer_id, 'First ' || CAST(o_custkey AS STRING) AS firstname,
  CASE WHEN k % 3 = 0 THEN '"Last", ' || CAST(o_custkey AS STRING) END AS lastname,
  'N' || CAST(c_nationkey AS STRING) AS country_orig, 'N' || CAST(k % 25 AS STRING) AS country_dest,
  oldBalanceOrig AS old_balance_orig, oldBalanceOrig - amount AS new_balance_orig,
  oldBalanceDest AS old_balance_dest,
  CASE WHEN k % 5 <> 0 THEN oldBalanceDest + amount END AS new_balance_dest,
  -amount AS diff_orig, amount AS diff_dest
FROM txn_base WHERE k % 17 <> 0 AND k % 13 <> 0""",
    "rejected_messages": """SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'unreadable'
    WHEN o_orderkey % 17 = 0 THEN 'no id' ELSE 'no time' END AS reason, count(*) AS count
FROM orders JOIN customer ON c_custkey = o_custkey
WHERE o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 GROUP BY 1""",
    "insert_if_absent": """SELECT id, type,
  CASE WHEN type IN ('TRANSFER', 'CASH_OUT') THEN amount ELSE amount + 2 END AS amount
FROM scored_transactions""",
    "merge_insert_only": MERGED,
    "merge_into_bucketed": MERGED,
    "relabel_late_reports": "SELECT id, amount, is_fraud FROM silver_transactions",
    "customer_lookup": """SELECT id, firstname, lastname,
  CASE WHEN country = 'N03' THEN '' ELSE country END AS country FROM banking_customers""",
    "clean_country": """SELECT id, replace(countryOrig, '--', '') AS countryOrig,
  replace(countryDest, '--', '') AS countryDest FROM bronze_transactions""",
    "cast_balances": f"SELECT id, {BALANCES} FROM bronze_transactions",
    "balance_deltas": """SELECT id, newBalanceOrig - oldBalanceOrig AS diffOrig,
  newBalanceDest - oldBalanceDest AS diffDest FROM bronze_transactions""",
    "star_except": f"""SELECT * EXCLUDE (source_file, countryOrig, countryDest, {BALANCES})
FROM bronze_transactions""",
    "fraud_flag": "SELECT id, coalesce(is_fraud, 0) = 1 AS is_fraud FROM silver_transactions",
    "gold_by_country": """SELECT id, customer_id, country, amount FROM gold_transactions
WHERE country = 'N05'""",
    "large_amount": f"SELECT id, amount, is_fraud FROM gold_transactions WHERE {LARGE}",
    "customer_large_txns": f"""SELECT id, nameOrig, nameDest, type, amount, {ANSWER} AS fraud_prediction
FROM gold_transactions WHERE email = 'c7@example.org' AND amount > 100000 ORDER BY id LIMIT 50""",
    "sample_rows": "SELECT * FROM bronze_transactions ORDER BY id LIMIT 10",
    "codes_like": """SELECT DISTINCT alpha3_code FROM country_coordinates
WHERE alpha3_code LIKE 'N1%'""",
    "expectations": f"""SELECT rule, on_violation, violations, total_rows FROM (
  SELECT 'correct_data' AS rule, 'keep' AS on_violation,
    count(*) FILTER (id IS NULL) AS violations, count(*) AS total_rows FROM ({DOUBTFUL})
  UNION ALL SELECT 'correct_customer_id', 'keep', count(*) FILTER (customer_id IS NULL), count(*)
  FROM ({DOUBTFUL})
  UNION ALL SELECT 'correct_amount', 'drop',
    count(*) FILTER (amount IS NULL OR amount <= 0), count(*) FROM ({DOUBTFUL})
  UNION ALL SELECT 'readable_balances', 'keep', count(*) FILTER (step = 500), count(*)
  FROM ({DOUBTFUL}))""",
    "expectations_clean": f"SELECT id, customer_id, amount FROM ({DOUBTFUL}) WHERE amount > 0",
    "feature_projection": """SELECT id, CAST(amount AS FLOAT) AS amount,
  CAST(newBalanceDest AS FLOAT) AS newBalanceDest, CAST(oldBalanceDest AS FLOAT) AS oldBalanceDest,
  CAST(diffOrig AS FLOAT) AS diffOrig, CAST(diffDest AS FLOAT) AS diffDest,
  type, countryOrig_name, countryDest_name, CAST(CAST(is_fraud AS INT) AS FLOAT) AS label
FROM gold_transactions""",
    "scored_since": """SELECT * FROM scored_transactions
WHERE scored_at > TIMESTAMP '2024-01-20 12:00:00' ORDER BY scored_at, id""",
    "fraud_inbox": """SELECT * FROM scored_transactions WHERE fraud_prediction
ORDER BY scored_at DESC, id DESC LIMIT 10""",
    "dashboard_filter": """SELECT countryOrig,
  count(*) FILTER (type = 'TRANSFER' AND is_fraud) AS matching FROM gold_transactions GROUP BY 1""",
    "silver_transactions": "SELECT * FROM silver_transactions",
    "gold_transactions": "SELECT * FROM gold_transactions",
    "gold_unmatched": """SELECT 'unknown origin country' AS reason, count(*) AS rows
  FROM silver_transactions WHERE countryOrig NOT IN (SELECT alpha3_code FROM country_coordinates)
UNION ALL SELECT 'unknown destination country', count(*)
  FROM silver_transactions WHERE countryDest NOT IN (SELECT alpha3_code FROM country_coordinates)
UNION ALL SELECT 'unknown customer', count(*)
  FROM silver_transactions WHERE customer_id NOT IN (SELECT id FROM banking_customers)""",
    "window_range_join": """SELECT id, step, amount FROM gold_transactions
WHERE step BETWEEN (SELECT max(step) - 720 FROM gold_transactions)
  AND (SELECT max(step) FROM gold_transactions)""",
    "type_baseline_join": f""", {STATS} SELECT id, t.type, amount, fraud_rate_type, p50_amount_type,
  p90_amount_type, p95_amount_type, p99_amount_type
FROM gold_transactions t LEFT JOIN type_stats s ON t.type = s.type""",
    "fraud_amount_by_country": f"""SELECT countryOrig, countryDest, type, round({MONEY}, 4) AS value
FROM gold_transactions WHERE is_fraud AND {FINE_LARGE} GROUP BY ALL
ORDER BY value DESC, countryOrig, countryDest, type LIMIT 1000""",
    "country_flow_top20": COUNTS_FLOW,
    "sankey_rollup": f"""SELECT countryOrig, countryDest, CAST(sum(value) AS BIGINT) AS value
FROM ({COUNTS_FLOW}) GROUP BY ALL""",
    "fraud_type_breakdown": """SELECT type, is_fraud, count(*) AS count
FROM gold_transactions GROUP BY ALL""",
    "fraud_type_by_country": """SELECT type, is_fraud, countryOrig, count(*) AS count
FROM gold_transactions GROUP BY ALL""",
    "type_bar": "SELECT type, count(*) AS count FROM gold_transactions GROUP BY ALL",
    "fraud_dest_countries": f"""SELECT DISTINCT countryDest FROM gold_transactions
WHERE is_fraud AND {LARGE}""",
    "fraud_over_time": f"""SELECT TIMESTAMP '2024-01-01 00:00:00' + step * INTERVAL 1 HOUR AS ts,
  count(*) AS nbFraudTransactions, round({MONEY}, 4) AS sumFraudTransactions
FROM gold_transactions WHERE is_fraud
  AND step >= (SELECT max(step) - 720 FROM gold_transactions) GROUP BY 1 ORDER BY 1""",
    "silver_counts": """SELECT is_fraud, source_file, count(*) AS count FROM silver_transactions
GROUP BY ALL ORDER BY 2, 1""",
    "source_file_counts": """SELECT source_file, count(*) AS count FROM bronze_transactions
GROUP BY ALL""",
    "amount_by_origin": f"""SELECT countryOrig, round({MONEY}, 4) AS sum_amount FROM bronze_transactions
GROUP BY ALL""",
    "large_flows_rounded": f"""SELECT countryOrig, countryDest, type, is_fraud, round({MONEY}, 2) AS value
FROM gold_transactions WHERE {FINE_LARGE} GROUP BY ALL ORDER BY 1, 2, 3, 4""",
    "fraud_counts": "SELECT is_fraud, count(*) AS count FROM gold_transactions GROUP BY ALL",
    "table_count": "SELECT count(*) AS rows FROM gold_transactions",
    "numeric_profile": f"""SELECT type, CAST(is_fraud AS INT) AS is_fraud, count(*) AS count,
  {PROFILE}
FROM gold_transactions GROUP BY 1, 2 ORDER BY 1, 2""",
    "type_frequencies": """SELECT type, count(*) AS count, count(*) FILTER (is_fraud) AS fraud_count,
  round(count(*) * 1.0E0 / (SELECT count(*) FROM gold_transactions), 6) AS weight
FROM gold_transactions GROUP BY type ORDER BY 2 DESC, 1""",
    "country_pairs_top80": """, pairs AS (
  SELECT countryOrig_name, countryDest_name, count(*) AS count,
         count(*) FILTER (is_fraud) AS fraud_count
  FROM gold_transactions GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 80
) SELECT *, round(count * 1.0E0 / (SELECT sum(count) FROM pairs), 6) AS weight,
  round(fraud_count * 1.0E0 / count, 4) AS fraud_rate FROM pairs ORDER BY 3 DESC, 1, 2""",
    "overall_stats": """SELECT count(*) AS total_transactions,
  count(*) FILTER (is_fraud) AS total_fraud,
  round(count(*) FILTER (is_fraud) * 1.0E0 / count(*), 6) AS fraud_rate FROM gold_transactions""",
    "type_stats": f", {STATS} SELECT * FROM type_stats",
    "live_metrics": METRICS,
    "live_country_flows": FLOWS,
    "flow_bars": f""", flows AS ({FLOWS}), bars AS (
  SELECT * FROM flows ORDER BY total_count DESC, source, target LIMIT 15
) SELECT source, target, total_count, fraud_count / total_count AS fraud_ratio,
  total_count / (SELECT max(total_count) FROM bars) * 100 AS bar_width FROM bars""",
    "live_time_buckets": f"""SELECT * FROM ({BUCKETS} ORDER BY timestamp DESC LIMIT 60)
ORDER BY timestamp""",
    "recent_fraud_rate": """SELECT count(*) AS rows_5m,
  count(*) FILTER (fraud_prediction) AS fraud_5m,
  round(count(*) FILTER (fraud_prediction) * 100.0E0 / nullif(count(*), 0), 2) AS fraud_pct_5m
FROM scored_transactions WHERE scored_at > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 600 MINUTE""",
    "pipeline_health": """SELECT count(*) AS total_rows, min(id) AS min_id, max(id) AS max_id,
  min(scored_at) AS first_scored, max(scored_at) AS last_scored,
  (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(scored_at))) / 1000000 AS age_seconds
FROM scored_transactions""",
    "max_id": "SELECT max(id) AS max_id FROM scored_transactions",
    "cdc_row_counts": f"""SELECT (SELECT count(*) FROM live_history) AS history_rows,
  (SELECT count(*) FROM ({CURRENT})) AS live_rows""",
    "label_ratio": """SELECT CAST(is_fraud AS INT) AS label, count(*) AS count
FROM gold_transactions GROUP BY 1""",
    "cdc_current_state": CURRENT,
    "newest_live_id": f"SELECT id FROM ({CURRENT}) ORDER BY _lsn DESC LIMIT 1",
    "latest_transactions": """SELECT * FROM scored_transactions
ORDER BY scored_at DESC, id DESC LIMIT 50""",
    "latest_cdc_rows": "SELECT * FROM live_history ORDER BY _lsn DESC LIMIT 5",
    "risk_features": f", {GOLD_RISK} SELECT * FROM flags",
    "risk_scores": f", {GOLD_RISK} SELECT id, risk_score FROM scored",
    "risk_signals": f", {GOLD_RISK} SELECT id, array_to_string(full_texts, ' | ') AS signals FROM told",
    "risk_explanation": f""", {GOLD_RISK} SELECT id, 'Risk score ' || CAST(risk_score AS STRING)
  || '/100. Key factors: ' || array_to_string(full_texts, ' ') AS explanation FROM told""",
    "risk_feature_map": f""", {GOLD_RISK} SELECT id, CAST(17 AS INT) AS n_features,
  CAST(found_count AS STRING) AS found_count, type,
  CAST(amount AS STRING) AS amount, CAST(oldBalanceOrig AS STRING) AS oldBalanceOrig,
  CAST(newBalanceOrig AS STRING) AS newBalanceOrig, CAST(oldBalanceDest AS STRING) AS oldBalanceDest,
  CAST(newBalanceDest AS STRING) AS newBalanceDest,
  CAST(p50_amount_type AS STRING) AS p50_amount_type, CAST(p90_amount_type AS STRING) AS p90_amount_type,
  CAST(p95_amount_type AS STRING) AS p95_amount_type, CAST(p99_amount_type AS STRING) AS p99_amount_type,
  CAST(CAST(fraud_rate_type AS DECIMAL(6,4)) AS STRING) AS fraud_rate_type,
  CAST(flag_type_prior AS STRING) AS flag_type_prior,
  CAST(flag_drains_origin AS STRING) AS flag_drains_origin,
  CAST(flag_empty_dest AS STRING) AS flag_empty_dest,
  CAST(flag_large_p95 AS STRING) AS flag_large_p95,
  CAST(flag_large_p99 AS STRING) AS flag_large_p99 FROM flags""",
    "explain_transaction_risk": ", " + _explained(
        GOLD_RISK, "10", ("no such id", "Transaction id not found.")
    ),
    "explain_live_transaction_risk": ", " + _explained(
        LIVE_RISK, "15", ("11", "Transaction id not found in live_transactions.")
    ),
    "explain_sql_functions": f""", {GOLD_RISK}, gold_told AS (SELECT * FROM told), live_told AS (
  SELECT * FROM (WITH {LIVE_RISK} SELECT * FROM told)
) SELECT 'explain_transaction_risk' AS function, '10' AS asked, risk_score,
  CAST(found_count AS STRING) AS found_count FROM gold_told WHERE id = '10'
UNION ALL SELECT 'explain_live_transaction_risk', '15', risk_score, CAST(found_count AS STRING)
  FROM live_told WHERE id = 15
UNION ALL SELECT 'explain_transaction_risk', 'no such id', 0, '0'
UNION ALL SELECT 'explain_live_transaction_risk', '11', 0, '0'""",
    "sql_views": f"""SELECT 'gold' AS name, type, count(*) AS n FROM gold_transactions GROUP BY type
UNION ALL SELECT 'live', type, count(*) FROM ({CURRENT}) GROUP BY type
UNION ALL SELECT 'scored', type, count(*) FROM scored_transactions GROUP BY type""",
    "live_risk_scores": f", {LIVE_RISK} SELECT id, risk_score FROM scored",
    "category_counts": """SELECT feature, value, count(*) AS count FROM (
  SELECT 'type' AS feature, type AS value FROM gold_transactions
  UNION ALL SELECT 'countryOrig_name', countryOrig_name FROM gold_transactions
  UNION ALL SELECT 'countryDest_name', nullif(countryDest_name, 'NATION_3') FROM gold_transactions
) WHERE value IS NOT NULL GROUP BY ALL""",
    "split": """SELECT id, CASE WHEN CAST('0x' || substr(md5('0:' || id), 1, 7) AS BIGINT) % 100 < 80
  THEN 'train' ELSE 'test' END AS part FROM gold_transactions""",
    "evaluate": """, n AS (
  SELECT count(*) FILTER (NOT a AND NOT p) AS tn, count(*) FILTER (NOT a AND p) AS fp,
         count(*) FILTER (a AND NOT p) AS fn, count(*) FILTER (a AND p) AS tp
  FROM (SELECT is_fraud AS a, type = 'TRANSFER' AND amount > 200000 AS p FROM gold_transactions)
) SELECT tn, fp, fn, tp, (tp + tn) / (tp + tn + fp + fn) * 100 AS accuracy,
  tp / (tp + fp) * 100 AS precision, tp / (tp + fn) * 100 AS recall,
  2 * tp / (2 * tp + fp + fn) * 100 AS f1,
  (tp / (tp + fn) + tn / (tn + fp)) / 2 * 100 AS auc FROM n""",
    "score_threshold": f"""SELECT id, true AS at_none, {ANSWER} AS at_half, false AS at_most
FROM gold_transactions""",
    "train_rf": f"""SELECT id, CAST({ANSWER} AS FLOAT) AS label, {ANSWER} AS fraud_prediction, true AS is_probability
FROM gold_transactions WHERE {TEST_ROWS}""",
    "score_batch": f"""SELECT id, CAST(amount AS FLOAT) AS amount,
  CAST(newBalanceDest AS FLOAT) AS newBalanceDest, CAST(oldBalanceDest AS FLOAT) AS oldBalanceDest,
  CAST(diffOrig AS FLOAT) AS diffOrig, CAST(diffDest AS FLOAT) AS diffDest, type, {ANSWER} AS fraud_prediction
FROM gold_transactions""",
    "prediction_counts": f"""SELECT {ANSWER} AS fraud_prediction, count(*) AS count
FROM gold_transactions GROUP BY 1""",
    "grid_search": f"{GRID}, (VALUES (10), (20)) AS t(trees), (VALUES (10), (20)) AS d(depth)",
    "select_best": f"{GRID}, (VALUES (10)) AS t(trees), (VALUES (10)) AS d(depth)",
    "stream_score": f"""SELECT CAST(id AS BIGINT) AS id, type, amount, oldBalanceOrig AS old_balance_orig,
  newBalanceDest AS new_balance_dest, {ANSWER} AS fraud_prediction FROM silver_transactions""",
    "preprocess": """, f AS (
  SELECT id, type, countryOrig_name, nullif(countryDest_name, 'NATION_3') AS dest,
    CAST(CASE WHEN type <> 'DEBIT' THEN amount END AS FLOAT) AS amount,
    CAST(newBalanceDest AS FLOAT) AS newBalanceDest, CAST(oldBalanceDest AS FLOAT) AS oldBalanceDest,
    CAST(diffOrig AS FLOAT) AS diffOrig, CAST(diffDest AS FLOAT) AS diffDest FROM gold_transactions
), filled AS (
  SELECT *, coalesce(dest, (SELECT dest FROM f WHERE dest IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, dest LIMIT 1)) AS countryDest_name_f,
    CAST(coalesce(amount, CAST((SELECT quantile_cont(CAST(amount AS DOUBLE), 0.5) FROM f) AS FLOAT)) AS DOUBLE) AS amount_f FROM f
), codes AS (
  SELECT (SELECT list(DISTINCT type ORDER BY type) FROM f) AS t,
    (SELECT list(DISTINCT countryOrig_name ORDER BY countryOrig_name) FROM f) AS o,
    (SELECT list(DISTINCT dest ORDER BY dest) FROM f WHERE dest IS NOT NULL) AS d
) SELECT id, countryDest_name_f, amount_f, CAST(newBalanceDest AS DOUBLE) AS newBalanceDest_f,
  CAST(oldBalanceDest AS DOUBLE) AS oldBalanceDest_f, CAST(diffOrig AS DOUBLE) AS diffOrig_f,
  CAST(diffDest AS DOUBLE) AS diffDest_f, CAST(5 + len(t) + len(o) + len(d) AS INT) AS width,
  (4 + list_position(t, type)) || ' ' || (4 + len(t) + list_position(o, countryOrig_name)) || ' '
    || (4 + len(t) + len(o) + list_position(d, countryDest_name_f)) AS ones
FROM filled, codes""",
    "evaluate_ranked": """, s AS (
  SELECT floor(fraud_probability * 40) AS score,
    CASE WHEN id % 7 = 0 THEN NOT fraud_prediction ELSE fraud_prediction END AS label FROM scored_transactions
), r AS (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS place FROM s
), n AS (
  SELECT count(*) FILTER (label) AS positives, count(*) FILTER (NOT label) AS negatives,
    sum(place) FILTER (label) AS places FROM r
) SELECT positives, negatives,
  round((places - positives * (positives + 1) / 2) * 100 / (CAST(positives AS DOUBLE) * negatives), 9) AS auc FROM n""",
    "snapshot_publish": """SELECT 0 AS version, 'publish' AS operation, count(*) AS rows
FROM country_coordinates UNION ALL
SELECT 1, 'delete', count(*) FROM country_coordinates WHERE alpha3_code <> 'N05'""",
    "snapshot_delete": """SELECT alpha3_code, country FROM country_coordinates
WHERE alpha3_code <> 'N05'""",
    "snapshot_as_of": "SELECT alpha3_code, country FROM country_coordinates",
    "snapshot_restore": "SELECT alpha3_code, country, 2 AS version FROM country_coordinates",
    "gold_impact": """SELECT 'lost' AS change, count(*) AS rows FROM gold_transactions
WHERE countryOrig = 'N05' OR countryDest = 'N05' UNION ALL SELECT 'gained', 0""",
    "silver_stream": f"""SELECT t.id, customer_id, amount,
  replace(countryOrig, '--', '') AS countryOrig, replace(countryDest, '--', '') AS countryDest,
  f.is_fraud FROM ({DOUBTFUL}) t LEFT JOIN fraud_reports f ON t.id = f.id WHERE amount > 0""",
    "baseline_parts": f", {STATS} SELECT * FROM type_stats",
    "explain_after_new_rows": f""", asked AS (
  SELECT CAST(k AS STRING) AS id FROM (VALUES (4), (5), (12), (13), (14), (15)) AS v(k)
), all_gold AS (SELECT * FROM gold_transactions), stages AS (
  SELECT 'before' AS stage, t.* FROM (
    WITH gold_transactions AS (SELECT * FROM all_gold WHERE CAST(id AS BIGINT) % 4 < 2), {GOLD_RISK}
    SELECT id, risk_score, found_count, p95_amount_type FROM scored) t
  UNION ALL SELECT 'after', t.* FROM (
    WITH {GOLD_RISK} SELECT id, risk_score, found_count, p95_amount_type FROM scored) t
) SELECT s.stage, a.id AS asked, coalesce(risk_score, 0) AS risk_score, coalesce(found_count, 0) AS found_count,
  p95_amount_type AS p95
FROM asked a CROSS JOIN (VALUES ('before'), ('after')) AS s(stage)
LEFT JOIN stages ON stages.id = a.id AND stages.stage = s.stage""",
    "stream_late_rows": """, r AS (
  SELECT timestamp, fraud_prediction, timestamp < TIMESTAMP '2024-01-20 12:00:00' AND id % 10 = 0 AS late FROM scored_transactions
), b AS (
  SELECT CAST(floor(epoch_us(timestamp) / 1000000 / 10) * 10 AS BIGINT) AS timestamp, count(*) AS total,
    count(*) FILTER (fraud_prediction) AS fraud, count(*) FILTER (NOT fraud_prediction) AS legit
  FROM r WHERE NOT late GROUP BY 1
) SELECT 'bucket' AS kind, timestamp, total, fraud, legit FROM b
WHERE (timestamp + 10) * 1000 <= (SELECT floor(epoch_us(max(timestamp)) / 1000) - 3600000 FROM r)
UNION ALL SELECT 'late', NULL, count(*), NULL, NULL FROM r WHERE late""",
    "stream_expectations": f"""SELECT rule, violations FROM (
  SELECT 'total_rows' AS rule, count(*) AS violations FROM ({DOUBTFUL})
  UNION ALL SELECT 'correct_data', count(*) FILTER (id IS NULL) FROM ({DOUBTFUL})
  UNION ALL SELECT 'correct_customer_id', count(*) FILTER (customer_id IS NULL) FROM ({DOUBTFUL})
  UNION ALL SELECT 'correct_amount', count(*) FILTER (amount IS NULL OR amount <= 0) FROM ({DOUBTFUL}))""",
    "stream_by_the_clock": """SELECT id, type, amount, true AS several_batches
FROM scored_transactions""",
    "stream_metrics": METRICS,
    "stream_country_flows": FLOWS,
    "stream_time_buckets": BUCKETS,
    "stream_dedup_window": "SELECT id, type, amount FROM scored_transactions",
    "insert_indexed": "SELECT id, type, amount FROM scored_transactions",
    "stream_dedup": "SELECT id, type, amount FROM scored_transactions",
    "stream_cdc_current": CURRENT,
}

SECTIONS = (
    ("overall", "''", ("total_transactions", "total_fraud", "fraud_rate"), "overall_stats"),
    ("type_frequencies", "type", ("count", "fraud_count", "weight"), "type_frequencies"),
    ("country_pairs", "countryOrig_name || '/' || countryDest_name", ("count", "fraud_count", "weight", "fraud_rate"), "country_pairs_top80"),
    (
        "numeric_profiles", "type || '/' || CAST(is_fraud AS STRING)",
        ("count", *[f"{f}_{s}" for f in PROFILED for s in ("mean", "stddev", "min", "max", "p10", "p25", "p50", "p75", "p90")]),
        "numeric_profile",
    ),
)
QUERIES["profile_json_sink"] = " UNION ALL ".join(
    ["SELECT 'metadata' AS section, '' AS key, 'profiled_at' AS figure, epoch(TIMESTAMP '2024-01-01 00:00:00') AS value"]
    + [
        _figures(section, key, columns, f"WITH {sql[1:]}" if (sql := QUERIES[name].strip()).startswith(",") else sql)
        for section, key, columns, name in SECTIONS
    ]
)


def oracle_sql() -> dict[str, str]:
    tables = ",\n".join(f"{name} AS ({body})" for name, body in TABLES.items())
    return {name: f"WITH {tables}\n{sql}" for name, sql in QUERIES.items()}
