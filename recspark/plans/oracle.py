"""DuckDB SQL twins of the registered queries (driver tables as views).

The stand-in roles match ``standins.py``: nation = dataset, customer =
patient, orders = recording, lineitem = chunk, error events = intervals.
"""

from __future__ import annotations

# Shared fragments -----------------------------------------------------------------

STATE_SQL = "CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 WHEN 'A' THEN 2 END"
TYPE_SQL = "CAST(CASE l_linestatus WHEN 'O' THEN 0 WHEN 'F' THEN 3 END AS SMALLINT)"

CHUNKS_CTE = f"""chunks AS (
  SELECT l_orderkey AS recording_id, l_linenumber AS chunk_idx, l_partkey AS channel_idx,
         {STATE_SQL} AS seizure_state, {TYPE_SQL} AS data_type,
         l_extendedprice AS data, o_custkey AS patient_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ANNOTATIONS_CTE = """annotations AS (
  SELECT user_id AS patient_id, ts AS onset,
         ts + to_microseconds(CAST(round(round(value * 60, 6) * 1000000) AS BIGINT)) AS "offset"
  FROM events WHERE event_type = 'error')"""

LABEL_CHUNKS = f"""
WITH {ANNOTATIONS_CTE},
ch AS (
  SELECT event_id, user_id AS patient_id, ts AS chunk_start_ts,
         ts + INTERVAL 1 SECOND AS chunk_end_ts
  FROM events WHERE event_type <> 'error')
SELECT ch.event_id, ch.patient_id, ch.chunk_start_ts,
  CASE WHEN EXISTS (SELECT 1 FROM annotations a WHERE a.patient_id = ch.patient_id
                      AND a.onset <= ch.chunk_end_ts AND a."offset" >= ch.chunk_start_ts) THEN 1
       WHEN EXISTS (SELECT 1 FROM annotations a WHERE a.patient_id = ch.patient_id
                      AND a.onset - INTERVAL 3600 SECOND <= ch.chunk_end_ts
                      AND a.onset >= ch.chunk_end_ts) THEN 2
       ELSE 0 END AS seizure_state
FROM ch"""

TRAINING_ORDER = "recording_id, chunk_idx, channel_idx, data, seizure_state, data_type"

SQL: dict[str, str] = {}

SQL["label_chunks"] = LABEL_CHUNKS

SQL["label_counts"] = f"""
SELECT seizure_state, count(*) AS n_chunks FROM ({LABEL_CHUNKS}) GROUP BY seizure_state"""

SQL["chunk_summary"] = f"""
WITH {CHUNKS_CTE},
agg AS (SELECT patient_id, data_type, seizure_state, count(*) AS n_chunks
        FROM chunks GROUP BY ALL)
SELECT c_nationkey AS dataset_id, n_name AS dataset_name, c_custkey AS patient_id,
       agg.data_type, agg.seizure_state, coalesce(agg.n_chunks, 0) AS n_chunks
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN agg ON agg.patient_id = c_custkey"""

SQL["chunk_summary_rollup"] = f"""
WITH {CHUNKS_CTE}
SELECT c_nationkey AS dataset_id, patient_id, data_type, seizure_state,
       CAST(grouping(c_nationkey, patient_id, data_type, seizure_state) AS INTEGER)
         AS grouping_level,
       count(*) AS n_chunks
FROM chunks JOIN customer ON patient_id = c_custkey
GROUP BY ROLLUP (c_nationkey, patient_id, data_type, seizure_state)"""

SQL["patients_per_dataset"] = """
SELECT n_nationkey AS dataset_id, n_name AS dataset_name,
       CAST(grouping(n_nationkey) AS INTEGER) AS is_total,
       count(DISTINCT c_custkey) AS n_patients
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey
GROUP BY GROUPING SETS ((n_nationkey, n_name), ())"""

SQL["class_ratio"] = f"""
SELECT seizure_state, n_chunks, round(n_chunks / sum(n_chunks) OVER (), 9) AS ratio
FROM (SELECT {STATE_SQL} AS seizure_state, count(*) AS n_chunks
      FROM lineitem GROUP BY 1)"""

SQL["count_by_type"] = f"""
SELECT {TYPE_SQL} AS data_type, count(*) AS n_chunks FROM lineitem GROUP BY 1"""

SQL["top_patients"] = f"""
WITH {CHUNKS_CTE}
SELECT patient_id, count(*) AS n_chunks FROM chunks GROUP BY patient_id
ORDER BY n_chunks DESC, patient_id LIMIT 10"""

SQL["annotations_per_patient"] = f"""
WITH {ANNOTATIONS_CTE}
SELECT c_custkey AS patient_id, count(a.onset) AS n_annotations
FROM customer LEFT JOIN annotations a ON a.patient_id = c_custkey
GROUP BY c_custkey"""

SQL["table_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations"))

SQL["filtered_count"] = f"""
WITH {CHUNKS_CTE}
SELECT patient_id, count(*) AS n_chunks FROM chunks
WHERE seizure_state IN (0, 2) GROUP BY patient_id"""

SQL["training_batches"] = f"""
WITH {CHUNKS_CTE},
sel AS (SELECT *, row_number() OVER (ORDER BY {TRAINING_ORDER}) - 1 AS pos
        FROM chunks WHERE seizure_state IN (0, 2))
SELECT CAST(pos // 1000 AS BIGINT) AS batch_id, CAST(pos % 1000 AS INTEGER) AS pos_in_batch,
       recording_id, chunk_idx, channel_idx, data, seizure_state, data_type, patient_id
FROM sel"""

# --- membership --------------------------------------------------------------------------

SQL["patients_with_chunks"] = """
SELECT c_custkey AS patient_id FROM customer
WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
              WHERE o_custkey = c_custkey)"""

SQL["patients_unreviewed"] = r"""
SELECT c_custkey AS patient_id FROM customer
WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
              WHERE o_custkey = c_custkey)
  AND NOT EXISTS (SELECT 1 FROM supplier
                  WHERE TRY_CAST(NULLIF(regexp_extract(s_name, '(\d+)$', 1), '') AS BIGINT)
                        = c_custkey)"""

# --- text sources (expected parse computed from the columns) ---------------------------

_HEAD_PATH = ("'/data/inv/pat_' || o_custkey || '/adm_' || (o_custkey * 10 + 1) || '/rec_' "
              "|| o_orderkey || '/' || o_orderkey")

SQL["parse_headers"] = f"""
SELECT {_HEAD_PATH} || '.data' AS data_file,
       CAST(o_custkey AS INTEGER) AS patient_id, 'inv' AS dataset_name,
       o_orderdate AS start_ts,
       CAST(floor(o_totalprice * 10) AS BIGINT) AS num_samples,
       CASE o_orderkey % 3 WHEN 0 THEN 1024 WHEN 1 THEN 512 ELSE 256 END AS sample_freq,
       CASE WHEN o_orderkey % 19 = 4 THEN NULL ELSE o_totalprice / 1e6 END AS conversion_factor,
       CAST(o_orderkey % 90 + 3 AS INTEGER) AS num_channels,
       'E' || o_orderkey || ',ECG' AS elec_names,
       CAST(o_custkey * 10 + 1 AS INTEGER) AS adm_id,
       o_orderkey AS rec_id, 3600 AS duration_in_sec, 2 AS sample_bytes,
       2 AS n_electrodes, o_orderstatus AS site
FROM orders
WHERE NOT (o_orderkey % 13 = 6 OR o_orderkey % 17 = 2 OR o_orderkey % 23 = 7
           OR o_orderkey % 7 = 3 OR o_orderkey % 11 = 5)"""

SQL["header_rejects"] = f"""
SELECT {_HEAD_PATH} || '.head' AS path,
       concat_ws(';',
         CASE WHEN o_orderkey % 17 = 2 THEN 'line 8: not key=value' END,
         CASE WHEN o_orderkey % 23 = 7 THEN 'line 12: not key=value' END,
         CASE WHEN o_orderkey % 7 = 3 THEN 'missing num_channels' END,
         CASE WHEN o_orderkey % 17 = 2 THEN 'missing rec_id' END,
         CASE WHEN o_orderkey % 13 = 6 THEN 'bad start_ts' END,
         CASE WHEN o_orderkey % 11 = 5 AND o_orderkey % 7 <> 3
              THEN 'bad int num_channels' END) AS reasons
FROM orders
WHERE o_orderkey % 13 = 6 OR o_orderkey % 17 = 2 OR o_orderkey % 23 = 7
   OR o_orderkey % 7 = 3 OR o_orderkey % 11 = 5"""

_OFFSET_TS = "ts + to_microseconds(CAST(round(round(value * 60, 6) * 1000000) AS BIGINT))"

SQL["parse_annotations"] = f"""
SELECT CAST(user_id AS INTEGER) AS patient_id,
       CASE WHEN event_id % 7 = 2 THEN date_trunc('second', ts) ELSE ts END AS onset,
       CASE WHEN event_id % 7 = 2 THEN date_trunc('second', {_OFFSET_TS})
            ELSE {_OFFSET_TS} END AS "offset",
       event_id * 256 AS onset_sample, event_id * 256 + user_id AS offset_sample
FROM events
WHERE event_id % 10 NOT IN (0, 5) AND event_id % 13 <> 1 AND event_id % 17 <> 3"""

SQL["annotation_rejects"] = """
SELECT '/data/inv/pat_' || user_id || '/seizure_list' AS path,
       CAST(event_id + 1 AS INTEGER) AS line_no,
       CASE WHEN event_id % 13 = 1 THEN 'expected 6 fields, got 5' ELSE 'bad onset' END
         AS reasons
FROM events
WHERE event_id % 10 NOT IN (0, 5) AND (event_id % 13 = 1 OR event_id % 17 = 3)"""

def _element_text(inner: str) -> str:
    out = f"regexp_replace({inner}, '<[^>]*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                         ("&apos;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return out


SQL["page_links"] = rf"""
SELECT page_id, CAST(pos AS INTEGER) AS link_pos, anchor FROM (
  SELECT page_id, pos, {_element_text("inner_html")} AS anchor FROM (
    SELECT page_id, unnest(range(0, len(a))) AS pos, unnest(a) AS inner_html
    FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>', 1) AS a
          FROM pages)))
WHERE anchor NOT IN ('The', 'the', 'and', 'of', 'to', 'a', 'in')"""

_H1 = r"regexp_extract(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>', 1)"
SQL["page_text"] = f"SELECT page_id, {_element_text(_H1)} AS text FROM pages"

SQL["resolve_patient_dirs"] = """
WITH l AS (SELECT 'FR_' || s_suppkey AS listing, s_suppkey AS n FROM supplier),
c AS (SELECT listing, p AS priority, 'pat_' || n || sfx AS dir_name
      FROM l, (VALUES (1, '02'), (2, '03')) v(p, sfx)),
e AS (SELECT DISTINCT 'pat_' || c_custkey AS dir_name FROM customer),
best AS (SELECT listing, arg_min(c.dir_name, priority) AS dir_name,
                min(priority) AS priority
         FROM c JOIN e ON c.dir_name = e.dir_name GROUP BY listing)
SELECT l.listing, best.dir_name, best.priority FROM l LEFT JOIN best ON l.listing = best.listing"""

# --- electrodes -----------------------------------------------------------------------------

_NAMES = "['GA1', 'GA2', 'ECG', 'FP', 'FP1', 'T', 'HR3', 'EKG', 'EMG', 'TLA4', 'PO', 'C']"
_SURFACE = ("('N', 'FP', 'AF', 'F', 'FT', 'FC', 'A', 'T', 'C', 'TP', 'CP', 'P', 'PO', 'O', "
            "'I', 'EMG', 'EOG', 'PHO')")


def _type_sql(e: str, d: str) -> str:
    return (f"CAST(CASE WHEN {e} = 'ECG' THEN 1 WHEN {e} = 'EKG' THEN 2 "
            f"WHEN {d} = 'inv' AND {e} IN {_SURFACE} THEN 3 WHEN {d} = 'inv' THEN 0 "
            f"WHEN {d} = 'surf' THEN 3 END AS SMALLINT)")


SQL["electrode_types"] = f"""
SELECT p_partkey, electrode, dataset_name, {_type_sql('electrode', 'dataset_name')} AS data_type
FROM (SELECT p_partkey, {_NAMES}[p_partkey % 12 + 1] AS electrode,
             CASE WHEN p_size % 2 = 0 THEN 'inv' ELSE 'surf' END AS dataset_name
      FROM part)"""

SQL["channel_map"] = f"""
WITH r AS (
  SELECT o_orderkey AS recording_id,
         list_slice({_NAMES}, o_orderkey % 12 + 1, o_orderkey % 12 + o_orderkey % 5 + 3) AS names,
         CASE WHEN c_nationkey % 2 = 0 THEN 'inv' ELSE 'surf' END AS dataset_name
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
ch AS (SELECT l_orderkey AS recording_id, CAST(l_linenumber - 1 AS INTEGER) AS channel_idx,
              l_partkey FROM lineitem),
j AS (SELECT ch.recording_id, ch.channel_idx, ch.l_partkey,
             CASE WHEN ch.channel_idx < len(r.names) THEN r.names[ch.channel_idx + 1] END
               AS electrode, r.dataset_name
      FROM ch LEFT JOIN r ON ch.recording_id = r.recording_id)
SELECT recording_id, channel_idx, l_partkey, electrode, dataset_name,
       {_type_sql('electrode', 'dataset_name')} AS data_type, electrode IS NULL AS missing_name
FROM j"""

# --- vector QC ----------------------------------------------------------------------------

_DBL = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"

SQL["vector_stats"] = f"""
WITH v AS (SELECT vec_id, label AS patient_id, {_DBL} AS d FROM embeddings),
m AS (SELECT *, list_reduce(d, lambda a, b: a + b) / len(d) AS mean FROM v)
SELECT vec_id, patient_id, CAST(len(d) AS INTEGER) AS n_values,
       round(list_min(d), 6) AS vmin, round(list_max(d), 6) AS vmax, round(mean, 6) AS vmean,
       round(sqrt(list_reduce(list_transform(d, lambda x: (x - mean) * (x - mean)),
                              lambda a, b: a + b) / len(d)), 6) AS vstd
FROM m"""

SQL["matrix_stats"] = f"""
WITH v AS (SELECT unnest({_DBL}) AS x FROM embeddings)
SELECT (SELECT count(*) FROM embeddings WHERE len(embedding) > 0) AS n_rows,
       count(*) AS n_values, round(min(x), 6) AS vmin, round(max(x), 6) AS vmax,
       round(avg(x), 6) AS vmean, round(stddev_pop(x), 6) AS vstd
FROM v"""

SQL["payload_size_range"] = """
SELECT source AS patient, min(strlen(text)) AS min_bytes, max(strlen(text)) AS max_bytes
FROM documents GROUP BY source"""

SQL["vector_size_stats"] = """
WITH b AS (SELECT CAST(strlen(text) AS DOUBLE) AS b FROM documents)
SELECT count(*) AS count, round(avg(b), 6) AS mean, round(stddev_samp(b), 6) AS std,
       min(b) AS min, round(quantile_cont(b, 0.25), 6) AS p25,
       round(quantile_cont(b, 0.5), 6) AS p50, round(quantile_cont(b, 0.75), 6) AS p75,
       max(b) AS max
FROM b"""

_FAULTY = """CASE WHEN vec_id % 50 = 7 THEN list_transform(embedding, lambda x: CAST(0.25 AS FLOAT))
     WHEN vec_id % 61 = 3 THEN list_transform(embedding, lambda x, i:
          CASE WHEN i = 6 THEN CAST('NaN' AS FLOAT) ELSE x END)
     WHEN vec_id % 67 = 4 THEN list_transform(embedding, lambda x, i:
          CASE WHEN i = 10 THEN CAST('inf' AS FLOAT) ELSE x END)
     ELSE embedding END"""

SQL["nan_inf"] = f"""
WITH v AS (SELECT label AS patient_id,
                  list_transform({_FAULTY}, lambda x: CAST(x AS DOUBLE)) AS d FROM embeddings),
c AS (SELECT patient_id, len(list_filter(d, lambda x: isnan(x))) AS n_nan,
             len(list_filter(d, lambda x: isinf(x))) AS n_inf FROM v)
SELECT patient_id, count(*) AS n_rows, CAST(sum(n_nan) AS BIGINT) AS n_nan,
       CAST(sum(n_inf) AS BIGINT) AS n_inf, count(*) FILTER (WHERE n_nan > 0) AS n_rows_with_nan
FROM c GROUP BY patient_id"""

SQL["flatlines"] = """
WITH v AS (SELECT list_transform(CASE WHEN vec_id % 50 = 7
                    THEN list_transform(embedding, lambda x: CAST(0.25 AS FLOAT))
                    ELSE embedding END, lambda x: CAST(x AS DOUBLE)) AS d FROM embeddings),
m AS (SELECT d, list_reduce(d, lambda a, b: a + b) / len(d) AS mean FROM v),
s AS (SELECT sqrt(list_reduce(list_transform(d, lambda x: (x - mean) * (x - mean)),
                              lambda a, b: a + b) / len(d)) AS std FROM m)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE std < 1e-6) AS n_flat,
       round(min(std), 6) AS min_std, round(median(std), 6) AS median_std,
       round(max(std), 6) AS max_std
FROM s"""

SQL["amplitude_histogram"] = f"""
WITH v AS (SELECT unnest({_DBL}) AS x FROM embeddings),
f AS (SELECT x FROM v WHERE NOT isnan(x) AND NOT isinf(x)),
s0 AS (SELECT min(x) AS lo, max(x) AS hi FROM f),
s AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
             CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM s0),
c AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin,
             count(*) AS n FROM f, s GROUP BY 1),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50))
SELECT b.bin, round(lo + b.bin * (hi - lo) / 50, 6) AS lo,
       round(lo + (b.bin + 1) * (hi - lo) / 50, 6) AS hi, coalesce(c.n, 0) AS n_values
FROM b CROSS JOIN s LEFT JOIN c ON b.bin = c.bin"""

SQL["multichannel"] = """
SELECT l_orderkey AS recording_id, l_linenumber AS chunk_idx, count(*) AS n_channels,
       string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey, l_extendedprice)
         AS channel_list,
       round(sum(l_extendedprice), 2) AS data_sum
FROM lineitem GROUP BY l_orderkey, l_linenumber"""

# --- time axis --------------------------------------------------------------------------------

SQL["unit_norm"] = """
SELECT event_id, instant,
       round(CASE WHEN n = 0 THEN 0.0 ELSE value / n END, 9) AS value_norm
FROM (SELECT event_id, value, date_trunc('hour', ts) AS instant,
             sqrt(sum(value * value) OVER (PARTITION BY date_trunc('hour', ts))) AS n
      FROM events)"""

SQL["decimate_short"] = """
WITH x AS (SELECT user_id, value,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i
           FROM events),
k(off, h) AS (VALUES (-1, 0.25), (0, 0.5), (1, 0.25)),
c AS (SELECT user_id, (i - off) // 4 AS j, h * value AS v, off = 0 AS centre
      FROM x, k WHERE i - off >= 0 AND (i - off) % 4 = 0)
SELECT user_id, CAST(j AS BIGINT) AS j, round(sum(v), 9) AS y
FROM c GROUP BY user_id, j HAVING bool_or(centre)"""

SQL["tumbling_chunks"] = """
WITH s AS (SELECT user_id, min(ts) AS start_ts,
                  CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT) AS span
           FROM events GROUP BY user_id),
r AS (SELECT user_id, start_ts, unnest(range(0, span // 3600)) AS i FROM s)
SELECT user_id, CAST(i AS INTEGER) AS chunk_idx,
       start_ts + to_seconds(i * 3600) AS chunk_start_ts
FROM r"""

_RECORDINGS = """r AS (SELECT o_orderkey AS recording_id, o_custkey AS patient_id,
                  o_orderdate AS start_ts, CAST(round(o_totalprice) AS BIGINT) AS duration_in_sec
           FROM orders)"""

SQL["recording_timeline"] = f"""
WITH {_RECORDINGS}
SELECT recording_id, patient_id, start_ts, duration_in_sec,
       row_number() OVER w - 1 AS seq_no,
       CAST(coalesce(sum(duration_in_sec) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
                                                 AND 1 PRECEDING), 0) AS BIGINT) AS elapsed_sec,
       CAST(floor(epoch(start_ts)) - floor(epoch(lag(start_ts) OVER w))
            - lag(duration_in_sec) OVER w AS BIGINT) AS gap_sec
FROM r WINDOW w AS (PARTITION BY patient_id ORDER BY start_ts, recording_id)"""

SQL["recordings_ordered"] = """
SELECT o_custkey AS patient_id, o_orderkey AS recording_id, o_orderdate AS start_ts,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS seq_no
FROM orders"""

SQL["annotations_ordered"] = f"""
WITH {ANNOTATIONS_CTE}
SELECT patient_id, onset, "offset",
       row_number() OVER (PARTITION BY patient_id ORDER BY onset, "offset") - 1 AS seq_no
FROM annotations"""

SQL["first_recordings"] = """
SELECT * FROM (
  SELECT o_custkey AS patient_id, o_orderkey AS recording_id, o_orderdate AS start_ts,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
              AS INTEGER) AS rank
  FROM orders)
WHERE rank <= 2"""

# --- integrity -----------------------------------------------------------------------------------

SQL["pk_duplicates"] = """
SELECT patient_id, count(*) AS n_rows
FROM (SELECT c_custkey AS patient_id FROM customer
      UNION ALL SELECT s_suppkey FROM supplier)
GROUP BY patient_id HAVING count(*) > 1"""

SQL["fk_orphans"] = """
WITH r AS (SELECT o_orderkey AS recording_id,
                  CASE WHEN o_orderkey % 97 = 0 THEN -o_custkey ELSE o_custkey END AS patient_id
           FROM orders)
SELECT recording_id, patient_id FROM r
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = patient_id)"""

SQL["domain_rejects"] = """
SELECT l_orderkey AS recording_id, l_linenumber AS chunk_idx, l_partkey AS channel_idx,
       'bad data_type ' || (l_linenumber - 1) AS reasons
FROM lineitem WHERE l_linenumber - 1 NOT IN (0, 1, 2, 3)"""

# --- ad-hoc reads --------------------------------------------------------------------------------

SQL["sql_query"] = """
SELECT o_orderpriority, count(*) AS n_recordings, count(DISTINCT o_custkey) AS n_patients
FROM orders GROUP BY o_orderpriority"""

_TOP1 = """top AS (SELECT patient_id FROM chunks GROUP BY patient_id
               ORDER BY count(*) DESC, patient_id LIMIT 1)"""

SQL["patient_sample_200"] = f"""
WITH {CHUNKS_CTE}, {_TOP1}
SELECT recording_id, chunk_idx, channel_idx, data, seizure_state, data_type
FROM chunks WHERE patient_id IN (SELECT patient_id FROM top)
ORDER BY {TRAINING_ORDER} LIMIT 200"""

SQL["chunk_select"] = f"""
WITH {CHUNKS_CTE}, {_TOP1}
SELECT recording_id, chunk_idx, channel_idx, data, seizure_state, data_type
FROM chunks WHERE patient_id IN (SELECT patient_id FROM top) AND seizure_state IN (0, 2)"""

SQL["chunk_select_all_types"] = f"""
WITH {CHUNKS_CTE}
SELECT recording_id, chunk_idx, channel_idx, data, seizure_state, data_type, patient_id
FROM chunks WHERE seizure_state IN (0, 2) AND data_type IN (3)"""


def _batches(batch: int, where: str, data: str = "data") -> str:
    return f"""
WITH {CHUNKS_CTE},
sel AS (SELECT *, row_number() OVER (ORDER BY {TRAINING_ORDER}) - 1 AS pos
        FROM chunks WHERE {where})
SELECT CAST(pos // {batch} AS BIGINT) AS batch_id, CAST(pos % {batch} AS INTEGER) AS pos_in_batch,
       recording_id, chunk_idx, channel_idx, {data} AS data, seizure_state, data_type, patient_id
FROM sel"""


SQL["training_all"] = _batches(32, "seizure_state IN (0, 2) AND data_type IN (3)")
SQL["shuffled_batches"] = f"""
WITH b AS ({_batches(1000, "seizure_state IN (0, 2)")}),
e AS (SELECT batch_id, row_number() OVER (
        ORDER BY CAST('0x' || substr(md5('7:' || batch_id), 1, 13) AS BIGINT), batch_id) - 1
        AS epoch_pos FROM (SELECT DISTINCT batch_id FROM b))
SELECT b.*, e.epoch_pos FROM b JOIN e ON b.batch_id = e.batch_id"""
SQL["transform_hook"] = _batches(32, "seizure_state IN (0, 2) AND data_type IN (3)",
                                 "round(data / 1000, 6)")

# --- maintenance -------------------------------------------------------------------------------

SQL["remove_patient_chunks"] = f"""
WITH {CHUNKS_CTE}
SELECT recording_id, chunk_idx, channel_idx, patient_id FROM chunks
WHERE patient_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7)"""

SQL["cascade_delete"] = f"""
WITH {ANNOTATIONS_CTE},
dn AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 1),
dp AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM dn)),
dr AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM dp))
SELECT 'datasets' AS table_name, count(*) AS n_rows FROM nation
  WHERE n_nationkey NOT IN (SELECT n_nationkey FROM dn)
UNION ALL SELECT 'patients', count(*) FROM customer
  WHERE c_custkey NOT IN (SELECT c_custkey FROM dp)
UNION ALL SELECT 'recordings', count(*) FROM orders
  WHERE o_orderkey NOT IN (SELECT o_orderkey FROM dr)
UNION ALL SELECT 'annotations', count(*) FROM annotations
  WHERE patient_id NOT IN (SELECT c_custkey FROM dp)
UNION ALL SELECT 'chunks', count(*) FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM dr)"""

SQL["upsert_dataset"] = """
WITH e AS (SELECT r_regionkey AS dataset_id, r_name AS name FROM region),
n AS (SELECT DISTINCT n_name AS name FROM nation WHERE n_name NOT IN (SELECT name FROM e))
SELECT dataset_id, name FROM e
UNION ALL
SELECT CAST((SELECT max(dataset_id) FROM e) + row_number() OVER (ORDER BY name) AS INTEGER), name
FROM n"""

SQL["upsert_patient"] = """
SELECT c_custkey AS patient_id, c_nationkey AS dataset_id FROM customer
UNION ALL
SELECT s_suppkey, s_nationkey FROM supplier
WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)
  AND s_nationkey IN (SELECT n_nationkey FROM nation)"""

SQL["append_annotations"] = f"""
WITH {ANNOTATIONS_CTE},
signup AS (SELECT user_id AS patient_id, ts AS onset,
                  ts + to_microseconds(CAST(round(round(value * 60, 6) * 1000000) AS BIGINT))
                    AS "offset"
           FROM events WHERE event_type = 'signup')
SELECT DISTINCT patient_id, onset, "offset" FROM (
  SELECT * FROM annotations UNION ALL SELECT * FROM annotations UNION ALL SELECT * FROM signup)"""

SQL["partition_rewrite"] = f"""
WITH {CHUNKS_CTE}
SELECT chunks.*, c_nationkey AS dataset_id
FROM chunks LEFT JOIN customer ON patient_id = c_custkey"""

# --- raw signals: recordings as plans/recordings.py renders them from events ---------------------

RECORDINGS_CTE = """ev AS (
  SELECT user_id, ts, event_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM events),
seconds AS (
  SELECT user_id AS patient_id, user_id * 100000 + k // 600 AS rec_id, k % 600 AS second, ts,
         [256, 512, 1024][CAST(1 + (user_id + k // 600) % 3 AS INTEGER)] AS fs,
         (CAST(floor(least(greatest(value, 0), 100)) AS BIGINT) + 1) * 200 AS amp
  FROM ev)"""

SAMPLES_CTE = f"""{RECORDINGS_CTE},
samples AS (
  SELECT rec_id, second, c, i, 30000 - amp
         + (amp * (abs((i * 3 * (c + 1) * (4096 // fs) + c * 512) % 4096 - 2048) - 1024)
            + amp * 1024) // 1024 AS v
  FROM (SELECT rec_id, second, fs, amp, c, unnest(range(fs)) AS i
        FROM seconds, (SELECT unnest(range(3)) AS c)))"""

SQL["binary_roundtrip"] = f"""
WITH {SAMPLES_CTE}
SELECT rec_id, CAST(second AS INTEGER) AS second, CAST(c AS INTEGER) AS channel_idx,
       CAST(count(*) AS INTEGER) AS n_samples, CAST(sum(v) AS BIGINT) AS total,
       CAST(sum(v * (i + 1)) AS BIGINT) AS placed_total, CAST(min(v) AS INTEGER) AS lowest,
       CAST(max(v) AS INTEGER) AS highest
FROM samples GROUP BY rec_id, second, c"""

SQL["raw_seconds_cap"] = f"""
WITH {SAMPLES_CTE}
SELECT rec_id, CAST(second AS INTEGER) AS second, CAST(c AS INTEGER) AS channel_idx,
       CAST(sum(v) AS BIGINT) AS total
FROM samples WHERE second BETWEEN 5 AND 19 AND c <> 1 GROUP BY rec_id, second, c"""

SQL["load_seconds_cap"] = f"""
WITH {RECORDINGS_CTE}
SELECT rec_id, CAST(c AS INTEGER) AS channel_idx, least(count(*), 20) AS n_chunks,
       CAST(least(max(second), 19) AS INTEGER) AS last_chunk
FROM seconds, (SELECT unnest(range(3)) AS c) GROUP BY rec_id, c"""

SQL["signal_index"] = f"""
WITH {ANNOTATIONS_CTE}, {RECORDINGS_CTE},
ch AS (SELECT patient_id, rec_id, second, date_trunc('second', min(ts) OVER (PARTITION BY rec_id))
              + to_seconds(second) AS s FROM seconds),
st AS (SELECT *, CASE
    WHEN EXISTS (SELECT 1 FROM annotations a WHERE a.patient_id = ch.patient_id
                 AND a.onset <= ch.s + INTERVAL 1 SECOND AND a."offset" >= ch.s) THEN 1
    WHEN EXISTS (SELECT 1 FROM annotations a WHERE a.patient_id = ch.patient_id
                 AND a.onset - INTERVAL 3600 SECOND <= ch.s + INTERVAL 1 SECOND
                 AND a.onset >= ch.s + INTERVAL 1 SECOND) THEN 2 ELSE 0 END AS state FROM ch)
SELECT CAST(patient_id AS INTEGER) AS patient_id, rec_id, CAST(second AS INTEGER) AS chunk_idx,
       CAST(c AS INTEGER) AS channel_idx, ['GA1', 'T', 'ECG'][c + 1] AS electrode,
       s AS chunk_start_ts, state AS seizure_state,
       CAST([0, 3, 1][c + 1] AS SMALLINT) AS data_type, 256 AS n_values
FROM st, (SELECT CAST(unnest(range(3)) AS INTEGER) AS c)"""

SQL["signal_norm"] = f"""
WITH {RECORDINGS_CTE}
SELECT rec_id, CAST(second AS INTEGER) AS chunk_idx, CAST(3 AS BIGINT) AS n_channels,
       CAST(768 AS BIGINT) AS n_values, CAST(256 AS DOUBLE) AS total_square FROM seconds"""

SQL["bad_recordings"] = f"""
WITH {RECORDINGS_CTE}
SELECT CAST(patient_id AS INTEGER) AS patient_id, rec_id,
       CASE patient_id % 5 WHEN 1 THEN 'sample_freq below 256' WHEN 2 THEN 'missing data file'
            WHEN 3 THEN 'fewer electrode names than channels' WHEN 4 THEN 'unreadable block' END
         AS error,
       CASE WHEN patient_id % 5 = 0 THEN count(*) * 3 ELSE 0 END AS n_chunks
FROM seconds GROUP BY patient_id, rec_id"""

# --- stored metadata, versions, ids, codec, schema ----------------------------------------------

SQL["load_append"] = f"""
WITH {RECORDINGS_CTE},
r AS (SELECT DISTINCT CAST(patient_id AS INTEGER) AS patient_id, rec_id FROM seconds)
SELECT patient_id, rec_id, CASE WHEN patient_id % 2 = 0 THEN 1 ELSE 2 END AS load_no,
       CAST(0 AS INTEGER) AS dataset_id, 'inv' AS dataset_name FROM r"""

SQL["layout_rewrite"] = f"""
WITH {CHUNKS_CTE}
SELECT v AS version, seizure_state, data_type, count(*) AS n_chunks, sum(recording_id) AS id_sum
FROM chunks, (VALUES (CAST(1 AS BIGINT)), (2)) t(v) GROUP BY ALL"""

SQL["dense_ids"] = """
WITH o AS (SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey % 3 = 0 AS first_load FROM lineitem)
SELECT l_orderkey AS recording_id, l_linenumber AS chunk_idx, l_partkey AS channel_idx,
       row_number() OVER (ORDER BY NOT first_load, l_orderkey, l_linenumber, l_partkey) AS id
FROM o"""

SQL["payload_roundtrip"] = """
WITH v AS (SELECT vec_id, CASE
    WHEN vec_id % 50 = 7 THEN list_transform(embedding, lambda x: CAST(0.25 AS FLOAT))
    WHEN vec_id % 61 = 3 THEN list_transform(embedding, lambda x, i:
         CASE WHEN i = 6 THEN CAST('nan' AS FLOAT) ELSE x END)
    WHEN vec_id % 67 = 4 THEN list_transform(embedding, lambda x, i:
         CASE WHEN i = 10 THEN CAST('inf' AS FLOAT) ELSE x END)
    ELSE embedding END AS d FROM embeddings)
SELECT vec_id, CAST(4 * len(d) AS INTEGER) AS n_bytes, d AS back FROM v"""

SQL["std_quartiles"] = """
WITH v AS (SELECT vec_id % 7 AS grp, list_transform(CASE WHEN vec_id % 50 = 7
                    THEN list_transform(embedding, lambda x: CAST(0.25 AS FLOAT))
                    ELSE embedding END, lambda x: CAST(x AS DOUBLE)) AS d FROM embeddings),
m AS (SELECT grp, d, list_reduce(d, lambda a, b: a + b) / len(d) AS mean FROM v),
s AS (SELECT grp, sqrt(list_reduce(list_transform(d, lambda x: (x - mean) * (x - mean)),
                                   lambda a, b: a + b) / len(d)) AS std FROM m)
SELECT grp, p AS prob, round(CASE p WHEN 0.25 THEN quantile_cont(std, 0.25)
       WHEN 0.5 THEN median(std) ELSE quantile_cont(std, 0.75) END, 9) AS value
FROM s, (VALUES (CAST(0.25 AS DOUBLE)), (0.5), (0.75)) t(p) GROUP BY grp, p"""


def _schema_sql(table: str, types: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS name, '{kind}' AS type, true AS nullable, "
        f"CAST(NULL AS VARCHAR) AS \"default\", count(*) AS n_rows, "
        f"count(*) - count({name}) AS n_nulls FROM {table}"
        for i, (name, kind) in enumerate(types.items()))


SQL["schema_report"] = _schema_sql("documents", {
    "doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"})

SQL["time_columns"] = f"""
SELECT * FROM ({_schema_sql("events", {
    "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
    "value": "double", "props": "string"})}) WHERE name IN ('ts')"""

SQL["add_annotations"] = f"""
WITH {ANNOTATIONS_CTE},
top AS (SELECT user_id FROM events WHERE event_type = 'error' GROUP BY user_id
        ORDER BY count(*) DESC, user_id LIMIT 1)
SELECT DISTINCT CAST(patient_id AS INTEGER) AS patient_id, onset, "offset"
FROM annotations WHERE patient_id IN (SELECT user_id FROM top)"""

# --- long recordings, listings, domains ---------------------------------------------------------

_GROUPED = """r AS (SELECT o_orderkey AS recording_id, o_custkey AS patient_id,
      CASE WHEN o_orderkey % 29 <> 0 THEN o_custkey * 10 + o_orderkey % 3 END AS rec_id,
      TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey * 7919 % 2592000) AS start_ts,
      CAST(round(o_totalprice) AS BIGINT) AS duration_in_sec
    FROM orders)"""

SQL["session_timeline"] = f"""
WITH {_GROUPED}
SELECT recording_id, patient_id, rec_id, start_ts, duration_in_sec,
       row_number() OVER w - 1 AS seq_no,
       CAST(coalesce(sum(duration_in_sec) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
                                                 AND 1 PRECEDING), 0) AS BIGINT) AS elapsed_sec,
       CAST(epoch(start_ts) - epoch(lag(start_ts) OVER w)
            - lag(duration_in_sec) OVER w AS BIGINT) AS gap_sec
FROM r WINDOW w AS (PARTITION BY patient_id, rec_id ORDER BY start_ts, recording_id)"""

SQL["recording_sessions"] = f"""
WITH {_GROUPED},
e AS (SELECT *, CAST(epoch(start_ts) AS BIGINT) AS b,
             CAST(epoch(start_ts) AS BIGINT) + duration_in_sec AS f FROM r),
m AS (SELECT *, max(f) OVER (PARTITION BY patient_id, rec_id ORDER BY start_ts, recording_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e)
SELECT patient_id, rec_id, min(start_ts) AS session_start,
       max(start_ts + to_seconds(duration_in_sec)) AS session_end, count(*) AS n_recordings,
       CAST(sum(duration_in_sec) AS BIGINT) AS recorded_sec,
       CAST(coalesce(sum(b - reach) FILTER (WHERE b > reach), 0) AS BIGINT) AS gap_sec,
       CAST(coalesce(sum(least(f, reach) - b) FILTER (WHERE reach > b), 0) AS BIGINT)
         AS overlap_sec
FROM m GROUP BY patient_id, rec_id"""

SQL["placed_annotations"] = f"""
WITH {_GROUPED}, {ANNOTATIONS_CTE},
e AS (SELECT *, start_ts + to_seconds(duration_in_sec) AS end_ts,
             min(start_ts) OVER (PARTITION BY patient_id, rec_id,
                 CASE WHEN rec_id IS NULL THEN recording_id END) AS first_ts FROM r),
a AS (SELECT row_number() OVER () AS n, * FROM annotations),
j AS (SELECT a.*, e.recording_id, e.rec_id, e.start_ts, e.end_ts, e.first_ts,
             row_number() OVER (PARTITION BY n ORDER BY start_ts DESC, recording_id DESC) AS late,
             row_number() OVER (PARTITION BY n ORDER BY end_ts DESC, recording_id DESC) AS far
      FROM a JOIN e ON a.patient_id = e.patient_id AND e.start_ts <= a.onset),
hit AS (SELECT n, recording_id, rec_id, start_ts, first_ts FROM j
        WHERE end_ts > onset AND (late = 1 OR far = 1)
        QUALIFY row_number() OVER (PARTITION BY n ORDER BY late) = 1),
far AS (SELECT n, end_ts FROM j WHERE far = 1)
SELECT a.patient_id, a.onset, a."offset", hit.recording_id, hit.rec_id,
       CAST(floor(epoch(a.onset)) - epoch(hit.start_ts) AS BIGINT) AS recording_offset_sec,
       CAST(floor(epoch(a.onset)) - epoch(hit.first_ts) AS BIGINT) AS session_offset_sec,
       CASE WHEN hit.n IS NULL THEN CAST(floor(epoch(a.onset)) - epoch(far.end_ts) AS BIGINT)
       END AS since_end_sec
FROM a LEFT JOIN hit ON a.n = hit.n LEFT JOIN far ON a.n = far.n"""

SQL["listing_links"] = """
SELECT event_id AS page_id, 2 AS link_pos, 'FR_' || user_id AS anchor FROM events"""

SQL["listing_annotations"] = f"""
SELECT * FROM ({SQL["parse_annotations"]})
WHERE (onset_sample // 256) % 19 <> 8"""

SQL["package_datasets"] = """
SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'inv' WHEN 1 THEN 'surf' ELSE 'other' END
         AS package_dataset,
       CASE s_suppkey % 4 WHEN 0 THEN 'inv' WHEN 1 THEN 'surf' END AS dir_dataset,
       CAST(s_suppkey AS INTEGER) AS patient_id
FROM supplier"""

SQL["state_sample_200"] = f"""
WITH {CHUNKS_CTE}, top AS (SELECT seizure_state FROM chunks GROUP BY seizure_state
                           ORDER BY count(*) DESC, seizure_state LIMIT 1)
SELECT recording_id, chunk_idx, channel_idx, data, seizure_state, data_type
FROM chunks WHERE seizure_state IN (SELECT seizure_state FROM top)
ORDER BY {TRAINING_ORDER} LIMIT 200"""

SQL["patient_select"] = f"""
WITH {CHUNKS_CTE}, {_TOP1}
SELECT recording_id, chunk_idx, channel_idx, data, seizure_state, data_type, patient_id
FROM chunks WHERE patient_id IN (SELECT patient_id FROM top) AND seizure_state IN (0, 2)
  AND data_type = 3"""

SQL["state_rejects"] = """
SELECT l_orderkey AS recording_id, l_linenumber AS chunk_idx, l_partkey AS channel_idx,
       'bad seizure_state ' || coalesce(CAST(CASE WHEN l_linenumber < 7 THEN l_linenumber END
                                             AS VARCHAR), 'NULL') AS reasons
FROM lineitem WHERE l_linenumber NOT IN (1, 2)"""

SQL["load_replace"] = f"""
SELECT rec_id, CASE WHEN patient_id % 2 = 0 THEN seizure_state ELSE 0 END AS seizure_state,
       count(*) AS n_chunks
FROM ({SQL["signal_index"]}) GROUP BY ALL"""
