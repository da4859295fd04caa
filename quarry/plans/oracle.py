"""SQL twins of the catalog, written for DuckDB over the driver tables
(views ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations``).

They are written independently of the Spark code, from the semantics
stated in each operator's docstring."""

from __future__ import annotations

from quarry.operators.features import ENGLISH_STOP_WORDS, SKILL_KEYWORDS

TS = "'%Y-%m-%d %H:%M:%S.%f'"

SQL: dict[str, str] = {}

# ---------------------------------------------------------------- streaks
_EVENT_LOG = """
ev AS (SELECT user_id, ts, event_id,
              CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_hit FROM events),
cum AS (SELECT user_id, ts, event_id, is_hit,
               SUM(1 - is_hit) OVER (PARTITION BY user_id ORDER BY ts
                   RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS miss_cum
        FROM ev),
runs AS (SELECT user_id, CAST(miss_cum AS BIGINT) AS run_id,
                CAST(user_id AS VARCHAR) || '_' || CAST(CAST(miss_cum AS BIGINT) AS VARCHAR) AS grp,
                COUNT(*) AS streak_len, MIN(ts) AS start_t, MAX(ts) AS end_t
         FROM cum WHERE is_hit = 1 GROUP BY user_id, miss_cum)
"""

_RUN_COLS = f"""user_id, grp, run_id, CAST(streak_len AS BIGINT) AS streak_len,
       strftime(start_t, {TS}) AS start_t, strftime(end_t, {TS}) AS end_t"""

SQL["streak_runs"] = f"WITH {_EVENT_LOG} SELECT {_RUN_COLS} FROM runs"

SQL["streak_longest_per_key"] = f"""WITH {_EVENT_LOG},
best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
             ORDER BY streak_len DESC, start_t, run_id) AS rn FROM runs)
SELECT {_RUN_COLS} FROM best WHERE rn = 1"""

SQL["streak_incremental"] = SQL["streak_merged_summaries"] = SQL["csv_folder_streaks"] = SQL["streak_longest_per_key"]

SQL["streak_topn"] = f"""WITH {_EVENT_LOG},
top AS (SELECT *, ROW_NUMBER() OVER (ORDER BY streak_len DESC, user_id, start_t, run_id) AS pos
        FROM runs)
SELECT {_RUN_COLS}, CAST(pos AS BIGINT) AS pos FROM top WHERE pos <= 10"""

SQL["running_miss_count"] = f"""WITH {_EVENT_LOG}
SELECT user_id, event_id, strftime(ts, {TS}) AS ts, CAST(is_hit AS BIGINT) AS is_hit,
       CAST(miss_cum AS BIGINT) AS miss_cum FROM cum"""

# ---------------------------------------------------------------- quality
_DIRTY = """
li AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
              (l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 100 AS dirt FROM lineitem),
dirty AS (
  SELECT CASE WHEN dirt BETWEEN 8 AND 9 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS Order_id,
         n_name AS city, r_name AS country,
         CASE WHEN dirt < 5 THEN NULL ELSE s_name END AS facility_name,
         CAST(CASE WHEN (l_suppkey * 13 + l_orderkey) % 20 = 0 THEN -999.999::DOUBLE
                   ELSE s_suppkey * 0.01::DOUBLE END AS VARCHAR) AS lat,
         CAST(CASE WHEN (l_partkey * 11 + l_orderkey) % 20 = 0 THEN -999.999::DOUBLE
                   ELSE s_suppkey * 0.02::DOUBLE END AS VARCHAR) AS lng,
         CASE WHEN dirt BETWEEN 5 AND 7 THEN NULL ELSE p_type END AS menu_item,
         CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS price,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS datetime
  FROM li JOIN supplier ON l_suppkey = s_suppkey
          JOIN nation ON s_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey
          JOIN part ON l_partkey = p_partkey),
typed AS (
  SELECT TRY_CAST(Order_id AS BIGINT) AS Order_id, city, country, facility_name,
         TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lng AS DOUBLE) AS lng, menu_item,
         TRY_CAST(price AS INTEGER) AS price,
         try_strptime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime,
         CAST(try_strptime(datetime, '%Y-%m-%d %H:%M:%S') AS DATE) AS date
  FROM dirty),
tagged AS (
  SELECT *, concat_ws(';',
      CASE WHEN lat = -999.999 THEN 'lat_sentinel' WHEN lat IS NULL THEN 'lat_sentinel:unknown' END,
      CASE WHEN lng = -999.999 THEN 'lng_sentinel' WHEN lng IS NULL THEN 'lng_sentinel:unknown' END,
      CASE WHEN facility_name IS NULL THEN 'facility_missing' END,
      CASE WHEN menu_item IS NULL THEN 'item_missing' END,
      CASE WHEN Order_id IS NULL THEN 'id_missing' END,
      CASE WHEN datetime IS NULL THEN 'datetime_invalid' END) AS reject_reason
  FROM typed)
"""

_ORDER_COLS = f"""Order_id, city, country, facility_name, lat, lng, menu_item,
       CAST(price AS BIGINT) AS price, strftime(datetime, {TS}) AS datetime,
       strftime(date, '%Y-%m-%d') AS date"""

SQL["typed_parse"] = f"WITH {_DIRTY} SELECT {_ORDER_COLS} FROM typed"
SQL["clean_good"] = f"WITH {_DIRTY} SELECT {_ORDER_COLS} FROM tagged WHERE reject_reason = ''"
SQL["clean_bad"] = f"WITH {_DIRTY} SELECT {_ORDER_COLS}, reject_reason FROM tagged WHERE reject_reason <> ''"
SQL["clean_reason_counts"] = f"""WITH {_DIRTY},
r AS (SELECT unnest(string_split(reject_reason, ';')) AS reason FROM tagged WHERE reject_reason <> '')
SELECT reason, COUNT(*) AS n FROM r GROUP BY reason"""
SQL["null_profile"] = f"""WITH {_DIRTY}
SELECT column_name, null_count FROM (
  SELECT 'Order_id' AS column_name, COUNT(*) - COUNT(Order_id) AS null_count FROM typed UNION ALL
  SELECT 'city', COUNT(*) - COUNT(city) FROM typed UNION ALL
  SELECT 'country', COUNT(*) - COUNT(country) FROM typed UNION ALL
  SELECT 'facility_name', COUNT(*) - COUNT(facility_name) FROM typed UNION ALL
  SELECT 'lat', COUNT(*) - COUNT(lat) FROM typed UNION ALL
  SELECT 'lng', COUNT(*) - COUNT(lng) FROM typed UNION ALL
  SELECT 'menu_item', COUNT(*) - COUNT(menu_item) FROM typed UNION ALL
  SELECT 'price', COUNT(*) - COUNT(price) FROM typed UNION ALL
  SELECT 'datetime', COUNT(*) - COUNT(datetime) FROM typed UNION ALL
  SELECT 'date', COUNT(*) - COUNT(date) FROM typed)"""
SQL["dropna_rows"] = f"""WITH {_DIRTY} SELECT {_ORDER_COLS} FROM typed
WHERE Order_id IS NOT NULL AND city IS NOT NULL AND country IS NOT NULL AND facility_name IS NOT NULL
  AND lat IS NOT NULL AND lng IS NOT NULL AND menu_item IS NOT NULL AND price IS NOT NULL
  AND datetime IS NOT NULL AND date IS NOT NULL"""

_JOBS = """
jobs AS (SELECT d.doc_id,
                d.text || CASE WHEN d.doc_id % 3 = 0 THEN ' ' || __SKILLS__[CAST(d.doc_id % 18 AS INTEGER) + 1] ELSE '' END AS title,
                CASE WHEN d.lang = 'de' THEN 'NULL' WHEN d.lang = 'es' THEN '' ELSE upper(d.lang) END AS country,
                d.source AS payment_type,
                CASE l.quality WHEN 1 THEN 'True' WHEN 0 THEN 'False' END AS is_hourly,
                CAST(d.n_chars AS DOUBLE) AS budget_clean,
                length(d.text) / 100.0 AS hourly_rate
         FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
""".replace("__SKILLS__", "[" + ", ".join(f"'{k}'" for k in SKILL_KEYWORDS) + "]")
SQL["missing_country_filter"] = f"""WITH {_JOBS}
SELECT doc_id, country FROM jobs WHERE country IS NOT NULL AND country NOT IN ('NULL', '')"""

# ---------------------------------------------------------------- modelling
_GOOD = _DIRTY + """,
good AS (SELECT * EXCLUDE (reject_reason) FROM tagged WHERE reject_reason = '')
"""

SQL["nf_cities"] = f"WITH {_GOOD} SELECT DISTINCT city, country FROM good"
SQL["nf_facilities"] = f"WITH {_GOOD} SELECT DISTINCT facility_name, city, lat, lng FROM good"
SQL["nf_menu_items"] = f"WITH {_GOOD} SELECT DISTINCT menu_item, CAST(price AS BIGINT) AS price FROM good"
SQL["nf_orders"] = f"""WITH {_GOOD} SELECT DISTINCT Order_id AS order_id, strftime(datetime, {TS}) AS datetime,
       facility_name, city FROM good"""
SQL["nf_order_items"] = f"""WITH {_GOOD}
SELECT CAST(ROW_NUMBER() OVER (ORDER BY Order_id NULLS FIRST, menu_item NULLS FIRST) AS BIGINT) AS order_item_id,
       Order_id AS order_id, menu_item FROM good"""

_STAR = _GOOD + """,
dim_city AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY city NULLS FIRST, country NULLS FIRST) AS BIGINT) AS city_key,
                    city, country FROM (SELECT DISTINCT city, country FROM good)),
fac AS (SELECT facility_name, city, country, lat, lng FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY facility_name, city, country ORDER BY lat, lng) AS rn FROM good) WHERE rn = 1),
dim_facility AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY f.facility_name NULLS FIRST, c.city_key NULLS FIRST) AS BIGINT) AS facility_key,
         f.facility_name, c.city_key, f.lat, f.lng
  FROM fac f JOIN dim_city c ON f.city IS NOT DISTINCT FROM c.city AND f.country IS NOT DISTINCT FROM c.country),
dim_menu AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY menu_item NULLS FIRST) AS BIGINT) AS menu_key, menu_item
             FROM (SELECT DISTINCT menu_item FROM good))
"""
SQL["star_dim_date"] = f"""WITH {_GOOD}
SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS BIGINT) AS date_key,
       strftime(date, '%Y-%m-%d') AS date, CAST(year(date) AS BIGINT) AS year,
       CAST(month(date) AS BIGINT) AS month, CAST(day(date) AS BIGINT) AS day
FROM (SELECT DISTINCT CAST(datetime AS DATE) AS date FROM good WHERE datetime IS NOT NULL)"""
SQL["star_dim_city"] = f"WITH {_STAR} SELECT city_key, city, country FROM dim_city"
SQL["star_dim_facility"] = f"WITH {_STAR} SELECT facility_key, facility_name, city_key, lat, lng FROM dim_facility"
SQL["star_dim_menu"] = f"WITH {_STAR} SELECT menu_key, menu_item FROM dim_menu"
SQL["star_fact"] = f"""WITH {_STAR}
SELECT g.Order_id AS order_id, strftime(g.datetime, {TS}) AS datetime,
       CAST(year(g.datetime) * 10000 + month(g.datetime) * 100 + day(g.datetime) AS BIGINT) AS date_key,
       c.city_key, f.facility_key, m.menu_key, CAST(g.price AS BIGINT) AS price
FROM good g
JOIN dim_city c ON g.city = c.city AND g.country = c.country
JOIN dim_facility f ON g.facility_name = f.facility_name AND c.city_key = f.city_key
JOIN dim_menu m ON g.menu_item = m.menu_item"""
SQL["durable_facility_keys"] = f"""WITH {_GOOD},
m AS (SELECT facility_name, city, country, COUNT(*) AS n_lines,
             MIN(CASE WHEN Order_id % 3 < 2 AND Order_id % 50 < 2 THEN Order_id % 3 ELSE 2 END) AS load,
             MAX(CASE WHEN Order_id % 3 = 2 OR Order_id % 50 < 2 THEN 1 ELSE 0 END) AS member
      FROM good WHERE facility_name IS NOT NULL AND city IS NOT NULL AND country IS NOT NULL GROUP BY ALL)
SELECT ROW_NUMBER() OVER (ORDER BY load, facility_name, city, country) AS facility_key, facility_name, city, country, n_lines
FROM m WHERE member = 1"""
SQL["order_documents"] = f"""WITH {_GOOD}
SELECT Order_id AS _id, city, country, facility_name, lat, lng,
       strftime(MIN(datetime), {TS}) AS datetime, CAST(SUM(price) AS BIGINT) AS order_total,
       string_agg(concat_ws(':', menu_item, CAST(price AS VARCHAR)), '|'
                  ORDER BY concat_ws(':', menu_item, CAST(price AS VARCHAR))) AS items
FROM good GROUP BY Order_id, city, country, facility_name, lat, lng"""

# ---------------------------------------------------------------- detections
_DET = """
vids AS (SELECT 'video_' || CAST(user_id AS VARCHAR) || '.MP4' AS video_file,
                CASE user_id % 4 WHEN 0 THEN 24.0 WHEN 1 THEN 25.0 WHEN 2 THEN 30.0 ELSE 0.0 END::DOUBLE AS fps0,
                CAST(MAX(date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts)) + 1 AS BIGINT) AS total_frames,
                640 AS width, 480 AS height
         FROM events GROUP BY user_id),
vfps AS (SELECT *, CASE WHEN fps0 = 0 THEN 30.0::DOUBLE ELSE fps0 END AS fps FROM vids),
vstep AS (SELECT *, CAST(greatest(1, round_even(fps * 0.5, 0)) AS BIGINT) AS step FROM vfps),
plan AS (SELECT video_file, fps, step, width, height,
                unnest(generate_series(0, total_frames - 1, step)) AS frame_idx
         FROM vstep WHERE total_frames > 0),
det AS (SELECT 'video_' || CAST(user_id AS VARCHAR) || '.MP4' AS video_file,
               CAST(date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts) AS BIGINT) AS frame_idx,
               event_id AS det_idx,
               CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 0 ELSE 9 END AS cls,
               value / 500.0 AS conf,
               CAST(event_id % 600 AS DOUBLE) AS x1, CAST(event_id % 400 AS DOUBLE) AS y1,
               CAST(event_id % 600 AS DOUBLE) + 32 AS x2, CAST(event_id % 400 AS DOUBLE) + 32 AS y2
        FROM events),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY video_file, frame_idx ORDER BY conf DESC, det_idx) AS rn
           FROM det WHERE conf > 0.25 AND cls IN (0, 1)),
best AS (SELECT video_file, frame_idx, det_idx, cls, conf, (x1 + x2) / 2.0 AS cx, (y1 + y2) / 2.0 AS cy
         FROM ranked WHERE rn = 1)
"""


def _be(x: str, n: int) -> str:
    return f"CAST(printf('%.{n}f', {x}) AS DOUBLE)"


SQL["frame_sample_plan"] = f"""WITH {_DET}
SELECT video_file, CAST(frame_idx AS BIGINT) AS frame_idx, round(frame_idx / fps, 6) AS t_sec, step FROM plan"""
SQL["best_detection"] = f"""WITH {_DET}
SELECT video_file, frame_idx, det_idx, CAST(cls AS BIGINT) AS cls, round(conf, 6) AS conf,
       round(cx, 6) AS cx, round(cy, 6) AS cy FROM best"""
SQL["detection_log"] = f"""WITH {_DET}
SELECT p.video_file, CAST(p.frame_idx AS BIGINT) AS frame_idx, {_be('p.frame_idx / p.fps', 2)} AS t_sec,
       'unknown' AS target_type,
       CASE WHEN b.cls IS NULL THEN -1.0 ELSE {_be('b.cx / p.width', 4)} END AS x_rel,
       CASE WHEN b.cls IS NULL THEN -1.0 ELSE {_be('b.cy / p.height', 4)} END AS y_rel,
       CASE b.cls WHEN 0 THEN 'whole' WHEN 1 THEN 'broken' ELSE 'unknown' END AS state,
       CASE WHEN b.cls IS NULL THEN 0.0 ELSE {_be('b.conf', 3)} END AS conf
FROM plan p LEFT JOIN best b ON p.video_file = b.video_file AND p.frame_idx = b.frame_idx"""


SQL["bbox_labels"] = f"""WITH {_DET},
clk AS (SELECT video_file, frame_idx, 640 AS width, 480 AS height, CAST(x1 AS BIGINT) + 16 AS cx,
               CAST(y1 AS BIGINT) + 16 + 60 AS cy, 1 AS cls FROM det WHERE cls = 1),
box AS (SELECT video_file, frame_idx, cls, width, height,
               greatest(0, cx - 16) AS x1, greatest(0, cy - 16) AS y1,
               least(width - 1, cx + 16) AS x2, least(height - 1, cy + 16) AS y2 FROM clk),
s AS (SELECT *, (x1 + x2) / 2.0 / width AS cxn, (y1 + y2) / 2.0 / height AS cyn,
             (x2 - x1) / CAST(width AS DOUBLE) AS wn, (y2 - y1) / CAST(height AS DOUBLE) AS hn FROM box)
SELECT regexp_extract(video_file, '^(.+?)(\\.[^.]*)?$', 1) || '_f' || lpad(CAST(frame_idx AS VARCHAR), 6, '0') AS name,
       CAST(cls AS VARCHAR) || ' ' || printf('%.6f', cxn) || ' ' || printf('%.6f', cyn) || ' '
         || printf('%.6f', wn) || ' ' || printf('%.6f', hn) AS label_line,
       CAST(printf('%.6f', cxn) AS DOUBLE) AS cx_n, CAST(printf('%.6f', cyn) AS DOUBLE) AS cy_n,
       CAST(printf('%.6f', wn) AS DOUBLE) AS w_n, CAST(printf('%.6f', hn) AS DOUBLE) AS h_n
FROM s"""

# ---------------------------------------------------------------- messages
_USERS = """
ue AS (SELECT CAST(e.user_id AS VARCHAR) AS id, c.c_name AS name,
              lower(replace(c.c_name, '#', '')) || '@example.com' AS email,
              n.n_name AS country, strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS created_at,
              e.event_id AS seq
       FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""
SQL["keyed_messages"] = f"""WITH {_USERS}
SELECT country AS key, to_json({{'id': id, 'name': name, 'email': email, 'country': country,
       'created_at': created_at}})::VARCHAR AS value FROM ue"""
SQL["decode_messages"] = f"WITH {_USERS} SELECT country AS msg_key, id, name, email, country, created_at FROM ue"
SQL["latest_by_key"] = f"""WITH {_USERS},
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY country, id ORDER BY created_at DESC, seq DESC) AS rn FROM ue)
SELECT country, id, name, email, created_at, seq FROM r WHERE rn = 1"""
SQL["minute_batches"] = f"""WITH {_USERS},
t AS (SELECT CAST(created_at AS TIMESTAMP) AS ts FROM ue),
g AS (SELECT time_bucket(INTERVAL '1 minute', ts) AS s, COUNT(*) AS n, MIN(ts) AS f, MAX(ts) AS l FROM t GROUP BY 1)
SELECT strftime(s, {TS}) AS batch_start, strftime(s + INTERVAL '1 minute', {TS}) AS batch_end,
       'users_' || strftime(s + INTERVAL '1 minute', '%Y%m%d_%H%M%S') || '.jsonl' AS file_name,
       n AS n_records, strftime(f, {TS}) AS first_ts, strftime(l, {TS}) AS last_ts FROM g"""
SQL["unique_append"] = SQL["unique_append_indexed"] = """WITH
inc AS (SELECT c.c_custkey AS seq, c.c_name AS name,
               'customer' || lpad(CAST(c.c_custkey // 2 AS VARCHAR), 9, '0')
                 || CASE WHEN c.c_acctbal < 0 THEN '.example.com' ELSE '@example.com' END AS email,
               n.n_name AS country
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
ex AS (SELECT DISTINCT lower(replace(c_name, '#', '')) || '@example.com' AS email FROM customer WHERE c_acctbal > 0),
chk AS (SELECT *, concat_ws(';', CASE WHEN name IS NULL THEN 'name_missing' END,
                               CASE WHEN email IS NULL THEN 'email_missing' END,
                               CASE WHEN country IS NULL THEN 'country_missing' END,
                               CASE WHEN NOT regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')
                                    THEN 'email_format' END) AS vr FROM inc),
valid AS (SELECT *, MIN(seq) OVER (PARTITION BY email) AS first_seq FROM chk WHERE vr = '')
SELECT seq, name, email, country,
       CASE WHEN email IN (SELECT email FROM ex) OR seq <> first_seq THEN 'rejected' ELSE 'accepted' END AS status,
       CASE WHEN email IN (SELECT email FROM ex) THEN 'email_exists'
            WHEN seq <> first_seq THEN 'duplicate_in_batch' END AS reason
FROM valid
UNION ALL
SELECT seq, name, email, country, 'rejected', vr FROM chk WHERE vr <> ''"""
SQL["user_lookup"] = """WITH
ex AS (SELECT CAST(c.c_custkey AS VARCHAR) AS id, c.c_name AS name,
              lower(replace(c.c_name, '#', '')) || '@example.com' AS email, n.n_name AS country
       FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_acctbal > 0)
SELECT e.event_id AS request_id, CAST(e.user_id AS VARCHAR) AS user_id, ex.name, ex.email, ex.country,
       CASE WHEN ex.id IS NULL THEN 404 ELSE 200 END AS status
FROM events e LEFT JOIN ex ON CAST(e.user_id AS VARCHAR) = ex.id WHERE e.event_type = 'signup'"""

# ------------------------------------------------------- categories / sorting
_CARS = """
cars AS (SELECT l.l_orderkey * 8 + l.l_linenumber AS row_id, l.l_extendedprice AS Price,
                l.l_quantity AS Mileage, year(l.l_shipdate) AS Year, p.p_type AS body_type,
                l.l_linestatus AS fuel_type, l.l_returnflag AS condition
         FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
"""
SQL["category_counts"] = f"""WITH {_CARS}
SELECT body_type, fuel_type, COUNT(*) AS count FROM cars GROUP BY body_type, fuel_type"""
SQL["topk_category_filter"] = f"""WITH {_CARS},
top AS (SELECT body_type FROM cars GROUP BY body_type ORDER BY COUNT(*) DESC, body_type NULLS FIRST LIMIT 5)
SELECT row_id, body_type, round(Price, 6) AS price FROM cars WHERE body_type IN (SELECT body_type FROM top)"""
SQL["heavy_hitters"] = """SELECT l_partkey, COUNT(*) AS count FROM lineitem
GROUP BY l_partkey ORDER BY count DESC, l_partkey NULLS FIRST LIMIT 20"""
SQL["typed_csv"] = f"""WITH {_CARS}
SELECT row_id, round(Price, 6) AS price, round(Mileage, 6) AS mileage, CAST(Year AS BIGINT) AS year, body_type,
       'double,int,string' AS kinds FROM cars"""
SQL["sorted_groups"] = f"""WITH {_CARS},
g AS (SELECT condition, AVG(Price) AS avg_price, COUNT(*) AS count FROM cars GROUP BY condition)
SELECT condition, round(avg_price, 6) AS avg_price, count,
       CAST(ROW_NUMBER() OVER (ORDER BY avg_price DESC, condition) AS BIGINT) AS pos FROM g"""

# ---------------------------------------------------------------- ML features
_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"

SQL["string_index"] = f"""WITH {_CARS}
SELECT body_type, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, body_type) - 1 AS BIGINT) AS label
FROM cars GROUP BY body_type"""
SQL["standardize"] = f"""WITH {_CARS},
s AS (SELECT AVG(Price) mp, STDDEV_SAMP(Price) sp, AVG(Mileage) mm, STDDEV_SAMP(Mileage) sm,
             AVG(CAST(Year AS DOUBLE)) my, STDDEV_SAMP(CAST(Year AS DOUBLE)) sy FROM cars)
SELECT row_id, round((Price - mp) / sp, 6) AS z_price, round((Mileage - mm) / sm, 6) AS z_mileage,
       round((CAST(Year AS DOUBLE) - my) / sy, 6) AS z_year FROM cars, s"""
SQL["assembled_features"] = "SELECT vec_id AS row_id, " + ", ".join(
    f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS f{i}" for i in range(64)) + " FROM embeddings"
_CLEAN = _JOBS + """,
cj AS (SELECT *, lower(regexp_replace(title, '[^a-zA-Z\\s]', '', 'g')) AS clean_title FROM jobs)
"""
SQL["clean_title"] = f"WITH {_CLEAN} SELECT doc_id, clean_title FROM cj"
_FLAGS = ", ".join(f"CASE WHEN contains(clean_title, '{k}') THEN 1 ELSE 0 END AS has_{k}" for k in SKILL_KEYWORDS)
SQL["keyword_flags"] = f"WITH {_CLEAN} SELECT doc_id, {_FLAGS} FROM cj"
_TOK = _JOBS + f""",
tk AS (SELECT doc_id, string_split_regex(regexp_replace(lower(title), '\\s+$', ''), '\\s') AS words FROM jobs),
fw AS (SELECT doc_id, words, list_filter(words, lambda x: NOT list_contains({_STOP}, x)) AS kept FROM tk)
"""
SQL["tokens"] = f"""WITH {_TOK}
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_tokens, CAST(len(list_distinct(words)) AS BIGINT) AS n_distinct,
       array_to_string(words, '|') AS words FROM tk"""
SQL["stopword_filter"] = f"""WITH {_TOK}
SELECT doc_id, CAST(len(kept) AS BIGINT) AS n_kept, CAST(len(list_distinct(kept)) AS BIGINT) AS n_kept_distinct,
       array_to_string(kept, '|') AS kept FROM fw"""
SQL["hashed_tf"] = f"WITH {_TOK} SELECT doc_id, CAST(len(kept) AS BIGINT) AS total_tf FROM fw"
SQL["tfidf_terms"] = f"""WITH {_TOK},
terms AS (SELECT doc_id, unnest(kept) AS term FROM fw),
tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM terms GROUP BY doc_id, term),
df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term),
n AS (SELECT COUNT(DISTINCT doc_id) AS n FROM jobs)
SELECT tf.doc_id, tf.term, tf.tf, df.df, round(ln((n.n + 1) / (df.df + 1)), 6) AS idf,
       round(tf.tf * ln((n.n + 1) / (df.df + 1)), 6) AS tfidf
FROM tf JOIN df ON tf.term = df.term, n"""
SQL["hash_split"] = f"""WITH {_CARS}
SELECT row_id, CASE WHEN ((CAST(row_id AS HUGEINT) % 4294967296) * 2654435761) % 4294967296 % 100 < 70
                    THEN 'train' ELSE 'test' END AS side FROM cars"""
_BIKE = """
bike AS (SELECT p_partkey AS row_id, 20.0::DOUBLE + p_size * 0.01::DOUBLE AS latitude,
                -103.0::DOUBLE - (p_partkey % 50) * 0.01::DOUBLE AS longitude,
                p_type AS status, p_brand AS location FROM part)
"""
SQL["center_distance"] = f"""WITH {_BIKE}
SELECT row_id, round(sqrt(pow(latitude - 20.666378, 2) + pow(longitude - -103.34882, 2)), 6) AS distance_from_center
FROM bike"""

# ---------------------------------------------------------------- evaluators
_RULE = """
ir AS (SELECT vec_id AS row_id, CAST(label AS DOUBLE) AS label,
              CAST(least(9, greatest(0, floor((CAST(embedding[1] AS DOUBLE) + 0.4) * 12.5))) AS DOUBLE) AS prediction,
              embedding FROM embeddings)
"""
SQL["eval_confusion"] = f"""WITH {_RULE}
SELECT CAST(label AS BIGINT) AS label, CAST(prediction AS BIGINT) AS prediction, COUNT(*) AS count
FROM ir GROUP BY label, prediction"""
SQL["eval_accuracy_f1"] = f"""WITH {_RULE},
k AS (SELECT k FROM (SELECT label AS k FROM ir UNION SELECT prediction FROM ir)),
st AS (SELECT k.k, (SELECT COUNT(*) FROM ir WHERE label = k.k) AS n,
              (SELECT COUNT(*) FROM ir WHERE prediction = k.k) AS pp,
              (SELECT COUNT(*) FROM ir WHERE label = k.k AND prediction = k.k) AS tp FROM k)
SELECT round(SUM(tp) / SUM(n), 6) AS accuracy,
       round(SUM(n * CASE WHEN tp = 0 THEN 0.0 ELSE 2.0 * tp / (pp + n) END) / SUM(n), 6) AS f1 FROM st"""
_SCORED = _JOBS + """,
sj AS (SELECT doc_id, CASE WHEN is_hourly = 'True' THEN 1 ELSE 0 END AS label,
              floor(budget_clean / 100) / 100.0 AS score FROM jobs WHERE is_hourly IS NOT NULL),
sc AS (SELECT score AS s, SUM(label) AS pos, SUM(1 - label) AS neg FROM sj GROUP BY score)
"""
SQL["eval_auc"] = f"""WITH {_SCORED},
c AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM sc)
SELECT round(SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)), 6) AS auc FROM c"""
SQL["eval_pr"] = f"""WITH {_SCORED},
c AS (SELECT *, SUM(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             SUM(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM sc),
p AS (SELECT pos, tp, tp - pos AS tp0, tp / (tp + fp) AS pc,
             CASE WHEN (tp - pos) + (fp - neg) = 0 THEN tp / (tp + fp)
                  ELSE (tp - pos) / ((tp - pos) + (fp - neg)) END AS pp FROM c)
SELECT round(SUM((tp - tp0) * (pc + pp) / 2.0) / SUM(pos), 6) AS aupr FROM p"""
SQL["eval_silhouette"] = f"""WITH {_RULE},
pt AS (SELECT row_id, label AS c, i, CAST(embedding[i] AS DOUBLE) AS x
       FROM ir, (SELECT unnest(range(1, 65)) AS i) AS r),
nn AS (SELECT row_id, c, SUM(x * x) AS nn FROM pt GROUP BY row_id, c),
cl AS (SELECT c, COUNT(*) AS n, SUM(nn) AS psi FROM nn GROUP BY c),
cy AS (SELECT c, i, SUM(x) AS y FROM pt GROUP BY c, i),
dot AS (SELECT p.row_id, cy.c AS other, SUM(p.x * cy.y) AS xy FROM pt p JOIN cy ON p.i = cy.i GROUP BY p.row_id, cy.c),
d AS (SELECT nn.row_id, nn.c AS own, cl.c AS other, cl.n, cl.n * nn.nn - 2 * dot.xy + cl.psi AS tot
      FROM nn JOIN dot ON nn.row_id = dot.row_id JOIN cl ON cl.c = dot.other),
ab AS (SELECT row_id, MAX(CASE WHEN own = other THEN tot / greatest(n - 1, 1) END) AS a,
              MAX(CASE WHEN own = other THEN n END) AS own_n,
              MIN(CASE WHEN own <> other THEN tot / n END) AS b
       FROM d GROUP BY row_id)
SELECT round(AVG(CASE WHEN own_n = 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END), 6)
       AS silhouette FROM ab"""
SQL["eval_regression"] = f"""WITH {_CARS},
c AS (SELECT regr_slope(Price, Mileage) AS b, regr_intercept(Price, Mileage) AS a FROM cars),
p AS (SELECT Price AS y, a + b * Mileage AS yhat FROM cars, c)
SELECT round(sqrt(AVG((y - yhat) * (y - yhat))), 4) AS rmse,
       round(1 - SUM((y - yhat) * (y - yhat)) / (VAR_POP(y) * COUNT(*)), 6) AS r2,
       round(AVG(abs(y - yhat)), 4) AS mae FROM p"""
SQL["group_profile"] = f"""WITH {_BIKE}
SELECT status, round(AVG(latitude), 6) AS avg_latitude, round(AVG(longitude), 6) AS avg_longitude,
       COUNT(*) AS station_count FROM bike GROUP BY status"""
SQL["linreg_fit"] = f"""WITH {_CARS}
SELECT round(regr_slope(Price, Mileage), 4) AS slope, round(regr_intercept(Price, Mileage), 4) AS intercept FROM cars"""
_NBF = ", ".join(f"SUM(CASE WHEN contains(clean_title, '{k}') THEN 1 ELSE 0 END) AS has_{k}" for k in SKILL_KEYWORDS)
_NBU = " UNION ALL ".join(f"SELECT country, 'has_{k}' AS feature, has_{k} AS c FROM per" for k in SKILL_KEYWORDS)
SQL["naive_bayes_fit"] = f"""WITH {_CLEAN},
nb AS (SELECT * FROM cj WHERE country IS NOT NULL AND country NOT IN ('NULL', '')),
per AS (SELECT country, COUNT(*) AS n, {_NBF} FROM nb GROUP BY country),
tot AS (SELECT SUM(n) AS total, COUNT(*) AS k FROM per),
cells AS ({_NBU}),
rowsum AS (SELECT country, SUM(c) AS s FROM cells GROUP BY country)
SELECT p.country, '__prior__' AS feature, round(ln(p.n + 1.0) - ln(t.total + t.k * 1.0), 6) AS log_prob
FROM per p, tot t
UNION ALL
SELECT c.country, c.feature, round(ln(c.c + 1.0) - ln(r.s + {len(SKILL_KEYWORDS)}.0), 6)
FROM cells c JOIN rowsum r ON c.country = r.country"""

# ------------------------------------------------------------ files / streams
SQL["stream_to_messages"] = SQL["keyed_messages"]
SQL["stream_upsert"] = f"""WITH {_USERS},
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY country, id ORDER BY created_at DESC) AS rn FROM ue)
SELECT country, id, name, email, created_at FROM r WHERE rn = 1"""
SQL["csv_round_trip"] = SQL["typed_parse"]
SQL["row_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}"
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"))

# ------------------------------------------------- validation / text helpers
SQL["validated_users"] = """WITH
inc AS (SELECT c.c_custkey AS seq, c.c_name AS name,
               'customer' || lpad(CAST(c.c_custkey // 2 AS VARCHAR), 9, '0')
                 || CASE WHEN c.c_acctbal < 0 THEN '.example.com' ELSE '@example.com' END AS email,
               n.n_name AS country
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
chk AS (SELECT seq, email, concat_ws(';', CASE WHEN name IS NULL THEN 'name_missing' END,
                               CASE WHEN email IS NULL THEN 'email_missing' END,
                               CASE WHEN country IS NULL THEN 'country_missing' END,
                               CASE WHEN NOT regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')
                                    THEN 'email_format' END) AS reasons FROM inc)
SELECT seq, email, reasons = '' AS valid, reasons FROM chk"""
SQL["path_stem"] = """SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base_name,
       regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^(.+?)(\\.[^.]*)?$', 1) AS stem FROM pages"""
SQL["formatted_dates"] = """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(ts, '%f') = '000000' THEN ''
                                                 ELSE '.' || strftime(ts, '%f') END AS ts_iso,
       strftime(ts, '%Y%m%d_%H%M%S') AS ts_stamp FROM events"""
SQL["tagged_rows"] = f"""WITH {_DET}
SELECT p.video_file, CAST(p.frame_idx AS BIGINT) AS frame_idx, 'skeet' AS target_type,
       CASE b.cls WHEN 0 THEN 'whole' WHEN 1 THEN 'broken' ELSE 'unknown' END AS state
FROM plan p LEFT JOIN best b ON p.video_file = b.video_file AND p.frame_idx = b.frame_idx"""

# ------------------------------------------------------------ option variants
SQL["streak_runs_balanced"] = SQL["streak_runs"]
SQL["order_documents_by_id"] = f"""WITH {_GOOD}
SELECT Order_id AS _id, strftime(MIN(datetime), {TS}) AS datetime, CAST(SUM(price) AS BIGINT) AS order_total,
       string_agg(concat_ws(':', menu_item, CAST(price AS VARCHAR)), '|'
                  ORDER BY concat_ws(':', menu_item, CAST(price AS VARCHAR))) AS items
FROM good GROUP BY Order_id"""
SQL["nf_order_items_dedup"] = f"""WITH {_GOOD}
SELECT CAST(ROW_NUMBER() OVER (ORDER BY Order_id NULLS FIRST, menu_item NULLS FIRST) AS BIGINT) AS order_item_id,
       Order_id AS order_id, menu_item FROM (SELECT DISTINCT Order_id, menu_item FROM good)"""
_TFLAGS = ", ".join(
    f"CASE WHEN list_contains(string_split_regex(clean_title, '\\s+'), '{k}') THEN 1 ELSE 0 END AS has_{k}"
    for k in SKILL_KEYWORDS)
SQL["keyword_flags_token"] = f"WITH {_CLEAN} SELECT doc_id, {_TFLAGS} FROM cj"

# --------------------------------------------------- jobs and sinks read back
SQL["cleaning_job"] = SQL["clean_good"]
SQL["dead_letters_read_back"] = f"""WITH {_DIRTY}
SELECT reject_reason, COUNT(*) AS n FROM tagged WHERE reject_reason <> '' GROUP BY reject_reason"""
SQL["per_key_csv"] = SQL["detection_log"]
SQL["documents_read_back"] = SQL["order_documents"]
SQL["label_lines_read_back"] = SQL["bbox_labels"].replace(""" AS label_line,
       CAST(printf('%.6f', cxn) AS DOUBLE) AS cx_n, CAST(printf('%.6f', cyn) AS DOUBLE) AS cy_n,
       CAST(printf('%.6f', wn) AS DOUBLE) AS w_n, CAST(printf('%.6f', hn) AS DOUBLE) AS h_n""", " AS label_line")
SQL["minute_files_read_back"] = f"""WITH {_USERS},
t AS (SELECT time_bucket(INTERVAL '1 minute', CAST(created_at AS TIMESTAMP)) + INTERVAL '1 minute' AS e FROM ue)
SELECT 'users_' || strftime(e, '%Y%m%d_%H%M%S') || '.jsonl' AS file_name, COUNT(*) AS n_records FROM t GROUP BY 1"""
SQL["file_catalog"] = f"""WITH {_USERS}
SELECT 'users_20240101_000' || CAST(seq % 4 AS VARCHAR) || '00' AS flush, true AS has_bytes, COUNT(*) AS n_records,
       CAST(SUM(seq) AS BIGINT) AS seq_sum FROM ue GROUP BY seq % 4"""
SQL["decode_rejects"] = f"""WITH {_USERS}
SELECT country AS msg_key, length(to_json({{'id': id, 'name': name, 'email': email, 'country': country,
       'created_at': created_at, 'seq': seq}})::VARCHAR) - 5 AS n_chars FROM ue WHERE seq % 7 = 0"""
SQL["id_check"] = """WITH h AS (SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR)) AS h FROM customer),
u AS (SELECT c_custkey, concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS u FROM h)
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN u[1:35] ELSE u END AS id, c_custkey % 5 <> 0 AS valid FROM u"""
SQL["key_partitions"] = f"""WITH {_USERS}
SELECT country AS key, COUNT(*) AS n, CAST(1 AS BIGINT) AS n_partitions FROM ue GROUP BY country"""

# ------------------------------------------------- fits by plain aggregations
_SPLIT = "((CAST(row_id AS HUGEINT) % 4294967296) * 2654435761) % 4294967296 % 100 < 70"


def _tree_sql(n_features: int, depth: int, bins: int) -> str:
    """Level by level: counts, every cut's impurity, the best cut per node."""
    xs = range(n_features)
    sql = f"""WITH p AS (SELECT vec_id AS row_id, 'class_' || CAST(label AS VARCHAR) AS y, embedding AS e FROM embeddings),
q AS (SELECT *, {_SPLIT} AS train FROM p),
m AS (SELECT {', '.join(f"min(e[{i + 1}]::DOUBLE) AS lo{i}, (max(e[{i + 1}]::DOUBLE) - min(e[{i + 1}]::DOUBLE)) / {bins} AS w{i}" for i in xs)}
      FROM q WHERE train),
l0 AS (SELECT row_id, y, train, 1 AS node,
       [{', '.join(f"CAST(greatest(least(floor((e[{i + 1}]::DOUBLE - lo{i}) / w{i}), {bins - 1}), 0) AS INTEGER)" for i in xs)}] AS b FROM q, m)"""
    for k in range(depth):
        sql += f""",
h{k} AS (SELECT node, f, b, y, count(*) AS n FROM (SELECT node, y, unnest(range({n_features})) AS f, unnest(b) AS b FROM l{k} WHERE train)
         GROUP BY ALL),
s{k} AS (SELECT node, f, cut, y, sum(CASE WHEN b <= cut THEN n ELSE 0 END)::DOUBLE AS l, sum(CASE WHEN b > cut THEN n ELSE 0 END)::DOUBLE AS r
         FROM h{k}, (SELECT unnest(range({bins - 1})) AS cut) GROUP BY ALL),
g{k} AS (SELECT node, f, cut, round(sum(l) - sum(l * l) / sum(l) + sum(r) - sum(r * r) / sum(r), 9) AS imp,
                round(sum(l + r) - sum((l + r) * (l + r)) / sum(l + r), 9) AS whole
         FROM s{k} GROUP BY node, f, cut HAVING sum(l) > 0 AND sum(r) > 0),
c{k} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY imp, f, cut) AS rn FROM g{k}) WHERE rn = 1 AND whole - imp > 1e-9),
l{k + 1} AS (SELECT row_id, y, train, CASE WHEN c.node IS NULL THEN x.node WHEN x.b[c.f + 1] > c.cut THEN 2 * x.node + 1 ELSE 2 * x.node END AS node, x.b
         FROM l{k} x LEFT JOIN c{k} c ON x.node = c.node)"""
    return sql + f""",
v AS (SELECT node, y, row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, y) AS rn FROM l{depth} WHERE train GROUP BY node, y)
SELECT row_id, CAST(x.node AS BIGINT) AS node, v.y AS prediction FROM l{depth} x JOIN v ON x.node = v.node AND v.rn = 1 WHERE NOT train"""


def _lloyd_sql(n_cols: int, k: int, rounds: int) -> str:
    xs = range(n_cols)
    cols = ", ".join(f"x{i}" for i in xs)
    dist = " + ".join(f"(p.x{i} - c.x{i}) * (p.x{i} - c.x{i})" for i in xs)
    sql = f"""WITH p AS (SELECT vec_id AS row_id, {', '.join(f"embedding[{i + 1}]::DOUBLE AS x{i}" for i in xs)} FROM embeddings),
c0 AS (SELECT row_number() OVER (ORDER BY md5(row_id::VARCHAR), row_id) - 1 AS c, {cols} FROM p QUALIFY c < {k})"""
    for r in range(rounds + 1):
        sql += f""",
a{r} AS (SELECT row_id, {', '.join(f"p.x{i}" for i in xs)}, c FROM p, c{r} c
         QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY {dist}, c) = 1)"""
        if r < rounds:
            sql += f""",
c{r + 1} AS (SELECT c.c, {', '.join(f"coalesce(avg(a.x{i}), any_value(c.x{i})) AS x{i}" for i in xs)}
         FROM c{r} c LEFT JOIN a{r} a ON a.c = c.c GROUP BY c.c)"""
    return sql + f"""
SELECT CAST(c AS BIGINT) AS cluster, count(*) AS n, {', '.join(f"round(avg(x{i}), 6) AS avg_m{i}" for i in xs)} FROM a{rounds} GROUP BY c"""


def _newton_sql(rounds: int) -> str:
    sql = f"""WITH {_JOBS},
j AS (SELECT CASE WHEN is_hourly = 'True' THEN 1 ELSE 0 END AS y, budget_clean / 10000.0::DOUBLE AS x FROM jobs WHERE is_hourly IS NOT NULL),
b0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"""
    for r in range(rounds):
        sql += f""",
p{r} AS (SELECT x, y, 1 / (1 + exp(-(a + b * x))) AS p FROM j, b{r}),
t{r} AS (SELECT sum(y - p) AS g0, sum((y - p) * x) AS g1, sum(p * (1 - p)) AS h00, sum(p * (1 - p) * x) AS h01,
                sum(p * (1 - p) * x * x) AS h11 FROM p{r}),
b{r + 1} AS (SELECT a + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS a, b + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS b FROM b{r}, t{r})"""
    return sql + f"""
SELECT count(*) AS n, CAST(sum(y) AS BIGINT) AS n_hourly, round(any_value(a), 6) AS intercept, round(any_value(b), 6) AS slope FROM j, b{rounds}"""


SQL["histogram_tree"] = _tree_sql(8, 3, 16)
SQL["kmeans_lloyd"] = _lloyd_sql(4, 3, 6)
SQL["logreg_newton"] = _newton_sql(6)
