"""The same queries in SQL for an independent engine."""

from __future__ import annotations

POS = "('view_phone','contact_chat','contact_zalo','contact_sms','other_interaction')"
HARD = "('view_phone','contact_chat','contact_zalo','contact_sms')"
W = f"CASE WHEN event_type IN {HARD} THEN 3.0::DOUBLE WHEN event_type = 'other_interaction' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
NPV = "CAST(count(*) FILTER (event_type = 'pageview') AS BIGINT)"
NPOS = f"CAST(count(*) FILTER (event_type IN {POS}) AS BIGINT)"
NHARD = f"CAST(count(*) FILTER (event_type IN {HARD}) AS BIGINT)"
CUT = "DATE '2024-01-20'"
WIN = "date BETWEEN DATE '2024-01-01' AND DATE '2024-01-28'"
DWELL = "CASE WHEN dwell_time_sec > 0 AND dwell_time_sec < 3600 THEN dwell_time_sec END"
NONE = "'Không xác định'"
SEG = "CASE WHEN category = 1050 OR project_id IS NOT NULL THEN 'B2B' ELSE 'C2C' END"


def rate(a: str, b: str) -> str:
    return f"round({a}::DOUBLE / nullif({b}::DOUBLE, 0), 6)"


def wilson(k: str, n: str, sign: str) -> str:
    c, z = f"nullif({n}::DOUBLE, 0)", "1.96::DOUBLE"
    p = f"({k}::DOUBLE / {c})"
    return f"round(CASE WHEN {n} > 0 THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, ({p} + {z}*{z}/(2*{c})) / (1 + {z}*{z}/{c}) {sign} {z}*sqrt(({p}*(1-{p}) + {z}*{z}/(4*{c}))/{c}) / (1 + {z}*{z}/{c}))) END, 6)"


def cr(source: str, by: str) -> str:
    k, n = "sum(is_qualified_pos)", "sum(is_qualified)"
    return f"SELECT {by}, count(*) AS n_pairs, CAST({n} AS BIGINT) AS n_qualified, CAST({k} AS BIGINT) AS n_positive, {rate(k, n)} AS rate, {wilson(k, n, '-')} AS low, {wilson(k, n, '+')} AS high FROM {source} GROUP BY {by}"


def gini(rows: str, value: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"SELECT {lead}count(*) AS n, round(CASE WHEN sum(x) > 0 THEN 2 * sum(i * x) / (count(*) * sum(x)) - (count(*) + 1.0::DOUBLE) / count(*) ELSE 0.0::DOUBLE END, 6) AS gini FROM (SELECT {lead}{value}::DOUBLE AS x, row_number() OVER ({part} ORDER BY {value}) AS i FROM ({rows}) WHERE {value} IS NOT NULL) {group}"


CTES = {
    "dim": """SELECT p_partkey AS item_id, s_suppkey AS seller_id,
 CASE p_type WHEN 'STANDARD' THEN 1010 WHEN 'ECONOMY' THEN 1020 WHEN 'MEDIUM' THEN 1030 WHEN 'LARGE' THEN 1040 WHEN 'PROMO' THEN 1050 ELSE 6020 END AS category,
 p_name AS title, CASE WHEN s_suppkey % 5 = 1 THEN 'private' ELSE 'agent' END AS seller_type, CASE WHEN p_size % 2 = 0 THEN 'sell' ELSE 'let' END AS ad_type,
 p_size * CAST(2.5 AS DOUBLE) AS area_sqm, CAST(p_size % 5 AS DOUBLE) AS bedrooms, CAST(p_size % 3 AS DOUBLE) AS bathrooms, CAST(p_size % 20 AS DOUBLE) AS images_count,
 n_name AS city_name, concat(n_name, '_D', CAST(p_partkey % 3 AS VARCHAR)) AS district_name, CASE WHEN p_partkey % 7 = 0 THEN concat('PRJ', CAST(p_partkey AS VARCHAR)) END AS project_id, p_brand AS price_bucket, CASE p_partkey % 10 WHEN 0 THEN 'đông bắc' WHEN 1 THEN 'Dong Nam' WHEN 2 THEN 'tb' WHEN 3 THEN 'tây - nam' WHEN 4 THEN 'Đông' WHEN 5 THEN 'tay' WHEN 6 THEN 'nam' WHEN 7 THEN 'BẮC' WHEN 9 THEN 'up' END AS direction,
 CAST(DATE '2023-12-01' + (p_partkey % 50) * INTERVAL '1' DAY AS DATE) AS posted_date, CAST(DATE '2023-12-01' + (p_partkey % 50 + 20 + p_size) * INTERVAL '1' DAY AS DATE) AS expected_expired_date
FROM part JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier) JOIN nation ON n_nationkey = s_nationkey""",
    "ev": """SELECT e.event_id, e.user_id, l.item_id,
 CASE e.event_type WHEN 'view' THEN 'pageview' WHEN 'purchase' THEN 'view_phone' WHEN 'signup' THEN 'contact_chat' WHEN 'error' THEN 'contact_sms' ELSE 'other_interaction' END AS event_type,
 e.ts AS event_ts, epoch_us(e.ts) AS us, CAST(e.ts AS DATE) AS date, l.category, l.city_name,
 CASE e.event_id % 4 WHEN 0 THEN 'ad_view' WHEN 1 THEN 'adview' WHEN 2 THEN 'search' ELSE 'feed' END AS surface, CASE e.event_id % 3 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' ELSE 'web' END AS device,
 CASE WHEN e.event_id % 97 = 0 THEN CAST(3600 AS DOUBLE) ELSE e.value END AS dwell_time_sec, CASE WHEN e.event_id % 10 = 0 THEN 'guest' ELSE 'login' END AS is_login,
 e.user_id * 100 + EXTRACT(DAY FROM e.ts) AS session_id, CASE WHEN e.event_type = 'view' THEN 0 ELSE 1 END AS is_contact
FROM events e JOIN dim l ON l.item_id = CAST(regexp_extract(e.props, '[0-9]+', 0) AS BIGINT)""",
    "usr": "SELECT c_custkey AS user_id FROM customer",
    "snap": f"SELECT e.item_id, e.date, {NPV} AS views_24h, {NPOS} AS contacts_24h, CAST(date_diff('day', min(posted_date), e.date) AS INTEGER) AS listing_age_days FROM ev e JOIN dim USING (item_id) GROUP BY e.item_id, e.date",
    "inter": f"SELECT user_id, item_id, date, min(category) AS category, {NPV} AS adview_count, {NHARD} AS lead_count, CAST(count(*) FILTER (event_type = 'contact_chat') AS BIGINT) AS chat_message_count, CAST(count(*) FILTER (event_type = 'contact_sms') AS BIGINT) AS chat_turn_count FROM ev GROUP BY user_id, item_id, date",
    "ud": f"SELECT user_id, date, {NPV} AS n_pageview, {NPOS} AS n_pos_events, sum({W}) AS weighted_score, count(DISTINCT item_id) AS n_unique_items FROM ev WHERE {WIN} GROUP BY user_id, date",
    "idy": f"SELECT item_id, date, {NPV} AS n_pageview, {NPOS} AS n_pos_events, sum({W}) AS weighted_score, count(DISTINCT user_id) AS n_unique_users, avg(dwell_time_sec) AS avg_dwell FROM ev WHERE {WIN} GROUP BY item_id, date",
    "uid": f"SELECT user_id, item_id, date, {NPV} AS n_pageview, {NPOS} AS n_pos_events, sum({W}) AS weighted_score, max(dwell_time_sec) AS max_dwell, min(us) AS first_event_us, max(us) AS last_event_us FROM ev WHERE {WIN} GROUP BY user_id, item_id, date",
    "ucat": f"SELECT user_id, category, {NPOS} AS n_pos_events, sum({W}) AS weighted_score, count(DISTINCT item_id) AS n_unique_items FROM ev WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-19' GROUP BY user_id, category HAVING sum({W}) > 0",
    "ucity": f"SELECT user_id, city_name, {NPOS} AS n_pos_events, sum({W}) AS weighted_score, count(DISTINCT item_id) AS n_unique_items FROM ev WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-19' GROUP BY user_id, city_name HAVING sum({W}) > 0",
    "reeng": f"SELECT user_id, item_id, 'reengagement' AS source, source_score, last_event_date FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY source_score DESC, last_event_date DESC, item_id) AS rn FROM (SELECT user_id, item_id, max(date) AS last_event_date, round(sum(weighted_score) * exp(-date_diff('day', max(date), {CUT}) * ln(2.0::DOUBLE) / 14), 9) AS source_score FROM uid WHERE date < {CUT} AND weighted_score > 0 GROUP BY user_id, item_id)) WHERE rn <= 50",
    "seeds": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY w DESC, item_id) AS rn FROM (SELECT user_id, item_id, sum(weighted_score) AS w FROM uid WHERE date < {CUT} AND date >= {CUT} - 21 GROUP BY ALL HAVING sum(weighted_score) >= 1)) WHERE rn <= 100",
    "edge": "SELECT a.item_id AS item_a, b.item_id AS item_b, sum(a.w * b.w) AS edge_weight, count(*) AS n_co_users FROM seeds a JOIN seeds b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY ALL HAVING count(*) >= 2",
    "matrix": "SELECT item_a, item_b, edge_weight, n_co_users FROM (SELECT *, row_number() OVER (PARTITION BY item_a ORDER BY edge_weight DESC, n_co_users DESC, item_b) AS rn FROM (SELECT * FROM edge UNION ALL SELECT item_b, item_a, edge_weight, n_co_users FROM edge)) WHERE rn <= 50",
    "allseeds": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY w DESC, item_id) AS rn FROM (SELECT user_id, item_id, sum(weighted_score) AS w FROM uid WHERE date < {CUT} GROUP BY ALL HAVING sum(weighted_score) > 0)) WHERE rn <= 100",
    "covis": "SELECT user_id, item_id, 'covisit' AS source, source_score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY source_score DESC, item_id) AS rn FROM (SELECT user_id, item_b AS item_id, sum(w * edge_weight) AS source_score FROM allseeds s JOIN matrix m ON s.item_id = m.item_a GROUP BY ALL)) WHERE rn <= 80",
    "pop": f"SELECT item_id, sum(weighted_score) AS pop FROM idy WHERE date < {CUT} AND date >= {CUT} - 14 GROUP BY item_id HAVING sum(weighted_score) > 0",
    "mycat": "SELECT user_id, category FROM ucat QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY weighted_score DESC, category) = 1",
    "mycity": "SELECT user_id, city_name FROM ucity QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY weighted_score DESC, city_name) = 1",
    "catpop": "SELECT user_id, item_id, 'category_pop' AS source, pop AS source_score FROM mycat JOIN (SELECT item_id, category, pop FROM pop JOIN dim USING (item_id) QUALIFY row_number() OVER (PARTITION BY category ORDER BY pop DESC, item_id) <= 30) USING (category)",
    "cellpop": "SELECT user_id, item_id, 'city_cat_pop' AS source, pop AS source_score FROM mycat JOIN mycity USING (user_id) JOIN (SELECT item_id, category, city_name, pop FROM pop JOIN dim USING (item_id) QUALIFY row_number() OVER (PARTITION BY category, city_name ORDER BY pop DESC, item_id) <= 20) USING (category, city_name)",
    "globpop": "SELECT user_id, item_id, 'global_pop' AS source, pop AS source_score FROM (SELECT DISTINCT user_id FROM ud), (SELECT item_id, pop FROM pop ORDER BY pop DESC, item_id LIMIT 20)",
    "srcs": "SELECT user_id, item_id, source, source_score FROM reeng UNION ALL SELECT * FROM covis UNION ALL SELECT * FROM catpop UNION ALL SELECT * FROM cellpop UNION ALL SELECT * FROM globpop",
    "scoredsrc": "SELECT *, CASE WHEN max(source_score) OVER (PARTITION BY source) > 0 THEN round(source_score / max(source_score) OVER (PARTITION BY source), 9) ELSE 0.0::DOUBLE END AS candidate_score FROM srcs",
    "pool": "SELECT user_id, item_id, source, source_score, candidate_score FROM (SELECT * FROM scoredsrc QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY candidate_score DESC, source_score DESC, source) = 1) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY candidate_score DESC, source_score DESC, item_id) <= 200",
    "hist": f"SELECT u.*, d.category, d.city_name FROM uid u LEFT JOIN dim d USING (item_id) WHERE u.date < {CUT} AND u.weighted_score > 0",
    "hcat": "SELECT user_id, category, sum(weighted_score) AS w, row_number() OVER (PARTITION BY user_id ORDER BY sum(weighted_score) DESC, category) AS rn FROM hist WHERE category IS NOT NULL GROUP BY user_id, category",
    "uf": f"""SELECT b.user_id, u_total_weighted, u_recent_weighted, CAST(u_total_pageview AS BIGINT) AS u_total_pageview, coalesce(u_unique_items, 0) AS u_unique_items, coalesce(u_unique_categories, 0) AS u_unique_categories, coalesce(u_unique_cities, 0) AS u_unique_cities, u_active_days,
 coalesce(c1.category, -1) AS u_top_category, coalesce(c2.category, -1) AS u_top2_category, coalesce(ct.city_name, '') AS u_top_city, round(coalesce(u_avg_dwell, 0) + 1e-7::DOUBLE, 4) AS u_avg_dwell, CAST(date_diff('day', last, {CUT}) AS INTEGER) AS u_days_since_last, CASE WHEN u_total_weighted > 0 THEN 1 ELSE 0 END AS u_is_warm, round(coalesce(c1.w / tot.w, 0), 6) AS u_top_category_share, round(coalesce(lt.top / lt.w, 0), 6) AS u_top_category_share_recent
FROM (SELECT user_id, sum(weighted_score) AS u_total_weighted, sum(CASE WHEN date >= {CUT} - 7 THEN weighted_score ELSE 0.0::DOUBLE END) AS u_recent_weighted, sum(n_pageview) AS u_total_pageview, count(DISTINCT date) AS u_active_days, max(date) AS last FROM ud WHERE date < {CUT} GROUP BY user_id) b
LEFT JOIN (SELECT user_id, count(DISTINCT item_id) AS u_unique_items, avg(max_dwell) AS u_avg_dwell, count(DISTINCT category) AS u_unique_categories, count(DISTINCT city_name) AS u_unique_cities FROM hist GROUP BY user_id) m USING (user_id)
LEFT JOIN (SELECT * FROM hcat WHERE rn = 1) c1 USING (user_id) LEFT JOIN (SELECT * FROM hcat WHERE rn = 2) c2 USING (user_id) LEFT JOIN (SELECT user_id, sum(w) AS w FROM hcat GROUP BY user_id) tot USING (user_id)
LEFT JOIN (SELECT user_id, max(w) AS top, sum(w) AS w FROM (SELECT user_id, category, sum(weighted_score) AS w FROM hist WHERE date >= {CUT} - 7 AND category IS NOT NULL GROUP BY user_id, category) GROUP BY user_id) lt USING (user_id)
LEFT JOIN (SELECT user_id, city_name FROM hist WHERE city_name IS NOT NULL GROUP BY user_id, city_name QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY sum(weighted_score) DESC, city_name) = 1) ct USING (user_id)""",
    "itf": f"""SELECT d.item_id, category AS i_category, city_name AS i_city_name, district_name AS i_district_name, seller_type AS i_seller_type, ad_type AS i_ad_type, CASE WHEN coalesce(project_id, '') <> '' THEN 1 ELSE 0 END AS i_has_project_id, area_sqm AS i_area_sqm, bedrooms AS i_bedrooms, bathrooms AS i_bathrooms, images_count AS i_images_count,
 CAST(coalesce(date_diff('day', posted_date, {CUT}), 999) AS INTEGER) AS i_age_days, coalesce(tw, 0.0::DOUBLE) AS i_total_weighted, coalesce(rw, 0.0::DOUBLE) AS i_recent_weighted, CAST(coalesce(pv, 0) AS BIGINT) AS i_total_pageview, CAST(coalesce(nu, 0) AS BIGINT) AS i_total_user_events, round(coalesce(ad, 0.0::DOUBLE), 6) AS i_avg_dwell, CAST(coalesce(rk, 999999) AS INTEGER) AS i_pop_rank_global
FROM dim d LEFT JOIN (SELECT *, CASE WHEN rw > 0 THEN row_number() OVER (ORDER BY rw DESC, item_id) END AS rk FROM (SELECT item_id, sum(weighted_score) AS tw, sum(CASE WHEN date >= {CUT} - 14 THEN weighted_score ELSE 0.0::DOUBLE END) AS rw, sum(n_pageview) AS pv, sum(n_unique_users) AS nu, avg(avg_dwell) AS ad FROM idy WHERE date < {CUT} GROUP BY item_id)) a USING (item_id)""",
    "pf": f"""SELECT c.user_id, c.item_id, coalesce(tw, 0.0::DOUBLE) AS ui_total_weighted, coalesce(rw, 0.0::DOUBLE) AS ui_recent_weighted, CAST(coalesce(pv, 0) AS BIGINT) AS ui_n_pageview, CAST(coalesce(np, 0) AS BIGINT) AS ui_n_pos_events, coalesce(md, 0.0::DOUBLE) AS ui_max_dwell, coalesce(nd, 0) AS ui_n_active_days,
 CAST(coalesce(date_diff('day', last, {CUT}), 999) AS INTEGER) AS ui_days_since_last, CAST(coalesce(date_diff('day', first, {CUT}), 999) AS INTEGER) AS ui_days_since_first
FROM pool c LEFT JOIN (SELECT user_id, item_id, sum(weighted_score) AS tw, sum(CASE WHEN date >= {CUT} - 7 THEN weighted_score ELSE 0.0::DOUBLE END) AS rw, sum(n_pageview) AS pv, sum(n_pos_events) AS np, max(max_dwell) AS md, count(DISTINCT date) AS nd, max(date) AS last, min(date) AS first FROM uid WHERE date < {CUT} GROUP BY user_id, item_id) USING (user_id, item_id)""",
    "tf": "SELECT user_id, item_id, " + ", ".join(f"CASE WHEN {d} <= 3 THEN 0 WHEN {d} <= 7 THEN 1 WHEN {d} <= 14 THEN 2 WHEN {d} <= 30 THEN 3 WHEN {d} <= 180 THEN 4 ELSE 5 END AS {n}" for d, n in (("ui_days_since_last", "ui_recency_tier"), ("coalesce(u_days_since_last, 999)", "u_activity_recency_tier"), ("coalesce(i_age_days, 999)", "i_age_tier"))) + " FROM pf LEFT JOIN uf USING (user_id) LEFT JOIN itf USING (item_id)",
    "ri": """SELECT p.*, * EXCLUDE (user_id, item_id, source, source_score, candidate_score, i_total_user_events) REPLACE (
 coalesce(u_total_weighted, 0) AS u_total_weighted, coalesce(u_recent_weighted, 0) AS u_recent_weighted, coalesce(u_total_pageview, 0) AS u_total_pageview, coalesce(u_unique_items, 0) AS u_unique_items, coalesce(u_unique_categories, 0) AS u_unique_categories, coalesce(u_unique_cities, 0) AS u_unique_cities, coalesce(u_active_days, 0) AS u_active_days, coalesce(u_top_category, -1) AS u_top_category, coalesce(u_top2_category, -1) AS u_top2_category, coalesce(u_top_city, '') AS u_top_city, coalesce(u_avg_dwell, 0) AS u_avg_dwell, coalesce(u_days_since_last, 999) AS u_days_since_last, coalesce(u_is_warm, 0) AS u_is_warm, coalesce(u_top_category_share, 0) AS u_top_category_share, coalesce(u_top_category_share_recent, 0) AS u_top_category_share_recent)
FROM pool p LEFT JOIN uf USING (user_id) LEFT JOIN itf USING (item_id) LEFT JOIN pf USING (user_id, item_id) LEFT JOIN tf USING (user_id, item_id)""",
    "rin": "SELECT *, CAST(u_top_category <> -1 AND u_top_category = i_category AS INTEGER) AS ui_category_match, CAST(u_top_city = i_city_name AS INTEGER) AS ui_city_match, greatest(CAST(u_top_category <> -1 AND u_top_category = i_category AS INTEGER), CAST(u_top2_category <> -1 AND u_top2_category = i_category AS INTEGER)) AS ui_category_match_top2, round(CAST(u_top_category <> -1 AND u_top_category = i_category AS INTEGER) * u_top_category_share, 6) AS ui_top_cat_match_x_share FROM ri",
    "gt": f"SELECT user_id, item_id, sum({W}) AS gt_weighted_score, count(*) AS gt_n_events FROM ev WHERE date BETWEEN DATE '2024-01-21' AND DATE '2024-01-28' AND is_login = 'login' AND ({W}) > 0 GROUP BY user_id, item_id",
    "lab": "SELECT user_id, item_id, candidate_score, CASE WHEN coalesce(gt_weighted_score, 0) >= 6 THEN 3 WHEN coalesce(gt_weighted_score, 0) >= 3 THEN 2 WHEN coalesce(gt_weighted_score, 0) > 0 THEN 1 ELSE 0 END AS label, md5(concat_ws('|', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), '42')) AS sample_key FROM pool LEFT JOIN gt USING (user_id, item_id)",
    "sc": "SELECT user_id, item_id, round(candidate_score * 1.0::DOUBLE + ui_category_match * 0.3::DOUBLE + ui_city_match * 0.1::DOUBLE + ui_top_cat_match_x_share * 0.2::DOUBLE + i_has_project_id * 0.05::DOUBLE + CASE WHEN ui_days_since_last <= 7 THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END + ln(1 + i_recent_weighted) * 0.1::DOUBLE, 6) AS pred_score FROM rin",
    "raw": "SELECT user_id, item_id, CAST(rk AS INTEGER) AS rank, pred_score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pred_score DESC, item_id) AS rk FROM sc) WHERE rk <= 10",
    "rr": f"SELECT user_id, item_id, CAST(rk AS INTEGER) AS rank, final_score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY final_score DESC, item_id) AS rk FROM (SELECT *, round(s * CASE WHEN row_number() OVER (PARTITION BY user_id, seller_id ORDER BY s DESC, item_id) > 2 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END, 6) AS final_score FROM (SELECT sc.*, seller_id, pred_score * CASE WHEN date_diff('day', posted_date, {CUT}) <= 7 THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END AS s FROM sc LEFT JOIN dim USING (item_id)))) WHERE rk <= 10",
    "gtop": "SELECT item_id, row_number() OVER (ORDER BY pop DESC, item_id) AS rank FROM pop QUALIFY rank <= 20",
    "sub": "SELECT user_id, CAST(rk AS INTEGER) AS rank, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY prio, rank, item_id) AS rk FROM (SELECT user_id, item_id, rank, 0 AS prio FROM raw JOIN usr USING (user_id) UNION ALL SELECT user_id, item_id, rank, 1 FROM usr, gtop WHERE NOT EXISTS (SELECT 1 FROM raw r WHERE r.user_id = usr.user_id AND r.item_id = gtop.item_id))) WHERE rk <= 10",
    "gp": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, item_id) AS place FROM (SELECT sc.user_id, sc.item_id, seller_id, coalesce(seller_type = 'private', false) AS private, round(pred_score * CASE WHEN coalesce(date_diff('day', posted_date, DATE '2024-01-28'), 999) <= 7 THEN 1.05::DOUBLE ELSE 1.0::DOUBLE END, 6) AS s FROM sc LEFT JOIN dim USING (item_id))) WHERE place <= 30",
    "gc": "SELECT *, (SELECT count(*) FROM gp o WHERE o.user_id = g.user_id AND o.seller_id = g.seller_id AND o.place < g.place) >= 3 AS beyond FROM gp g",
    "gi": "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY beyond, place) <= 10 AS inside FROM gc",
    "gn": "SELECT user_id, greatest(0, least(3 - count(*) FILTER (inside AND private), count(*) FILTER (NOT inside AND private), count(*) FILTER (inside AND NOT private))) AS swaps FROM gi GROUP BY user_id",
    "greedy": "SELECT user_id, item_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY place) AS INTEGER) AS rank, s AS final_score FROM (SELECT *, row_number() OVER (PARTITION BY user_id, inside, private ORDER BY place) AS high, row_number() OVER (PARTITION BY user_id, inside, private ORDER BY place DESC) AS low FROM gi) JOIN gn USING (user_id) WHERE (inside AND (private OR low > swaps)) OR (NOT inside AND private AND high <= swaps)",
    "posev": f"SELECT event_id, user_id, item_id, event_type, date, category, city_name, session_id, device, us AS event_us, least(greatest(coalesce(dwell_time_sec, 0), 0), 3600) AS dwell FROM ev WHERE event_type IN {POS} AND is_login = 'login' AND date <= DATE '2024-01-28'",
    "pr": f"""SELECT *, CASE WHEN n_pageview > 0 AND coalesce(max_dwell, 0) >= 30 THEN 1 ELSE 0 END AS is_qualified, CASE WHEN n_pageview > 0 AND coalesce(max_dwell, 0) >= 30 AND n_pos > 0 THEN 1 ELSE 0 END AS is_qualified_pos FROM
(SELECT user_id, item_id, {NPV} AS n_pageview, {NPOS} AS n_pos, {NHARD} AS n_direct, max(CASE WHEN event_type = 'pageview' THEN {DWELL} END) AS max_dwell, min(CASE WHEN event_type = 'pageview' THEN us END) AS first_view_us, min(CASE WHEN event_type IN {POS} THEN us END) AS first_pos_us FROM ev WHERE {WIN} GROUP BY user_id, item_id)""",
    "pd": f"SELECT p.*, seller_id, category, seller_type, ad_type, {SEG} AS segment FROM pr p JOIN dim USING (item_id) WHERE n_pageview > 0",
    "im": f"SELECT d.item_id, seller_id, category, seller_type, ad_type, city_name, district_name, images_count, area_sqm, bedrooms, price_bucket, project_id, posted_date, {SEG} AS segment, CAST(coalesce(views, 0) AS BIGINT) AS views, CAST(coalesce(contacts, 0) AS BIGINT) AS contacts, round(coalesce(avg_age, 0), 6) AS avg_age, CAST(coalesce(max_age, 0) AS BIGINT) AS max_age, CAST(coalesce(n_days, 0) AS BIGINT) AS n_days, {rate('contacts', 'views')} AS contact_rate FROM dim d LEFT JOIN (SELECT item_id, sum(greatest(coalesce(views_24h, 0), 0)) AS views, sum(greatest(coalesce(contacts_24h, 0), 0)) AS contacts, avg(greatest(coalesce(listing_age_days, 0), 0)) AS avg_age, max(greatest(coalesce(listing_age_days, 0), 0)) AS max_age, count(*) AS n_days FROM snap WHERE date <= DATE '2024-01-28' GROUP BY item_id) s USING (item_id)",
    "sm": f"SELECT seller_id, min(seller_type) AS seller_type, count(*) AS n_listings, CAST(sum(views) AS BIGINT) AS views, CAST(sum(contacts) AS BIGINT) AS contacts, CAST(count(*) FILTER (contacts > 0) AS BIGINT) AS n_contacted, min(posted_date) AS first_post, max(posted_date) AS last_post, {rate('sum(contacts)', 'sum(views)')} AS contact_rate FROM im GROUP BY seller_id",
    "sd": "SELECT segment, seller_id, CAST(sum(is_qualified) AS BIGINT) AS n_qualified, CAST(sum(is_qualified_pos) AS BIGINT) AS n_positive FROM pd GROUP BY segment, seller_id HAVING sum(is_qualified) > 0",
    "sdall": "SELECT * FROM sd UNION ALL SELECT 'ALL', seller_id, CAST(sum(is_qualified) AS BIGINT), CAST(sum(is_qualified_pos) AS BIGINT) FROM pd GROUP BY seller_id HAVING sum(is_qualified) > 0",
    "pop2": """SELECT item_id, category, city_name, pos_28, round(3 * log10(1 + pos_7) + 2 * log10(1 + pos_28) + log10(1 + n_users) + 1.5::DOUBLE * coalesce(contacts / nullif(views, 0), 0) + CASE WHEN seller_type = 'private' THEN 0.25::DOUBLE ELSE 0 END + CASE WHEN age BETWEEN 0 AND 30 THEN 0.20::DOUBLE ELSE 0 END, 6) AS base_score
FROM (SELECT d.*, date_diff('day', posted_date, DATE '2024-01-28') AS age, coalesce(pos_all, 0) AS pos_all, coalesce(pos_7, 0) AS pos_7, coalesce(pos_28, 0) AS pos_28, coalesce(n_users, 0) AS n_users, coalesce(views, 0)::DOUBLE AS views, coalesce(contacts, 0)::DOUBLE AS contacts FROM dim d
 LEFT JOIN (SELECT item_id, count(*) AS pos_all, count(*) FILTER (date >= DATE '2024-01-28' - INTERVAL 7 DAY) AS pos_7, count(*) FILTER (date >= DATE '2024-01-28' - INTERVAL 28 DAY) AS pos_28, count(DISTINCT user_id) AS n_users FROM posev GROUP BY item_id) p USING (item_id)
 LEFT JOIN (SELECT item_id, sum(views_24h) AS views, sum(contacts_24h) AS contacts FROM snap WHERE date <= DATE '2024-01-28' GROUP BY item_id) s USING (item_id))
WHERE posted_date <= DATE '2024-01-28' AND expected_expired_date >= posted_date AND coalesce(expected_expired_date, DATE '2024-01-28') >= DATE '2024-01-28' - INTERVAL 60 DAY AND (pos_28 > 0 OR views > 0)""",
    "prof": """SELECT user_id, coalesce(n_pos, 0) AS n_pos, coalesce(n_items, 0) AS n_items, coalesce(n_days, 0) AS n_days, last_category, last_city, last_device, tc.category AS top_category, ty.city_name AS top_city_name, CASE WHEN coalesce(n_pos, 0) = 0 THEN '0_cold' WHEN n_pos <= 5 THEN '1_low' WHEN n_pos <= 50 THEN '2_mid' ELSE '3_high' END AS activity_tier
FROM usr LEFT JOIN (SELECT user_id, count(*) AS n_pos, count(DISTINCT item_id) AS n_items, count(DISTINCT date) AS n_days, arg_max(category, (event_us, event_id)) AS last_category, arg_max(city_name, (event_us, event_id)) AS last_city, arg_max(device, (event_us, event_id)) AS last_device FROM posev GROUP BY user_id) USING (user_id)
LEFT JOIN (SELECT user_id, category FROM posev GROUP BY user_id, category QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, max(event_us) DESC, category) = 1) tc USING (user_id)
LEFT JOIN (SELECT user_id, city_name FROM posev GROUP BY user_id, city_name QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, max(event_us) DESC, city_name) = 1) ty USING (user_id)""",
    "bs": """SELECT user_id, item_id, max(score) AS score, arg_max(source, (score, source)) AS source FROM (
 SELECT user_id, item_id, round(500 + base_score - rn * 0.01::DOUBLE, 6) AS score, 'global' AS source FROM usr, (SELECT *, row_number() OVER (ORDER BY base_score DESC, pos_28 DESC, item_id) AS rn FROM pop2 QUALIFY rn <= 10)
 UNION ALL SELECT user_id, item_id, round(800 + base_score - rn * 0.01::DOUBLE, 6), 'category' FROM prof JOIN (SELECT *, row_number() OVER (PARTITION BY category ORDER BY base_score DESC, pos_28 DESC, item_id) AS rn FROM pop2 QUALIFY rn <= 8) t ON t.category = coalesce(top_category, last_category)
 UNION ALL SELECT user_id, item_id, round(650 + base_score - rn * 0.01::DOUBLE, 6), 'city' FROM prof JOIN (SELECT *, row_number() OVER (PARTITION BY city_name ORDER BY base_score DESC, pos_28 DESC, item_id) AS rn FROM pop2 QUALIFY rn <= 6) t ON t.city_name = coalesce(top_city_name, last_city)
 UNION ALL SELECT user_id, item_id, round(1000 + base_score - rn * 0.01::DOUBLE, 6), 'cat_city' FROM prof JOIN (SELECT *, row_number() OVER (PARTITION BY category, city_name ORDER BY base_score DESC, pos_28 DESC, item_id) AS rn FROM pop2 QUALIFY rn <= 5) t ON t.category = coalesce(top_category, last_category) AND t.city_name = coalesce(top_city_name, last_city)) GROUP BY user_id, item_id""",
    "btop": "SELECT user_id, CAST(rk AS INTEGER) AS rank, item_id, score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rk FROM bs) WHERE rk <= 10",
}


def recall(pred: str, k: int = 10) -> str:
    return f"SELECT count(*) AS n_users, round(avg(coalesce(hits, 0) / g::DOUBLE), 6) AS recall, round(avg(coalesce(dcg, 0) / ideal), 6) AS ndcg FROM (SELECT user_id, count(DISTINCT item_id) AS g, list_sum([1 / log2(r + 1) FOR r IN range(1, least({k}, count(DISTINCT item_id)) + 1)]) AS ideal FROM gt GROUP BY user_id) LEFT JOIN (SELECT user_id, count(*) AS hits, sum(1 / log2(rank + 1)) AS dcg FROM {pred} JOIN gt USING (user_id, item_id) WHERE rank <= {k} GROUP BY user_id) USING (user_id)"


def shown(sub: str) -> str:
    return f"(SELECT s.user_id, s.item_id, s.rank, seller_id, seller_type, date_diff('day', posted_date, DATE '2024-01-28') AS age FROM {sub} s LEFT JOIN dim USING (item_id))"


def slots(x: str, key: str) -> str:
    return f"(SELECT gini FROM ({gini(f'SELECT count(*) AS c FROM {x} WHERE {key} IS NOT NULL GROUP BY {key}', 'c')}))"


def health(sub: str) -> str:
    x = shown(sub)
    top = lambda c: f"(SELECT round(100.0::DOUBLE * max(n) / sum(n), 6) FROM (SELECT count(*) AS n FROM {x} WHERE rank = 1 AND {c} IS NOT NULL GROUP BY {c}))"
    active = "(SELECT count(DISTINCT item_id) FROM idy WHERE date >= DATE '2024-01-28' - INTERVAL 30 DAY AND date < DATE '2024-01-28' AND weighted_score > 0)"
    return f"SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_distinct_items, count(DISTINCT seller_id) AS n_distinct_sellers, {active} AS n_active_items, round(100.0::DOUBLE * count(DISTINCT item_id) / greatest({active}, 1), 6) AS item_coverage_pct, {slots(x, 'item_id')} AS gini_item_exposure, {slots(x, 'seller_id')} AS gini_seller_exposure, round(100.0::DOUBLE * count(*) FILTER (age <= 7) / count(*), 6) AS fresh_slot_pct, round(100.0::DOUBLE * count(*) FILTER (seller_type = 'private') / count(seller_type), 6) AS private_slot_pct, round(100.0::DOUBLE * count(*) FILTER (seller_type = 'agent') / count(seller_type), 6) AS agent_slot_pct, (SELECT round(avg(v), 6) FROM (SELECT count(DISTINCT seller_id) AS v FROM {x} WHERE seller_id IS NOT NULL GROUP BY user_id)) AS avg_unique_sellers_per_user, {top('item_id')} AS top1_item_concentration_pct, {top('seller_id')} AS top1_seller_concentration_pct FROM {x}"


def variant(sub: str) -> str:
    x = shown(sub)
    pct = lambda c: f"round(100.0::DOUBLE * count(*) FILTER ({c}) / count(*), 6)"
    cover = lambda c: f"round(100.0::DOUBLE * count(DISTINCT {c}) / greatest((SELECT count(DISTINCT {c}) FROM dim), 1), 6)"
    private, agent = "seller_type = 'private'", "seller_type = 'agent'"
    return f"SELECT count(DISTINCT user_id) AS n_users_with_recs, count(DISTINCT item_id) AS n_distinct_items_recommended, count(DISTINCT seller_id) AS n_distinct_sellers_recommended, {cover('item_id')} AS item_coverage_pct, {cover('seller_id')} AS seller_coverage_pct, {slots(x, 'item_id')} AS gini_item_exposure, {slots(x, 'seller_id')} AS gini_seller_exposure, {pct('age <= 7')} AS fresh_slot_pct, {pct(private)} AS private_slot_pct, {pct(agent)} AS agent_slot_pct FROM {x}"


def share(n: str, over: str = "") -> str:
    return f"round(100.0::DOUBLE * {n} / sum({n}) OVER ({over}), 2)"


PART = "round(sum(CASE WHEN rn <= {k} THEN {v} ELSE 0 END)::DOUBLE / nullif(sum({v})::DOUBLE, 0), 6)"


def tops(v: str) -> str:
    return ", ".join(f"{PART.format(k=k, v=v)} AS {n}" for k, n in (("10", "top10_share"), ("greatest(1, n // 100)", "top1pct_share"), ("greatest(1, n // 10)", "top10pct_share")))


VARIANTS = (("baseline_popularity", "btop"), ("rank_only", "raw"), ("rank_rerank", "greedy"))
GROUP3 = f"CASE WHEN event_type = 'pageview' THEN 'pageview' WHEN event_type IN {HARD} THEN 'direct_contact' ELSE 'other_interaction' END"
Q = {
    "user_daily": "SELECT * FROM ud",
    "item_daily": "SELECT * REPLACE (round(avg_dwell, 6) AS avg_dwell) FROM idy",
    "user_item_daily": "SELECT * FROM uid",
    "user_category": "SELECT * FROM ucat",
    "user_category_whole_window": f"SELECT user_id, category, {NPOS} AS n_pos_events, sum({W}) AS weighted_score, count(DISTINCT item_id) AS n_unique_items FROM ev WHERE {WIN} GROUP BY user_id, category HAVING sum({W}) > 0",
    "user_city": "SELECT * FROM ucity",
    "event_type_daily": f"SELECT date, event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM ev WHERE {WIN} GROUP BY date, event_type",
    "event_share": f"SELECT event_type, count(*) AS n, {share('count(*)')} AS pct FROM ev WHERE {WIN} GROUP BY event_type",
    "clean_dim": f"SELECT item_id, seller_id, category, seller_type, ad_type, CASE WHEN lower(direction) IN ('đông bắc', 'dong bac', 'đông - bắc', 'db', 'đb') THEN 'Đông Bắc' WHEN lower(direction) IN ('đông nam', 'dong nam', 'đông - nam', 'dn', 'đn') THEN 'Đông Nam' WHEN lower(direction) IN ('tây bắc', 'tay bac', 'tây - bắc', 'tb') THEN 'Tây Bắc' WHEN lower(direction) IN ('tây nam', 'tay nam', 'tây - nam', 'tn') THEN 'Tây Nam' WHEN lower(direction) IN ('đông', 'dong') THEN 'Đông' WHEN lower(direction) IN ('tây', 'tay') THEN 'Tây' WHEN lower(direction) = 'nam' THEN 'Nam' WHEN lower(direction) IN ('bắc', 'bac') THEN 'Bắc' ELSE {NONE} END AS direction_clean, coalesce(city_name, {NONE}) AS city_name_clean, coalesce(district_name, {NONE}) AS district_name_clean, coalesce(price_bucket, {NONE}) AS price_bucket_clean, area_sqm, project_id IS NOT NULL AS has_project, posted_date, expected_expired_date, CAST(date_diff('day', posted_date, expected_expired_date) AS INTEGER) AS listing_lifetime_days, posted_date > DATE '2024-01-28' AS is_post_train_end, expected_expired_date < posted_date AS is_expire_before_post FROM dim",
    "clean_snapshot": "SELECT item_id, date, views_24h::DOUBLE AS views_24h, contacts_24h::DOUBLE AS contacts_24h, greatest(listing_age_days, 0)::DOUBLE AS listing_age_days, views_24h IS NULL AS views_was_null, contacts_24h IS NULL AS contacts_was_null FROM snap WHERE date <= DATE '2024-01-28'",
    "clean_interactions": "SELECT *, lead_count > 0 AS has_lead FROM inter WHERE date <= DATE '2024-01-28'",
    "clean_events": "SELECT * FROM posev",
    "reengagement": "SELECT * FROM reeng",
    "covisit_matrix": "SELECT * FROM matrix",
    "covisit_candidates": "SELECT * FROM covis",
    "category_pop": "SELECT * FROM catpop",
    "city_cat_pop": "SELECT * FROM cellpop",
    "global_pop": "SELECT * FROM globpop",
    "merge_candidates": "SELECT * FROM pool",
    "user_features": "SELECT * FROM uf",
    "item_features": "SELECT * FROM itf",
    "pair_features": "SELECT * FROM pf",
    "temporal_features": "SELECT * FROM tf",
    "ranker_input": "SELECT * FROM rin",
    "feature_diagnostics": "SELECT CAST(count(*) FILTER (u_top_category_share >= 0.9) AS BIGINT) AS n_loyal, CAST(count(*) FILTER (u_top_category_share <= 0.6) AS BIGINT) AS n_cross, CAST(count(*) FILTER (u_unique_categories > 1) AS BIGINT) AS n_multi_category, count(*) AS n_users FROM uf",
    "internal_gt": "SELECT * FROM gt",
    "graded_labels": "SELECT * FROM lab",
    "negative_sample": "SELECT user_id, item_id, label FROM (SELECT *, row_number() OVER (PARTITION BY user_id, label > 0 ORDER BY sample_key, item_id) AS rn, sum(CAST(label > 0 AS INTEGER)) OVER (PARTITION BY user_id) AS n_pos FROM lab) WHERE n_pos > 0 AND (label > 0 OR rn <= n_pos * 10)",
    "user_split": "SELECT user_id, CAST(('0x' || substr(md5(concat_ws('|', CAST(user_id AS VARCHAR), '42')), 1, 6))::BIGINT < 1677721 AS INTEGER) AS is_val FROM (SELECT DISTINCT user_id FROM ud)",
    "group_sizes": "SELECT user_id, count(*) AS group_size FROM pool GROUP BY user_id",
    "linear_scores": "SELECT * FROM sc",
    "rerank_raw": "SELECT * FROM raw",
    "rerank_health": "SELECT * FROM rr",
    "greedy_rerank": "SELECT * FROM greedy",
    "submission": "SELECT * FROM sub",
    "submission_checks": "SELECT *, n_users_repeated_rank = 0 AND n_users_repeated_item = 0 AND n_bad_ranks = 0 AND n_unknown_users = 0 AND n_unknown_items = 0 AND max_rows_per_user <= 10 AS is_valid FROM (SELECT count(*) AS n_rows, CAST(count(*) FILTER (rank < 1 OR rank > 10) AS BIGINT) AS n_bad_ranks, (SELECT max(n) FROM (SELECT count(*) AS n FROM sub GROUP BY user_id)) AS max_rows_per_user, CAST(min(rank) AS BIGINT) AS min_rank, CAST(max(rank) AS BIGINT) AS max_rank, CAST(count(*) FILTER (user_id IS NULL OR item_id IS NULL OR rank IS NULL) AS BIGINT) AS n_nulls, (SELECT CAST(count(*) FILTER (n <> 10) AS BIGINT) FROM (SELECT count(*) AS n FROM sub GROUP BY user_id)) AS n_users_bad_size, (SELECT CAST(count(*) FILTER (n <> m) AS BIGINT) FROM (SELECT count(*) AS n, count(DISTINCT rank) AS m FROM sub GROUP BY user_id)) AS n_users_repeated_rank, (SELECT CAST(count(*) FILTER (n <> m) AS BIGINT) FROM (SELECT count(*) AS n, count(DISTINCT item_id) AS m FROM sub GROUP BY user_id)) AS n_users_repeated_item, (SELECT count(*) FROM (SELECT user_id FROM sub EXCEPT SELECT user_id FROM usr)) AS n_unknown_users, (SELECT count(*) FROM (SELECT user_id FROM usr EXCEPT SELECT user_id FROM sub)) AS n_missing_users, (SELECT count(*) FROM (SELECT item_id FROM sub EXCEPT SELECT item_id FROM dim)) AS n_unknown_items, (SELECT count(*) * 10 FROM usr) AS n_rows_expected FROM sub)",
    "recall_ndcg": recall("raw"),
    "candidate_recall": "SELECT count(*) AS n_pairs, " + ", ".join(f"round(avg(CASE WHEN r <= {k} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS hit_at_{k}" for k in (5, 10, 20)) + " FROM gt LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY candidate_score DESC, source_score DESC, item_id) AS r FROM pool) USING (user_id, item_id)",
    "source_breakdown": "SELECT source, count(*) AS n, count(DISTINCT p.user_id) AS n_users, CAST(count(gt_n_events) AS BIGINT) AS hits, round(100.0::DOUBLE * count(gt_n_events) / count(*), 6) AS hit_pct FROM pool p LEFT JOIN gt USING (user_id, item_id) GROUP BY source",
    "marketplace_health": health("sub"),
    "variant_comparison": " UNION ALL ".join(f"SELECT *, '{v}' AS variant FROM ({recall(s)}), ({variant(s)})" for v, s in VARIANTS),
    "variant_deltas": "SELECT round(a.recall - b.recall, 6) AS delta_recall, round(a.gini_item_exposure - b.gini_item_exposure, 6) AS delta_gini_item, round(a.fresh_slot_pct - b.fresh_slot_pct, 6) AS delta_fresh_pp FROM " + ", ".join(f"(SELECT * FROM ({recall(s)}), ({variant(s)})) {alias}" for alias, s in (("a", "greedy"), ("b", "raw"))),
    "item_popularity": "SELECT * FROM pop2",
    "user_profile": "SELECT * FROM prof",
    "baseline_top10": "SELECT * FROM btop",
    "baseline_health": "SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, count(DISTINCT seller_id) AS n_sellers, round(100 * avg(CASE WHEN seller_type = 'private' THEN 1.0::DOUBLE ELSE 0 END), 6) AS private_pct, round(100 * avg(CASE WHEN date_diff('day', posted_date, DATE '2024-01-28') BETWEEN 0 AND 30 THEN 1.0::DOUBLE ELSE 0 END), 6) AS fresh_pct FROM btop LEFT JOIN dim USING (item_id)",
    "eda_01_category_supply": "SELECT category, count(*) AS n_listings, count(DISTINCT seller_id) AS n_sellers FROM dim GROUP BY category",
    "eda_02_city_supply": "SELECT city_name, count(*) AS n_listings, count(DISTINCT seller_id) AS n_sellers FROM dim GROUP BY city_name ORDER BY n_listings DESC, city_name LIMIT 20",
    "eda_03_category_demand": "SELECT category, count(*) AS n_events, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM posev GROUP BY category",
    "eda_04_city_demand": "SELECT city_name, count(*) AS n_events, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM posev GROUP BY city_name ORDER BY n_events DESC, city_name LIMIT 20",
    "eda_05_weekly_events": "SELECT CAST(date_trunc('week', date) AS DATE) AS week, count(*) AS n_events, count(DISTINCT user_id) AS wau, count(DISTINCT item_id) AS n_items FROM posev GROUP BY week",
    "eda_06_cold_start": f"SELECT has_positive, has_interaction, count(*) AS n_users, {share('count(*)')} AS pct FROM (SELECT user_id IN (SELECT user_id FROM posev) AS has_positive, user_id IN (SELECT user_id FROM inter) AS has_interaction FROM usr) GROUP BY ALL",
    "eda_07_interaction_tier": f"SELECT user_tier, count(*) AS n_users, {share('count(*)')} AS pct FROM (SELECT CASE WHEN n = 0 THEN '0_zero_history' WHEN n <= 5 THEN '1_low_1_5' WHEN n <= 20 THEN '2_mid_6_20' WHEN n <= 100 THEN '3_high_21_100' ELSE '4_heavy_100+' END AS user_tier FROM (SELECT u.user_id, count(i.item_id) AS n FROM usr u LEFT JOIN (SELECT * FROM inter WHERE date <= DATE '2024-01-28') i ON i.user_id = u.user_id GROUP BY u.user_id)) GROUP BY user_tier",
    "eda_08_event_types": f"SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, {share('count(*)')} AS pct FROM posev GROUP BY event_type",
    "eda_09_session_tier": f"SELECT session_tier, count(*) AS n_sessions, {share('count(*)')} AS pct FROM (SELECT CASE WHEN count(*) = 1 THEN '1_single' WHEN count(*) <= 5 THEN '2_short_2_5' WHEN count(*) <= 20 THEN '3_medium_6_20' WHEN count(*) <= 100 THEN '4_long_21_100' ELSE '5_very_long_100+' END AS session_tier FROM posev GROUP BY session_id) GROUP BY session_tier",
    "eda_10_weekly_market": f"SELECT CAST(date_trunc('week', date) AS DATE) AS week, sum(v) AS views, sum(c) AS contacts, round(avg(a), 6) AS mean_daily_active, {rate('sum(c)', 'sum(v)')} AS contact_rate FROM (SELECT date, sum(greatest(coalesce(views_24h::DOUBLE, 0), 0)) AS v, sum(greatest(coalesce(contacts_24h::DOUBLE, 0), 0)) AS c, count(DISTINCT item_id) AS a FROM snap WHERE date <= DATE '2024-01-28' GROUP BY date) GROUP BY week",
    "pair_flags": "SELECT * FROM pr",
    "d30_funnel": f"SELECT *, round(100 * n2_qualified::DOUBLE / nullif(n1_pairs, 0), 6) AS qualified_pct, round(100 * n3_positive_inside::DOUBLE / nullif(n2_qualified, 0), 6) AS contact_rate_pct, round(100 * n3_direct_inside::DOUBLE / nullif(n2_qualified, 0), 6) AS direct_rate_pct, round(100 * n3_positive_all::DOUBLE / nullif(n1_pairs, 0), 6) AS total_positive_pct FROM (SELECT CAST(count(*) FILTER (n_pageview > 0) AS BIGINT) AS n1_pairs, CAST(sum(is_qualified) AS BIGINT) AS n2_qualified, CAST(count(*) FILTER (n_pos > 0) AS BIGINT) AS n3_positive_all, CAST(count(*) FILTER (n_direct > 0) AS BIGINT) AS n3_direct_all, CAST(sum(is_qualified_pos) AS BIGINT) AS n3_positive_inside, CAST(count(*) FILTER (is_qualified = 1 AND n_direct > 0) AS BIGINT) AS n3_direct_inside FROM pr)",
    "daily_counts": f"SELECT *, {rate('positives', 'pageviews')} AS positive_intensity, {rate('directs', 'pageviews')} AS direct_intensity FROM (SELECT date, {NPV} AS pageviews, {NPOS} AS positives, {NHARD} AS directs FROM ev WHERE {WIN} GROUP BY date)",
    "daily_pair_rates": f"SELECT *, round(avg(rate) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rate_7 FROM (SELECT date, count(*) AS viewed_pairs, CAST(sum(p) AS BIGINT) AS converted_pairs, {rate('sum(p)', 'count(*)')} AS rate FROM (SELECT date, user_id, item_id, max(CAST(event_type IN {POS} AS INTEGER)) AS p FROM ev WHERE {WIN} GROUP BY ALL HAVING bool_or(event_type = 'pageview')) GROUP BY date)",
    "dwell_quantiles": f"SELECT count(*) AS n, round(quantile_cont(d, 0.25), 6) AS q25, round(quantile_cont(d, 0.5), 6) AS q50, round(quantile_cont(d, 0.75), 6) AS q75 FROM (SELECT {DWELL} AS d, event_type, us, min(CASE WHEN event_type IN {POS} THEN us END) OVER (PARTITION BY session_id) AS f FROM ev WHERE {WIN}) WHERE event_type = 'pageview' AND d IS NOT NULL AND us <= f",
    "user_positives": f"SELECT user_id, count(*) AS n_events, count(DISTINCT item_id) AS n_items, count(DISTINCT date) AS n_days FROM ev WHERE {WIN} AND event_type IN {POS} AND is_login = 'login' GROUP BY user_id",
    "cold_start_segments": f"SELECT user_segment, count(*) AS n_users, {share('count(*)')} AS pct FROM (SELECT CASE WHEN v = 0 AND p = 0 THEN '0_no_history' WHEN v > 0 AND p = 0 THEN '1_browser_only' WHEN v = 0 AND p > 0 THEN '2_positive_no_pageview' ELSE '3_warm_with_positive' END AS user_segment FROM (SELECT user_id, coalesce(v, 0) AS v, coalesce(p, 0) AS p FROM usr LEFT JOIN (SELECT user_id, {NPV} AS v, {NPOS} AS p FROM ev WHERE {WIN} AND is_login = 'login' GROUP BY user_id) USING (user_id))) GROUP BY user_segment",
    "gap_hours": "SELECT count(*) AS n, round(quantile_cont(g, 0.5), 6) AS median_hours, round(avg(g), 6) AS mean_hours FROM (SELECT (first_pos_us - first_view_us) / 3.6e9::DOUBLE AS g FROM pr) WHERE g >= 0",
    "category_heatmap": f"SELECT view_category, contact_category, count(*) AS n_users, {share('count(*)', 'PARTITION BY view_category')} AS row_pct FROM (SELECT user_id, category AS view_category FROM hm WHERE v > 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY v DESC, category) = 1) JOIN (SELECT user_id, category AS contact_category FROM hm WHERE p > 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY p DESC, category) = 1) USING (user_id) GROUP BY view_category, contact_category",
    "device_surface": f"SELECT device, replace(surface, 'adview', 'ad_view') AS surface, event_type, count(*) AS n FROM ev WHERE {WIN} GROUP BY ALL",
    "item_metrics": "SELECT * FROM im",
    "seller_metrics": "SELECT * FROM sm",
    "cr_by_category": cr("pd", "category"),
    "cr_by_ad_seller": cr("pd", "ad_type, seller_type"),
    "snapshot_cr_category": f"SELECT category, count(*) AS n_items, CAST(sum(views) AS BIGINT) AS views, CAST(sum(contacts) AS BIGINT) AS contacts, {rate('sum(contacts)', 'sum(views)')} AS rate FROM im GROUP BY category",
    "snapshot_cr_ad_seller": f"SELECT ad_type, seller_type, count(*) AS n_items, CAST(sum(views) AS BIGINT) AS views, CAST(sum(contacts) AS BIGINT) AS contacts, {rate('sum(contacts)', 'sum(views)')} AS rate FROM im GROUP BY ALL",
    "age_decay": f"SELECT CASE WHEN avg_age <= 3 THEN '00_0-3' WHEN avg_age <= 7 THEN '01_4-7' WHEN avg_age <= 14 THEN '02_8-14' WHEN avg_age <= 30 THEN '03_15-30' WHEN avg_age <= 60 THEN '04_31-60' WHEN avg_age <= 90 THEN '05_61-90' WHEN avg_age <= 180 THEN '06_91-180' ELSE '07_180+' END AS age_bin, count(*) AS n_items, CAST(sum(views) AS BIGINT) AS views, CAST(sum(contacts) AS BIGINT) AS contacts, {rate('sum(contacts)', 'sum(views)')} AS rate FROM im GROUP BY age_bin",
    "image_sample": "SELECT image_bucket, item_id, views, contacts, contact_rate FROM (SELECT *, CASE WHEN images_count IS NULL THEN 'unknown' WHEN images_count <= 2 THEN '00_0-2' WHEN images_count <= 5 THEN '01_3-5' WHEN images_count <= 10 THEN '02_6-10' WHEN images_count <= 15 THEN '03_11-15' ELSE '04_16+' END AS image_bucket FROM im WHERE views >= 10 AND contact_rate IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY image_bucket ORDER BY item_id) <= 5000",
    "geo_top": f"SELECT city_name, district_name, count(*) AS n_items, CAST(sum(views) AS BIGINT) AS views, CAST(sum(contacts) AS BIGINT) AS contacts, {rate('sum(contacts)', 'sum(views)')} AS rate FROM im WHERE district_name IS NOT NULL AND district_name <> {NONE} GROUP BY city_name, district_name ORDER BY contacts DESC, city_name, district_name LIMIT 20",
    "seller_cohort": f"SELECT CASE WHEN first_post >= DATE '2023-12-10' THEN 'new_seller' ELSE 'established_seller' END AS seller_cohort, CAST(date_trunc('week', posted_date) AS DATE) AS week, count(*) AS n_listings, CAST(sum(views) AS BIGINT) AS views, CAST(sum(contacts) AS BIGINT) AS contacts, {rate('sum(contacts)', 'sum(views)')} AS rate FROM im JOIN (SELECT seller_id, min(posted_date) AS first_post FROM im WHERE posted_date IS NOT NULL GROUP BY seller_id) USING (seller_id) WHERE posted_date IS NOT NULL GROUP BY ALL",
    "segment_audit": f"SELECT {SEG} AS segment, seller_type, category, count(*) AS n_items, count(DISTINCT seller_id) AS n_sellers FROM dim GROUP BY ALL",
    "segment_overall": f"SELECT * FROM ({cr('pd', 'segment')}) JOIN (SELECT segment, count(DISTINCT user_id) FILTER (is_qualified = 1) AS n_users, count(DISTINCT item_id) FILTER (is_qualified = 1) AS n_items, count(DISTINCT seller_id) FILTER (is_qualified = 1) AS n_sellers FROM pd GROUP BY segment) USING (segment)",
    "segment_volume": f"SELECT *, {share('n_qualified', 'PARTITION BY segment')} AS volume_pct FROM ({cr('pd', 'segment, ad_type, seller_type')})",
    "segment_category": cr("pd", "segment, category"),
    "seller_distribution": "SELECT * FROM sd",
    "segment_gini": f"SELECT * FROM (SELECT segment, gini FROM ({gini('SELECT * FROM sdall', 'n_positive', 'segment')})) JOIN (SELECT segment, count(*) AS n, {tops('n_positive')} FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY n_positive DESC, seller_id) AS rn, count(*) OVER (PARTITION BY segment) AS n FROM sdall) GROUP BY segment) USING (segment)",
    "snapshot_gini": gini("SELECT segment, seller_id, sum(contacts) AS contacts FROM im GROUP BY segment, seller_id", "contacts", "segment"),
    "segment_comparison": f"UNPIVOT (SELECT segment, n_pairs::DOUBLE AS n_pairs, n_qualified::DOUBLE AS n_qualified, n_positive::DOUBLE AS n_positive, rate, n_users::DOUBLE AS n_users, n_items::DOUBLE AS n_items, n_sellers::DOUBLE AS n_sellers FROM ({cr('pd', 'segment')}) JOIN (SELECT segment, count(DISTINCT user_id) FILTER (is_qualified = 1) AS n_users, count(DISTINCT item_id) FILTER (is_qualified = 1) AS n_items, count(DISTINCT seller_id) FILTER (is_qualified = 1) AS n_sellers FROM pd GROUP BY segment) USING (segment)) ON n_pairs, n_qualified, n_positive, rate, n_users, n_items, n_sellers INTO NAME metric VALUE value",
    "gini_item_contacts": gini("SELECT contacts FROM im", "contacts"),
    "lorenz_items": "SELECT DISTINCT x, round(count(*) OVER (ORDER BY x) / count(*) OVER ()::DOUBLE, 6) AS cum_sellers, round(sum(x) OVER (ORDER BY x) / nullif(sum(x) OVER (), 0), 6) AS cum_value FROM (SELECT contacts::DOUBLE AS x FROM im)",
    "top_share_items": f"SELECT count(*) AS n, {tops('contacts')} FROM (SELECT *, row_number() OVER (ORDER BY contacts DESC, item_id) AS rn, count(*) OVER () AS n FROM im)",
    "slide_core": f"SELECT *, {rate('pairs_q', 'pairs')} AS q_rate, {rate('pairs_p', 'pairs_q')} AS cr, {rate('users_p', 'users_q')} AS user_cr, {rate('items_p', 'items_q')} AS item_cr FROM (SELECT count(*) AS pairs, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items, count(DISTINCT seller_id) AS sellers, count(DISTINCT user_id) FILTER (is_qualified = 1) AS users_q, count(DISTINCT item_id) FILTER (is_qualified = 1) AS items_q, count(DISTINCT user_id) FILTER (is_qualified_pos = 1) AS users_p, count(DISTINCT item_id) FILTER (is_qualified_pos = 1) AS items_p, CAST(sum(is_qualified) AS BIGINT) AS pairs_q, CAST(sum(is_qualified_pos) AS BIGINT) AS pairs_p FROM pd)",
    "dwell_hist": f"SELECT CASE WHEN d < 5 THEN '0-5s' WHEN d < 10 THEN '5-10s' WHEN d < 30 THEN '10-30s' WHEN d < 60 THEN '30-60s' WHEN d < 180 THEN '1-3m' WHEN d < 600 THEN '3-10m' ELSE '10m+' END AS bin_label, count(*) AS pairs, CAST(sum(is_qualified_pos) AS BIGINT) AS positive_pairs, {rate('sum(is_qualified_pos)', 'count(*)')} AS positive_rate FROM (SELECT *, coalesce(max_dwell, 0) AS d FROM pr WHERE n_pageview > 0) GROUP BY bin_label",
    "audit_surface": f"SELECT *, {share('n', 'PARTITION BY event_group')} AS pct FROM (SELECT {GROUP3} AS event_group, surface AS value, count(*) AS n FROM ev WHERE {WIN} GROUP BY ALL)",
    "audit_device": f"SELECT *, {share('n', 'PARTITION BY event_group')} AS pct FROM (SELECT {GROUP3} AS event_group, device AS value, count(*) AS n FROM ev WHERE {WIN} GROUP BY ALL)",
    "audit_dwell": f"SELECT event_group, count(*) AS n_events, count(d) AS n_with_dwell, round(100.0::DOUBLE * count(*) FILTER (d = 0) / count(d), 6) AS zero_pct, round(100.0::DOUBLE * count(*) FILTER (d < 5) / count(d), 6) AS lt5_pct, round(100.0::DOUBLE * count(*) FILTER (d < 30) / count(d), 6) AS lt30_pct, round(quantile_cont(d, 0.5), 6) AS median, round(quantile_cont(d, 0.75), 6) AS p75, round(quantile_cont(d, 0.95), 6) AS p95 FROM (SELECT {GROUP3} AS event_group, CASE WHEN dwell_time_sec IS NOT NULL THEN least(greatest(dwell_time_sec, 0), 3600) END AS d FROM ev WHERE {WIN}) GROUP BY event_group",
    "audit_session": f"SELECT event_group, count(*) AS n_sessions, round(quantile_cont(n, 0.5), 6) AS median_events, round(avg(n), 6) AS mean_events, round(quantile_cont(n, 0.95), 6) AS p95_events, max(n) AS max_events FROM (SELECT session_id, {GROUP3} AS event_group, count(*) AS n FROM ev WHERE {WIN} GROUP BY ALL) GROUP BY event_group",
    "audit_dc_cr": f"SELECT *, round(100 * (1 - n_direct::DOUBLE / nullif(n_full, 0)), 6) AS drop_pct FROM (SELECT count(*) AS n_qualified, CAST(count(*) FILTER (p > 0) AS BIGINT) AS n_full, CAST(count(*) FILTER (k > 0) AS BIGINT) AS n_direct FROM (SELECT max(CASE WHEN event_type = 'pageview' THEN least(greatest(coalesce(dwell_time_sec, 0), 0), 3599.999::DOUBLE) END) AS d, {NPOS} AS p, {NHARD} AS k FROM ev WHERE {WIN} GROUP BY user_id, item_id) WHERE d >= 30)",
    "audit_flag_crosstab": "SELECT event_type, CAST(count(*) FILTER (is_contact = 0) AS BIGINT) AS flag_0, CAST(count(*) FILTER (is_contact = 1) AS BIGINT) AS flag_1 FROM ev GROUP BY event_type",
    "exposure_vs_cr": f"SELECT *, {share('n_pairs')} AS exposure_pct, round(n_pairs / n_listings::DOUBLE, 2) AS pageview_per_listing, round(n_qualified / n_listings::DOUBLE, 2) AS qualified_per_listing, round(100 * n_qualified / n_pairs::DOUBLE, 2) AS qualifying_rate_pct, round(100 * n_positive / nullif(n_qualified, 0)::DOUBLE, 2) AS cr_d30_pct FROM ({cr('pd', 'seller_type')}) JOIN (SELECT seller_type, count(DISTINCT item_id) AS n_listings FROM pd GROUP BY seller_type) USING (seller_type)",
    "segment_seller_crosstab": "SELECT coalesce(segment, 'Total') AS segment, CAST(count(*) FILTER (seller_type = 'private') AS BIGINT) AS private, CAST(count(*) FILTER (seller_type = 'agent') AS BIGINT) AS agent, count(*) AS total FROM pd GROUP BY ROLLUP (segment)",
    "verify_slices": " UNION ALL ".join(f"SELECT '{b}' AS slice, CAST(sum(q) AS BIGINT) AS sum_qualified, CAST(sum(p) AS BIGINT) AS sum_positive, sum(q) = (SELECT sum(is_qualified) FROM pr) AS qualified_ok, sum(p) = (SELECT sum(is_qualified_pos) FROM pr) AS positive_ok FROM (SELECT {b}, sum(is_qualified) AS q, sum(is_qualified_pos) AS p FROM pd GROUP BY {b})" for b in ("category", "seller_type", "segment")),
}


def checks(rows: list[tuple[str, str, str, str]]) -> str:
    """check, value, status and source of each check."""
    return " UNION ALL ".join(f"SELECT '{name}' AS \"check\", round(({value})::DOUBLE, 6) AS value, {status} AS status FROM ({source})" for name, value, status, source in rows)


def fails(cond: str, otherwise: str = "OK") -> str:
    return f"CASE WHEN {cond} THEN 'FAIL' ELSE '{otherwise}' END"


def summed(x: str) -> str:
    return f"SELECT *, (n2 - q) * 100.0::DOUBLE / greatest(n2, 1) AS lost2, (n3 - p) * 100.0::DOUBLE / greatest(n3, 1) AS lost3 FROM (SELECT sum(n_qualified) AS q, sum(n_positive) AS p, 100.0::DOUBLE * sum(rate * n_qualified) FILTER (n_qualified > 0) / nullif(sum(n_qualified) FILTER (n_qualified > 0), 0) AS mean_pct, count(*) FILTER (rate IS NULL) AS n_null, count(*) FILTER (rate < 0 OR rate > 1) AS n_outside, max(rate) AS most FROM ({x})), (SELECT n2_qualified AS n2, n3_positive_inside AS n3, contact_rate_pct AS whole_pct FROM ({Q['d30_funnel']}))"


def band(whole: str, part: str, lost: str) -> str:
    return f"CASE WHEN abs({whole} - {part}) <= 1 THEN 'OK' WHEN abs({lost}) > 10 THEN 'FAIL' WHEN abs({lost}) > 3 THEN 'WARN' ELSE 'OK' END"


def d30_checks() -> str:
    cat, combo = summed(cr("pd", "category")), summed(cr("pd WHERE ad_type IS NOT NULL AND seller_type IS NOT NULL", "ad_type, seller_type"))
    rows = [
        ("category_qualified_missing_pct", "lost2", band("n2", "q", "lost2"), cat),
        ("category_positive_missing_pct", "lost3", band("n3", "p", "lost3"), cat),
        ("ad_seller_qualified_missing_pct", "lost2", fails("lost2 > 10"), combo),
        ("category_weighted_mean_diff_pp", "whole_pct - mean_pct", fails("coalesce(abs(whole_pct - mean_pct) > 0.1, true)"), cat),
    ]
    for name, x in (("category", cat), ("ad_seller", combo)):
        rows += [
            (f"{name}_null_rates", "n_null", fails("n_null > 0"), x),
            (f"{name}_rates_outside_0_1", "n_outside", fails("n_outside > 0"), x),
            (f"{name}_most_against_whole", "most * 100 / whole_pct", "CASE WHEN most * 100 > 3 * whole_pct THEN 'WARN' ELSE 'OK' END", x),
        ]
    return checks(rows)


PROXY = "SELECT category, count(*) AS n_listings, CAST(count(project_id) AS BIGINT) AS n_with_project_id, CAST(count(*) FILTER (category = 1050 OR project_id IS NOT NULL) AS BIGINT) AS n_b2b, CAST(count(*) FILTER (NOT (category = 1050 OR project_id IS NOT NULL)) AS BIGINT) AS n_c2c, round(100 * count(project_id) / count(*)::DOUBLE, 6) AS pct_with_project_id, round(100 * count(*) FILTER (category = 1050 OR project_id IS NOT NULL) / count(*)::DOUBLE, 6) AS pct_b2b FROM dim GROUP BY category"


def segment_checks() -> str:
    audit = f"SELECT sum(n_listings) AS n, sum(n_b2b) AS b, sum(n_c2c) AS c, 100 * sum(CASE WHEN category <> 1050 THEN n_with_project_id ELSE 0 END) / greatest(sum(n_listings), 1)::DOUBLE AS hidden FROM ({PROXY})"
    s = summed(cr("pd", "segment"))
    outside = lambda q, c, top: f"SELECT count(*) FILTER (NOT coalesce({c} >= 0 AND {c} <= {top}, false)) AS n FROM ({q})"
    volume = lambda name: f"SELECT coalesce(sum(is_qualified) FILTER (segment = '{name}'), 0) AS q FROM pd"
    return checks([
        ("listings_outside_segments", "n - b - c", fails("b + c <> n"), audit),
        ("hidden_b2b_pct", "hidden", "CASE WHEN hidden > 1 THEN 'WARN' ELSE 'OK' END", audit),
        ("segment_qualified_missing_pct", "lost2", fails("lost2 > 5"), s),
        ("segment_weighted_mean_diff_pp", "whole_pct - mean_pct", fails("coalesce(abs(whole_pct - mean_pct) > 0.5, true)"), s),
        *((f"{name}_qualified", "q", fails("q = 0"), volume(name)) for name in ("B2B", "C2C")),
        ("segment_rates_outside_0_1", "n", fails("n > 0"), outside(cr("pd", "segment"), "rate", 1)),
        ("segment_ginis_outside_0_1", "n", fails("n > 0"), outside(Q["segment_gini"], "gini", 1)),
        ("volume_shares_outside_0_1", "n", fails("n > 0"), outside(Q["segment_volume"], "volume_pct", 100.01)),
    ])


def verdicts() -> str:
    one = lambda angle, q, verdict: f"SELECT '{angle}' AS angle, round(v::DOUBLE, 6) AS value, {verdict} AS verdict FROM ({q}) WHERE v IS NOT NULL"
    group = "event_group = 'other_interaction'"
    rows = " UNION ALL ".join([
        one("A1_surface", f"SELECT max(pct) AS v FROM ({Q['audit_surface']}) WHERE {group}", "CASE WHEN v > 50 THEN 'concentrated' WHEN v > 25 THEN 'partial' ELSE 'spread' END"),
        one("B1_dwell", f"SELECT zero_pct AS v FROM ({Q['audit_dwell']}) WHERE {group}", "CASE WHEN v > 80 THEN 'noise_signal' WHEN v < 30 THEN 'real_engagement' ELSE 'mixed' END"),
        one("B2_session_freq", f"SELECT max(median_events) FILTER ({group}) / greatest(max(median_events) FILTER (event_group = 'direct_contact'), 0.5) AS v FROM ({Q['audit_session']})", "CASE WHEN v > 5 THEN 'noise_signal' ELSE 'normal' END"),
        one("C_dc_only_cr", f"SELECT drop_pct AS v FROM ({Q['audit_dc_cr']})", "CASE WHEN v > 80 THEN 'story_collapses' WHEN v < 30 THEN 'story_holds' ELSE 'story_partial' END"),
        one("D_is_contact_flag", f"SELECT 100.0::DOUBLE * flag_1 / (flag_0 + flag_1) AS v FROM ({Q['audit_flag_crosstab']}) WHERE event_type = 'other_interaction'", "CASE WHEN v > 90 THEN 'btc_treats_as_contact' WHEN v > 30 AND v < 90 THEN 'btc_inconsistent' ELSE 'btc_not_contact' END"),
    ])
    return f"WITH vs AS ({rows}), calls AS (SELECT count(*) FILTER (verdict IN ('noise_signal', 'story_collapses', 'btc_not_contact')) AS bad, count(*) FILTER (verdict IN ('real_engagement', 'story_holds', 'btc_treats_as_contact')) AS good FROM vs) SELECT * FROM vs UNION ALL SELECT 'final_call', (good - bad)::DOUBLE, CASE WHEN bad = 0 AND good >= 2 THEN 'keep' WHEN bad >= 2 THEN 'change' ELSE 'mixed' END FROM calls"


def summary() -> str:
    one = lambda branch, metric, value, text, q: f"SELECT '{branch}' AS branch, {metric} AS metric, round(({value})::DOUBLE, 6) AS value, '{text}' AS description FROM ({q})"
    f, cat, seg, con = Q["d30_funnel"], f"SELECT * FROM ({cr('pd', 'category')}) WHERE rate IS NOT NULL ORDER BY rate DESC, category LIMIT 1", cr("pd", "segment"), Q["segment_gini"]
    a1 = (("N1_pageview_pairs", "n1_pairs", "pairs of user and item with a page view"), ("N2_qualified_pairs_d30", "n2_qualified", "pairs with a dwell of 30 seconds or more"), ("N3_qualified_pos_pairs_d30", "n3_positive_inside", "qualified pairs with a positive event"), ("CR_D30_overall_pct", "contact_rate_pct", "contact rate of qualified pairs"), ("N3_qualified_dc_pos_pairs_d30", "n3_direct_inside", "qualified pairs with a direct contact"), ("CR_D30_dc_only_pct", "direct_rate_pct", "contact rate by direct contacts alone"), ("P_total_positive_over_pageview_pct", "total_positive_pct", "positive pairs over pairs with a page view"), ("D_selected_sec", "30", "least dwell of a qualified pair"))
    return " UNION ALL ".join([
        *(one("A1", f"'{m}'", v, t, f) for m, v, t in a1),
        one("A2", "'test_no_history_pct'", "pct", "test users without history", f"SELECT * FROM ({Q['cold_start_segments']}) WHERE user_segment = '0_no_history'"),
        one("A2", "'median_view_to_contact_hours'", "v", "median hours from first view to first contact, up to 30 days", "SELECT median(g) AS v FROM (SELECT (first_pos_us - first_view_us) / 3.6e9::DOUBLE AS g FROM pr) WHERE g >= 0 AND g <= 720 HAVING count(*) > 0"),
        one("A3", "'seller_contact_gini'", "gini", "concentration of contacts on sellers", gini("SELECT contacts FROM sm WHERE seller_id IS NOT NULL", "contacts")),
        one("A3", "'best_category_by_cr_d30'", "category", "category of the highest contact rate", cat),
        one("A3", "'best_category_cr_d30_pct'", "100 * rate", "its contact rate", cat),
        one("A3", "concat('cr_d30_pct__', ad_type, '_', seller_type)", "100 * rate", "contact rate by ad and seller type", cr("pd WHERE ad_type IS NOT NULL AND seller_type IS NOT NULL", "ad_type, seller_type")),
        one("A3_seg", "concat('cr_d30_pct__', segment)", "100 * rate", "contact rate of a segment", seg),
        one("A3_seg", "concat('qualified_pairs__', segment)", "n_qualified", "qualified pairs of a segment", seg),
        one("A3_seg", "concat('gini_d30__', segment)", "gini", "concentration of leads on sellers of a segment", con),
        one("A3_seg", "concat('top10pct_share__', segment)", "top10pct_share", "leads of the first tenth of sellers", f"SELECT * FROM ({con}) WHERE segment <> 'ALL' AND top10pct_share IS NOT NULL"),
    ])


START = "DATE '2024-01-21'"
CTES["apos"] = f"SELECT DISTINCT user_id, item_id FROM posev WHERE date < {START}"
CTES["aneg"] = "SELECT user_id, item_id, source, row_number() OVER (PARTITION BY user_id ORDER BY md5(concat_ws('|', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), '42')), item_id) AS rn FROM bs WHERE user_id IN (SELECT user_id FROM apos) AND NOT EXISTS (SELECT 1 FROM apos p WHERE p.user_id = bs.user_id AND p.item_id = bs.item_id)"
CTES["apairs"] = "SELECT p.user_id, p.item_id, 1 AS label, coalesce(source, 'positive_outside_pool') AS x_candidate_source FROM apos p LEFT JOIN bs ON bs.user_id = p.user_id AND bs.item_id = p.item_id UNION ALL SELECT user_id, item_id, 0, source FROM aneg WHERE rn <= 10"
CTES["aitems"] = f"SELECT d.item_id, category AS i_category, ad_type AS i_ad_type, seller_type AS i_seller_type, seller_id AS i_seller_id, area_sqm AS i_area_sqm, bedrooms AS i_bedrooms, bathrooms AS i_bathrooms, images_count AS i_images_count, city_name AS i_city_name, coalesce(age, 0)::DOUBLE AS i_listing_age_days, coalesce(v7, 0)::DOUBLE AS i_views_7d, coalesce(c7, 0)::DOUBLE AS i_contacts_7d, coalesce(v28, 0)::DOUBLE AS i_views_28d, coalesce(c28, 0)::DOUBLE AS i_contacts_28d, CASE WHEN coalesce(v28, 0) > 0 THEN round(c28::DOUBLE / v28, 6) ELSE 0.0::DOUBLE END AS i_contact_rate_28d FROM dim d LEFT JOIN (SELECT item_id, sum(views_24h) FILTER (date >= {START} - INTERVAL 7 DAY) AS v7, sum(contacts_24h) FILTER (date >= {START} - INTERVAL 7 DAY) AS c7, sum(views_24h) FILTER (date >= {START} - INTERVAL 28 DAY) AS v28, sum(contacts_24h) FILTER (date >= {START} - INTERVAL 28 DAY) AS c28, max(greatest(coalesce(listing_age_days, 0), 0)) AS age FROM snap WHERE date < {START} GROUP BY item_id) s USING (item_id)"
CTES["ausers"] = f"SELECT user_id, n AS u_n_positives, i AS u_n_distinct_items, c AS u_n_distinct_categories, CAST(date_diff('day', last, {START}) AS DOUBLE) AS u_days_since_last_event, category AS u_top_category, city_name AS u_top_city, 0 AS u_n_pageviews FROM (SELECT user_id, count(*) AS n, count(DISTINCT item_id) AS i, count(DISTINCT category) AS c, max(date) AS last FROM posev WHERE date < {START} GROUP BY user_id) LEFT JOIN (SELECT user_id, category FROM posev WHERE date < {START} GROUP BY user_id, category QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, category) = 1) USING (user_id) LEFT JOIN (SELECT user_id, city_name FROM posev WHERE date < {START} GROUP BY user_id, city_name QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, city_name) = 1) USING (user_id)"
CTES["apopular"] = f"SELECT item_id FROM posev WHERE date < {START} GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 5000"
CTES["pv"] = "SELECT user_id, item_id, seller_id, category, coalesce(nullif(seller_type, ''), 'unknown') AS seller_type, coalesce(nullif(ad_type, ''), 'unknown') AS ad_type, n_pageview::DOUBLE AS n_pageview, n_pos::DOUBLE AS n_pos, n_direct::DOUBLE AS n_direct, coalesce(max_dwell, 0)::DOUBLE AS max_dwell, is_qualified AS q_pair, is_qualified_pos AS q_pos_pair FROM pd"
CTES["leads"] = "SELECT CASE seller_type WHEN 'agent' THEN 'B2B_agent' WHEN 'private' THEN 'C2C_private' ELSE 'unknown' END AS seller_group, seller_id, CAST(sum(q_pos_pair) AS BIGINT) AS leads FROM pv WHERE seller_id IS NOT NULL GROUP BY ALL HAVING sum(q_pos_pair) > 0"
CTES["hm"] = f"SELECT user_id, category, {NPV} AS v, {NPOS} AS p FROM ev WHERE {WIN} AND is_login = 'login' AND category IS NOT NULL GROUP BY user_id, category"


Q |= {
    "alt_item_features": "SELECT * FROM aitems",
    "alt_user_features": "SELECT * FROM ausers",
    "alt_training_pairs": "SELECT * FROM apairs",
    "alt_popular_pairs": "SELECT user_id, item_id, 1 AS label, 'random' AS x_candidate_source FROM apos UNION ALL SELECT user_id, item_id, 0, 'random' FROM (SELECT u.user_id, i.item_id, row_number() OVER (PARTITION BY u.user_id ORDER BY md5(concat_ws('|', CAST(u.user_id AS VARCHAR), CAST(i.item_id AS VARCHAR), '42')), i.item_id) AS rn FROM (SELECT DISTINCT user_id FROM apos) u, apopular i WHERE NOT EXISTS (SELECT 1 FROM apos p WHERE p.user_id = u.user_id AND p.item_id = i.item_id)) WHERE rn <= 10",
    "alt_training_frame": "SELECT *, CAST(coalesce(u_top_category = i_category, false) AS INTEGER) AS x_category_match, CAST(coalesce(u_top_city = i_city_name, false) AS INTEGER) AS x_city_match, 0 AS x_user_saw_item_before, 0 AS x_user_contacted_seller_before FROM apairs LEFT JOIN aitems USING (item_id) LEFT JOIN ausers USING (user_id)",
    "alt_holdout": "SELECT DISTINCT user_id, item_id FROM posev WHERE date BETWEEN DATE '2024-01-21' AND DATE '2024-01-28'",
    "pair_view": "SELECT * FROM pv",
    "slide_rates": f"SELECT ad_type, seller_type, count(*) AS observed_pairs, CAST(sum(q_pair) AS BIGINT) AS d30_engaged_pairs, CAST(sum(q_pos_pair) AS BIGINT) AS d30_positive_pairs, count(DISTINCT item_id) AS observed_items, count(DISTINCT CASE WHEN q_pos_pair = 1 THEN item_id END) AS contacted_items, {rate('sum(q_pos_pair)', 'sum(q_pair)')} AS cr_d30, {rate('sum(q_pos_pair)', 'count(*)')} AS cr_observed FROM pv GROUP BY ALL",
    "slide_concentration": f"SELECT seller_group, gini, n_sellers_with_positive, total_lead_pairs, top10_n_sellers, top10_share FROM ({gini('SELECT * FROM leads', 'leads', 'seller_group')}) JOIN (SELECT seller_group, count(*) AS n_sellers_with_positive, CAST(sum(leads) AS BIGINT) AS total_lead_pairs, any_value(k) AS top10_n_sellers, round(sum(leads) FILTER (rn <= k) / sum(leads)::DOUBLE, 6) AS top10_share FROM (SELECT *, row_number() OVER (PARTITION BY seller_group ORDER BY leads DESC) AS rn, greatest(1, CAST(ceil(count(*) OVER (PARTITION BY seller_group) * 0.10::DOUBLE) AS BIGINT)) AS k FROM leads) GROUP BY seller_group) USING (seller_group)",
    "cold_tiers": f"SELECT tier, CAST(sum(n_users) AS BIGINT) AS n_users, round(100.0::DOUBLE * sum(n_users) / sum(sum(n_users)) OVER (), 2) AS pct FROM (SELECT n_users, CASE WHEN has_positive AND has_interaction THEN 'warm_positive' WHEN has_positive THEN 'positive_no_pageview' WHEN has_interaction THEN 'browser_only' ELSE 'no_history' END AS tier FROM ({Q['eda_06_cold_start']})) GROUP BY tier",
    "summary_metrics": summary(),
    "exposure_ratios": f"SELECT metric, max(v) FILTER (seller_type = 'private') AS private, max(v) FILTER (seller_type = 'agent') AS agent, round(max(v) FILTER (seller_type = 'agent') / nullif(max(v) FILTER (seller_type = 'private'), 0), 2) AS ratio_agent_over_private FROM (UNPIVOT (SELECT seller_type, n_listings::DOUBLE AS n_listings, n_pairs::DOUBLE AS n_pairs, n_qualified::DOUBLE AS n_qualified, n_positive::DOUBLE AS n_positive, pageview_per_listing, qualified_per_listing, qualifying_rate_pct, cr_d30_pct FROM ({Q['exposure_vs_cr']})) ON n_listings, n_pairs, n_qualified, n_positive, pageview_per_listing, qualified_per_listing, qualifying_rate_pct, cr_d30_pct INTO NAME metric VALUE v) GROUP BY metric",
    "segment_proxy": PROXY,
    "verify_d30": d30_checks(),
    "verify_segments": segment_checks(),
    "other_interaction_verdicts": verdicts(),
}
#: As of the end of training, for test users.
LATER = (("DATE '2024-01-20'", "DATE '2024-01-28'"), ("DATE '2024-01-19'", "DATE '2024-01-27'"))
PREDICTED = {
    "merge_candidates_predict": "SELECT * FROM pool",
    "ranker_input_predict": "SELECT * FROM rin",
}


def _later(name: str, sql: str) -> str:
    for a, b in LATER:
        sql = sql.replace(a, b)
    if name == "srcs":
        return f"SELECT * FROM ({sql}) WHERE user_id IN (SELECT user_id FROM usr)"
    return sql.replace("(SELECT DISTINCT user_id FROM ud)", "usr") if name == "globpop" else sql


def oracle_sql() -> dict[str, str]:
    made = lambda change: "WITH " + ",\n".join(f"{name} AS ({change(name, sql)})" for name, sql in CTES.items())
    now, later = made(lambda name, sql: sql), made(_later)
    return {name: f"{now}\nSELECT * FROM ({sql})" for name, sql in Q.items()} | {name: f"{later}\nSELECT * FROM ({sql})" for name, sql in PREDICTED.items()}
