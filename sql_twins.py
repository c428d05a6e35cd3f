"""DuckDB twins of the registered queries, over the same tables."""

from __future__ import annotations

import string

from millrace.functions.text import PUNCTUATION

TWINS: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# ---------------------------------------------------------------- words

LINES = """
docs AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS pos, unnest(ls) AS line FROM docs)"""
CLEAN = (
    r"translate(regexp_replace(lower(line), '^\s+|\s+$', '', 'g'), " + _text(PUNCTUATION) + ", '')"
)
ALL_WORDS = f"{LINES}, every_word AS (SELECT unnest(string_split({CLEAN}, ' ')) AS word FROM lines)"
WORDS = f"{ALL_WORDS}, words AS (SELECT word FROM every_word WHERE length(word) > 0)"
COUNTS = f"{WORDS}, counts AS (SELECT word, count(*) AS n FROM words GROUP BY word)"

TWINS["range_sum"] = "SELECT sum(o_orderkey)::BIGINT AS total FROM orders"
TWINS["filter_mod_sum"] = (
    "SELECT sum(o_orderkey)::BIGINT AS total FROM orders WHERE o_orderkey % 7 = 0"
)
TWINS["line_count"] = f"WITH {LINES} SELECT count(*) AS n_lines FROM lines"
TWINS["word_count"] = f"WITH {COUNTS} SELECT word, n FROM counts"
TWINS["top_words"] = f"WITH {COUNTS} SELECT word, n FROM counts ORDER BY n DESC, word LIMIT 15"
TWINS["all_word_count"] = f"""WITH {ALL_WORDS}
SELECT count(*) AS n_all, count(*) FILTER (length(word) > 0) AS n_words FROM every_word"""
TWINS["last_words"] = f"WITH {WORDS} SELECT word FROM words ORDER BY word DESC LIMIT 5"
TWINS["mean_word_occurrence"] = f"""WITH {COUNTS}
SELECT sum(n)::BIGINT AS n_words, count(*) AS n_distinct, round(sum(n) / count(*), 2) AS mean_uses
FROM counts"""
TWINS["plural_words"] = f"WITH {COUNTS} SELECT word, word || 's' AS plural_word FROM counts"
TWINS["word_lengths"] = f"""WITH {WORDS}
SELECT length(word || 's')::INT AS length, count(*) AS n FROM words GROUP BY 1"""
TWINS["grouped_words"] = f"""WITH {COUNTS}
SELECT word, 1::INT AS member, n, n AS total FROM counts"""
TWINS["numbered_lines"] = f"""WITH {LINES}, numbered AS (
  SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS line_no, {CLEAN} AS cleaned FROM lines)
SELECT line_no, line_no::VARCHAR || ': ' || cleaned AS text FROM numbered"""

# ---------------------------------------------------------------- logs

# The line grammars whose results are matched
STRICT = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)'
RELAXED = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*\s*)" (\d{3}) (\S+)'


def _log(pattern: str) -> str:
    p = _text(pattern)
    return f"""
log_lines AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN concat('garbage line ', event_id::VARCHAR)
    ELSE concat('host', user_id::VARCHAR, '.example.com - - [',
      strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' -0400] "GET /', event_type, '/',
      regexp_extract(props, '([0-9]+)', 1), '.html HTTP/1.0',
      CASE WHEN event_id % 50 = 0 THEN ' ' ELSE '' END, '" ',
      CASE event_type WHEN 'error' THEN '404' WHEN 'signup' THEN '302'
        WHEN 'purchase' THEN '304' ELSE '200' END, ' ',
      CASE WHEN event_id % 13 = 0 THEN '-' ELSE floor(value * 100)::BIGINT::VARCHAR END)
    END AS value
  FROM events),
fields AS (
  SELECT value, regexp_matches(value, {p}) AS hit,
    regexp_extract(value, {p}, 1) AS host, regexp_extract(value, {p}, 2) AS client_identd,
    regexp_extract(value, {p}, 3) AS user_id, regexp_extract(value, {p}, 4) AS stamp,
    regexp_extract(value, {p}, 5) AS method, regexp_extract(value, {p}, 6) AS endpoint,
    regexp_extract(value, {p}, 7) AS protocol, regexp_extract(value, {p}, 8) AS code,
    regexp_extract(value, {p}, 9) AS size
  FROM log_lines),
log AS (
  SELECT value, host, client_identd, user_id, method, endpoint, protocol,
    try_strptime(substr(stamp, 1, 20), '%d/%b/%Y:%H:%M:%S') AS date_time,
    try_cast(code AS INT) AS response_code,
    CASE WHEN size = '-' THEN 0 ELSE try_cast(size AS BIGINT) END AS content_size,
    CASE WHEN hit AND try_strptime(substr(stamp, 1, 20), '%d/%b/%Y:%H:%M:%S') IS NOT NULL
      AND (size = '-' OR try_cast(size AS BIGINT) IS NOT NULL) THEN 1 ELSE 0 END AS status
  FROM fields),
good AS (SELECT * FROM log WHERE status = 1),
errors AS (SELECT * FROM good WHERE response_code = 404)"""


LOG = _log(RELAXED)
SHOWN = """host, client_identd, user_id, strftime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time,
method, endpoint, protocol, response_code, content_size"""

TWINS["log_parse"] = f"WITH {_log(STRICT)} SELECT {SHOWN} FROM good"
TWINS["log_parse_relaxed"] = f"WITH {LOG} SELECT {SHOWN} FROM good"
TWINS["log_load_counts"] = f"WITH {LOG} SELECT status, count(*) AS n FROM log GROUP BY 1"
TWINS["log_file_counts"] = TWINS["log_load_counts"]
TWINS["log_rejects"] = f"""WITH {_log(STRICT)}
SELECT value FROM log WHERE status = 0 ORDER BY value LIMIT 20"""
TWINS["content_size_stats"] = f"""WITH {LOG}
SELECT (sum(content_size) // count(*))::BIGINT AS mean_size, min(content_size) AS min_size,
  max(content_size) AS max_size FROM good"""
TWINS["response_code_counts"] = f"""WITH {LOG}
SELECT response_code, count(*) AS n FROM good GROUP BY 1"""
TWINS["response_code_share"] = f"""WITH {LOG}
SELECT response_code, round(count(*) / (SELECT count(*) FROM good), 9) AS share
FROM good GROUP BY 1"""
TWINS["hosts_over_n"] = f"""WITH {LOG}
SELECT host FROM good GROUP BY 1 HAVING count(*) > 10 ORDER BY host LIMIT 20"""
TWINS["endpoint_hits"] = f"WITH {LOG} SELECT endpoint, count(*) AS n FROM good GROUP BY 1"
TWINS["top_endpoints"] = f"""WITH {LOG}
SELECT endpoint, count(*) AS n FROM good GROUP BY 1 ORDER BY n DESC, endpoint LIMIT 10"""
TWINS["top_failing_endpoints"] = f"""WITH {LOG}
SELECT endpoint, count(*) AS n FROM good WHERE response_code <> 200
GROUP BY 1 ORDER BY n DESC, endpoint LIMIT 10"""
TWINS["failing_endpoint_count"] = f"""WITH {LOG}
SELECT count(DISTINCT endpoint) AS n_endpoints FROM good WHERE response_code <> 200"""
TWINS["unique_hosts"] = f"WITH {LOG} SELECT count(DISTINCT host) AS n_hosts FROM good"
TWINS["daily_hosts"] = f"""WITH {LOG}
SELECT day(date_time)::INT AS day, count(DISTINCT host) AS n_hosts FROM good GROUP BY 1"""
TWINS["daily_avg_requests"] = f"""WITH {LOG}
SELECT day(date_time)::INT AS day, count(*) // count(DISTINCT host) AS mean_requests
FROM good GROUP BY 1"""
TWINS["errors_404"] = f"WITH {LOG} SELECT {SHOWN} FROM errors"
TWINS["distinct_404_endpoints"] = f"""WITH {LOG}
SELECT DISTINCT endpoint FROM errors ORDER BY endpoint LIMIT 40"""
TWINS["top_404_endpoints"] = f"""WITH {LOG}
SELECT endpoint, count(*) AS n FROM errors GROUP BY 1 ORDER BY n DESC, endpoint LIMIT 20"""
TWINS["top_404_hosts"] = f"""WITH {LOG}
SELECT host, count(*) AS n FROM errors GROUP BY 1 ORDER BY n DESC, host LIMIT 25"""
TWINS["daily_404"] = f"""WITH {LOG}
SELECT day(date_time)::INT AS day, count(*) AS n FROM errors GROUP BY 1"""
TWINS["top_404_days"] = f"""WITH {LOG}
SELECT day(date_time)::INT AS day, count(*) AS n FROM errors GROUP BY 1
ORDER BY n DESC, day LIMIT 5"""
TWINS["hourly_404"] = f"""WITH {LOG}
SELECT hour(date_time)::INT AS hour, count(*) AS n FROM errors GROUP BY 1"""

# ---------------------------------------------------------------- entities

TOKENS = (
    f"list_filter(regexp_split_to_array(translate(text, '{string.ascii_uppercase}', "
    f"'{string.ascii_lowercase}'), '\\W+'), lambda x: x <> '')"
)
RAW = f"""
raw AS (SELECT doc_id AS id, CASE WHEN length(source) = 4 THEN 'a' ELSE 'g' END AS side,
  {TOKENS} AS tokens FROM documents)"""
RECORDS = f"""{RAW},
stop AS (SELECT t FROM (SELECT unnest(list_distinct(tokens)) AS t FROM raw)
  GROUP BY t ORDER BY count(*) DESC, t LIMIT 20),
stops AS (SELECT list(t) AS s FROM stop),
records AS (SELECT id, side, list_filter(tokens, lambda x: NOT list_contains(s, x)) AS tokens
  FROM raw, stops)"""
POSTINGS = f"""{RECORDS},
spelled AS (SELECT id, side, len(tokens) AS size, unnest(tokens) AS token FROM records),
postings AS (SELECT id, side, size, token, count(*) AS n FROM spelled GROUP BY ALL),
ratios AS (SELECT token, count(*) AS n_docs, (SELECT count(*) FROM records) / count(*) AS idf
  FROM postings GROUP BY token)"""
WEIGHTS = f"""{POSTINGS},
weights AS (SELECT id, side, token, n / size * idf AS weight FROM postings JOIN ratios USING (token)),
norms AS (SELECT id, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY id)"""
SIMS = f"""{WEIGHTS},
dots AS (SELECT a.id AS a_id, g.id AS g_id, sum(a.weight * g.weight) AS dot
  FROM weights a JOIN weights g ON a.token = g.token AND a.side = 'a' AND g.side = 'g'
  GROUP BY 1, 2),
sims AS (SELECT a_id, g_id, dot / (na.norm * ng.norm) AS cosine FROM dots
  JOIN norms na ON na.id = a_id JOIN norms ng ON ng.id = g_id)"""
GOLD = """
keyed AS (SELECT doc_id, lang, length(source) = 4 AS is_a, md5(lower(text)) AS h FROM documents),
gold AS (
  SELECT a_id, g_id FROM (
    SELECT min(doc_id) FILTER (is_a) AS a_id, min(doc_id) FILTER (NOT is_a) AS g_id
    FROM keyed GROUP BY h
    UNION
    SELECT max(doc_id) FILTER (is_a), max(doc_id) FILTER (NOT is_a) FROM keyed GROUP BY lang)
  WHERE a_id IS NOT NULL AND g_id IS NOT NULL)"""
GOLD_SIMS = f"""{SIMS}, {GOLD},
gold_sims AS (SELECT gold.a_id, gold.g_id, coalesce(cosine, 0.0) AS cosine,
    gold.a_id IN (SELECT id FROM postings) AND gold.g_id IN (SELECT id FROM postings) AS known
  FROM gold LEFT JOIN sims USING (a_id, g_id)),
sizes AS (SELECT count(*) FILTER (side = 'a') * count(*) FILTER (side = 'g') AS n_pairs
  FROM records WHERE len(tokens) > 0)"""
HISTOGRAM = f"""{GOLD_SIMS},
pair_bins AS (SELECT floor(round(cosine * 100, 7))::INT AS bin, count(*) AS n FROM sims GROUP BY 1),
gold_bins AS (SELECT floor(round(cosine * 100, 7))::INT AS bin, count(*) AS n FROM gold_sims GROUP BY 1),
bins AS (SELECT range::INT AS bin FROM range(101)),
histogram AS (
  SELECT b.bin,
    CASE WHEN b.bin = 0 THEN (SELECT n_pairs FROM sizes)
        - coalesce((SELECT sum(n) FROM pair_bins WHERE bin > 0), 0)
      ELSE coalesce(p.n, 0) END::BIGINT AS pairs,
    coalesce(g.n, 0)::BIGINT AS golds
  FROM bins b LEFT JOIN pair_bins p ON p.bin = b.bin LEFT JOIN gold_bins g ON g.bin = b.bin)"""

SPELLED_BAG = "id, len(tokens)::INT AS n_tokens, array_to_string(tokens, ' ') AS token_text"
TWINS["doc_tokens"] = f"WITH {RAW} SELECT {SPELLED_BAG} FROM raw"
TWINS["stopword_filter"] = f"WITH {RECORDS} SELECT {SPELLED_BAG} FROM records"
TWINS["token_total"] = f"WITH {RECORDS} SELECT sum(len(tokens))::BIGINT AS n_tokens FROM records"
TWINS["biggest_record"] = f"""WITH {RECORDS}
SELECT side, id, len(tokens)::INT AS n_tokens FROM records
QUALIFY row_number() OVER (PARTITION BY side ORDER BY len(tokens) DESC, id) = 1"""
TWINS["tf"] = f"WITH {POSTINGS} SELECT id, token, round(n / size, 9) AS tf FROM postings"
TWINS["idf"] = f"WITH {POSTINGS} SELECT token, n_docs, round(idf, 6) AS idf FROM ratios"
TWINS["rare_idf"] = f"""WITH {POSTINGS}
SELECT token, round(idf, 6) AS idf FROM (SELECT * FROM ratios ORDER BY idf, token LIMIT 11)"""
TWINS["idf_histogram"] = f"""WITH {POSTINGS},
span AS (SELECT min(idf) AS low, max(idf) AS high FROM ratios)
SELECT least(floor((idf - low) / (high - low) * 50), 49)::INT AS bin, count(*) AS n
FROM ratios, span GROUP BY 1"""
TWINS["tfidf"] = f"WITH {WEIGHTS} SELECT id, token, round(weight, 6) AS weight FROM weights"
TWINS["weight_norms"] = f"WITH {WEIGHTS} SELECT id, round(norm, 6) AS norm FROM norms"

PRODUCTS = """
product_lines AS (
  SELECT CASE WHEN doc_id % 101 = 0 THEN concat('bad ', doc_id::VARCHAR)
    ELSE concat('"', lang, doc_id::VARCHAR, '","', source, ' title",',
      translate(text, chr(10), ' '), ',"maker, inc",', n_chars::VARCHAR) END AS value
  FROM documents
  UNION ALL SELECT '"id","title","description","manufacturer","price"'),
product_fields AS (
  SELECT value, regexp_matches(value, '^(.+),"(.+)",(.*),(.*),(.*)') AS hit,
    regexp_extract(value, '^(.+),"(.+)",(.*),(.*),(.*)', 1) AS f1,
    regexp_extract(value, '^(.+),"(.+)",(.*),(.*),(.*)', 2) AS f2,
    regexp_extract(value, '^(.+),"(.+)",(.*),(.*),(.*)', 3) AS f3,
    regexp_extract(value, '^(.+),"(.+)",(.*),(.*),(.*)', 4) AS f4
  FROM product_lines),
products AS (
  SELECT *, CASE WHEN NOT hit THEN -1 WHEN f1 = '"id"' THEN 0 ELSE 1 END AS status
  FROM product_fields)"""
TWINS["product_csv_parse"] = f"""WITH {PRODUCTS}
SELECT replace(f1, '"', '') AS id, concat(f2, ' ', f3, ' ', f4) AS text
FROM products WHERE status = 1"""
TWINS["product_load_counts"] = f"WITH {PRODUCTS} SELECT status, count(*) AS n FROM products GROUP BY 1"
TWINS["product_rejects"] = f"""WITH {PRODUCTS}
SELECT value FROM products WHERE status = -1 ORDER BY value LIMIT 10"""
TWINS["gold_parse"] = f"""WITH {GOLD}
SELECT CASE WHEN a_id % 7 = 0 THEN -1 ELSE 1 END AS status,
  CASE WHEN a_id % 7 <> 0 THEN 'a' || a_id::VARCHAR END AS a_id,
  CASE WHEN a_id % 7 <> 0 THEN 'g' || g_id::VARCHAR END AS g_id FROM gold
UNION ALL SELECT 0, NULL, NULL"""
BAG = "md5(array_to_string(list_sort(tokens), ' '))"
TWINS["record_bags"] = f"""WITH {RECORDS}
SELECT side, id, {BAG} AS bag FROM records WHERE len(tokens) > 0"""
TWINS["similar_pairs"] = f"""WITH {SIMS}, bags AS (SELECT id, {BAG} AS bag FROM records)
SELECT min(a_id) AS a_id, min(g_id) AS g_id, count(DISTINCT a_id) AS n_a,
  count(DISTINCT g_id) AS n_g, round(max(cosine), 6) AS cosine
FROM sims JOIN bags ba ON ba.id = a_id JOIN bags bg ON bg.id = g_id
GROUP BY ba.bag, bg.bag HAVING round(max(cosine), 9) >= 0.1"""
TWINS["gold_left_join"] = f"""WITH {GOLD_SIMS}
SELECT a_id, g_id, round(cosine, 6) AS cosine FROM gold_sims"""
TWINS["dup_vs_nondup_mean"] = f"""WITH {GOLD_SIMS},
dups AS (SELECT count(*) AS n, sum(cosine) AS s FROM gold_sims WHERE known),
others AS (SELECT sum(cosine) AS s FROM sims ANTI JOIN gold USING (a_id, g_id))
SELECT dups.n AS n_dups, round(dups.s / dups.n, 6) AS mean_dups,
  round(others.s / (n_pairs - dups.n), 9) AS mean_others FROM dups, others, sizes"""
TWINS["similarity_histogram"] = f"""WITH {HISTOGRAM}
SELECT bin, pairs, golds, pairs - golds AS others FROM histogram"""
TWINS["pr_sweep"] = f"""WITH {HISTOGRAM},
tally AS (
  SELECT bin, sum(pairs - golds) OVER up AS fp, sum(golds) OVER up AS tp,
    sum(golds) OVER () AS total
  FROM histogram
  WINDOW up AS (ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
rated AS (
  SELECT bin / 100.0::DOUBLE AS threshold, fp::BIGINT AS fp, (total - tp)::BIGINT AS fn,
    tp::BIGINT AS tp, tp::DOUBLE / nullif(tp + fp, 0)::DOUBLE AS p,
    tp::DOUBLE / nullif(total, 0)::DOUBLE AS r
  FROM tally WHERE bin < 100)
SELECT threshold, fp, fn, tp, round(p, 9) AS precision, round(r, 9) AS recall,
  round(2 * r * p / nullif(r + p, 0), 9) AS fmeasure FROM rated"""

# ---------------------------------------------------------------- recommend

POINT = "('0x' || substr(md5({key}), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


def _split(key: str, first: float, second: float) -> str:
    point = POINT.format(key=key)
    return (
        f"CASE WHEN {point} < {first}::DOUBLE THEN 'train' "
        f"WHEN {point} < {second}::DOUBLE THEN 'validation' ELSE 'test' END"
    )


RATINGS = """
ratings AS (
  SELECT o_custkey::INT AS usr, l_partkey::INT AS item,
    max((floor((l_quantity - 1) / 10) + 1)::DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
SPLIT_RATINGS = f"""{RATINGS},
parts AS (SELECT *, {_split("usr::VARCHAR || '|' || item::VARCHAR", 0.6, 0.8)} AS split FROM ratings)"""
AVERAGES = f"""{RATINGS},
averages AS (SELECT item, count(*) AS n, avg(rating) AS mean_rating FROM ratings GROUP BY 1),
named AS (SELECT mean_rating, p_name AS title, n FROM averages JOIN part ON p_partkey = item)"""
OWN = """
liked AS (SELECT p_partkey::INT AS item, p_size FROM part
  WHERE p_brand = 'Brand#7' AND p_type = 'PROMO'),
own AS (SELECT -1::INT AS usr, item, (p_size % 5 + 1)::DOUBLE AS rating FROM liked
  UNION ALL SELECT -1::INT, item, 5.0::DOUBLE FROM liked WHERE p_size <= 10)"""

TWINS["rating_lines_parse"] = f"""WITH {RATINGS}
SELECT 1 AS status, count(*) AS n, sum(usr)::BIGINT AS usrs, sum(item)::BIGINT AS items,
  sum(rating) AS ratings FROM ratings"""
TWINS["item_lines_parse"] = "SELECT p_partkey::INT AS item, p_name AS title, 1 AS status FROM part"
TWINS["item_ratings"] = f"""WITH {RATINGS}
SELECT item, rating, count(*) AS n FROM ratings GROUP BY 1, 2"""
TWINS["item_averages"] = f"""WITH {AVERAGES}
SELECT item, n, round(mean_rating, 9) AS mean_rating FROM averages"""
TWINS["named_item_averages"] = f"""WITH {AVERAGES}
SELECT round(mean_rating, 9) AS mean_rating, title, n FROM named"""
TWINS["well_rated_items"] = f"""WITH {AVERAGES}
SELECT round(mean_rating, 9) AS mean_rating, title, n FROM named WHERE n > 30"""
TWINS["sort_composite"] = f"""WITH {AVERAGES}
SELECT printf('%.3f %s', mean_rating, title) AS sort_key FROM named WHERE n > 30
ORDER BY sort_key DESC LIMIT 20"""
TWINS["first_items"] = f"""WITH {AVERAGES}
SELECT item, n, round(mean_rating, 9) AS mean_rating FROM averages ORDER BY item LIMIT 3"""
TWINS["hash_split"] = f"""WITH {SPLIT_RATINGS}
SELECT split, count(*) AS n, sum(rating) AS ratings FROM parts GROUP BY 1"""
TWINS["rating_rmse"] = f"""WITH {SPLIT_RATINGS},
means AS (SELECT item, avg(rating) AS prediction FROM parts WHERE split = 'train' GROUP BY 1)
SELECT count(*) AS n, round(sqrt(avg((rating - prediction) ** 2)), 9) AS rmse
FROM parts JOIN means USING (item) WHERE split = 'test'"""
TWINS["mean_baseline_rmse"] = f"""WITH {SPLIT_RATINGS},
m AS (SELECT avg(rating) AS mean FROM parts WHERE split = 'train')
SELECT round(max(mean), 9) AS train_mean, round(sqrt(avg((rating - mean) ** 2)), 9) AS rmse
FROM parts, m WHERE split = 'test'"""
TWINS["gzip_rating_lines"] = TWINS["rating_lines_parse"]
TWINS["same_rating_rows"] = f"""WITH {RATINGS},
less AS (SELECT * FROM ratings WHERE (usr, item) <> (SELECT (min((usr, item)))  FROM ratings))
SELECT 'round_trip' AS kind, (SELECT count(*) FROM (FROM ratings EXCEPT ALL FROM ratings)) = 0 AS same
UNION ALL SELECT 'one_lost', (SELECT count(*) FROM (FROM ratings EXCEPT ALL FROM less)) = 0"""
TWINS["als_coverage"] = f"""WITH {SPLIT_RATINGS},
train AS (SELECT * FROM parts WHERE split = 'train')
SELECT split, count(*) AS n,
  count(*) FILTER (usr IN (SELECT usr FROM train) AND item IN (SELECT item FROM train)) AS predicted
FROM parts WHERE split <> 'train' GROUP BY 1"""
TWINS["supported_candidates"] = f"""WITH {RATINGS}, {OWN}
SELECT -1::INT AS usr, item, count(*) AS n FROM ratings
WHERE item NOT IN (SELECT item FROM own) AND item IN (SELECT p_partkey::INT FROM part)
GROUP BY 2 HAVING count(*) > 30 ORDER BY n DESC, item LIMIT 20"""
TWINS["union_ratings"] = f"""WITH {RATINGS}, {OWN},
both_sets AS (SELECT * FROM ratings UNION ALL SELECT * FROM own)
SELECT usr, count(*) AS n, sum(rating) AS ratings FROM both_sets GROUP BY 1"""
TWINS["unrated_items"] = f"""WITH {OWN}
SELECT -1::INT AS usr, p_partkey::INT AS item FROM part
WHERE p_partkey NOT IN (SELECT item FROM own)"""

def _eigen(count: int) -> str:
    """The first eigenvectors of cov0 (i, j, v): per vector c the tables dir{c} (pos, w) and val{c} (l). The
    matrix is squared again and again, which leaves the
    projector on the first direction; what that explains is then taken off."""
    parts = []
    for c in range(count):
        parts.append(f"""
sq{c} AS (
  SELECT 0 AS t, i, j, v / sum(CASE WHEN i = j THEN v END) OVER () AS v FROM cov{c}
  UNION ALL
  SELECT t, i, j, v / sum(CASE WHEN i = j THEN v END) OVER () FROM (
    SELECT a.t + 1 AS t, a.i, b.j, sum(a.v * b.v) AS v FROM sq{c} a JOIN sq{c} b ON a.j = b.i WHERE a.t < 30 GROUP BY ALL)),
peak{c} AS MATERIALIZED (SELECT i AS p, v FROM sq{c} WHERE t = 30 AND i = j ORDER BY v DESC, i LIMIT 1),
dir{c} AS MATERIALIZED (SELECT i AS pos, sq{c}.v / sqrt(peak{c}.v) AS w FROM sq{c}, peak{c} WHERE t = 30 AND j = p),
val{c} AS MATERIALIZED (
  SELECT sum(a.w * cov{c}.v * b.w) / (SELECT sum(w * w) FROM dir{c}) AS l
  FROM cov{c} JOIN dir{c} a ON a.pos = i JOIN dir{c} b ON b.pos = j),
cov{c + 1} AS MATERIALIZED (
  SELECT i, j, cov{c}.v - l * a.w * b.w AS v FROM cov{c} JOIN dir{c} a ON a.pos = i JOIN dir{c} b ON b.pos = j, val{c})""")
    return ",".join(parts)


# ---------------------------------------------------------------- linear

LINE_KEY = (
    "concat_ws('-', l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR, l_quantity::BIGINT::VARCHAR)"
)
ROWS = f"""
reg AS (SELECT {LINE_KEY} AS row_id, l_extendedprice / 1000 AS label, l_quantity / 50 AS x1,
  l_discount * 10 AS x2, l_tax * 10 AS x3 FROM lineitem),
parts AS (SELECT *, {_split("row_id", 0.8, 0.9)} AS split FROM reg)"""

TWINS["labelled_lines_parse"] = f"""WITH {ROWS}
SELECT count(*) AS n, round(sum(label), 4) AS labels, round(sum(x3), 4) AS third_features FROM reg"""
TWINS["label_range_shift"] = f"""WITH {ROWS}
SELECT round(min(label) - min(label), 6) AS new_min, round(max(label) - min(label), 6) AS new_max,
  round(min(label), 6) AS old_min, round(max(label), 6) AS old_max FROM reg"""
TWINS["shifted_labels"] = f"""WITH {ROWS}
SELECT row_id, round(label - (SELECT min(label) FROM reg), 6) AS label FROM reg"""
TWINS["label_histogram"] = f"""WITH {ROWS},
counted AS (SELECT label, count(*) AS n FROM reg GROUP BY 1)
SELECT round(label, 6) AS label, n FROM counted"""
TWINS["split_totals"] = f"""WITH {ROWS}
SELECT split, count(*) AS n, round(sum(label), 4) AS labels FROM parts GROUP BY 1"""
TWINS["mean_label_rmse"] = f"""WITH {ROWS},
m AS (SELECT avg(label) AS mean FROM parts WHERE split = 'train')
SELECT split, count(*) AS n, round(sqrt(avg((label - mean) ** 2)), 6) AS rmse FROM parts, m GROUP BY 1"""
TWINS["gradient_sum"] = f"""WITH {ROWS}, res AS (SELECT *, x1 + x2 + x3 - label AS r FROM reg)
SELECT 0::INT AS pos, round(sum(r * x1), 3) AS gradient FROM res
UNION ALL SELECT 1::INT, round(sum(r * x2), 3) FROM res
UNION ALL SELECT 2::INT, round(sum(r * x3), 3) FROM res"""
TWINS["linear_predict"] = f"""WITH {ROWS}
SELECT row_id, round(label, 6) AS label, round(x1 + 1.5 * x2 - 0.5 * x3, 6) AS prediction FROM reg"""
_PRODUCTS = [f"x{i}" for i in (1, 2, 3)] + [f"x{i} * x{j}" for i in (1, 2, 3) for j in (1, 2, 3)]
TWINS["interactions"] = f"WITH {ROWS}\n" + "\nUNION ALL ".join(
    f"SELECT {pos}::INT AS pos, round(sum({p}), 3) AS total FROM reg"
    for pos, p in enumerate(_PRODUCTS)
)


def _moment_cte(name: str, xs: list[str], part: str) -> str:
    sums = ["count(*)::DOUBLE AS n", "sum(label * label) AS yy"]
    for i, a in enumerate(xs):
        sums.append(f"sum({a} * label) AS b{i}")
        sums += [f"sum({a} * {b}) AS s{i}_{j}" for j, b in enumerate(xs) if j >= i]
    return f"{name} AS (SELECT {', '.join(sums)} FROM (SELECT *, 1.0::DOUBLE AS one FROM parts) WHERE split = '{part}')"


def _pull(width: int, i: int, m: str) -> str:
    return " + ".join(f"{m}.s{min(i, j)}_{max(i, j)} * w{j}" for j in range(width))


def _mse(width: int, m: str) -> str:
    quad = " + ".join(f"w{i} * ({_pull(width, i, m)})" for i in range(width))
    lin = " + ".join(f"w{i} * {m}.b{i}" for i in range(width))
    return f"(({quad}) - 2 * ({lin}) + {m}.yy) / {m}.n"


_X = ["x1", "x2", "x3"]
TWINS["gd_trace"] = f"""WITH RECURSIVE {ROWS}, {_moment_cte('m', _X, 'train')},
steps AS (
  SELECT 0 AS i, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2
  UNION ALL
  SELECT i + 1, {', '.join(f'w{k} - ({_pull(3, k, "m")} - m.b{k}) / (m.n * sqrt(i + 1))' for k in range(3))}
  FROM steps, m WHERE i < 49)
SELECT i::INT AS iteration, round(sqrt({_mse(3, 'm')}), 6) AS rmse FROM steps, m"""

_X1 = _X + ["one"]
_GRID = [(500, 1.0, 1e-10), (500, 1.0, 1e-5), (500, 1.0, 1e-1), (500, 1.0, 1.0),
         (5, 1e-5, 1e-10), (500, 1e-5, 1e-10), (5, 10.0, 1e-10), (500, 10.0, 1e-10)]
_LINEAR_GRID = f"""WITH RECURSIVE {ROWS}, {_moment_cte('m', _X1, 'train')}, {_moment_cte('v', _X1, 'validation')},
cov0 AS MATERIALIZED ({' UNION ALL '.join(f'SELECT {i} AS i, {j} AS j, s{min(i, j)}_{max(i, j)} / n AS v FROM m' for i in range(4) for j in range(4))}),
{_eigen(4)},
pulls AS MATERIALIZED ({' UNION ALL '.join(f'SELECT {i} AS pos, b{i} / n AS b FROM m' for i in range(4))}),
spectrum AS MATERIALIZED ({' UNION ALL '.join(f'SELECT {c} AS c, pos, w / (SELECT sqrt(sum(w * w)) FROM dir{c}) AS w, l FROM dir{c}, val{c}' for c in range(4))}),
axes AS MATERIALIZED (SELECT c, any_value(l) AS l, sum(w * b) AS pull, sum(CASE WHEN pos = 3 THEN w END) AS begun FROM spectrum JOIN pulls USING (pos) GROUP BY 1),
grid(its, step, reg) AS (VALUES {', '.join(f'({a}, {b}::DOUBLE, {c}::DOUBLE)' for a, b, c in _GRID)}),
factors AS (
  SELECT its, step, reg, c, product(1 - step / sqrt(t) * (l + reg)) AS p
  FROM grid, axes, (SELECT unnest(range(1, 501)) AS t) WHERE t <= its GROUP BY ALL),
ends AS (SELECT its, step, reg, c, pull / (l + reg) + (begun - pull / (l + reg)) * p AS z FROM factors JOIN axes USING (c)),
weights AS MATERIALIZED (
  SELECT its, step, reg, {', '.join(f'sum(CASE WHEN pos = {k} THEN w * z END) AS w{k}' for k in range(4))}
  FROM ends JOIN spectrum USING (c) GROUP BY 1, 2, 3),
begun AS (SELECT sqrt({_mse(4, 'v')}) AS e0 FROM v, (SELECT 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, 1.0::DOUBLE AS w3)),
rated AS MATERIALIZED (SELECT weights.*, sqrt({_mse(4, 'v')}) AS e, e0 FROM weights, v, begun)"""
TWINS["linear_fit_grid"] = f"""{_LINEAR_GRID}
SELECT its::INT AS iterations, step, reg, CASE WHEN e > 1000 THEN round(e, 0) ELSE round(e, 6) END AS rmse,
  e > e0 AS diverged, e = (SELECT min(e) FROM rated) AS best FROM rated"""
TWINS["linear_grid_test"] = f"""{_LINEAR_GRID}, {_moment_cte('u', _X1, 'test')},
base AS (SELECT avg(label) AS mean FROM parts WHERE split = 'train')
SELECT (SELECT count(*) FROM parts WHERE split = 'test') AS n,
  (SELECT round(sqrt(avg((label - mean) ** 2)), 6) FROM parts, base WHERE split = 'test') AS baseline_rmse,
  round(sqrt({_mse(4, 'u')}), 6) AS model_rmse
FROM rated, u ORDER BY e LIMIT 1"""
TWINS["sample_slice_trace"] = f"""WITH RECURSIVE {ROWS},
sample AS (SELECT * FROM parts WHERE split = 'train' ORDER BY md5(row_id), row_id LIMIT 10),
m AS MATERIALIZED (
  SELECT count(*)::DOUBLE AS n, sum(label * label) AS yy, sum(x1 * label) AS b0, sum(x2 * label) AS b1,
    sum(x1 * x1) AS s0_0, sum(x1 * x2) AS s0_1, sum(x2 * x2) AS s1_1 FROM sample),
steps AS (
  SELECT 0 AS i, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1
  UNION ALL
  SELECT i + 1, {', '.join(f'w{k} - ({_pull(2, k, "m")} - m.b{k}) / (m.n * sqrt(i + 1))' for k in range(2))} FROM steps, m WHERE i < 4)
SELECT i::INT AS iteration, round(sqrt({_mse(2, 'm')}), 6) AS rmse FROM steps, m"""
TWINS["labelled_width_counts"] = """SELECT CASE WHEN l_linenumber = 1 THEN -1 ELSE 1 END AS status, count(*) AS n
FROM lineitem GROUP BY 1"""

_I1 = [*_PRODUCTS, "one"]
_IW = len(_I1)
TWINS["linear_interact_fit"] = f"""WITH RECURSIVE {ROWS}, {_moment_cte('m', _I1, 'train')},
{_moment_cte('v', _I1, 'test')},
steps AS (
  SELECT 1 AS t, {', '.join(f"{1.0 if k == _IW - 1 else 0.0}::DOUBLE AS w{k}" for k in range(_IW))}
  UNION ALL
  SELECT t + 1, {', '.join(f'w{k} * (1 - 1.0 / sqrt(t) * 1e-10) - 1.0 / sqrt(t) * ({_pull(_IW, k, "m")} - m.b{k}) / m.n' for k in range(_IW))}
  FROM steps, m WHERE t <= 500),
base AS (SELECT avg(label) AS mean FROM parts WHERE split = 'train')
SELECT (SELECT count(*) FROM parts WHERE split = 'test') AS n,
  (SELECT round(sqrt(avg((label - mean) ** 2)), 6) FROM parts, base WHERE split = 'test') AS baseline_rmse,
  round(sqrt({_mse(_IW, 'v')}), 6) AS model_rmse FROM steps, v WHERE t = 501"""

# ---------------------------------------------------------------- clicks

CLICKS = f"""
click_fields AS (
  SELECT {LINE_KEY} AS row_id, l_orderkey % 10 = 0 AS tabbed, [CASE WHEN l_quantity > 40 THEN '1' ELSE '0' END,
    l_returnflag, l_linestatus, p_brand, p_type, p_size::VARCHAR, ''] AS fs
  FROM lineitem JOIN part ON l_partkey = p_partkey),
click_lines AS (
  SELECT row_id, CASE WHEN tabbed THEN array_to_string(fs, chr(9)) ELSE array_to_string(fs, ',') END AS value
  FROM click_fields),
clicks AS (
  SELECT row_id, string_split(regexp_replace(translate(value, chr(9), ','), '^\\s+|\\s+$', '', 'g'), ',') AS f
  FROM click_lines),
click_rows AS (SELECT row_id, f[1]::DOUBLE AS label, f[2:] AS cats FROM clicks),
click_parts AS (SELECT *, {_split("row_id", 0.8, 0.9)} AS split FROM click_rows),
feats AS (
  SELECT row_id, label, split, (generate_subscripts(cats, 1) - 1)::INT AS idx, unnest(cats) AS cat
  FROM click_parts)"""


def _dictionary(where: str) -> str:
    return f"""
dictionary AS (
  SELECT idx, cat, n, row_number() OVER (ORDER BY idx, cat) - 1 AS ordinal
  FROM (SELECT idx, cat, count(*) AS n FROM feats WHERE {where} GROUP BY 1, 2))"""


def _encoded(where: str) -> str:
    return f"""
encoded AS (
  SELECT row_id, label, coalesce(string_agg(ordinal::VARCHAR || ':1', ' ' ORDER BY ordinal), '') AS features,
    count(ordinal) AS nnz
  FROM (SELECT * FROM feats WHERE {where}) LEFT JOIN dictionary USING (idx, cat) GROUP BY 1, 2)"""


def _hashed(buckets: int) -> str:
    fold = "0::BIGINT"
    for start in (1, 9, 17, 25):
        fold = f"(({fold}) * 4294967296 + ('0x' || substr(h, {start}, 8))::BIGINT) % {buckets}"
    return f"""
names AS (SELECT DISTINCT row_id, label, md5(cat || idx::VARCHAR) AS h FROM feats),
places AS (SELECT row_id, label, {fold} AS place, count(*) AS n FROM names GROUP BY 1, 2, 3),
hashed AS (SELECT row_id, label, count(*) AS nnz,
  string_agg(place::VARCHAR || ':' || n::VARCHAR, ' ' ORDER BY place) AS features
  FROM places GROUP BY 1, 2)"""


LOSS = """CASE WHEN {y} = 1 THEN -ln(CASE WHEN {p} = 0 THEN {p} + 10e-12 WHEN {p} = 1 THEN {p} - 10e-12 ELSE {p} END)
  WHEN {y} = 0 THEN -ln(1 - CASE WHEN {p} = 0 THEN {p} + 10e-12 WHEN {p} = 1 THEN {p} - 10e-12 ELSE {p} END) END"""
FIXED_SCORES = f"""{CLICKS}, {_dictionary('true')},
raw_scores AS (
  SELECT row_id, label, sum((ordinal % 7 - 3) / 10.0::DOUBLE) - 1.0 AS z
  FROM feats JOIN dictionary USING (idx, cat) GROUP BY 1, 2),
scores AS (SELECT row_id, label, 1 / (1 + exp(-greatest(least(z, 20.0), -20.0))) AS p FROM raw_scores)"""

TWINS["click_parse"] = f"""WITH {CLICKS}
SELECT label, idx, cat, count(*) AS n FROM feats GROUP BY 1, 2, 3"""
TWINS["categories_per_feature"] = f"""WITH {CLICKS}
SELECT idx, count(DISTINCT cat) AS n_categories FROM feats GROUP BY 1"""
TWINS["feature_dictionary"] = f"""WITH {CLICKS}, {_dictionary('true')}
SELECT idx, cat, ordinal FROM dictionary"""
TWINS["one_hot"] = f"""WITH {CLICKS}, {_dictionary('true')}, {_encoded('true')}
SELECT row_id, label, features FROM encoded"""
_TRAINED = f"{CLICKS}, {_dictionary(chr(39).join(['split = ', 'train', '']))}, {_encoded(chr(39).join(['split = ', 'validation', '']))}"
TWINS["one_hot_unseen"] = f"WITH {_TRAINED} SELECT row_id, label, features FROM encoded"
TWINS["feature_count_buckets"] = f"""WITH {CLICKS}, {_dictionary('true')}
SELECT bucket, count(*) AS n_features FROM (
  SELECT pow(2, ceil(log2(n)))::INT AS bucket FROM dictionary WHERE n <= 1024) GROUP BY 1"""
TWINS["nnz_total"] = f"WITH {_TRAINED} SELECT sum(nnz)::BIGINT AS n_nonzero FROM encoded"
TWINS["sparsity"] = f"""WITH {CLICKS}, {_dictionary('true')}, {_encoded('true')}, {_hashed(2**15)}
SELECT 'one_hot' AS kind, round(avg(nnz / (SELECT count(*) FROM dictionary)), 12) AS sparsity FROM encoded
UNION ALL SELECT 'hashed', round(avg(nnz / 32768), 12) FROM hashed"""
TWINS["first_rows_nonzeros"] = f"""WITH {CLICKS}, {_hashed(2**15)}
SELECT sum(nnz)::BIGINT AS total FROM (SELECT nnz FROM hashed ORDER BY row_id LIMIT 20)"""
TWINS["feature_hash"] = f"WITH {CLICKS}, {_hashed(2**15)} SELECT row_id, label, features FROM hashed"
TWINS["feature_hash_narrow"] = f"WITH {CLICKS}, {_hashed(7)} SELECT row_id, label, features FROM hashed"
TWINS["class_fraction"] = f"""WITH {CLICKS}
SELECT split, round(avg((label = 1)::INT), 9) AS positive_share FROM click_parts GROUP BY 1"""
TWINS["baseline_logloss"] = f"""WITH {CLICKS},
base AS (SELECT avg((label = 1)::INT) AS p FROM click_parts WHERE split = 'train')
SELECT split, count(*) AS n, round(avg({LOSS.format(y='label', p='p')}), 9) AS loss
FROM click_parts, base GROUP BY 1"""
TWINS["fixed_weight_scores"] = f"""WITH {FIXED_SCORES}
SELECT row_id, round(p, 9) AS p, round({LOSS.format(y='label', p='p')}, 9) AS loss FROM scores"""
TWINS["fixed_weight_logloss"] = f"""WITH {FIXED_SCORES}
SELECT round(avg({LOSS.format(y='label', p='p')}), 9) AS loss FROM scores"""
TWINS["one_hot_strict"] = f"""WITH {CLICKS},
strict AS (SELECT row_id, split FROM click_parts),
known AS (SELECT DISTINCT idx, cat FROM feats WHERE split = 'train'
  AND row_id IN (SELECT row_id FROM feats WHERE idx = 4 AND cat::INT <= 40)),
unseen AS (SELECT idx, cat, count(*) AS n FROM feats ANTI JOIN known USING (idx, cat) WHERE split = 'test' GROUP BY 1, 2)
SELECT coalesce(sum(n), 0)::BIGINT AS unseen_uses, count(*) AS unseen_features,
  (SELECT count(*) FROM strict WHERE split = 'test') AS n_rows FROM unseen"""


def _fitted(source: str, settings: str, iterations: int) -> str:
    """Logistic descent over `source` (row_id, label, features, split), features as `place:value`:
    fitted (m, slot, w) and settings (m, step, reg). Equal rows are one counted row."""
    return f"""
source AS MATERIALIZED ({source}),
train AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, *
  FROM (SELECT label, features, count(*)::DOUBLE AS k FROM source WHERE split = 'train' GROUP BY 1, 2)),
entries AS MATERIALIZED (
  SELECT rid, split_part(x, ':', 1)::BIGINT AS slot, split_part(x, ':', 2)::DOUBLE AS v
  FROM (SELECT rid, unnest(string_split(features, ' ')) AS x FROM train WHERE features <> '')
  UNION ALL SELECT rid, -1, 1.0 FROM train),
size AS MATERIALIZED (SELECT sum(k) AS n FROM train),
settings(m, step, reg) AS (VALUES {settings}),
steps AS (
  SELECT 1 AS t, m, slot, CASE WHEN slot = -1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS w
  FROM settings, (SELECT DISTINCT slot FROM entries)
  UNION ALL
  SELECT t + 1, s.m, s.slot, w * (1 - step / sqrt(t) * reg) - step / sqrt(t) * g / n
  FROM steps s JOIN settings ON s.m = settings.m, size, (
    SELECT m AS gm, slot AS gslot, sum(v * r) AS g FROM entries JOIN (
      SELECT m, rid, (1 / (1 + exp(-z)) - label) * k AS r FROM train JOIN (
        SELECT m, rid, sum(w * v) AS z FROM steps JOIN entries USING (slot) GROUP BY 1, 2) USING (rid)) USING (rid) GROUP BY 1, 2)
  WHERE gm = s.m AND gslot = s.slot AND t <= {iterations}),
fitted AS MATERIALIZED (SELECT m, slot, w FROM steps WHERE t = {iterations} + 1)"""


def _rated(part: str, name: str = "rated") -> str:
    """Raw scores (m, row_id, label, split, z) of the rows of `source` where `part` holds."""
    return f"""
{name}_uses AS (
  SELECT row_id, split_part(x, ':', 1)::BIGINT AS slot, split_part(x, ':', 2)::DOUBLE AS v
  FROM (SELECT row_id, unnest(string_split(features, ' ')) AS x FROM source WHERE features <> '' AND {part})
  UNION ALL SELECT row_id, -1, 1.0 FROM source WHERE {part}),
{name} AS MATERIALIZED (
  SELECT m, row_id, label, split, sum(v * w) AS z
  FROM {name}_uses JOIN fitted USING (slot) JOIN source USING (row_id) GROUP BY ALL)"""


_P = "(1 / (1 + exp(-greatest(least(z, 20.0), -20.0))))"
_MEAN_LOSS = f"avg({LOSS.format(y='label', p=_P)})"
_HASHED_SOURCE = f"SELECT row_id, label, features, {_split('row_id', 0.8, 0.9)} AS split FROM hashed"
_ONE_SETTINGS = ", ".join(f"({m}, {s}::DOUBLE, {r}::DOUBLE)" for m, (s, r) in enumerate([(1.0, 1e-6), (1.0, 1e-3), (10.0, 1e-6), (10.0, 1e-3)]))


def _hashed_grid(iterations: int) -> str:
    return f"""WITH RECURSIVE {CLICKS}, {_hashed(2**15)}, {_fitted(_HASHED_SOURCE, _ONE_SETTINGS, iterations)},
{_rated("split = 'validation'")},
losses AS MATERIALIZED (SELECT m, step, reg, {_MEAN_LOSS} AS loss FROM rated JOIN settings USING (m) GROUP BY ALL)"""


TWINS["logistic_fit_grid"] = f"""{_hashed_grid(500)}
SELECT step, reg, round(loss, 6) AS loss, loss = (SELECT min(loss) FROM losses) AS best FROM losses"""
TWINS["logistic_grid_test"] = f"""{_hashed_grid(50)},
{_rated("split = 'test'", "tested")},
base AS (SELECT avg((label = 1)::INT) AS p FROM source WHERE split = 'train')
SELECT count(*) AS n, round(avg({LOSS.format(y='label', p='p')}), 6) AS baseline_loss, round({_MEAN_LOSS}, 6) AS model_loss
FROM tested, base WHERE m = (SELECT arg_min(m, loss) FROM losses)"""
_TRAIN_DICTIONARY = _dictionary("split = 'train'")
_ONE_HOT_SOURCE = """SELECT row_id, label, split, coalesce(string_agg(ordinal::VARCHAR || ':1', ' ' ORDER BY ordinal), '') AS features
  FROM feats LEFT JOIN dictionary USING (idx, cat) GROUP BY 1, 2, 3"""


def _one_hot_model(iterations: int) -> str:
    return f"""WITH RECURSIVE {CLICKS}, {_TRAIN_DICTIONARY},
{_fitted(_ONE_HOT_SOURCE, '(0, 10.0::DOUBLE, 1e-6::DOUBLE)', iterations)}"""


TWINS["logistic_one_hot"] = f"""{_one_hot_model(50)}, {_rated("split <> 'test'")}
SELECT split, round({_MEAN_LOSS}, 6) AS loss, round(sum({_P}), 4) AS expected_positives FROM rated GROUP BY 1"""
TWINS["logistic_wide_weights"] = f"""{_one_hot_model(8)}
SELECT slot, round(w, 9) AS weight FROM fitted"""
_AUC = """counts AS (SELECT score, sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS n FROM scored GROUP BY 1),
below AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM counts)
SELECT sum(p)::BIGINT AS positives, sum(n)::BIGINT AS negatives, round(sum(p * (b + n / 2)) / (sum(p) * sum(n)), 9) AS auc FROM below"""
TWINS["logistic_roc_auc"] = f"""{_one_hot_model(50)}, {_rated("split = 'validation'")},
scored AS (SELECT round(z, 7) AS score, label FROM rated), {_AUC}"""
TWINS["roc_auc"] = f"""WITH scored AS (
  SELECT (n_chars % 1000) / 1000.0::DOUBLE AS score, quality::BIGINT AS label FROM labels JOIN documents USING (doc_id)), {_AUC}"""
TWINS["roc_curve"] = """WITH scored AS (
  SELECT doc_id, (n_chars % 1000) / 1000.0::DOUBLE AS score, quality::BIGINT AS label
  FROM labels JOIN documents USING (doc_id)),
run AS (
  SELECT doc_id, score, sum(label) OVER w AS tp, sum(1 - label) OVER w AS fp,
    sum(label) OVER () AS pos, sum(1 - label) OVER () AS neg
  FROM scored
  WINDOW w AS (ORDER BY score DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
whole AS (SELECT sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg FROM scored)
SELECT doc_id, score, tp::BIGINT AS tp, fp::BIGINT AS fp,
  round(tp::DOUBLE / nullif(whole.pos, 0), 9) AS tpr,
  round(fp::DOUBLE / nullif(whole.neg, 0), 9) AS fpr FROM run, whole"""

# ---------------------------------------------------------------- series

SERIES = """
series AS (
  SELECT vec_id, (vec_id % 25)::INT AS x, (vec_id // 25)::INT AS y,
    list_transform(embedding, lambda v: v::DOUBLE + 1.0::DOUBLE) AS s FROM embeddings),
points AS (
  SELECT vec_id, x, y, (generate_subscripts(s, 1) - 1)::INT AS pos, unnest(s) AS v FROM series),
means AS (SELECT vec_id, avg(v) AS m FROM points GROUP BY 1),
rescaled AS (SELECT x, y, pos, (v - m) / m AS v FROM points JOIN means USING (vec_id))"""
VECTORS = """
points AS (
  SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::INT AS pos, unnest(embedding)::DOUBLE AS v
  FROM embeddings),
means AS (SELECT pos, avg(v) AS mean FROM points GROUP BY 1)"""

TWINS["series_lines_parse"] = f"""WITH {SERIES}
SELECT x, y, count(*)::INT AS n, round(sum(v), 6) AS total FROM points GROUP BY 1, 2"""
TWINS["series_minmax"] = f"WITH {SERIES} SELECT min(v) AS low, max(v) AS high FROM points"
TWINS["series_std_filter"] = f"""WITH {SERIES}
SELECT x, y, round(stddev_pop(v), 6) AS sd FROM points GROUP BY 1, 2 HAVING stddev_pop(v) > 0.12"""
TWINS["series_rescale"] = f"WITH {SERIES} SELECT x, y, pos, round(v, 6) AS v FROM rescaled"
TWINS["series_fold"] = f"""WITH {SERIES}
SELECT x, y, (pos % 16)::INT AS pos, round(sum(v), 6) AS v FROM rescaled GROUP BY 1, 2, 3"""
TWINS["series_blocks"] = f"""WITH {SERIES}
SELECT x, y, (pos // 8)::INT AS pos, round(sum(v), 6) AS v FROM rescaled GROUP BY 1, 2, 3"""
TWINS["vector_mean"] = f"WITH {VECTORS} SELECT pos, round(mean, 9) AS mean FROM means"
TWINS["centre"] = f"""WITH {VECTORS}
SELECT vec_id, pos, round(v - mean, 6) AS v FROM points JOIN means USING (pos)"""


def _components(key: str, count: int) -> str:
    """Leading components of `points` (key, pos, v), as of `_eigen`."""
    return f"""
cov0 AS MATERIALIZED (
  SELECT a.pos AS i, b.pos AS j, covar_pop(a.v, b.v) AS v FROM points a JOIN points b USING ({key}) GROUP BY 1, 2),{_eigen(count)}"""


def _scores(key: str, count: int) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, {c}::INT AS component, round(sum(v * w), 6) AS score FROM points JOIN dir{c} USING (pos) GROUP BY ALL"
        for c in range(count))


TWINS["pca"] = f"WITH RECURSIVE {VECTORS}, {_components('vec_id', 2)} {_scores('vec_id', 2)}"
TWINS["project_back"] = f"""WITH RECURSIVE {VECTORS}, {_components('vec_id', 1)},
along AS (
  SELECT vec_id, sum((v - mean) * w) / (SELECT sum(w * w) FROM dir0) AS share
  FROM points JOIN means USING (pos) JOIN dir0 USING (pos) GROUP BY 1)
SELECT vec_id, pos, round(share * w + mean, 6) AS v FROM along, dir0 JOIN means USING (pos)"""
TWINS["variance_shares"] = f"""WITH RECURSIVE {VECTORS}, {_components('vec_id', 3)},
whole AS (SELECT sum(v) AS total FROM cov0 WHERE i = j)
SELECT 1::INT AS k, round(val0.l / total, 9) AS share FROM whole, val0
UNION ALL SELECT 2, round((val0.l + val1.l) / total, 9) FROM whole, val0, val1
UNION ALL SELECT 3, round((val0.l + val1.l + val2.l) / total, 9) FROM whole, val0, val1, val2"""
TWINS["eigenvalue_sums"] = f"""WITH {VECTORS},
cov AS MATERIALIZED (
  SELECT a.pos AS i, b.pos AS j, covar_pop(a.v, b.v) AS v FROM points a JOIN points b USING (vec_id) GROUP BY 1, 2),
square AS MATERIALIZED (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM cov a JOIN cov b ON a.j = b.i GROUP BY 1, 2)
SELECT 1::INT AS power, round(sum(v), 9) AS total FROM cov WHERE i = j
UNION ALL SELECT 2, round(sum(v * v), 9) FROM cov
UNION ALL SELECT 3, round(sum(cov.v * square.v), 9) FROM cov JOIN square USING (i, j)
UNION ALL SELECT 4, round(sum(v * v), 9) FROM square"""
for _name, _points in (("pca_rescaled", "pos"), ("pca_folded", "(pos % 16)::INT"), ("pca_blocks", "(pos // 8)::INT")):
    _changed = SERIES.replace("points AS", "raw_points AS").replace("FROM points", "FROM raw_points")
    TWINS[_name] = f"""WITH RECURSIVE {_changed},
points AS MATERIALIZED (SELECT x, y, {_points} AS pos, sum(v) AS v FROM rescaled GROUP BY ALL),
{_components('x, y', 3)} {_scores('x, y', 3)}"""
TWINS["covariance"] = f"""WITH {VECTORS}
SELECT a.pos AS i, b.pos AS j, round(covar_pop(a.v, b.v), 9) AS cov
FROM points a JOIN points b USING (vec_id) GROUP BY 1, 2"""
