"""DuckDB oracle SQL for the registered queries (same semantics, independent engine).

Shared CTE fragments mirror the adapters of ``sources.adapters``.  DuckDB has no
NFKC; on the driver tables NFKC equals NFC for every token, so ``nfc_normalize``
stands in (checked over sf0.01 and sf0.1 documents, conversations and pages).
"""

from __future__ import annotations

from wordtide.functions.stats import REGRESSION_POINTS
from wordtide.functions.text import DELETED_LONG_MARKS, DELETED_SYMBOLS, TOKEN_PATTERN_RE2
from wordtide.sources.adapters import BLOCKED_WORDS, CONVERSATION_DAYS, CONVERSATION_EPOCH


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _char_class(chars: str) -> str:
    out = []
    for ch in chars:
        out.append("\\" + ch if ch in "\\-[]^" else ch)
    return "[" + "".join(out) + "]"


def norm_sql(t: str) -> str:
    """T3/T4 in DuckDB SQL for a surface expression ``t``."""
    x = f"lower(nfc_normalize({t}))"
    x = f"regexp_replace({x}, {_sql_str(_char_class(DELETED_SYMBOLS + DELETED_LONG_MARKS))}, '', 'g')"
    ws = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    x = f"trim(regexp_replace({x}, {_sql_str(ws)}, ' ', 'g'), ' ')"
    return f"(CASE WHEN {t} IS NULL OR length({x}) <= 1 THEN '' ELSE {x} END)"


BLOCKED_SQL = "(" + ", ".join(_sql_str(w) for w in BLOCKED_WORDS) + ")"
TOKENS_SQL = f"regexp_extract_all(content, {_sql_str(TOKEN_PATTERN_RE2)})"

POSTS_LINEITEM = """
posts AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS board_key,
         CAST(l_orderkey AS VARCHAR) AS thread_path, l_linenumber AS post_no, p_name AS content
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

POSTS_CONVERSATIONS = f"""
posts AS (
  SELECT CAST(DATE '{CONVERSATION_EPOCH}' + CAST(conv_id % {CONVERSATION_DAYS} AS INTEGER) AS DATE) AS date,
         role AS board_key, CAST(conv_id AS VARCHAR) AS thread_path, CAST(turn AS INTEGER) AS post_no,
         text AS content
  FROM conversations)"""


def daily_ctes(posts_cte: str = POSTS_LINEITEM) -> str:
    """posts -> tok (per-post normalised terms) -> stats, metrics, runs, valid."""
    return f"""WITH {posts_cte},
tok AS (
  SELECT date, board_key, thread_path, post_no, {TOKENS_SQL} AS tokens FROM posts),
normed AS (
  SELECT date, board_key, thread_path, tokens,
         list_transform(tokens, lambda t: {norm_sql('t')}) AS nterms FROM tok),
occ AS (
  SELECT date, board_key, thread_path,
         list_distinct(list_filter(nterms, lambda t: t <> '' AND t NOT IN {BLOCKED_SQL})) AS terms
  FROM normed),
stats AS (
  SELECT date, board_key, term, CAST(count(*) AS BIGINT) AS post_hits,
         CAST(count(DISTINCT thread_path) AS BIGINT) AS thread_hits
  FROM (SELECT date, board_key, thread_path, unnest(terms) AS term FROM occ)
  GROUP BY date, board_key, term),
metrics AS (
  SELECT date, board_key,
         CAST(count(DISTINCT thread_path) AS BIGINT) AS fetched_threads,
         CAST(count(*) AS BIGINT) AS fetched_posts,
         CAST(sum(len(tokens)) AS BIGINT) AS total_tokens,
         CAST(sum(len(list_filter(nterms, lambda t: t = '' OR t IN {BLOCKED_SQL}))) AS BIGINT) AS filtered_tokens
  FROM normed GROUP BY date, board_key),
runs AS (
  SELECT date, board_key,
         CASE WHEN day(date) % 9 = 0 THEN 'failed' ELSE 'success' END AS status,
         day(date) % 18 = 0 AS is_recovered
  FROM (SELECT DISTINCT date, board_key FROM posts)),
valid AS (
  SELECT date, board_key FROM runs WHERE status = 'success' OR is_recovered)"""


def weekly_ctes(posts_cte: str = POSTS_LINEITEM) -> str:
    return daily_ctes(posts_cte) + """,
wagg AS (
  SELECT CAST(date_trunc('week', s.date) AS DATE) AS week_start_date, s.board_key, s.term,
         CAST(sum(s.post_hits) AS BIGINT) AS post_hits, CAST(sum(s.thread_hits) AS BIGINT) AS thread_hits
  FROM stats s SEMI JOIN valid v ON s.date = v.date AND s.board_key = v.board_key
  GROUP BY 1, 2, 3),
wtot AS (
  SELECT CAST(date_trunc('week', m.date) AS DATE) AS week_start_date, m.board_key,
         CAST(sum(m.fetched_posts) AS BIGINT) AS total_posts
  FROM metrics m SEMI JOIN valid v ON m.date = v.date AND m.board_key = v.board_key
  GROUP BY 1, 2),
rates AS (
  SELECT a.*, coalesce(t.total_posts, 0) AS total_posts,
         CASE WHEN coalesce(t.total_posts, 0) = 0 THEN 0.0
              ELSE a.post_hits / CAST(t.total_posts AS DOUBLE) END AS appearance_rate,
         date_diff('day', DATE '1970-01-01', a.week_start_date) AS dnum
  FROM wagg a LEFT JOIN wtot t USING (week_start_date, board_key)),
zs AS (
  SELECT *,
    count(appearance_rate) OVER h AS n_hist, avg(appearance_rate) OVER h AS mean_hist,
    stddev_samp(appearance_rate) OVER h AS sd_hist
  FROM rates
  WINDOW h AS (PARTITION BY board_key, term ORDER BY dnum RANGE BETWEEN 49 PRECEDING AND 1 PRECEDING)),
trends AS (
  SELECT *, CASE WHEN n_hist < 7 THEN NULL WHEN sd_hist < 1e-10 THEN 0.0
                 ELSE (appearance_rate - mean_hist) / sd_hist END AS zscore
  FROM zs)"""


def flagship_sql(limit: int) -> str:
    return weekly_ctes() + f"""
SELECT strftime(week_start_date, '%Y-%m-%d') AS week_start_date, board_key, term, post_hits, total_posts,
       (round(appearance_rate, 9) + 0.0) AS appearance_rate, (round(zscore, 9) + 0.0) AS zscore,
       CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY week_start_date, board_key
                                   ORDER BY zscore DESC NULLS LAST, term) AS rank
      FROM trends)
WHERE rank <= {limit}"""


def rnd(e: str) -> str:
    return f"(round({e}, 9) + 0.0)"


def iso(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%d')"


#: 97.5 % quantile of Student's t with 6 degrees of freedom, to the last digit of a double
T_QUANTILE = "2.4469118511449692"
#: nodes and weights of the 3-point Gauss rule on [0, 1]
GAUSS = [(0.5 - 0.15 ** 0.5, 5 / 18), (0.5, 8 / 18), (0.5 + 0.15 ** 0.5, 5 / 18)]


def regression_ctes() -> str:
    """W8-W12 from the definitions: the 8 rates of the frame as a list, sums over positions 0..7, residuals one by
    one, and the tail of Student's t with 6 degrees of freedom by quadrature.

    With v = |t| / sqrt(6 + t^2) the two-sided tail is 15/8 * integral of (1 - u^2)^2 over u in [v, 1], a polynomial
    of degree 4, for which the 3-point Gauss rule is exact; 1 - v is formed without cancellation.
    """
    total = lambda e: f"list_sum(list_transform(range(8), lambda i: {e}))"
    y = "ys[i + 1]"
    nodes = " + ".join(f"{w!r} * pow(_c * {x!r} * (2.0 - _c * {x!r}), 2)" for x, w in GAUSS)
    return f""",
fr AS (
  SELECT *, list(appearance_rate) OVER g AS ys
  FROM trends WINDOW g AS (PARTITION BY board_key, term ORDER BY dnum RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
line AS (SELECT *, {total(f"(i - 3.5) * {y}")} / 42.0 AS slope, list_sum(ys) / 8.0 AS _ybar FROM fr WHERE len(ys) = {REGRESSION_POINTS}),
resid AS (
  SELECT *, _ybar - 3.5 * slope AS intercept, {total(f"pow({y} - _ybar - slope * (i - 3.5), 2)")} AS _sse,
         {total(f"pow({y} - _ybar, 2)")} AS _sst, list_max(ys) = list_min(ys) AS _flat FROM line),
err AS (SELECT *, sqrt(_sse / 6.0 / 42.0) AS _se_b, sqrt(_sse / 6.0 * (1.0 / 8.0 + 3.5 * 3.5 / 42.0)) AS _se_a FROM resid),
tail AS (SELECT *, slope * slope / nullif(_se_b * _se_b, 0.0) AS _t2 FROM err),
cap AS (SELECT *, 6.0 / (6.0 + _t2) / (1.0 + sqrt(_t2 / (6.0 + _t2))) AS _c FROM tail),
regcols AS (
  SELECT *, intercept - {T_QUANTILE} * _se_a AS intercept_ci_lower, intercept + {T_QUANTILE} * _se_a AS intercept_ci_upper,
         slope - {T_QUANTILE} * _se_b AS slope_ci_lower, slope + {T_QUANTILE} * _se_b AS slope_ci_upper,
         CASE WHEN _flat THEN NULL WHEN _c IS NULL THEN 0.0 ELSE 15.0 / 8.0 * _c * ({nodes}) END AS p_value,
         CASE WHEN NOT _flat THEN 1.0 - _sse / _sst END AS r_squared,
         CAST(week_start_date - 49 AS DATE) AS analysis_start_date,
         CAST(week_start_date + 6 AS DATE) AS analysis_end_date
  FROM cap),
latest AS (
  SELECT * FROM regcols
  QUALIFY row_number() OVER (PARTITION BY board_key, term ORDER BY week_start_date DESC) = 1)"""


def regression_points_sql(points: tuple) -> str:
    """W8-W12 over any number of points: sums over the list of rates; the distribution of |T| by Simpson's rule on
    C cos(u)^(df - 1) over the angle, quantiles by bisection on it."""
    total = lambda e: f"list_sum(list_transform(range(points), lambda i: {e}))"
    y, n = "ys[i + 1]", 2000

    def inside(angle: str) -> str:
        """P(|T| <= sqrt(df) tan(angle)): twice the integral from 0 to angle."""
        f = f"power(cos({angle} * k / {n}.0), df - 1) * (CASE WHEN k IN (0, {n}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END)"
        return f"(2 * c * {angle} / {3 * n}.0 * list_sum(list_transform(range({n + 1}), lambda k: {f})))"

    frames = " UNION ALL ".join(
        f"SELECT {p} AS points, *, list(appearance_rate) OVER (PARTITION BY board_key, term ORDER BY dnum RANGE BETWEEN {7 * (p - 1)} PRECEDING AND CURRENT ROW) AS ys "
        f"FROM rates" for p in points)
    return weekly_ctes().replace("WITH ", "WITH RECURSIVE ", 1) + f""",
df AS (
  SELECT p AS points, p - 2 AS df, exp(lgamma((p - 1) / 2.0) - lgamma((p - 2) / 2.0)) / sqrt(pi()) AS c FROM (VALUES {', '.join(f'({p})' for p in points)}) v(p)),
bis AS (
  SELECT points, df, c, 0 AS step, 0.0::DOUBLE AS lo, pi() / 2 AS hi FROM df
  UNION ALL
  SELECT points, df, c, step + 1, CASE WHEN {inside('mid')} < 0.95 THEN mid ELSE lo END, CASE WHEN {inside('mid')} < 0.95 THEN hi ELSE mid END
  FROM (SELECT *, (lo + hi) / 2 AS mid FROM bis) WHERE step < 60),
q AS (SELECT points, df, c, sqrt(df) * tan((lo + hi) / 2) AS q FROM bis WHERE step = 60),
fr AS ({frames}),
line AS (
  SELECT *, {total(f"(i - (points - 1) / 2.0) * {y}")} / (points * (points * points - 1) / 12.0) AS slope, list_sum(ys) / points AS _ybar,
         points * (points * points - 1) / 12.0 AS _sxx FROM fr JOIN q USING (points) WHERE len(ys) = points),
resid AS (
  SELECT *, _ybar - (points - 1) / 2.0 * slope AS intercept, {total(f"power({y} - _ybar - slope * (i - (points - 1) / 2.0), 2)")} AS _sse,
         {total(f"power({y} - _ybar, 2)")} AS _sst, list_max(ys) = list_min(ys) AS _flat FROM line),
err AS (
  SELECT *, sqrt(_sse / df / _sxx) AS _se_b, sqrt(_sse / df * (1.0 / points + power((points - 1) / 2.0, 2) / _sxx)) AS _se_a FROM resid),
angle AS (SELECT *, atan2(abs(slope), _se_b * sqrt(df)) AS _angle FROM err)
SELECT points, {iso('week_start_date')} AS week_start_date, board_key, term, {rnd('intercept')} AS intercept, {rnd('slope')} AS slope,
       {rnd('intercept - q * _se_a')} AS intercept_ci_lower, {rnd('intercept + q * _se_a')} AS intercept_ci_upper,
       {rnd('slope - q * _se_b')} AS slope_ci_lower, {rnd('slope + q * _se_b')} AS slope_ci_upper,
       CASE WHEN NOT _flat THEN {rnd(f"greatest(1.0 - {inside('_angle')}, 0.0)")} END AS p_value,
       CASE WHEN NOT _flat THEN {rnd('1.0 - _sse / _sst')} END AS r_squared,
       {iso('CAST(week_start_date - 7 * (points - 1) AS DATE)')} AS analysis_start_date, {iso('CAST(week_start_date + 6 AS DATE)')} AS analysis_end_date
FROM angle"""


REG_OUT = ["intercept", "slope", "intercept_ci_lower", "intercept_ci_upper", "slope_ci_lower",
           "slope_ci_upper", "p_value"]

def html_lines_sql(html: str) -> str:
    """S8 on the regular markup of ``pages``: text between tags, entities decoded, stripped, empty pieces dropped, joined by line breaks."""
    x = f"regexp_replace({html}, '(?s)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', '<>', 'g')"
    t = "s"
    for name, ch in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        t = f"replace({t}, '{name}', '{ch}')"
    strip = f"regexp_replace({t}, '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g')"
    return f"array_to_string(list_filter(list_transform(string_split_regex({x}, '<[^>]*>'), lambda s: {strip}), lambda s: s <> ''), chr(10))"


CRAWL_SQL = """,
lp AS (SELECT * FROM posts),
days AS (SELECT DISTINCT board_key, thread_path, date FROM lp),
crawl_days AS (SELECT DISTINCT board_key, date AS target_date FROM lp),
listing AS (
  SELECT DISTINCT d.board_key, d.thread_path, CAST(d.date + CAST(k AS INTEGER) AS DATE) AS target_date
  FROM days d, range(-1, 7) t(k)
  SEMI JOIN crawl_days c ON c.board_key = d.board_key AND c.target_date = CAST(d.date + CAST(k AS INTEGER) AS DATE)),
flag AS (
  SELECT l.board_key, l.target_date, l.thread_path, -CAST(l.thread_path AS BIGINT) AS position,
         coalesce(p.date = l.target_date, false) AS is_target,
         coalesce(p.date = l.target_date + 1, false) AS is_next
  FROM listing l LEFT JOIN lp p ON p.board_key = l.board_key AND p.thread_path = l.thread_path),
act AS (
  SELECT board_key, target_date, thread_path, position, bool_or(is_target OR is_next) AS active
  FROM flag GROUP BY ALL),
cut AS (SELECT board_key, target_date, min(position) AS cutoff FROM act WHERE NOT active GROUP BY ALL),
kept AS (
  SELECT f.* FROM flag f LEFT JOIN cut c USING (board_key, target_date)
  WHERE f.is_target AND (c.cutoff IS NULL OR f.position < c.cutoff))"""

PATH_RE_SQL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"


def thread_id_sql(u: str) -> str:
    parts = f"list_filter(string_split(regexp_extract({u}, '{PATH_RE_SQL}', 1), '/'), lambda z: z <> '')"
    return (f"(CASE WHEN list_position({parts}, 'read.cgi') > 0 "
            f"THEN {parts}[list_position({parts}, 'read.cgi') + 2] END)")


NAV_LINKS_SQL = r"""
links AS (
  SELECT page_id, url, unnest(hrefs) AS href, unnest(titles) AS raw_title,
         CAST(unnest(range(len(hrefs))) AS INTEGER) AS position
  FROM (SELECT page_id, url,
               regexp_extract_all(html, '<li><a href="(/[^"]*)">[^<]*</a>', 1) AS hrefs,
               regexp_extract_all(html, '<li><a href="/[^"]*">([^<]*)</a>', 1) AS titles
        FROM pages)),
threads AS (
  SELECT page_id, url, position,
         regexp_replace(regexp_replace(href, '/l\d+/?$', ''), '/+$', '') AS thread_path,
         regexp_replace(regexp_replace(trim(raw_title), '^\d+:\s*', ''), '\s*\(\d+\)$', '') AS title
  FROM links)"""


def build(limit: int) -> dict[str, str]:
    w = weekly_ctes()
    d = daily_ctes()
    reg = w + regression_ctes()
    q = {}
    q["flagship_trending"] = flagship_sql(limit)
    q["w2_weekly_aggregation"] = w + """,
wall AS (
  SELECT CAST(date_trunc('week', date) AS DATE) AS week_start_date, board_key,
         CAST(sum(fetched_posts) AS BIGINT) AS total_posts_all
  FROM metrics GROUP BY 1, 2)
SELECT strftime(r.week_start_date, '%Y-%m-%d') AS week_start_date, r.board_key, r.term, r.post_hits,
       r.thread_hits, r.total_posts, coalesce(a.total_posts_all, 0) AS total_posts_all
FROM rates r LEFT JOIN wall a USING (week_start_date, board_key)"""
    q["w7_weekly_trends"] = w + f"""
SELECT {iso('week_start_date')} AS week_start_date, board_key, term, post_hits, total_posts,
       {rnd('appearance_rate')} AS appearance_rate, {rnd('zscore')} AS zscore
FROM trends"""
    q["w8_regression"] = reg + f"""
SELECT {iso('week_start_date')} AS week_start_date, board_key, term,
       {', '.join(f'{rnd(c)} AS {c}' for c in REG_OUT + ['r_squared'])},
       {iso('analysis_start_date')} AS analysis_start_date, {iso('analysis_end_date')} AS analysis_end_date
FROM regcols"""
    q["w9_regression_points"] = regression_points_sql((3, 5, 8, 13))
    q["w14_latest_regression"] = reg + f"""
SELECT board_key, term, {', '.join(f'{rnd(c)} AS {c}' for c in REG_OUT)},
       {iso('analysis_start_date')} AS analysis_start_date, {iso('analysis_end_date')} AS analysis_end_date
FROM latest"""
    q["w17_growth_ranking"] = reg + f"""
SELECT board_key, term, {rnd('slope')} AS slope, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY board_key ORDER BY slope DESC, term) AS rank FROM latest)
WHERE rank <= 5"""
    q["w16_w18_lookups"] = reg + f"""
SELECT 'history' AS lookup, {iso('week_start_date')} AS week_start_date, board_key, term,
       {rnd('appearance_rate')} AS value
FROM trends WHERE term = 'ring' AND board_key = 'A'
  AND week_start_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
UNION ALL
SELECT 'regression', {iso('analysis_start_date')}, board_key, term, {rnd('slope')}
FROM latest WHERE board_key = 'R' AND term = 'gear'"""
    cal = """,
weeks AS (SELECT DISTINCT CAST(date_trunc('week', date) AS DATE) AS week_start_date, board_key FROM posts),
cal AS (SELECT week_start_date, board_key, CAST(week_start_date + CAST(k AS INTEGER) AS DATE) AS date FROM weeks, range(7) t(k)),
calv AS (
  SELECT c.*, coalesce(r.status = 'success' OR r.is_recovered, false) AS is_valid
  FROM cal c LEFT JOIN runs r ON r.date = c.date AND r.board_key = c.board_key),
summ AS (
  SELECT week_start_date, board_key, CAST(count(*) FILTER (WHERE is_valid) AS INTEGER) AS valid_days,
         coalesce(string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) FILTER (WHERE NOT is_valid), '')
           AS invalid_dates
  FROM calv GROUP BY 1, 2)"""
    q["w21_weekly_summary"] = w + cal + f"""
SELECT {iso('s.week_start_date')} AS week_start_date, s.board_key,
       coalesce(g.n_ok, 0) AS processed_terms, coalesce(g.n_bad, 0) AS error_terms, s.valid_days, s.invalid_dates,
       0 AS duration_sec
FROM summ s LEFT JOIN (
  SELECT week_start_date, board_key,
         count(*) FILTER (WHERE appearance_rate BETWEEN 0 AND 1 AND post_hits >= 0 AND total_posts >= 0) AS n_ok,
         count(*) FILTER (WHERE NOT (appearance_rate BETWEEN 0 AND 1 AND post_hits >= 0 AND total_posts >= 0))
           AS n_bad
  FROM rates GROUP BY 1, 2) g USING (week_start_date, board_key)"""
    q["l6_collection_check"] = d + cal + f"""
SELECT {iso('week_start_date')} AS week_start_date, board_key, valid_days, invalid_dates FROM summ"""
    q["a_daily_term_stats"] = d + """
SELECT strftime(date, '%Y-%m-%d') AS date, board_key, term, post_hits, thread_hits FROM stats"""
    q["a_daily_metrics"] = d + """
SELECT strftime(m.date, '%Y-%m-%d') AS date, m.board_key,
       m.board_key || ':' || strftime(m.date, '%Y-%m-%d') AS run_id,
       fetched_threads, fetched_posts, fetched_posts AS parsed_posts, CAST(0 AS BIGINT) AS parse_fail_posts,
       CAST(0 AS BIGINT) AS tokenize_fail_posts, filtered_tokens, total_tokens,
       (round(CASE WHEN total_tokens = 0 THEN 0.0 ELSE filtered_tokens / CAST(total_tokens AS DOUBLE) END, 9) + 0.0)
         AS filtered_rate,
       CAST(dayofyear(m.date) % 50 + 10 AS INTEGER) AS duration_sec
FROM metrics m"""
    q["a9_top_terms"] = d + """
SELECT strftime(date, '%Y-%m-%d') AS date, board_key, term, post_hits, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY date, board_key ORDER BY post_hits DESC, term) AS rank FROM stats)
WHERE rank > 1 AND rank <= 4"""
    q["a10_metrics_lookup"] = d + """
SELECT strftime(date, '%Y-%m-%d') AS date, board_key, fetched_posts, total_tokens, filtered_tokens
FROM metrics WHERE date = DATE '1996-03-04' AND board_key = 'R'"""
    dc = daily_ctes(POSTS_CONVERSATIONS)
    q["t_conversation_stats"] = dc + """
SELECT strftime(date, '%Y-%m-%d') AS date, board_key, term, post_hits, thread_hits FROM stats"""
    q["t_conversation_metrics"] = dc + """
SELECT strftime(date, '%Y-%m-%d') AS date, board_key, fetched_threads, fetched_posts, total_tokens,
       filtered_tokens,
       (round(CASE WHEN total_tokens = 0 THEN 0.0 ELSE filtered_tokens / CAST(total_tokens AS DOUBLE) END, 9) + 0.0)
         AS filtered_rate
FROM metrics"""
    q["t3_document_terms"] = f"""
SELECT surface, {norm_sql('surface')} AS normalized FROM (
  SELECT DISTINCT unnest(regexp_extract_all(text, {_sql_str(TOKEN_PATTERN_RE2)})) AS surface FROM documents)
WHERE surface IS NOT NULL"""
    terms = d + f""",
dict AS (SELECT DISTINCT t AS normalized FROM (SELECT unnest(nterms) AS t FROM normed) WHERE t <> '')"""
    q["d3_dictionary"] = terms + f"""
SELECT count(*) AS n_terms, CAST(1 AS BIGINT) AS min_id, count(*) AS max_id, count(*) AS n_ids,
       count(*) AS n_texts, count(*) FILTER (WHERE normalized IN {BLOCKED_SQL}) AS n_blocked
FROM dict"""
    ledger = d + """,
fin AS (
  SELECT *, CAST(date AS TIMESTAMP) + INTERVAL 17 HOUR + to_seconds(dayofyear(date) % 50 + 10) AS finished_at,
         board_key || ':' || strftime(date, '%Y-%m-%d') AS run_id
  FROM runs)"""
    q["l1_l5_ledger"] = ledger + """
SELECT run_id, strftime(date, '%Y-%m-%d') AS target_date, board_key,
       CASE WHEN status = 'failed' AND is_recovered THEN 'success' ELSE status END AS status,
       is_recovered, strftime(finished_at, '%Y-%m-%d %H:%M:%S') AS finished_at
FROM fin"""
    q["l2_l4_lookups"] = ledger + """
SELECT 'range' AS lookup, run_id, strftime(date, '%Y-%m-%d') AS target_date, board_key, status FROM fin
WHERE board_key = 'N' AND date BETWEEN DATE '1996-01-01' AND DATE '1996-01-31'
UNION ALL
SELECT 'date_board', run_id, strftime(date, '%Y-%m-%d'), board_key, status FROM fin
WHERE board_key = 'A' AND date = DATE '1997-05-05'
UNION ALL
SELECT 'id', run_id, strftime(date, '%Y-%m-%d'), board_key, status FROM fin WHERE run_id = 'R:1998-02-09'"""
    q["s3_page_links"] = "WITH " + NAV_LINKS_SQL.strip() + """
SELECT page_id, position, thread_path, title FROM threads WHERE thread_path <> ''"""
    q["s16_s18_urls"] = "WITH " + NAV_LINKS_SQL.strip() + f"""
SELECT page_id, position,
       coalesce(regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+'), false) AS url_valid,
       {thread_id_sql('url')} AS url_thread_id,
       {thread_id_sql("regexp_extract(url, '^([^?#]*)', 1) || '/test/read.cgi/b/' || CAST(page_id AS VARCHAR) || '/l50'")}
         AS thread_id,
       regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || thread_path AS resolved
FROM threads WHERE thread_path <> ''"""
    kana = "CASE WHEN page_id % 4 = 0 THEN html ELSE regexp_replace(html, '[^\\x00-\\x7f]', 'ｱ', 'g') END"
    q["s2_page_decode"] = f"SELECT page_id, CAST(length({kana}) AS INTEGER) AS n_chars, md5({kana}) AS text_md5 FROM pages"
    q["s1_page_files"] = """
SELECT 'host' || (page_id % 5) || '/' || page_id || '.html' AS path, strlen(html) AS size, sha256(html) AS body_sha256,
       CAST(length(html) AS INTEGER) AS n_chars, CAST(NULL AS VARCHAR) AS error
FROM pages WHERE page_id % 13 <> 0 AND page_id % 5 <> 3 AND html <> ''"""
    q["s7_page_posts"] = f"""
SELECT page_id, CAST(1 AS INTEGER) AS post_no, {html_lines_sql("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS date_text,
       {html_lines_sql("regexp_extract(html, '<article>(.*?)</article>', 1, 's')")} AS content
FROM pages"""
    q["s8_page_text"] = f"""
SELECT page_id, CAST(len(string_split(t, chr(10))) AS INTEGER) AS n_lines, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS text_md5
FROM (SELECT page_id, {html_lines_sql("html")} AS t FROM pages)"""
    q["s11_crawl_cutoff"] = "WITH " + POSTS_LINEITEM.strip() + CRAWL_SQL + """
SELECT strftime(target_date, '%Y-%m-%d') AS target_date, board_key,
       count(DISTINCT thread_path) AS kept_threads, count(*) AS kept_posts
FROM kept GROUP BY ALL"""
    q["s12_crawl_missing_pages"] = "WITH " + POSTS_LINEITEM.strip() + """,
ok AS (SELECT CAST(o_orderkey AS VARCHAR) AS thread_path, o_orderstatus <> 'P' AS page_ok FROM orders),
lp AS (SELECT * FROM posts),
days AS (SELECT DISTINCT board_key, thread_path, date FROM lp),
crawl_days AS (SELECT DISTINCT board_key, date AS target_date FROM lp),
listing AS (
  SELECT DISTINCT d.board_key, d.thread_path, CAST(d.date + CAST(k AS INTEGER) AS DATE) AS target_date
  FROM days d, range(-1, 7) t(k)
  SEMI JOIN crawl_days c ON c.board_key = d.board_key AND c.target_date = CAST(d.date + CAST(k AS INTEGER) AS DATE)),
flag AS (
  SELECT l.board_key, l.target_date, l.thread_path, -CAST(l.thread_path AS BIGINT) AS position,
         coalesce(o.page_ok, false) AS page_ok,
         coalesce(p.date = l.target_date AND o.page_ok, false) AS is_target,
         coalesce(p.date = l.target_date + 1 AND o.page_ok, false) AS is_next
  FROM listing l LEFT JOIN ok o ON o.thread_path = l.thread_path
  LEFT JOIN lp p ON p.board_key = l.board_key AND p.thread_path = l.thread_path),
act AS (
  SELECT board_key, target_date, thread_path, position, page_ok, bool_or(is_target OR is_next) AS active
  FROM flag GROUP BY ALL),
cut AS (SELECT board_key, target_date, min(position) AS cutoff FROM act WHERE page_ok AND NOT active GROUP BY ALL),
kept AS (
  SELECT f.* FROM flag f LEFT JOIN cut c USING (board_key, target_date)
  WHERE f.is_target AND f.page_ok AND (c.cutoff IS NULL OR f.position < c.cutoff))
SELECT strftime(target_date, '%Y-%m-%d') AS target_date, board_key,
       count(DISTINCT thread_path) AS kept_threads, count(*) AS kept_posts
FROM kept GROUP BY ALL"""
    q["s14_dates"] = """
SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ts,
       strftime(CAST(l_shipdate + INTERVAL 9 HOUR AS DATE) - 1, '%Y-%m-%d') AS target_date,
       strftime(l_shipdate, '%Y/%m/%d') || '(' AS day_prefix,
       strftime(CAST(date_trunc('week', l_shipdate) AS DATE) - 7, '%Y-%m-%d') AS week_start,
       strftime(CAST(date_trunc('week', l_shipdate) AS DATE) - 1, '%Y-%m-%d') AS week_end,
       strftime(CAST(date_trunc('week', l_shipdate) AS DATE) - 56, '%Y-%m-%d') AS analysis_start,
       strftime(CAST(date_trunc('week', l_shipdate) AS DATE) - 1, '%Y-%m-%d') AS analysis_end
FROM (SELECT DISTINCT l_shipdate FROM lineitem)"""
    q["u1_upsert"] = w + """,
uagg AS (
  SELECT CAST(date_trunc('week', date) AS DATE) AS week_start_date, board_key, term,
         CAST(sum(post_hits) AS BIGINT) AS post_hits FROM stats GROUP BY 1, 2, 3),
utot AS (
  SELECT CAST(date_trunc('week', date) AS DATE) AS week_start_date, board_key,
         CAST(sum(fetched_posts) AS BIGINT) AS total_posts FROM metrics GROUP BY 1, 2),
upd AS (
  SELECT a.week_start_date, a.board_key, a.term, a.post_hits, coalesce(t.total_posts, 0) AS total_posts,
         CASE WHEN coalesce(t.total_posts, 0) = 0 THEN 0.0 ELSE a.post_hits / CAST(t.total_posts AS DOUBLE) END
           AS appearance_rate
  FROM uagg a LEFT JOIN utot t USING (week_start_date, board_key)
  WHERE year(a.week_start_date) = 1997)
SELECT strftime(coalesce(u.week_start_date, s.week_start_date), '%Y-%m-%d') AS week_start_date,
       coalesce(u.board_key, s.board_key) AS board_key, coalesce(u.term, s.term) AS term,
       CASE WHEN u.term IS NOT NULL THEN u.post_hits ELSE s.post_hits END AS post_hits,
       CASE WHEN u.term IS NOT NULL THEN u.total_posts ELSE s.total_posts END AS total_posts,
       (round(CASE WHEN u.term IS NOT NULL THEN u.appearance_rate ELSE s.appearance_rate END, 9) + 0.0)
         AS appearance_rate,
       CASE WHEN u.term IS NOT NULL THEN NULL ELSE (round(s.zscore, 9) + 0.0) END AS zscore
FROM trends s FULL OUTER JOIN upd u
  ON s.week_start_date = u.week_start_date AND s.board_key = u.board_key AND s.term = u.term"""
    ci = w + """,
pairs AS (SELECT DISTINCT post_hits AS k, total_posts AS n FROM rates WHERE total_posts > 0 AND post_hits <= total_posts)
""" + binomial_ci_ctes("pairs")
    q["w6_binomial_ci"] = ci + f"""
SELECT p.post_hits, p.total_posts, {rnd('c.ci_lower')} AS appearance_rate_ci_lower,
       {rnd('c.ci_upper')} AS appearance_rate_ci_upper
FROM (SELECT DISTINCT post_hits, total_posts FROM rates) p
LEFT JOIN ci c ON c.k = p.post_hits AND c.n = p.total_posts"""
    conv = daily_ctes(POSTS_CONVERSATIONS)
    q["w6_native_ci"] = conv + """,
t AS (
  SELECT s.post_hits, m.fetched_posts, count(*) AS n_terms FROM stats s JOIN metrics m ON m.date = s.date AND m.board_key IS NOT DISTINCT FROM s.board_key GROUP BY ALL),
pairs AS (SELECT DISTINCT post_hits AS k, fetched_posts AS n FROM t WHERE post_hits <= fetched_posts)
""" + binomial_ci_ctes("pairs") + f"""
SELECT t.post_hits, t.fetched_posts, CAST(t.n_terms AS BIGINT) AS n_terms, {rnd('c.ci_lower')} AS appearance_rate_ci_lower,
       {rnd('c.ci_upper')} AS appearance_rate_ci_upper
FROM t LEFT JOIN ci c ON c.k = t.post_hits AND c.n = t.fetched_posts"""
    q["w22_weekly_job"] = ci + f"""
SELECT {iso('t.week_start_date')} AS week_start_date, t.board_key, t.term, t.post_hits, t.total_posts,
       {rnd('t.appearance_rate')} AS appearance_rate, {rnd('c.ci_lower')} AS appearance_rate_ci_lower,
       {rnd('c.ci_upper')} AS appearance_rate_ci_upper, {rnd('t.zscore')} AS zscore
FROM trends t LEFT JOIN ci c ON c.k = t.post_hits AND c.n = t.total_posts"""
    lex = "WITH " + POSTS_LINEITEM.strip() + f""",
nouns AS (SELECT DISTINCT string_split(p_name, ' ')[-1] AS surface FROM part),
tok AS (SELECT row_number() OVER () AS rid, date, board_key, thread_path, {TOKENS_SQL} AS tokens FROM posts),
occ AS (
  SELECT o.rid, o.date, o.board_key, o.thread_path, {norm_sql('o.surface')} AS term
  FROM (SELECT rid, date, board_key, thread_path, unnest(tokens) AS surface FROM tok) o
  SEMI JOIN nouns n ON n.surface = o.surface),
stats AS (
  SELECT date, board_key, term, CAST(count(DISTINCT rid) AS BIGINT) AS post_hits,
         CAST(count(DISTINCT thread_path) AS BIGINT) AS thread_hits
  FROM occ WHERE term <> '' AND term NOT IN {BLOCKED_SQL} GROUP BY ALL),
tm AS (
  SELECT date, board_key, count(*) AS total_tokens,
         count(*) FILTER (WHERE term = '' OR term IN {BLOCKED_SQL}) AS filtered_tokens
  FROM occ GROUP BY ALL),
pm AS (SELECT date, board_key, count(*) AS fetched_posts FROM posts GROUP BY ALL)"""
    q["t2_lexicon_stats"] = lex + """
SELECT strftime(date, '%Y-%m-%d') AS date, board_key, term, post_hits, thread_hits FROM stats"""
    q["t2_lexicon_metrics"] = lex + f"""
SELECT strftime(p.date, '%Y-%m-%d') AS date, p.board_key, CAST(p.fetched_posts AS BIGINT) AS fetched_posts,
       CAST(coalesce(t.total_tokens, 0) AS BIGINT) AS total_tokens,
       CAST(coalesce(t.filtered_tokens, 0) AS BIGINT) AS filtered_tokens,
       {rnd('CASE WHEN coalesce(t.total_tokens, 0) = 0 THEN 0.0 ELSE t.filtered_tokens / CAST(t.total_tokens AS DOUBLE) END')}
         AS filtered_rate
FROM pm p LEFT JOIN tm t USING (date, board_key)"""
    q["i2_duplicate_keys"] = "WITH " + POSTS_LINEITEM.strip() + """
SELECT thread_path, post_no, count(*) AS n FROM posts GROUP BY 1, 2 HAVING count(*) > 1"""
    q["i5_schema_evolution"] = d + """
SELECT board_key || ':' || strftime(date, '%Y-%m-%d') AS run_id, status,
       CASE WHEN year(date) = 1995 THEN false ELSE is_recovered END AS is_recovered
FROM runs"""
    q["j4_runs_metrics"] = d + """
SELECT strftime(m.date, '%Y-%m-%d') AS date, m.board_key, r.status, r.is_recovered, m.fetched_posts
FROM metrics m LEFT JOIN runs r ON r.date = m.date AND r.board_key = m.board_key"""
    return q


def binomial_ci_ctes(pairs: str, alpha: float = 0.05, steps: int = 50) -> str:
    """Clopper-Pearson bounds for the (k, n) rows of CTE ``pairs`` in plain SQL.

    An independent check of the Spark kernel: bisection on binomial tail sums
    (terms from ``lgamma``) instead of the incomplete-beta continued fraction.
    lower: P(X >= k | n, p) = alpha/2;  upper: P(X <= k | n, p) = alpha/2.
    """
    a2 = alpha / 2.0

    def term(p):
        return (f"exp(lgamma(t.n + 1) - lgamma(t.j + 1) - lgamma(t.n - t.j + 1) "
                f"+ t.j * ln({p}) + (t.n - t.j) * ln(1 - {p}))")

    parts = [f""",
cp_terms AS (SELECT k, n, CAST(j AS DOUBLE) AS j FROM {pairs}, range(0, n + 1) r(j)),
lo_0 AS (SELECT k, n, 0.0 AS lo, 1.0 AS hi FROM {pairs}),
up_0 AS (SELECT k, n, 0.0 AS lo, 1.0 AS hi FROM {pairs})"""]
    for i in range(steps):
        mid = "((b.lo + b.hi) / 2)"
        parts.append(f""",
lo_{i + 1} AS (
  SELECT b.k, b.n,
         CASE WHEN sum(CASE WHEN t.j >= b.k THEN {term(mid)} ELSE 0 END) < {a2} THEN {mid} ELSE b.lo END AS lo,
         CASE WHEN sum(CASE WHEN t.j >= b.k THEN {term(mid)} ELSE 0 END) < {a2} THEN b.hi ELSE {mid} END AS hi
  FROM lo_{i} b JOIN cp_terms t ON t.k = b.k AND t.n = b.n GROUP BY b.k, b.n, b.lo, b.hi),
up_{i + 1} AS (
  SELECT b.k, b.n,
         CASE WHEN sum(CASE WHEN t.j <= b.k THEN {term(mid)} ELSE 0 END) > {a2} THEN {mid} ELSE b.lo END AS lo,
         CASE WHEN sum(CASE WHEN t.j <= b.k THEN {term(mid)} ELSE 0 END) > {a2} THEN b.hi ELSE {mid} END AS hi
  FROM up_{i} b JOIN cp_terms t ON t.k = b.k AND t.n = b.n GROUP BY b.k, b.n, b.lo, b.hi)""")
    parts.append(f""",
ci AS (
  SELECT l.k, l.n,
         CASE WHEN l.k = 0 THEN 0.0 ELSE (l.lo + l.hi) / 2 END AS ci_lower,
         CASE WHEN l.k = l.n THEN 1.0 ELSE (u.lo + u.hi) / 2 END AS ci_upper
  FROM lo_{steps} l JOIN up_{steps} u ON u.k = l.k AND u.n = l.n)""")
    return "".join(parts)
