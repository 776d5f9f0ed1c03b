"""SQL of the reference queries for another engine, over views named like the tables."""

from __future__ import annotations

from flashmill.functions import text as T
from flashmill.operators import lexicon as L
from flashmill.operators.expansion import TEMPLATES

WS = r"[\t\n\x0B\f\r\x85\p{Z}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(ws: list[str]) -> str:
    return "[" + ",".join(map(q, ws)) + "]"


def rx(x: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, {q(flags)})"


def clean(x: str) -> str:
    return f"trim({rx(x, WS + '+', ' ')}, ' ')"


def norm(x: str) -> str:
    x = clean(f"coalesce({x}, '')")
    for p in T.DATELINES:
        x = f"trim({rx(x, p)}, ' ')"
    x = rx(x, r"^[【\[][^】\]]{2,120}[】\]]\s*")
    return rx(x, r"[^\p{L}\p{N}_]+")


def html(x: str) -> str:
    return clean(rx(rx(x, r"<br\s*/?>", " ", "gi"), "<.*?>", " "))


POLARITY = "CASE WHEN regexp_matches(polarity, '(?i)正|积极|pos') THEN 'positive' WHEN regexp_matches(polarity, '(?i)负|消极|neg') THEN 'negative' END"
SECONDS = """CASE WHEN regexp_matches(publish_time, '^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}(:\\d{2})?$')
  THEN CAST(epoch(coalesce(try_strptime(publish_time, '%Y-%m-%d %H:%M:%S'), try_strptime(publish_time, '%Y-%m-%d %H:%M'))) AS BIGINT) END"""
DATE = """strftime(CASE WHEN regexp_matches(publish_time, '^\\d{4}[-/]\\d{1,2}[-/]\\d{1,2}(\\D|$)')
  THEN try_strptime(replace(regexp_extract(publish_time, '^\\d{4}[-/]\\d{1,2}[-/]\\d{1,2}'), '/', '-'), '%Y-%m-%d')
  WHEN regexp_matches(publish_time, '^\\d{8}(\\D|$)') THEN try_strptime(substr(publish_time, 1, 8), '%Y%m%d') END, '%Y-%m-%d')"""

NORMAL = f"SELECT seq, publish_time, {norm('title')} AS t, {norm('content')} AS c, {norm('source')} AS s, {norm('publish_time')} AS p FROM news"
KEYED = f"""SELECT *, sha1(CASE WHEN t <> '' AND c <> '' THEN t || chr(10) || c WHEN t <> '' THEN t WHEN c <> '' THEN c ELSE s || chr(10) || p END) AS key,
  CASE WHEN t = c THEN c ELSE t || c END AS txt, {SECONDS} AS sec FROM ({NORMAL})"""
SEEDS = f"""SELECT word, min(polarity) AS polarity FROM (SELECT DISTINCT trim(word) AS word, {POLARITY} AS polarity FROM lexicon)
  WHERE word <> '' AND polarity IS NOT NULL GROUP BY word HAVING count(*) = 1"""

GRAMS = """SELECT seq, unnest(CASE WHEN length(txt) = 1 THEN [txt] ELSE list_transform(range(1, length(txt)), lambda i: substr(txt, i, 2)) END) AS g FROM k WHERE txt <> ''"""
HASHES = f"""SELECT seq, ({" | ".join(f"(CASE WHEN sum(CAST((h >> {b}) & 1 AS BIGINT) * 2 - 1) > 0 THEN {1 << b}::UBIGINT ELSE 0::UBIGINT END)" for b in range(64))}) AS u
  FROM (SELECT seq, CAST(concat('0x', substr(md5(g), 1, 16)) AS UBIGINT) AS h FROM grams) GROUP BY seq"""
SIGNED = "CASE WHEN u >= 9223372036854775808 THEN CAST(CAST(u AS HUGEINT) - 18446744073709551616 AS BIGINT) ELSE CAST(u AS BIGINT) END"
EPOCH = "TRY_CAST(CASE WHEN regexp_matches(trim(publish_time), '^\\d{1,17}$') THEN trim(publish_time) END AS BIGINT)"

#: Triggers by rank, and each text with its matches as marks of the private use area.
RANKED = f"""ranked AS (SELECT *, row_number() OVER (ORDER BY length(word) DESC, ord) AS rk FROM (
    SELECT word, arg_min(event_type, ord) AS event_type, arg_min(direction, ord) AS direction, arg_min(name, ord) AS name, min(ord) AS ord FROM (
      SELECT word, event_type, event_type_name AS name, direction, trigger_id AS ord FROM triggers
      UNION ALL SELECT word, 'price_move', '价格变动', CASE WHEN polarity = 'positive' THEN 'bullish' ELSE 'bearish' END, 1000000 + row_number() OVER (ORDER BY word) FROM ({SEEDS}))
    WHERE word <> '' GROUP BY word)),
  wl AS (SELECT list(word || chr(1) || chr(CAST(57343 + rk AS INTEGER)) ORDER BY rk) AS l FROM ranked)"""
TRIM = " || ".join(f"chr({c})" for c in (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288))


def marked(text: str) -> str:
    return f"""{RANKED},
  src AS (SELECT *, trim({text}, {TRIM}) AS txt FROM news),
  mk AS (SELECT src.*, list_reduce(list_prepend(txt, list_filter(l, lambda x: contains(txt, split_part(x, chr(1), 1)))),
      lambda acc, x: replace(acc, split_part(x, chr(1), 1), split_part(x, chr(1), 2))) AS m FROM src, wl),
  hit AS (SELECT *, unnest(range(1, len(codes) + 1)) AS i FROM (SELECT *, regexp_extract_all(m, '[\ue000-\uf8ff]') AS codes, list_transform(regexp_split_to_array(m, '[\ue000-\uf8ff]'), lambda p: length(p)) AS lens FROM mk)),
  one AS (SELECT h.*, r.word, r.event_type, r.direction AS dir, r.name, list_sum(list_slice(lens, 1, i)) AS before FROM hit h JOIN ranked r ON ord(codes[i]) = 57343 + r.rk),
  ev AS (SELECT *, CAST(before + coalesce(sum(length(word)) OVER (PARTITION BY seq ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s FROM one)"""


def events(text: str) -> str:
    o = L.Ontology([])
    deg = ",".join(f"{{'level': {q(a)}, 'place': {q(b)}, 'word': {q(w)}}}" for a, b, w in o.degree_words())
    neg = sorted(set(o.negations), key=lambda w: (-len(w), w))
    return f"""{marked(text)},
  win AS (SELECT *, s + length(word) AS e, greatest(0, s - 12) AS ws, greatest(0, s - 3) AS ns, greatest(0, s - 15) AS bs FROM ev),
  cut AS (SELECT *, substr(txt, ws + 1, e - ws) AS back, substr(txt, s + 1, e - s + 12) AS ahead, substr(txt, ns + 1, s - ns) AS close, substr(txt, bs + 1, s - bs) AS pre, substr(txt, e + 1, 15) AS post FROM win),
  det AS (SELECT *,
    list_filter({words(L.longest_first(o.before))}, lambda p: contains(back, p) AND (
      (s - (ws + length(back) - instr(reverse(back), reverse(p)) + 1)) BETWEEN 0 AND 4
      OR (ws + length(back) - length(p) - instr(reverse(back), reverse(p)) + 1 <= s AND s <= ws + length(back) - instr(reverse(back), reverse(p)) + 1)))[1] AS r1,
    list_filter({words(L.longest_first(o.after))}, lambda p: contains(ahead, p) AND (
      (s + instr(ahead, p) - 1 - e) BETWEEN 0 AND 4 OR (s + instr(ahead, p) - 1 <= e AND e <= s + instr(ahead, p) - 1 + length(p))))[1] AS r2,
    list_filter({words(neg)}, lambda p: contains(close, p))[1] AS r3,
    list_filter([{deg}], lambda x: contains(CASE WHEN x.place = 'prefix' THEN pre ELSE post END, x.word))[1] AS d FROM cut),
  fin AS (SELECT *, coalesce(r1, r2, r3, '') AS turn FROM det),
  res AS (SELECT seq, publish_time, i, event_type, CASE WHEN (dir = 'bullish') <> (turn <> '') THEN 'bullish' ELSE 'bearish' END AS direction,
    CASE coalesce(d.level, 'moderate') WHEN 'weakening' THEN 'moderate' ELSE coalesce(d.level, 'moderate') END AS degree, word AS trigger_word,
    turn <> '' AS reversed, turn AS reversal_word, coalesce(d.word, '') AS degree_word, CAST(s AS INTEGER) AS position FROM fin)"""


TEXT = "coalesce(nullif(content, ''), nullif(title, ''), '')"
SUMMARY = f"""{events(TEXT)},
  per AS (SELECT seq, count(*) AS n, count(*) FILTER (direction = 'bullish') AS bull FROM res GROUP BY seq),
  ty AS (SELECT seq, string_agg(event_type, ',' ORDER BY c DESC, f) AS types FROM (SELECT seq, event_type, count(*) AS c, min(i) AS f FROM res GROUP BY ALL) GROUP BY seq),
  summ AS (SELECT n0.seq, n0.publish_time, coalesce(n, 0) AS n, coalesce(bull, 0) AS bull, coalesce(types, '') AS types,
    CASE WHEN coalesce(bull, 0) > coalesce(n, 0) - coalesce(bull, 0) THEN 'bullish' WHEN coalesce(bull, 0) < coalesce(n, 0) - coalesce(bull, 0) THEN 'bearish' WHEN coalesce(n, 0) > 0 THEN 'mixed' ELSE 'neutral' END AS net
    FROM news n0 LEFT JOIN per USING (seq) LEFT JOIN ty USING (seq))"""

SCORED = f"""lx AS ({SEEDS}), src AS (SELECT seq, publish_time, {TEXT} AS txt FROM news),
  m AS (SELECT seq, txt, word, CASE WHEN polarity = 'positive' THEN 1 ELSE -1 END AS s, string_split(txt, word) AS parts FROM src JOIN lx ON contains(txt, word)),
  k AS (SELECT seq, txt, word, s, parts, unnest(range(1, len(parts))) AS i FROM m),
  b AS (SELECT seq, s, substr(txt, 1, CAST(list_sum(list_transform(list_slice(parts, 1, i), lambda p: length(p))) + (i - 1) * length(word) AS BIGINT)) AS before FROM k),
  g AS (SELECT seq, CASE WHEN len(list_filter({words(L.SENTIMENT_NEGATIONS)}, lambda n: contains(right(before, 12), n))) > 0 THEN -s ELSE s END AS s FROM b),
  a AS (SELECT seq, count(*) FILTER (s > 0) AS p, count(*) FILTER (s < 0) AS n FROM g GROUP BY seq),
  scored AS (SELECT src.seq, publish_time, CAST(coalesce(p, 0) AS INTEGER) AS positive_count, CAST(coalesce(n, 0) AS INTEGER) AS negative_count,
    CASE WHEN coalesce(p + n, 0) > 0 THEN round(CAST(p - n AS DOUBLE) / (p + n), 4) ELSE 0.0::DOUBLE END AS sentiment_score, CAST(length(txt) AS INTEGER) AS total_words FROM src LEFT JOIN a USING (seq))"""


def _has(ws: list[str]) -> str:
    return "(" + " OR ".join(f"contains(x, {q(w)})" for w in ws) + ")"


FINAL = f"""SELECT word, polarity, source, similarity, confidence FROM (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY (similarity IS NOT NULL), polarity DESC, similarity DESC NULLS LAST, confidence DESC NULLS LAST) AS rn
  FROM (SELECT word, {POLARITY} AS polarity, source, similarity, confidence FROM lexicon)) WHERE rn = 1"""


def oracles() -> dict[str, str]:
    page = "'<p>' || title || '</p><BR/>' || content || ' <a href=''x''>…</a>'"
    raw = clean("coalesce('【' || title || '】 — ' || content, '')")
    sep = q(T.SEPARATORS)
    br = r"^【([^】]{2,120})】((?s:.)*)$"
    has_b = f"regexp_matches(x, {q(br)})"
    bt = f"trim({clean(f'regexp_extract(x, {q(br)}, 1)')}, '【】[]')"
    bb = f"trim(ltrim({clean(f'regexp_extract(x, {q(br)}, 2)')}, {sep}), ' ')"
    out = {
        "news_normalize": f"SELECT seq, md5(t) AS title_md5, md5(c) AS content_md5, CAST(length(txt) AS INTEGER) AS n_chars, key AS dedup_key FROM ({KEYED})",
        "news_sort": f"SELECT seq, {SECONDS} AS local_s FROM news ORDER BY local_s DESC NULLS LAST, seq",
        "time_range_scan": f"SELECT seq, publish_time FROM news WHERE {SECONDS} BETWEEN epoch(TIMESTAMP '2025-01-01 00:00:00') AND epoch(TIMESTAMP '2025-06-30 23:59:59')",
        "time_bucket": f"""SELECT CASE WHEN sec IS NULL THEN 'no_time' ELSE replace(substr(publish_time, 1, 10), '-', '') || '_' || CAST(CAST((sec % 86400) // 7200 AS BIGINT) AS VARCHAR) END AS bucket, count(*) AS n
            FROM (SELECT publish_time, {SECONDS} AS sec FROM news) GROUP BY 1""",
        "epoch_times": f"""SELECT seq, strftime(TIMESTAMP '1970-01-01' + to_seconds(s + 28800), '%Y-%m-%d %H:%M:%S') AS local_time
            FROM (SELECT seq, CASE WHEN v > 10000000000 THEN v // 1000 ELSE v END AS s FROM (SELECT seq, {EPOCH} AS v FROM news)) WHERE s BETWEEN 0 AND 253402214400""",
        "html_clean": f"SELECT seq, md5({html('x')}) AS text_md5, md5({rx(clean('x'), '<[^>]+>')}) AS corpus_md5 FROM (SELECT seq, {page} AS x FROM news)",
        "title_split": f"""SELECT seq, CASE WHEN {has_b} AND {bt} <> '' AND {bb} <> '' THEN {bt} ELSE '' END AS title,
            md5(CASE WHEN {has_b} AND {bt} <> '' AND {bb} <> '' THEN {bb} ELSE x END) AS body_md5 FROM (SELECT seq, {raw} AS x FROM news)""",
        "relevance_filter": f"SELECT seq FROM (SELECT seq, concat_ws(' ', coalesce(title, ''), coalesce(content, '')) AS x FROM news) WHERE {_has(L.RELEVANT)} OR ({_has(L.AMBIGUOUS)} AND NOT {_has(L.FIGURATIVE)})",
        "dedup_exact": f"SELECT arg_min(seq, {{'a': -coalesce(sec, -1152921504606846976), 'b': seq}}) AS seq, count(*) AS copies FROM ({KEYED}) GROUP BY key",
        "removal_ratio": f"SELECT CAST(count(*) AS BIGINT) AS before, count(DISTINCT key) AS after, round(CAST(count(*) - count(DISTINCT key) AS DOUBLE) / count(*), 4) AS removed FROM ({KEYED})",
        "simhash": f"WITH k AS ({KEYED}), grams AS ({GRAMS}), h AS ({HASHES}) SELECT k.seq, coalesce({SIGNED}, 0) AS simhash FROM k LEFT JOIN h ON h.seq = k.seq",
        "near_dup_links": f"""WITH k0 AS ({KEYED}), k AS (SELECT key, sec, min(seq) AS seq, arg_min(txt, seq) AS txt FROM k0 GROUP BY key, sec), grams AS ({GRAMS}), h AS ({HASHES}),
            n AS (SELECT k.seq, sec, u, coalesce(sec // 86400, -1) AS d, unnest(range(0, 8)) AS b FROM k JOIN h USING (seq) WHERE length(txt) >= 16),
            s AS (SELECT *, (u >> CAST(8 * b AS UBIGINT)) & 255 AS v FROM n)
            SELECT seq, count(*) AS links FROM (SELECT DISTINCT a.seq, z.seq AS other FROM s a JOIN s z ON a.d = z.d AND a.b = z.b AND a.v = z.v
              AND (coalesce(z.sec, -1152921504606846976) > coalesce(a.sec, -1152921504606846976) OR (a.sec IS NOT DISTINCT FROM z.sec AND z.seq < a.seq))
              AND coalesce(abs(a.sec - z.sec) <= 7200, true) AND bit_count(xor(a.u, z.u)) <= 12) GROUP BY seq""",
        "trigger_match": f"WITH {marked('coalesce(content, ' + q('') + ')')} SELECT seq, CAST(s AS INTEGER) AS position, word AS trigger_word FROM ev",
        "event_extract": f"WITH {events(TEXT)} SELECT seq, event_type, direction, degree, trigger_word, reversed, reversal_word, degree_word, position FROM res",
        "event_summary": f"WITH {SUMMARY} SELECT seq, CAST(n AS INTEGER) AS event_count, net AS net_direction, types AS event_types FROM summ",
        "batch_stats": f"WITH {SUMMARY} SELECT net AS net_direction, count(*) AS n, count(*) FILTER (n > 0) AS with_events, CAST(sum(n) AS BIGINT) AS events FROM summ GROUP BY 1",
        "commodity_detect": f"""SELECT seq, CASE WHEN g AND s THEN 'gold,silver' WHEN g THEN 'gold' WHEN s THEN 'silver' ELSE 'precious_metals_general' END AS commodities
            FROM (SELECT seq, {_has(L.COMMODITIES['gold'])} AS g, {_has(L.COMMODITIES['silver'])} AS s FROM (SELECT seq, {TEXT} AS x FROM news))""",
        "daily_event_index": f"""WITH {SUMMARY}, dd AS (SELECT *, {DATE} AS date FROM summ), nn AS (SELECT date, count(*) AS news_count FROM dd WHERE date IS NOT NULL GROUP BY 1),
            ty2 AS (SELECT {DATE} AS date, event_type, count(*) AS total, count(*) FILTER (direction = 'bullish') AS bull FROM res GROUP BY ALL),
            by_day AS (SELECT date, sum(total) AS n, sum(bull) AS b, count(*) AS k FROM ty2 WHERE date IS NOT NULL GROUP BY 1),
            js AS (SELECT date, '{{' || string_agg('"' || event_type || '":{{"bullish":' || bull || ',"bearish":' || (total - bull) || ',"total":' || total || '}}', ',' ORDER BY event_type) || '}}' AS a,
              '{{' || string_agg('"' || event_type || '":' || CAST(round(CAST(2 * bull - total AS DOUBLE) / news_count, 6) AS VARCHAR), ',' ORDER BY event_type) || '}}' AS b FROM ty2 JOIN nn USING (date) GROUP BY date)
            SELECT date, news_count, CAST(coalesce(n, 0) AS BIGINT) AS event_count, CAST(coalesce(by_day.b, 0) AS BIGINT) AS bullish_events, CAST(coalesce(n - by_day.b, 0) AS BIGINT) AS bearish_events,
              round(CAST(coalesce(2 * by_day.b - n, 0) AS DOUBLE) / news_count, 6) AS net_event_index, coalesce(k, 0) AS type_count, coalesce(a, '{{}}') AS type_breakdown, coalesce(js.b, '{{}}') AS type_net_index
            FROM nn LEFT JOIN by_day USING (date) LEFT JOIN js USING (date)""",
        "sentiment_score": f"WITH {SCORED} SELECT seq, positive_count, negative_count, sentiment_score, total_words FROM scored",
        "daily_sentiment_index": f"""WITH {SCORED}, dd AS (SELECT *, {DATE} AS date FROM scored)
            SELECT date, count(*) AS news_count, count(*) FILTER (sentiment_score > 0.01) AS positive_count, count(*) FILTER (sentiment_score < -0.01) AS negative_count,
              round(avg(sentiment_score), 6) AS sentiment_intensity, round(coalesce(stddev_samp(sentiment_score), 0), 6) AS sentiment_volatility,
              count(*) - count(*) FILTER (abs(sentiment_score) > 0.01) AS neutral_count,
              CASE WHEN count(*) FILTER (abs(sentiment_score) > 0.01) > 0 THEN round(CAST(greatest(count(*) FILTER (sentiment_score > 0.01), count(*) FILTER (sentiment_score < -0.01)) AS DOUBLE) / count(*) FILTER (abs(sentiment_score) > 0.01), 4) ELSE 0.5::DOUBLE END AS sentiment_consistency
            FROM dd WHERE date IS NOT NULL GROUP BY date""",
        "review_sample_random": "SELECT seq, source FROM news ORDER BY md5('42|' || seq), seq LIMIT 50",
        "review_sample_by_type": """WITH e AS (SELECT DISTINCT review_id, unnest(list_transform(predicted_events, lambda e: e.event_type)) AS sample_type FROM review_items),
            r AS (SELECT *, md5('42|' || review_id) AS d, row_number() OVER (PARTITION BY sample_type ORDER BY md5('42|' || review_id), review_id) AS r FROM e)
            SELECT review_id, sample_type FROM r WHERE r <= greatest(1, 50 // (SELECT count(DISTINCT sample_type) FROM e)) ORDER BY d, sample_type, review_id LIMIT 50""",
        "review_edge_cases": """SELECT review_id FROM review_items WHERE predicted_summary.net_direction = 'mixed' OR predicted_summary.total_events >= 5
            OR len(list_filter(predicted_events, lambda e: e.degree = 'uncertain')) > 0""",
        "review_metrics": """WITH t AS (SELECT count(*) AS total_reviewed, count(*) FILTER (lower(overall_correct) = 'true') AS fully_correct, count(*) FILTER (lower(overall_correct) = 'partial') AS partially_correct,
            count(*) FILTER (lower(overall_correct) = 'false') AS wrong, CAST(coalesce(sum(len(correct_events)), 0) AS BIGINT) AS tp, CAST(coalesce(sum(len(wrong_events)), 0) AS BIGINT) AS fp,
            CAST(coalesce(sum(len(missed_events)), 0) AS BIGINT) AS fn FROM review_items WHERE reviewed),
            u AS (SELECT *, CAST(fully_correct + partially_correct * 0.5 AS DOUBLE) / total_reviewed AS accuracy, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS p0,
            CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS r0 FROM t)
            SELECT * EXCLUDE (p0, r0), round(p0, 4) AS "precision", round(r0, 4) AS recall, round(CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END, 4) AS f1 FROM u WHERE total_reviewed > 0""",
        "review_type_breakdown": """WITH e AS (SELECT 'predicted' AS kind, unnest(predicted_events) AS e FROM review_items WHERE reviewed UNION ALL SELECT 'correct', unnest(correct_events) FROM review_items WHERE reviewed
            UNION ALL SELECT 'missed', unnest(missed_events) FROM review_items WHERE reviewed UNION ALL SELECT 'wrong', unnest(wrong_events) FROM review_items WHERE reviewed),
            t AS (SELECT coalesce(e.event_type, 'unknown') AS event_type, count(*) FILTER (kind = 'predicted') AS predicted, count(*) FILTER (kind = 'correct') AS correct, count(*) FILTER (kind = 'missed') AS missed, count(*) FILTER (kind = 'wrong') AS wrong FROM e GROUP BY 1)
            SELECT *, round(CASE WHEN correct + wrong > 0 THEN CAST(correct AS DOUBLE) / (correct + wrong) ELSE 0.0 END, 4) AS "precision", round(CASE WHEN correct + missed > 0 THEN CAST(correct AS DOUBLE) / (correct + missed) ELSE 0.0 END, 4) AS recall FROM t""",
        "lexicon_merge": SEEDS,
        "lexicon_final": FINAL,
        "lexicon_counts": f"SELECT polarity, source, count(*) AS n FROM ({FINAL}) GROUP BY ALL",
        "candidate_filter": f"""WITH l AS (SELECT word, source, similarity, {POLARITY} AS polarity FROM lexicon), c AS (SELECT * FROM l WHERE similarity IS NOT NULL),
            r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY similarity DESC, source) AS rn FROM c WHERE word NOT IN (SELECT word FROM l WHERE similarity IS NULL) AND word NOT IN (SELECT word FROM c GROUP BY word HAVING count(DISTINCT polarity) > 1))
            SELECT word, source AS source_seed, similarity, polarity FROM r WHERE rn = 1""",
        "embedding_topk": """WITH s AS (SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
            SELECT query_id, vec_id, similarity, CAST(rk AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rk FROM s) WHERE rk <= 20""",
        "template_vote": f"""WITH w AS ({SEEDS}), s AS (SELECT word, polarity, unnest(range(0, 5)) AS i, CASE WHEN polarity = 'positive' THEN {words(TEMPLATES['positive'])} ELSE {words(TEMPLATES['negative'])} END AS t FROM w),
            h AS (SELECT word, polarity, i, CAST(concat('0x', substr(md5(replace(t[i + 1], '{{word}}', word)), 1, 2)) AS INTEGER) AS h FROM s),
            p AS (SELECT *, CASE WHEN h < 120 THEN 'positive' WHEN h < 200 THEN 'negative' ELSE 'neutral' END AS label, 0.4::DOUBLE + CAST(h AS DOUBLE) / 512 AS conf FROM h),
            g AS (SELECT word, polarity, label, count(*) AS n, min(i) AS f, avg(conf) AS conf FROM p GROUP BY ALL),
            b AS (SELECT *, row_number() OVER (PARTITION BY word, polarity ORDER BY n DESC, f) AS rn, sum(n) OVER (PARTITION BY word, polarity) AS total FROM g)
            SELECT word, polarity, label = polarity AND CAST(n AS DOUBLE) / total >= 0.6 AND conf >= 0.5 AS valid, label AS predicted, round(conf, 4) AS confidence, round(CAST(n AS DOUBLE) / total, 4) AS vote_ratio FROM b WHERE rn = 1""",
        "corpus_merge": "SELECT md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS len FROM (SELECT DISTINCT trim(text, ' ') AS text FROM (SELECT text FROM documents UNION ALL SELECT content FROM news)) WHERE length(text) > 10",
        "corpus_stats": "SELECT count(text) AS texts, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents",
        "date_forward_fill": f"SELECT seq, last_value(d IGNORE NULLS) OVER (PARTITION BY source ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS date FROM (SELECT seq, source, CASE WHEN seq % 7 = 0 THEN {DATE} END AS d FROM news)",
        "list_detail_join": "SELECT e.extraction_id, n.seq FROM extractions e JOIN news n ON e.news_id = n.news_id WHERE trim(n.news_id) <> ''",
    }
    return out
