"""SQL of those queries that another engine can run over whole tables."""

from __future__ import annotations

#: Lines with their number and key: without case, white space and digits.
LINES = r"""WITH l AS (SELECT seq, source, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS line_no
    FROM news WHERE trim(source) <> '' AND content IS NOT NULL),
  k AS (SELECT seq, source, line_no, regexp_replace(lower(line), '[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}\p{Nd}]+', '', 'g') AS key FROM l),
  s AS (SELECT source, count(*) AS n FROM news GROUP BY source),
  g AS (SELECT source, key FROM k JOIN s USING (source) WHERE key <> '' GROUP BY source, key, n HAVING count(DISTINCT seq) >= 5 AND count(DISTINCT seq) * 10 >= n)"""

#: Letters and digits of a text; the sharp s, whose capital form is SS, is written out.
_FORM = r"regexp_replace(lower(replace(coalesce({x}, ''), 'ß', 'ss')), '[^\p{{L}}\p{{N}}]+', '', 'g')"
_PIECES = r"list_filter(regexp_split_to_array(coalesce(content, ''), '[;；|\n\r]'), lambda p: regexp_matches(p, '[^\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]'))"
FORMS = f"""WITH p AS (SELECT seq, {_FORM.format(x='title')} AS t, {_FORM.format(x='content')} AS c, {_PIECES} AS ps FROM news),
  f AS (SELECT seq, t, c, CASE WHEN len(ps) >= 2 AND len(list_filter(ps, lambda p: NOT (contains(p, ':') OR contains(p, '：')))) = 0
    THEN 'F' || array_to_string(list_sort(list_transform(ps, lambda p: {_FORM.format(x='p')})), '|') ELSE c END AS k FROM p),
  g AS (SELECT *, min(seq) OVER (PARTITION BY t, k) AS first_seq, count(*) OVER (PARTITION BY t, k) AS copies FROM f WHERE t <> '' OR c <> '')"""


def oracles() -> dict[str, str]:
    return {
        "p4_found": f"{LINES} SELECT seq, line_no FROM k JOIN g USING (source, key)",
        "p6_found": f"{FORMS} SELECT first_seq, seq AS copy_seq FROM g WHERE seq <> first_seq",
        "p6_records": f"{FORMS} SELECT DISTINCT first_seq, copies FROM g",
    }
