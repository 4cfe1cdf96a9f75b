"""DuckDB SQL with the same rows as the registered queries (documented rules, no stored answers)."""

from __future__ import annotations

from stride.llm import secret_scan as secrets
from stride.llm.quality_rules import BOILERPLATE, LineRules

WORD = r"[^\x20\x09-\x0D]+"


def quality_rules(r: LineRules = LineRules()) -> str:
    notice = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '{WORD}') AS w FROM d),
win AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM rep, unnest([0, 1, 2]) AS v(k) GROUP BY rid),
l AS (SELECT rid, pos, line, len(regexp_extract_all(line, '{WORD}')) AS nw,
             length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
             length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS sym,
             length(line) - length(replace(line, '|', '')) AS bars,
             (length(line) - length(replace(line, '!!', ''))) // 2 AS shouts
      FROM (SELECT rid, string_split(text, chr(10)) AS ls FROM d), unnest(ls) WITH ORDINALITY AS t(line, pos)),
j AS (SELECT *, row_number() OVER (PARTITION BY rid, line ORDER BY pos) AS nth,
             100 * sym > {r.max_symbol_pct} * chars OR {r.shout_per_words} * shouts > nw
             OR (bars > 0 AND {r.bar_per_words} * bars >= nw)
             OR (nw <= {r.fragment_words} AND NOT regexp_matches(line, '[.!?:;"''][\x20\x09-\x0D]*$'))
             OR {notice} AS bad
      FROM l WHERE nw > 0),
a AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (nth > 1) AS n_dup_lines,
             count(*) FILTER (bad) AS n_bad_lines, coalesce(sum(chars) FILTER (bad), 0) AS lost_chars
      FROM j GROUP BY rid),
b AS (SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(a.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(a.n_lines, 0) AS BIGINT) AS n_lines,
             CAST(coalesce(a.n_bad_lines, 0) AS BIGINT) AS n_bad_lines,
             CAST(coalesce(a.lost_chars, 0) AS BIGINT) AS lost_chars
      FROM d JOIN w USING (rid) LEFT JOIN cov c USING (rid) LEFT JOIN a USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_pct} * n_words AS base_failed,
       NOT (n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_pct} * n_words)
           AND 100 * lost_chars <= {r.max_lost_pct} * word_chars AS kept,
       n_lines, n_bad_lines, lost_chars
FROM b"""


def decontamination(window: int = 10) -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
i AS (SELECT item_id, {words} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), {window}) AS n, array_to_string(w[s + 1:s + {window}], ' ') AS g
       FROM i, unnest(range(0, greatest(len(w) - {window - 1}, 1))) AS u(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT rid, s, n, array_to_string(w[s + 1:s + n], ' ') AS g
       FROM d, sizes, unnest(range(0, len(w) - n + 1)) AS u(s)),
h AS (SELECT rid, s, dw.n, item_id FROM dw JOIN iw ON iw.n = dw.n AND iw.g = dw.g),
hits AS (SELECT rid, count(DISTINCT p) AS n_hit FROM h, unnest(range(s, s + n)) AS u(p) GROUP BY rid),
its AS (SELECT rid, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM h GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN its USING (rid)"""


def _crc32(text: str, table: str = "t") -> str:
    """crc32 of an ASCII text; needs a row of CRC_TABLE's list."""
    codes = f"[ascii(_x) FOR _x IN string_split({text}, '')]"
    step = f"xor(_c >> 8, {table}[(xor(_c, _b) & 255) + 1])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda _c, _b: {step}), 4294967295::BIGINT)"


CRC_TABLE = """(SELECT [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda _c, _z: CASE WHEN _c & 1 = 1 THEN xor(_c >> 1, 3988292384::BIGINT) ELSE _c >> 1 END) FOR i IN range(0, 256)] AS t)"""


def conversation_trie() -> str:
    """A prefix is the text of its turns' hashes; a node's subtree is every node whose prefix begins with its own."""
    return rf"""
WITH t AS (SELECT conv_id, turn, length(coalesce(text, '')) AS size,
             md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS m FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(m ORDER BY turn NULLS FIRST, m) AS ms, list(size ORDER BY turn NULLS FIRST, m) AS ss FROM t GROUP BY conv_id),
h AS (SELECT o.*, CAST({_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS BIGINT) AS h FROM o, {CRC_TABLE}),
b AS (SELECT h.conv_id, list_concat(coalesce(p.ms[1:h.h], []), h.ms[h.h + 1:]) AS ms, list_concat(coalesce(p.ss[1:h.h], []), h.ss[h.h + 1:]) AS ss
      FROM h LEFT JOIN o p ON p.conv_id = h.conv_id - h.conv_id % 100),
x AS (SELECT conv_id, d, len(ms) AS n, coalesce(array_to_string(ms[1:d], ''), '') AS k, coalesce(ss[d], 0) AS size
      FROM b, unnest(range(0, len(ms) + 1)) AS u(d)),
n AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
             coalesce(string_agg(CASE WHEN n = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends FROM x GROUP BY d, k),
kids AS (SELECT d - 1 AS d, left(k, 32 * (d - 1)) AS k, count(*) AS c FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(c, 0) AS n_children FROM n LEFT JOIN kids USING (d, k)),
sub AS (SELECT a.d, a.k, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.size) AS saved
        FROM f, unnest(range(0, f.d + 1)) AS u(up) JOIN n a ON a.d = up AND a.k = left(f.k, 32 * up) GROUP BY ALL)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, sub.n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens,
       sha256(f.ends) AS ends_sha256
FROM f JOIN sub USING (d, k) LEFT JOIN n p ON p.d = f.d - 1 AND p.k = left(f.k, 32 * (f.d - 1))"""


def periodic_runs() -> str:
    """All pairs of equal stretches of 16 words in a document; consecutive pairs of one lag are a run's line."""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
             {_crc32("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h FROM documents, {CRC_TABLE}),
g AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
r AS (SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 AND doc_id IS NOT NULL
               THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END] FOR i IN range(0, n)] ELSE w END AS w
      FROM g),
x AS (SELECT rid, n, i, md5(array_to_string(w[i - 14:i + 1], ' ')) AS s FROM r, unnest(range(15, n)) AS u(i)),
m AS (SELECT a.rid, a.i, a.i - b.i AS q FROM x a JOIN x b ON a.rid = b.rid AND a.s = b.s AND b.i < a.i AND 3 * (a.i - b.i) <= a.n),
l AS (SELECT rid, q, min(i) - 15 - q AS start, max(i) + 1 AS stop
      FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM m) GROUP BY rid, q, k),
runs AS (SELECT rid, start, stop - start AS length, min(q) AS q FROM l WHERE stop - start >= greatest(24, 3 * q) GROUP BY ALL),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY CAST(length AS DOUBLE) / q DESC, start, q) = 1),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS t FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, j FROM runs, unnest(range(start + q, start + length)) AS u(j)),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY j) AS t
         FROM (SELECT rid, j, w[j + 1] AS word FROM r, unnest(range(0, n)) AS u(j)) ANTI JOIN gone USING (rid, j) GROUP BY rid)
SELECT doc_id, r.n AS n_words, coalesce(n_runs, 0) AS n_runs, best.start, best.length, best.q AS period,
       1000 * best.length // best.q AS exponent_milli, sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM r LEFT JOIN best USING (rid) LEFT JOIN listed USING (rid) LEFT JOIN kept USING (rid)"""


def _positions(name: str, pattern: str, keep: str = "true") -> str:
    """CTEs: matches of a pattern in d (rid, text) with start and end."""
    p = pattern.replace("'", "''")
    return f"""
{name}_m AS (SELECT rid, i, len(g[i]) AS gap, len(m[i]) AS size, m[i] AS match
  FROM (SELECT rid, regexp_split_to_array(text, '{p}') AS g, regexp_extract_all(text, '{p}') AS m FROM d),
       unnest(range(1, len(m) + 1)) AS u(i)),
{name} AS (SELECT rid, match, s AS start, s + size AS "end"
  FROM (SELECT *, sum(gap + size) OVER (PARTITION BY rid ORDER BY i) - size AS s FROM {name}_m) WHERE {keep})"""


def secret_scan(linking: secrets.Linking = secrets.Linking()) -> str:
    assign = secrets.ASSIGN.replace("'", "''")
    spans = ",".join((
        _positions("assign", secrets.ASSIGN, f"length(regexp_extract(match, '{assign}', 2)) >= 6"),
        _positions("access", secrets.ACCESS, "length(match) >= 20"),
        _positions("hex", secrets.HEX, "length(match) >= 24"),
        _positions("weak_id", secrets.IDENTIFIER),
        _positions("weak_secret", secrets.WEAK_SECRET),
        _positions("weak_endpoint", secrets.ENDPOINT)))
    near = f'b.rid = a.rid AND b.start <= a."end" + {linking.scope} AND a.start <= b."end" + {linking.scope}'
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents), {spans},
ids AS (SELECT rid, start, "end" FROM weak_id UNION SELECT rid, start, "end" FROM access),
vals AS (SELECT rid, start, "end" FROM weak_secret UNION SELECT rid, start, "end" FROM assign
         UNION SELECT rid, start, "end" FROM hex),
anchored AS (SELECT * FROM vals a WHERE EXISTS (SELECT 1 FROM ids b WHERE {near})),
base AS (SELECT rid, start, "end", 0 AS o, 'assign' AS kind FROM assign UNION ALL
         SELECT rid, start, "end", 1, 'access' FROM access UNION ALL SELECT rid, start, "end", 2, 'hex' FROM hex),
links AS (SELECT rid, start, "end", 3 AS o, 'link_id' AS kind FROM weak_id a
          WHERE EXISTS (SELECT 1 FROM vals b WHERE {near}) UNION ALL
          SELECT rid, start, "end", 4, 'link_secret' FROM weak_secret a
          WHERE EXISTS (SELECT 1 FROM ids b WHERE {near}) UNION ALL
          SELECT rid, start, "end", 5, 'link_endpoint' FROM weak_endpoint a
          WHERE EXISTS (SELECT 1 FROM anchored b WHERE {near})),
added AS (SELECT * FROM links a
          WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = a.rid AND b.start < a."end" AND a.start < b."end")),
text_of AS (SELECT *, kind || ':' || start || ':' || "end" AS t FROM base),
n AS (SELECT rid, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access,
             count(*) FILTER (o = 2) AS n_hex, string_agg(t, ',' ORDER BY start, o) AS t FROM text_of GROUP BY rid),
s AS (SELECT rid, string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, o, "end") AS spans
      FROM (SELECT * FROM base UNION ALL SELECT * FROM added) GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(t, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN n USING (rid) LEFT JOIN s USING (rid)"""


def url_filters() -> str:
    scheme = r"^\s*[A-Za-z][A-Za-z0-9+.-]*://"
    return rf"""
WITH a AS (SELECT row_number() OVER () AS rid, page_id, 1704067200 + (page_id * 7919) % 2592000 AS fetch_ts,
             regexp_replace(lower(regexp_replace(regexp_extract(url, '{scheme}([^/?#\s]*)', 1), '^.*@|:[0-9]*$', '', 'g')), '\.+$', '') AS h,
             regexp_replace(regexp_extract(url, '{scheme}[^/?#\s]*(/[^?#\s]*)', 1), '/+$', '') AS p
           FROM pages),
e AS (SELECT event_id, event_type IN ('purchase', 'signup') AS gone, epoch_us(ts) AS ts,
             CASE event_id % 4 WHEN 0 THEN 'host:' || h
               WHEN 1 THEN 'domain:' || regexp_replace(h, '^[^.]*\.([^.]*\..*)$', '\1')
               WHEN 2 THEN 'prefix:' || h || regexp_extract(p, '^(/[^/]*)', 1) ELSE 'url:' || h || p END AS key
      FROM events JOIN a ON event_id % (SELECT count(*) FROM pages) = page_id WHERE h <> ''),
f AS (SELECT key, ts, gone, lead(ts) OVER (PARTITION BY key ORDER BY ts) AS until
      FROM (SELECT *, row_number() OVER (PARTITION BY key, ts ORDER BY event_id DESC) AS nth FROM e) WHERE nth = 1),
k AS (SELECT rid, fetch_ts * 1000000 AS asked, unnest(list_distinct(list_concat(['host:' || h, 'url:' || h || p],
             [('domain:' || array_to_string(string_split(h, '.')[i:], '.')) FOR i IN range(1, greatest(len(string_split(h, '.')), 2))],
             [('prefix:' || h || array_to_string(string_split(p, '/')[1:i], '/')) FOR i IN range(1, len(string_split(p, '/')) + 1)]))) AS key
      FROM a WHERE h <> ''),
hit AS (SELECT rid, count(*) AS n, string_agg(k.key, ',' ORDER BY k.key) AS keys
        FROM k JOIN f ON f.key = k.key AND NOT gone AND ts <= asked AND (until IS NULL OR asked < until) GROUP BY rid)
SELECT page_id, fetch_ts, coalesce(h, '') AS host, n IS NOT NULL AS blocked, coalesce(n, 0) AS n_active, coalesce(keys, '') AS entries
FROM a LEFT JOIN hit USING (rid)"""
