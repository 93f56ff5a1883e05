"""SQL of the page cleaning: tokens, a recursive walk with the stack of open elements, blocks."""

from placestats import constants as K
from placestats.operators.pages import LISTS, VOID_TAGS


def listed(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_TOKEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)|</?[a-z][^>]*>|<[^>]*>|[^<]+"
_CLASS = """(?is)\\sclass\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s>"'']+))"""
_PLAIN = "regexp_replace(replace(replace(replace(replace(replace(t, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g')"
_MARK = " ".join(f"WHEN tag = '{tag}' THEN '{sign} '" for tag, sign in K.HEADING_MARKS.items())
_STOPS = " OR ".join(f"contains(lower(text), '{p.lower()}')" for p in K.STOP_PHRASES)

PAGES = {
    # an unfinished tag at the end of a page is text
    "pg": f"SELECT page_id, url, regexp_extract_all(regexp_replace(coalesce(html, ''), '<([^<>]*)$', '&lt;\\1'), '{_TOKEN}') AS toks FROM pages",
    "raw": "SELECT page_id, unnest(toks) AS t, generate_subscripts(toks, 1) AS i FROM pg",
    "named": f"""SELECT *, lower(regexp_extract(t, '^</?([a-zA-Z][^\\s/>]*)', 1)) AS tag, regexp_matches(t, '(?i)^<(script|style)\\b') AS swallowed,
regexp_extract(t, '{_CLASS}', 1) || regexp_extract(t, '{_CLASS}', 2) || regexp_extract(t, '{_CLASS}', 3) AS cls FROM raw""",
    "tok": f"""SELECT page_id, i, tag, CASE WHEN t[1] <> '<' THEN 'text' WHEN tag = '' OR swallowed THEN 'other' WHEN t[2] = '/' THEN 'close' ELSE 'open' END AS kind,
tag IN ({listed(K.DROPPED_TAGS)}) OR list_has_any(regexp_split_to_array(cls, '\\s+'), [{listed(K.DROPPED_CLASSES)}]) AS drp,
tag IN ({listed(VOID_TAGS)}) OR t LIKE '%/>' AS empty, regexp_replace({_PLAIN}, '^\\s+|\\s+$', '', 'g') AS txt FROM named""",
    "walk": f"""SELECT page_id, 0 AS i, []::VARCHAR[] AS tags, []::INTEGER[] AS ns, []::BOOLEAN[] AS hid, 0 AS n, 0 AS strings, 0 AS hidden, NULL::VARCHAR AS seen,
NULL::INTEGER AS born, NULL::INTEGER AS parent, FALSE AS nested, []::INTEGER[] AS gone FROM pg
UNION ALL SELECT w.page_id, w.ti,
CASE WHEN kind = 'open' AND NOT empty THEN list_append(tags, tag) WHEN cut THEN tags[1:keep] ELSE tags END,
CASE WHEN kind = 'open' AND NOT empty THEN list_append(ns, n) WHEN cut THEN ns[1:keep] ELSE ns END,
CASE WHEN kind = 'open' AND NOT empty THEN list_append(hid, drp OR hidden > 0) WHEN cut THEN hid[1:keep] ELSE hid END,
CASE WHEN kind = 'open' THEN n + 1 ELSE n END, CASE WHEN shown THEN strings + 1 ELSE strings END,
CASE WHEN kind = 'open' AND NOT empty AND drp AND hidden = 0 THEN len(tags) + 1 WHEN cut AND keep < hidden THEN 0 ELSE hidden END,
CASE WHEN shown THEN txt END, CASE WHEN kind = 'open' THEN n END, CASE WHEN len(ns) > 0 THEN ns[-1] ELSE -1 END,
len(list_filter(range(1, len(tags) + 1), lambda k: tags[k] IN ({listed(LISTS)}) AND NOT hid[k])) > 0,
CASE WHEN kind = 'open' AND empty THEN [n] WHEN cut THEN ns[keep + 1:] ELSE [] END
FROM (SELECT w.*, t.i AS ti, kind, tag, drp, empty, txt, kind = 'text' AND hidden = 0 AND txt <> '' AS shown,
  kind = 'close' AND list_contains(tags, tag) AS cut, len(tags) - coalesce(list_position(list_reverse(tags), tag), 0) AS keep
  FROM walk w JOIN tok t ON t.page_id = w.page_id AND t.i = w.i + 1) w""",
    "strs": "SELECT page_id, strings AS k, seen AS s FROM walk WHERE seen IS NOT NULL",
    "left_open": "SELECT page_id, unnest(ns) AS n, strings AS ends, n - 1 AS last FROM walk QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY i DESC) = 1",
    "shut": "SELECT page_id, unnest(gone) AS n, strings AS ends, CASE WHEN born IS NULL THEN n - 1 ELSE born END AS last FROM walk UNION ALL FROM left_open",
    "opened": """SELECT w.page_id, w.born AS n, CASE WHEN NOT (t.drp OR w.before > 0) THEN t.tag END AS tag, w.parent, w.nested, w.strings AS start
FROM (SELECT *, lag(hidden) OVER (PARTITION BY page_id ORDER BY i) AS before FROM walk) w JOIN tok t ON t.page_id = w.page_id AND t.i = w.i WHERE w.born IS NOT NULL""",
    "el": "SELECT o.*, s.ends, s.last FROM opened o JOIN shut s ON s.page_id = o.page_id AND s.n = o.n",
    "up": """SELECT page_id, min(n) AS place, 0 AS step FROM el WHERE tag = 'h1' GROUP BY page_id
UNION ALL SELECT u.page_id, coalesce(e.parent, -1), step + 1 FROM up u LEFT JOIN el e ON e.page_id = u.page_id AND e.n = u.place WHERE step < 6""",
    "main_at": """SELECT p.page_id, coalesce((SELECT min(n) FROM el e WHERE e.page_id = p.page_id AND tag = 'article'),
(SELECT place FROM up u WHERE u.page_id = p.page_id AND step = 6), (SELECT min(n) FROM el e WHERE e.page_id = p.page_id AND tag = 'body'), -1) AS root FROM pg p""",
    "scope": """SELECT e.*, (SELECT string_agg(s, ' ' ORDER BY k) FROM strs x WHERE x.page_id = e.page_id AND x.k > e.start AND x.k <= e.ends) AS text
FROM el e JOIN main_at m ON m.page_id = e.page_id LEFT JOIN el r ON r.page_id = e.page_id AND r.n = m.root WHERE e.n > m.root AND e.n <= coalesce(r.last, e.n) AND e.tag IS NOT NULL""",
    "stops": f"SELECT page_id, min(n) AS stop FROM scope WHERE {_STOPS} GROUP BY page_id",
    "part": "SELECT s.* FROM scope s LEFT JOIN stops t ON t.page_id = s.page_id WHERE s.n < coalesce(t.stop, s.n + 1)",
    "blocks": f"""SELECT page_id, n, CASE {_MARK} WHEN tag = 'blockquote' THEN '> ' ELSE '' END || text || chr(10) AS line FROM part
WHERE tag IN ({listed([*K.HEADING_MARKS, 'p', 'blockquote'])}) AND text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY page_id, text ORDER BY n) = 1
UNION ALL SELECT page_id, n, string_agg(CASE WHEN kind = 'ul' THEN '- ' ELSE CAST(pos AS VARCHAR) || '. ' END || text, chr(10) ORDER BY pos) || chr(10)
FROM (SELECT l.page_id, l.n, l.tag AS kind, i.text, row_number() OVER (PARTITION BY l.page_id, l.n ORDER BY i.n) AS pos
  FROM part l JOIN scope i ON i.page_id = l.page_id AND i.parent = l.n AND i.tag = 'li' AND i.text IS NOT NULL WHERE l.tag IN ({listed(LISTS)}) AND NOT l.nested) GROUP BY page_id, n""",
    "joined": "SELECT p.page_id, p.url, coalesce(string_agg(b.line, chr(10) ORDER BY b.n), '') AS m FROM pg p LEFT JOIN blocks b ON b.page_id = p.page_id GROUP BY ALL",
}
MARKDOWN = r"""SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(replace(m, chr(13) || chr(10), chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]{2,}', ' ', 'g'), '^\s+|\s+$', '', 'g') AS markdown FROM joined"""
