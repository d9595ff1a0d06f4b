"""SQL that says the same as the registered corpus queries, for engines with list functions."""

from __future__ import annotations

import string

from fleet_engine.llm.licenses import BASE, BASE_CONFIDENCE, CONFIDENCE, rules

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"

LINES_SQL = f"""WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos, len(ls) AS n_lines
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
 keyed AS (SELECT *, translate(trim(line, {_BLANKS}), {_LOWER}) AS key FROM lines),
 shared AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
 marked AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, n_lines::BIGINT AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id, n_lines"""

WARC_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
 g AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest, max(page_id) OVER (PARTITION BY payload) AS newest FROM p),
 r AS (SELECT *, payload_bytes >= 1000 AND page_id <> newest AS revisit FROM g)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN newest END AS refers_to FROM r"""

JACCARD_SQL = f"""WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
 grams AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS gram FROM w),
 sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
 common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
 links AS (SELECT x, y, c = p.n AND c = q.n AS same FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 10 * c >= 8 * (p.n + q.n - c)),
 reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
 classes AS (SELECT x AS doc_id, min(y) AS class_id FROM reach GROUP BY x),
 texts AS (SELECT doc_id, min(least(doc_id, coalesce(l.y, doc_id))) AS text_class FROM documents d LEFT JOIN links l ON l.x = d.doc_id AND same GROUP BY doc_id)
SELECT c.doc_id, class_id, count(l.y) AS n_links, count(DISTINCT t.text_class) FILTER (WHERE NOT l.same) AS n_text_links
FROM classes c LEFT JOIN links l ON l.x = c.doc_id LEFT JOIN texts t ON t.doc_id = l.y GROUP BY c.doc_id, class_id"""


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licenses_sql() -> str:
    """Words stand between two blanks here, so that a match can take the blanks at its ends and leave the neighbours theirs."""
    wide = lambda text: text.replace(" ", "  ")
    table = ", ".join(f"({i}, {r.tier}, {_quote(r.label)}, {_quote(wide(n))}, {_quote(' (?:' + wide(r.pattern) + ') ')})" for i, r in enumerate(rules()) for n in r.needles)
    base = ", ".join(f"({_quote(' ' + wide(p) + ' ')}, {_quote(label)})" for p, label in BASE.items())
    sure = " ".join(f"WHEN {t} THEN {v}" for t, v in CONFIDENCE.items())
    return f"""WITH rules(rule, tier, label, needle, pattern) AS (VALUES {table}),
 base(phrase, label) AS (VALUES {base}),
 w AS (SELECT doc_id, ' ' || replace(trim(regexp_replace(translate(coalesce(text, ''), {_LOWER}), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), ' ', '  ') || ' ' AS s FROM documents),
 tried AS (SELECT DISTINCT doc_id, s, rule, tier, label, pattern FROM w JOIN rules ON contains(s, needle)),
 found AS (SELECT doc_id, rule, tier, label, regexp_extract_all(s, pattern) AS m, regexp_split_to_array(s, pattern) AS gaps FROM tried),
 places AS (SELECT doc_id, rule, tier, label, unnest(list_transform(range(1, len(m) + 1),
     lambda i: {{'b': list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), 'n': length(m[i])}})) AS p
   FROM found WHERE len(m) > 0),
 dets AS (SELECT doc_id, rule, tier, label, p.b AS b, p.b + p.n AS e FROM places),
 kept AS (SELECT * FROM dets d WHERE NOT EXISTS (SELECT 1 FROM dets o WHERE o.doc_id = d.doc_id AND o.tier <= d.tier AND o.e >= d.e
     AND (o.b < d.b OR (o.b = d.b AND (o.e > d.e OR (o.e = d.e AND (o.tier < d.tier OR (o.tier = d.tier AND o.rule < d.rule)))))))),
 named AS (SELECT doc_id, list(DISTINCT label) AS labels, max(CASE tier {sure} END)::DOUBLE AS score FROM kept GROUP BY doc_id),
 hits AS (SELECT doc_id, label, unnest(list_filter(range(1, length(s) + 1), lambda i: substr(s, i, length(phrase)) = phrase)) AS spot, s FROM w JOIN base ON contains(s, phrase)),
 at_word AS (SELECT doc_id, label, (length(substr(s, 1, spot)) - length(replace(substr(s, 1, spot), ' ', '')) - 1) // 2 AS word FROM hits),
 based AS (SELECT doc_id, count(*) AS n_base, min(word) AS first_word, max(word) AS last_word, list(DISTINCT label) AS labels FROM at_word GROUP BY doc_id)
SELECT w.doc_id, (CASE WHEN s = '  ' THEN 0 ELSE (length(s) - length(replace(s, ' ', ''))) // 2 END)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(n.labels, [])))), ','), '') AS labels,
       greatest(coalesce(score, 0.0), CASE WHEN n_base > 0 THEN {BASE_CONFIDENCE} ELSE 0.0 END)::DOUBLE AS score
FROM w LEFT JOIN based b USING (doc_id) LEFT JOIN named n USING (doc_id)"""


LICENSES_SQL = _licenses_sql()

REPEATS_SQL = """WITH b AS (SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS x, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
 w AS (SELECT r, p, md5_number(substr(x, (2 * p + 1)::BIGINT, 400)) AS h FROM (SELECT r, x, unnest(range(0, n - 199)) AS p FROM b WHERE n >= 200)),
 d AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM (SELECT r, p, count(*) OVER (PARTITION BY h) AS c FROM w) WHERE c > 1),
 i AS (SELECT r, p, count(*) FILTER (WHERE before IS NULL OR p > before + 200) OVER (PARTITION BY r ORDER BY p) AS island FROM d),
 s AS (SELECT r, island, min(p) AS low, max(p) + 200 AS high FROM i GROUP BY r, island),
 e AS (SELECT s.*, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low), 0) AS since FROM s),
 k AS (SELECT e.r, sum(high - low)::BIGINT AS n_removed, count(*) AS n_spans, max(high) AS last,
              string_agg(substr(x, (2 * since + 1)::BIGINT, (2 * (low - since))::BIGINT), '' ORDER BY low) AS head FROM e JOIN b ON b.r = e.r GROUP BY e.r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, (2 * coalesce(last, 0) + 1)::BIGINT))) AS kept_sha256
FROM b LEFT JOIN k ON k.r = b.r"""


LEXICAL_SQL = f"""WITH t AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
 sizes AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_all FROM t WHERE len(ts) > 0),
 tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM t) GROUP BY ALL),
 q AS (SELECT i, item_id, term, count(*)::BIGINT AS times FROM (SELECT row_number() OVER () AS i, item_id,
     unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
 w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, sizes WHERE term IN (SELECT term FROM q) GROUP BY term),
 m AS (SELECT r, doc_id, 100 - 75 + (75 * len(ts)::BIGINT * n_docs) // n_all AS m FROM t, sizes WHERE len(ts) > 0),
 s AS (SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
       FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY i, r),
 o AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 10"""


def _clusters_sql(dims: int = 64, k: int = 40, rounds: int = 5) -> str:
    """Plain rounds: each compares every vector with every centroid."""
    distance = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (v[i] - mid[i]) * (v[i] - mid[i])))"
    parts = [f"""x AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS v FROM embeddings
   WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims})""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS mid FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM x ORDER BY h, v LIMIT {k}))"""]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': {distance}::BIGINT, 'c': c}}) AS best FROM x, c{n} GROUP BY r)""")
        if n < rounds:
            parts.append(f"""m{n} AS (SELECT c, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS mean FROM (SELECT best.c AS c, i, sum(v[i]) AS s, count(*) AS n
   FROM a{n}, range(1, {dims + 1}) AS p(i) GROUP BY ALL))""")
            parts.append(f"""c{n + 1} AS MATERIALIZED (SELECT c, coalesce(any_value(l), any_value(mid)) AS mid FROM c{n} LEFT JOIN (SELECT c, list(mean ORDER BY i) AS l FROM m{n} GROUP BY c) USING (c) GROUP BY c)""")
    return "WITH " + ",\n ".join(parts) + f"""
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(mid, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON c = best.c"""


CLUSTERS_SQL = _clusters_sql()
