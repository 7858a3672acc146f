"""DuckDB statements of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op10_warc_dictionary"] = """
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS body FROM pages),
d AS (SELECT *, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first_id FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41),
        lambda i: lpad(bin(strpos('0123456789abcdef', substr(hex, i, 1)) - 1), 4, '0')), '') AS bits FROM d)
SELECT page_id, strlen(body) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(0, 5), lambda j: substr(bits, i * 5 + j + 1, 1)::INT * (16 >> j)))::INT, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to, url
FROM b
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quality_rules() -> str:
    from shelfsense.llm.quality_rules import PRIOR_ROWS, RATIOS, SCALE, SLACK, SPREAD, TWO_SIDED
    ratios = ", ".join(f"({scale} * {a}) // greatest({b}, 1) AS r_{m}" for m, (a, b, scale) in RATIOS.items())
    long = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS rule, r_{m} AS v FROM rated" for m in SLACK)
    slack = "CASE rule " + " ".join(f"WHEN '{m}' THEN {s}" for m, s in SLACK.items()) + " END"
    ok = [f"r_{m} <= max(hi) FILTER (rule = '{m}')" for m in SLACK] + [f"r_{m} >= max(lo) FILTER (rule = '{m}')" for m in TWO_SIDED]
    names = [f"CASE WHEN r_{m} > max(hi) FILTER (rule = '{m}') THEN 'high_{m}' END" for m in SLACK]
    names += [f"CASE WHEN r_{m} < max(lo) FILTER (rule = '{m}') THEN 'low_{m}' END" for m in TWO_SIDED]
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, k FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win JOIN twice USING (doc_id, k))
        GROUP BY doc_id),
m AS (SELECT d.doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
        len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals
      FROM d JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
rated AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {ratios} FROM m),
sketch AS (SELECT lang, source, rule, CASE WHEN v < 128 THEN v ELSE v - v % (1::BIGINT << (length(bin(v)) - 7)) END AS b,
             count(*) AS n FROM ({long}) GROUP BY ALL),
whole AS (SELECT rule, b, {SCALE} * sum(n) AS n FROM sketch GROUP BY ALL),
whole_share AS (SELECT rule, b, ({SCALE * PRIOR_ROWS} * n) // sum(n) OVER (PARTITION BY rule) AS n FROM whole),
by_lang AS (SELECT lang, rule, b, sum(n) AS n FROM (
  SELECT lang, rule, b, {SCALE} * n AS n FROM sketch
  UNION ALL SELECT g.lang, rule, b, n FROM (SELECT DISTINCT lang, rule FROM sketch) g JOIN whole_share USING (rule)) GROUP BY ALL),
lang_share AS (SELECT lang, rule, b, ({SCALE * PRIOR_ROWS} * n) // sum(n) OVER (PARTITION BY lang, rule) AS n FROM by_lang),
merged AS (SELECT lang, source, rule, b, sum(n) AS n FROM (
  SELECT lang, source, rule, b, {SCALE} * n AS n FROM sketch
  UNION ALL SELECT g.lang, g.source, g.rule, s.b, s.n FROM (SELECT DISTINCT lang, source, rule FROM sketch) g
    JOIN lang_share s ON g.lang IS NOT DISTINCT FROM s.lang AND g.rule = s.rule) GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, rule ORDER BY b) AS c,
             sum(n) OVER (PARTITION BY lang, source, rule) AS total FROM merged),
q AS (SELECT lang, source, rule, min(b) FILTER (4 * c >= total) AS q25, min(b) FILTER (4 * c >= 3 * total) AS q75
      FROM ranked GROUP BY ALL),
fence AS (SELECT lang, source, rule, q75 + {SPREAD} * (q75 - q25) + {slack} AS hi, q25 - {SPREAD} * (q75 - q25) - {slack} AS lo
          FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(ok)} AS kept, concat_ws(',', {", ".join(names)}) AS broken
FROM rated r JOIN fence f ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source
GROUP BY doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {", ".join(f"r_{m}" for m in SLACK)}
"""


ORACLE["op3_quality_rules"] = _quality_rules()

ORACLE["op5_substring_dedup"] = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
later AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
word AS (SELECT doc_id, w[i] AS x, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLE["op6_minhash"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS k FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.k = b.k AND a.doc_id < b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON r.other = e.a)
SELECT doc_id, len(s) AS n_shingles, m.component_id, doc_id = m.component_id AS kept
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
"""

_NORMAL = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE["op9_decontamination"] = rf"""
WITH d AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
b AS (SELECT item_id, {_NORMAL} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS k
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
own AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS k
        FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win))),
found AS (SELECT doc_id, item_id, i, m FROM own JOIN win USING (m, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS l
          FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.l, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE["op11_line_dedup"] = f"""
WITH line AS (SELECT doc_id, i, l[i] AS line, translate(trim(l[i], {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') AS k
              FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
                    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
first AS (SELECT k, min(doc_id) AS owner FROM line WHERE length(k) >= 10 GROUP BY k),
judged AS (SELECT doc_id, i, line, owner IS NULL OR owner = doc_id AS stays FROM line LEFT JOIN first USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(c::VARCHAR) + 1),
  lambda i: [ascii(substr(c::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END),
  4294967295::BIGINT)"""
ORACLE["op12_prefix_trie"] = f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, length(coalesce(text, ''))) AS i,
             coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT DISTINCT c, {_CRC32} % 6 AS h FROM t),
own AS (SELECT h.c, 1 AS part, i, r, x FROM h JOIN t ON t.c = h.c AND i > h
        UNION ALL SELECT h.c, 0, i, r, x FROM h JOIN t ON t.c = h.c - h.c % 100 AND i <= h),
s AS (SELECT h.c, coalesce(list(struct_pack(r := r, x := x) ORDER BY part, i) FILTER (own.c IS NOT NULL), []) AS s
      FROM h LEFT JOIN own ON h.c = own.c GROUP BY h.c),
p AS (SELECT c, len(s) AS m, d, s[1:d] AS k, CASE WHEN d > 0 THEN length(s[d].x) ELSE 0 END AS n
      FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM s)),
node AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (m = d), '')) AS ends FROM p GROUP BY d, k),
kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS children FROM node WHERE d > 0 GROUP BY ALL),
above AS (SELECT e, k[1:e] AS k, n_convs, n, children IS NULL AS leaf
          FROM (SELECT node.*, children, unnest(range(0, node.d + 1)) AS e FROM node LEFT JOIN kids USING (d, k))),
below AS (SELECT e AS d, k, count(*) FILTER (leaf) AS leaves, sum((n_convs - 1) * n) AS saved FROM above GROUP BY e, k)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(children, 0) AS n_children,
  leaves AS n_leaves, saved::BIGINT AS saved_tokens, node.ends AS ends_sha256
FROM node JOIN below ON node.d = below.d AND node.k = below.k
LEFT JOIN kids ON node.d = kids.d AND node.k = kids.k
LEFT JOIN node up ON node.d > 0 AND up.d = node.d - 1 AND up.k = node.k[1:node.d - 1]
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE["op13_lexical_search"] = f"""
WITH d AS (SELECT doc_id, t, len(t) AS n FROM (SELECT doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM d) GROUP BY ALL),
item AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
           FROM item JOIN w USING (term) JOIN tf USING (term), total GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
