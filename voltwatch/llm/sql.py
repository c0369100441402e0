"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from voltwatch.llm import lexical, pii
from voltwatch.llm import quality_rules as rules


def _pii_kind(kind: str, pattern: str, test: str, only: str, part: str = "x") -> str:
    return f"""
    SELECT rid, '{kind}' AS kind, {pii.KINDS.index(kind)} AS o, s, s + length(x) AS e, round(least(1.0, {pii.PRIOR[kind]} + CASE WHEN
        regexp_matches(lower(substr(t, greatest(s - {pii.CONTEXT_CHARS}, 0) + 1, s - greatest(s - {pii.CONTEXT_CHARS}, 0))), '{pii.CONTEXT[kind]}')
        THEN {pii.LIFT} ELSE 0.0 END), 2) AS score
    FROM (SELECT rid, t, s, {part} AS x FROM (SELECT rid, t, unnest(found) AS x, unnest(list_transform(range(1, len(found) + 1), lambda i:
            list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i-1], lambda f: length(f))), 0))) :: BIGINT AS s
        FROM (SELECT rid, t, regexp_extract_all(t, '{pattern}') AS found, string_split_regex(t, '{pattern}') AS gaps
            FROM d WHERE regexp_matches(t, '{only}'))))
    WHERE {test}"""


_DIGITS = "regexp_replace(x, '[^0-9]', '', 'g')"
_LUHN = f"""length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
    CASE WHEN i % 2 = 1 THEN CAST(substr(reverse({_DIGITS}), i, 1) AS INTEGER)
    ELSE (CAST(substr(reverse({_DIGITS}), i, 1) AS INTEGER) * 2) // 10 + (CAST(substr(reverse({_DIGITS}), i, 1) AS INTEGER) * 2) % 10 END)) % 10 = 0"""


def _mod97(x: str) -> str:
    """Digit by digit, as the whole number of a long one has more than 38 digits."""
    values = f"list_transform(string_split(substr({x}, 5) || substr({x}, 1, 4), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)"
    return f"list_reduce(list_concat([0], {values}), lambda a, b: (a * (CASE WHEN b < 10 THEN 10 ELSE 100 END) + b) % 97) = 1"


_MOD97 = f"CASE WHEN regexp_matches(x, '^[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}$') THEN {_mod97('x')} ELSE false END"
_GROUPED = r"\b[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?\b"
_LONGEST = f"""list_filter(list_transform(range(len(string_split(x, ' ')), 2, -1), lambda k: array_to_string(string_split(x, ' ')[1:k], ' ')),
    lambda p: length(replace(p, ' ', '')) BETWEEN {pii.IBAN_CHARS[0]} AND {pii.IBAN_CHARS[1]} AND {_mod97("replace(p, ' ', '')")})[1]"""

_PII_KINDS = [
    _pii_kind("email", pii.BASE["email"], "true", "@"),
    _pii_kind("ip", pii.BASE["ip"], "list_max(list_transform(string_split(x, '.'), lambda p: CAST(p AS HUGEINT))) <= 255", r"[0-9]\.[0-9]"),
    _pii_kind("card", r"[0-9](?:[\x20-]?[0-9])+", _LUHN, "[0-9]{2}"),
    _pii_kind("phone", pii.BASE["phone"], f"length({_DIGITS}) BETWEEN 9 AND 15", r"\+"),
    _pii_kind("iban", "[A-Za-z0-9]+", _MOD97, "[A-Z]{2}[0-9]{2}[A-Z0-9]{11}"),
    _pii_kind("iban", _GROUPED, "x IS NOT NULL", "[A-Z]{2}[0-9]{2} [A-Z0-9]{4} [A-Z0-9]{4}", _LONGEST),
    _pii_kind("ssn", "[0-9-]+", "regexp_matches(x, '^[0-9]{3}-[0-9]{2}-[0-9]{4}$') AND NOT regexp_matches(x, '^(000|666|9[0-9]{2})|-00-|-0000$')", "[0-9]{3}-[0-9]{2}-[0-9]{4}"),
]

PII_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
spans AS (SELECT * FROM ({' UNION ALL '.join(_PII_KINDS)}) WHERE o < 4 OR score >= {pii.LEAST}),
by_doc AS (SELECT rid, count(*) FILTER (o = 0) AS n_email, count(*) FILTER (o = 1) AS n_ip, count(*) FILTER (o = 2) AS n_card, count(*) FILTER (o = 3) AS n_phone,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY o, s) FILTER (o < 4) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY o, s) AS spans, string_agg(format('{{:.2f}}', score), ',' ORDER BY o, s) AS scores
    FROM spans GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_email, 0) AS BIGINT) AS n_email, CAST(coalesce(n_ip, 0) AS BIGINT) AS n_ip, CAST(coalesce(n_card, 0) AS BIGINT) AS n_card,
    CAST(coalesce(n_phone, 0) AS BIGINT) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN by_doc USING (rid)
"""


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_SQL = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))) END AS ss FROM w),
one AS (SELECT doc_id, len(ss) AS n, unnest(ss) AS x FROM s),
links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM one a JOIN one b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS c FROM s UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.a)
SELECT doc_id, CAST(len(ss) AS BIGINT) AS n_shingles, least AS component_id, doc_id = least AS kept
FROM s JOIN (SELECT a, min(c) AS least FROM reach GROUP BY a) ON a = doc_id
"""

SUBSTRING_SQL = """
WITH w AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
win AS MATERIALIZED (SELECT rid, i, md5(array_to_string(ws[i:i+34], ' ')) AS k FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)),
cov AS (SELECT DISTINCT rid, i + o AS p FROM win JOIN (SELECT k FROM win GROUP BY k HAVING count(*) > 1) USING (k), range(35) AS t(o)),
words AS (SELECT rid, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT rid, count(c.p) AS removed, string_agg(x, ' ' ORDER BY p) FILTER (c.p IS NULL) AS kept FROM words LEFT JOIN cov c USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (rid)
"""


def _shingles(table: str, key: str) -> str:
    return f"""SELECT rid, {key}, i, CASE WHEN len(ws) >= 5 THEN array_to_string(ws[i:i+4], ' ') ELSE '#' || array_to_string(ws, ' ') END AS x,
        greatest(1, least(15, length(array_to_string(CASE WHEN len(ws) >= 5 THEN ws[i:i+4] ELSE ws END, '')) // 4)) AS g, greatest(1, len(ws) - 4) AS n
        FROM (SELECT *, unnest(range(1, 1 + CASE WHEN len(ws) = 0 THEN 0 ELSE greatest(1, len(ws) - 4) END)) AS i
            FROM (SELECT row_number() OVER () AS rid, {key}, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS ws FROM {table}))"""


LEAK_SQL = f"""
WITH d AS MATERIALIZED ({_shingles('documents', 'doc_id')}), b AS MATERIALIZED ({_shingles('benchmark', 'item_id')}),
own AS (SELECT rid AS item, item_id, n AS long, x, g FROM b GROUP BY ALL),
total AS (SELECT item, sum(g) AS total_weight FROM own GROUP BY item),
met AS (SELECT d.rid, doc_id, item, item_id, long, d.x, own.g, unnest(range(least(greatest(0, d.i - long), greatest(0, d.n - long)), least(d.i - 1, greatest(0, d.n - long)) + 1)) AS s
    FROM d JOIN own ON d.x = own.x),
shares AS (SELECT rid, doc_id, item, item_id, s, sum(g) AS shared FROM (SELECT DISTINCT rid, doc_id, item, item_id, s, x, g FROM met) GROUP BY ALL),
best AS (SELECT doc_id, item_id, s, CAST(shared AS DOUBLE) / CAST(total_weight AS DOUBLE) AS similarity,
    row_number() OVER (PARTITION BY rid, item ORDER BY shared DESC, s) AS k FROM shares JOIN total USING (item))
SELECT doc_id, item_id, CAST(s AS BIGINT) AS first_word, similarity FROM best WHERE k = 1 AND similarity >= 0.8
"""

_WORD = "[^\\x20\\x09-\\x0D]"
_CRC_TABLE = "(SELECT list_transform(range(256), lambda i: list_reduce([i :: BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc)"
_CRC = "xor(list_reduce(list_prepend(4294967295 :: BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x) :: BIGINT)), lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"

REPAIR_SQL = f"""
WITH RECURSIVE ids AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
hit AS (SELECT conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS kind
    FROM (SELECT *, coalesce(c.conv_id :: VARCHAR, ' ') || ':' || coalesce(turn :: VARCHAR, ' ') AS key FROM conversations c JOIN ids ON c.conv_id IS NOT DISTINCT FROM ids.conv_id), {_CRC_TABLE}),
rows AS MATERIALIZED (SELECT conv, turn, role, text, row_number() OVER w AS i, NOT regexp_matches(text, '{_WORD}') AS blank, NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS open,
    row_number() OVER (PARTITION BY conv, role, text) > 1 AS seen, substr(role, 1, 1) AS initial
    FROM (SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM hit, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text)),
signs AS MATERIALIZED (SELECT * EXCLUDE (seen), NOT blank AND row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again, lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair FROM rows),
moves(q, initial, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
nexts(q, q2, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
best AS (SELECT conv, 0 :: BIGINT AS i, 0 AS q, {{'c': 0, 'a': '', 'o': ''}} AS b FROM ids
    UNION ALL
    SELECT conv, i, q, min(b) AS b FROM (
        WITH step AS (SELECT s.conv, s.i, s.role, s.text, s.initial, s.blank OR s.again AS gone, CASE WHEN s.open THEN 1 ELSE 0 END AS more, b.q, b.b.c AS c, b.b.a AS a, b.b.o AS o FROM best b JOIN signs s ON s.conv = b.conv AND s.i = b.i + 1),
        ready AS (SELECT * FROM step UNION ALL SELECT step.* REPLACE (nexts.q2 AS q, c + 2 AS c, a || 'I' AS a, o || nexts.role || ':' || chr(10) AS o) FROM step JOIN nexts USING (q))
        SELECT conv, i, q, {{'c': c + 3, 'a': a || 'D', 'o': o}} AS b FROM ready
        UNION ALL SELECT conv, i, moves.q2, {{'c': c + more, 'a': a || 'K', 'o': o || role || ':' || text || chr(10)}} FROM ready JOIN moves USING (q, initial) WHERE NOT gone
        UNION ALL SELECT conv, i, nexts.q2, {{'c': c + more + 2, 'a': a || 'R', 'o': o || nexts.role || ':' || text || chr(10)}} FROM ready JOIN nexts USING (q) WHERE NOT gone)
    GROUP BY conv, i, q),
ends(q, c, a, o) AS (VALUES (0, 0, '', ''), (1, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (2, 2, 'I', 'assistant:' || chr(10)), (3, 0, '', '')),
done AS (SELECT conv, min({{'c': b.c + ends.c, 'a': b.a || ends.a, 'o': b.o || ends.o}}) AS b FROM best JOIN ends USING (q) WHERE i = (SELECT count(*) FROM signs s WHERE s.conv = best.conv) GROUP BY conv),
facts AS (SELECT conv, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
    count(*) FILTER (open AND NOT blank AND NOT again) AS truncated, count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM signs GROUP BY conv)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
    CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(b.c AS BIGINT) AS cost, b.a AS audit,
    sha256(CASE WHEN b.o = '' THEN '' ELSE substr(b.o, 1, length(b.o) - 1) END) AS repaired_sha256
FROM ids JOIN done USING (conv) LEFT JOIN facts USING (conv)
"""

RULES_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS ws FROM documents),
w AS MATERIALIZED (SELECT rid, doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM d),
numbers AS MATERIALIZED (SELECT x, list_sum(list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT) * pw[i % {rules.CYCLE} + 1])) % {rules.PRIME} AS k
    FROM (SELECT x, hex(encode(x)) AS h, {rules.POWERS} :: BIGINT[] AS pw FROM (SELECT DISTINCT x FROM w))),
seq AS MATERIALIZED (SELECT rid, doc_id, k, lead(k) OVER (PARTITION BY rid ORDER BY p) AS k2 FROM w JOIN numbers USING (x)),
ngrams AS MATERIALIZED (SELECT rid, doc_id, k % {rules.DIMS} AS bucket FROM seq UNION ALL
    SELECT rid, doc_id, ({rules.FIRST} * k + {rules.SECOND} * k2) :: BIGINT % {rules.PRIME} % {rules.DIMS} FROM seq WHERE k2 IS NOT NULL),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING avg(quality) > 0.5),
counts AS MATERIALIZED (SELECT bucket, count(*) AS r, count(*) FILTER (doc_id IN (SELECT doc_id FROM good)) AS t FROM ngrams GROUP BY bucket),
totals AS (SELECT sum(r) :: DOUBLE AS rs, sum(t) :: DOUBLE AS ts FROM counts),
weights AS MATERIALIZED (SELECT bucket, floor(1e6 * ln((t + {rules.SMOOTH} :: DOUBLE) / (ts * r / rs + {rules.SMOOTH} :: DOUBLE))) :: BIGINT AS g FROM counts, totals),
sums AS (SELECT rid, sum(g) AS weight, count(*) AS n FROM ngrams JOIN weights USING (bucket) GROUP BY rid),
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS again FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}') GROUP BY rid),
windows AS MATERIALIZED (SELECT rid, p, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS t FROM w WINDOW o AS (PARTITION BY rid ORDER BY p)),
twice AS (SELECT rid, t FROM windows WHERE t IS NOT NULL GROUP BY rid, t HAVING count(*) > 1),
repeated AS (SELECT rid, count(DISTINCT p + o) AS n FROM windows JOIN twice USING (rid, t), range(3) AS k(o) GROUP BY rid),
base AS (SELECT rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(again, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
    FROM d LEFT JOIN lines USING (rid) LEFT JOIN repeated USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed,
    CAST(CASE WHEN (SELECT ts FROM totals) > 0 THEN coalesce(weight, 0) ELSE 0 END AS BIGINT) AS weight,
    NOT base_failed AND ((SELECT ts FROM totals) = 0 OR weight >= {rules.FLOOR} * n) AS kept
FROM base LEFT JOIN sums USING (rid)
"""


def _terms(table: str, key: str) -> str:
    return f"SELECT row_number() OVER () AS rid, {key}, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM {table}"


SEARCH_SQL = f"""
WITH d AS MATERIALIZED ({_terms('documents', 'doc_id')}), b AS MATERIALIZED ({_terms('benchmark', 'item_id')}),
q AS MATERIALIZED (SELECT DISTINCT rid AS item, item_id, unnest(ts) AS term FROM b),
whole AS (SELECT count(*) AS docs, sum(len(ts)) :: BIGINT AS long FROM d WHERE len(ts) > 0),
tf AS MATERIALIZED (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 :: DOUBLE * docs + 2) / (2.0 :: DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, docs),
scores AS (SELECT item, item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // long)))) AS BIGINT) AS score
    FROM q JOIN tf USING (term) JOIN w USING (term), whole GROUP BY item, item_id, rid, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM
    (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0) WHERE rank <= {lexical.BEST}
"""
