"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_BITS = "[CASE WHEN embedding[i + 1] > 0 THEN 1::UBIGINT << (63 - i) ELSE 0::UBIGINT END FOR i IN range(64)]"

#: All pairs of queries and rows, which only a check can afford.
OP1 = f"""
WITH codes AS (SELECT vec_id, list_sum({_BITS})::UBIGINT AS code FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id,
         CAST(bit_count(xor(q.code, c.code)) AS INTEGER) AS distance
  FROM codes q, codes c WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(place AS INTEGER) AS rank, neighbour_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS place
      FROM pairs)
WHERE place <= 10
"""

#: n-grams as lists of words, counted and laid over the words they cover.
OP2 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
    [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')]
      AS lines
  FROM documents),
words AS (
  SELECT doc_id, unnest(range(1, len(ws) + 1)) AS pos, length(unnest(ws)) AS size FROM docs),
sizes AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS word_chars FROM words GROUP BY 1),
grams AS (
  SELECT doc_id, n, pos, array_to_string(ws[pos:pos + n - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS pos
        FROM docs, range(2, 6) r(n) WHERE len(ws) >= n)),
counted AS (SELECT *, count(*) OVER (PARTITION BY doc_id, n, gram) AS c FROM grams),
top AS (
  SELECT doc_id, n, max(c * (length(gram) - n + 1)) AS chars
  FROM counted WHERE c > 1 AND n <= 4 GROUP BY 1, 2),
covered AS (
  SELECT doc_id, n, count(*) AS words, sum(size) AS chars
  FROM (SELECT DISTINCT doc_id, n, unnest(range(pos, pos + n)) AS pos FROM counted WHERE c > 1 AND n >= 5)
  JOIN words USING (doc_id, pos) GROUP BY 1, 2),
tops AS (
  SELECT doc_id, max(chars / word_chars) AS share,
    bool_and(chars / word_chars <= CASE n WHEN 2 THEN 0.20 WHEN 3 THEN 0.18 ELSE 0.16 END) AS fine
  FROM top JOIN sizes USING (doc_id) GROUP BY 1),
dups AS (
  SELECT doc_id, max(chars / word_chars) AS share, bool_and(chars / word_chars <= 0.20) AS fine,
    max(words) FILTER (n = 5) AS repeated
  FROM covered JOIN sizes USING (doc_id) GROUP BY 1),
measured AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(repeated, 0) AS n_repeat_words,
    coalesce(tops.share, 0) AS top_ngram_share, coalesce(dups.share, 0) AS dup_ngram_share,
    (len(lines) - len(list_distinct(lines))) / greatest(len(lines), 1) AS dup_line_share,
    (coalesce(list_sum([length(x) FOR x IN lines]), 0)
      - coalesce(list_sum([length(x) FOR x IN list_distinct(lines)]), 0))
      / greatest(coalesce(list_sum([length(x) FOR x IN lines]), 0), 1) AS dup_line_chars,
    coalesce(tops.fine, TRUE) AND coalesce(dups.fine, TRUE) AS fine
  FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN tops USING (doc_id) LEFT JOIN dups USING (doc_id))
SELECT doc_id, n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND fine
    AND dup_line_share <= 0.30 AND dup_line_chars <= 0.20 AS kept,
  top_ngram_share, dup_ngram_share, dup_line_share, dup_line_chars
FROM measured
"""

_CONTROL = r"([<\[])(\\*(?:s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|ROLE\]|TEXT\]|/TEXT\]))"

OP4 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]'
  FROM range(2) r(t)),
sized AS (
  SELECT *, length(regexp_replace(text, '{_CONTROL}', '\\1\\\\\\2', 'g'))
    + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
      ELSE 23 + length(role) END AS size
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _strength(level: str) -> str:
    """Prior strength of a level with columns n, good, pn, pg."""
    return f"""
  SELECT CASE WHEN coalesce(most, 0) = 0 OR spread <= chance THEN 1000.0
    ELSE least(greatest((1 - least((spread - chance) / most, 1.0))
      / least((spread - chance) / most, 1.0), 1.0), 1000.0) END AS m
  FROM (SELECT sum(n * (good / n - pg / pn) ** 2) AS spread,
          sum(pg / pn * (1 - pg / pn) * (1 - n / pn)) AS chance,
          sum(pg / pn * (1 - pg / pn) * (n - 1) * (1 - n / pn)) AS most
        FROM {level} WHERE n > 0)"""


OP6 = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0
    THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
outcomes AS (
  SELECT CAST(doc_id AS VARCHAR) AS key, min(quality) AS good FROM labels
  WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY 1),
named AS (SELECT host, path, string_split(host, '.') AS labels FROM parsed),
hosts AS (
  SELECT host,
    array_to_string(labels[-2:], '.') AS domain, labels[-1] AS suffix,
    count(good) AS n, coalesce(sum(good), 0) AS good
  FROM named LEFT JOIN outcomes ON key = regexp_extract(path, '^/[a-z]{{2}}/([0-9]+)', 1)
  GROUP BY 1, 2, 3),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM domains GROUP BY 1),
overall AS (SELECT sum(n) AS n, sum(good) AS good FROM suffixes),
ls AS (SELECT s.n, s.good, o.n AS pn, o.good AS pg FROM suffixes s, overall o),
ld AS (SELECT d.n, d.good, s.n AS pn, s.good AS pg FROM domains d JOIN suffixes s USING (suffix)),
lh AS (SELECT h.n, h.good, d.n AS pn, d.good AS pg FROM hosts h JOIN domains d USING (domain)),
ms AS ({_strength("ls")}), md AS ({_strength("ld")}), mh AS ({_strength("lh")}),
rs AS (
  SELECT suffix, r, r * (1 - r) / (m + n + 1) AS v FROM (
    SELECT suffix, m, s.n AS n,
      (m * CASE WHEN o.n > 0 THEN o.good / o.n ELSE 1.0 END + s.good) / (m + s.n) AS r
    FROM suffixes s, overall o, ms)),
rd AS (
  SELECT domain, r, r * (1 - r) / (m + n + 1) + (m / (m + n)) ** 2 * pv AS v FROM (
    SELECT domain, m, n, (m * rs.r + good) / (m + n) AS r, rs.v AS pv
    FROM domains JOIN rs USING (suffix), md)),
rh AS (
  SELECT host, n AS labelled, r, r * (1 - r) / (m + n + 1) + (m / (m + n)) ** 2 * pv AS v FROM (
    SELECT host, m, n, (m * rd.r + good) / (m + n) AS r, rd.v AS pv
    FROM hosts JOIN rd USING (domain), mh)),
judged AS (
  SELECT page_id, p.host, path, labelled, 1 - r - 1.645 * sqrt(v) AS bound,
    CASE WHEN host = 'www.example.com' OR host LIKE '%.www.example.com' THEN 1 ELSE 0 END AS www,
    CASE WHEN host = 'example.com' OR host LIKE '%.example.com' THEN 1 ELSE 0 END AS example,
    labels[-1] AS tld
  FROM parsed p JOIN (SELECT *, string_split(host, '.') AS labels FROM rh) rh USING (host)),
ruled AS (
  SELECT *, CASE
    WHEN www = 1 AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN example = 1 AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN tld = 'net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN tld = 'net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN tld = 'com' AND path LIKE '/%' THEN 'com/' END AS rule
  FROM judged)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  CAST(labelled AS BIGINT) AS labelled, round(bound, 4) AS bad_bound
FROM ruled
"""


#: The notices that the given documents hold, written out here: name, licence, order, wording.
OP8 = r"""
WITH known AS (SELECT * FROM (VALUES
    ('APACHE2_REF', 'Apache-2.0', 1, 'licensed under the apache license version 2 0'),
    ('MIT_REF', 'MIT', 2, 'released under the mit license'),
    ('GPL3_REF', 'GPL-3.0-only', 3, 'this work is licensed under the gnu general public license version 3'),
    ('CC_BY_NC_REF', 'CC-BY-NC-4.0', 4, 'licensed under cc by nc 4 0'),
    -- A German word alone between two stops reads like a name, which is no licence by itself.
    ('ID_MIT', NULL, 0, 'mit')) v(name, licence, rank, wording)),
readings AS (
  SELECT doc_id, way, string_split(regexp_replace(coalesce(text, ''), ends, chr(1), 'g'), chr(1)) AS parts
  FROM documents, (VALUES (1, '[.!?;:][ \t\r\n\f]+|\n[ \t\r]*\n'), (2, '[.!?;:][ \t\r\n\f]+|\n')) e(way, ends)),
said AS (
  SELECT doc_id, way, generate_subscripts(parts, 1) AS place,
    trim(regexp_replace(translate(unnest(parts), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^a-z0-9]+', ' ', 'g')) AS wording
  FROM readings),
named AS (
  SELECT doc_id, way, string_agg(name, '|' ORDER BY place) AS ids, count(*) AS n
  FROM said JOIN known USING (wording) GROUP BY 1, 2),
best AS (SELECT doc_id, arg_max(ids, 10 * n - way) AS sentence_ids FROM named GROUP BY 1),
found AS (
  SELECT doc_id, string_agg(licence, ',' ORDER BY rank) AS licences
  FROM (SELECT DISTINCT doc_id, licence, rank FROM said JOIN known USING (wording)) GROUP BY 1)
SELECT doc_id, coalesce(licences, '') AS licences,
  CASE WHEN licences IS NULL THEN '' ELSE sentence_ids END AS sentence_ids
FROM documents LEFT JOIN found USING (doc_id) LEFT JOIN best USING (doc_id)
"""

#: Windows as texts, grouped over all documents.
OP11 = r"""
WITH docs AS (
  SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents),
windows AS (
  SELECT doc_id, place, sha256(array_to_string(ws[place:place + 49], ' ')) AS said
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS place FROM docs)),
firsts AS (SELECT said, min(doc_id) AS first FROM windows GROUP BY 1),
gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(place, place + 50)))) AS places
  FROM windows JOIN firsts USING (said) WHERE doc_id > first GROUP BY 1),
marked AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(CAST(len(places) AS BIGINT), 0) AS n_removed,
    [x FOR x, i IN ws IF NOT list_contains(coalesce(places, []), i)] AS kept
  FROM docs d LEFT JOIN gone g ON d.doc_id = g.doc_id)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM marked
"""

#: Scores of all pairs with an anchor.
OP12 = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a, rows b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
        FROM pairs WHERE same) WHERE place <= 5),
ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
  FROM pairs JOIN positives USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score,
  negative_score
FROM ranked WHERE place <= 10
"""

#: Every item against every document that holds one of its terms.
OP13 = r"""
WITH words AS (
  SELECT kind, id, unnest([x FOR x IN string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') IF x <> '']) AS term
  FROM (SELECT 'd' AS kind, doc_id AS id, coalesce(text, '') AS text FROM documents
        UNION ALL SELECT 'q', item_id, coalesce(text, '') FROM benchmark)),
tfs AS (SELECT id, term, count(*) AS tf FROM words WHERE kind = 'd' GROUP BY 1, 2),
sizes AS (SELECT id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY 1),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
norms AS (SELECT id, 100 - 25 + ((25 * n * docs) // terms) AS m FROM sizes, totals),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term, docs),
scores AS (
  SELECT q.id AS item_id, t.id AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM words q JOIN tfs t USING (term) JOIN weights USING (term) JOIN norms n ON n.id = t.id
  WHERE kind = 'q' GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
  FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 20
"""

ALL = {
    "op1_multiindex": OP1,
    "op2_repetition": OP2,
    "op4_chat": OP4,
    "op6_urls": OP6,
    "op8_licences": OP8,
    "op11_substrings": OP11,
    "op12_covertree": OP12,
    "op13_lexical": OP13,
}
