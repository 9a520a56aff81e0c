"""SQL for the queries that SQL can express; document ids are taken to be unique."""

from __future__ import annotations

SPACE = "[\\x20\\x09-\\x0D]+"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACE}'), lambda x: x <> '')"


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def shingles(source: str, key: str, text: str, k: int = 5) -> str:
    """(key, g): the distinct shingles of each text, or its whole sequence if it is shorter."""
    return f"""w AS (SELECT {key}, {words(text)} AS ws FROM {source}),
        sh AS (SELECT DISTINCT {key}, g FROM (SELECT {key}, unnest(CASE WHEN len(ws) >= {k} THEN list_transform(range(1, len(ws) - {k} + 2), lambda i: array_to_string(ws[i : i + {k - 1}], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w))"""


JACCARD = f"""WITH RECURSIVE {shingles("documents", "doc_id", LOWER)},
    n AS (SELECT doc_id, count(g) AS n FROM documents LEFT JOIN sh USING (doc_id) GROUP BY 1),
    pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
    reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.r = links.x)
    SELECT doc_id, n AS n_shingles, min(r) AS component_id FROM n JOIN reach USING (doc_id) GROUP BY 1, 2"""

LINES = f"""WITH l AS (SELECT doc_id, CAST(i AS INT) AS i, string_split({LOWER}, '\n')[i + 1] AS line FROM documents, unnest(range(0, len(string_split({LOWER}, '\n')))) AS u(i)),
    worded AS (SELECT doc_id * 100000 + i AS id, line, doc_id, i FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
    {shingles("worded", "id", "line")},
    n AS (SELECT id, count(*) AS n FROM sh GROUP BY 1),
    later AS (SELECT DISTINCT y AS id FROM (SELECT a.id AS x, b.id AS y, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.id < b.id GROUP BY 1, 2) JOIN n a ON a.id = x JOIN n b ON b.id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS kept FROM worded WHERE id NOT IN (SELECT id FROM later) GROUP BY 1),
    every AS (SELECT d.doc_id, count(w.id) AS n FROM documents d LEFT JOIN worded w USING (doc_id) GROUP BY 1)
    SELECT e.doc_id, e.n AS n_lines, e.n - coalesce(k.n, 0) AS n_removed, coalesce(k.kept, '') AS kept_lines FROM every e LEFT JOIN kept k USING (doc_id)"""


def substrings(length: int = 35) -> str:
    return f"""WITH w AS (SELECT doc_id, {words("coalesce(text, '')")} AS ws FROM documents),
    runs AS (SELECT doc_id, s, md5(array_to_string(ws[s : s + {length - 1}], ' ')) AS h FROM w, unnest(range(1, len(ws) - {length - 2})) AS u(s)),
    twice AS (SELECT h FROM runs GROUP BY 1 HAVING count(*) > 1),
    gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, s FROM runs JOIN twice USING (h)), unnest(range(s, s + {length})) AS u(p)),
    every AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS u(p)),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM every ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
    lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
    SELECT w.doc_id, len(ws) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def crc32(text: str) -> str:
    """The CRC-32 of a short ASCII text, bit by bit."""
    step = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda k: CAST(ascii(k) AS BIGINT))), lambda c, b: {step}))"


LM_BASE = f"""WITH d AS (SELECT doc_id, {crc32("CAST(doc_id AS VARCHAR)")} % 7 = 2 AS held_out, list_append({words(LOWER)}, chr(10)) AS ws FROM documents),
    t AS (SELECT doc_id, held_out, unnest(ws) AS w FROM d),
    c AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY 1),
    n AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c)
    SELECT doc_id, held_out, count(*) AS n_tokens, count(c.c) AS n_known, CAST(any_value(n) AS BIGINT) AS train_tokens, round(sum(log10((coalesce(c.c, 0) + 1) / (n + v + 1))), 4) AS base_score FROM t LEFT JOIN c USING (w), n GROUP BY 1, 2"""

QUALITY_BASE = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {words("coalesce(text, '')")} AS ws FROM documents),
    lines AS (SELECT doc_id, unnest(string_split(text, '\n')) AS line FROM d),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
    runs AS (SELECT doc_id, i, array_to_string(ws[i : i + 2], ' ') AS g FROM d, unnest(range(1, len(ws) - 1)) AS u(i)),
    twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS k FROM runs) WHERE k > 1),
    rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY 1)
    SELECT d.doc_id, len(ws) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    len(ws) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(ws) AS base_failed FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)"""

#: Sources stop from the least size for their weight on; the rest share what these leave.
TARGETS = f"""WITH s AS (SELECT source, CAST(sum(len({words("coalesce(text, '')")})) AS BIGINT) AS size FROM documents GROUP BY 1),
    w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
    levels AS (SELECT a.source, ((SELECT sum(size) FROM w) - coalesce((SELECT sum(3 * size) FROM w b WHERE 3 * b.size / b.weight < 3 * a.size / a.weight), 0)) / (SELECT sum(weight) FROM w b WHERE 3 * b.size / b.weight >= 3 * a.size / a.weight) AS level, 3 * a.size / a.weight AS ratio FROM w a),
    stay AS (SELECT min_by(level, ratio) AS level FROM levels WHERE ratio > level)
    SELECT source, size AS source_size, round(CAST(CASE WHEN (SELECT level FROM stay) IS NULL THEN 3 * size ELSE least(3 * size, weight * (SELECT level FROM stay)) END AS DOUBLE), 4) AS target FROM w"""
