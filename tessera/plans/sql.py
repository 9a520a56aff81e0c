"""The registered queries' SQL, put together from common table expressions."""

from __future__ import annotations

from tessera.functions import text as X
from tessera.operators.evaluate import CAUSES, THRESHOLDS


def quoted(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def clean(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(replace(lower({x}), '&', ' and '), '[.''`]', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def core(x: str) -> str:
    c = f"array_to_string(list_filter({words(x)}, lambda w: NOT list_contains({quoted(X.LEGAL + X.GENERIC)}, w)), ' ')"
    return f"CASE WHEN {c} = '' THEN {x} ELSE {c} END"


def address(x: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.ABBREVIATIONS.items())
    return f"array_to_string(list_transform(list_filter({words(x)}, lambda w: w <> 'null'), lambda w: CASE w {cases} ELSE w END), ' ')"


def runs(x: str) -> str:
    return f"regexp_extract_all({x}, '[0-9]+')"


def postcode(r: str) -> str:
    return f"coalesce(list_filter({r}, lambda r: length(r) IN (5, 6))[-1], '')"


def city(x: str) -> str:
    keep = f"list_filter(list_transform(list_filter(string_split({x}, ','), lambda p: NOT regexp_matches(p, '[0-9]')), lambda p: {clean('p')}), lambda p: p <> 'null' AND length(replace(p, ' ', '')) > 2 AND NOT list_has_any({words('p')}, {quoted(X.NOT_CITY)}))"
    return f"coalesce({keep}[-2], {keep}[1], '')"


def grams(x: str) -> str:
    return f"flatten(list_transform({words(x)}, lambda w: list_transform(range(1, length(w) + 1), lambda i: substring(' ' || w || ' ', i, 3))))"


def numbers(r: str) -> str:
    return f"list_distinct(list_transform({r}, lambda x: CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END))"


RECORDS = f"""raw AS (
    SELECT 'S' || (page_id % 3 + 1) || '-' || page_id AS entity_id, 'S' || (page_id % 3 + 1) AS source, url AS name_raw,
           regexp_replace(url, '[/?#&=:]+', ', ', 'g') AS addr_raw, regexp_extract(url, '/(en|fr|de|es)(/|$|\\?|#)', 1) AS country,
           regexp_extract(lower(url), '^https?://(?:www\\.|m\\.|blog\\.)?([^/]+)', 1) AS address FROM pages),
cleaned AS (SELECT *, {clean('name_raw')} AS name_norm, {clean('addr_raw')} AS addr_clean, {runs('addr_raw')} AS numbers FROM raw),
rec AS (SELECT entity_id, source, country, name_raw, addr_raw, name_norm, numbers, {core('name_norm')} AS name_core, {address('addr_clean')} AS addr_norm, {postcode('numbers')} AS postcode, {city('addr_raw')} AS city_token FROM cleaned)"""
TRUTH = """pairs AS (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, a.country FROM raw a JOIN raw b ON a.address = b.address AND a.country = b.country AND a.source = 'S1' AND b.source <> 'S1'),
truth AS (SELECT s.entity_id AS s1_id, s.country, count(p.cand_id) AS n_true, coalesce(string_agg(p.cand_id, ',' ORDER BY p.cand_id), '') AS ids FROM raw s LEFT JOIN pairs p ON p.s1_id = s.entity_id WHERE s.source = 'S1' GROUP BY 1, 2)"""


def index(cap: int = 500, share: float = 0.002, fallback: int = 5) -> str:
    return f"""txt AS (
    SELECT entity_id, source, country, 'name' AS channel, name_core AS text FROM rec
    UNION ALL SELECT entity_id, source, country, 'ctx', trim(concat_ws(' ', name_core, nullif(postcode, ''), nullif(city_token, ''))) FROM rec
    UNION ALL SELECT entity_id, source, country, 'addr', addr_norm FROM rec),
g AS (SELECT country, channel, entity_id, source, gram, count(*) AS tf FROM (SELECT country, channel, entity_id, source, unnest({grams('text')}) AS gram FROM txt) GROUP BY ALL),
dfs AS (SELECT country, channel, gram, count(*) AS df FROM g GROUP BY ALL),
docs AS (SELECT country, channel, count(*) AS n_docs FROM txt GROUP BY ALL),
idf AS (SELECT country, channel, gram, df, n_docs, ln((1 + n_docs) / (1 + df)) + 1 AS idf FROM dfs JOIN docs USING (country, channel)),
w AS (SELECT country, channel, entity_id, source, gram, df, n_docs, (1 + ln(tf)) * idf AS w FROM g JOIN idf USING (country, channel, gram)),
q AS (SELECT country, channel, entity_id, source, gram, df, n_docs, CAST(round(w / sqrt(sum(w * w) OVER (PARTITION BY country, channel, entity_id)) * 1000000) AS BIGINT) AS q FROM w),
marked AS (SELECT *, df > greatest({cap}, floor(n_docs * {share})) AS common, row_number() OVER (PARTITION BY country, channel, entity_id ORDER BY df, gram) AS rare FROM q WHERE source = 'S1'),
search AS (SELECT * FROM (SELECT *, min(common) OVER (PARTITION BY country, channel, entity_id) AS lost FROM marked) WHERE NOT common OR (lost AND rare <= {fallback})),
hits AS (SELECT a.country, a.channel, a.entity_id AS s1_id, b.entity_id AS cand_id, b.source, CAST(sum(a.q * b.q) AS BIGINT) AS score FROM search a JOIN q b USING (country, channel, gram) WHERE b.source <> 'S1' GROUP BY ALL),
ret AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, channel, s1_id, source ORDER BY score DESC, cand_id) AS rank FROM hits) WHERE rank <= CASE channel WHEN 'name' THEN 60 ELSE 40 END),
cosine AS (SELECT p.country, p.s1_id, p.cand_id, a.channel, CAST(sum(a.q * b.q) AS BIGINT) AS cos FROM (SELECT DISTINCT country, s1_id, cand_id FROM ret) p JOIN q a ON a.entity_id = p.s1_id AND a.country = p.country JOIN q b ON b.entity_id = p.cand_id AND b.country = p.country AND b.channel = a.channel AND b.gram = a.gram GROUP BY ALL),
keyed AS (SELECT r.*, coalesce(c.cos, 0) AS cos, coalesce(c.cos, 0) + CASE WHEN r.channel IN ('name', 'ctx') THEN CAST(trunc(coalesce(x.cos, 0) * 0.5) AS BIGINT) ELSE 0 END AS key FROM ret r LEFT JOIN cosine c USING (country, s1_id, cand_id, channel) LEFT JOIN (SELECT * FROM cosine WHERE channel = 'addr') x ON x.country = r.country AND x.s1_id = r.s1_id AND x.cand_id = r.cand_id),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, channel, s1_id, source ORDER BY key DESC, score DESC, cand_id) AS final FROM keyed) WHERE final <= CASE channel WHEN 'name' THEN 15 ELSE 10 END),
per AS (SELECT country, s1_id, cand_id, min(final) FILTER (channel = 'name') AS rank_name, min(final) FILTER (channel = 'ctx') AS rank_ctx, min(final) FILTER (channel = 'addr') AS rank_addr FROM ranked GROUP BY ALL),
unit AS (SELECT country, s1_id, cand_id, least(coalesce(max(cos) FILTER (channel = 'name'), 0) / 1e12, 1) AS cos_name, least(coalesce(max(cos) FILTER (channel = 'ctx'), 0) / 1e12, 1) AS cos_ctx, least(coalesce(max(cos) FILTER (channel = 'addr'), 0) / 1e12, 1) AS cos_addr FROM cosine GROUP BY ALL),
cand AS (SELECT s1_id, cand_id, country, rank_name, rank_ctx, rank_addr, cos_name, cos_ctx, cos_addr, greatest(cos_name, cos_ctx, cos_addr) AS block_score FROM per JOIN unit USING (country, s1_id, cand_id))"""


BLOCKED = f"{RECORDS},\n{TRUTH},\n{index()}"
#: Predictions for evaluation queries: the name's cosine, to six digits.
PREDS = "preds AS (SELECT s1_id, cand_id, round(cos_name, 6) AS prob FROM cand)"
GRID = "grid AS (SELECT unnest([" + ", ".join(map(str, THRESHOLDS)) + "]) AS t)"
F05 = "CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END ELSE 1.25 * tp / (n_pred + 0.25 * n_true) END"
COUNTS = "counts AS (SELECT t.s1_id, t.country, t.n_true, count(p.cand_id) AS n_pred, count(x.cand_id) AS tp FROM truth t LEFT JOIN (SELECT * FROM preds WHERE prob >= 0.7) p ON p.s1_id = t.s1_id LEFT JOIN pairs x ON x.s1_id = p.s1_id AND x.cand_id = p.cand_id GROUP BY ALL)"
SWEPT = f"swept AS (SELECT t, avg({F05}) AS macro_f05 FROM (SELECT g.t, e.s1_id, e.n_true, count(p.cand_id) AS n_pred, count(x.cand_id) AS tp FROM grid g CROSS JOIN truth e LEFT JOIN preds p ON p.s1_id = e.s1_id AND p.prob >= g.t LEFT JOIN pairs x ON x.s1_id = p.s1_id AND x.cand_id = p.cand_id GROUP BY ALL) GROUP BY t)"
STRATA = "ent AS (SELECT s1_id, country, n_true > 0 AS has_match FROM truth)"


#: Faulty id lists, as views.spoilt makes them; {rows} has source1_entity_id and ids.
SPOILT = """spoilt AS (WITH l AS (SELECT source1_entity_id, CAST(split_part(source1_entity_id, '-', 2) AS BIGINT) AS n, CASE WHEN ids = '' THEN [] ELSE string_split(ids, ',') END AS ids FROM ({rows})),
    r AS (SELECT CASE WHEN n % 31 = 0 THEN source1_entity_id || ' ' ELSE source1_entity_id END AS source1_entity_id, array_to_string(list_concat(ids, CASE WHEN n % 7 = 0 THEN ids[1:1] ELSE [] END, CASE WHEN n % 11 = 0 THEN [source1_entity_id] ELSE [] END, CASE WHEN n % 13 = 0 THEN ['X-' || n] ELSE [] END, CASE WHEN n % 17 = 0 THEN ['S2-0' || n] ELSE [] END), ',') AS ids, n FROM l WHERE n % 19 <> 0)
    SELECT source1_entity_id, ids FROM r UNION ALL SELECT source1_entity_id, ids FROM r WHERE n % 23 = 0 UNION ALL SELECT 'S1-0' || n, '' FROM r WHERE n % 29 = 0)"""
#: Trimmed, without repeated ids, as truth is read.
SPOILT_LISTS = "lists AS (SELECT trim(source1_entity_id) AS s1_id, list_distinct(CASE WHEN ids = '' THEN [] ELSE string_split(ids, ',') END) AS ids FROM spoilt), mentions AS (SELECT s1_id, unnest(ids) AS id FROM lists)"
FEWER = "fewer AS (SELECT * FROM raw WHERE CAST(split_part(entity_id, '-', 2) AS BIGINT) % 37 <> 0)"


def scores(fields: dict[str, tuple[str, str]], source: str) -> str:
    """score(s1_id, cand_id, f, ratio, partial, tsort, tset) of pairs of texts by field; source: s1_id, cand_id and the texts.

    Longest common subsequences by bits: masks of each distinct left text, then a step for each character of the right one.
    """
    each = " UNION ALL ".join(f"SELECT s1_id, cand_id, '{f}' AS f, {a} AS a, {b} AS b FROM ({source})" for f, (a, b) in fields.items())
    joined = lambda x: f"array_to_string(list_sort({x}), ' ')"
    full = "((CAST(1 AS HUGEINT) << length(a)) - 1)"
    return f"""pr AS ({each}),
    tx AS (SELECT DISTINCT a, b, {words('a')} AS wa, {words('b')} AS wb FROM pr WHERE a <> '' AND b <> ''),
    ts AS (SELECT a, b, {joined('wa')} AS sa, {joined('wb')} AS sb, {joined('list_filter(list_distinct(wa), lambda x: list_contains(wb, x))')} AS shared, {joined('list_filter(list_distinct(wa), lambda x: NOT list_contains(wb, x))')} AS le, {joined('list_filter(list_distinct(wb), lambda x: NOT list_contains(wa, x))')} AS ri, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS short, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS long FROM tx),
    st AS (SELECT *, trim(shared || ' ' || le) AS one, trim(shared || ' ' || ri) AS two FROM ts),
    win AS (SELECT DISTINCT short, long, long[greatest(i, 0) + 1 : i + length(short)] AS w FROM st, unnest(range(1 - length(short), length(long))) AS u(i) WHERE NOT contains(long, short)),
    asks AS (SELECT a, b FROM st UNION SELECT sa, sb FROM st UNION SELECT one, two FROM st UNION SELECT shared, one FROM st UNION SELECT shared, two FROM st UNION SELECT short, w FROM win),
    masks AS (SELECT a, map(list(ch), list(bits)) AS m FROM (SELECT a, ch, CAST(sum(CAST(1 AS HUGEINT) << i) AS HUGEINT) AS bits FROM (SELECT a, string_split(a, '')[i + 1] AS ch, CAST(i AS INT) AS i FROM (SELECT DISTINCT a FROM asks WHERE a <> ''), unnest(range(0, length(a))) AS u(i)) GROUP BY 1, 2) GROUP BY 1),
    ratios AS (SELECT a, b, 2 * (length(a) - bit_count(list_reduce(list_prepend({full}, list_transform(string_split(b, ''), lambda c: coalesce(m[c], 0))), lambda row, x: ((row + (row & x)) | (row - (row & x))) & {full}))) / (length(a) + length(b)) AS ratio FROM asks JOIN masks USING (a) WHERE b <> ''),
    best AS (SELECT short, long, max(ratio) AS ratio FROM win JOIN ratios ON ratios.a = short AND ratios.b = w GROUP BY 1, 2),
    known AS (SELECT st.a, st.b, r.ratio, CASE WHEN contains(long, short) THEN 1.0 ELSE coalesce(best.ratio, 0) END AS partial, coalesce(t.ratio, 0) AS tsort, CASE WHEN shared <> '' AND (le = '' OR ri = '') THEN 1.0 ELSE greatest(coalesce(x.ratio, 0), coalesce(y.ratio, 0), coalesce(z.ratio, 0)) END AS tset
        FROM st LEFT JOIN ratios r ON r.a = st.a AND r.b = st.b LEFT JOIN ratios t ON t.a = sa AND t.b = sb LEFT JOIN ratios x ON x.a = one AND x.b = two LEFT JOIN ratios y ON y.a = shared AND y.b = one LEFT JOIN ratios z ON z.a = shared AND z.b = two LEFT JOIN best USING (short, long)),
    score AS (SELECT s1_id, cand_id, f, coalesce(ratio, 0) AS ratio, coalesce(partial, 0) AS partial, coalesce(tsort, 0) AS tsort, coalesce(tset, 0) AS tset, CASE WHEN pr.a = '' OR pr.b = '' THEN 0 ELSE jaro_winkler_similarity(pr.a, pr.b) END AS jw FROM pr LEFT JOIN known USING (a, b))"""


SIDES = "SELECT c.s1_id, c.cand_id, a.name_norm AS nna, b.name_norm AS nnb, a.name_core AS nca, b.name_core AS ncb, a.addr_norm AS ada, b.addr_norm AS adb FROM cand c JOIN rec a ON a.entity_id = c.s1_id JOIN rec b ON b.entity_id = c.cand_id"
#: Pairs that blocking missed, with the likely cause.
MISSED = f"""loose AS (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id FROM raw a JOIN raw b ON a.country = b.country AND CAST(split_part(a.entity_id, '-', 2) AS BIGINT) % 10 = CAST(split_part(b.entity_id, '-', 2) AS BIGINT) % 10 AND a.source = 'S1' AND b.source <> 'S1'),
gone AS (SELECT p.s1_id, p.cand_id FROM loose p LEFT JOIN cand c ON c.s1_id = p.s1_id AND c.cand_id = p.cand_id WHERE c.s1_id IS NULL),
{scores({"nc": ("nca", "ncb")}, SIDES.replace("cand c", "gone c"))},
missed AS (SELECT s1_id, cand_id, b.source, tset AS similarity, a.name_raw AS name, a.addr_raw AS address, b.name_raw AS other_name, b.addr_raw AS other_address,
    CASE WHEN trim(b.addr_raw) = '' THEN '{CAUSES[0]}' WHEN regexp_matches(a.name_raw || b.name_raw, '[^\x00-\x7F]') THEN '{CAUSES[1]}' WHEN tset < 0.5 THEN '{CAUSES[2]}' WHEN tset < 0.8 THEN '{CAUSES[3]}' ELSE '{CAUSES[4]}' END AS cause
    FROM score JOIN rec a ON a.entity_id = s1_id JOIN rec b ON b.entity_id = cand_id)"""


def key(salt: str, column: str) -> str:
    return f"md5('42:{salt}:' || {column})"


def oracle() -> dict[str, str]:
    r = f"WITH {RECORDS} "
    t = f"WITH {RECORDS}, {TRUTH} "
    b = f"WITH {BLOCKED} "
    e = f"WITH {BLOCKED}, {PREDS}, {COUNTS} "
    s = f"WITH {BLOCKED}, {PREDS}, {GRID}, {SWEPT} "
    few = f"WITH {RECORDS},\n{TRUTH},\n{index(20)} "
    ranked_strata = f"{t}, {STRATA}, o AS (SELECT *, row_number() OVER (PARTITION BY country, has_match ORDER BY {key('%s', 's1_id')}, s1_id) AS place, count(*) OVER (PARTITION BY country, has_match) AS n FROM ent) "
    unaccented = "strip_accents(replace(replace(coalesce(text, ''), 'ß', 'ss'), 'ẞ', 'SS'))"
    pairside = "JOIN rec a ON a.entity_id = c.s1_id JOIN rec b ON b.entity_id = c.cand_id"
    shared = f"len(list_intersect({numbers('a.numbers')}, {numbers('b.numbers')}))"
    both = f"len(list_intersect(list_distinct({words('a.name_core')}), list_distinct({words('b.name_core')})))"
    either = f"len(list_distinct(list_concat({words('a.name_core')}, {words('b.name_core')})))"
    spoilt_rows = f"{b}, {SPOILT.replace('{rows}', 'SELECT t.s1_id AS source1_entity_id, coalesce(string_agg(c.cand_id, chr(44) ORDER BY c.cand_id), left(chr(48), 0)) AS ids FROM truth t LEFT JOIN cand c ON c.s1_id = t.s1_id GROUP BY 1')}"
    spoilt_truth = f"{t}, {SPOILT.replace('{rows}', 'SELECT s1_id AS source1_entity_id, ids FROM truth')}, {SPOILT_LISTS}"
    real = lambda x: f"round(CAST(CAST({x} AS REAL) AS DOUBLE), 5)"
    fuzzy = ", ".join(f"round(CAST(CAST(max(CASE WHEN s.f = '{f}' THEN s.{k} END) AS REAL) AS DOUBLE), 5) AS {f}_{k}" for f in ("nn", "nc", "ad") for k in ("ratio", "partial", "tsort", "tset", "jw"))
    ranks = ", ".join(f"{real(f'CAST(rank_{x} IS NOT NULL AS INT)')} AS ch_{x}, {real(f'rank_{x}')} AS rank_{x}" for x in ("name", "ctx", "addr"))
    return {
        "scan_stats": "SELECT count(*) AS n_rows, count(DISTINCT trim(c_name)) AS n_ids, count(*) - count(DISTINCT trim(c_name)) AS n_repeated, count(*) FILTER (trim(c_mktsegment) = '') AS empty_names, count(*) FILTER (trim(c_mktsegment) = '') AS empty_addresses, count(*) FILTER (NOT starts_with(trim(c_name), 'Customer#')) AS bad_prefix, count(*) FILTER (c_name <> trim(c_name)) AS outer_space FROM customer",
        "country_counts": "SELECT trim(n_name) AS country, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
        "clean_text": f"SELECT doc_id, {clean(unaccented)} AS cleaned FROM documents",
        "name_core": f"{r} SELECT entity_id, name_norm, name_core, array_to_string({words('name_core')}, '|') AS name_tokens FROM rec",
        "address_expand": f"{r} SELECT entity_id, addr_norm FROM rec",
        "digit_runs": f"SELECT doc_id, array_to_string({runs('text')}, ',') AS numbers FROM documents",
        "postcode": f"SELECT doc_id, {postcode(runs('text'))} AS postcode FROM documents",
        "city_token": f"{r} SELECT entity_id, city_token FROM rec",
        "id_lists": "SELECT conv_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(s, ','), lambda x: trim(x)), lambda x: x <> ''))), ',') AS ids FROM (SELECT conv_id, string_agg(' S2-' || turn || ',S3-' || length(text) || ', ', ',') AS s FROM conversations GROUP BY 1)",
        "char_grams": f"SELECT gram, count(*) AS n FROM (SELECT unnest({grams(clean(unaccented))}) AS gram FROM documents) GROUP BY 1",
        "doc_freq": f"{b} SELECT country, channel, gram, df FROM dfs",
        "idf": f"{b} SELECT country, channel, gram, n_docs, round(idf, 6) AS idf FROM idf",
        "tfidf_fixed": f"{b} SELECT country, channel, entity_id, gram, q FROM q",
        "prune_common": f"{few} SELECT country, channel, entity_id, gram, df FROM marked WHERE NOT common",
        "rare_fallback": f"{few} SELECT country, channel, entity_id, gram, df FROM search",
        "topk_name": f"{b} SELECT s1_id, cand_id, score, rank FROM ret WHERE channel = 'name'",
        "topk_ctx": f"{b} SELECT s1_id, cand_id, score, rank FROM ret WHERE channel = 'ctx'",
        "topk_addr": f"{b} SELECT s1_id, cand_id, score, rank FROM ret WHERE channel = 'addr'",
        "topk_pruned": f"{few} SELECT channel, s1_id, cand_id, score, rank FROM ret",
        "exact_cosine": f"{b} SELECT s1_id, cand_id, channel, cos FROM cosine",
        "rerank_tiebreak": f"{b} SELECT channel, s1_id, cand_id, cos, CAST(key AS BIGINT) AS key, final FROM ranked",
        "candidates_union": f"{b} SELECT s1_id, cand_id, country, rank_name, rank_ctx, rank_addr, round(CAST(CAST(cos_name AS REAL) AS DOUBLE), 5) AS cos_name, round(CAST(CAST(cos_ctx AS REAL) AS DOUBLE), 5) AS cos_ctx, round(CAST(CAST(cos_addr AS REAL) AS DOUBLE), 5) AS cos_addr, round(CAST(CAST(block_score AS REAL) AS DOUBLE), 5) AS block_score FROM cand",
        "country_equal_share": f"{t} SELECT count(*) AS n_true_pairs, count(*) FILTER (a.country = b.country) AS n_equal, round(count(*) FILTER (a.country = b.country) / count(*), 9) AS country_equal_share FROM pairs p JOIN raw a ON a.entity_id = p.s1_id JOIN raw b ON b.entity_id = p.cand_id",
        "pair_features": f"{b} SELECT s1_id, cand_id, round(CASE WHEN {either} > 0 THEN {both} / {either} ELSE 0 END, 6) AS name_jaccard, CAST(a.name_core = b.name_core AND a.name_core <> '' AS INT) AS core_exact, CAST(abs(length(a.name_core) - length(b.name_core)) AS INT) AS name_len_diff, CAST(a.addr_norm = '' AS INT) AS addr_empty_s1, CAST(b.addr_norm = '' AS INT) AS addr_empty_cand, CAST({shared} AS INT) AS num_shared, CAST(len(a.numbers) > 0 AND len(b.numbers) > 0 AND {shared} = 0 AS INT) AS num_conflict, CASE WHEN a.postcode = '' OR b.postcode = '' THEN 0 WHEN a.postcode = b.postcode THEN 1 ELSE -1 END AS pc_state FROM cand c {pairside}",
        "jaro_winkler": f"{b} SELECT s1_id, cand_id, round(CASE WHEN a.name_norm = '' OR b.name_norm = '' THEN 0 ELSE jaro_winkler_similarity(a.name_norm, b.name_norm) END, 6) AS jw FROM cand c {pairside}",
        "label_pairs": f"{b} SELECT c.s1_id, c.cand_id, CAST(p.s1_id IS NOT NULL AS INT) AS label FROM cand c LEFT JOIN pairs p ON p.s1_id = c.s1_id AND p.cand_id = c.cand_id",
        "strat_split": ranked_strata.replace("%s", "split") + "SELECT s1_id, country, has_match, CASE WHEN place <= floor(n * 0.8 + 0.5) THEN 'train' ELSE 'val' END AS split FROM o",
        "strat_sample": ranked_strata.replace("%s", "frac") + "SELECT s1_id, country, has_match FROM o WHERE place <= greatest(1, floor(n * 0.25 + 0.5))",
        "bottom_k": f"{r} SELECT entity_id FROM raw WHERE source <> 'S1' ORDER BY {key('distractor', 'entity_id')}, entity_id LIMIT 50",
        "hash_share": f"SELECT doc_id FROM documents WHERE substring({key('test', 'doc_id')}, 1, 8) < '4ccccccc'",
        "group_cap": f"SELECT conv_id, turn FROM conversations WHERE conv_id IN (SELECT conv_id FROM (SELECT conv_id, sum(n) OVER (ORDER BY k, conv_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT conv_id, count(*) AS n, {key('cap', 'conv_id')} AS k FROM conversations GROUP BY 1)) WHERE s <= 200)",
        "largest_remainder": "WITH s AS (SELECT c_mktsegment AS stratum, count(*) AS size FROM customer GROUP BY 1), f AS (SELECT *, size * 100.0 / sum(size) OVER () AS quota FROM s), o AS (SELECT *, floor(quota) AS base, row_number() OVER (ORDER BY quota - floor(quota) DESC, stratum) AS turn FROM f) SELECT stratum, size, CAST(base + CASE WHEN turn <= 100 - sum(base) OVER () AND base < size THEN 1 ELSE 0 END AS BIGINT) AS take FROM o",
        "fbeta_per_entity": f"{e} SELECT s1_id, n_true, n_pred, tp, round({F05}, 9) AS f05 FROM counts",
        "macro_f05": f"{e} SELECT CASE WHEN grouping(country) = 0 THEN country END AS country, CASE WHEN grouping(n_true = 0) = 0 THEN n_true = 0 END AS singleton, count(*) AS entities, round(avg({F05}), 9) AS macro_f05, round(CASE WHEN sum(n_pred) = 0 THEN 1 ELSE sum(tp) / sum(n_pred) END, 9) AS precision, round(CASE WHEN sum(n_true) = 0 THEN 1 ELSE sum(tp) / sum(n_true) END, 9) AS recall FROM counts GROUP BY GROUPING SETS ((), (country), (n_true = 0))",
        "threshold_sweep": f"{s} SELECT CAST(t AS DOUBLE) AS t, round(macro_f05, 9) AS macro_f05 FROM swept",
        "best_threshold": f"{s} SELECT CAST(t AS DOUBLE) AS t, round(macro_f05, 9) AS macro_f05 FROM swept ORDER BY round(macro_f05, 12) DESC, t DESC LIMIT 1",
        "apply_threshold": f"{e} SELECT s1_id, cand_id, prob FROM preds WHERE prob >= 0.7",
        "blocking_recall": f"{b}, h AS (SELECT p.s1_id, count(*) AS n, count(c.cand_id) AS k FROM pairs p LEFT JOIN cand c ON c.s1_id = p.s1_id AND c.cand_id = p.cand_id GROUP BY 1), m AS (SELECT t.s1_id, count(c.cand_id) AS m FROM truth t LEFT JOIN cand c ON c.s1_id = t.s1_id GROUP BY 1) SELECT (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM h) AS n_true, (SELECT CAST(coalesce(sum(k), 0) AS BIGINT) FROM h) AS n_hit, round((SELECT CASE WHEN sum(n) > 0 THEN sum(k) / sum(n) ELSE 1 END FROM h), 9) AS recall, round((SELECT sum(m) / count(*) FROM m), 9) AS avg_candidates, round((SELECT CASE WHEN count(*) > 0 THEN count(*) FILTER (n = k) / count(*) ELSE 1 END FROM h), 9) AS full_set, round((SELECT count(*) FILTER (m = 0) / count(*) FROM m), 9) AS zero_share",
        "recall_by_channel": f"{b} SELECT p.country, count(*) AS n_true, round(avg(CAST(rank_name IS NOT NULL AS INT)), 9) AS recall_name, round(avg(CAST(rank_ctx IS NOT NULL AS INT)), 9) AS recall_ctx, round(avg(CAST(rank_addr IS NOT NULL AS INT)), 9) AS recall_addr, round(avg(CAST(c.s1_id IS NOT NULL AS INT)), 9) AS recall_any FROM pairs p LEFT JOIN cand c ON c.s1_id = p.s1_id AND c.cand_id = p.cand_id GROUP BY 1",
        "match_histogram": f"{t} SELECT least(n_true, 10) AS matches, count(*) AS n FROM truth GROUP BY 1",
        "truth_stats": f"{spoilt_truth} SELECT count(*) AS n_rows, count(*) - count(DISTINCT s1_id) AS repeated_rows, count(*) FILTER (len(ids) = 0) AS singletons, count(*) FILTER (len(list_filter(ids, lambda x: starts_with(x, 'S2-'))) > 0 AND len(list_filter(ids, lambda x: starts_with(x, 'S3-'))) > 0) AS both_sources, (SELECT count(*) FROM mentions) AS n_pairs, (SELECT count(*) FROM mentions WHERE NOT regexp_matches(id, '^S[23]-')) AS other_prefix, (SELECT count(*) FROM (SELECT id FROM mentions GROUP BY 1 HAVING count(*) > 1)) AS shared_ids, (SELECT coalesce(max(k), 0) FROM (SELECT count(*) AS k FROM mentions GROUP BY id)) AS most_shared, (SELECT count(*) FROM spoilt WHERE source1_entity_id <> trim(source1_entity_id)) AS outer_space FROM lists",
        "truth_integrity": f"""{spoilt_truth}, {FEWER}, lost AS (SELECT id FROM mentions WHERE id NOT IN (SELECT entity_id FROM fewer)), own AS (SELECT entity_id FROM fewer WHERE source = 'S1')
            SELECT 'missing mentions' AS what, count(*) AS n FROM lost UNION ALL SELECT 'missing ids', count(DISTINCT id) FROM lost
            UNION ALL SELECT 'truth without record', count(DISTINCT s1_id) FROM lists WHERE s1_id NOT IN (SELECT entity_id FROM own)
            UNION ALL SELECT 'record without truth', count(*) FROM own WHERE entity_id NOT IN (SELECT s1_id FROM lists)
            UNION ALL SELECT 'repeated truth rows', count(*) FROM (SELECT s1_id FROM lists GROUP BY 1 HAVING count(*) > 1)""",
        "submission_rows": f"{b} SELECT t.s1_id AS source1_entity_id, coalesce(string_agg(c.cand_id, ',' ORDER BY c.cand_id), '') AS candidate_entity_ids FROM truth t LEFT JOIN cand c ON c.s1_id = t.s1_id GROUP BY 1",
        "submission_checks": f"""{spoilt_rows}, r AS (SELECT source1_entity_id AS s1_id, CASE WHEN trim(ids) = '' THEN [] ELSE string_split(ids, ',') END AS ids FROM spoilt), x AS (SELECT DISTINCT unnest(ids) AS id FROM r)
            SELECT 'repeated rows' AS what, count(*) AS n FROM (SELECT s1_id FROM r GROUP BY 1 HAVING count(*) > 1)
            UNION ALL SELECT 'repeated ids in a list', count(DISTINCT s1_id) FROM r WHERE len(ids) <> len(list_distinct(ids))
            UNION ALL SELECT 'self matches', count(*) FROM x WHERE starts_with(id, 'S1-') UNION ALL SELECT 'bad prefixes', count(*) FROM x WHERE NOT regexp_matches(id, '^S[123]-')
            UNION ALL SELECT 'missing entities', count(*) FROM truth WHERE s1_id NOT IN (SELECT s1_id FROM r) UNION ALL SELECT 'unknown entities', count(DISTINCT s1_id) FROM r WHERE s1_id NOT IN (SELECT s1_id FROM truth)
            UNION ALL SELECT 'unknown ids', count(*) FROM x WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT entity_id FROM raw)""",
        "share_deviation": f"{r}, a AS (SELECT country, count(*) AS n FROM raw GROUP BY 1), b AS (SELECT country, count(*) AS n FROM raw WHERE source = 'S1' GROUP BY 1), j AS (SELECT coalesce(a.n, 0) / (SELECT sum(n) FROM a) AS x, coalesce(b.n, 0) / (SELECT sum(n) FROM b) AS y FROM a FULL JOIN b USING (country)) SELECT round(max(abs(x - y)), 9) AS deviation, round(0.05 + 1 / (SELECT sum(n) FROM b), 9) AS tolerance FROM j",
        "miss_causes": f"{b}, {MISSED} SELECT cause, source, count(*) AS n FROM missed GROUP BY 1, 2",
        "miss_examples": f"{b}, {MISSED} SELECT cause, s1_id, cand_id, round(similarity, 3) AS similarity, name, address, other_name, other_address FROM (SELECT *, row_number() OVER (PARTITION BY cause ORDER BY s1_id, cand_id) AS k FROM missed) WHERE k <= 5",
        "precision_curve": f"{e}, steps AS (SELECT prob, count(x.s1_id) AS p, count(*) - count(x.s1_id) AS n FROM preds LEFT JOIN pairs x ON x.s1_id = preds.s1_id AND x.cand_id = preds.cand_id GROUP BY 1), run AS (SELECT *, sum(p) OVER (ORDER BY prob DESC) AS tp, sum(p + n) OVER (ORDER BY prob DESC) AS every FROM steps) SELECT round(sum(p * tp / every) / sum(p), 6) AS average_precision, round(sum(n * (tp - p / 2)) / sum(p) / sum(n), 6) AS auc FROM run",
        "fuzzy_scores": f"{b}, {scores({'nc': ('nca', 'ncb')}, SIDES)} SELECT s1_id, cand_id, round(ratio, 6) AS ratio, round(partial, 6) AS partial, round(tsort, 6) AS tsort, round(tset, 6) AS tset, round(jw, 6) AS jw FROM score",
        "feature_rows": f"{b}, {scores({'nn': ('nna', 'nnb'), 'nc': ('nca', 'ncb'), 'ad': ('ada', 'adb')}, SIDES)} SELECT c.s1_id, c.cand_id, {fuzzy}, {real(f'CASE WHEN {either} > 0 THEN {both} / {either} ELSE 0 END')} AS name_jaccard, {real('CAST(a.name_core = b.name_core AND a.name_core <> left(chr(48), 0) AS INT)')} AS core_exact, {real('abs(length(a.name_core) - length(b.name_core))')} AS name_len_diff, {real('CAST(length(a.addr_norm) = 0 AS INT)')} AS addr_empty_s1, {real('CAST(length(b.addr_norm) = 0 AS INT)')} AS addr_empty_cand, {real(shared)} AS num_shared, {real(f'CAST(len(a.numbers) > 0 AND len(b.numbers) > 0 AND {shared} = 0 AS INT)')} AS num_conflict, {real('CASE WHEN length(a.postcode) = 0 OR length(b.postcode) = 0 THEN 0 WHEN a.postcode = b.postcode THEN 1 ELSE -1 END')} AS pc_state, {real('CAST(b.source[2:2] AS INT) // 3')} AS cand_is_s3, {ranks}, {real(' + '.join(f'CAST(rank_{x} IS NOT NULL AS INT)' for x in ('name', 'ctx', 'addr')))} AS n_channels, {real('cos_name')} AS cos_name, {real('cos_ctx')} AS cos_ctx, {real('cos_addr')} AS cos_addr, {real('block_score')} AS block_score, CAST(max(x.s1_id) IS NOT NULL AS INT) AS label FROM cand c {pairside} JOIN score s ON s.s1_id = c.s1_id AND s.cand_id = c.cand_id LEFT JOIN pairs x ON x.s1_id = c.s1_id AND x.cand_id = c.cand_id GROUP BY ALL",
        "per_stratum": f"{t}, s AS (SELECT country AS stratum, count(*) AS size FROM truth GROUP BY 1), f AS (SELECT *, size * least(20, sum(size) OVER ()) / sum(size) OVER () AS quota FROM s), g AS (SELECT *, row_number() OVER (ORDER BY quota - floor(quota) DESC, stratum) AS turn, sum(floor(quota)) OVER () AS given, sum(size) OVER () AS total FROM f), k AS (SELECT stratum, floor(quota) + CASE WHEN turn <= least(20, total) - given AND floor(quota) < size THEN 1 ELSE 0 END AS take FROM g), o AS (SELECT s1_id, country, n_true > 0 AS has_match, row_number() OVER (PARTITION BY country ORDER BY {key('s1', 's1_id')}, s1_id) AS place FROM truth) SELECT s1_id, country, has_match FROM o JOIN k ON k.stratum = o.country WHERE place <= take",
        "not_candidates": f"{spoilt_rows}, m AS (SELECT DISTINCT source1_entity_id AS s1_id, unnest(string_split(ids, ',')) AS cand_id FROM spoilt WHERE ids <> '') SELECT m.s1_id, m.cand_id FROM m LEFT JOIN cand c ON c.s1_id = m.s1_id AND c.cand_id = m.cand_id WHERE c.s1_id IS NULL",
        "tsv_round_trip": f"{r} SELECT entity_id, name_raw AS business_name, addr_raw AS business_address, country, source FROM raw",
        "tsv_lines": f"{r} SELECT source, count(*) AS lines, CAST(sum(length(name_raw || addr_raw) - length(replace(name_raw || addr_raw, '\"', ''))) AS BIGINT) AS quotes FROM raw GROUP BY 1",
        "truth_read": f"{t} SELECT s1_id, CAST(len(CASE WHEN ids = '' THEN [] ELSE string_split(ids, ',') END) AS BIGINT) AS n_ids, n_true > 0 AS has_match, CAST(split_part(s1_id, '-', 2) AS BIGINT) % 2 = 0 AS wanted FROM truth",
        "parquet_scan": f"{r} SELECT entity_id, name_norm, addr_norm FROM rec WHERE country = 'fr' AND source IN ('S2', 'S3') AND CAST(split_part(entity_id, '-', 2) AS BIGINT) % 3 <> 0 OR country = 'fr' AND source = 'S3'",
        "latest_metrics": "SELECT o_orderpriority AS stage, o_orderstatus AS split, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2",
        "sample_rows": f"""{t}, e AS (SELECT s1_id, concat_ws('|', country, CAST(n_true > 0 AS VARCHAR)) AS stratum FROM truth), s AS (SELECT stratum, count(*) AS size FROM e GROUP BY 1), f AS (SELECT *, size * least(20, sum(size) OVER ()) / sum(size) OVER () AS quota, sum(size) OVER () AS total FROM s),
            g AS (SELECT *, row_number() OVER (ORDER BY quota - floor(quota) DESC, stratum) AS turn, sum(floor(quota)) OVER () AS given FROM f), k AS (SELECT stratum, floor(quota) + CASE WHEN turn <= least(20, total) - given AND floor(quota) < size THEN 1 ELSE 0 END AS take FROM g),
            o AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {key('s1', 's1_id')}, s1_id) AS place FROM e), chosen AS (SELECT s1_id FROM o JOIN k USING (stratum) WHERE place <= take), matched AS (SELECT DISTINCT cand_id FROM pairs JOIN chosen USING (s1_id)),
            wanted AS (SELECT source, count(*) AS n FROM raw JOIN matched ON entity_id = cand_id GROUP BY 1), others AS (SELECT entity_id, source, row_number() OVER (PARTITION BY source ORDER BY {key('distractor', 'entity_id')}, entity_id) AS place FROM raw WHERE source <> 'S1' AND entity_id NOT IN (SELECT cand_id FROM pairs))
            SELECT s1_id AS entity_id FROM chosen UNION ALL SELECT cand_id FROM matched UNION ALL SELECT entity_id FROM others JOIN wanted USING (source) WHERE place <= 3 * n""",
        "result_files": f"{e}, m AS (SELECT t.s1_id, coalesce(string_agg(p.cand_id, ',' ORDER BY p.cand_id), '') AS ids FROM truth t LEFT JOIN (SELECT * FROM preds WHERE prob >= 0.7) p ON p.s1_id = t.s1_id GROUP BY 1), k AS (SELECT t.s1_id, coalesce(string_agg(c.cand_id, ',' ORDER BY c.cand_id), '') AS ids FROM truth t LEFT JOIN cand c ON c.s1_id = t.s1_id GROUP BY 1) SELECT m.s1_id AS source1_entity_id, m.ids AS matched_entity_ids, k.ids AS candidate_entity_ids FROM m JOIN k USING (s1_id)",
        "json_round_trip": f"{t} SELECT count(*) AS n_true_pairs, count(*) FILTER (a.country = b.country) AS n_equal, round(count(*) FILTER (a.country = b.country) / count(*), 9) AS country_equal_share FROM pairs p JOIN raw a ON a.entity_id = p.s1_id JOIN raw b ON b.entity_id = p.cand_id",
        "whole_pool": f"WITH {RECORDS.replace(chr(39) + '/(en|fr|de|es)(/|$|' + chr(92) + '?|#)' + chr(39) + ', 1) AS country', chr(39) + '/(en|fr|de|es)(/|$|' + chr(92) + '?|#)' + chr(39) + ', 1) AS own_country, ' + chr(39) * 2 + ' AS country')}, {index()} SELECT c.s1_id, c.cand_id, o.own_country AS country, round(CAST(CAST(block_score AS REAL) AS DOUBLE), 5) AS block_score FROM cand c JOIN raw o ON o.entity_id = c.s1_id",
    }
