"""SQL counterparts of the registered queries: common table expressions, put together on demand."""

from __future__ import annotations

import re

from ..functions import constants as K
from ..functions.vectors import LETTERS

_LIST = lambda xs: ", ".join(f"'{x}'" for x in xs)
_MAP = lambda m: "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in m.items()) + "}"
_RUNS = "list_filter({x}, lambda t, i: i = 1 OR t <> {x}[i - 1])"


def _skeleton(token: str) -> str:
    sounds = f"replace(replace(replace({token}, 'ph', 'f'), 'q', 'k'), 'z', 'j')"
    sounds = f"replace(replace(replace({sounds}, 'ch', '~'), 'c', 'k'), '~', 'ch')"
    for _ in range(2):
        sounds = f"regexp_replace({sounds}, 'm([cdfghjklmnqrstvwxz])', 'n\\1', 'g')"
    kept = f"translate({sounds}, '5013', 'sole')"
    kept = f"substr({kept}, 1, 1) || regexp_replace(substr({kept}, 2), '[aeiouy]', '', 'g')"
    chars = f"string_split(CASE WHEN regexp_full_match({token}, '[0-9]+') THEN {token} ELSE {kept} END, '')"
    return f"array_to_string(list_filter({chars}, lambda c, i: i = 1 OR c <> {chars}[i - 1]), '')"


def _jaccard(a: str, b: str) -> str:
    return f"(len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))))"


def _pairs(keys: str) -> str:
    return f"""SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS cand_id, b.source - 2 AS cand_source
        FROM {keys} a JOIN {keys} b ON a.key = b.key AND a.source = 1 AND b.source > 1
        JOIN (SELECT source, key FROM {keys} WHERE source > 1 GROUP BY source, key HAVING count(*) <= 50) c ON c.source = b.source AND c.key = b.key"""


def _fold(block: str, on: str, k: int, weights: str) -> str:
    return f"""SELECT *, CAST(substr(p, 2, 1) AS INTEGER) AS src FROM (SELECT q, p, block, round(score, 6) AS score, row_number() OVER (PARTITION BY q, block ORDER BY round(score, 9) DESC, p) AS rank FROM
        (SELECT a.id AS q, b.id AS p, a.block, sum(a.w * b.w) AS score FROM {weights} a JOIN {weights} b ON a.block = b.block AND a.term = b.term AND {on} GROUP BY ALL)) WHERE rank <= {k}"""


def _grams(name: str) -> str:
    text = f"lower({name} || ' ' || name_skel || ' ' || addr_norm)"
    return f"""SELECT country || '/' || pool AS block, id, source, term, count(*) AS tf FROM (SELECT country, entity_id AS id, source, unnest(CASE WHEN source = 1 THEN [2, 3] ELSE [source] END) AS pool,
        flatten(list_transform(list_filter(regexp_split_to_array({text}, '\\s+'), lambda w: w <> ''), lambda w: list_transform(generate_series(1, length(w)), lambda i: substr(' ' || w || ' ', i, 3)))) AS terms FROM {{table}}), unnest(terms) AS u(term) GROUP BY ALL"""


def _weights(grams: str) -> str:
    return f"""SELECT block, id, source, term, w / sqrt(sum(w * w) OVER (PARTITION BY block, id)) AS w FROM (SELECT g.*, (1 + ln(tf)) * (ln((1 + n.n) / (1 + v.df)) + 1) AS w FROM {grams} g
        JOIN (SELECT block, term, count(*) AS df FROM {grams} GROUP BY ALL) v USING (block, term) JOIN (SELECT block, count(DISTINCT id) AS n FROM {grams} GROUP BY ALL) n USING (block))"""


_LETTERS = ", ".join(f"'{c}'" for c in LETTERS)
_UNIT = "list_transform({x}, lambda y: y / greatest(sqrt(list_inner_product({x}, {x})), 1e-6))"
_COUNT = "list_transform([{letters}], lambda c: CAST(length({t}) - length(replace({t}, c, '')) AS DOUBLE))"


def _dense(column: str, on: str, by: str, k: int) -> str:
    return f"""SELECT * FROM (SELECT a.entity_id AS q, b.entity_id AS p, b.source AS src, round(list_inner_product(a.{column}, b.{column}), 6) AS score,
        row_number() OVER (PARTITION BY {by} ORDER BY round(list_inner_product(a.{column}, b.{column}), 9) DESC, b.entity_id) AS rank FROM w_vec a JOIN w_vec b ON a.country = b.country AND {on}) WHERE rank <= {k}"""


_FIVE = ["ch_emb", "ch_addr", "ch_skel", "ch_rare", "ch_rev"]
_MORE = ["ch_rerank", "ch_k1", "ch_k3", "ch_k5", "ch_comb"]
_TOKENS = "SELECT DISTINCT entity_id, country, token FROM (SELECT entity_id, country, unnest(list_filter(addr_tokens, lambda x: regexp_full_match(x, '[0-9]+') OR regexp_full_match(x, '[a-z]{4,}'))) AS token FROM norm)"


def _flagged(name: str, names: list[str], source: str) -> str:
    return f"SELECT s1_id, cand_id, {', '.join(f'{int(n == name)} AS {n}' for n in names)} FROM ({source})"


def _keyed(keys: str) -> str:
    return f"""SELECT s1_id, cand_id FROM (SELECT k.*, row_number() OVER (PARTITION BY k.s1_id, k.cand_source ORDER BY round(list_inner_product(a.v, b.v), 6) DESC, k.cand_id) AS rn FROM ({_pairs(keys)}) k
        JOIN w_vec a ON a.entity_id = k.s1_id JOIN w_vec b ON b.entity_id = k.cand_id WHERE NOT EXISTS (SELECT 1 FROM w_base x WHERE x.s1_id = k.s1_id AND x.cand_id = k.cand_id)) WHERE rn <= 10"""


def _added(before: str, found: str, order: str, code: int) -> str:
    return f"""SELECT s1_id, cand_id, added_by FROM {before} UNION ALL SELECT s1_id, cand_id, {code} FROM (SELECT f.*, row_number() OVER (PARTITION BY s1_id ORDER BY {order}, cand_id) AS rn FROM {found} f
        WHERE NOT EXISTS (SELECT 1 FROM {before} x WHERE x.s1_id = f.s1_id AND x.cand_id = f.cand_id)) WHERE rn <= 10"""


#: All channels, by larger countries.
WIDENED = {
    "w_vec": f"""SELECT entity_id, source, country, {_UNIT.format(x='n')} AS v, {_UNIT.format(x='c')} AS vc FROM (SELECT entity_id, source, country, {_COUNT.format(letters=_LETTERS, t='name_full')} AS n, {_COUNT.format(letters=_LETTERS, t="(name_full || ' | ' || addr_norm)")} AS c FROM norm)""",
    "w_a": _dense("v", "a.source = 1 AND b.source > 1", "a.entity_id, b.source", 200),
    "w_d": _dense("v", "a.source > 1 AND b.source = 1", "a.entity_id", 3),
    "w_h": _dense("vc", "a.source = 1 AND b.source > 1", "a.entity_id, b.source", 20),
    "w_five": " UNION ALL ".join(_flagged(n, _FIVE, f"SELECT s1_id, cand_id FROM ({x})") for n, x in (("ch_emb", "SELECT q AS s1_id, p AS cand_id FROM w_a WHERE rank <= 20"), ("ch_addr", _pairs("k_addr")), ("ch_skel", _pairs("k_skel")), ("ch_rare", _pairs("k_rare")), ("ch_rev", "SELECT p AS s1_id, q AS cand_id FROM w_d"))),
    "w_base": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY greatest(ch_addr, ch_skel, ch_rare) DESC, emb_score DESC, cand_id) AS rn FROM
        (SELECT f.s1_id, f.cand_id, {', '.join(f'max({c}) AS {c}' for c in _FIVE)}, any_value(round(list_inner_product(a.v, b.v), 6)) AS emb_score, coalesce(any_value(r.rank), 999) AS emb_rank FROM w_five f JOIN w_vec a ON a.entity_id = f.s1_id JOIN w_vec b ON b.entity_id = f.cand_id
          LEFT JOIN (SELECT * FROM w_a WHERE rank <= 20) r ON r.q = f.s1_id AND r.p = f.cand_id GROUP BY f.s1_id, f.cand_id)) WHERE rn <= 40""",
    "w_tok": _TOKENS,
    "w_idf": "SELECT x.country, x.token, ln(1 + (any_value(n) + 1) / (count(*) + 1)) AS idf FROM w_tok x JOIN (SELECT country, count(DISTINCT entity_id) AS n FROM w_tok GROUP BY country) c ON c.country = x.country GROUP BY x.country, x.token",
    "w_f": """SELECT s1_id, cand_id, f_score FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, src ORDER BY f_score DESC, score DESC, cand_id) AS rn FROM
        (SELECT w.q AS s1_id, w.p AS cand_id, any_value(w.src) AS src, any_value(w.score) AS score, coalesce(round(sum(i.idf), 6), 0) AS f_score FROM w_a w JOIN w_vec v ON v.entity_id = w.q LEFT JOIN (SELECT a.entity_id AS q, b.entity_id AS p, a.country, a.token FROM w_tok a JOIN w_tok b ON a.country = b.country AND a.token = b.token) t ON t.q = w.q AND t.p = w.p
          LEFT JOIN w_idf i ON i.country = t.country AND i.token = t.token WHERE NOT EXISTS (SELECT 1 FROM w_base x WHERE x.s1_id = w.q AND x.cand_id = w.p) GROUP BY w.q, w.p)) WHERE rn <= 10""",
    "w_fgh": " UNION ALL ".join(
        f"SELECT *, {fs} AS f_score FROM ({_flagged(n, _MORE, x)})" if n != "ch_rerank" else f"SELECT s1_id, cand_id, {', '.join(str(int(m == n)) + ' AS ' + m for m in _MORE)}, f_score FROM w_f"
        for n, x, fs in (("ch_rerank", "", ""), ("ch_k1", _keyed("k_k1"), 0), ("ch_k3", _keyed("k_k3"), 0), ("ch_k5", _keyed("k_k5"), 0), ("ch_comb", "SELECT q AS s1_id, p AS cand_id FROM w_h", 0))
    ),
    "w_new": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY {' + '.join(_MORE)} DESC, ch_comb DESC, f_score DESC, emb_score DESC, cand_id) AS rn FROM
        (SELECT f.s1_id, f.cand_id, {', '.join(f'max({c}) AS {c}' for c in _MORE)}, max(f_score) AS f_score, any_value(round(list_inner_product(a.v, b.v), 6)) AS emb_score FROM w_fgh f JOIN w_vec a ON a.entity_id = f.s1_id JOIN w_vec b ON b.entity_id = f.cand_id
          WHERE NOT EXISTS (SELECT 1 FROM w_base x WHERE x.s1_id = f.s1_id AND x.cand_id = f.cand_id) GROUP BY f.s1_id, f.cand_id)) WHERE rn <= 30""",
    "w_t1": "SELECT s1_id, cand_id, 0 AS added_by FROM w_base UNION ALL SELECT s1_id, cand_id, 1 FROM w_new",
    "w_g": _grams("name_full").format(table="norm"),
    "w_w": _weights("w_g"),
    "w_i": f"SELECT q AS s1_id, p AS cand_id, score, rank FROM ({_fold('block', 'a.source = 1 AND b.source > 1', 10, 'w_w')})",
    "w_j": f"SELECT p AS s1_id, q AS cand_id, score, rank FROM ({_fold('block', 'a.source > 1 AND b.source = 1', 5, 'w_w')})",
    "w_learn": """SELECT src, dst FROM (SELECT src, dst, n, n / sum(n) OVER (PARTITION BY src) AS share, row_number() OVER (PARTITION BY src ORDER BY n DESC, dst) AS rn FROM
        (SELECT s[i] AS src, t[i] AS dst, count(*) AS n FROM (SELECT s, t, unnest(generate_series(1, len(s))) AS i FROM (SELECT list_filter(y, lambda w: NOT list_contains(x, w)) AS s, list_filter(x, lambda w: NOT list_contains(y, w)) AS t FROM
          (SELECT a.full_t AS x, b.full_t AS y FROM norm a JOIN norm b ON a.country = b.country AND a.addr_tokens[1] = b.addr_tokens[1] AND a.addr_tokens[3] = b.addr_tokens[3] AND a.source = 1 AND b.source > 1))
          WHERE len(s) = len(t) AND len(s) BETWEEN 1 AND 4) GROUP BY ALL)) WHERE rn = 1 AND n >= 1 AND share >= 0.1""",
    "w_map": "SELECT n.* EXCLUDE (name_full), CASE WHEN n.source = 1 THEN n.name_full ELSE m.mapped END AS name_full FROM norm n LEFT JOIN (SELECT entity_id, string_agg(coalesce(l.dst, w.t), ' ' ORDER BY w.i) AS mapped FROM (SELECT entity_id, unnest(full_t) AS t, generate_subscripts(full_t, 1) AS i FROM norm WHERE source > 1) w LEFT JOIN w_learn l ON l.src = w.t GROUP BY entity_id) m ON m.entity_id = n.entity_id",
    "w_gk": _grams("name_full").format(table="w_map"),
    "w_wk": _weights("w_gk"),
    "w_k": f"SELECT q AS s1_id, p AS cand_id, score, rank FROM ({_fold('block', 'a.source = 1 AND b.source > 1', 10, 'w_wk')})",
    "w_t2": _added("w_t1", "w_i", "rank, score DESC", 2),
    "w_t3": _added("w_t2", "w_j", "score DESC", 3),
    "w_t4": _added("w_t3", "w_k", "rank, score DESC", 4),
    "w_all": f"""SELECT t.s1_id, t.cand_id, CAST(substr(t.cand_id, 2, 1) AS INTEGER) - 2 AS cand_source, round(list_inner_product(a.v, b.v), 6) AS emb_score, coalesce(x.emb_rank, 999) AS emb_rank,
        {', '.join(f'coalesce(x.{c}, 0) AS {c}' for c in _FIVE)}, {', '.join(f'coalesce(n.{c}, 0) AS {c}' for c in _MORE)}, t.added_by, a.country,
        {', '.join(f'CASE WHEN {q}.s1_id IS NULL THEN 0 ELSE 1 END AS {f}, coalesce({q}.rank, 99) AS {r}_rank, coalesce({q}.score, 0) AS {r}_score' for q, f, r in (('i', 'ch_tfidf', 'tfidf'), ('j', 'ch_revtf', 'revtf'), ('k', 'ch_dict', 'dict')))},
        round(list_inner_product(a.vc, b.vc), 6) AS comb_cos FROM w_t4 t JOIN w_vec a ON a.entity_id = t.s1_id JOIN w_vec b ON b.entity_id = t.cand_id LEFT JOIN w_base x ON x.s1_id = t.s1_id AND x.cand_id = t.cand_id LEFT JOIN w_new n ON n.s1_id = t.s1_id AND n.cand_id = t.cand_id
        LEFT JOIN w_i i ON i.s1_id = t.s1_id AND i.cand_id = t.cand_id LEFT JOIN w_j j ON j.s1_id = t.s1_id AND j.cand_id = t.cand_id LEFT JOIN w_k k ON k.s1_id = t.s1_id AND k.cand_id = t.cand_id""",
}

CTES = {
    "rec": """SELECT 'S' || (1 + p_partkey % 3) || '-' || p_partkey AS entity_id, CAST(1 + p_partkey % 3 AS INTEGER) AS source, p_type AS country, p_name AS raw_name,
        p_size || ' ' || replace(p_brand, '#', ' ') || ' Street ' || CAST(floor(p_retailprice) AS INTEGER) AS raw_address FROM part""",
    "cut": rf"""SELECT *, list_transform(list_filter(regexp_split_to_array(regexp_replace(lower(raw_name), '[^a-z0-9_\s]', ' ', 'g'), '\s+'), lambda t: t <> ''), lambda t: coalesce({_MAP(K.NAME_ABBREVIATIONS)}[t], t)) AS n0,
        list_transform(list_filter(regexp_split_to_array(regexp_replace(lower(raw_address), '[^a-z0-9_\s]', ' ', 'g'), '\s+'), lambda t: t <> ''), lambda t: CASE WHEN regexp_full_match(t, '[0-9]+') THEN regexp_replace(t, '^0+([0-9])', '\1') ELSE coalesce({_MAP(K.ADDRESS_ABBREVIATIONS)}[t], t) END) AS a0 FROM rec""",
    "parts": f"""SELECT *, list_filter({_RUNS.format(x="n0")}, lambda t: t NOT IN ({_LIST(K.LEGAL_SUFFIXES)})) AS full_t, list_filter({_RUNS.format(x="n0")}, lambda t: t IN ({_LIST(K.LEGAL_SUFFIXES)})) AS legal_t,
        list_filter(a0, lambda t: t NOT IN ({_LIST(K.UNIT_TOKENS)})) AS addr_tokens FROM cut""",
    "strong": f"""SELECT *, CASE WHEN len(list_filter(full_t, lambda t: t NOT IN ({_LIST(K.WEAK_TOKENS)}))) > 0 THEN list_filter(full_t, lambda t: t NOT IN ({_LIST(K.WEAK_TOKENS)})) ELSE full_t END AS core_t FROM parts""",
    "nrm": rf"""SELECT entity_id, source, country, raw_name, raw_address, array_to_string(full_t, ' ') AS name_full, array_to_string(core_t, ' ') AS core_name, array_to_string(legal_t, ' ') AS legal,
        array_to_string(list_sort(core_t), ' ') AS core_sorted, array_to_string(list_transform(core_t, lambda w: {_skeleton("w")}), ' ') AS name_skel, full_t, addr_tokens, array_to_string(addr_tokens, ' ') AS addr_norm,
        list_filter(flatten(list_transform(addr_tokens, lambda t: list_transform(regexp_extract_all(t, '([0-9]+)', 1), lambda d: regexp_replace(d, '^0+([0-9])', '\1')))), lambda x: x <> '') AS nums0,
        coalesce(regexp_replace(regexp_replace(list_filter(regexp_split_to_array(lower(raw_address), '\s+'), lambda t: regexp_matches(t, '[0-9]'))[1], '[^0-9]', '', 'g'), '^0+([0-9])', '\1'), '') AS house_no,
        coalesce(list_filter(regexp_split_to_array(regexp_replace(lower(raw_address), '[^a-z0-9_\s]', ' ', 'g'), '\s+'), lambda t: regexp_full_match(t, '[0-9]{{5,6}}'))[-1], '') AS zip_pin FROM strong""",
    "norm": """SELECT *, list_filter(nums0, lambda x, i: list_position(nums0, x) = i) AS num_tokens,
        list_filter(list_transform(addr_tokens, lambda t, i: CASE WHEN regexp_full_match(t, '[0-9]+') AND regexp_full_match(coalesce(addr_tokens[i + 1], ''), '[a-z]{3,}') THEN regexp_replace(t, '^0+([0-9])', '\\1') || '_' || addr_tokens[i + 1] END), lambda x: x IS NOT NULL)[1:3] AS house_cands FROM nrm""",
    "freq": "SELECT country, token, count(*) AS doc_freq FROM (SELECT country, unnest(list_distinct(list_filter(addr_tokens, lambda t: length(t) >= 5))) AS token FROM norm) GROUP BY country, token",
    "rare": "SELECT entity_id, source, country, token, row_number() OVER (PARTITION BY entity_id ORDER BY doc_freq, token) AS rk FROM (SELECT entity_id, source, country, unnest(list_distinct(list_filter(addr_tokens, lambda t: length(t) >= 5))) AS token FROM norm) JOIN freq USING (country, token)",
    "k_addr": "SELECT DISTINCT entity_id, source, 'H_' || country || '_' || h AS key FROM (SELECT entity_id, source, country, unnest(house_cands) AS h FROM norm) UNION SELECT DISTINCT entity_id, source, 'Z_' || country || '_' || zip_pin || '_' || n FROM (SELECT entity_id, source, country, zip_pin, unnest(num_tokens) AS n FROM norm WHERE zip_pin <> '')",
    "k_skel": "SELECT entity_id, source, 'SK_' || country || '_' || array_to_string(list_sort(string_split(name_skel, ' ')), ' ') AS key FROM norm WHERE name_skel <> ''",
    "k_rare": "SELECT entity_id, source, 'E1_' || country || '_' || token AS key FROM rare WHERE rk = 1 UNION SELECT entity_id, source, 'E2_' || country || '_' || string_agg(token, '_' ORDER BY token) FROM rare WHERE rk <= 2 GROUP BY entity_id, source, country HAVING count(*) = 2",
    "k_k1": "SELECT DISTINCT entity_id, source, 'K1_' || country || '_' || n[i] || '_' || n[i + 1] AS key FROM (SELECT *, unnest(generate_series(1, len(n) - 1)) AS i FROM (SELECT entity_id, source, country, list_filter(num_tokens, lambda t: length(t) >= 2) AS n FROM norm))",
    "k_k2": "SELECT entity_id, source, 'K2_' || country || '_' || zip_pin || '_' || list_filter(addr_tokens, lambda t: regexp_full_match(t, '[a-z]{4,}'))[1] AS key FROM norm WHERE zip_pin <> ''",
    "k_k3": "SELECT entity_id, source, 'K3_' || country || '_' || array_to_string(list_sort(num_tokens), '_') AS key FROM norm WHERE len(num_tokens) > 0",
    "k_k4": "SELECT entity_id, source, 'K4_' || country || '_' || s[1] || '_' || s[2] AS key FROM (SELECT *, list_sort(string_split(name_skel, ' ')) AS s FROM norm WHERE name_skel <> '') WHERE len(s) > 1",
    "alpha": "SELECT entity_id, source, country, token, row_number() OVER (PARTITION BY entity_id ORDER BY doc_freq, token) AS rk FROM (SELECT entity_id, source, country, unnest(list_distinct(list_filter(addr_tokens, lambda t: regexp_full_match(t, '[a-z]{5,}')))) AS token FROM norm) JOIN freq USING (country, token)",
    "k_k5": "SELECT DISTINCT n.entity_id, n.source, 'K5_' || n.country || '_' || n.num || '_' || a.token AS key FROM (SELECT entity_id, source, country, unnest(list_filter(num_tokens, lambda t: length(t) >= 3)) AS num FROM norm) n JOIN alpha a ON a.entity_id = n.entity_id AND a.rk = 1",
    "gold": "SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, b.source - 2 AS cand_source, a.country FROM norm a JOIN norm b ON a.country = b.country AND a.name_full = b.name_full AND a.house_no = b.house_no AND a.source = 1 AND b.source > 1",
    "s1": "SELECT entity_id AS s1_id, country FROM rec WHERE source = 1",
    "scored0": f"SELECT p.*, round({_jaccard('list_concat(a.full_t, a.addr_tokens)', 'list_concat(b.full_t, b.addr_tokens)')}, 6) AS emb_score FROM (SELECT s1_id, cand_id, cand_source, max(ch_addr) AS ch_addr, max(ch_skel) AS ch_skel, max(ch_rare) AS ch_rare, max(ch_k3) AS ch_k3 FROM chan GROUP BY s1_id, cand_id, cand_source) p JOIN norm a ON a.entity_id = p.s1_id JOIN norm b ON b.entity_id = p.cand_id",
    "chan": f"SELECT *, 1 AS ch_addr, 0 AS ch_skel, 0 AS ch_rare, 0 AS ch_k3 FROM ({_pairs('k_addr')}) UNION ALL SELECT *, 0, 1, 0, 0 FROM ({_pairs('k_skel')}) UNION ALL SELECT *, 0, 0, 1, 0 FROM ({_pairs('k_rare')}) UNION ALL SELECT *, 0, 0, 0, 1 FROM ({_pairs('k_k3')})",
    "cand": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY greatest(ch_addr, ch_k3) DESC, emb_score DESC, cand_id) AS rn FROM scored0) WHERE rn <= 40",
    "sets": f"""SELECT c.*, a.country, round({_jaccard('a.full_t', 'b.full_t')}, 6) AS name_jaccard, round({_jaccard('a.num_tokens', 'b.num_tokens')}, 6) AS num_jaccard, abs(length(a.core_name) - length(b.core_name)) AS len_diff,
        round({_jaccard('a.addr_tokens', 'b.addr_tokens')}, 6) AS addr_jaccard, CASE WHEN a.house_no = '' OR b.house_no = '' THEN -1 WHEN a.house_no = b.house_no THEN 1 ELSE 0 END AS house_match
        FROM cand c JOIN norm a ON a.entity_id = c.s1_id JOIN norm b ON b.entity_id = c.cand_id""",
    "prob": "SELECT s1_id, cand_id, cand_source, country, emb_score, round((50 * name_jaccard + 30 * addr_jaccard + CASE WHEN house_match = 1 THEN 20 ELSE 0 END) / 100, 6) AS prob FROM sets",
    "excl": "SELECT * EXCLUDE (rn, nxt) FROM (SELECT *, row_number() OVER w AS rn, lead(prob) OVER w AS nxt FROM prob WINDOW w AS (PARTITION BY cand_id ORDER BY prob DESC, emb_score DESC, s1_id)) WHERE rn = 1",
    "excl_m": "SELECT * EXCLUDE (rn, nxt) FROM (SELECT *, row_number() OVER w AS rn, lead(prob) OVER w AS nxt FROM prob WINDOW w AS (PARTITION BY cand_id ORDER BY prob DESC, emb_score DESC, s1_id)) WHERE rn = 1 AND (nxt IS NULL OR prob - nxt >= 0.05)",
    "kept": "SELECT * EXCLUDE (rn, top) FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, emb_score DESC, cand_id) AS rn, max(prob) OVER (PARTITION BY s1_id) AS top FROM excl) WHERE top >= 0.5 AND (rn = 1 OR prob >= 0.8)",
    "tally": "SELECT s1.s1_id, s1.country, coalesce(x.tp, 0) AS tp, coalesce(x.n_pred, 0) AS n_pred, coalesce(x.n_gold, 0) AS n_gold FROM s1 LEFT JOIN (SELECT coalesce(k.s1_id, g.s1_id) AS s1_id, count(CASE WHEN k.s1_id IS NOT NULL AND g.s1_id IS NOT NULL THEN 1 END) AS tp, count(k.s1_id) AS n_pred, count(g.s1_id) AS n_gold FROM kept k FULL JOIN gold g ON k.s1_id = g.s1_id AND k.cand_id = g.cand_id GROUP BY 1) x ON x.s1_id = s1.s1_id",
    "scores": "SELECT *, round(CASE WHEN n_pred = 0 AND n_gold = 0 THEN 1.0 WHEN n_pred = 0 OR n_gold = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_gold) / (0.25 * (tp / n_pred) + tp / n_gold) END, 6) AS f05 FROM tally",
    "vec": "SELECT vec_id AS id, CAST(vec_id % 3 AS INTEGER) AS source, CAST(label AS VARCHAR) AS country, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
    "grams": r"SELECT country, entity_id AS id, source, term, count(*) AS tf FROM (SELECT country, entity_id, source, unnest(flatten(list_transform(list_filter(regexp_split_to_array(lower(name_full || ' ' || name_skel), '\s+'), lambda w: w <> ''), lambda w: list_transform(generate_series(1, length(w)), lambda i: substr(' ' || w || ' ', i, 3))))) AS term FROM norm) GROUP BY ALL",
    "vocab": "SELECT * FROM (SELECT g.country, term, sum(tf) AS total, count(*) AS df, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf FROM grams g JOIN (SELECT country, count(*) AS n FROM norm GROUP BY country) USING (country) GROUP BY g.country, term)",
    "wts": "SELECT country, id, source, term, w / sqrt(sum(w * w) OVER (PARTITION BY country, id)) AS w FROM (SELECT g.*, (1 + ln(tf)) * idf AS w FROM grams g JOIN vocab USING (country, term))",
}

CTES |= WIDENED


def statement(select: str, market: bool = False) -> str:
    """The query with the expressions that it needs, directly or through others, in their order."""
    made = _statement(select)
    return made.replace("p_type AS country", "p_brand AS country") if market else made


def _statement(select: str) -> str:
    names: list[str] = []

    def need(text: str) -> None:
        for name in CTES:
            if name not in names and re.search(rf"\b(?:FROM|JOIN) {name}\b", text):
                names.append(name)
                need(CTES[name])

    need(select)
    if not names:
        return select
    done: list[str] = []

    def put(name: str) -> None:
        for other in CTES:
            if other != name and other not in done and re.search(rf"\b(?:FROM|JOIN) {other}\b", CTES[name]):
                put(other)
        if name not in done:
            done.append(name)

    for name in names:
        put(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in done) + "\n" + select


pairs, jaccard, skeleton = _pairs, _jaccard, _skeleton


def unit(x: str) -> str:
    return _UNIT.format(x=x)


def letter_counts(text: str) -> str:
    return _COUNT.format(letters=_LETTERS, t=text)
