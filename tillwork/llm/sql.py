"""DuckDB SQL that must give the same rows as the queries, where SQL can express them."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 1], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(d, r) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.d, sym.b FROM reach JOIN sym ON sym.a = reach.r)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r) AS component_id, min(r) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.d = w.doc_id GROUP BY w.doc_id, n.n"""

OP8 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
windows AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS t
            FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
found AS (SELECT p.doc_id, p.i, p.n, x.item FROM places p
          JOIN windows x ON x.n = p.n AND x.t = array_to_string(p.w[p.i : p.i + p.n - 1], ' ')),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP10 = f"""
WITH p AS (SELECT page_id, url, coalesce({LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, start, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
SELECT page_id, host, path, h || start AS rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, start)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || start) DESC) = 1"""

def _framed(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_framed, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# crc32, bit by bit, of the decimal digits of doc_id
CRC32 = """xor(list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda i: (ascii(c) >> i) & 1))),
    lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295)"""


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves`` (g, pos, n, digest), and the siblings of each that has a parent."""
    return f"""{name}(level, g, pos, n, digest) AS (SELECT 0, g, pos, n, digest FROM {leaves}
    UNION ALL SELECT level + 1, g, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY level, g, pos // 8, n),
{name}_siblings AS (SELECT level, g, pos,
      coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY level, g, pos // 8 ORDER BY pos))"""


OP11 = f"""
WITH RECURSIVE hashed AS (SELECT doc_id, coalesce('1' || lang, '0') AS g, {_leaf("text")} AS leaf,
    CASE WHEN {CRC32} % 3 = 0 THEN {_leaf(LOWER.format("text"))} END AS altered FROM documents),
leaves AS MATERIALIZED (SELECT *, leaf AS digest, row_number() OVER () AS id, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY g) AS n FROM hashed),
{_tree("lower_tree", "leaves")},
subroots AS (SELECT '' AS g, g AS name, digest, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM lower_tree WHERE n = 1),
{_tree("upper_tree", "subroots")},
up AS (SELECT id, 0 AS level, g, pos, coalesce(altered, leaf) AS node, '' AS proof FROM leaves),
climb AS (SELECT * FROM up UNION ALL
    SELECT id, c.level + 1, g, pos // 8, sha256(l || node || r), proof || l || r FROM climb c JOIN lower_tree_siblings USING (level, g, pos)),
ends AS (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY id ORDER BY level DESC) = 1),
over_groups AS (SELECT id, 0 AS level, '' AS g, s.pos, node, proof FROM ends e JOIN subroots s ON s.name = e.g),
climb_over AS (SELECT * FROM over_groups UNION ALL
    SELECT id, c.level + 1, g, pos // 8, sha256(l || node || r), proof || l || r FROM climb_over c JOIN upper_tree_siblings USING (level, g, pos)),
done AS (SELECT * FROM climb_over QUALIFY row_number() OVER (PARTITION BY id ORDER BY level DESC) = 1),
root AS (SELECT digest AS root FROM upper_tree WHERE n = 1)
SELECT l.doc_id, l.leaf, s.digest AS subroot, root, sha256(proof) AS proof_sha256, done.node AS folded_root, done.node = root AS verified
FROM leaves l JOIN done USING (id) JOIN subroots s ON s.name = l.g, root"""


def _shown(column: str) -> str:
    """Characters of an escaped text: each backslash and each control string takes one more."""
    control = r"([<\[])(<SYS>>|</SYS>>|/?INST\]|/?s>|/?ROLE\]|ROLE/\]|END\])"
    return rf"length(regexp_replace(replace({column}, '\', '\\'), '{control}', '\1\\\2', 'g'))"


OP12 = f"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, role)),
c AS (SELECT conv_id, count(*) AS n_turns, sum({_shown("text")} + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    ELSE coalesce(18 + {_shown("role")}, 12) END)::BIGINT AS formatted_chars,
  string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM c"""

ORACLES = {
    "op1_near_duplicates": OP1,
    "op8_benchmark_hits": OP8,
    "op10_url_rules": OP10,
    "op11_merkle_manifest": OP11,
    "op12_chat_examples": OP12,
}

