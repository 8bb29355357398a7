"""DuckDB SQL of the queries whose text is long."""

#: crc32 of a decimal text, bit by bit; the reflected polynomial 0xEDB88320 is the usual one.
CRC32 = """xor(4294967295, list_reduce([4294967295] || [ascii(c)::BIGINT for c in string_split({0}, '')],
    lambda crc, byte: list_reduce([xor(crc, byte)] || range(8), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""
UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(({x})::VARCHAR) || ':' || ({x})::VARCHAR END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _tree(name: str, leaves: str) -> str:
    return f"""{name}(lvl, tree, idx, digest, n) AS (
    SELECT 0, tree, idx, digest, count(*) OVER (PARTITION BY tree) FROM {leaves}
    UNION ALL SELECT lvl + 1, tree, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 7) // 8) FROM {name} WHERE n > 1 GROUP BY lvl, tree, idx // 8)"""


def _steps(name: str, nodes: str) -> str:
    """For each lowest node and level on its way up: the siblings before and after."""
    return f"""{name} AS (SELECT l.tree, l.idx, o.lvl, coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (WHERE s.idx < o.idx), '') AS before,
        coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (WHERE s.idx > o.idx), '') AS after
    FROM {nodes} l JOIN {nodes} o ON o.tree = l.tree AND o.n > 1 AND o.idx = l.idx // (8 ** o.lvl)::BIGINT
    LEFT JOIN {nodes} s ON s.tree = o.tree AND s.lvl = o.lvl AND s.idx // 8 = o.idx // 8 AND s.idx <> o.idx
    WHERE l.lvl = 0 GROUP BY l.tree, l.idx, o.lvl)"""


OP13_SQL = f"""
WITH RECURSIVE rows AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("text")} AS digest,
    CASE WHEN {CRC32.format("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(f"translate(text, {UPPER_LOWER})")} END AS tampered FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx FROM rows),
{_tree("nodes", "leaves")},
langs AS (SELECT '' AS tree, tree AS lang_tree, row_number() OVER (ORDER BY tree) - 1 AS idx, digest FROM nodes WHERE n = 1),
{_tree("tops", "langs")},
{_steps("low", "nodes")},
{_steps("high", "tops")},
way AS (SELECT tree, idx, lvl, before, after FROM low
    UNION ALL SELECT l.tree, l.idx, 1000 + h.lvl, h.before, h.after FROM leaves l JOIN langs g ON g.lang_tree = l.tree JOIN high h ON h.idx = g.idx),
proofs AS (SELECT tree, idx, string_agg(before || after, '' ORDER BY lvl) AS proof, list(before || '|' || after ORDER BY lvl) AS steps FROM way GROUP BY tree, idx),
folded AS (SELECT l.*, proof, list_reduce([coalesce(tampered, digest)] || coalesce(steps, []), lambda acc, s: sha256(split_part(s, '|', 1) || acc || split_part(s, '|', 2))) AS folded_root
    FROM leaves l LEFT JOIN proofs USING (tree, idx))
SELECT doc_id, f.digest AS leaf, g.digest AS subroot, t.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = t.digest AS verified
FROM folded f JOIN langs g ON g.lang_tree = f.tree CROSS JOIN (SELECT digest FROM tops WHERE n = 1) t
"""

OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (SELECT d, lang, source, unnest(regexp_extract_all(translate(text, {UPPER_LOWER}), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
sets AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT lang, source, coalesce(v, 0) AS v, coalesce(t, 0) + 2 * coalesce(v, 0) AS total FROM (SELECT DISTINCT lang, source FROM docs)
    LEFT JOIN sets USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS t FROM counts GROUP BY lang, source) USING (lang, source)),
shares AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // total::HUGEINT AS p
    FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
whole AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v)::HUGEINT AS q
    FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term) JOIN sets USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY a.lang, a.source, b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM terms) WHERE rank <= 10
"""

OP12_SQL = """
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
good AS (SELECT r, vec_id, label, v FROM rows WHERE label IS NOT NULL AND v IS NOT NULL
    AND len([1 for x in v if x IS NULL OR NOT isfinite(x)]) = 0 AND len([1 for x in v if x <> 0]) > 0),
links AS (SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT r, r FROM rows UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT rows.vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, rows.vec_id IS NOT DISTINCT FROM c AS kept
FROM rows LEFT JOIN (SELECT a AS r, count(*) AS n FROM links GROUP BY a) USING (r)
JOIN (SELECT reach.a AS r, min(o.vec_id) AS c FROM reach JOIN rows o ON o.r = reach.b GROUP BY reach.a) USING (r)
"""
