"""DuckDB SQL that the queries have to agree with, where SQL can express them."""

# Words, lines and 5-word windows are taken apart into rows and counted.
OP10 = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT k, i, [ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4]] AS win
      FROM (SELECT k, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
r AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS c FROM g) WHERE c > 1),
n AS (SELECT k, sum(least(5, i - prev)) AS n_repeat_words
      FROM (SELECT k, i, coalesce(lag(i) OVER (PARTITION BY k ORDER BY i), -5) AS prev FROM r) GROUP BY k),
l AS (SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
m AS (SELECT w.doc_id, len(ws) AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
             coalesce(l.n_dup_lines, 0) AS n_dup_lines, coalesce(l.n_lines, 0) AS n_lines,
             coalesce(n.n_repeat_words, 0) AS n_repeat_words,
             len(regexp_extract_all(t, '[^\x20\x09-\x0D]*([\p{Ll}]|[^\P{Lo}\x{AA}\x{BA}])[^\x20\x09-\x0D]*')) AS n_lowered,
             length(regexp_replace(t, '[^\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}\x{3000}-\x{303F}\x{FF00}-\x{FFEF}]+', '', 'g')) AS n_unspaced
      FROM w LEFT JOIN l ON l.k = w.k LEFT JOIN n ON n.k = w.k)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 40 * n_words
            OR 100 * n_dup_lines > 40 * n_lines OR word_chars < 2 * n_words
            OR (word_chars > 20 * n_words AND word_chars - n_unspaced > 20 * n_words)
            OR 100 * n_lowered < 50 * n_words) AS kept
FROM m
"""

# The longest of the four rules that fits, written out; no two of them that fit one url are equally long.
OP8 = r"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


def crc32(number: str) -> str:
    """SQL for the unsigned CRC-32 of a number's decimal text: eight steps for each byte, the first takes it in."""
    text = f"CAST({number} AS VARCHAR)"
    steps = f"flatten([[CAST(ascii({text}[i]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] FOR i IN range(1, len({text}) + 1)])"
    step = "lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {steps}), {step}), 4294967295)"


_LEAF = """sha256(concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'),
    coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-'), coalesce(strlen({t}) || ':' || {t}, '-')))"""

# Trees level by level; a row's siblings are those of its number's run; folding follows the steps of a row's way.
OP11 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, doc_id, source,
    {_LEAF.format(t="text")} AS leaf,
    CASE WHEN {crc32("doc_id")} % 2 = 0 THEN {_LEAF.format(t="replace(text, chr(10), '')")}
         ELSE {_LEAF.format(t="text")} END AS found FROM documents),
n AS (SELECT *, coalesce('v' || source, 'n') AS tree,
      row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
lv AS (SELECT 0 AS l, tree, i, leaf AS h FROM n UNION ALL
       SELECT l + 1, tree, i // 3, sha256(string_agg(h, '' ORDER BY i))
       FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM lv) WHERE c > 1 GROUP BY l, tree, i // 3),
sub AS (SELECT tree, h AS subroot, l AS top, row_number() OVER (ORDER BY encode(tree)) - 1 AS j
        FROM (SELECT *, max(l) OVER (PARTITION BY tree) AS m FROM lv) WHERE l = m),
uv AS (SELECT 0 AS l, j AS i, subroot AS h FROM sub UNION ALL
       SELECT l + 1, i // 3, sha256(string_agg(h, '' ORDER BY i))
       FROM (SELECT *, count(*) OVER () AS c FROM uv) WHERE c > 1 GROUP BY l, i // 3),
rt AS (SELECT h AS root, l AS top FROM uv ORDER BY l DESC LIMIT 1),
own AS (SELECT n.k, lv.l AS step, coalesce(string_agg(lv.h, '' ORDER BY lv.i) FILTER (lv.i < n.i // CAST(3 ** lv.l AS BIGINT)), '') AS b,
               coalesce(string_agg(lv.h, '' ORDER BY lv.i) FILTER (lv.i > n.i // CAST(3 ** lv.l AS BIGINT)), '') AS a
        FROM n JOIN sub ON sub.tree = n.tree
        JOIN lv ON lv.tree = n.tree AND lv.l < sub.top AND lv.i // 3 = n.i // CAST(3 ** (lv.l + 1) AS BIGINT) GROUP BY n.k, lv.l),
up AS (SELECT sub.tree, sub.top + uv.l AS step, coalesce(string_agg(uv.h, '' ORDER BY uv.i) FILTER (uv.i < sub.j // CAST(3 ** uv.l AS BIGINT)), '') AS b,
              coalesce(string_agg(uv.h, '' ORDER BY uv.i) FILTER (uv.i > sub.j // CAST(3 ** uv.l AS BIGINT)), '') AS a
       FROM sub CROSS JOIN rt JOIN uv ON uv.l < rt.top AND uv.i // 3 = sub.j // CAST(3 ** (uv.l + 1) AS BIGINT) GROUP BY sub.tree, sub.top, uv.l),
way AS (SELECT k, step, b, a FROM own UNION ALL SELECT n.k, up.step, up.b, up.a FROM n JOIN up ON up.tree = n.tree),
folded AS (SELECT k, 0 AS step, found AS h FROM n UNION ALL
           SELECT f.k, f.step + 1, sha256(way.b || f.h || way.a) FROM folded f JOIN way ON way.k = f.k AND way.step = f.step),
proof AS (SELECT k, sha256(string_agg(b || a, '' ORDER BY step)) AS p FROM way GROUP BY k),
ends AS (SELECT k, arg_max(h, step) AS h FROM folded GROUP BY k)
SELECT n.doc_id, n.leaf, sub.subroot, rt.root, coalesce(proof.p, sha256('')) AS proof_sha256, ends.h AS folded_root, ends.h = rt.root AS verified
FROM n JOIN sub ON sub.tree = n.tree CROSS JOIN rt JOIN ends ON ends.k = n.k LEFT JOIN proof ON proof.k = n.k
"""

# A rebuilt prefix is the digests of its turns in a row; a subtree's nodes begin with its top's.
OP13 = f"""
WITH c AS (SELECT conv_id, sha256(strlen(r) || ':' || r || t) AS g, length(t) AS n,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || t)) AS pos
           FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations) WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, conv_id - conv_id % 100 AS b, {crc32("conv_id")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM c)),
hd AS (SELECT k.conv_id, k.h, count(c.pos) AS hb FROM k LEFT JOIN c ON c.conv_id = k.b AND c.pos <= k.h GROUP BY ALL),
s AS (SELECT k.conv_id, c.pos AS d, g, n FROM k JOIN c ON c.conv_id = k.b AND c.pos <= k.h UNION ALL
      SELECT c.conv_id, hb + c.pos - h, g, n FROM hd JOIN c ON c.conv_id = hd.conv_id AND c.pos > hd.h),
e AS (SELECT conv_id, d, string_agg(g, '') OVER (PARTITION BY conv_id ORDER BY d) AS path, n FROM s UNION ALL
      SELECT conv_id, 0, '', 0 FROM k),
v AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, min(n) AS n FROM e GROUP BY path, d),
ch AS (SELECT left(path, 64 * (d - 1)) AS path, count(*) AS n_children FROM v WHERE d > 0 GROUP BY 1),
w AS (SELECT v.*, coalesce(ch.n_children, 0) AS n_children FROM v LEFT JOIN ch ON ch.path = v.path),
up AS (SELECT left(path, 64 * x) AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * n) AS saved
       FROM (SELECT *, unnest(range(0, d + 1)) AS x FROM w) GROUP BY 1),
en AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
       FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS m FROM e) WHERE d = m GROUP BY path)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children,
       CAST(up.n_leaves AS BIGINT) AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, coalesce(en.ends, sha256('')) AS ends_sha256
FROM w JOIN up ON up.path = w.path LEFT JOIN en ON en.path = w.path
LEFT JOIN v p ON p.path = left(w.path, 64 * (w.d - 1)) AND w.d > 0
"""

ORACLES = {
    "op8_url_filters": OP8,
    "op10_quality_rules": OP10,
    "op11_merkle_manifest": OP11,
    "op13_conversation_trie": OP13,
}
