"""DuckDB SQL of the queries that SQL can state."""

WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

OP4 = r"""
WITH lines AS (
  SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), shared AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10
), marked AS (
  SELECT keyed.*, shared.k IS NOT NULL AS dropped FROM keyed LEFT JOIN shared ON keyed.k = shared.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

OP8 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents
), grams AS (
  SELECT r, i, hash(list_slice(w, i, i + 7)) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, range(8) t(k) GROUP BY r
), lines AS (
  SELECT r, count(*) AS n, count(DISTINCT line) AS u
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT d.r, doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(lines.n - lines.u, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lines.n, 0) AS n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
    length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower,
    len(list_filter(w, lambda x: x LIKE '%!')) AS n_shouts,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters
  FROM d LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
), b AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_upper > n_lower THEN 16 ELSE 0 END
    + CASE WHEN 10 * n_shouts > 3 * n_words THEN 32 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 64 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words THEN 128 ELSE 0 END
    + CASE WHEN 5 * n_stutters > n_words THEN 256 ELSE 0 END
    + CASE WHEN n_upper > n_lower AND 2 * (n_upper + n_lower) > word_chars THEN 512 ELSE 0 END)::BIGINT AS fail_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits & 1007 = 0 AS kept, fail_bits FROM b
"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(list_slice(w, i, i + 4)) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
  WHERE 100 * c >= 75 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), smallest AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM smallest LEFT JOIN n USING (doc_id)
"""

OP6 = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations
), p AS (
  SELECT conv_id, pos, n, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '')
         OVER (PARTITION BY conv_id ORDER BY pos) AS whole
  FROM t
), f AS (
  SELECT min(conv_id) AS conv_id, n, whole, count(*) AS copies FROM p WHERE pos = n GROUP BY n, whole
)
SELECT conv_id, n AS n_turns, copies, whole AS text, length(whole)::BIGINT AS n_chars
FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos = f.n AND p.pos < p.n AND p.whole = f.whole)
"""

OP9 = r"""
WITH s AS (
  SELECT source, count(*)::DOUBLE AS size, CASE WHEN source = 'src0' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM documents GROUP BY source
), r AS (
  SELECT source, w / (SELECT sum(w) FROM s) * (SELECT sum(size) FROM s) / size AS rate FROM s
), m AS (
  SELECT source, greatest(ceil(rate / 32), 1)::BIGINT AS parts, rate / greatest(ceil(rate / 32), 1) AS mean FROM r
), c AS (
  SELECT source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS total
  FROM (SELECT source, mean, unnest(range(0, ceil(mean + 10 * sqrt(mean) + 30)::BIGINT + 1)) AS k FROM m)
), u AS (
  SELECT d.*, (('0x' || substr(md5('20240607:' || d.doc_id || ':' || part), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM (SELECT d.doc_id, d.source, unnest(range(1, parts + 1)) AS part FROM documents d JOIN m ON d.source = m.source) d
), n AS (
  SELECT u.doc_id, count(c.k) AS copies FROM u JOIN c ON u.source = c.source AND c.total <= u.u GROUP BY u.doc_id
)
SELECT doc_id, text, lang, source, n_chars, copies::INTEGER AS copies, copy::INTEGER AS copy,
       md5('20240607:order:' || doc_id || ':' || copy) AS shuffle_key
FROM (SELECT d.*, n.copies, unnest(range(0, n.copies)) AS copy FROM documents d JOIN n USING (doc_id))
"""

# crc32 of a decimal number, bit by bit.
CRC32 = """list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda acc, byte: list_reduce(list_prepend(xor(acc, byte), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
      lambda x, step: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""


def crc32(number: str) -> str:
    return f"xor({CRC32.replace('c::VARCHAR', number + '::VARCHAR')}, 4294967295)"


def _leaf(n_chars: str) -> str:
    values = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
    return "sha256(" + " || ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}) || ':' || {v} END" for v in values) + ")"


OP12 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_leaf("n_chars")} AS leaf,
         CASE WHEN {crc32("doc_id")} % 7 = 0 THEN {_leaf("n_chars + 1")} END AS given
  FROM documents
), ranked AS (
  SELECT r, doc_id, lang, leaf, coalesce(given, leaf) AS given,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM d
), tree AS (
  SELECT lang, 0 AS lvl, pos, n, leaf AS hash FROM ranked
  UNION ALL
  SELECT lang, any_value(lvl) + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(hash, '' ORDER BY pos))
  FROM tree WHERE n > 1 GROUP BY lang, pos // 2
), subroots AS (
  SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1
), crown AS (
  SELECT 0 AS lvl, pos, n, subroot AS hash FROM subroots
  UNION ALL
  SELECT any_value(lvl) + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(hash, '' ORDER BY pos))
  FROM crown WHERE n > 1 GROUP BY pos // 2
), steps AS (
  -- the siblings of each leaf, level by level: its tree's, then those of the tree over the trees
  SELECT r.r, t.lvl AS lvl, (r.pos >> t.lvl) & 1 AS side, s.hash AS sibling
  FROM ranked r JOIN tree t ON t.lang IS NOT DISTINCT FROM r.lang AND t.pos = r.pos >> t.lvl AND t.n > 1
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM r.lang AND s.lvl = t.lvl AND s.pos = xor(t.pos, 1)
  UNION ALL
  SELECT r.r, 1000 + c.lvl, (p.pos >> c.lvl) & 1, s.hash
  FROM ranked r JOIN subroots p ON p.lang IS NOT DISTINCT FROM r.lang
  JOIN crown c ON c.pos = p.pos >> c.lvl AND c.n > 1
  LEFT JOIN crown s ON s.lvl = c.lvl AND s.pos = xor(c.pos, 1)
), proofs AS (
  SELECT r, string_agg(sibling, '' ORDER BY lvl) AS siblings,
         list(CASE WHEN side = 1 THEN sibling ELSE '' END ORDER BY lvl) AS lefts,
         list(CASE WHEN side = 0 THEN coalesce(sibling, '') ELSE '' END ORDER BY lvl) AS rights
  FROM steps GROUP BY r
), folds AS (
  SELECT r.r, 0 AS done, r.given AS hash FROM ranked r
  UNION ALL
  SELECT f.r, f.done + 1, sha256(p.lefts[f.done + 1] || f.hash || p.rights[f.done + 1])
  FROM folds f JOIN proofs p ON p.r = f.r WHERE f.done < len(p.lefts)
), ends AS (
  SELECT r, arg_max(hash, done) AS folded_root FROM folds GROUP BY r
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM ranked JOIN ends USING (r) JOIN subroots s ON s.lang IS NOT DISTINCT FROM ranked.lang
CROSS JOIN (SELECT hash AS root FROM crown WHERE n = 1) LEFT JOIN proofs USING (r)
"""

OP13 = rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, {crc32("c")} % 4 AS h FROM (SELECT DISTINCT c FROM t)
), rebuilt AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth, role, text FROM (
    SELECT convs.c, 0 AS part, t.pos, role, text FROM convs JOIN t ON t.c = convs.c - convs.c % 20 AND t.pos <= h
    UNION ALL
    SELECT convs.c, 1, t.pos, role, text FROM convs JOIN t ON t.c = convs.c AND t.pos > h
  )
), paths AS (
  SELECT c, depth, count(*) OVER (PARTITION BY c) AS n,
         len(regexp_extract_all(text, '[^ 	-
]+')) AS words,
         sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY depth)) AS prefix
  FROM rebuilt
  UNION ALL
  SELECT convs.c, 0, (SELECT count(*) FROM rebuilt WHERE rebuilt.c = convs.c), 0, '' FROM convs
), nodes AS (
  SELECT prefix, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words, max(n) = depth AS childless,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = depth), '')) AS ends_sha256
  FROM paths GROUP BY prefix, depth
), up AS (
  SELECT x.prefix, x.depth, y.prefix AS above, y.depth AS above_depth
  FROM nodes x JOIN paths y ON y.c = x.conv_id AND y.depth <= x.depth
), below AS (
  SELECT above AS prefix, above_depth AS depth, count(*) FILTER (childless) AS n_leaves,
         sum((n_convs - 1) * words) AS saved_tokens, count(*) FILTER (up.depth = above_depth + 1) AS n_children
  FROM up JOIN nodes USING (prefix, depth) GROUP BY above, above_depth
)
SELECT x.conv_id, x.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs, n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM nodes x JOIN below USING (prefix, depth)
LEFT JOIN up ON up.prefix = x.prefix AND up.depth = x.depth AND up.above_depth = x.depth - 1
LEFT JOIN nodes p ON p.prefix = up.above AND p.depth = up.above_depth
"""

ORACLE = {
    "op4_line_dedup": OP4,
    "op6_chat_snapshots": OP6,
    "op8_quality_rules": OP8,
    "op9_poisson_mix": OP9,
    "op10_minhash_forest": OP10,
    "op12_manifest": OP12,
    "op13_prefix_trie": OP13,
}
