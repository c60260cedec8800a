"""DuckDB SQL of the queries that SQL can express (the others are tested against brute force).

The rules' numbers are written out here, not taken from the operators.
"""

GAP = r"[\x20\x09-\x0D]+"

OP1 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '{GAP}'), lambda x: x <> '') AS w FROM d),
m AS (SELECT d.doc_id, source, text, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM d JOIN w USING (doc_id)),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS gram
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM r) GROUP BY 1),
b AS (SELECT m.*, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             n_words < 20 OR 100 * coalesce(rep.n, 0) > 30 * n_words AS base_failed
      FROM m LEFT JOIN rep USING (doc_id)),
nl AS (SELECT doc_id, source, text, line, len(string_split(line, ' ')) AS n
       FROM (SELECT doc_id, source, text, trim(unnest(string_split(
               regexp_replace(lower(text), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10))), ' ') AS line FROM d) WHERE line <> ''),
f AS (SELECT source, line FROM nl
      JOIN (SELECT source, count(DISTINCT text) AS host_docs FROM d GROUP BY 1) USING (source)
      GROUP BY source, line, host_docs HAVING count(DISTINCT text) > 20 AND count(DISTINCT text) > host_docs * 0.05),
x AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS removed FROM nl JOIN f USING (source, line) GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (coalesce(removed, 0) > 0 AND (n_words - coalesce(removed, 0) < 20
                                                              OR coalesce(removed, 0) > n_words * 0.5)) AS kept,
       coalesce(removed, 0) AS removed_words
FROM b LEFT JOIN x USING (doc_id)"""

OP8 = rf"""
WITH l AS (SELECT doc_id, i, line, len(list_filter(regexp_split_to_array(line, '{GAP}'), lambda x: x <> '')) AS n
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)),
s AS (SELECT doc_id, i, trim(line, ' ') AS h, n, row_number() OVER p AS r, sum(n) OVER p AS e, sum(n) OVER p - n AS b
      FROM l WHERE n > 0 WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
win AS (SELECT x.doc_id, x.r AS a, min(y.r) AS z FROM s x JOIN s y ON y.doc_id = x.doc_id AND y.r >= x.r AND y.e >= x.b + 50
        GROUP BY ALL
        UNION SELECT y.doc_id, max(x.r) AS a, y.r AS z FROM s y JOIN s x
        ON y.doc_id = x.doc_id AND x.r <= y.r AND x.b <= y.e - 50 GROUP BY y.doc_id, y.r),
runs AS (SELECT win.doc_id, a, z, string_agg(h, chr(10) ORDER BY r) AS run, min(i) AS first, max(i) AS last
         FROM win JOIN s ON s.doc_id = win.doc_id AND r BETWEEN a AND z GROUP BY ALL),
later AS (SELECT doc_id, first, last FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, first) AS k FROM runs)
          WHERE k > 1),
t AS (SELECT l.*, EXISTS (SELECT 1 FROM later WHERE later.doc_id = l.doc_id AND l.i BETWEEN first AND last) AS gone FROM l)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text,
       CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(removed, '') AS removed_lines
FROM documents LEFT JOIN (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept, count(*) FILTER (gone) AS n,
         string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FILTER (gone) AS removed FROM t GROUP BY 1) USING (doc_id)"""

OP12 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
k AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST(CAST('0x' || substr(h, 1, 8) AS UBIGINT) AS BIGINT) AS h1,
             CAST(CAST('0x' || substr(h, 9, 8) AS UBIGINT) AS BIGINT) AS h2, CAST(CAST('0x' || substr(h, 17, 8) AS UBIGINT) AS BIGINT) AS h3,
             CAST(CAST('0x' || substr(h, 25, 8) AS UBIGINT) AS BIGINT) AS h4 FROM d),
c AS (SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN h3 IS NULL OR n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                  THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, substr(text, 1, a) AS pre, substr(text, a + 1, b - a) AS mid, substr(text, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p"""

_LEAF = "sha256(" + " || ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"

OP13 = f"""
WITH RECURSIVE c AS (SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
  lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
    lambda r, z: xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) AS crc
  FROM documents),
leaves AS (SELECT doc_id, coalesce(lang, chr(1)) AS g, lang, {_LEAF.format(n="n_chars")} AS leaf,
  CASE WHEN crc % 7 = 0 THEN {_LEAF.format(n="(n_chars + 1)")} ELSE {_LEAF.format(n="n_chars")} END AS shown FROM c),
low AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
up(l, g, pos, n, digest) AS (SELECT 0, g, pos, n, leaf FROM low UNION ALL
  SELECT l + 1, g, pos >> 1, (n + 1) >> 1, sha256(string_agg(digest, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY l, g, pos >> 1, n),
sub AS (SELECT g, digest AS subroot, row_number() OVER (ORDER BY g <> chr(1), encode(g)) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top(l, pos, n, digest) AS (SELECT 0, pos, n, subroot FROM sub UNION ALL
  SELECT l + 1, pos >> 1, (n + 1) >> 1, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY l, pos >> 1, n),
steps AS (SELECT low.doc_id, low.leaf, s.l, s.digest, s.pos < low.pos >> s.l AS before
          FROM low JOIN up s ON s.g = low.g AND s.pos = xor(low.pos >> s.l, 1) WHERE s.n > 1
          UNION ALL SELECT low.doc_id, low.leaf, 100 + t.l, t.digest, t.pos < sub.pos >> t.l
          FROM low JOIN sub USING (g) JOIN top t ON t.pos = xor(sub.pos >> t.l, 1) WHERE t.n > 1),
levels AS (SELECT low.doc_id, low.leaf, l FROM low JOIN (SELECT DISTINCT g, l FROM up WHERE n > 1) USING (g)
           UNION ALL SELECT doc_id, leaf, 100 + l FROM low, (SELECT DISTINCT l FROM top WHERE n > 1)),
walk AS (SELECT doc_id, leaf, row_number() OVER (PARTITION BY doc_id, leaf ORDER BY l) AS k, digest, before
         FROM levels LEFT JOIN steps USING (doc_id, leaf, l)),
proof AS (SELECT doc_id, leaf, string_agg(digest, '' ORDER BY k) AS siblings FROM walk GROUP BY ALL),
fold(doc_id, leaf, k, digest) AS (SELECT doc_id, leaf, 0, shown FROM low UNION ALL
  SELECT fold.doc_id, fold.leaf, walk.k, sha256(CASE WHEN before THEN walk.digest || fold.digest ELSE fold.digest || coalesce(walk.digest, '') END)
  FROM fold JOIN walk ON walk.doc_id = fold.doc_id AND walk.leaf = fold.leaf AND walk.k = fold.k + 1),
ends AS (SELECT doc_id, leaf, arg_max(digest, k) AS folded_root FROM fold GROUP BY ALL)
SELECT low.doc_id, low.leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM low JOIN sub USING (g) CROSS JOIN (SELECT digest AS root FROM top WHERE n = 1) LEFT JOIN proof USING (doc_id, leaf)
JOIN ends USING (doc_id, leaf)"""

ORACLE_SQL = {"op1_quality_lines": OP1, "op8_line_dedup": OP8, "op12_fim_wavelet": OP12, "op13_merkle_manifest": OP13}
