"""DuckDB SQL for the operators whose result SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWERED = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x20\x09-\x0D]+')")


def crc32(text: str) -> str:
    """crc32 of an ASCII text: each byte is xored in, then shifted out bit by bit."""
    steps = f"flatten([[ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for x in string_split({text}, '')])"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) "
            "WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT)")


OP2 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS w
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY w) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM rep, (SELECT unnest(range(0, 35)) AS k)),
kept AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS t
         FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d) x
         ANTI JOIN gone ON gone.doc_id = x.doc_id AND gone.p = x.p GROUP BY x.doc_id)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(g.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g ON g.doc_id = d.doc_id
LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

OP4 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {LOWERED} AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, g FROM (
         SELECT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)
         UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

OP5 = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY body)
"""

OP6 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS ws FROM documents),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS p FROM hit, (SELECT unnest([0, 1, 2]) AS k)) GROUP BY doc_id),
ln AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
       WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM ln GROUP BY doc_id),
m AS (SELECT d.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n, 0) AS n_lines,
             coalesce(lines.dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
             len([x for x in ws if NOT regexp_matches(x, '[#*$%&|<>]')]) AS plain
      FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN lines ON d.doc_id = lines.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
      (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
       + CASE WHEN 100 * n_symbols > 25 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
       + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
       + CASE WHEN 100 * plain < 70 * n_words THEN 64 ELSE 0 END)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_bits = 0 AS kept, failed_bits FROM b
"""

ABLATIONS = f"""
WITH v AS ({OP6}),
p AS (SELECT * FROM (VALUES ('base', 3), ('v1', 15), ('v2', 127)) AS x(policy, mask)),
r AS (SELECT * FROM (VALUES ('too_few_words', 1), ('repeated_words', 2), ('many_symbols', 4), ('duplicate_lines', 8),
      ('short_words', 16), ('long_words', 32), ('few_plain_words', 64)) AS x(rule, one))
SELECT policy, rule, count(*) FILTER (WHERE failed_bits & one <> 0) AS n_failed,
       count(*) FILTER (WHERE failed_bits & mask = one) AS n_failed_alone,
       count(*) FILTER (WHERE failed_bits & mask = 0) AS n_kept,
       count(*) FILTER (WHERE failed_bits & (mask - one) = 0) AS n_kept_without
FROM p JOIN r ON mask & one <> 0 LEFT JOIN v ON true GROUP BY policy, rule
"""


def _discounts(table: str, column: str) -> str:
    """(d1, d2, d3) of a table of counts; every count of counts is present here."""
    n = ", ".join(f"count(*) FILTER (WHERE {column} = {k})::DOUBLE AS n{k}" for k in (1, 2, 3, 4))
    return (f"SELECT 1 - 2 * y * n2 / n1 AS d1, 2 - 3 * y * n3 / n2 AS d2, 3 - 4 * y * n4 / n3 AS d3 "
            f"FROM (SELECT *, n1 / (n1 + 2 * n2) AS y FROM (SELECT {n} FROM {table}))")


# A blank stands for the end, before the first token and after the last word.
OP10 = f"""
WITH d AS (SELECT doc_id, {LOWERED} AS ws, {crc32("doc_id::VARCHAR")} % 7 = 2 AS held_out FROM documents),
t AS (SELECT doc_id, held_out, unnest(list_concat(ws, [' '])) AS w, unnest(list_concat([' '], ws)) AS v FROM d),
uni AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
tot AS (SELECT sum(c)::BIGINT AS n, count(*) AS vocab FROM uni),
big AS (SELECT v, w, count(*) AS c FROM t WHERE NOT held_out GROUP BY v, w),
dk AS ({_discounts("big", "c")}),
bef AS (SELECT w, count(*) AS k FROM big GROUP BY w),
d1k AS ({_discounts("bef", "k")}),
u AS (SELECT sum(k)::DOUBLE AS total, sum(CASE k WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END) / sum(k) AS g FROM bef, d1k),
p1 AS (SELECT w, (k - CASE k WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END) / total AS p FROM bef, d1k, u),
ctx AS (SELECT v, sum(c)::DOUBLE AS total, sum(CASE c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END) / sum(c) AS g FROM big, dk GROUP BY v),
s AS (SELECT t.doc_id, t.held_out, uni.c AS known, log10((coalesce(uni.c, 0) + 1) / (tot.n + 1 * (tot.vocab + 1))) AS base,
             log10(coalesce((big.c - CASE big.c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END) / ctx.total, 0)
                   + coalesce(ctx.g, 1) * (coalesce(p1.p, 0) + u.g / (tot.vocab + 1))) AS lp
      FROM t CROSS JOIN tot CROSS JOIN dk CROSS JOIN u LEFT JOIN uni ON uni.w = t.w LEFT JOIN p1 ON p1.w = t.w
      LEFT JOIN ctx ON ctx.v = t.v LEFT JOIN big ON big.v = t.v AND big.w = t.w)
SELECT doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens, count(known) AS n_known, (SELECT n FROM tot) AS train_tokens,
       sum(base) AS base_score, sum(lp) AS score
FROM s GROUP BY doc_id
"""

UNITS = r"regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+')"

OP13 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {UNITS} AS u, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
r AS (SELECT doc_id, t, u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                       OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
                  WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
x AS (SELECT *, array_to_string(u[1:least(a, b)], '') AS pre, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS mid,
             array_to_string(u[greatest(a, b) + 1:n], '') AS suf FROM r)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM x
"""

ORACLE = {
    "op2_substring_dedup": OP2,
    "op4_ngram_jaccard_join": OP4,
    "op5_exact_dedup": OP5,
    "op6_quality_rules": OP6,
    "op10_lm_scoring": OP10,
    "op13_fill_in_middle": OP13,
    "quality_rule_ablations": ABLATIONS,
}
