"""DuckDB SQL for the queries of this package that SQL can express.

The others are tested against brute force, the libraries themselves or held-out
rows in ``tests/llm``: language ID (1), edited token counts (4), sentence spans
(5), consistent sampling (8), co-occurrence PII (9) and pieces (10).
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _op2() -> str:
    """The same integer arithmetic throughout; the operator's limits restated."""
    from strata.llm.quality import LEAST_GROUP, RATIOS, REACH

    ratios = ", ".join(f"1000 * {a} // greatest({b}, 1) AS {k}" for k, (a, b, _) in RATIOS.items())
    unpivot = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS ratio, {k} AS v FROM ok" for k in RATIOS)
    spread = "CASE ratio " + " ".join(f"WHEN '{k}' THEN {v[2]}" for k, v in RATIOS.items()) + " END"
    own = ("min(CASE WHEN 4 * upto >= total THEN bin END) AS low, min(CASE WHEN 4 * upto >= 3 * total THEN bin END) AS high, "
           "max(total) AS total")

    def quartiles(keys: str) -> str:
        by = f"{keys}, ratio" if keys else "ratio"
        return (f"SELECT {by}, {own} FROM (SELECT {by}, bin, sum(n) OVER (PARTITION BY {by} ORDER BY bin) AS upto, "
                f"sum(n) OVER (PARTITION BY {by}) AS total FROM (SELECT {by}, bin, sum(n) AS n FROM bins GROUP BY ALL)) GROUP BY {by}")

    pivot = ", ".join(f"max(CASE WHEN ratio = '{k}' THEN high + {REACH} * spread END) AS {k}_most" for k in RATIOS)
    met = " AND ".join(f"f.{k} <= b.{k}_most" for k in RATIOS)
    return rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM documents),
c AS (SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, w, len(lines)::BIGINT AS n_lines,
        length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines FROM w),
tri AS (SELECT doc_id, unnest(range(1, n_words - 1)) AS i, w FROM c WHERE n_words >= 3),
tri2 AS (SELECT doc_id, i, array_to_string(w[i:i+2], ' ') AS t FROM tri),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS n FROM tri2) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
f0 AS (SELECT c.* EXCLUDE (w), coalesce(rep.n, 0) AS n_repeat_words FROM c LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {ratios} FROM f0),
ok AS (SELECT * FROM f WHERE NOT base_failed),
long AS ({unpivot}),
bins AS (SELECT lang, source, ratio, (v >> greatest(length(bin(v)) - 8, 0)) << greatest(length(bin(v)) - 8, 0) AS bin, count(*) AS n
         FROM long GROUP BY ALL),
own AS ({quartiles('lang, source')}), wide AS ({quartiles('lang')}), every AS ({quartiles('')}),
picked AS (SELECT own.lang, own.source, own.ratio,
             CASE WHEN own.total >= {LEAST_GROUP} THEN own.low WHEN wide.total >= {LEAST_GROUP} THEN wide.low ELSE every.low END AS low,
             CASE WHEN own.total >= {LEAST_GROUP} THEN own.high WHEN wide.total >= {LEAST_GROUP} THEN wide.high ELSE every.high END AS high
           FROM own JOIN wide ON own.lang IS NOT DISTINCT FROM wide.lang AND own.ratio = wide.ratio JOIN every ON own.ratio = every.ratio),
spread AS (SELECT *, greatest(high - low, {spread}) AS spread FROM picked),
b AS (SELECT lang, source, {pivot}, max(CASE WHEN ratio = 'word_length' THEN low - {REACH} * spread END) AS word_length_least
      FROM spread GROUP BY lang, source)
SELECT f.doc_id, f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, f.base_failed,
  NOT f.base_failed AND coalesce({met} AND f.word_length >= b.word_length_least, false) AS kept
FROM f LEFT JOIN b ON f.lang IS NOT DISTINCT FROM b.lang AND f.source IS NOT DISTINCT FROM b.source
"""


OP3 = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
d AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.pos, k.line, d.key IS NOT NULL AND d.keeper <> k.doc_id AS gone FROM k LEFT JOIN d ON k.key = d.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP6 = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
         WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON r.other = l.a),
comp AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*)::BIGINT AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, comp.component_id, e.vec_id = comp.component_id AS kept
FROM embeddings e JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5('mix|' || coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, 2 * source_size AS most,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s0),
s2 AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
           - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s1),
s3 AS (SELECT *, (SELECT level FROM s2 WHERE level <= most / weight ORDER BY most / weight, source NULLS LAST LIMIT 1) AS lev FROM s2),
s4 AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0::DOUBLE
         ELSE least(most::DOUBLE, coalesce(lev * weight, most::DOUBLE)) END AS target FROM s3),
s5 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM s4),
s AS (SELECT *, target - passes * source_size AS rest,
        CASE WHEN source_size > 0 THEN (target - passes * source_size) / source_size ELSE 0 END AS part FROM s5),
r AS (SELECT d.*, CASE WHEN size > 1024 THEN 0 WHEN size > 128 THEN 1 ELSE 2 END AS length FROM d),
b AS (SELECT *, (sum(size) OVER (PARTITION BY source, length ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT
        AS before FROM r),
w AS (SELECT source, sum(CASE WHEN length = 0 THEN size ELSE 0 END)::BIGINT AS w0, sum(CASE WHEN length = 1 THEN size ELSE 0 END)::BIGINT AS w1
      FROM r GROUP BY source),
p AS (SELECT s.*, w.w0, w.w1, part * w0 AS q0 FROM s JOIN w ON s.source IS NOT DISTINCT FROM w.source),
t0 AS (SELECT b.source, max(before + size) AS took FROM b JOIN p ON b.source IS NOT DISTINCT FROM p.source
       WHERE length = 0 AND q0 > 0 AND 2 * before + size <= 2 * q0 GROUP BY b.source),
p1 AS (SELECT p.*, coalesce(t0.took, 0) AS t0, part * (w0 + w1) - coalesce(t0.took, 0) AS q1
       FROM p LEFT JOIN t0 ON p.source IS NOT DISTINCT FROM t0.source),
t1 AS (SELECT b.source, max(before + size) AS took FROM b JOIN p1 ON b.source IS NOT DISTINCT FROM p1.source
       WHERE length = 1 AND q1 > 0 AND 2 * before + size <= 2 * q1 GROUP BY b.source),
p2 AS (SELECT p1.*, rest - (p1.t0 + coalesce(t1.took, 0)) AS q2 FROM p1 LEFT JOIN t1 ON p1.source IS NOT DISTINCT FROM t1.source)
SELECT b.doc_id, b.size, p2.source_size, p2.target,
  (size * (passes + CASE WHEN (CASE length WHEN 0 THEN q0 WHEN 1 THEN q1 ELSE q2 END) > 0
     AND 2 * before + size <= 2 * (CASE length WHEN 0 THEN q0 WHEN 1 THEN q1 ELSE q2 END) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM b JOIN p2 ON b.source IS NOT DISTINCT FROM p2.source
"""

OP11 = r"""
WITH lab AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
             FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT t.part, coalesce(lab.good, false) AS good, coalesce(lab.toxic, false) AS toxic,
        len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
        coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false) AS e
      FROM t LEFT JOIN lab ON t.doc_id = lab.doc_id),
m AS (SELECT part, a, b, c, d, e, good, toxic, count(*)::BIGINT AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t
      WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
g AS (SELECT m.*, filter_order, coalesce(least(CASE WHEN a THEN strpos(filter_order, 'A') END, CASE WHEN b THEN strpos(filter_order, 'B') END,
        CASE WHEN c THEN strpos(filter_order, 'C') END, CASE WHEN d THEN strpos(filter_order, 'D') END,
        CASE WHEN e THEN strpos(filter_order, 'E') END), 9) AS gone FROM m, o),
h AS (SELECT g.*, step, substr(filter_order, step::INT, 1) AS letter,
        CASE substr(filter_order, step::INT, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails,
        a::INT + b::INT + c::INT + d::INT + e::INT AS failures FROM g, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step::INT AS step, letter, coalesce(sum(n) FILTER (gone > step), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (gone = step), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (fails AND gone < step), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (fails AND failures = 1), 0)::BIGINT AS unique_fails,
        coalesce(sum(n) FILTER (gone = step AND good), 0)::BIGINT AS good_lost,
        coalesce(sum(n) FILTER (gone = step AND toxic), 0)::BIGINT AS toxic_lost FROM h GROUP BY ALL)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM r
"""

# bytes as two hex digits each; a string of 50 bytes starts at an even offset
OP12 = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM t)),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM w) WHERE least < doc_id),
n AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM g),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM
        (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM n) GROUP BY doc_id, run),
k AS (SELECT doc_id, count(*)::BIGINT AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last FROM r GROUP BY doc_id),
e AS (SELECT r.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM
        (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r) r JOIN t ON r.doc_id = t.doc_id GROUP BY r.doc_id)
SELECT t.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(e.kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM t LEFT JOIN k ON t.doc_id = k.doc_id LEFT JOIN e ON t.doc_id = e.doc_id
"""


def _op13() -> str:
    from strata.llm.collocations import LEAST, TOP

    cut = "1000000::HUGEINT * {0}.n * {0}.n // ({1}.n::HUGEINT * {2}.n)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT row, lang, unnest(string_split_regex(text, '[.,;:!?
-]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g1 AS (SELECT lang, w[i] AS x, count(*)::BIGINT AS n FROM i GROUP BY ALL),
g2 AS (SELECT lang, w[i] AS x, w[i+1] AS y, count(*)::BIGINT AS n FROM i WHERE i + 1 <= len(w) GROUP BY ALL),
g3 AS (SELECT lang, w[i] AS x, w[i+1] AS y, w[i+2] AS z, count(*)::BIGINT AS n FROM i WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= {LEAST}),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM g1 GROUP BY lang),
two AS (SELECT g.lang, g.x || ' ' || g.y AS phrase, g.n AS a, u.n AS l, v.n AS r, ({cut.format('g', 'u', 'v')})::BIGINT AS score
        FROM g2 g JOIN g1 u ON g.lang = u.lang AND g.x = u.x JOIN g1 v ON g.lang = v.lang AND g.y = v.x
        WHERE g.n >= {LEAST} AND NOT EXISTS (SELECT 1 FROM g3 t WHERE t.lang = g.lang AND 100 * t.n >= 50 * g.n
          AND ((t.x = g.x AND t.y = g.y) OR (t.y = g.x AND t.z = g.y)))),
both_cuts AS (SELECT g.lang, g.x || ' ' || g.y || ' ' || g.z AS phrase, g.n AS a,
          {cut.format('g', 'a', 'b')} AS first_score, a.n AS l1, b.n AS r1, {cut.format('g', 'c', 'd')} AS second_score, c.n AS l2, d.n AS r2
        FROM g3 g JOIN g1 a ON g.lang = a.lang AND g.x = a.x JOIN g2 b ON g.lang = b.lang AND g.y = b.x AND g.z = b.y
          JOIN g2 c ON g.lang = c.lang AND g.x = c.x AND g.y = c.y JOIN g1 d ON g.lang = d.lang AND g.z = d.x),
three AS (SELECT lang, phrase, a, CASE WHEN first_score <= second_score THEN l1 ELSE l2 END AS l,
            CASE WHEN first_score <= second_score THEN r1 ELSE r2 END AS r, least(first_score, second_score)::BIGINT AS score FROM both_cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
           FROM (SELECT * FROM two UNION ALL SELECT * FROM three))
SELECT lang, rank, phrase, a, l, r, total.n, score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""


ORACLE: dict[str, str] = {
    "op2_quality_rules": _op2(),
    "op3_line_dedup": OP3,
    "op6_embedding_near_dedup": OP6,
    "op7_mixing": OP7,
    "op11_filter_audit": OP11,
    "op12_suffix_array_dedup": OP12,
    "op13_collocations": _op13(),
}
