"""SQL for those of the queries that SQL can express, in plain versions without any index."""

from __future__ import annotations

from txn_risk.llm.repeats import PASSAGE, PASSAGE_WORDS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_BLANK_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
         WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id <= coalesce(m, vec_id) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id"""

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM (
          SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
          FROM b WHERE len(w) > 0)),
own AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g FROM (
          SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win)
          WHERE len(w) >= m)),
hit AS (SELECT doc_id, i, m, item_id FROM own JOIN win USING (m, g)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit)
        GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items,
                 string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN items USING (doc_id)"""



def _stretches(name: str, length: int) -> str:
    """Common table ``name(doc_id, a, b)``: maximal stretches covered by repeated strings of ``length`` bytes."""
    return f"""
{name}_win AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * length})) AS g FROM (
        SELECT doc_id, h, unnest(range(0, length(h) // 2 - {length - 1})) AS i FROM d WHERE length(h) >= {2 * length})),
{name}_hit AS (SELECT doc_id, i FROM {name}_win
        SEMI JOIN (SELECT g FROM {name}_win GROUP BY g HAVING count(*) > 1) USING (g)),
{name}_step AS (SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {length}, -1) AS new
        FROM {name}_hit),
{name}_run AS (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM {name}_step),
{name} AS (SELECT doc_id, min(i) AS a, max(i) + {length} AS b FROM {name}_run GROUP BY doc_id, k)"""


# Bytes are read as two hexadecimal digits each. A word begins after white space or the text's start, and lies whole
# in a stretch if it ends there as well.
REPEATS = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),{_stretches("span", 400)},
kept AS (SELECT doc_id, any_value(h) AS h, sum(b - a) AS n_removed, count(*) AS n_spans,
                string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head, max(b) AS last
         FROM (SELECT span.*, h, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before
               FROM span JOIN d USING (doc_id)) GROUP BY doc_id),{_stretches("near", PASSAGE)},
byte AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) IN ('20', '09', '0A', '0B', '0C', '0D') AS blank FROM (
        SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS p FROM d SEMI JOIN near USING (doc_id))),
edge AS (SELECT doc_id, p, blank, coalesce(lag(blank) OVER own, true) AS first, coalesce(lead(blank) OVER own, true) AS last
         FROM byte WINDOW own AS (PARTITION BY doc_id ORDER BY p)),
starts AS (SELECT doc_id, p AS s, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS k FROM edge WHERE first AND NOT blank),
ends AS (SELECT doc_id, p + 1 AS e, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS k FROM edge WHERE last AND NOT blank),
passage AS (SELECT near.doc_id, a, b FROM near JOIN starts ON near.doc_id = starts.doc_id AND s >= a
            JOIN ends ON ends.doc_id = starts.doc_id AND ends.k = starts.k AND e <= b
            GROUP BY ALL HAVING count(*) >= {PASSAGE_WORDS}),
read_over AS (SELECT doc_id, count(*) AS n, sum(b - a) AS bytes FROM passage GROUP BY doc_id)
SELECT doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN d.h ELSE head || substr(d.h, 2 * last + 1) END)) AS kept_sha256,
       coalesce(n, 0) AS n_passages, coalesce(bytes, 0)::BIGINT AS n_passage_bytes
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN read_over USING (doc_id)"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_BLANK_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + m - 1], ' ') AS g FROM (
        SELECT doc_id, w, least(4, len(w)) AS m, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i
        FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g)
           WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = d.doc_id"""


COLLOCATIONS = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS t
               FROM documents),
p AS (SELECT lang, regexp_extract_all(t, '[^\\x20\\x09]+') AS w FROM piece),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 5) AS ks(k) WHERE len(w) >= k)
      GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, g, string_split(g, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 30),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, max(a) AS longer
           FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM cand, range(2, 4) AS ms(m) WHERE m < k)
           GROUP BY ALL),
kept AS (SELECT cand.* FROM cand LEFT JOIN inside USING (lang, g) WHERE longer IS NULL OR 100 * longer < 80 * a),
cut AS (SELECT lang, g, a, c, array_to_string(w[1:c], ' ') AS x, array_to_string(w[c + 1:], ' ') AS y
        FROM kept, range(1, 4) AS cs(c) WHERE c < k),
scored AS (SELECT cut.lang, cut.g, a, c, x.f AS l, y.f AS r,
                  ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
           FROM cut JOIN f AS x ON x.lang = cut.lang AND x.g = cut.x JOIN f AS y ON y.lang = cut.lang AND y.g = cut.y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM best)
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_embedding_neardup": VECTORS,
        "op6_benchmark_decontamination": CONTAMINATION,
        "op7_suffix_array_dedup": REPEATS,
        "op10_ngram_jaccard_join": JACCARD,
        "op11_phrase_collocations": COLLOCATIONS,
    }
