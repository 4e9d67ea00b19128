"""DuckDB SQL for the training-data queries that SQL can express over whole tables."""

from __future__ import annotations

# A-Z only; DuckDB's lower() would change other letters too
_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH t AS (SELECT doc_id, {_NORM} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

DECONTAMINATION = rf"""
WITH words AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_NORM}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
           regexp_extract_all({_NORM}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(13, len(w)) AS k, array_to_string(w[i + 1 : i + 13], ' ') AS x
    FROM (SELECT item, w, unnest(range(greatest(1, len(w) - 12))) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (
    SELECT rid, i, k, array_to_string(w[i + 1 : i + k], ' ') AS x
    FROM (SELECT rid, w, k, unnest(range(len(w) - k + 1)) AS i FROM words, sizes WHERE len(w) >= k)),
found AS (SELECT p.rid, p.i, p.k, v.item FROM places p JOIN windows v USING (k, x)),
hits AS (SELECT rid, count(DISTINCT at_) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS at_ FROM found) GROUP BY rid),
names AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hits USING (rid) LEFT JOIN names USING (rid)
"""

MIXING = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS key,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents),
per AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w,
           row_number() OVER (ORDER BY source NULLS LAST) AS rank
    FROM sized GROUP BY source),
-- round by round: share what is left by weight among the sources that are not full
rounds AS (
    SELECT 0 AS step, rank, CAST(w AS DOUBLE) AS w, CAST(2 * source_size AS DOUBLE) AS most, false AS full_,
           CAST(0 AS DOUBLE) AS level, CAST((SELECT 1.5 * sum(source_size) FROM per) AS DOUBLE) AS budget
    FROM per
    UNION ALL
    SELECT step + 1, rank, w, most, full_ OR w * lv >= most, lv, budget
    FROM (SELECT *, (budget - coalesce(sum(CASE WHEN full_ THEN most END) OVER (), 0))
                    / sum(CASE WHEN NOT full_ THEN w END) OVER () AS lv FROM rounds)
    WHERE step < (SELECT count(*) FROM per)),
targets AS (
    SELECT p.source, p.source_size, CASE WHEN r.full_ THEN r.most ELSE r.level * r.w END AS target
    FROM per p JOIN rounds r USING (rank) WHERE r.step = (SELECT count(*) FROM per)),
placed AS (
    SELECT s.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS until_,
           CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY key, doc_id, s.size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       CASE WHEN target > 0 THEN (start_ + size) / target END AS virtual_finish,
       greatest(0, least(size, until_ - start_)) + greatest(0, least(size, until_ - source_size - start_)) AS taken
FROM placed
"""

CHAT = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
esc AS (
    SELECT *, '### ' || replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '#', '\h'), ':', '\c') || ': '
              || replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h') || '</turn>' || chr(10) AS piece FROM t),
d AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
           coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS loss,
           CAST(sum(length(piece)) AS BIGINT) AS formatted_chars
    FROM esc GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM d
"""

COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all({_NORM}, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
f1 AS (SELECT lang, w[i] AS p, count(*) AS f FROM spots GROUP BY ALL),
f2 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM spots WHERE i < len(w) GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM spots WHERE i < len(w) - 1
       GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
    SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, 1 AS k, u.f AS l, v.f AS r
    FROM f2 t JOIN f1 u ON u.lang = t.lang AND u.p = t.x JOIN f1 v ON v.lang = t.lang AND v.p = t.y
    UNION ALL
    SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, u.f, v.f
    FROM f3 t JOIN f1 u ON u.lang = t.lang AND u.p = t.x JOIN f2 v ON v.lang = t.lang AND v.x = t.y AND v.y = t.z
    UNION ALL
    SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, u.f, v.f
    FROM f3 t JOIN f2 u ON u.lang = t.lang AND u.x = t.x AND u.y = t.y JOIN f1 v ON v.lang = t.lang AND v.p = t.z),
scored AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, phrase, max(f) AS most FROM (
        SELECT lang, x || ' ' || y AS phrase, f FROM f3 UNION ALL SELECT lang, y || ' ' || z, f FROM f3) GROUP BY ALL),
kept AS (
    SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE i.most IS NULL OR 100 * i.most < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang)
SELECT r.lang, rank, phrase, a, l, r.r, n, score FROM ranked r JOIN sizes s ON s.lang = r.lang WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": DECONTAMINATION, "op3_exact_dedup": EXACT_DEDUP, "op8_mixing": MIXING, "op9_chat": CHAT,
            "op12_collocations": COLLOCATIONS}
