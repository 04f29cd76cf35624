"""The same results in DuckDB SQL, where SQL can express the operator."""

from __future__ import annotations

from strandweave.llm.mixing import INCREMENT, MODULUS, MOST_REPEATS, MULTIPLIER, SEEDS, SHARE, WEIGHTS
from strandweave.llm.secrets import ASSIGN_LEAST, EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES

EXACT_DEDUP = r"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM texts
WINDOW best AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST)
"""

# Level: the first place in the order of (cap / weight) at which the next source is not above its cap.
MIXING = rf"""
WITH RECURSIVE sized AS (
    SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, ''))[1:8])::BIGINT & {MODULUS} AS coin,
           CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS source_key
    FROM documents),
totals AS (SELECT source_key, sum(size)::BIGINT AS source_size FROM sized GROUP BY source_key),
weighted AS (
    SELECT source_key, source_size,
           [{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source_key) - 1) % {len(WEIGHTS)} + 1] AS weight
    FROM totals),
level AS (
    SELECT 0 AS step, sum(source_size) * {SHARE} / sum(weight) AS height, -1.0::DOUBLE AS lower FROM weighted
    UNION ALL
    SELECT step + 1, coalesce((SELECT (sum(source_size) * {SHARE}
                 - sum(CASE WHEN height * weight > {MOST_REPEATS} * source_size THEN {MOST_REPEATS} * source_size ELSE 0 END))
               / nullif(sum(CASE WHEN height * weight > {MOST_REPEATS} * source_size THEN 0 ELSE weight END), 0)
              FROM weighted), height), height
    FROM level WHERE height > lower),
targets AS (
    SELECT source_key, source_size, least((SELECT max(height) FROM level) * weight, ({MOST_REPEATS} * source_size)::DOUBLE) AS target
    FROM weighted),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets),
powers AS (
    SELECT 0 AS seed, {MULTIPLIER}::BIGINT AS factor, {INCREMENT}::BIGINT AS addend
    UNION ALL
    SELECT seed + 1, factor * {MULTIPLIER} % {MODULUS}, addend * {INCREMENT} % {MODULUS} FROM powers WHERE seed < {SEEDS - 1}),
trials AS (
    SELECT r.source_key, p.seed, any_value(p.factor) AS factor, any_value(p.addend) AS addend,
           abs(any_value(floor(rate) * r.source_size)
               + sum(CASE WHEN ((coin * factor + addend) % {MODULUS}) / {MODULUS}.0::DOUBLE < rate - floor(rate) THEN size ELSE 0 END)
               - any_value(target)) AS off
    FROM sized s JOIN rates r USING (source_key), powers p GROUP BY r.source_key, p.seed),
chosen AS (SELECT source_key, factor, addend FROM trials QUALIFY row_number() OVER (PARTITION BY source_key ORDER BY off, seed) = 1)
SELECT doc_id, size, source_size, target,
       (floor(rate)::BIGINT + CASE WHEN ((coin * factor + addend) % {MODULUS}) / {MODULUS}.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END)
       * size AS taken
FROM sized JOIN rates USING (source_key) JOIN chosen USING (source_key)
"""

# Control signs become two characters each; a turn has 5 + 2 + 4 characters of markup.
CHAT = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS probe (turn, role))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(text) + length(regexp_replace(role || text, '[^~<\[\]]', '', 'g')) + 10)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

HARD_NEGATIVES = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS codes
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.codes, r.codes)::BIGINT AS score
    FROM usable AS a JOIN usable AS r ON a.vec_id <> r.vec_id
    WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""



def _either(word: str) -> str:
    """A pattern for an ASCII word in either case; the engine's own flag would fold other letters too."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# (kind, pattern, group of the value, what a match must be besides); an opaque token is a whole run of its signs.
_SECRET_KINDS = (
    ("assign", f"""(?:{'|'.join(map(_either, ('password', 'passwd', 'secret', 'token')))}|{_either('api')}_?{_either('key')})"""
     r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, f"length(value) >= {ASSIGN_LEAST}"),
    ("access", "AKIA[A-Z0-9]+", 0, "length(value) >= 20"),
    ("hex", "[0-9a-f]+", 0, "length(value) >= 24"),
    ("opaque", "[A-Za-z0-9+/_-]{20,}", 0, "value SIMILAR TO '.*[0-9].*' AND value SIMILAR TO '.*[A-Z].*' AND value SIMILAR TO '.*[a-z].*'"),
)
_SECRET_MATCHES = " UNION ALL ".join(
    f"""SELECT doc_row, {number} AS kind_no, '{kind}' AS kind, unnest(range(len(found))) AS place, unnest(found) AS found,
               unnest(vals) AS value, unnest(pieces[1:len(found)]) AS piece
        FROM (SELECT doc_row, regexp_extract_all(text, '{pattern}', 0) AS found, regexp_extract_all(text, '{pattern}', {group}) AS vals,
                     string_split_regex(text, '{pattern}') AS pieces FROM texts)"""
    for number, (kind, pattern, group, _) in enumerate(_SECRET_KINDS))
_SECRET_FITS = " OR ".join(f"(kind = '{kind}' AND {test})" for kind, _, _, test in _SECRET_KINDS)

# A match ends where the pieces and matches up to it end; an opaque token that a base span overlaps is left out.
SECRETS = f"""
WITH texts AS (SELECT row_number() OVER () AS doc_row, doc_id, source AS owner, coalesce(text, '') AS text FROM documents),
matches AS ({_SECRET_MATCHES}),
spans AS (
    SELECT doc_row, kind_no, kind, value, stop - length(found) AS start, stop
    FROM (SELECT *, sum(length(piece) + length(found)) OVER (PARTITION BY doc_row, kind_no ORDER BY place)::BIGINT AS stop FROM matches)
    WHERE {_SECRET_FITS}),
candidates AS (
    SELECT * FROM spans WHERE kind <> 'opaque'
    UNION ALL
    SELECT o.* FROM spans o WHERE o.kind = 'opaque' AND NOT EXISTS (
        SELECT 1 FROM spans b WHERE b.doc_row = o.doc_row AND b.kind <> 'opaque' AND b.start < o.stop AND b.stop > o.start)),
frequency AS (
    SELECT value, count(DISTINCT coalesce('1' || owner, '0')) AS owners, count(DISTINCT (coalesce('1' || owner, '0'), coalesce(doc_id, -1))) AS repositories
    FROM candidates JOIN texts USING (doc_row) GROUP BY value),
judged AS (
    SELECT c.*, kind || ':' || start || ':' || stop AS span,
           owners >= {EXAMPLE_OWNERS} OR (owners > 1 AND repositories >= {EXAMPLE_REPOSITORIES}) AS example
    FROM candidates c JOIN frequency USING (value)),
listed AS (
    SELECT doc_row, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
           count(*) FILTER (WHERE kind = 'hex') AS n_hex,
           string_agg(span, ',' ORDER BY start, kind_no) FILTER (WHERE kind <> 'opaque') AS base,
           string_agg(span, ',' ORDER BY start, kind_no) FILTER (WHERE kind <> 'opaque' OR NOT example) AS spans,
           count(*) FILTER (WHERE NOT example) AS n_live, count(*) FILTER (WHERE example) AS n_example
    FROM judged GROUP BY doc_row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM texts LEFT JOIN listed USING (doc_row)
"""

ORACLES = {
    "op8_secrets": SECRETS,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op4_chat": CHAT,
    "op9_mixing": MIXING,
    "op10_exact_dedup": EXACT_DEDUP,
}
