"""DuckDB SQL that restates those queries of the subpackage which SQL can express."""

from __future__ import annotations

from gridledger.llm import sharding

#: Number of words of a text.
_SIZE = r"length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

#: A text with A-Z, and nothing else, in lower case.
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, {_SIZE} AS size,
         length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS marks,
         (('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT + 0.5)::DOUBLE
           / 4503599627370496.0::DOUBLE AS u
  FROM documents
), keyed AS (
  SELECT *, -ln(u) / ((size + 1)::DOUBLE / (size + 1 + marks)) AS k FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, (((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1)::DOUBLE AS w,
         3.0::DOUBLE * source_size AS cap, (sum(source_size) OVER ())::DOUBLE AS total
  FROM sources
), levels AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM weighed
), filled AS (SELECT *, cap * open_w <= (total - before) * w AS is_full FROM levels
), goals AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN cap
              ELSE (total - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ()) * w
                   / sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () END AS target
  FROM filled
), budgets AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs FROM goals
), sums AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs,
         CASE WHEN b.epochs >= 3 THEN 0 ELSE b.target - b.epochs * b.source_size END AS rest, d.k,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.k) AS same
  FROM keyed d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (epochs + CASE WHEN rest > 0 AND upto - same + same / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sums
"""

SHARDING = f"""
WITH tab AS (SELECT {sharding.lookup_table(sharding.SHARDS)} AS owners),
placed AS (
  SELECT doc_id, (('0x' || substr(md5(coalesce('k:' || CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT
                  % {sharding.TABLE_SIZE})::INTEGER AS slot
  FROM documents
)
SELECT doc_id, slot, 'shard-' || lpad(CAST(owners[slot + 1] AS VARCHAR), 2, '0') AS shard FROM placed, tab
"""

LEXICAL_SEARCH = rf"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
        {_FOLDED},
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), asked AS MATERIALIZED (
    SELECT item_id, term, count(*) AS repeats
    FROM (SELECT item_id, unnest(regexp_extract_all(
        {_FOLDED},
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), totals AS MATERIALIZED (
    SELECT count(*) FILTER (len(w) > 0) AS n_all, sum(len(w))::BIGINT AS l_all FROM docs
), postings AS MATERIALIZED (
    SELECT row_id, doc_id, n, term, count(*) AS tf FROM (SELECT row_id, doc_id, len(w) AS n, unnest(w) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, n_all
), scores AS (
    SELECT item_id, row_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_all) // l_all))))::BIGINT AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""

# A CRC-32 is taken byte by byte, a round of the recursion per byte of the longest feature.
RESAMPLING = rf"""
WITH RECURSIVE texts AS MATERIALIZED (
    SELECT 0 AS target, row_number() OVER () AS row_id, doc_id, text FROM documents
    UNION ALL
    SELECT 1, row_number() OVER (), NULL, text FROM benchmark
), worded AS MATERIALIZED (
    SELECT target, row_id, doc_id, regexp_extract_all(
        {_FOLDED},
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts
), placed AS MATERIALIZED (
    SELECT target, row_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM worded
), runs AS MATERIALIZED (
    SELECT target, row_id, w AS a, w || ' ' || lead(w, 1) OVER t AS b, w || ' ' || lead(w, 1) OVER t || ' ' || lead(w, 2) OVER t AS c
    FROM placed WINDOW t AS (PARTITION BY target, row_id ORDER BY i)
), occurrences AS MATERIALIZED (
    SELECT target, row_id, feature, count(*) AS n
    FROM (SELECT target, row_id, a AS feature FROM runs UNION ALL SELECT target, row_id, b FROM runs UNION ALL SELECT target, row_id, c FROM runs)
    WHERE feature IS NOT NULL GROUP BY ALL
), features AS MATERIALIZED (
    SELECT feature, hex(encode(feature)) AS bytes, row_number() OVER () AS f FROM (SELECT DISTINCT feature FROM occurrences)
), one AS MATERIALIZED (
    SELECT v AS b, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, v) AS t
    FROM (SELECT unnest(range(256)) AS v)
), steps AS (
    SELECT f, 0::BIGINT AS k, 4294967295::BIGINT AS crc FROM features
    UNION ALL
    SELECT s.f, s.k + 1, xor(one.t, s.crc >> 8)
    FROM steps s JOIN features x ON x.f = s.f AND 2 * s.k < length(x.bytes)
    JOIN one ON one.b = xor(s.crc & 255, ('0x' || substr(x.bytes, 2 * s.k + 1, 2))::BIGINT)
), hashed AS MATERIALIZED (
    SELECT x.feature, xor(s.crc, 4294967295) % 10000 AS bucket
    FROM steps s JOIN features x ON x.f = s.f AND 2 * s.k = length(x.bytes)
), counted AS (
    SELECT bucket, coalesce(sum(n) FILTER (target = 0), 0)::BIGINT AS s, coalesce(sum(n) FILTER (target = 1), 0)::BIGINT AS t
    FROM occurrences JOIN hashed USING (feature) GROUP BY bucket
), gains AS MATERIALIZED (
    SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))::DOUBLE))::BIGINT AS gain
    FROM counted
), weights AS (
    SELECT row_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
    FROM occurrences JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE target = 0 GROUP BY row_id
), scored AS MATERIALIZED (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS eligible,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM worded LEFT JOIN weights USING (row_id) WHERE target = 0
), placed_scores AS (
    SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
        5 * count(*) FILTER (eligible) OVER () // 100 AS drawn
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= drawn THEN place END AS rank FROM placed_scores
"""

ORACLES: dict[str, str] = {
    "op1_mixing": MIXING,
    "op8_sharding": SHARDING,
    "op11_lexical_search": LEXICAL_SEARCH,
    "op13_importance_resampling": RESAMPLING,
}
