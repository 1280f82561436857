"""The same results as SQL, where SQL can express them."""

from __future__ import annotations

# Weights 3, 1, 2 repeating; 150% of all words; at most twice a source. What sources at their limit
# leave is shared among those after them, in ascending order of size per weight.
MIX_SOURCES = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), sizes AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
    FROM sizes
), levels AS (
    SELECT *, source_size / weight AS ratio, (
        1.5::DOUBLE * sum(source_size) OVER ()
        - coalesce(sum(2 * source_size) OVER (
            ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    ) / sum(weight) OVER (
        ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted
), targets AS (
    SELECT source, source_size, least(
        weight * (SELECT level FROM levels WHERE level * weight < 2 * source_size ORDER BY ratio, level LIMIT 1),
        2 * source_size)::DOUBLE AS target
    FROM levels
), expected AS (
    SELECT doc_id, sized.source, size, source_size, target,
        CASE WHEN source_size > 0 THEN least(round(16777216 * target / source_size)::BIGINT, 2 * 16777216) ELSE 0 END AS units,
        greatest(length(bin(size)) - 4, 0) AS shift,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % 256 AS block,
        ('0x' || substr(md5('mix' || coalesce(sized.source, '')), 1, 6))::BIGINT AS start
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), crossed AS (
    SELECT *, start + sum(units) OVER (
        PARTITION BY source ORDER BY shift * 16 + (size >> shift), block, size, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto
    FROM expected
)
SELECT doc_id, size, source_size, target,
    (upto // 16777216 - (upto - units) // 16777216)::BIGINT AS copies,
    ((upto // 16777216 - (upto - units) // 16777216) * size)::BIGINT AS taken
FROM crossed
"""


# Windows of items against windows of documents of the same length.
BENCHMARK_LEAKS = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT row_number() OVER () AS k, item_id::VARCHAR AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS seq
    FROM (SELECT item, words, least(len(words), 10) AS n, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM items WHERE len(words) > 0)
), lengths AS (
    SELECT DISTINCT n FROM item_windows
), doc_windows AS (
    SELECT r, n, i, array_to_string(words[i:i + n - 1], ' ') AS seq
    FROM (SELECT r, n, words, unnest(range(1, len(words) - n + 2)) AS i FROM docs, lengths WHERE len(words) >= n)
), met AS (
    SELECT r, i, n, item FROM doc_windows JOIN item_windows USING (n, seq)
), hit AS (
    SELECT r, count(*) AS n_hit
    FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT r, i, n FROM met)) GROUP BY r
), listed AS (
    SELECT r, count(item) AS n_items, coalesce(string_agg(item, ',' ORDER BY item), '') AS list
    FROM (SELECT DISTINCT r, item FROM met WHERE item IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""


def llm_oracles() -> dict[str, str]:
    return {"op2_mix_sources": MIX_SOURCES, "op12_benchmark_leaks": BENCHMARK_LEAKS}
