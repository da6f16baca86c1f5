"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from skytrace.llm.quality import QualityParams

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CLASSES = ["[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"""[.,;:?''"()\-]""", "[#*$%&|<>]"]


def quality_rules(p: QualityParams = QualityParams()) -> str:
    """The base counts and the divergence verdict; a null ``lang`` is a language too."""
    counts = [f"length(text) - length(regexp_replace(text, '{c}', '', 'g'))" for c in _CLASSES]
    ascii_only = "length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'))"
    classes = f"[{', '.join(counts)}, {ascii_only} - ({' + '.join(f'({c})' for c in counts)}), length(text) - {ascii_only}]"
    jsd = "p * log2(2 * p / (p + q)) + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END"
    limit = lambda t, bins, n: f"sqrt({t * t!r} + {p.noise_allowance!r} * ({bins} - 1) / (8 * ln(2) * greatest({n}, 1)))"
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
u AS (SELECT doc_id, lang, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
grams AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, w2, w3) AS n FROM (SELECT doc_id, i, word, lead(word) OVER x AS w2, lead(word, 2) OVER x AS w3 FROM u WINDOW x AS (PARTITION BY doc_id ORDER BY i)) WHERE w3 IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM grams, (VALUES (0), (1), (2)) t(k) WHERE n > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (SELECT w.doc_id, lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, {classes} AS cs FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)),
short AS (SELECT doc_id, lang, CASE WHEN strlen(c) <= 8 THEN translate(c, '{_UPPER}', '{_LOWER}') END AS key FROM (SELECT doc_id, lang, CASE WHEN length(word) > 1 AND regexp_matches(word, '[.,;:?!]$') THEN left(word, length(word) - 1) ELSE word END AS c FROM u)),
ranked AS (SELECT lang, key, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, key) AS r FROM (SELECT lang, key, count(*) AS n FROM short WHERE key IS NOT NULL GROUP BY lang, key)),
top AS (SELECT lang, key, n FROM ranked WHERE r <= {p.common_words}),
tot AS (SELECT lang, count(*) AS total FROM short GROUP BY lang),
ref AS (SELECT top.lang AS lang, key, n / total AS q FROM top JOIN tot ON top.lang IS NOT DISTINCT FROM tot.lang UNION ALL SELECT top.lang AS lang, '' AS key, 1 - sum(n) / any_value(total) AS q FROM top JOIN tot ON top.lang IS NOT DISTINCT FROM tot.lang GROUP BY top.lang),
mine AS (SELECT doc_id, lang, coalesce(k, '') AS key, count(*) AS c FROM (SELECT s.doc_id, s.lang, t.key AS k FROM short s LEFT JOIN top t ON s.lang IS NOT DISTINCT FROM t.lang AND s.key = t.key) GROUP BY ALL),
by_word AS (SELECT doc_id, sqrt(greatest(sum({jsd}) + 1 - sum(q), 0) / 2) AS d FROM (SELECT m.doc_id, c / sum(c) OVER (PARTITION BY m.doc_id) AS p, q FROM mine m JOIN ref r ON r.lang IS NOT DISTINCT FROM m.lang AND r.key = m.key) GROUP BY doc_id),
chars AS (SELECT doc_id, lang, unnest(cs) AS c, unnest(range(8)) AS k FROM base),
char_ref AS (SELECT lang, k, sum(c) / sum(sum(c)) OVER (PARTITION BY lang) AS q FROM chars GROUP BY lang, k),
by_char AS (SELECT doc_id, sqrt(greatest(sum(CASE WHEN p > 0 THEN {jsd} ELSE q END), 0) / 2) AS d, any_value(n) AS n FROM (SELECT doc_id, q, c / sum(c) OVER (PARTITION BY doc_id) AS p, sum(c) OVER (PARTITION BY doc_id) AS n FROM chars JOIN char_ref ON chars.lang IS NOT DISTINCT FROM char_ref.lang AND chars.k = char_ref.k) GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {p.min_words} OR 100 * n_repeat_words > {p.max_repeat_percent} * n_words AS base_failed,
  NOT (n_words < {p.min_words} OR 100 * n_repeat_words > {p.max_repeat_percent} * n_words) AND coalesce(w.d <= {limit(p.max_word_distance, p.common_words + 1, 'n_words')}, false) AND coalesce(c.d <= {limit(p.max_char_distance, 8, 'c.n')}, false) AS kept
FROM base b LEFT JOIN by_word w USING (doc_id) LEFT JOIN by_char c USING (doc_id)"""
