"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from phasediff.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP1 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (
  SELECT doc_id, p, array_to_string(list_slice(words, p, p + 7), ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS p FROM w WHERE len(words) >= 8)),
twice AS (SELECT doc_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (SELECT doc_id, sum(n) AS n FROM (
  SELECT doc_id, least(8, coalesce(lead(p) OVER (PARTITION BY doc_id ORDER BY p) - p, 8)) AS n FROM twice) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop_words, len(lines)::BIGINT AS n_lines
  FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words >= 20 AND coalesce(word_chars / nullif(n_words, 0) BETWEEN 2 AND 20, true)
  AND coalesce(n_symbols / nullif(n_words, 0) <= 0.3, true) AND coalesce(n_stop_words / nullif(n_words, 0) >= 0.05, true)
  AND coalesce(n_dup_lines / nullif(n_lines, 0) <= 0.3, true) AND coalesce(n_repeat_words / nullif(n_words, 0) <= 0.3, true) AS kept,
  n_stop_words, n_lines
FROM f
"""

OP4 = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP13 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS words FROM benchmark),
known AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size, unnest(CASE WHEN len(words) < 10 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 8), lambda i: array_to_string(list_slice(words, i, i + 9), ' ')) END) AS win
  FROM b WHERE len(words) > 0),
places AS (SELECT doc_id, words, size, unnest(range(0, len(words) - size + 1)) AS p
  FROM d, (SELECT DISTINCT size FROM known) WHERE len(words) >= size),
windows AS (SELECT doc_id, p, size, array_to_string(list_slice(words, p + 1, p + size), ' ') AS win FROM places),
hits AS (SELECT doc_id, p, windows.size, item_id FROM windows JOIN known USING (win)),
covered AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS w FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _weights(level: str, names: dict[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN {level} = '{n}' THEN {w}" for n, w in names.items()) + " ELSE 1 END"


def _served(children: str, parents: str, name: str, weights: dict[str, int]) -> str:
    family = f"PARTITION BY {parents}" if parents else ""
    before = f"OVER ({family} ORDER BY ratio, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = f"OVER ({family} ORDER BY ratio, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""(
  SELECT * EXCLUDE (weight, ratio, remaining, open, first, budget), CASE WHEN capacity * open <= remaining * weight THEN capacity
    ELSE (greatest(first.remaining, 0) * weight) // first.open END::BIGINT AS budget
  FROM (SELECT *, min(CASE WHEN capacity * open > remaining * weight
      THEN struct_pack(ratio := ratio, name := {name}, remaining := remaining, open := open) END) OVER ({family}) AS first
    FROM (SELECT *, (budget - coalesce(sum(capacity) {before}, 0))::BIGINT AS remaining, (sum(weight) {after})::BIGINT AS open
      FROM (SELECT *, capacity / weight AS ratio FROM (SELECT *, {_weights(name, weights)} AS weight FROM {children})))))"""


def op3(mix) -> str:
    weights = mix.weights
    domains = _served("root", "", "domain", weights["domain"])
    langs = _served("lang_children", "domain", "lang", weights["lang"])
    sources = _served("source_children", "domain, lang", "source", weights["source"])
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE WHEN regexp_extract(source, '([0-9])$', 1) IN ('1', '4', '7') THEN 'books'
      WHEN regexp_extract(source, '([0-9])$', 1) IN ('2', '5', '8') THEN 'code' ELSE 'web' END AS domain,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS n_tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * {mix.max_epochs})::BIGINT AS capacity
  FROM d GROUP BY ALL),
root AS (SELECT domain, sum(capacity)::BIGINT AS capacity, (SELECT least(sum(tokens) * {mix.budget_percent} // 100, sum(capacity))::BIGINT FROM leaves) AS budget
  FROM leaves GROUP BY domain),
domains AS {domains},
lang_children AS (SELECT domain, lang, sum(leaves.capacity)::BIGINT AS capacity, any_value(budget) AS budget
  FROM leaves JOIN domains USING (domain) GROUP BY domain, lang),
langs AS {langs},
source_children AS (SELECT leaves.*, budget FROM leaves JOIN langs USING (domain, lang)),
sources AS {sources},
r AS (SELECT d.*, coalesce(budget // nullif(tokens, 0), 0)::BIGINT AS epochs, coalesce(budget % nullif(tokens, 0), 0)::BIGINT AS rest
  FROM d JOIN sources USING (domain, lang, source)),
k AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5(concat_ws(':', {mix.seed}, epochs, doc_id)), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r),
p AS (SELECT *, greatest(least(n_tokens, rest - before), 0)::BIGINT AS part_tokens FROM k)
SELECT doc_id, domain, lang, source, n_tokens, epochs, part_tokens, epochs * n_tokens + part_tokens AS take_tokens FROM p
"""


def _all() -> dict[str, str]:
    from phasediff.llm.queries import MIX

    return {"op1_quality_rules": OP1, "op3_mixing_to_weights": op3(MIX), "op4_exact_dedup": OP4, "op13_benchmark_decontamination": OP13}


ORACLES = _all()
