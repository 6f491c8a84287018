"""DuckDB SQL for the results of the queries that SQL can express, from their definitions."""

from __future__ import annotations

import string

from marginlab.llm.decontaminate import SEPARATOR
from marginlab.llm.quality_rules import CLOSED, MARKS, PHRASES, SEPARATORS
from marginlab.llm.text import WORD


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_WORDS = f"""SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
    string_split(coalesce(text, ''), chr(10)) AS lines, coalesce(text, '') AS text FROM documents"""

QUALITY_RULES = f"""
WITH d AS ({_WORDS}),
grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i + 2]) AS times
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)
),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE times > 1)
  GROUP BY doc_id
),
each_line AS (
  SELECT doc_id, line, len(regexp_extract_all(line, '{WORD}')) AS n FROM (SELECT doc_id, unnest(lines) AS line FROM d)
),
judged AS (
  SELECT doc_id, line, n, len(regexp_extract_all(line, {_text(MARKS)})) > 0.2::DOUBLE * n
    OR (n < 8 AND NOT regexp_matches(line, {_text(CLOSED)}))
    OR len(regexp_extract_all(line, {_text(SEPARATORS)})) > 0.2::DOUBLE * n
    OR 12 * len(regexp_extract_all(lower(line), {_text(PHRASES)})) >= n AS bad
  FROM each_line WHERE n > 0
),
by_doc AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(n) FILTER (WHERE bad), 0) AS n_lost
  FROM judged GROUP BY doc_id
),
counts AS (
  SELECT d.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, CAST(coalesce(n_lost, 0) AS BIGINT) AS n_lost
  FROM d LEFT JOIN repeated r USING (doc_id) LEFT JOIN by_doc USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost <= 0.5::DOUBLE * n_words AS kept
FROM counts
"""


def _level(name: str, parents: str, above: str, weight: str) -> str:
    """Shares of one level: CTEs <name>_in, <name>_run, <name>_cut and <name>_got."""
    path = f"{parents}{name}"
    using = parents.rstrip(", ")
    budget = f"JOIN {above} USING ({using})" if using else f"CROSS JOIN {above}"
    on = f"PARTITION BY {using}" if using else ""
    return f"""
{name}_in AS (
  SELECT {path}, cap, CAST({weight} AS HUGEINT) AS w, got AS b
  FROM (SELECT {path}, CAST(sum(tokens) * 2 AS HUGEINT) AS cap FROM leaves GROUP BY {path}) {budget} WHERE cap > 0
),
{name}_run AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS cap0, coalesce(sum(w) OVER before, 0) AS w0, sum(w) OVER ({on}) AS ws
  FROM {name}_in
  WINDOW before AS ({on} ORDER BY cap::DOUBLE / w::DOUBLE, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
{name}_cut AS (SELECT *, cap * (ws - w0) <= w * (b - cap0) AS filled FROM {name}_run),
{name}_got AS (
  SELECT {path}, CASE WHEN filled THEN cap ELSE w * (b - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({on}))
    // nullif(sum(CASE WHEN filled THEN 0 ELSE w END) OVER ({on}), 0) END AS got
  FROM {name}_cut
)"""


MIXING = f"""
WITH nodes AS (
  SELECT doc_id, 'd' || (coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INTEGER), 0) % 4) AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n
  FROM documents
),
leaves AS (SELECT domain, lang, source, CAST(sum(n) AS BIGINT) AS tokens FROM nodes GROUP BY ALL),
everything AS (SELECT CAST(floor(0.6::DOUBLE * sum(tokens)) AS HUGEINT) AS got FROM leaves),
{_level("domain", "", "everything", "CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END")},
{_level("lang", "domain, ", "domain_got", "CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END")},
{_level("source", "domain, lang, ", "lang_got", "1")},
plan AS (
  SELECT domain, lang, source, CAST(got // tokens AS BIGINT) AS epochs, CAST(got % tokens AS BIGINT) AS rest
  FROM source_got JOIN leaves USING (domain, lang, source)
),
ordered AS (
  SELECT nodes.*, epochs, rest, sum(n) OVER (
    PARTITION BY domain, lang, source ORDER BY md5('17:' || epochs || ':' || doc_id), doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM nodes JOIN plan USING (domain, lang, source)
),
times AS (SELECT *, epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS times FROM ordered)
SELECT doc_id, domain, lang, source, n AS n_tokens, CAST(unnest(range(times)) AS INTEGER) AS epoch FROM times
"""

SUBSTRING_DEDUP = f"""
WITH d AS ({_WORDS}),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d)),
again AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM again),
kept AS (
  SELECT doc_id, p, words[p] AS word FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM d)
  ANTI JOIN gone USING (doc_id, p)
),
digests AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS line FROM kept GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN digests USING (doc_id)
"""


def _plain(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"regexp_extract_all({lowered}, '[^{SEPARATOR[1:-2]}]+')"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_plain('text')} AS words FROM documents),
items AS (SELECT item_id, {_plain('text')} AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS g
  FROM (SELECT item_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM (SELECT *, least(13, len(words)) AS size FROM items WHERE len(words) > 0))
),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d CROSS JOIN sizes)
),
met AS (SELECT doc_id, i, size, item_id FROM doc_windows JOIN item_windows USING (size, g)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM met) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM met) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

EXACT_DEDUP = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
  sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWER} AS t FROM documents) WINDOW same AS (PARTITION BY t)
"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, {_LOWER} AS t FROM documents)
),
f AS (
  SELECT lang, size, words[i:i + size - 1] AS p, count(*) AS f
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM pieces, range(1, 5) AS sizes(size))
  GROUP BY ALL
),
words_of AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, p, f AS a FROM f WHERE size > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.p, a, k, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * a) // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) AS c
  JOIN f AS x ON x.lang = c.lang AND x.p = c.p[1:k]
  JOIN f AS y ON y.lang = c.lang AND y.p = c.p[k + 1:c.size]
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, p[i:i + len - 1] AS p, max(a) AS most
  FROM (SELECT lang, p, a, size, len, unnest(range(1, size - len + 2)) AS i FROM candidates, range(2, 4) AS lens(len) WHERE len < size)
  GROUP BY ALL
),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM lowest LEFT JOIN inner_phrases USING (lang, p)
  WHERE most IS NULL OR 100 * most < 80 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN words_of USING (lang) QUALIFY rank <= 2000
"""

_TERMS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(_LOWER)

LEXICAL_SEARCH = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
totals AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d),
tf AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
counted AS (SELECT doc_id, n, term, count(*) AS tf FROM tf GROUP BY ALL),
wanted AS (SELECT DISTINCT item_id, unnest(terms) AS term FROM (SELECT item_id, {_TERMS} AS terms FROM benchmark)),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), totals
),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN counted USING (term), totals GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

ORACLES = {
    "op2_quality_rules": QUALITY_RULES,
    "op5_mixing": MIXING,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op8_decontamination": DECONTAMINATION,
    "op11_exact_dedup": EXACT_DEDUP,
    "op12_collocations": COLLOCATIONS,
    "op13_lexical_search": LEXICAL_SEARCH,
}
