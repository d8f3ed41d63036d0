"""The queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from cinestar.llm.quality import QualityRules
from cinestar.llm.line_dedup import Boilerplate
from cinestar.llm.url_filter import Reputation, suffix_pattern

_LINES, _RULES, _URLS = Boilerplate(), QualityRules(), Reputation()

LINE_DEDUP = f"""
WITH numbered AS (SELECT *, row_number() OVER () AS place FROM {{documents}}),
lines AS (
  SELECT place, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS k
  FROM numbered WHERE text IS NOT NULL),
pages AS (SELECT source, count(*) AS pages FROM numbered GROUP BY source),
dropped AS (
  SELECT source, line, true AS gone FROM lines JOIN pages USING (source)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
  GROUP BY source, line, pages
  HAVING count(DISTINCT place) > {_LINES.max_ratio} * pages
     AND count(DISTINCT place) >= {_LINES.min_pages}),
cleaned AS (
  SELECT place,
         coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (gone IS NULL), '') AS text,
         count(gone) AS n_dropped_lines
  FROM lines LEFT JOIN dropped USING (source, line) GROUP BY place)
SELECT doc_id, cleaned.text, lang, source, n_chars,
       coalesce(n_dropped_lines, 0) AS n_dropped_lines
FROM numbered LEFT JOIN cleaned USING (place)"""

_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def _count(pattern: str) -> str:
    return f"length(regexp_replace(body, '{pattern}', '', 'g'))"


_CLASS_PATTERNS = (
    r"[^A-Z]",
    r"[^0-9]",
    r"[^#*$%&|<>]",
    r"""[^.,;:!?"''()+\-/=@\[\]^_`{}~\\]""",
)


def _js(left: str, right: str) -> str:
    """Jensen-Shannon divergence of two lists of counts."""
    return (
        f"list_sum(list_transform(list_zip({left}, {right}), lambda z: "
        f"coalesce(CASE WHEN z[1] > 0 THEN z[1] / list_sum({left}) * log2(2 * (z[1] / list_sum({left}))"
        f" / (z[1] / list_sum({left}) + z[2] / list_sum({right}))) END, 0) / 2 + "
        f"coalesce(CASE WHEN z[2] > 0 THEN z[2] / list_sum({right}) * log2(2 * (z[2] / list_sum({right}))"
        f" / (z[1] / list_sum({left}) + z[2] / list_sum({right}))) END, 0) / 2))"
    )


_CLASS_SUMS = ", ".join(f"sum(classes[{i}])" for i in range(1, 6))
_COMMON_SUMS = ", ".join(f"sum(common[{i}])" for i in range(1, _RULES.common_words + 2))

QUALITY = f"""
WITH texts AS (
  SELECT row_number() OVER () AS place, doc_id, lang, coalesce(text, '') AS body,
         {_WORDS} AS words
  FROM {{documents}}),
common_words AS (
  SELECT lang, list_resize(list(word ORDER BY n DESC, word), {_RULES.common_words}, ' ') AS top
  FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank
        FROM (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(words) AS word FROM texts)
              WHERE lang IS NOT NULL AND length(word) <= {_RULES.common_letters} GROUP BY lang, word))
  WHERE rank <= {_RULES.common_words} GROUP BY lang),
grams AS (
  SELECT place, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT place, words, unnest(range(1, len(words) - 1)) AS i FROM texts)),
repeated AS (SELECT place, i, count(*) OVER (PARTITION BY place, gram) AS n FROM grams),
covered AS (
  SELECT place, count(DISTINCT i + d) AS n
  FROM repeated, (SELECT unnest([0, 1, 2]) AS d) WHERE n > 1 GROUP BY place),
lines AS (
  SELECT place, count(*) - count(DISTINCT line) AS n
  FROM (SELECT place, unnest(string_split(body, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY place),
measured AS (
  SELECT place, doc_id, lang, len(words) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         {_count(_CLASS_PATTERNS[2])} AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         [{", ".join(_count(p) for p in _CLASS_PATTERNS)},
          length(body) - {" - ".join(_count(p) for p in _CLASS_PATTERNS)}] AS classes,
         list_append(list_transform(top, lambda c: len(list_filter(words, lambda w: w = c))),
           len(list_filter(words, lambda w: NOT list_contains(top, w)))) AS common
  FROM texts LEFT JOIN lines USING (place) LEFT JOIN covered USING (place) LEFT JOIN common_words USING (lang)),
reference AS (
  SELECT lang, [{_CLASS_SUMS}] AS ref_classes, [{_COMMON_SUMS}] AS ref_common
  FROM measured WHERE lang IS NOT NULL AND n_words >= {_RULES.min_words} GROUP BY lang),
judged AS (
  SELECT measured.*,
         n_words < {_RULES.min_words}
           OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words AS base_failed,
         CASE WHEN n_words >= {_RULES.min_words}
              THEN sqrt(greatest(0, {_js("classes", "ref_classes")})) END AS class_distance,
         CASE WHEN n_words >= {_RULES.min_common_words}
              THEN sqrt(greatest(0, {_js("common", "ref_common")}
                   - {_RULES.common_words} / (8 * ln(2)) / n_words)) END AS common_distance
  FROM measured LEFT JOIN reference USING (lang))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(class_distance > {_RULES.max_class_distance}, false)
         AND NOT coalesce(common_distance > {_RULES.max_common_distance}, false) AS kept
FROM judged"""

_SUFFIX = suffix_pattern(_URLS.wide_suffixes)


def _posterior(name: str, counts: str) -> str:
    """Shares shrunk towards their priors, by a strength from the counts' scatter."""
    chance = "seen * prior * (1 - prior)"
    least, most = 1 / (_URLS.strongest + 1), 1 / (_URLS.weakest + 1)
    return f"""{name}_strength AS (
  SELECT 1 / least(greatest(coalesce(
    sum((bad - seen * prior) * (bad - seen * prior) - {chance}) / nullif(sum({chance} * (seen - 1)), 0),
    {most!r}::DOUBLE), {least!r}::DOUBLE), {most!r}::DOUBLE) - 1 AS strength FROM {counts}),
{name} AS (
  SELECT *, (bad + strength * prior) / (seen + strength) AS share, seen + strength AS weight
  FROM {counts}, {name}_strength)"""


URL_FILTER = f"""
WITH parsed AS (
  SELECT row_number() OVER () AS place, page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
split AS (
  SELECT *, regexp_extract(host, '(?:^|[.])([^.]+[.](?:{_SUFFIX}))$', 1) AS domain,
         regexp_extract(host, '(?:^|[.])({_SUFFIX})$', 1) AS suffix FROM parsed),
labelled AS (
  SELECT host, domain, suffix,
         CAST(coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 AS INTEGER) AS bad
  FROM split JOIN labels ON labels.doc_id = split.page_id),
overall AS (
  SELECT (coalesce(sum(bad), 0) + 0.5) / (count(*) + 1) AS share, count(*) + 1.0 AS weight FROM labelled),
suffix_counts AS (
  SELECT suffix, sum(bad) AS bad, count(*) AS seen, any_value(o.share) AS prior
  FROM labelled, overall o WHERE host <> '' GROUP BY suffix),
{_posterior("suffixes", "suffix_counts")},
domain_counts AS (
  SELECT l.domain, l.suffix, sum(l.bad) AS bad, count(*) AS seen, any_value(s.share) AS prior
  FROM labelled l JOIN suffixes s USING (suffix) WHERE host <> '' GROUP BY l.domain, l.suffix),
{_posterior("domains", "domain_counts")},
host_counts AS (
  SELECT l.host, sum(l.bad) AS bad, count(*) AS seen, any_value(d.share) AS prior
  FROM labelled l JOIN domains d USING (domain, suffix) WHERE host <> '' GROUP BY l.host),
{_posterior("hosts", "host_counts")},
rules AS (
  SELECT * FROM (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
    ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow'))
  t(rule, rule_host, rule_path, verdict)),
ruled AS (
  SELECT place, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path) GROUP BY place),
best AS (
  SELECT place, coalesce(h.share, d.share, s.share, o.share) AS share,
         coalesce(h.weight, d.weight, s.weight, o.weight) AS weight
  FROM split LEFT JOIN hosts h USING (host)
  LEFT JOIN domains d ON d.domain = split.domain AND d.suffix = split.suffix
  LEFT JOIN suffixes s ON s.suffix = split.suffix, overall o),
beta AS (
  SELECT place, a, b, 1 / (2 * a - 1) AS one, 1 / (2 * b - 1) AS two, ({_URLS.z} * {_URLS.z} - 3) / 6 AS skew
  FROM (SELECT place, weight * share + 1 AS a, weight * (1 - share) + 1 AS b FROM best)),
bounds AS (
  SELECT place, a / (a + b * exp(2 * ({_URLS.z} * sqrt(greatest(h + skew, 0)) / h
    - (two - one) * (skew + 5.0 / 6 - 2 / (3 * h))))) AS bound
  FROM (SELECT *, 2 / (one + two) AS h FROM beta))
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN bound > {_URLS.max_bad} THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN ruled USING (place) LEFT JOIN bounds USING (place)"""

_TERMS = (
    "unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"
)
LEXICAL = f"""
WITH words AS (SELECT doc_id, {_TERMS} AS term FROM {{documents}}),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_id),
totals AS (SELECT count(*) AS all_n, sum(n)::BIGINT AS l FROM lengths),
sized AS (SELECT doc_id, 100 - 50 + ((50 * n * all_n) // l) AS m FROM lengths, totals),
weights AS (
  SELECT term, floor(1000 * ln((2 * all_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, totals GROUP BY term, all_n),
asked AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sized USING (doc_id)
  GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 50"""

ORACLES = {
    "op1_line_dedup": LINE_DEDUP.replace("{documents}", "documents"),
    "op9_quality": QUALITY.replace("{documents}", "documents"),
    "op10_url_filter": URL_FILTER,
    "op12_lexical": LEXICAL.replace("{documents}", "documents"),
}
