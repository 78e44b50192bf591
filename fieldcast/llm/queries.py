"""One query per operator over its whole table, with production parameters, and SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcast.llm import (bpe, line_dedup, neighbours, packing, phrases, prefix_trie,
                           quality_classifier, quality_rules, simhash, token_counts, token_files,
                           tokenizer, toxicity, url_reputation)
from fieldcast.llm.common import table
from fieldcast.session import scratch_dir

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"
FILE_END, PACK_END = 2, 1


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_dir(spark).rstrip('/')}/token_files/{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents"), folder,
                      tokenizer.default_path(WORD_VOCABULARY), FILE_END)
    return token_files.checksums(token_files.read(spark, folder))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"),
                          tokenizer.default_path(BYTE_VOCABULARY))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_sections(
        table(spark, sf_dir, "documents"), tokenizer.default_path(BYTE_VOCABULARY)).drop("name")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("n_lines")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"),
                        tokenizer.default_path(BYTE_VOCABULARY), PACK_END)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"),
                        "component_id")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = url_reputation.outcomes(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return url_reputation.judge(pages)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.search(rows, rows.where(F.col("vec_id") % 50 == 0))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_token_files, op3_bpe_round_trip, op4_toxicity, op5_token_counts,
    op6_quality_rules, op7_packing, op8_simhash, op9_url_filters, op10_neighbours,
    op11_line_dedup, op12_phrases, op13_prefix_trie)}

#: Lower-cases A-Z alone.
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _shrunk(name: str, groups: str) -> str:
    """Two CTEs: the groups (with n, bad and prior) and their posterior rates."""
    return f"""
{name}_groups AS ({groups}),
{name}_sums AS (SELECT count(*) AS g, sum(n)::DOUBLE AS t, sum(n * n)::DOUBLE AS sq,
    sum(n * pow(bad / n - prior, 2)) AS between_groups, sum(n * (bad / n) * (1 - bad / n)) AS inside
  FROM {name}_groups WHERE n > 0),
{name}_spread AS (SELECT between_groups / greatest(g - 1, 1) AS msb,
    inside / greatest(t - g, 1.0) AS msw, (t - sq / t) / greatest(g - 1, 1) AS n0
  FROM {name}_sums),
{name}_rho AS (SELECT CASE WHEN msb + (n0 - 1) * msw > 0
    THEN (msb - msw) / (msb + (n0 - 1) * msw) END AS rho FROM {name}_spread),
{name}_means AS (SELECT *, (bad + mass * prior) / (n + mass) AS mean FROM {name}_groups,
  (SELECT greatest(1.0, least(10000.0, coalesce(CASE WHEN rho > 0 THEN 1 / rho - 1 END, 10000.0)))
    AS mass FROM {name}_rho)),
{name} AS (SELECT *, greatest(0.0, mean - {url_reputation.Z!r} * sqrt(greatest(0.0,
    mean * (1 - mean)) / (n + mass + 1))) AS lower_bound FROM {name}_means)"""


def _rule_cases() -> str:
    """CASE branches of the rules, longest first."""
    out = []
    for verdict, rule in sorted(url_reputation.RULES, key=lambda r: (-len(r[1]), r[1])):
        name, slash, prefix = rule.partition("/")
        out.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND "
                   f"starts_with(path, '{slash}{prefix}') THEN '{rule} {verdict}'")
    return "\n    ".join(out)


_URL_SQL = f"""
WITH marks AS (SELECT doc_id, 1 - min(quality) AS bad FROM labels WHERE doc_id IS NOT NULL
  GROUP BY doc_id),
cut AS (SELECT page_id, url,
  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
raws AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
parts AS (SELECT page_id,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path,
    TRY_CAST(regexp_extract(url, '://[^/?#]*/[^?#]*?([0-9]+)', 1) AS BIGINT) AS number FROM raws),
judged AS (SELECT page_id, host, path, bad FROM parts LEFT JOIN marks ON number = doc_id),
counts AS (SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
    string_split(host, '.')[-1] AS suffix, count(bad) AS n, coalesce(sum(bad), 0) AS bad
  FROM judged GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM counts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
{_shrunk("by_suffix", """SELECT suffix, n, bad,
  (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0.0) FROM suffixes) AS prior FROM suffixes""")},
{_shrunk("by_domain", """SELECT domain, suffix, d.n, d.bad, mean AS prior
  FROM domains d JOIN by_suffix USING (suffix)""")},
{_shrunk("by_host", """SELECT host, c.n, c.bad, mean AS prior
  FROM counts c JOIN by_domain USING (domain, suffix)""")},
ruled AS (SELECT page_id, host, path, CASE
    {_rule_cases()} END AS found FROM judged)
SELECT page_id, host, path, split_part(found, ' ', 1) AS rule,
  coalesce(split_part(found, ' ', 2), CASE WHEN lower_bound > {url_reputation.LIMIT} THEN 'block'
    ELSE 'allow' END) AS verdict,
  round(mean, 6) AS bad_rate, round(lower_bound, 6) AS bad_rate_low
FROM ruled JOIN by_host USING (host)"""



def _rules_sql() -> str:
    """The quality rules from scratch: measures, bins, quartiles of three levels, fences."""
    q = quality_rules
    gamma = (1 + q.ERROR) / (1 - q.ERROR)
    values = " UNION ALL ".join(
        f"SELECT rid, lang, source, '{n}' AS feature, {top} / nullif({low}, 0) AS v, "
        f"{'NULL' if below is None else below} AS below, {above} AS above FROM measures"
        for n, (top, low, below, above) in q.FEATURES.items())

    def level(name: str, keys: str) -> str:
        by = f"{keys}, feature" if keys else "feature"
        return f"""
{name}_cells AS (SELECT {by}, bin, sum(n) AS n FROM cells GROUP BY ALL),
{name}_placed AS (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bin) AS upto,
    sum(n) OVER (PARTITION BY {by}) AS total FROM {name}_cells),
{name} AS (SELECT {by}, max(total) AS total, min(bin) FILTER (WHERE upto >= total * 0.25) AS b1,
    min(bin) FILTER (WHERE upto >= total * 0.75) AS b3 FROM {name}_placed GROUP BY {by})"""

    def pick(b: str) -> str:
        one = (f"CASE WHEN o.total >= {q.MIN_ROWS} THEN o.{b} WHEN l.total >= {q.MIN_ROWS} "
               f"THEN l.{b} ELSE a.{b} END")
        return (f"CASE WHEN {one} = {q.ZERO_BIN} THEN 0.0 "
                f"ELSE pow({gamma!r}, {one}) * {2 / (gamma + 1)!r} END")

    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
listed AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
words AS (SELECT rid, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM listed),
windows AS (SELECT rid, i, w1, lead(w1) OVER (PARTITION BY rid ORDER BY i) AS w2,
    lead(w1, 2) OVER (PARTITION BY rid ORDER BY i) AS w3 FROM words),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w1, w2, w3) AS n FROM windows
  WHERE w3 IS NOT NULL),
repeats AS (SELECT rid, count(DISTINCT i + d) AS n_repeat_words
  FROM twice, (VALUES (0), (1), (2)) AS t(d) WHERE n >= 2 GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs),
line_counts AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
measures AS (SELECT d.*, len(w) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM docs d JOIN listed USING (rid) LEFT JOIN line_counts USING (rid)
  LEFT JOIN repeats USING (rid)),
vals AS ({values}),
cells AS (SELECT lang, source, feature, CASE WHEN v <= 0 THEN {q.ZERO_BIN}
    ELSE ceil(ln(v) / {q.bin_step()!r})::INT END AS bin, count(*) AS n
  FROM vals WHERE v IS NOT NULL GROUP BY ALL),
{level("own", "lang, source")},
{level("by_lang", "lang")},
{level("everything", "")},
quartiles AS (SELECT o.lang, o.source, o.feature, {pick("b1")} AS q1, {pick("b3")} AS q3
  FROM own o JOIN by_lang l USING (lang, feature) JOIN everything a USING (feature)),
tests AS (SELECT rid, bool_and(coalesce(v <= q3 + (q3 - q1) * {q.SPREAD} + above, true) AND
    coalesce(v >= q1 - (q3 - q1) * {q.SPREAD} - below, true)) AS within
  FROM vals LEFT JOIN quartiles USING (lang, source, feature) GROUP BY rid),
base AS (SELECT *, n_words < {q.MIN_WORDS} OR
    n_repeat_words * 100 > n_words * {q.MAX_REPEAT_PERCENT} AS base_failed FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND within AS kept FROM base JOIN tests USING (rid)"""


_LINES_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id,
    string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT rid, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM docs),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) ||
    chr(13)), {_LOWER}) AS key FROM lines),
shared AS (SELECT key, max(doc_id) AS keeper FROM keyed
  WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key
  HAVING count(DISTINCT rid) >= {line_dedup.MIN_DOCS}),
judged AS (SELECT k.*, coalesce(doc_id < keeper, doc_id IS NULL AND keeper IS NOT NULL) AS lost
  FROM keyed k LEFT JOIN shared USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY rid"""

_PHRASES_SQL = rf"""
WITH docs AS (SELECT coalesce(lang, '{phrases.NO_LANG}') AS lang, string_split_regex(
    translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]') AS p FROM documents),
pieces AS (SELECT lang, unnest(p) AS piece FROM docs),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
runs AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2),
    lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM words, range(1, {phrases.MAX_WORDS + 1}) AS t(m)),
f AS (SELECT lang, phrase, any_value(m) AS m, count(*) AS f FROM runs GROUP BY lang, phrase
  HAVING count(*) >= {phrases.MIN_COUNT}),
cands AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (SELECT c.*, k FROM cands c, range(1, {phrases.MAX_WORDS}) AS t(k) WHERE k < m),
scored AS (SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n,
    ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
weakest AS (SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_runs AS (SELECT lang, a, unnest(list_transform(range(1, m - s + 2),
    lambda i: array_to_string(w[i:i + s - 1], ' '))) AS phrase
  FROM cands, range(2, {phrases.MAX_WORDS}) AS t(s) WHERE s < m),
longest AS (SELECT lang, phrase, max(a) AS longer FROM inner_runs GROUP BY lang, phrase),
kept AS (SELECT w.* FROM weakest w LEFT JOIN longest USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < {phrases.ABSORB_PERCENT} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score FROM kept QUALIFY rank <= {phrases.TOP}"""

_TRIE_SQL = f"""
WITH turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      coalesce(text, '')) AS nth
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, conv_id - conv_id % {prefix_trie.BLOCK} AS base,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: list_reduce(
      [xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda v, z: CASE WHEN v & 1 = 1
        THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) % {prefix_trie.MOST_SHARED} AS h
  FROM turns),
taken AS (SELECT c.conv_id, nth AS place, role, text FROM convs c
  JOIN turns t ON t.conv_id = c.base AND t.nth <= h),
sizes AS (SELECT c.conv_id, h, count(place) AS m FROM convs c LEFT JOIN taken USING (conv_id)
  GROUP BY ALL),
rebuilt AS (SELECT * FROM taken UNION ALL SELECT conv_id, nth - h + m, role, text
  FROM turns JOIN sizes USING (conv_id) WHERE nth > h),
paths AS (SELECT conv_id, place AS depth, list(struct_pack(r := role, t := text)) OVER (
    PARTITION BY conv_id ORDER BY place) AS path, length(text) AS chars FROM rebuilt
  UNION ALL SELECT conv_id, 0, [], 0 FROM convs),
nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
    any_value(chars) AS chars FROM paths GROUP BY depth, path),
lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
ends AS (SELECT depth, path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest
  FROM paths JOIN lengths USING (conv_id, depth) GROUP BY depth, path),
kids AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n FROM nodes
  WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT o.*, coalesce(k.n, 0) AS n_children FROM nodes o LEFT JOIN kids k
  ON o.depth = k.depth AND o.path = k.path),
up AS (SELECT t.d AS depth, path[1:t.d] AS path, sum((n_children = 0)::INT)::BIGINT AS n_leaves,
    sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
  FROM full_nodes, LATERAL (SELECT unnest(range(0, depth + 1)) AS d) t GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, u.n_leaves,
  u.saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM full_nodes n JOIN up u ON n.depth = u.depth AND n.path = u.path
LEFT JOIN ends e ON n.depth = e.depth AND n.path = e.path
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]"""


ORACLES: dict[str, str] = {"op11_line_dedup": _LINES_SQL, "op12_phrases": _PHRASES_SQL,
                           "op13_prefix_trie": _TRIE_SQL,
                           "op6_quality_rules": _rules_sql(), "op9_url_filters": _URL_SQL}
