"""The registered queries of this package, with SQL twins where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from chainstrata.llm import (
    ann, bpe, cover_tree, importance, line_dedup, mixing, pii, quality, simhash, token_files, topk, toxicity, url_trust,
)
from chainstrata.llm.columns import BLANK, LOWER, UPPER, held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function
    return keep


_BLANK_SQL = " || ".join(f"chr({ord(c)})" for c in BLANK)
_MIX_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, CAST([{", ".join(map(str, mixing.WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS BIGINT) AS weight,
  source_size * {mixing.MOST} AS capacity, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * {mixing.SHARE} - coalesce(sum(capacity) OVER before, 0))
  / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level FROM w
  WINDOW before AS (ORDER BY capacity / CAST(weight AS DOUBLE), nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(CAST(capacity AS DOUBLE), max(level) OVER () * weight) AS target,
  CAST(CAST('0x' || substr(md5('{mixing.SEED}' || coalesce('=' || source, '')), 1, 4) AS INTEGER) AS DOUBLE) / 65536 AS start FROM l),
r AS (SELECT doc_id, size, source_size, target, start, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS step,
  CAST(row_number() OVER (PARTITION BY t.source ORDER BY size, doc_id) AS DOUBLE) AS nth
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(floor(step * nth + start) - floor(step * (nth - 1) + start) AS BIGINT) * size AS taken FROM r"""


def _url_sql() -> str:
    """Rules by CASE, scores by a recursive query of a fixed number of rounds, compared as the operator does."""
    longest_first = sorted(url_trust.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in longest_first]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, longest_first))
    verdict = " ".join(f"WHEN {f} THEN '{d}'" for f, (d, _, _) in zip(fits, longest_first))
    link = url_trust.LINK.replace("'", "''")
    flow = "".join(f""",
{name}_seed AS (SELECT host, n / sum(n) OVER () * (1 - {url_trust.STAY}) AS base FROM (SELECT host, CAST(count(*) AS DOUBLE) AS n FROM p
  WHERE host <> '' AND ruled = '{decision}' GROUP BY 1)),
{name}_rounds(i, host, score) AS (SELECT 0, host, base FROM {name}_seed UNION ALL
  SELECT i + 1, host, sum(score) FROM (SELECT i, e.target AS host, e.weight * r.score * {url_trust.STAY} AS score FROM {name}_rounds r
    JOIN {edges} e ON e.source = r.host UNION ALL SELECT x.i, s.host, s.base FROM (SELECT DISTINCT i FROM {name}_rounds) x, {name}_seed s)
  WHERE i < {url_trust.ROUNDS} GROUP BY i, host),
{name} AS (SELECT host, score FROM {name}_rounds WHERE i = {url_trust.ROUNDS})"""
                   for name, decision, edges in (("trust", "allow", "links"), ("distrust", "block", "back")))
    return f"""
WITH RECURSIVE u AS (SELECT page_id, html, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
p AS (SELECT page_id, html, host, path, CASE {rule} END AS rule, CASE {verdict} END AS ruled FROM u),
found AS (SELECT host AS source, unnest(regexp_extract_all(html, '{link}', 1)) AS target FROM p WHERE host <> ''),
counted AS (SELECT source, translate(target, '{UPPER}', '{LOWER}') AS target, count(*) AS n FROM found GROUP BY 1, 2),
links AS (SELECT source, target, n / sum(n) OVER (PARTITION BY source) AS weight FROM counted WHERE source <> target),
back AS (SELECT target AS source, source AS target, 1.0 / count(*) OVER (PARTITION BY target) AS weight FROM links){flow}
SELECT page_id, p.host, path, rule, coalesce(ruled, CASE WHEN coalesce(d.score, 0) > {url_trust.RATIO * (1 + url_trust.ALIKE)} * coalesce(t.score, 0) THEN 'block' ELSE 'allow' END) AS verdict,
  round(coalesce(t.score, 0.0), 6) AS trust, round(coalesce(d.score, 0.0), 6) AS distrust
FROM p LEFT JOIN trust t ON t.host = p.host LEFT JOIN distrust d ON d.host = p.host"""


@query(_url_sql())
def op1_url_trust(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_trust.judge(table(spark, sf, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("trust", 6).alias("trust"), F.round("distrust", 6).alias("distrust"))


@query(_MIX_SQL)
def op3_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"), carry=False)
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


@query(f"""
WITH v AS (SELECT vec_id, [CAST(floor({topk.SCALE} * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {topk.K}""")
def op4_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op10_one_bit_codes(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op2_token_files(spark: SparkSession, sf: str) -> DataFrame:
    tokens = token_files.round_trip(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours", "terms")


@query()
def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scored = quality.score(docs.select("doc_id", "text"), quality.train(docs, table(spark, sf, "labels")))
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query(f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT *, translate(trim(line, {_BLANK_SQL}), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY 1),
m AS (SELECT k.doc_id, pos, line, coalesce(k.doc_id > f.first_doc, false) AS dropped FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id""")
def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    lines = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return lines.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


@query()
def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", "fingerprint", "component_id", "links")


@query()
def op9_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


_ASCII = r"[^\x20\x09-\x0D]"
_RUN = r"\p{L}+"
_PII_FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _pii_sql() -> str:
    """Plain patterns, places by running sums, and the disclosures of the letter runs around the matches."""
    forms = ", ".join(f"({i}, '{k}', '{f}')" for i, (k, f) in enumerate(_PII_FORMS.items()))

    def runs(text: str) -> str:
        return f"list_distinct(list_filter(regexp_extract_all(lower({text}), '{_RUN}'), lambda w: len(w) BETWEEN 3 AND 40))"

    counts = ", ".join(f"CAST(count(*) FILTER (WHERE kind = {i}) AS BIGINT) AS n_{k}" for i, k in enumerate(_PII_FORMS))
    text = "name || ':' || s || ':' || e, ',' ORDER BY s, kind"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
cut AS (SELECT doc_id, kind, name, string_split_regex(body, form) AS gaps, regexp_extract_all(body, form) AS hits
  FROM d, (VALUES {forms}) f(kind, name, form)),
each AS (SELECT doc_id, kind, name, i, gaps[i] AS gap, hits[i] AS hit, gaps[i + 1] AS after
  FROM (SELECT *, unnest(generate_series(1, len(hits))) AS i FROM cut)),
placed AS (SELECT *, sum(len(gap) + len(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e,
  regexp_replace(hit, '[^0-9]', '', 'g') AS digits FROM each),
found AS (SELECT doc_id, kind, name, CAST(e - len(hit) AS BIGINT) AS s, CAST(e AS BIGINT) AS e, right(gap, {pii.CONTEXT}) AS head, left(after, {pii.CONTEXT}) AS tail,
  name || ':' || CASE kind WHEN 0 THEN lower(hit) WHEN 1 THEN hit ELSE digits END AS entity FROM placed
  WHERE CASE kind WHEN 1 THEN list_max([CAST(x AS HUGEINT) FOR x IN string_split(hit, '.')]) <= 255
    WHEN 2 THEN len(digits) BETWEEN 12 AND 19 AND list_sum([CASE WHEN (len(digits) - i) % 2 = 0 THEN CAST(digits[i] AS INTEGER)
      ELSE CAST(digits[i] AS INTEGER) * 2 - CASE WHEN digits[i] > '4' THEN 9 ELSE 0 END END FOR i IN range(1, len(digits) + 1)]) % 10 = 0
    WHEN 3 THEN len(digits) BETWEEN 9 AND 15 ELSE true END),
around AS (SELECT doc_id, entity, regexp_replace(CASE WHEN len(head) = {pii.CONTEXT} THEN regexp_replace(head, '^{_ASCII}+', '') ELSE head END || ' ' ||
  CASE WHEN len(tail) = {pii.CONTEXT} THEN regexp_replace(tail, '{_ASCII}+$', '') ELSE tail END, '{_ASCII}*@{_ASCII}*', ' ', 'g') AS context FROM found),
near AS (SELECT DISTINCT doc_id, entity, unnest({runs("context")}) AS term FROM around),
n_term AS (SELECT term, count(*) AS n_t FROM (SELECT unnest({runs("body")}) AS term FROM d) GROUP BY 1),
n_entity AS (SELECT entity, count(DISTINCT doc_id) AS n_c FROM found GROUP BY 1),
rated AS (SELECT entity, term, round(1 - ln(CAST(n_t AS DOUBLE) / n) / ln(CAST((SELECT count(*) FROM d) AS DOUBLE) / n_c), 9) AS disclosure
  FROM (SELECT entity, term, count(*) AS n FROM near GROUP BY 1, 2 HAVING count(*) >= {pii.LEAST_DOCUMENTS}) JOIN n_entity USING (entity) JOIN n_term USING (term)
  WHERE n_c < (SELECT count(*) FROM d)),
flagged AS (SELECT DISTINCT doc_id, term FROM near JOIN rated USING (entity, term) WHERE disclosure >= {pii.GENERALISE}),
words AS (SELECT doc_id, string_split_regex(body, '{_RUN}') AS gaps, regexp_extract_all(body, '{_RUN}') AS hits FROM d WHERE doc_id IN (SELECT doc_id FROM flagged)),
spots AS (SELECT doc_id, hit, sum(len(gap) + len(hit)) OVER (PARTITION BY doc_id ORDER BY i) AS e
  FROM (SELECT doc_id, i, gaps[i] AS gap, hits[i] AS hit FROM (SELECT *, unnest(generate_series(1, len(hits))) AS i FROM words))),
terms AS (SELECT w.doc_id, {len(pii.KINDS)} AS kind, '{pii.TERM_KIND}' AS name, CAST(w.e - len(hit) AS BIGINT) AS s, CAST(w.e AS BIGINT) AS e
  FROM spots w JOIN flagged f ON f.doc_id = w.doc_id AND f.term = lower(w.hit)
  WHERE NOT EXISTS (SELECT 1 FROM found b WHERE b.doc_id = w.doc_id AND b.s < w.e AND b.e > w.e - len(hit))),
spans AS (SELECT doc_id, kind, name, s, e FROM found UNION ALL SELECT * FROM terms),
per_doc AS (SELECT doc_id, {counts}, sha256(coalesce(string_agg({text}) FILTER (WHERE kind < {len(pii.KINDS)}), '')) AS base_sha256, string_agg({text}) AS spans
  FROM spans GROUP BY 1)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in _PII_FORMS)}, coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per_doc USING (doc_id)"""


@query(_pii_sql())
def op11_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf, "documents")))


def _importance_sql() -> str:
    """CRC-32 by a table of 256 numbers, folded over the bytes of each distinct word."""
    step = "list_reduce(list_concat([CAST({0} AS BIGINT)], range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    buckets, least = importance.BUCKETS, importance.LEAST_WORDS
    bytes_of = "list_transform(range(1, strlen(w) + 1), lambda i: CAST('0x' || substr(hex(w), 2 * i - 1, 2) AS BIGINT))"
    return f"""
WITH t AS (SELECT list({step.format("n")} ORDER BY n) AS crc FROM range(256) r(n)),
d AS (SELECT doc_id, {words} AS words FROM documents),
all_words AS (SELECT doc_id, unnest(words) AS w FROM d),
wanted AS (SELECT unnest({words}) AS w FROM benchmark),
coded AS (SELECT w, xor(list_reduce(list_concat([4294967295], {bytes_of}),
  lambda c, b: xor(c >> 8, crc[xor(c, b) % 256 + 1])), 4294967295) % {buckets} AS bucket
  FROM (SELECT DISTINCT w FROM (SELECT w FROM all_words UNION ALL SELECT w FROM wanted)), t),
s AS (SELECT bucket, count(*) AS n FROM all_words JOIN coded USING (w) GROUP BY 1),
g AS (SELECT bucket, count(*) AS n FROM wanted JOIN coded USING (w) GROUP BY 1),
gains AS (SELECT r.bucket, CAST(floor(1000 * ln((coalesce(g.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + {buckets}.0::DOUBLE)
  / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM g) + {buckets}.0::DOUBLE)))) AS BIGINT) AS gain
  FROM range({buckets}) r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN g USING (bucket)),
sums AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total FROM all_words JOIN coded USING (w) JOIN gains USING (bucket) GROUP BY 1),
weighed AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight
  FROM d LEFT JOIN sums USING (doc_id)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('{importance.SEED}:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5)
  / 4294967296))) AS BIGINT) AS score FROM weighed),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able FROM scored WHERE n_features >= {least})
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= able * {importance.SHARE[0]} // {importance.SHARE[1]} THEN rank END AS rank
FROM scored s LEFT JOIN ranked r USING (doc_id)"""


@query(_importance_sql())
def op12_importance(spark: SparkSession, sf: str) -> DataFrame:
    drawn = importance.draw(importance.weigh(table(spark, sf, "documents"), table(spark, sf, "benchmark")))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def _codes_sql() -> str:
    """Every round compares all parts with all entries."""
    most = cover_tree.PARTS
    rounds = "".join(f""",
near{i} AS (SELECT vec_id, label, part, arg_min(entry, (gap, entry)) AS entry, min(gap) AS gap FROM (
  SELECT x.vec_id, x.label, x.part, c.entry, CAST(list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS gap
  FROM x JOIN book{i} c USING (part)) GROUP BY 1, 2, 3)""" + (f""",
book{i + 1} AS (SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM book{i} c LEFT JOIN (
  SELECT part, entry, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v FROM (
    SELECT part, entry, place, sum(value) AS total, count(*) AS n FROM (
      SELECT part, entry, unnest(v) AS value, unnest(range(len(v))) AS place FROM near{i} JOIN x USING (vec_id, part)) GROUP BY 1, 2, 3) GROUP BY 1, 2) m
  USING (part, entry))""" if i < cover_tree.ROUNDS else "") for i in range(cover_tree.ROUNDS + 1))
    last = cover_tree.ROUNDS
    return f"""
WITH kept AS (SELECT vec_id, label, [CAST(floor({cover_tree.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
x AS (SELECT vec_id, label, part, v[len(v) // {most} * part + 1:len(v) // {most} * (part + 1)] AS v FROM kept, range({most}) r(part)),
book0 AS (SELECT part, entry, v FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM x) WHERE entry < {cover_tree.ENTRIES}){rounds},
codes AS (SELECT vec_id, label, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(gap) AS BIGINT) AS error FROM near{last} GROUP BY 1, 2),
digest AS (SELECT sha256(string_agg(value, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM (
  SELECT part, entry, unnest(v) AS value, unnest(range(len(v))) AS place FROM book{last}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes, digest"""


@query(_codes_sql())
def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded, codebooks = cover_tree.compress(table(spark, sf, "embeddings"))
    digest = F.lit(cover_tree.codebook_digest(codebooks)).alias("codebooks_sha256")
    return cover_tree.with_label_error(coded).select("vec_id", "code", "error", "label_error", digest)
