"""One query per operator, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.catalog import QueryFunction
from basinspark.llm.common import table, words

QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(function: QueryFunction) -> QueryFunction:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query(r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         row_number() OVER () AS row_no
  FROM documents),
windows AS (
  SELECT row_no, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT row_no, words, unnest(range(1, len(words) - 3)) AS i FROM docs WHERE len(words) >= 5)),
again AS (SELECT row_no, i FROM (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, w) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT row_no, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(0, 5)) AS k) GROUP BY row_no),
lines AS (
  SELECT row_no, source, text, line,
         trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm,
         len(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
  FROM (SELECT row_no, source, text, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
duplicates AS (SELECT row_no, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY row_no),
kinds AS (SELECT source, text, norm, max(chars) AS chars FROM lines GROUP BY ALL),
hosts AS (SELECT source, count(DISTINCT text) AS host_texts FROM kinds GROUP BY ALL),
frequent AS (
  SELECT k.source, k.norm FROM kinds k JOIN hosts h ON k.source IS NOT DISTINCT FROM h.source
  GROUP BY k.source, k.norm, h.host_texts HAVING count(*) > 20 AND count(*) > 0.005::DOUBLE * h.host_texts),
losses AS (
  SELECT k.source, k.text, sum(k.chars) AS line_chars, coalesce(sum(k.chars) FILTER (f.norm IS NOT NULL), 0) AS removed_chars,
         count(f.norm) AS removed_lines
  FROM kinds k LEFT JOIN frequent f ON k.source IS NOT DISTINCT FROM f.source AND k.norm = f.norm GROUP BY k.source, k.text),
base AS (
  SELECT d.doc_id, d.source, d.text, CAST(len(words) AS BIGINT) AS n_words, CAST(len(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(d.text) - len(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(u.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM docs d LEFT JOIN duplicates u USING (row_no) LEFT JOIN repeats r USING (row_no))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
       NOT failed AND NOT coalesce(removed_chars > 0.5::DOUBLE * line_chars, false) AS kept,
       CAST(coalesce(removed_lines, 0) AS BIGINT) AS removed_lines, CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS failed FROM base) b
LEFT JOIN losses l ON b.source IS NOT DISTINCT FROM l.source AND b.text = l.text
""")
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and the verdict of cross-document line frequency, the source being the host."""
    from basinspark.llm.quality_rules import quality_verdicts

    return quality_verdicts(table(spark, folder, "documents"))


_LEVEL = """
  SELECT {key}, sum(bad) AS bad, sum(pages) AS pages,
         CASE WHEN count(*) < 2 THEN 2.0 WHEN rate * (1 - rate) <= 0 OR sum(pages) <= count(*)
                OR sum(spread) - count(*) * rate * (1 - rate) <= 0 THEN 1000.0
              ELSE greatest(2.0, least(1000.0, 1 / ((sum(spread) - count(*) * rate * (1 - rate))
                / (rate * (1 - rate) * (sum(pages) - count(*)))) - 1)) END::DOUBLE AS weight
  FROM (SELECT *, pages * (bad / pages - rate) ^ 2 AS spread
        FROM (SELECT *, sum(bad) OVER (PARTITION BY {key}) / sum(pages) OVER (PARTITION BY {key}) AS rate FROM {children}))
  GROUP BY {key}, rate"""


@query(
    r"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path FROM parts),
rules(rule, rule_verdict, rule_host, rule_path) AS (
  VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
         ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')),
ruled AS (
  SELECT page_id, arg_max(rule, len(rule)) AS rule, arg_max(rule_verdict, len(rule)) AS rule_verdict
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id),
hosts AS (
  SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix, 1 AS every,
         sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END)::DOUBLE AS bad, count(*)::DOUBLE AS pages
  FROM split JOIN labels ON doc_id = TRY_CAST(regexp_extract(path, '^/[^/]*/([0-9]+)', 1) AS BIGINT) GROUP BY host),
domains AS ("""
    + _LEVEL.format(key="domain", children="hosts")
    + r"""),
named AS (SELECT d.*, suffix FROM domains d JOIN (SELECT domain, any_value(suffix) AS suffix FROM hosts GROUP BY 1) USING (domain)),
suffixes AS ("""
    + _LEVEL.format(key="suffix", children="named")
    + r"""),
all_suffixes AS (SELECT *, 1 AS every FROM suffixes),
everything AS ("""
    + _LEVEL.format(key="every", children="all_suffixes")
    + r"""),
suffix_rates AS (
  SELECT suffix, rate, weight, rate - 1.645 * sqrt(rate * (1 - rate) / (n + 1)) AS bound
  FROM (SELECT s.suffix, (s.bad + e.weight * (e.bad / e.pages)) / (s.pages + e.weight) AS rate, s.weight, s.pages + e.weight AS n
        FROM all_suffixes s JOIN everything e USING (every))),
domain_rates AS (
  SELECT domain, rate, weight, rate - 1.645 * sqrt(rate * (1 - rate) / (n + 1)) AS bound
  FROM (SELECT n.domain, (n.bad + s.weight * s.rate) / (n.pages + s.weight) AS rate, n.weight, n.pages + s.weight AS n
        FROM named n JOIN suffix_rates s USING (suffix))),
reputation AS (
  SELECT host, pages, mean, mean - 1.645 * sqrt(mean * (1 - mean) / (n + 1)) AS bound
  FROM (SELECT h.host, h.pages, (h.bad + d.weight * d.rate) / (h.pages + d.weight) AS mean, h.pages + d.weight AS n
        FROM hosts h JOIN domain_rates d USING (domain))),
placed AS (
  SELECT *, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix,
         (SELECT bad / pages FROM everything) AS prior
  FROM split),
nearest AS (
  SELECT p.*, r.pages, coalesce(r.mean, CASE WHEN host <> '' THEN coalesce(d.rate, s.rate) END, prior) AS mean,
         coalesce(r.bound, CASE WHEN host <> '' THEN coalesce(d.bound, s.bound) END, prior, 0) AS bound
  FROM placed p LEFT JOIN reputation r USING (host) LEFT JOIN domain_rates d USING (domain) LEFT JOIN suffix_rates s USING (suffix))
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(pages, 0)::BIGINT AS labelled_pages, round(mean, 9) AS bad_rate
FROM nearest LEFT JOIN ruled USING (page_id)
"""
)
def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Rule verdicts of every page url, and host reputation where no rule fits.

    The outcome of a page is the label of the document that it shows, whose number follows the language in its path.
    """
    from basinspark.llm.url_reputation import Rule, judged_urls, url_parts

    pages, labels = table(spark, folder, "pages"), table(spark, folder, "labels")
    number = F.regexp_extract(url_parts(F.col("url"))[1], "^/[^/]*/([0-9]+)", 1)
    shown = pages.select("url", number.try_cast("long").alias("doc_id"))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    outcomes = shown.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("url", "bad")
    rules = [
        Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
        Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
    ]
    return judged_urls(pages, outcomes, rules)


@query(r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS seeded
  FROM documents),
sources AS (
  SELECT source, sum(size) AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM docs GROUP BY source),
ranked AS (
  SELECT *, 2 * source_size / weight AS ratio,
         sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS capped,
         sum(weight) OVER (ORDER BY 2 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM sources),
levels AS (SELECT *, (total - coalesce(capped, 0)) / open_weight AS level FROM ranked),
chosen AS (SELECT arg_min(level, ratio) AS level FROM levels WHERE level <= ratio),
targets AS (SELECT source, source_size, least(2 * source_size, c.level * weight)::DOUBLE AS target FROM levels, chosen c),
placed AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (
           PARTITION BY source ORDER BY seeded, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, round(target, 6) AS target,
       CAST(greatest(0, least(floor(target + 1e-6) - before, size)) + greatest(0, least(floor(target + 1e-6) - source_size - before, size)) AS BIGINT) AS taken
FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source
""")
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken from every document; each document has one source here, so each pattern is one source."""
    from basinspark.llm.mixing import mixed

    docs = table(spark, folder, "documents")
    rows = mixed(docs, "doc_id", F.size(words(F.col("text"))), F.array("source"))
    return rows.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query()
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language, score and number of spans of every document."""
    from basinspark.llm.common import remainder
    from basinspark.llm.language_spans import fit_languages, identified

    docs, held_out = table(spark, folder, "documents"), remainder("doc_id", 4) == 2
    rows = identified(docs, fit_languages(docs.where(~held_out)), [F.col("doc_id"), held_out.alias("held_out")])
    return rows.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


@query()
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score, prediction and toxic offsets of every document."""
    from basinspark.llm.common import remainder
    from basinspark.llm.toxic_spans import fit_toxicity, toxicity_scored

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = remainder("doc_id", 5) == 0
    model = fit_toxicity(docs, labels.where(~held_out))
    rows = toxicity_scored(docs, model, [F.col("doc_id"), held_out.alias("held_out")])
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return rows.select("doc_id", "held_out", "score", predicted.alias("predicted"), "offsets")


@query()
def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    from basinspark.llm.extraction import extracted

    return extracted(table(spark, folder, "pages"))


@query()
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Confirmed license notices of every document with the differences in wording."""
    from basinspark.llm.licenses import scanned

    return scanned(table(spark, folder, "documents"))


@query()
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds, with edits and place."""
    from basinspark.llm.decontamination import with_leaks

    rows = with_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"), [F.col("doc_id")])
    return rows.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query()
def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Set size, class and component of every document."""
    from basinspark.llm.ngram_join import near_duplicates

    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query()
def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram and attention-model log10 probability of every document."""
    from basinspark.llm.attention_lm import scored
    from basinspark.llm.common import remainder

    docs, held_out = table(spark, folder, "documents"), remainder("doc_id", 10) == 0
    return scored(docs, held_out, [F.col("doc_id"), held_out.alias("held_out")])


@query(r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, text, tokens, CAST(len(tokens) AS BIGINT) AS n, CAST(CAST('0x' || h[1:8] AS UBIGINT) AS BIGINT) AS h1,
         CAST(CAST('0x' || h[9:16] AS UBIGINT) AS BIGINT) AS h2, CAST(CAST('0x' || h[17:24] AS UBIGINT) AS BIGINT) AS h3,
         CAST(CAST('0x' || h[25:32] AS UBIGINT) AS BIGINT) AS h4
  FROM docs),
placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle,
         array_to_string(tokens[b + 1:n], '') AS suffix
  FROM placed),
outputs AS (
  SELECT *, CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END AS output
  FROM parts),
marks AS (SELECT *, strpos(output, '<P>') AS p, strpos(output, '<S>') AS s, strpos(output, '<M>') AS m FROM outputs)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(len(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(len(middle) AS BIGINT) END AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'psm' THEN output[4:s - 1] || output[m + 3:] || output[s + 3:m - 1]
                        WHEN 'spm' THEN output[p + 3:m - 1] || output[m + 3:] || output[4:p - 1] ELSE output END) AS restored_sha256
FROM marks
""")
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Form, cuts and hashes of every transformed document, and of the document rebuilt from it."""
    from basinspark.llm.fill_in_middle import fill_in_middle, restored

    facts = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    rows = fill_in_middle(table(spark, folder, "documents"), [F.col("doc_id")])
    return restored(rows, [F.col(c) for c in facts], with_text=False)


@query(r"""
WITH payloads AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
groups AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM payloads)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN other THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN other THEN top END AS refers_to
FROM (SELECT *, payload_bytes >= 1000 AND top IS NOT NULL AND page_id IS DISTINCT FROM top AS other FROM groups)
""")
def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC archives and read back, revisits through the capture index."""
    from basinspark.llm.web_archive import read_back, written

    pages = table(spark, folder, "pages")
    kind = pages.schema["page_id"].dataType
    rows = read_back(written(pages))
    return rows.withColumns({name: F.col(name).cast(kind) for name in ("page_id", "refers_to")})


_ROUND = r"""
near{i} AS MATERIALIZED (
  SELECT id, part, arg_min(entry, error) AS entry, min(error) AS error FROM (
    SELECT v.id, v.part, c.entry, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + c.entry AS error
    FROM vectors v JOIN books{i} c ON v.part = c.part)
  GROUP BY id, part),"""
_MEANS = r"""
sums{i} AS (
  SELECT part, entry, place, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x
  FROM (SELECT n.part, n.entry, unnest(v.x) AS x, generate_subscripts(v.x, 1) AS place FROM near{i} n JOIN vectors v ON n.id = v.id AND n.part = v.part)
  GROUP BY part, entry, place),
means{i} AS (SELECT part, entry, list(x ORDER BY place) AS x FROM sums{i} GROUP BY part, entry),
books{j} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM books{i} b LEFT JOIN means{i} m ON b.part = m.part AND b.entry = m.entry),"""


@query(
    r"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
vectors AS MATERIALIZED (
  SELECT id, part, x[part * len(x) // 16 + 1:(part + 1) * len(x) // 16] AS x FROM kept, (SELECT unnest(range(0, 16)) AS part)),
books0 AS MATERIALIZED (SELECT part, id - 1 AS entry, x FROM vectors WHERE id <= 64),"""
    + "".join(_ROUND.format(i=i) + _MEANS.format(i=i, j=i + 1) for i in (0, 1))
    + _ROUND.format(i=2)
    + r"""
coded AS (
  SELECT id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum((error - entry) // 64) AS BIGINT) AS error FROM near2 GROUP BY id),
digest AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(x) AS x, generate_subscripts(x, 1) AS place FROM books2))
SELECT vec_id, code, error, label, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (id), digest
"""
)
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes, errors and errors by label of every kept vector."""
    from basinspark.llm.vector_codes import coded

    return coded(table(spark, folder, "embeddings"))


@query()
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    from corpus_pipeline import run

    return run(spark, folder)
