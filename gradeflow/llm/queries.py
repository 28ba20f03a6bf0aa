"""The operators as registered queries over the given tables, each next to its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeflow.llm import (
    bpe,
    clustering,
    embeddings,
    licenses,
    mixing,
    packing,
    quality,
    simhash,
    substrings,
    suffixes,
    tokencount,
    vectorcodes,
    warc,
)
from gradeflow.llm.common import stored, table

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


#: Words of a text, as every SQL below takes them: none if it is null or blank.
WORDS = r"""list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')"""


@query(
    rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents
), places AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS run
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM docs WHERE len(w) >= 8)
), twice AS (
  SELECT r, i FROM places QUALIFY count(*) OVER (PARTITION BY r, run) > 1
), hit AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY r
), rows_of AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '') AS lines,
    coalesce(n, 0) AS n_repeat_words
  FROM docs LEFT JOIN hit USING (r)
), measured AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines FROM rows_of
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    CAST(CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
      + CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
      + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
      AS BIGINT) AS failed
  FROM measured
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, failed = 0 AS kept,
  CAST(n_lines AS BIGINT) AS n_lines, failed, sole_rule,
  CASE WHEN sole_rule IS NOT NULL THEN CAST(count(*) OVER (PARTITION BY sole_rule) AS BIGINT) END AS n_sole
FROM (
  SELECT *, CASE failed WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_words' WHEN 4 THEN 'symbols'
    WHEN 8 THEN 'repeated_lines' WHEN 16 THEN 'short_words' WHEN 32 THEN 'long_words' END AS sole_rule
  FROM judged
)
"""
)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failed rules, verdict of the current policy and ablation of the one rule at fault."""
    book = stored(quality.ledger(table(spark, sf_dir, "documents")), "quality-ledger")
    return quality.judged(book).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality.rejected_by(F.col("failed"), "base").alias("base_failed"),
        (~quality.rejected_by(F.col("failed"), quality.CURRENT)).alias("kept"),
        "n_lines",
        "failed",
        "sole_rule",
        "n_sole",
    )


@query()
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and the smallest doc_id that links lead to."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


PLACES = rf"""
docs AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents
), places AS (
  SELECT r, doc_id, len(w) AS n, i, array_to_string(w[i:i + {{last}}], ' ') AS run
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {{last}} + 1)) AS i FROM docs WHERE len(w) > {{last}})
)"""


@query(
    f"""
WITH {PLACES.format(last=34)}, hit AS (
  SELECT r, i FROM places QUALIFY count(*) OVER (PARTITION BY run) > 1
), gone AS (
  SELECT r, list(DISTINCT j) AS js FROM (SELECT r, unnest(range(i, i + 35)) AS j FROM hit) GROUP BY r
), words AS (
  SELECT r, list(word ORDER BY j) AS left_over FROM (
    SELECT docs.r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j, coalesce(js, []) AS js
    FROM docs LEFT JOIN gone USING (r)
  ) WHERE NOT list_contains(js, j) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(len(left_over), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(left_over, ' '), '')) AS kept_sha256
FROM docs LEFT JOIN words USING (r)
"""
)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the windows of 35 words that occur elsewhere."""
    found = substrings.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", substrings.digests(F.col("text"), F.col("places")).alias("d")).select("doc_id", "d.*")


@query(
    f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, substr(md5(text), 1, 8) AS tag, {WORDS} AS w
  FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents)
), places AS (
  SELECT r, doc_id, tag, i, array_to_string(w[i:i + 49], ' ') AS run
  FROM (SELECT r, doc_id, tag, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) > 49)
), ranked AS (
  SELECT r, doc_id, i, count(*) OVER (PARTITION BY run) AS n,
    row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS LAST, tag, i) > 1 AS later
  FROM places
), marks AS (
  SELECT r, doc_id, j, max(later) AS gone
  FROM (SELECT r, doc_id, later, unnest(range(i, i + 50)) AS j FROM ranked WHERE n > 1) GROUP BY r, doc_id, j
), islands AS (
  SELECT r, doc_id, j, gone, j - row_number() OVER (PARTITION BY r ORDER BY j) AS island FROM marks
)
SELECT doc_id, CAST(min(j) - 1 AS BIGINT) AS start_word, CAST(count(*) AS BIGINT) AS n_words,
  CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed
FROM islands GROUP BY r, doc_id, island
"""
)
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of words that lie in a repeated passage of 50 words or more, and how many of them go."""
    return suffixes.spans(table(spark, sf_dir, "documents"))


@query()
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return packing.packed(table(spark, sf_dir, "documents"))


@query(
    """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS n, sha1(html) AS digest FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest) AS largest FROM d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < largest THEN largest END AS refers_to
FROM g
"""
)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to seekable bundles and read back."""
    found = warc.archived(table(spark, sf_dir, "pages"), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


def template_values() -> str:
    rows = [
        f"({k}, {len(t)}, {licenses.scale(len(t))}, '{label}', {base}, {i}, '{t[i].decode()} {t[i + 1].decode()}')"
        for k, (t, label, base) in enumerate(licenses.TEMPLATES)
        for i in range(len(t) - 1)
    ]
    return ", ".join(rows)


@query(
    rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), templates AS (
  SELECT * FROM (VALUES {template_values()}) AS v(template, size, scale, label, base, place, pair)
), hits AS (
  SELECT r, template, size, scale, label, base, pos - place AS diagonal, place
  FROM (SELECT r, unnest(range(1, len(w))) - 1 AS pos, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pair FROM docs)
  JOIN templates USING (pair)
), votes AS (
  SELECT r, template, size, scale, label, base, diagonal, count(*) AS votes, list(place) AS places
  FROM hits GROUP BY ALL
), whole AS (
  SELECT r, label, base, diagonal AS start, 1.0::DOUBLE AS score FROM votes WHERE base AND votes = size - 1
), merged AS (
  SELECT r, label, base, size, diagonal AS start, sum(votes) OVER near AS votes,
    list(list_transform(places, lambda x: struct_pack(at := diagonal + x, down := -x))) OVER near AS points
  FROM votes WHERE NOT base
  WINDOW near AS (PARTITION BY r, template ORDER BY diagonal * scale RANGE BETWEEN CURRENT ROW AND {licenses.REACH} FOLLOWING)
), ordered AS (
  SELECT r, label, base, size, start, list_transform(list_sort(list_distinct(list_concat(flatten(points),
    list_transform(flatten(points), lambda p: struct_pack(at := p.at + 1, down := p.down - 1))))), lambda p: [-p.down]) AS places
  FROM merged WHERE 2 * votes >= {licenses.COVER} * size
), lines AS (
  SELECT r, label, base, start, len(list_reduce(places, lambda ends, x: list_concat(
    list_filter(ends, lambda y: y < x[1]), x, ends[len(list_filter(ends, lambda y: y < x[1])) + 2:])))::DOUBLE / size AS score
  FROM ordered
), found AS (
  SELECT * FROM whole UNION ALL SELECT * FROM lines WHERE score >= {licenses.COVER}
), told AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ','), '') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(score) AS score
  FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0) AS score
FROM docs LEFT JOIN told USING (r)
"""
)
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and lines of every document."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query(
    """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), ok AS (
  SELECT r, vec_id, label, e, sqrt(list_dot_product(e, e)) AS size FROM v
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS ra, b.r AS rb, a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
    AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v LEFT JOIN (SELECT ra AS r, count(*) AS n FROM links GROUP BY ra) USING (r)
  LEFT JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) USING (vec_id)
"""
)
def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


#: What the labels say: documents of quality that are not toxic, toxic ones, poor ones.
DOMAINS = ("plain", "toxic", "poor")
TARGETS = (0.92, 0.03, 0.05)


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = F.expr("CASE WHEN quality = 0 THEN 2 WHEN toxic = 1 THEN 1 WHEN quality = 1 AND toxic = 0 THEN 0 END")
    return table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))


@query()
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memberships, rate and copies of every document; how far the shares stay off their targets."""
    found = mixing.mixed(table(spark, sf_dir, "documents"), domains(spark, sf_dir), list(TARGETS))
    shares = [(F.col(f"q{k}") / mixing.GRID).alias(f"p_{name}") for k, name in enumerate(DOMAINS)]
    return found.select("doc_id", "n_tokens", *shares, "rate", "copies", "miss")


@query()
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text that they decode to, as digests."""
    found = bpe.encoded(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2(bpe.decoded(F.col("ids")), 256).alias("decoded_sha256"),
    )


def whole_vectors(unit: int, usable: str) -> str:
    """SQL of the vectors as integers: r numbers the rows, v holds floor(unit * x)."""
    return f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({unit} * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE {usable} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""


def sql_rounds(size: int, entries: int, rounds: int) -> str:
    """SQL of the rounds over ``pieces0`` (r, p, v) and ``book0`` (p, c, m), up to near{rounds} and book{rounds}."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT r, p, any_value(v) AS v, min(CAST(list_inner_product(v, v) - 2 * list_inner_product(v, m) + list_inner_product(m, m) AS BIGINT) * {entries} + c) AS z
  FROM pieces0 JOIN book{k} USING (p) GROUP BY r, p
)""")
        if k < rounds:
            steps.append(f"""sums{k} AS (
  SELECT p, z % {entries} AS c, j, sum(x) AS s, count(*) AS n
  FROM (SELECT p, z, unnest(v) AS x, unnest(range({size})) AS j FROM near{k}) GROUP BY ALL
), book{k + 1} AS MATERIALIZED (
  SELECT p, c, coalesce(new.m, book{k}.m) AS m FROM book{k} LEFT JOIN (
    SELECT p, c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM sums{k} GROUP BY p, c
  ) AS new USING (p, c)
)""")
    return ", ".join(steps)


@query(
    f"""
WITH {whole_vectors(clustering.UNIT, "len(embedding) = 64")}, pieces0 AS (
  SELECT r, 0 AS p, v FROM kept
), book0 AS MATERIALIZED (
  SELECT 0 AS p, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c, v AS m FROM kept
  QUALIFY c < {clustering.CLUSTERS}
), {sql_rounds(64, clustering.CLUSTERS, clustering.ROUNDS)}, found AS (
  SELECT r, CAST(z % 16 AS INTEGER) AS cluster, z // 16 AS distance FROM near3
)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM kept JOIN found USING (r) JOIN book3 ON c = cluster
"""
)
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every whole vector of 64 components, after three rounds."""
    return clustering.clustered(table(spark, sf_dir, "embeddings"))


@query(
    f"""
WITH {whole_vectors(vectorcodes.UNIT, "len(embedding) > 0 AND len(embedding) % 8 = 0")}, pieces0 AS (
  SELECT r, p, list_slice(v, p * len(v) // 8 + 1, (p + 1) * len(v) // 8) AS v FROM (SELECT r, v, unnest(range(8)) AS p FROM kept)
), book0 AS MATERIALIZED (
  SELECT p, c, pieces0.v AS m
  FROM pieces0 JOIN (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS c FROM kept) USING (r)
  WHERE c < {vectorcodes.ENTRIES}
), {sql_rounds(8, vectorcodes.ENTRIES, vectorcodes.ROUNDS)}, found AS (
  SELECT r, string_agg(printf('%02x', z % 16), '' ORDER BY p) AS code, CAST(sum(z // 16) AS BIGINT) AS error
  FROM near6 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(m, ','), ',' ORDER BY p, c)) FROM book6) AS codebooks_sha256
FROM kept JOIN found USING (r)
"""
)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector, eight parts of sixteen entries, after six rounds."""
    return vectorcodes.compressed(table(spark, sf_dir, "embeddings"))
