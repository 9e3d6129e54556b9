"""The registered queries of this subpackage, each with equivalent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.functions.storage import scratch_path
from shelfwise.llm import decontaminate, fingerprints, huffman, jaccard, packing, pii, quality, runs, secrets, sharding, token_counts, toxicity, whitening
from shelfwise.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    huffman.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return huffman.read_ids(spark, path)


def crc_of_id(divisor: int) -> Column:
    """The remainder of the checksum of doc_id as text, by which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=crc_of_id(3) != 1)
    held_out = F.coalesce(crc_of_id(3) == 1, F.lit(False))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


# The key of the registered query; a production run passes a secret of its own.
PSEUDONYM_KEY = b"registered query"


@query
def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=crc_of_id(4) != 2)
    held_out = F.coalesce(crc_of_id(4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), decontaminate.build(table(spark, sf_dir, "benchmark")))


@query
def op10_similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"), words=3, percent=90)


@query
def op5_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def _kind_sql(place: int, kind: str, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
    SELECT key, {place} AS i, '{kind}' AS kind, e - length(w) AS s, e, v FROM (
      SELECT key, w, v, CAST(sum(length(b) + coalesce(length(w), 0)) OVER (PARTITION BY key ORDER BY pos) AS BIGINT) AS e FROM (
        SELECT key, unnest(range(len(b))) AS pos, unnest(b) AS b, unnest(w) AS w, unnest(v) AS v FROM (
          SELECT key, string_split_regex(t, '{pattern}') AS b, regexp_extract_all(t, '{pattern}', 0) AS w, regexp_extract_all(t, '{pattern}', {group}) AS v
          FROM docs WHERE regexp_matches(t, '{pattern}'))))
    WHERE w IS NOT NULL AND length(v) >= {least}"""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
SQL["op5_secret_owners"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS key, doc_id, coalesce(source, '') AS owner, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
base AS (
  {_kind_sql(0, "assign", f"({_ASSIGN})" + secrets.KINDS["assign"][0].partition("))")[2], 2, 12)}
  UNION ALL {_kind_sql(1, "access", secrets.KINDS["access"][0], 1, 18)}
  UNION ALL {_kind_sql(2, "hex", secrets.KINDS["hex"][0], 1, 16)}),
candidates AS (SELECT DISTINCT key, e - length(v) AS s, e, v, owner, lang FROM base JOIN docs USING (key)),
spread AS (
  SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT (owner, lang)) AS repositories FROM candidates GROUP BY v),
judged AS (
  SELECT key, s, e, owners, repositories,
    CASE WHEN owners > {secrets.MAX_OWNERS} THEN 'example' WHEN len(list_distinct(string_split(v, ''))) >= {secrets.MIN_DISTINCT} THEN 'live' END AS kind
  FROM candidates JOIN spread USING (v)),
added AS (
  SELECT key, count(*) FILTER (kind = 'live') AS n_live, count(*) FILTER (kind = 'example') AS n_example,
    max(owners) AS max_owners, max(repositories) AS max_repositories FROM judged GROUP BY key),
spans AS (
  SELECT key, s, i, e, kind FROM base UNION ALL
  SELECT key, s, CASE kind WHEN 'live' THEN 3 ELSE 4 END, e, kind FROM judged WHERE kind IS NOT NULL),
listed AS (
  SELECT key, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, i, e) FILTER (i < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, i, e) AS spans FROM spans GROUP BY key)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  max_owners, max_repositories
FROM docs LEFT JOIN listed USING (key) LEFT JOIN added USING (key)"""


@query
def op8_paragraph_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def with_echoes(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of every tenth document by checksum, the words from some place on repeat what begins there.

    With h the checksum of the id and g = floor(h / 10): if h % 10 = 0, words i >= a = g % n become words
    a + (i - a) % p of the n words, p = 1 + floor((n - a) / (3 + g % 8)), which repeats them ten times at most.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    n, g = F.size("_words"), F.floor(F.col("_h") / 10)
    a = (F.col("_g") % n).cast("int")
    p = (1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int")
    head, cycle = F.slice("_words", 1, F.col("_a")), F.slice("_words", F.col("_a") + 1, F.col("_p"))
    echoed = F.concat_ws(" ", F.slice(F.concat(head, F.flatten(F.array_repeat(cycle, 11))), F.lit(1), n))
    numbered = docs.select("doc_id", "text", h.alias("_h"), words.alias("_words")).withColumn("_g", g)
    numbered = numbered.withColumn("_a", F.when(n > 0, a)).withColumn("_p", p)
    return numbered.select("doc_id", F.when(n > 0, echoed).otherwise(F.col("text")).alias("text"))


@query
def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.word_runs(with_echoes(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("longest", longest)
    length, period = F.col("longest.length"), -F.col("longest.short")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op12_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op13_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    fixed = embeddings.select("vec_id", whitening.fixed_point(embeddings, "embedding").alias("vector"))
    model = whitening.fit(fixed, 32)
    explained = F.array(*[F.lit(float(v) / model.trace) for v in model.values]).cast("array<double>")
    by_component = whitening.whiten(fixed, model).select("vec_id", "deviation", F.posexplode("whitened").alias("_i", "whitened"))
    return by_component.select(
        "vec_id", (F.col("_i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"), "whitened", explained[F.col("_i")].alias("explained"),
        F.lit(model.identity_error).alias("identity_error"))
