"""Queries of the training-data operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op5_byte_shards")
def op5_byte_shards(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.sharding import assign_shards
    placed = assign_shards(table(spark, sf, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op10_linear_grouping")
def op10_linear_grouping(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.grouping import pack_documents
    return pack_documents(table(spark, sf, "documents"))


@query("op4_gray_simhash")
def op4_gray_simhash(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.gray import fingerprint_classes
    found = fingerprint_classes(table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op8_random_indexing_quality")
def op8_random_indexing_quality(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.quality import quality_scores
    scored = quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op9_hyperdimensional_language")
def op9_hyperdimensional_language(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.language import languages
    return languages(table(spark, sf, "documents"))


@query("op1_packed_rows")
def op1_packed_rows(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.packed import packed_rows
    return packed_rows(table(spark, sf, "documents"))


@query("op6_weighted_simhash")
def op6_weighted_simhash(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.fingerprints import edited_fingerprints, near_counts
    from riskweave.session import settle
    made = settle(edited_fingerprints(table(spark, sf, "documents")), "edited")
    near = near_counts(made.select("lanes").distinct())
    words = lambda c: F.lower(F.concat(*(F.lpad(F.hex(F.col(c)[i]), 16, "0") for i in range(2))))
    return made.join(near, "lanes", "left").select(
        "doc_id", "n_chars", "edited_sha256", words("lanes").alias("fingerprint"), words("edited_lanes").alias("edited_fingerprint"),
        "near_edited", "near_next", F.coalesce("near", F.lit(0)).alias("near_fingerprints"))


@query("op7_template_leaks")
def op7_template_leaks(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.templates import leaks
    return leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("__text").distinct()


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.licenses import license_spans
    return license_spans(table(spark, sf, "documents"))


@query("op3_url_words")
def op3_url_words(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.urls import Rule, url_verdicts
    rules = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]
    pages = table(spark, sf, "pages")
    return url_verdicts(pages, rules, pages)


@query("op12_minimizer_runs")
def op12_minimizer_runs(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.runs import periodic_runs, run_digest, with_repeated_tails
    return run_digest(periodic_runs(with_repeated_tails(table(spark, sf, "documents"))))


@query("op11_flow_mix")
def op11_flow_mix(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.mixing import mix
    made = mix(table(spark, sf, "documents"), (5, 2, 1))
    # a document of this table has one source
    of = made.sources.select(F.to_json(F.array("source")).alias("pattern"), "source_size", "target")
    return made.rows.join(of, "pattern").select("doc_id", "size", "source_size", "target", "taken")


PHRASE_SQL = """
WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (SELECT lang, size, unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
      FROM w, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size),
c AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE size = 1 GROUP BY lang),
k AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM c WHERE size > 1 AND f >= 10),
s AS (SELECT k.lang, k.size, k.phrase, k.a, k.k, x.f AS l, y.f AS r, (1000000::HUGEINT * k.a * k.a) // (x.f::HUGEINT * y.f) AS score
      FROM k JOIN c x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1:k.k], ' ')
             JOIN c y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1:k.size], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
t AS (SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase
      FROM c WHERE size = 3 AND f >= 10),
kept AS (SELECT * FROM b WHERE size = 3 OR NOT EXISTS (
      SELECT 1 FROM t WHERE t.lang = b.lang AND t.phrase = b.phrase AND 100 * t.f >= 50 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""


@query("op13_shard_phrases", PHRASE_SQL)
def op13_shard_phrases(spark: SparkSession, sf: str) -> DataFrame:
    from riskweave.llm.phrases import collocations, first_phrases
    found = first_phrases(collocations(table(spark, sf, "documents")), 2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
