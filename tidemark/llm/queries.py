"""The numbered operators as queries over the driver's tables, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.audit import audit
from tidemark.llm.classlm import lm_scores
from tidemark.llm.decontaminate import contamination
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.linededup import repeated_units
from tidemark.llm.minhash import near_dedup
from tidemark.llm.mixing import mix
from tidemark.llm.pii import find_pii
from tidemark.llm.quality import fit_quality, scored
from tidemark.llm.search import ranked_search
from tidemark.llm.sharding import shard
from tidemark.llm.toxicity import fit_toxicity
from tidemark.llm.warc import warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Weights of the sources in code point order, repeating.
MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED = [5, 2, 1], 3, "tidemark"
SHARDS = 16


def query(name: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


@query(
    "op1_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, f"{sf_dir}/documents.parquet")


@query(
    "op4_source_mix",
    r"""
    WITH sized AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
               md5('tidemark:' || coalesce(doc_id::VARCHAR, '')) AS h
        FROM documents),
    per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    ranked AS (
        SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rnk FROM per),
    weighed AS (
        SELECT *, [5.0, 2.0, 1.0][((rnk - 1) % 3) + 1]::DOUBLE AS weight, (source_size * 3)::DOUBLE AS cap FROM ranked),
    needed AS (SELECT *, cap / weight AS need FROM weighed),
    tried AS (
        SELECT *, ((SELECT sum(source_size) FROM per)::DOUBLE
                   - coalesce(sum(cap) OVER before, 0.0))
                  / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0.0)) AS attempt
        FROM needed WINDOW before AS (ORDER BY need, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (SELECT attempt AS lvl FROM tried WHERE attempt <= need ORDER BY need, rnk LIMIT 1),
    targets AS (
        SELECT source, source_size, CASE WHEN need <= lvl THEN cap ELSE lvl * weight END AS target FROM tried, level),
    fitted AS (
        SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS epochs FROM targets),
    walked AS (
        SELECT s.doc_id, s.size, f.source_size, f.target, f.epochs,
               round(f.target - f.epochs * f.source_size)::BIGINT
               - coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id, s.size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
        FROM sized s JOIN fitted f ON s.source IS NOT DISTINCT FROM f.source)
    SELECT doc_id, size, source_size, target,
           (epochs * size + greatest(least(room, size), 0))::BIGINT AS taken
    FROM walked
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs, MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED)


@query("op8_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `bytes`: groups of equal texts, best-fit-decreasing into 16 shards of near equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard(docs, SHARDS).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_minhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_dedup(docs, shingle_words=2, percent=80)


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated (document, item) pairs; clean documents have no row."""
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op5_warc")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_round_trip(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"), payloads=False, least_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op10_repeated_units",
    r"""
    WITH cut AS (
        SELECT doc_id, md5(text) AS body, regexp_extract_all(text, '[^.!?\n]*[.!?\n]+|[^.!?\n]+') AS parts FROM documents),
    one AS (
        SELECT doc_id, body, unnest(range(len(parts))) AS place, unnest(parts) AS part FROM cut),
    placed AS (
        SELECT doc_id, body, place, part,
               coalesce(sum(length(part)) OVER (PARTITION BY doc_id, body ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
               regexp_extract_all(lower(part), '[^\x20\x09-\x0D]+') AS tokens FROM one),
    worded AS (
        SELECT doc_id, body, (row_number() OVER (PARTITION BY doc_id, body ORDER BY place) - 1)::INTEGER AS unit,
               start, (start + length(part))::BIGINT AS "end", len(tokens)::INTEGER AS words,
               array_to_string(tokens, ' ') AS norm FROM placed WHERE len(tokens) > 0),
    ranked AS (
        SELECT *, first_value(doc_id) OVER w AS kept_in, first_value(unit) OVER w AS kept_unit
        FROM worded WINDOW w AS (PARTITION BY norm ORDER BY doc_id, unit)),
    repeats AS (
        SELECT *, unit - row_number() OVER (PARTITION BY doc_id, body ORDER BY unit) AS run
        FROM ranked WHERE doc_id <> kept_in OR unit <> kept_unit),
    sized AS (
        SELECT *, (sum(words) OVER (PARTITION BY doc_id, body, run))::BIGINT AS run_words FROM repeats)
    SELECT doc_id, unit, start, "end", words, run_words, kept_in, kept_unit FROM sized WHERE run_words >= 15
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_units(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return scored(docs, fit_quality(docs, labels), 0.5)


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return scored(docs, fit_toxicity(docs, labels), 0.7)


@query("op6_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query(
    "op11_ranked_search",
    r"""
    WITH lowered AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
    held AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM lowered),
    tfs AS (SELECT doc_id, term, any_value(n) AS n, count(*) AS tf FROM held GROUP BY doc_id, term),
    sizes AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS terms FROM lowered WHERE len(terms) > 0),
    weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM tfs, sizes GROUP BY term, docs),
    asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    scores AS (
        SELECT item_id, doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
        FROM asked JOIN tfs USING (term) JOIN weights USING (term), sizes GROUP BY item_id, doc_id),
    ranked AS (
        SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
        FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return ranked_search(docs, items, 50)


@query(
    "op12_filter_audit",
    r"""
    WITH read AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    failing AS (
        SELECT r.doc_id, part, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic,
               (len(words) < 100)::INTEGER
               + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INTEGER
               + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INTEGER
               + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
               + 16 * (r.doc_id > min(r.doc_id) OVER (PARTITION BY text))::INTEGER AS fails
        FROM read r LEFT JOIN labels l USING (doc_id)),
    letters AS (SELECT unnest([1, 2, 4, 8, 16]) AS bit, unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
    orders AS (
        SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
               unnest([1, 2, 3, 4, 5]) AS step,
               unnest([0, a.bit, a.bit + b.bit, a.bit + b.bit + c.bit, 31 - e.bit]) AS before,
               unnest([a.bit, b.bit, c.bit, d.bit, e.bit]) AS bit
        FROM letters a JOIN letters b ON b.bit <> a.bit JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
        JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
    kinds AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
        FROM failing GROUP BY part, fails),
    counted AS (
        SELECT part, filter_order, step, bit,
               coalesce(sum(n) FILTER (fails & (before | bit) = 0), 0)::BIGINT AS kept,
               coalesce(sum(n) FILTER (fails & before = 0 AND fails & bit > 0), 0)::BIGINT AS removed,
               coalesce(sum(n) FILTER (fails & before > 0 AND fails & bit > 0), 0)::BIGINT AS redundant,
               coalesce(sum(n) FILTER (fails = bit), 0)::BIGINT AS unique_fails,
               coalesce(sum(good) FILTER (fails & before = 0 AND fails & bit > 0), 0)::BIGINT AS good_lost,
               coalesce(sum(toxic) FILTER (fails & before = 0 AND fails & bit > 0), 0)::BIGINT AS toxic_lost
        FROM kinds CROSS JOIN orders GROUP BY part, filter_order, step, bit)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM counted
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit(docs, labels)


@query("op13_class_lm")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
