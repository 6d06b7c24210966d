"""The operators applied to the given tables, one query each, and the SQL that checks them where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedload.llm import decontam, kneser_ney, langid, merkle, packing, periodic, pii, repeats, search, secret_scan, simhash, tokens, toxicity
from keyedload.llm.common import crc_remainder, documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


TOKEN_LIMIT = 2048


@query("op1_tokens")
def op1_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = tokens.token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("*", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query("op2_langid")
def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_remainder("doc_id", 4) == 2
    found = langid.languages(docs, langid.train(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir)).select("doc_id", "spans", F.filter("spans", lambda s: s["base"]).alias("base"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in pii.KINDS],
        F.sha2(pii.listed("base"), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


#: Words as the contract states them; A-Z are lower-cased first.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark),
iw AS (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS x FROM iw),
sizes AS (SELECT DISTINCT size FROM item_windows),
dw AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size),
hits AS (SELECT dw.doc_id, dw.s, dw.size, item_id FROM dw JOIN item_windows k
         ON k.size = dw.size AND k.x = array_to_string(dw.w[dw.s:dw.s + dw.size - 1], ' ')),
words AS (SELECT doc_id, count(*) AS n_hit FROM
          (SELECT DISTINCT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(k) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM
          (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op5_decontamination", DECONTAMINATION_SQL)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.contamination(documents(spark, sf_dir), items)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query("op6_merkle")
def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compared_with_next(documents(spark, sf_dir))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.toxicity(docs, machine).select(
        "doc_id",
        (crc_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op8_kneser_ney")
def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_remainder("doc_id", 7) == 2
    scored = kneser_ney.score(docs, kneser_ney.train(docs.where(~held_out), order=3))
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    return scored.select("doc_id", held_out.alias("held_out"), *columns)


@query("op9_secrets")
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secret_scan.find(documents(spark, sf_dir))
    base = [r.kind for r in secret_scan.BASE_RULES]
    found = found.select("doc_id", "spans", F.filter("spans", lambda s: s["kind"].isin(base)).alias("base"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in base],
        F.sha2(pii.listed("base"), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(documents(spark, sf_dir), shingle=3, max_distance=2)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query("op11_repeats")
def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(documents(spark, sf_dir), least=200)
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["start"])).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


SEARCH_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS no, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
i AS (SELECT item_id, row_number() OVER () AS q, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark),
totals AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
qt AS (SELECT q, t, count(*) AS r FROM (SELECT q, unnest(w) AS t FROM i) GROUP BY q, t),
dt AS (SELECT no, doc_id, n, t, count(*) AS tf FROM (SELECT no, doc_id, len(w) AS n, unnest(w) AS t FROM d)
       WHERE t IN (SELECT t FROM qt) GROUP BY no, doc_id, n, t),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
            FROM (SELECT t, count(*) AS df FROM dt GROUP BY t), totals),
impacts AS (SELECT no, doc_id, t, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)) AS impact FROM dt, totals),
sums AS (SELECT q, no, doc_id, CAST(sum(r * weight * impact) AS BIGINT) AS score
         FROM qt JOIN weights USING (t) JOIN impacts USING (t) GROUP BY q, no, doc_id),
ranks AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM sums WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranks JOIN i USING (q) WHERE rank <= 10
"""


@query("op12_search", SEARCH_SQL)
def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)


def _with_periodic_tail(docs: DataFrame) -> DataFrame:
    """The texts of the query's contract: of each tenth document by checksum, the words from a place on repeat."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", text.alias("text"), h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    rows = rows.withColumn("n", F.coalesce(F.size("w"), F.lit(0)).cast("bigint"))
    a = F.col("g") % F.col("n")
    rows = rows.withColumn("a", F.when(F.col("n") > 0, a))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    changed = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.get("w", place(i).cast("int")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


@query("op13_periodic")
def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.runs(_with_periodic_tail(documents(spark, sf_dir)))
    run = "struct<start:bigint,length:bigint,period:bigint>"

    def greater(best, r):
        # Runs come by start and then period, so the first of equals stays.
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast(run), greater)
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("b"), listed.alias("listed"), "collapsed"
    ).select(
        "doc_id",
        "n_runs",
        *[F.col(f"b.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * b.length) div b.period").alias("exponent_milli"),
        F.sha2(F.array_join("listed", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
