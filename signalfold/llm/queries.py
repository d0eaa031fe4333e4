"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from signalfold.llm.chat import formatted_digests
from signalfold.llm.components import stored
from signalfold.llm.langid import fold, learn_profiles, predict_language
from signalfold.llm.mixing import mix_counts
from signalfold.llm.ngram_join import Jaccard, ngram_jaccard_join
from signalfold.llm.packing import pack_documents
from signalfold.llm.pivot_index import embedding_near_duplicates
from signalfold.llm.quality_classifier import learn_quality, quality_stats, score_quality
from signalfold.llm.quality_rules import quality_rules
from signalfold.llm.ranked_search import ranked_search
from signalfold.llm.resampling import resample
from signalfold.llm.ship import ship
from signalfold.llm.simhash import fingerprint_documents, with_near_counts
from signalfold.llm.substring_dedup import substring_dedup
from signalfold.llm.tokens import token_counts

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
CONTEXT = 1024  # tokens
GOOD = 0.7


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(read(spark, sf_dir, "documents"), Jaccard(n=3, num=90, den=100))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(read(spark, sf_dir, "documents"), TOKENIZER)
    return counts.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(read(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprint_documents(read(spark, sf_dir, "documents"))
    prints = prints.withColumn("edited_sha256", F.sha2(F.col("edited_text").cast("binary"), 256)).drop("edited_text")
    return with_near_counts(stored(prints, "fingerprints"), F.col("doc_id") % 100 == 0)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(read(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    profiles = learn_profiles(docs.where(~held_out).select("text", "lang"))
    return predict_language(docs, profiles).withColumn("held_out", F.coalesce(held_out, F.lit(False)))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "<|im_end|><|im_start|>assistant ok"
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return formatted_digests(rows.union(added), TOKENIZER)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(fold(F.col("_id"), 4) == 2, F.lit(False))
    stats = stored(quality_stats(read(spark, sf_dir, "documents")), "stats")
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("_id"), F.col("quality").alias("_label"))
    model = learn_quality(stats.where(~held_out), labels.where(~held_out))
    scored = score_quality(stats, model)
    return scored.select(F.col("_id").alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(read(spark, sf_dir, "documents"), joined=True)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents"), k=10)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), percent=5, least_words=20, seed=42)


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.95)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_ngram_jaccard_join, op2_token_counts, op3_packing, op4_fingerprints, op5_mixing,
        op6_language_id, op7_quality_rules, op8_chat_formatting, op9_quality_classifier, op10_substring_dedup,
        op11_ranked_search, op12_resampling, op13_embedding_near_dedup,
    )
}

# words as the contracts define them; A-Z only is lower-cased where asked for
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM worded
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
    SELECT a.doc_id AS u, b.doc_id AS v
    FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.doc_id, links.v FROM reach JOIN links ON links.u = reach.other
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""

OP8_SQL = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), told AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
        sum(length(role) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + 24)::BIGINT AS formatted_chars
    FROM said GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM told
"""

OP10_SQL = r"""
WITH worded AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM worded WHERE len(w) >= 50)
), repeats AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM windows) WHERE first < doc_id
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM repeats
), items AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM worded
), kept AS (
    SELECT items.doc_id, string_agg(word, ' ' ORDER BY items.i) AS text, count(*) AS n
    FROM items ANTI JOIN gone ON items.doc_id = gone.doc_id AND items.i = gone.i GROUP BY items.doc_id
)
SELECT worded.doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM worded LEFT JOIN kept ON worded.doc_id = kept.doc_id
"""

# terms: ASCII letters and digits and all characters beyond ASCII, A-Z lower-cased
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP11_SQL = rf"""
WITH said AS (
    SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS w FROM documents
), told AS (
    SELECT row, doc_id, len(w)::BIGINT AS n, w FROM said WHERE len(w) > 0
), totals AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM told
), asked AS (
    SELECT item, item_id, term, count(*)::BIGINT AS times
    FROM (SELECT row_number() OVER () AS item, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
), counted AS (
    SELECT row, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT row, doc_id, n, unnest(w) AS term FROM told)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weighed AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), totals
), scored AS (
    SELECT item, item_id, row, doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // length))))::BIGINT AS score
    FROM asked JOIN weighed USING (term) JOIN counted USING (term), totals GROUP BY ALL
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""

# CRC-32 by its rule: the table of a byte is made by eight steps, a text goes through it byte by byte
OP12_SQL = rf"""
WITH steps AS MATERIALIZED (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
), words AS MATERIALIZED (
    SELECT 'd' AS side, row_number() OVER () AS row, doc_id AS id, {_TERMS} AS w FROM documents
    UNION ALL SELECT 'b', -row_number() OVER (), NULL, {_TERMS} FROM benchmark
), features AS MATERIALIZED (
    SELECT side, row, unnest(list_concat(w,
        list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
        list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
    FROM words
), distincts AS (
    SELECT f, hex(f) AS h FROM (SELECT DISTINCT f FROM features)
), hashed AS MATERIALIZED (
    SELECT f, xor(list_reduce(list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
    FROM distincts, steps
), placed AS MATERIALIZED (
    SELECT side, row, bucket, count(*) AS n FROM features JOIN hashed USING (f) GROUP BY ALL
), sides AS (
    SELECT coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t FROM placed
), gains AS (
    SELECT bucket, floor(1000 * ln((sum(CASE WHEN side = 'b' THEN n ELSE 0 END) + 1)::DOUBLE * (any_value(s) + 10000)
        / ((sum(CASE WHEN side = 'd' THEN n ELSE 0 END) + 1)::DOUBLE * (any_value(t) + 10000))))::BIGINT AS gain
    FROM placed, sides GROUP BY bucket
), weights AS (
    SELECT row, sum(n * gain)::BIGINT AS weight, sum(n)::BIGINT AS n_features FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row
), scored AS (
    SELECT row, id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
            / 4294967296)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (row) WHERE side = 'd'
), ranks AS (
    SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS eligible FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_words, n_features, weight, score, CASE WHEN rank <= 5 * eligible // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranks USING (row)
"""

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard_join": OP1_SQL,
    "op8_chat_formatting": OP8_SQL,
    "op10_substring_dedup": OP10_SQL,
    "op11_ranked_search": OP11_SQL,
    "op12_resampling": OP12_SQL,
}
