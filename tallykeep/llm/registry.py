"""The queries of the operators, as the checks run them, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.llm import (
    chat, collocations, decontaminate, language_id, language_model, licenses, packing, quality, search, simhash, suffixes,
    toxicity, vector_codes,
)
from tallykeep.llm.shared import prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])
    labels = lambda spans: F.array_join(
        F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"))


def op3_language_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scores(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", "held_out", F.col("quality").alias("score"), (F.col("quality") >= 0.3).cast("int").alias("predicted"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.groups(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def op6_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = search.sign_code(F.col("embedding"), 32, 64)
    codes = _table(spark, sf_dir, "embeddings").where("embedding IS NOT NULL").select(
        F.col("vec_id").alias("id"), code.alias("code"))
    queries = codes.where("id % 100 = 0").withColumnRenamed("id", "query_id")
    found = search.top_k(codes, queries, 10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), F.col("distance").cast("int").alias("distance"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.transform("items", lambda x: x["item_id"]).alias("item_ids"),
        F.array_max(F.transform("items", lambda x: x["coverage"])).alias("coverage"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", "held_out", F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), "evidence")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    log = rows.unionByName(more).select(
        "conv_id", F.col("turn").alias("seq"), F.lit("message").alias("event"), "role", "text")
    done = chat.format_conversations(log)
    read = done.select(
        "conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"),
        chat.learned(F.col("formatted"), F.col("loss_spans")).alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings")).drop("label")


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_license_scan, op3_language_model_scores, op4_quality_classifier, op5_simhash_near_dedup,
    op6_top_k_search, op7_benchmark_decontamination, op8_toxicity, op9_suffix_array_dedup, op10_chat_formatting, op11_language_id,
    op12_phrase_collocations, op13_vector_codes)}

#: One round after the other: `parts` numbers the places of the integer vectors, `bookN` are the codebooks after N rounds.
_ROUND = """
    near{now} AS MATERIALIZED (
        SELECT p.row, p.part, p.v, arg_min(b.entry, (d * 100 + b.entry)) AS entry, min(d) AS d
        FROM (SELECT p.row, p.part, any_value(p.v) AS v, b.entry,
                     list_sum(list_transform(list_zip(any_value(p.v), any_value(b.v)), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS d
              FROM parts p JOIN book{now} b USING (part) GROUP BY p.row, p.part, b.entry) p JOIN book{now} b USING (part, entry)
        GROUP BY p.row, p.part, p.v
    )"""
_MOVED = """
    book{next} AS MATERIALIZED (
        SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{now} b LEFT JOIN (
            SELECT part, entry, list(floor_mean ORDER BY i) AS v FROM (
                SELECT part, entry, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean
                FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{now}) GROUP BY ALL)
            GROUP BY ALL) m USING (part, entry)
    )"""
_VECTOR_CODES = """
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label,
               list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS MATERIALIZED (
        SELECT row, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS v
        FROM kept, (SELECT unnest(range(16)) AS part)
    ), book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, v FROM parts WHERE row <= 64),
""" + ",".join([*(x for i in range(2) for x in (_ROUND.format(now=i), _MOVED.format(now=i, next=i + 1))), _ROUND.format(now=2)]) + """,
    coded AS (
        SELECT row, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
        FROM near2 GROUP BY row
    ), listed AS (
        SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (row), listed
"""

ORACLES = {
    "op6_top_k_search": """
        WITH codes AS (
            SELECT vec_id, list_sum(list_transform(range(32),
                lambda i: CASE WHEN embedding[i + 1]::DOUBLE + embedding[i + 33]::DOUBLE > 0
                               THEN 1::BIGINT << (31 - i) ELSE 0 END))::BIGINT AS code
            FROM embeddings WHERE embedding IS NOT NULL
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::INTEGER AS distance
            FROM codes q, codes c WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank,
               vec_id, distance
        FROM pairs QUALIFY rank <= 10
    """,
    "op10_chat_formatting": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), marked AS (
            SELECT *, regexp_replace(replace(text, '\', '\\'), '<(/?turn>)', '<\\\1', 'g') AS part
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               sum(20 + length(role) + length(part) + coalesce(list_sum(list_transform(
                   regexp_extract_all(text, '#+'), lambda x: length(x) - 1)), 0))::BIGINT AS formatted_chars
        FROM marked GROUP BY conv_id
    """,
    "op12_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), listed AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
        ), grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS w
            FROM listed, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k
        ), known AS (SELECT lang, k, w, count(*) AS f FROM grams GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM known WHERE k = 1 GROUP BY lang),
        inner_ones AS (
            SELECT lang, w, max(f) AS most FROM (
                SELECT lang, w[1:2] AS w, f FROM known WHERE k = 3 UNION ALL SELECT lang, w[2:3], f FROM known WHERE k = 3)
            GROUP BY ALL
        ), candidates AS (
            SELECT c.lang, c.k, c.w, c.f AS a FROM known c LEFT JOIN inner_ones i ON c.k = 2 AND c.lang = i.lang AND c.w = i.w
            WHERE c.k > 1 AND c.f >= 10 AND (i.most IS NULL OR i.most < 10 OR 100 * i.most < 50 * c.f)
        ), cuts AS (
            SELECT c.lang, c.w, c.a, c.j, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
            FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
            JOIN known x ON x.lang = c.lang AND x.w = c.w[1:c.j] JOIN known y ON y.lang = c.lang AND y.w = c.w[c.j + 1:c.k]
        ), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, j) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank,
               array_to_string(w, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
        FROM best JOIN totals USING (lang) QUALIFY rank <= 2000
    """,
    "op13_vector_codes": _VECTOR_CODES,
}
