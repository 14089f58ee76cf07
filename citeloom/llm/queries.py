"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import byte_bpe, kneser_ney, language_id, quality
from citeloom.llm.embedding_dedup import near_vectors
from citeloom.llm.exact_dedup import exact_dedup
from citeloom.llm.lexical_search import ranked_search
from citeloom.llm.minhash_dedup import near_duplicates
from citeloom.llm.packing import pack_documents
from citeloom.llm.shared import documents
from citeloom.llm.substring_dedup import remove_repeated
from citeloom.llm.surrogates import replace_personal_data, session_key
from citeloom.llm.token_counts import token_counts
from citeloom.llm.whitening import whiten


def _remainder(of: int, value: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == value, F.lit(False))


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _remainder(5, 1)
    docs = documents(spark, sf_dir)
    found = kneser_ney.score(docs, kneser_ney.train(docs.where(~held_out)))
    return found.withColumn("held_out", held_out)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = byte_bpe.decode(byte_bpe.encode(documents(spark, sf_dir), ranks, pattern), ranks)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal_data(documents(spark, sf_dir).select("doc_id", "text"), session_key(spark))


def op4_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.with_quality(docs, model).select("row.doc_id", "score", "kept")


def op5_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op7_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _remainder(4, 2)
    docs = documents(spark, sf_dir)
    return language_id.predict(docs, language_id.train(docs.where(~held_out))).withColumn("held_out", held_out)


def op9_small_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kneser_ney": op1_kneser_ney,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_surrogates": op3_surrogates,
    "op4_co_training": op4_co_training,
    "op5_best_two_fit": op5_best_two_fit,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_super_kmers": op7_super_kmers,
    "op8_language_mixture": op8_language_mixture,
    "op9_small_world": op9_small_world,
    "op10_minhash": op10_minhash,
    "op11_lexical_search": op11_lexical_search,
    "op12_token_counts": op12_token_counts,
    "op13_whitening": op13_whitening,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

ORACLE: dict[str, str] = {
    "op6_exact_dedup": f"""
        WITH t AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op7_super_kmers": """
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                                              lambda x: x <> '') AS w FROM documents),
        s AS (SELECT doc_id, i, array_to_string(w[i:i+34], ' ') AS g
              FROM d, unnest(range(1, greatest(len(w) - 33, 1))) AS r(i)),
        again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM s) WHERE c > 1),
        gone AS (SELECT DISTINCT doc_id, i + j AS i FROM again, range(35) AS t(j)),
        words AS (SELECT doc_id, i, w[i] AS x FROM d, unnest(range(1, len(w) + 1)) AS r(i)),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept, count(*) AS n
                 FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op10_minhash": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        e AS (SELECT DISTINCT doc_id, hash(w[i:i+4]) AS g
              FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS r(i) WHERE len(w) > 0),
        s AS (SELECT doc_id, count(g) AS n FROM d LEFT JOIN e USING (doc_id) GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b USING (g)
              WHERE a.doc_id < b.doc_id GROUP BY ALL),
        h AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
              WHERE 100 * c >= 75 * (x.n + y.n - c)),
        l AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
        r(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
        m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
        SELECT s.doc_id, n AS n_shingles, component_id, s.doc_id = component_id AS kept
        FROM s JOIN m USING (doc_id)""",
    "op11_lexical_search": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
        c AS (SELECT r, any_value(doc_id) AS doc_id, len(any_value(t)) AS n FROM d WHERE len(t) > 0 GROUP BY r),
        a AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM c),
        f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
              FROM f, a GROUP BY term, docs),
        q AS (SELECT item_id, term, count(*) AS q
              FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
        s AS (SELECT item_id, r, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))
                     ::BIGINT AS score
              FROM q JOIN w USING (term) JOIN f USING (term) JOIN c USING (r), a GROUP BY item_id, r)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score
        FROM (SELECT item_id, doc_id, score,
                     row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
              FROM s JOIN c USING (r) WHERE score > 0)
        WHERE rank <= 20""",
}
