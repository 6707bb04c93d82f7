"""The corpus operators bound to the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstseen.llm import (
    alignment,
    chat,
    decontaminate,
    html_text,
    licenses,
    packing,
    periodic,
    pii,
    quality,
    repeats,
    simhash,
    token_files,
    vectors,
)
from firstseen.llm.frames import small_batches, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(small_batches(spark), sf_dir, "pages"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(small_batches(spark), sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(small_batches(spark), sf_dir, "documents"))


def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(small_batches(spark), sf_dir, "documents"))


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(small_batches(spark), sf_dir, "embeddings"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(small_batches(spark), sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("score")


# Fixed value: what both turns of conversation -7 say.
PROBE_TEXT = r"\### Assistant: </turn> ok"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    return chat.digests(chat.format_chats(given.unionByName(probe)))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(small_batches(spark), sf_dir, "documents"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digests(licenses.scan(table(small_batches(spark), sf_dir, "documents")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(small_batches(spark), sf_dir, "documents")).drop("groups")


# What separates words, as in a character class.
WORD_GAP = r"[\x20\x09-\x0D]+"


def with_periods(documents: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the documents repeat some of their words to the end.

    With h the crc32 of the id as text and n words, those where ``h % 10 = 0`` and
    n > 0 have each word i >= a replaced by word ``a + (i - a) % p``.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", WORD_GAP, -1), lambda word: word != "")
    chosen = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("h"))
    chosen = chosen.select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), F.when(F.col("h") % 10 == 0, split).alias("words"))
    chosen = chosen.withColumn("n", F.size("words").cast("bigint")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    chosen = chosen.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    ahead = F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)
    place = F.transform(ahead, lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    words = F.transform(place, lambda i: F.get("words", i.cast("int")))
    return chosen.select("doc_id", F.when(F.col("n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = with_periods(table(small_batches(spark), sf_dir, "documents"))
    return periodic.digests(periodic.collapse_runs(documents))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_html_text": op2_html_text,
    "op3_pii": op3_pii,
    "op4_packing": op4_packing,
    "op5_token_planes": op5_token_planes,
    "op6_vectors": op6_vectors,
    "op7_repeats": op7_repeats,
    "op8_decontaminate": op8_decontaminate,
    "op9_chat_format": op9_chat_format,
    "op10_simhash": op10_simhash,
    "op11_licenses": op11_licenses,
    "op12_alignment": op12_alignment,
    "op13_periodic": op13_periodic,
}

def _words_sql(expression: str) -> str:
    """The words of decontamination in SQL: characters without spaces around stand alone."""
    alone = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in decontaminate.UNSPACED)
    spaced = rf"regexp_replace(lower({expression}), '([{alone}])', ' \1 ', 'g')"
    return rf"regexp_extract_all({spaced}, '[\p{{L}}\p{{N}}_]+|[{alone}]')"


ORACLES: dict[str, str] = {
    "op6_vectors": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), linked AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
            ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
        ), reached AS (
            SELECT vec_id AS node, vec_id AS other FROM embeddings
            UNION SELECT node, b FROM reached JOIN linked ON other = a
        ), counted AS (SELECT a, count(*) AS n FROM linked GROUP BY a)
        SELECT node AS vec_id, any_value(coalesce(n, 0)) AS n_links, min(other) AS component_id, node = min(other) AS kept
        FROM reached LEFT JOIN counted ON node = a GROUP BY node
    """,
    "op8_decontaminate": r"""
        WITH items AS (
            SELECT item_id, @words(text) AS w,
                len(@words(line)) AS line
            FROM benchmark
        ), cut AS (
            SELECT item_id, w, CASE WHEN line > 0 AND line < len(w) THEN line ELSE (len(w) + 1) // 2 END AS cut
            FROM items WHERE len(w) > 0
        ), placed AS (
            SELECT item_id, w, cut, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM cut
        ), wanted AS (
            SELECT item_id, array_to_string(w[i + 1:i + 5], ' ') AS shingle, least(len(w), 5) AS width,
                bool_or(i < cut) AS question, bool_or(i >= cut - 4) AS answer
            FROM placed GROUP BY ALL
        ), words AS (
            SELECT doc_id, @words(text) AS w FROM documents
        ), starts AS (
            SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM words WHERE len(w) > 0
        ), held AS (
            SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + width], ' ') AS shingle
            FROM starts, (SELECT DISTINCT width FROM wanted) WHERE i + width <= len(w)
        ), sizes AS (
            SELECT item_id, count(*) AS n, count(*) FILTER (question) AS nq, count(*) FILTER (answer) AS na
            FROM wanted GROUP BY item_id
        ), hits AS (
            SELECT doc_id, item_id, count(*) AS k, count(*) FILTER (question) AS kq, count(*) FILTER (answer) AS ka
            FROM held JOIN wanted USING (shingle) GROUP BY ALL
        )
        SELECT doc_id, item_id, k::DOUBLE / n AS overlap, kq::DOUBLE / nq AS question_overlap, ka::DOUBLE / na AS answer_overlap
        FROM hits JOIN sizes USING (item_id)
        WHERE k >= 0.8 * n AND kq >= 0.25 * nq AND ka >= 0.25 * na
    """.replace("@words(text)", _words_sql("text")).replace(
        "@words(line)", _words_sql(r"split_part(regexp_replace(text, '^\s+', ''), chr(10), 1)")
    ),
    "op9_chat_format": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), sized AS (
            SELECT *, CASE
                WHEN contains(text, '</turn>') OR contains(role, '</turn>') OR contains(role, ': ')
                THEN length(replace(replace(replace(role || chr(1) || text, '\', '\b'), '</turn>', '\t'), ': ', '\c')) - 1
                ELSE length(role) + length(text) END + 14 AS chars
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(chars)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op11_licenses": licenses.oracle(),
}
