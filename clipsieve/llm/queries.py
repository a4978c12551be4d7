"""The registered queries of this subpackage and their SQL for DuckDB.

Each query applies one operator with production parameters to a whole table; where a fixed digest is asked
for, it is derived here from what the operator returns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsieve.llm import alignment, byte_bpe, classifier, language, neighbours, packing, pii, quality, simhash, spelling, substring_dedup, suffix_dedup, token_files
from clipsieve.session import prepare_session

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_PAIR_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id="doc_id"):
    """Rows that nothing is learnt from; a null id is one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out()))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_VOCABULARY, end_id=2)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.digest_documents(docs, BYTE_VOCABULARY, public_tokenizers.PATTERN)


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = token_files.write_tokens(table(spark, sf_dir, "documents"), WORD_VOCABULARY, end_id=1)
    return token_files.read_documents(chunks)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs)
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substring_dedup.remove_repeats(docs)
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), BYTE_PAIR_VOCABULARY, PIECE_VOCABULARY)


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = classifier.fit(docs.where(~held_out()), table(spark, sf_dir, "labels"))
    found = classifier.score(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_language": op2_language,
    "op3_pii": op3_pii,
    "op4_packing": op4_packing,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_neighbours": op6_neighbours,
    "op7_token_files": op7_token_files,
    "op8_quality": op8_quality,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_spelling": op11_spelling,
    "op12_alignment": op12_alignment,
    "op13_quality_classifier": op13_quality_classifier,
}

# Exact window comparisons and spelling variants can be put in SQL: the others rest on hashes, automata, vocabularies,
# compression, spans by look-behind or sums of doubles, and are tested against plain versions.
SQL: dict[str, str] = {
    "op9_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
        windows AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS w
                    FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d)),
        later AS (SELECT doc_id, i FROM (
                    SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM windows)
                  WHERE k > 1),
        marked AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100
                   THEN 0 ELSE 1 END AS begins FROM later),
        runs AS (SELECT doc_id, i, sum(begins) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
        spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY ALL),
        pieces AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since
                   FROM spans),
        cut AS (SELECT p.doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
                string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head
                FROM pieces p JOIN d USING (doc_id) GROUP BY p.doc_id)
        SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN cut USING (doc_id)""",
    "op10_substring_dedup": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                   lambda x: x <> '') AS words FROM documents),
        windows AS (SELECT doc_id, i, md5_number(array_to_string(words[i:i + 34], ' ')) AS w
                    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM d)),
        repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY w) AS k FROM windows)
                     WHERE k > 1),
        gone AS (SELECT DISTINCT doc_id, i + o AS j FROM repeated, range(0, 35) AS t(o)),
        word AS (SELECT doc_id, unnest(words) AS x, generate_subscripts(words, 1) AS j FROM d),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS text, count(*) AS n
                 FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
        SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op11_spelling": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list_transform(range(0, 256), lambda i: list_reduce(
                [i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs),
        runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS r FROM documents),
        low AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS k
                FROM runs WHERE length(r) >= 7 GROUP BY ALL),
        octets AS (SELECT r, k, doc_id, hex(encode(doc_id::VARCHAR || ':' || r)) AS h FROM low),
        hashed AS (SELECT r, k, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
                       list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                       lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) AS crc, doc_id
                   FROM octets, crc_table),
        results AS (SELECT CASE WHEN doc_id IS NOT NULL AND crc % 31 = 0
                    THEN left(r, crc % length(r)) || substr(r, crc % length(r) + 2) ELSE r END AS word, k FROM hashed),
        words AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM results WHERE length(word) >= 7 GROUP BY word
                               HAVING sum(k) >= 2),
        gone AS (SELECT word, n, left(word, i - 1) || '$' || substr(word, i + 1) AS prefix
                 FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
        whole AS (SELECT word, n, left(word, i) || '$' || substr(word, i + 1) AS prefix
                  FROM (SELECT *, unnest(range(0, length(word) + 1)) AS i FROM words)),
        near AS (SELECT a.word, b.word AS other, b.n AS m FROM gone a JOIN gone b USING (prefix) WHERE a.word <> b.word
                 UNION SELECT a.word, b.word, b.n FROM gone a JOIN whole b USING (prefix)
                 UNION SELECT b.word, a.word, a.n FROM gone a JOIN whole b USING (prefix)),
        best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m
                 FROM near GROUP BY word),
        formed AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
                   FROM words w LEFT JOIN best USING (word)),
        walk AS (SELECT word, form AS place, 1 AS k FROM formed WHERE form IS NOT NULL
                 UNION ALL SELECT walk.word, f.form, k + 1 FROM walk JOIN formed f ON f.word = place WHERE f.form IS NOT NULL),
        roots AS (SELECT word, arg_max(place, k) AS root FROM walk GROUP BY word)
        SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM formed LEFT JOIN roots USING (word)""",
}
