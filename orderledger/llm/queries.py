"""One query for each operator of this folder: the whole table in, the contract's columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderledger.llm import (
    collocations,
    embedding_dedup,
    html_extraction,
    language_id,
    line_dedup,
    mixing,
    near_duplicates,
    pii,
    quality_rules,
    repeated_passages,
    sentencepiece_codec,
    sharding,
    token_alignment,
)
from orderledger.llm.common import table, words_of, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

ORACLES: dict[str, str] = {
    "op4_mixing": r"""
WITH docs AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM docs GROUP BY source
), levels AS (
  SELECT *, 3 * source_size AS cap,
    (sum(source_size) OVER ()
     - coalesce(sum(3 * source_size) OVER (
         ORDER BY 3 * source_size / weight, source NULLS LAST
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (
         ORDER BY 3 * source_size / weight, source NULLS LAST
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM sources
), targets AS (
  SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target
  FROM levels
), expected AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0
      THEN CAST(round(t.target * 1000000 / t.source_size) AS BIGINT) ELSE 0 END AS units,
    length(bin(d.size)) * 8 + list_position(['0', '1', '10', '11', '100', '101', '110', '111'],
      substring(bin(d.size), 1, 3)) AS band,
    substring(md5('17:' || coalesce(d.doc_id::VARCHAR, '')), 1, 2) AS block,
    CAST('0x' || substring(md5('17:' || coalesce(d.source, '')), 1, 8) AS BIGINT) % 1000000
      AS start
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), summed AS (
  SELECT *, start + CAST(sum(units) OVER (
    PARTITION BY source ORDER BY band, block, size, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM expected
)
SELECT doc_id, size, source_size, target,
  (upto // 1000000 - (upto - units) // 1000000) * size AS taken
FROM summed
""",
    "op12_collocations": r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(
    unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
  FROM docs
), totals AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang
), begins AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), grams AS (
  SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, 6)) AS m FROM begins) WHERE i + m - 1 <= len(words)
), counts AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, phrase, f AS a, m, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k
  FROM counts WHERE m > 1
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
    ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
), worst AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_begins AS (
  SELECT lang, f, m, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS i
  FROM counts WHERE m > 2
), around AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(2, m)) AS s FROM inner_begins) WHERE i + s - 1 <= m
  GROUP BY ALL
), ranked AS (
  SELECT w.*, row_number() OVER (
    PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS rank
  FROM worst w LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase
  WHERE o.longer IS NULL OR 100 * o.longer < 100 * w.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
""",
}


def query(function):
    QUERIES[function.__name__] = function
    return function


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality(table(spark, sf_dir, "documents"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(*base, "base_failed", "kept", "p_quality")


def piece_model() -> str:
    """Where the vocabulary lies that the queries use; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return sentencepiece_codec.encoded_digests(documents, piece_model)


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda span: span["kind"].isin(pii.BASE_KINDS))

    def joined(spans) -> Column:
        named = F.transform(
            spans, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])
        )
        return F.array_join(named, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        sha256(joined(base)).alias("base_sha256"),
        joined("spans").alias("spans"),
        F.array_join(
            F.transform("spans", lambda span: F.round(span["score"], 2).cast("string")), ","
        ).alias("scores"),
    )


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.size(words_of(F.col("text"))).cast("bigint").alias("size")
    )
    mixed = mixing.mix(written(sizes, "sizes"), F.col("size"))
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = line_dedup.line_verdicts(table(spark, sf_dir, "documents"))
    return verdicts.select(
        "doc_id",
        "n_lines",
        F.size("removed").cast("bigint").alias("n_removed"),
        F.array_join("removed", ",").alias("removed_lines"),
    )


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extraction.extract_text(table(spark, sf_dir, "pages"))
    return texts.select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )


@query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeated_passages.repeated_passages(table(spark, sf_dir, "documents"))
    lengths = F.transform("spans", lambda span: span["end"] - span["start"])
    return left.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("bigint"), lambda n, x: n + x).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        # Of the text itself, two hashes ride along.
        F.when(text.isNotNull(), F.xxhash64(text)).alias("h1"),
        F.when(text.isNotNull(), F.xxhash64(F.lit(1), text)).alias("h2"),
    )
    return sharding.sharded(rows, ["h1", "h2"]).select(
        "row.doc_id",
        "row.size",
        "row.text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def byte_model() -> str:
    """The same for the byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Entries of the piece vocabulary.
PIECES = 32_000


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return token_alignment.alignment_scores(documents, byte_model, piece_model, PIECES)


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
