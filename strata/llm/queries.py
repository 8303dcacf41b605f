"""The registered queries of the operators in this folder, and their SQL.

Each query applies its operator to its whole table and derives the digest
columns of the contract from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.chat_format import format_conversations, read_back
from strata.llm.decontamination import contamination
from strata.llm.exact_dedup import exact_dedup, normalised
from strata.llm.hard_negatives import hard_negatives
from strata.llm.language_id import language_id, train
from strata.llm.lexical_search import lexical_search
from strata.llm.line_dedup import line_dedup
from strata.llm.neighbours import nearest
from strata.llm.ngram_join import ngram_join
from strata.llm.quality_classifier import quality
from strata.llm.sentencepiece_codec import encode_decode
from strata.llm.toxicity import toxicity
from strata.llm.warc import warc_round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(4, 2)))
    found = language_id(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.sha2("text", 256).alias("text_sha256"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM d),
w AS (
  SELECT doc_id, pos, line AS a, lead(line, 1) OVER o AS b, lead(line, 2) OVER o AS c
  FROM lines WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
),
f AS (
  SELECT a, b, c, min({'doc_id': doc_id, 'pos': pos}) AS first
  FROM w WHERE c IS NOT NULL GROUP BY a, b, c HAVING count(*) > 1
),
covered AS (
  SELECT DISTINCT w.doc_id, w.pos + k.k AS pos
  FROM w JOIN f ON w.a = f.a AND w.b = f.b AND w.c = f.c, (SELECT unnest(range(3)) AS k) k
  WHERE w.doc_id <> f.first.doc_id OR w.pos <> f.first.pos
),
kept AS (
  SELECT lines.doc_id, count(*) AS n_lines, count(covered.pos) AS n_removed,
    string_agg(line, chr(10) ORDER BY lines.pos) FILTER (covered.pos IS NULL) AS text
  FROM lines LEFT JOIN covered ON lines.doc_id = covered.doc_id AND lines.pos = covered.pos GROUP BY lines.doc_id
)
SELECT doc_id, n_lines, n_removed, sha256(coalesce(text, '')) AS text_sha256 FROM kept
"""


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], rows.schema))
    stream, members = format_conversations(rows)
    turns = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    digests = read_back(stream).select(
        "leaf",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return members.join(digests, "leaf").drop("leaf")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark"))


def held_out(modulus: int, remainder: int) -> Column:
    """The contract's held-out rows, by the CRC-32 of the decimal id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(normalised(F.col("text")), 256))
    return exact_dedup(docs, carry=["text_sha256"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP7_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256
FROM t JOIN g USING (text_sha256)
"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, labels, keep=["doc_id"])
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality(docs, labels, keep=["doc_id"])
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_round_trip(table(spark, sf_dir, "pages"), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l
  FROM documents WHERE text IS NOT NULL
),
s AS (SELECT count(*) AS docs, sum(len(l))::BIGINT AS total FROM d WHERE len(l) > 0),
t AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(l) AS term FROM d) GROUP BY k, term),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM t, s GROUP BY term, docs),
scored AS (
  SELECT item_id, t.k, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(l) * docs) // total))))::BIGINT AS score
  FROM i JOIN t USING (term) JOIN w USING (term) JOIN d ON t.k = d.k, s GROUP BY item_id, t.k
),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN d USING (k) WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, F.col("vec_id") % 20 == 0, 20).withColumnRenamed("id", "vec_id")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER o)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW o AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER o <= 3
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_decontamination": op4_decontamination,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_ngram_join": op6_ngram_join,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_lexical_search": op11_lexical_search,
    "op12_nearest": op12_nearest,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op11_lexical_search": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}
