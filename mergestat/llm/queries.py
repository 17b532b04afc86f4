"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (arc_warc, chat_parts, hilbert_ann, hyper_shards, markov_secrets, ordinal_quality, part_codes, piece_codec,
               pivotal_mix, simhash_decontam, simhash_mih, token_frames, word_runs)
from .common import WORD, table


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grade probabilities and selection of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal_quality.train(docs, ordinal_quality.graded(table(spark, sf_dir, "labels")))
    return ordinal_quality.score(docs, model).drop("text")


def op2_arc_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as an ARC record, converted to WARC and read back."""
    arcs = arc_warc.write_arc(table(spark, sf_dir, "pages"))
    return arc_warc.read_warc(arc_warc.convert(arcs))


def op3_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, written and parsed again."""
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    return chat_parts.read_back(chat_parts.formatted(told.union(hard)))


OP3_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, role IS NULL AS no_role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', false, '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', false, '\\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(text, '\\', '\\\\'), '<', '\\<') AS safe,
    CASE WHEN no_role THEN '<turn>' ELSE '<turn ' || replace(replace(replace(role, '\\', '\\\\'), '<', '\\<'), '>', '\\>') || '>' END AS head
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(head || safe) + 8)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def op4_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every hundredth vector."""
    return hilbert_ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as seekable frames and read back."""
    files = token_frames.write(table(spark, sf_dir, "documents"), tokenizer_path())
    return token_frames.read_back(files)


def op6_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return pivotal_mix.mix(table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("copies")


def op7_simhash_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a near copy of a benchmark item."""
    return simhash_decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .drop("text_key")


def op8_simhash_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash_mih.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op9_hyper_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under a uniform shuffle."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hyper_shards.shard(docs).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = markov_secrets.scan(docs, markov_secrets.train(docs)).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"] < 3)

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(markov_secrets.listed(base), 256).alias("base_sha256"),
                        markov_secrets.listed(F.col("secrets")).alias("spans"))


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the text they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = tokenizer_path("piece_bpe_32k.model")
    told = piece_codec.decode(piece_codec.encode(docs, model), model)
    return told.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector."""
    coded, books = part_codes.encode(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    return part_codes.label_totals(coded).select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                                                 F.lit(books.sha256).alias("codebooks_sha256"))


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents, one in ten of which repeats its words from some place on, as its id decides."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        start = (g % n).cast("int")
        period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
        from_start = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
            words, F.when(i < start, i).otherwise(start + (i - start) % period)))
        return F.when(n > 0, F.array_join(from_start, " ")).otherwise(F.lit(""))

    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    planted = F.transform(F.array(words), repeated)[0]
    return docs.withColumn("text", F.when(h % 10 == 0, planted).otherwise(F.col("text")))


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, and its text without their repeats."""
    docs = with_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = word_runs.collapse(docs).select("doc_id", "runs", "collapsed")

    def better(best, r):
        # exact: lengths and periods are cross-multiplied; runs come by start, then period
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    best = F.aggregate("runs", F.get("runs", F.lit(0)), better)
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {f.__name__: f for f in (op1_ordinal_quality, op2_arc_warc, op3_chat_parts,
                                   op4_hilbert_ann, op5_token_frames, op6_pivotal_mix, op7_simhash_decontam,
                                   op8_simhash_mih, op9_hyper_shards, op10_markov_secrets, op11_piece_codec,
                                   op12_part_codes, op13_word_runs)}
ORACLE_SQL: dict[str, str] = {"op3_chat_parts": OP3_SQL}
