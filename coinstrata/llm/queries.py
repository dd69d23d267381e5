"""The registered queries of the corpus operators; each applies one operator, with
production parameters, to its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinstrata.llm.common import table
from coinstrata.llm.decontaminate import scan_texts
from coinstrata.llm.divergence import divergence
from coinstrata.llm.hard_negatives import hard_negatives
from coinstrata.llm.html_text import extracted
from coinstrata.llm.line_dedup import dedup_lines
from coinstrata.llm.probminhash import near_duplicates
from coinstrata.llm.quality import judge
from coinstrata.llm.passages import repeated_passages
from coinstrata.llm.pii import pseudonymized
from coinstrata.llm.pieces import PieceModel, default_model, encode_and_decode
from coinstrata.llm.toxicity import ToxicityModel
from coinstrata.llm.oracle import ORACLE as ORACLE
from coinstrata.llm.url_filter import Rule, judge_urls
from coinstrata.llm.warc import archived_pages

#: The rules of the url contract.
URL_RULES = [
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    held_out = F.coalesce(remainder == 1, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "toxic")
    model = ToxicityModel.fit(docs.filter(~held_out), labels)
    return docs.select(
        "doc_id", held_out.alias("held_out"), model.score(docs["text"], spark).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).drop("url")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs)


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymized(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = PieceModel.load(default_model())
    both = encode_and_decode(docs["text"], model, spark)
    return docs.select("doc_id", "text", both.alias("both")).select("doc_id", "text", "both.*").select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.sha2(F.array_join(F.col("pieces").cast("array<string>"), ","), 256).alias("pieces_sha256"),
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return archived_pages(pages, least_bytes=0).drop("url")


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = scan_texts(docs, table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("scan.items", lambda i: i.cast("string")))
    return scanned.select(
        "doc_id",
        "scan.n_words",
        "scan.n_hit",
        F.size("scan.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("scan.n_hit") > 0).alias("contaminated"),
    )


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(rows)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents").select("lang", "source", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_url_filter,
        op3_near_duplicates,
        op4_quality,
        op5_surrogates,
        op6_sentencepiece,
        op7_line_dedup,
        op8_warc,
        op9_passages,
        op10_decontamination,
        op11_html_text,
        op12_hard_negatives,
        op13_divergence,
    )
}
