"""The corpus pipeline: stages over ``documents``, each written and read again as the next
one's input.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of
``documents``; the last one returns what it makes of them.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinstrata.llm.common import Stages, table
from coinstrata.llm.decontaminate import scan_texts
from coinstrata.llm.line_dedup import dedup_lines
from coinstrata.llm.pieces import PieceModel, default_model, encode
from coinstrata.llm.probminhash import near_duplicates
from coinstrata.llm.toxicity import ToxicityModel

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Score from which a document is rejected as toxic.
TOXIC = 0.7


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, fitted on ``labels``, does not find toxic. Null
    and empty texts stay."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = ToxicityModel.fit(docs, labels)
    scored = docs.withColumn("_score", model.score(docs["text"], spark))
    return scored.filter(F.col("_score") < TOXIC).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that a smaller doc_id keeps. ``n_chars`` follows
    the text; a document that loses no line keeps its text and count as they are, null
    included. One that loses all its lines stays, with an empty text: its rows still say
    that it was there, and every line it had stands in another document. Rows that repeat
    an id are one document, so they lose no line to each other."""
    deduped = dedup_lines(docs)
    changed = F.size("lines") > F.size("kept")
    text = F.array_join("kept", "\n")
    return deduped.withColumns(
        {
            "text": F.when(changed, text).otherwise(F.col("text")),
            "n_chars": F.when(changed, F.char_length(text).cast("long")).otherwise(F.col("n_chars")),
        }
    ).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of smallest doc_id. Rows that repeat an
    id and the text stay or go together; rows that repeat an id with another text are judged
    by their own text, in the order of its digest. Rows with a null id stay, as they are in
    no class, and so do null and empty texts, which are like no other."""
    digest = F.coalesce(F.md5("text"), F.lit(""))
    ids = docs.filter("doc_id is not null").groupBy("doc_id")
    mixed = ids.agg(F.min(digest).alias("low"), F.max(digest).alias("high")).filter("low <> high")
    # Where ids name one text each they are enough, and shorter.
    key = F.col("doc_id") if mixed.isEmpty() else F.struct("doc_id", digest.alias("digest"))
    key = F.when(F.col("doc_id").isNotNull(), key).alias("_key")
    classes = near_duplicates(docs.select(key, "text"), doc_id="_key")
    gone = classes.filter("doc_id <> class_id").select(F.col("doc_id").alias("_key"))
    return docs.select("*", key).join(gone, "_key", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a window of any benchmark item. Null and empty texts have no
    window and stay; repeated rows stay or go together."""
    scanned = scan_texts(docs, table(spark, sf_dir, "benchmark"))
    return scanned.filter("scan.n_hit = 0").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece numbers of every row, and how many they are. Null and empty texts have
    none; repeated rows stay repeated."""
    model = PieceModel.load(default_model())
    encoded = docs.select("doc_id", "lang", "source", encode(docs["text"], model, spark).alias("pieces"))
    return encoded.withColumn("n_pieces", F.size("pieces").cast("long"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    stages = Stages(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stages.write(stage(spark, docs, sf_dir), name)
    return docs


#: The stages train a classifier and compare weighted sets, which SQL cannot express.
ORACLE_SQL = None
