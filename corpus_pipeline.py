"""From raw documents to token ids: language, near copies, benchmark passages, private data, tokens.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; what it returns
is written as Parquet and read again as the next stage's documents. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm import decontaminate, jaccard, language, private, tokens
from rowmill.llm.frames import table, written
from rowmill.llm.queries import PII_KEY


def _others(docs: DataFrame) -> Column:
    """All columns but the text as one, to go through an operator in place of an id."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, null ones too, and texts in no learned language go.

    Those are told by their n-grams, less likely than in any labelled text of their length
    but a few; a foreign text of a word or two can pass.
    """
    model = language.fit(docs, "doc_id", "text", "lang")
    carried = docs.select(F.struct(_others(docs).alias("others"), F.col("text")).alias("row"), "text")
    named = language.identify(carried, model, "row", "text")
    kept = named.where((F.col("lang_pred") != language.UNKNOWN) & F.col("belongs"))
    return kept.select("id.others.*", "id.text").select(*docs.columns)


def _named_apart(docs: DataFrame, *names: str) -> list[str]:
    """Names for columns of a stage's own that the documents do not have."""
    return [next(n for n in (name + "_" * k for k in range(len(docs.columns) + 1)) if n not in docs.columns) for name in names]


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, one without an
    id only where none has one.

    Rows are told apart by their place in the stored documents, not by their ids: rows of one
    id are near copies only if their texts are.
    """
    (row,) = _named_apart(docs, "row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    groups = jaccard.jaccard_groups(numbered, row).select(F.col("id").alias(row), "class_id")
    first = F.min_by(F.col(row), F.struct(F.col("doc_id").isNull(), "doc_id", row))
    kept = numbered.select(row, "doc_id").join(groups, row).groupBy("class_id").agg(first.alias(row)).select(row)
    return numbered.join(kept, row, "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go. Null texts stay."""
    (name,) = _named_apart(docs, "key")
    key = F.concat_ws("/", F.col("doc_id").cast("string"), F.sha2(F.coalesce("text", F.lit("")), 256))
    found = decontaminate.contamination(docs.select(key.alias("key"), "text"), table(spark, sf_dir, "benchmark"), "key")
    bad = found.where("n_hit > 0").select(F.col("id").alias(name)).distinct()
    return docs.withColumn(name, key).join(bad, name, "left_anti").select(*docs.columns)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by surrogates; no document goes. n_chars follows the text."""
    made = private.replace_entities(docs.select(_others(docs).alias("others"), "text"), PII_KEY, "others")
    return made.select("id.*", "text").withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to exactly the text. Columns of the
    documents of those names get an underscore."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    others = F.struct(_others(docs).alias("others"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    back = tokens.round_trip(docs.select(others.alias("row"), "text"), "row", "text", ranks, public_tokenizers.PATTERN)
    own = ("ids", "n_tokens", "exact")
    kept = [F.col(f"id.others.`{c}`").alias(c + "_" if c in own else c) for c in docs.columns if c != "text"]
    return back.select(
        *kept, "ids", F.size("ids").cast("long").alias("n_tokens"), (F.sha2("decoded", 256) == F.col("id.sha")).alias("exact")
    )


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", replace_private),
    ("byte-level BPE", to_tokens),
]

#: Language models, surrogates and token ids can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
