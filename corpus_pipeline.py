"""A training-data pipeline over ``documents``, one stage after another.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows it is given and returns rows with the
columns of ``docs``; the last adds columns.  ``lang`` may be used to learn a language model and is filled
in where it is null; other columns but ``doc_id``, ``text`` and ``n_chars`` are passed through, whatever their names.  Null texts and
texts without letters leave in the first stage; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.llm.contamination import LENGTH, find_contamination
from kerbline.llm.language import UNKNOWN, predict_languages, train
from kerbline.llm.neardup import near_duplicates
from kerbline.llm.pieces import decode_ids, default_model, encode_texts
from kerbline.llm.shared import known_id, shared_path
from kerbline.llm.substrings import remove_repeated_passages


class _Plain:
    """Documents with their columns numbered, so that no name clashes with those that operators add."""

    def __init__(self, docs: DataFrame):
        self.columns = docs.columns
        self.names = [f"d{i}" for i in range(len(docs.columns))]
        self.rows = docs.toDF(*self.names)
        self.id, self.text = self["doc_id"], self["text"]

    def __getitem__(self, column: str) -> str:
        return self.names[self.columns.index(column)]

    def back(self, rows: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
        """Rows with the columns of the documents, and ``more`` behind them."""
        own = [name for name in more if name not in self.columns]
        return rows.select(*self.names, *own).toDF(*self.columns, *own)


def in_a_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without text or letters go, and no others.

    Learns from the labels of ``docs``; a null ``lang`` becomes the predicted one.  Without any label
    there is nothing to predict with, and it stays null.
    """
    plain = _Plain(docs)
    model = train(plain.rows, plain.id, plain.text, plain["lang"])
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    predicted = predict_languages(plain.rows, model, plain.text)
    predicted = predicted.where(F.col("lang_pred") != UNKNOWN)
    return plain.back(predicted.withColumn(plain["lang"], F.coalesce(plain["lang"], "lang_pred")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (shingles of five words, similarity 0.8) the document of
    the least id.  Of equal rows one stays."""
    plain = _Plain(docs)
    groups = near_duplicates(plain.rows, plain.id, plain.text)
    kept = groups.where("kept").select(known_id("doc_id").alias("did"), "text_md5").distinct()
    rows = plain.rows.withColumns(
        {
            "did": known_id(plain.id),
            "text_md5": F.md5(F.coalesce(F.col(plain.text), F.lit(""))),
        }
    ).join(kept, ["did", "text_md5"])
    same = Window.partitionBy("did", "text_md5").orderBy("did")
    return plain.back(rows.withColumn("turn", F.row_number().over(same)).where("turn = 1"))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words that an earlier one has.  ``n_chars`` follows."""
    plain = _Plain(docs)
    cut = remove_repeated_passages(plain.rows, plain.id, plain.text, keep_text=True)
    cut = cut.withColumn(plain.text, F.col("kept_text"))
    if "n_chars" in docs.columns:
        size = F.char_length(plain.text).cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn(plain["n_chars"], size)
    return plain.back(cut)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage of ten words with ``benchmark``.  An item of fewer words takes none
    away: so few words also stand in documents that never saw it."""
    plain = _Plain(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(plain.rows, benchmark, plain.id, plain.text)
    return plain.back(found.where(~F.exists("hit_spans", lambda span: span["words"] >= LENGTH)))


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces, and whether these decode to the text again."""
    plain = _Plain(docs)
    encoded = encode_texts(plain.rows, default_model(), plain.text, "piece_ids")
    decoded = decode_ids(encoded, default_model(), "piece_ids", "decoded")
    text = F.coalesce(F.col(plain.text), F.lit(""))
    decoded = decoded.withColumns(
        {"n_pieces": F.size("piece_ids").cast("long"), "round_trip": F.col("decoded") == text}
    )
    return plain.back(decoded, ("piece_ids", "n_pieces", "round_trip"))


STAGES = [
    ("language id", in_a_known_language),
    ("minhash near-dedup", without_near_duplicates),
    ("substring dedup", without_repeated_passages),
    ("benchmark decontamination", without_benchmark),
    ("sentencepiece", in_pieces),
]

#: MinHash, learned languages and pieces have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each returns is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
