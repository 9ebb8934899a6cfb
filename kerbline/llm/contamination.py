"""Benchmark passages in training documents, found with a positional inverted index.

The index is a table of postings: one row per word of a document, with its place.  It is sharded
by document, as search engines do it, so building it shuffles nothing.  A phrase is looked up from
its rarest terms: their postings are shifted back by the term's offset in the phrase, the shifted
lists of the two rarest are intersected, and what is left is compared with the document in full.

All of it is DataFrame operations; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.llm.shared import known_id, stored, table

#: Words of a window.
LENGTH = 10
#: Test terms are sent to all executors up to this many; beyond, they are joined by shuffling.
MOST_SENT_TERMS = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything in ASCII but digits and lower-case letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text: A-Z as a-z, split at ASCII characters that are no letter or digit."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lowered, _BETWEEN), lambda w: w != "")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings ``term, did, place`` of all words, written to the shared folder.

    Rows without words have no postings.  Rows of one id share its postings.
    """
    words = docs.select(known_id(id_col).alias("did"), words_of(F.col(text_col)).alias("words"))
    postings = words.select("did", F.posexplode("words").alias("place", "term"))
    return stored(postings.select("term", "did", "place"), "postings")


def phrases_of(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """The windows of each item, ``item, phrase`` (an array of words), without repeats.

    An item of fewer than ``length`` words, but not none, is one window.
    """
    words = items.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - length + 1))
    windows = words.where(F.size("words") > 0).select(
        "item", "words", F.explode(starts).alias("start")
    )
    return windows.select("item", F.slice("words", F.col("start"), length).alias("phrase")).distinct()


class PhraseSearch:
    """Looks up phrases in an index.  ``phrases`` has one column ``phrase`` without repeats."""

    def __init__(self, index: DataFrame, phrases: DataFrame):
        self.index = index
        self.phrases = stored(phrases.withColumn("pid", F.md5(F.array_join("phrase", " "))), "phrases")
        terms = self.phrases.select("pid", F.posexplode("phrase").alias("offset", "term"))
        wanted = stored(terms.select("term").distinct(), "terms")
        self.sent = wanted.count() <= MOST_SENT_TERMS
        counts = self._of(wanted).groupBy("term").agg(F.count("*").alias("many"))
        rank = F.row_number().over(Window.partitionBy("pid").orderBy("many", "term", "offset"))
        # A term that occurs nowhere rules its phrases out.
        counted = terms.join(counts, "term", "left").withColumn("many", F.coalesce("many", F.lit(0)))
        ranked = counted.withColumn("turn", rank).where("turn <= 2")
        possible = Window.partitionBy("pid")
        ranked = ranked.withColumn("fewest", F.min("many").over(possible)).where("fewest > 0")
        self.rarest = stored(ranked.select("pid", "turn", "term", "offset", "many"), "rarest")

    def _of(self, terms: DataFrame) -> DataFrame:
        """The postings of a few terms."""
        return self.index.join(F.broadcast(terms) if self.sent else terms, "term")

    def _starts(self, turn: int) -> DataFrame:
        """Where phrases would start, by the postings of their rarest or second rarest term."""
        terms = self.rarest.where(F.col("turn") == turn).select("pid", "term", "offset")
        # Only the distinct terms are looked up in the index; phrases come in afterwards.
        hits = self._of(terms.select("term").distinct())
        return hits.join(terms, "term").select("pid", "did", (F.col("place") - F.col("offset")).alias("start"))

    def candidates(self) -> DataFrame:
        """``pid, did, start`` at which the two rarest terms of a phrase stand as in the phrase."""
        single = self.phrases.where(F.size("phrase") == 1).select("pid")
        first = self._starts(1).where("start >= 0")
        both = first.join(self._starts(2), ["pid", "did", "start"], "left_semi")
        return both.unionAll(first.join(single, "pid", "left_semi"))

    def proximity_matches(self, slop: int) -> DataFrame:
        """``pid, did, start, apart``: documents that have the two rarest terms of a phrase at most
        ``slop`` words nearer or farther from each other than in the phrase, and each other term at
        most ``slop`` words from its place.  Phrases of one word have no matches."""
        first, second = self._starts(1), self._starts(2).withColumnRenamed("start", "other")
        # Starts are joined by stretches of slop + 1 words: a near one is in the same or the next.
        stretch = slop + 1
        first = first.withColumn("cell", F.floor(F.col("start") / stretch))
        cell = F.floor(F.col("other") / stretch)
        near = F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell")
        pairs = first.join(second.select("pid", "did", "other", near), ["pid", "did", "cell"])
        apart = F.col("other") - F.col("start")
        pairs = pairs.where(F.abs(apart) <= slop).select("pid", "did", "start", apart.alias("apart")).distinct()
        terms = self.phrases.select("pid", F.size("phrase").alias("n"), F.posexplode("phrase").alias("offset", "term"))
        hits = pairs.join(terms, "pid").join(self._of(terms.select("term").distinct()), ["term", "did"])
        hits = hits.where(F.abs(F.col("place") - F.col("offset") - F.col("start")) <= slop)
        met = hits.groupBy("pid", "did", "start", "apart", "n").agg(F.count_distinct("offset").alias("met"))
        return met.where("met = n").select("pid", "did", "start", "apart")


ADDED = ("n_words", "n_hit", "n_items", "items", "hit_spans", "contaminated")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    length: int = LENGTH,
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_hit`` (words inside an occurrence of a window of
    the benchmark), ``n_items`` and ``items`` (those with an occurring window, ids as text, sorted),
    ``hit_spans`` (start and number of words of each occurrence) and ``contaminated``.

    A null or empty text has no words; a null item text has no windows.  Windows of an item
    without id count as hits, but name no item.  Items of equal text are all named.  Rows of one id
    are each judged by their own text.  Extra columns stay, but those named as an added one
    are replaced.
    """
    own = [c for c in docs.columns if c not in ADDED]
    names = [f"c{i}" for i in range(len(own))]
    text = F.col(names[own.index(text_col)])
    base = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(own, names, strict=True)))
    # Rows go by a hash of id and text: an id, or a missing one, may stand for any number of texts.  Two
    # texts of one hash would only be compared with each other's candidates too.
    base = base.withColumn("did", F.xxhash64(names[own.index(id_col)], text))
    index = build_index(base, "did", names[own.index(text_col)])
    phrases = stored(phrases_of(benchmark, item_col, item_text_col, length), "windows")
    search = PhraseSearch(index, phrases.select("phrase").distinct())
    named = phrases.groupBy("phrase").agg(
        F.collect_set(F.col("item").cast("string")).alias("items")
    )
    # The full comparison happens beside the document; its candidates travel as arrays.
    found = search.candidates().distinct().join(search.phrases.join(named, "phrase"), "pid")
    found = found.groupBy("did").agg(
        F.collect_list(F.struct((F.col("start") + 1).alias("start"), "phrase", "items")).alias("found")
    )
    rows = base.join(found, "did", "left").withColumn("words", words_of(text))
    rows = rows.withColumn(
        "found",
        F.filter(
            F.coalesce("found", F.array()),
            lambda f: F.slice(F.col("words"), f["start"], F.size(f["phrase"])) == f["phrase"],
        ),
    )
    places = F.transform(
        "found", lambda f: F.sequence(f["start"], f["start"] + F.size(f["phrase"]) - 1)
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda f: f["items"]))))
    spans = F.transform("found", lambda f: F.struct((f["start"] - 1).alias("start"), F.size(f["phrase"]).alias("words")))
    rows = rows.select(
        *names,
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct(F.flatten(places))).cast("long").alias("n_hit"),
        items.alias("items"),
        F.array_sort(F.array_distinct(spans)).alias("hit_spans"),
    ).select("*", F.size("items").cast("long").alias("n_items"), (F.col("n_hit") > 0).alias("contaminated"))
    order = [*names, *ADDED]
    return rows.select(*order).toDF(*own, *ADDED)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside passages of the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (
  SELECT item_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS ph, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
x AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS ph
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT x.doc_id, x.s, x.n, p.item_id FROM x JOIN p ON x.ph = p.ph AND x.n = p.n),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS j FROM (SELECT DISTINCT doc_id, s, n FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(len(t.items), 0) AS n_items,
  sha256(coalesce(array_to_string(t.items, ','), '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
