"""Language identification in two steps: the family first, then the language within it.

Both steps are linear support vector machines, one for each pair of classes, on hashed byte
n-grams of the whole text.  Only the training sample reaches the driver: at most
``SAMPLE`` texts of each language, each as counts of ``BUCKETS`` features.  Prediction runs in
the tasks and reads the text alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from kerbline.llm.bytesets import chunks, mixed, text_buffer
from kerbline.llm.shared import in_arrow, stored, table

#: Training texts of each language at most.
SAMPLE = 400
BUCKETS = 4096
#: Labels whose counts are sent to all tasks, at most.
MOST_SENT_LABELS = 10_000
#: Texts worked on at once.
ROWS = 256
#: Longest n-gram, in bytes.
LONGEST = 4
UNKNOWN = "und"

#: Languages of a family, by ISO 639-1 code; a language named nowhere is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "gd", "cy", "br"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "ky", "uz", "tt", "tk"),
    "indo-aryan": ("hi", "ur", "bn", "pa", "gu", "mr", "ne", "si"),
    "iranian": ("fa", "ps", "ku", "tg"),
    "semitic": ("ar", "he", "am", "mt"),
    "dravidian": ("ta", "te", "kn", "ml"),
    "malayic": ("id", "ms", "jv", "su", "tl"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

_LETTER = regex.compile(r"\p{L}")
#: Lower case; ASCII bytes that are no letter become a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language, language)


def is_held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text is a multiple of 5.  A
    null id counts as empty text and is held out."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def _features(rows: np.ndarray, data: np.ndarray) -> np.ndarray:
    """A row of unit length for each text: roots of the counts of its n-grams."""
    n = len(rows) - 1
    text = _FOLD[data[rows[0] : rows[-1]]].astype(np.uint64)
    first = rows - rows[0]
    row = np.repeat(np.arange(n), np.diff(first))
    room = np.repeat(first[1:], np.diff(first)) - np.arange(len(text))
    counts = np.zeros(n * BUCKETS, np.float32)
    gram = np.zeros(len(text), np.uint64)
    for size in range(1, LONGEST + 1):
        gram = gram[: max(0, len(text) - size + 1)]
        gram = (gram << np.uint64(8)) | text[size - 1 :]
        good = room[: len(gram)] >= size
        bucket = (mixed(gram + np.uint64(size << 40)) % np.uint64(BUCKETS)).astype(np.int64)
        place = row[: len(gram)] * BUCKETS + bucket
        counts += np.bincount(place[good], minlength=n * BUCKETS)
    matrix = np.sqrt(counts).reshape(n, BUCKETS)
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return (matrix / np.maximum(length, 1)).astype(np.float32)


def _sample_features(batches):
    for batch in batches:
        rows, data = text_buffer(batch["text"])
        packed = []
        for a, b in chunks(rows, most_rows=ROWS):
            for line in _features(rows[a : b + 1], data):
                used = np.flatnonzero(line)
                packed.append(used.astype(np.uint16).tobytes() + line[used].tobytes())
        yield pa.RecordBatch.from_pydict(
            {"lang": batch["lang"], "features": pa.array(packed, pa.binary())}
        )


def _separator(left: np.ndarray, right: np.ndarray, rounds: int = 15, cost: float = 10.0):
    """Weights of a linear support vector machine (squared hinge loss, dual coordinate descent)
    that is positive for ``left``; the last weight is the bias."""
    rows = np.vstack([left, right])
    rows = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
    sign = np.concatenate([np.ones(len(left)), -np.ones(len(right))])
    share = np.where(sign > 0, len(rows) / (2 * len(left)), len(rows) / (2 * len(right)))
    soft = 1 / (2 * cost * share)
    diagonal = (rows * rows).sum(axis=1) + soft
    weights, alpha = np.zeros(rows.shape[1]), np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            slope = sign[i] * (rows[i] @ weights) - 1 + soft[i] * alpha[i]
            new = max(0.0, alpha[i] - slope / diagonal[i])
            if new != alpha[i]:
                weights += (new - alpha[i]) * sign[i] * rows[i]
                alpha[i] = new
    return weights.astype(np.float32)


@dataclass
class Vote:
    """One machine for each pair of ``classes``; all machines vote."""

    classes: list[str]
    weights: np.ndarray

    @staticmethod
    def fit(rows: dict[str, np.ndarray]) -> Vote:
        classes = sorted(rows)
        machines = [_separator(rows[a], rows[b]) for a, b in combinations(classes, 2)]
        return Vote(classes, np.array(machines, np.float32).reshape(-1, BUCKETS + 1))

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class with most votes (then the largest margins), and how sure its machines are."""
        n, many = len(rows), len(self.classes)
        if many == 1:
            return np.zeros(n, np.int64), np.ones(n)
        margins = rows @ self.weights[:, :-1].T + self.weights[:, -1]
        votes, sure = np.zeros((n, many)), np.zeros((n, many))
        for k, (a, b) in enumerate(combinations(range(many), 2)):
            chance = 1 / (1 + np.exp(-4 * np.clip(margins[:, k], -9, 9)))
            votes[:, a] += margins[:, k] >= 0
            votes[:, b] += margins[:, k] < 0
            sure[:, a] += chance
            sure[:, b] += 1 - chance
        best = np.argmax(votes * many + sure, axis=1)
        return best, sure[np.arange(n), best] / (many - 1)


@dataclass
class LanguageModel:
    """A vote between families, and one within each family."""

    families: Vote
    languages: dict[str, Vote]

    @staticmethod
    def fit(rows: dict[str, np.ndarray]) -> LanguageModel | None:
        if not rows:
            return None
        members: dict[str, list[str]] = {}
        for language in sorted(rows):
            members.setdefault(family_of(language), []).append(language)
        families = {name: np.vstack([rows[m] for m in own]) for name, own in members.items()}
        return LanguageModel(
            Vote.fit(families),
            {name: Vote.fit({m: rows[m] for m in own}) for name, own in members.items()},
        )

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        family, score = self.families.predict(rows)
        named = np.empty(len(rows), object)
        for k, name in enumerate(self.families.classes):
            mine = np.flatnonzero(family == k)
            if len(mine):
                vote = self.languages[name]
                best, sure = vote.predict(rows[mine])
                named[mine] = np.array(vote.classes, object)[best]
                score[mine] = score[mine] * sure
        return named.tolist(), score


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """A model learned from the labelled texts that are not held out, or None without any.

    From each language the ``SAMPLE`` texts of least hash are taken.  A filter leaves about
    twice that many, and each task passes on ``SAMPLE`` a language at most.
    """
    known = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where(~is_held_out("id") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    draw = F.xxhash64("id", "text")
    counts = known.groupBy("lang").agg(F.count("*").alias("many"))
    counts = stored(counts, "labels")
    # A row for each label.  Should labels be that many, they are joined by shuffling.
    some = F.broadcast(counts) if counts.count() <= MOST_SENT_LABELS else counts
    share = 2 * SAMPLE / F.col("many")
    drawn = known.join(some, "lang").where(F.pmod(draw, F.lit(1 << 20)) < share * (1 << 20))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(draw))
    chosen = drawn.withColumn("turn", turn).where(F.col("turn") <= SAMPLE).select("lang", "text")
    rows: dict[str, list[np.ndarray]] = {}
    for line in in_arrow(chosen, _sample_features, "lang string, features binary").collect():
        many = len(line["features"]) // 6
        row = np.zeros(BUCKETS, np.float32)
        row[np.frombuffer(line["features"], np.uint16, many)] = np.frombuffer(
            line["features"], np.float32, many, 2 * many
        )
        rows.setdefault(line["lang"], []).append(row)
    return LanguageModel.fit({language: np.array(own) for language, own in rows.items()})


def _predictions(model: LanguageModel | None, text_name: str, names: list[str]):
    def run(batches):
        for batch in batches:
            rows, data = text_buffer(batch[text_name])
            languages: list[str] = []
            scores: list[float] = []
            for a, b in chunks(rows, most_rows=ROWS):
                if model is None:
                    named, score = [UNKNOWN] * (b - a), np.zeros(b - a)
                else:
                    named, score = model.predict(_features(rows[a : b + 1], data))
                for r in range(a, b):
                    if not _LETTER.search(str(data[rows[r] : rows[r + 1]], "utf-8", "replace")):
                        named[r - a], score[r - a] = UNKNOWN, 0.0
                languages += named
                scores += np.clip(score, 0, 1).tolist()
            columns = {name: batch[name] for name in names}
            columns["lang_pred"] = pa.array(languages, pa.string())
            columns["score"] = pa.array(scores, pa.float64())
            yield pa.RecordBatch.from_pydict(columns)

    return run


ADDED = ("lang_pred", "score")


def predict_languages(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``lang_pred`` and ``score`` (0 to 1).

    Only ``text_col`` is read.  A null text, one without letters, and every text if there is no
    model, is ``und`` with score 0.  Other columns stay, but those named as an added one are replaced.
    """
    own = [c for c in docs.columns if c not in ADDED]
    names = [f"c{i}" for i in range(len(own))]
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(own, names, strict=True)))
    fields = [StructField(n, docs.schema[c].dataType) for c, n in zip(own, names, strict=True)]
    fields += [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    run = _predictions(model, names[own.index(text_col)], names)
    return in_arrow(plain, run, StructType(fields)).toDF(*own, *ADDED)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predicted = predict_languages(docs.drop("lang"), train(docs))
    return predicted.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
