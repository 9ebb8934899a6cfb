"""Document fingerprints by winnowing.

Every run of ``GRAM`` words has a rolling hash: the words' hashes, each rotated by the number of words that
follow it in the run, combined by exclusive or.  Runs are put together from shorter ones, so that a
text's hashes take a few passes over arrays.  Of each ``WINDOW`` neighbouring hashes the least is
chosen, the rightmost if it occurs several times, and its place is kept.  So a passage of
``GRAM + WINDOW - 1`` words that two texts share leaves at least one common hash in both, and
no passage of fewer than ``GRAM`` words leaves any.

All of it is DataFrame operations; no Python runs on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.llm.shared import stored, table

GRAM, WINDOW = 5, 8
#: Low bits of a sort key that tell a hash's place, counted back; a text has fewer words than they can tell.
#: The high bits are the hash's own, and two hashes that agree in them count as equal.
_PLACE_BITS = 31
_LAST_PLACE = (1 << _PLACE_BITS) - 1


#: Letters and marks of scripts that are written without spaces: Thai, Lao, Tibetan, Burmese, Khmer, kana,
#: Chinese characters and others beside them.
_UNSPACED = (
    "["
    r"\u0E00-\u0EFF\u0F00-\u0FFF\u1000-\u109F\u1780-\u17FF\u1950-\u19FF\u1A20-\u1AAF\uA9E0-\uA9FF\uAA60-\uAADF"
    r"\u2E80-\u2FDF\u3005-\u3007\u3021-\u3029\u3031-\u303C\u3040-\u312F\u31A0-\u31BF\u31F0-\u31FF\u3400-\u4DBF"
    r"\u4E00-\uA4CF\uF900-\uFAFF\uFF66-\uFF9F\x{16FE0}-\x{18DFF}\x{1B000}-\x{1B2FF}\x{20000}-\x{3FFFF}"
    "]"
)
#: What every text with one of them has; told faster.
_FAR = r"[^\x00-\u0DFF]"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _rotated(value: Column, bits: int) -> Column:
    return F.shiftleft(value, bits % 64).bitwiseOR(F.shiftrightunsigned(value, -bits % 64))


def _followed(left: Column, right: Column, distance: int, combine: Callable[[Column, Column], Column]) -> Column:
    """Each entry of ``left`` combined with the entry of ``right`` that stands ``distance`` after it."""
    return _let(
        F.struct(left.alias("l"), right.alias("r")),
        lambda x: F.transform(
            F.sequence(F.lit(0), F.size(x["r"]) - distance - 1),
            lambda i: combine(F.get(x["l"], i), F.get(x["r"], i + distance)),
        ),
    )


def _grams(words: Column, gram: int) -> Column:
    """The hash of each run of ``gram`` words; fewer words, but not none, are one run."""

    def longer(runs: Column, hashes: Column, length: int, bits: str) -> Column:
        # Runs of ``length`` words are doubled for each binary digit that ``gram`` has left, and get
        # a word more where that is 1.
        if not bits:
            return runs
        double = _followed(runs, runs, length, lambda a, b: _rotated(a, length).bitwiseXOR(b))
        if bits[0] == "0":
            return _let(double, lambda r: longer(r, hashes, 2 * length, bits[1:]))
        one_more = _let(
            double, lambda r: _followed(r, hashes, 2 * length, lambda a, b: _rotated(a, 1).bitwiseXOR(b))
        )
        return _let(one_more, lambda r: longer(r, hashes, 2 * length + 1, bits[1:]))

    def runs(hashes: Column) -> Column:
        return (
            F.when(F.size(hashes) == 0, F.array().cast("array<bigint>"))
            .when(F.size(hashes) < gram, F.array(F.xxhash64(hashes)))
            .otherwise(longer(hashes, hashes, 1, f"{gram:b}"[1:]))
        )

    return _let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def _chosen(hashes: Column, window: int) -> Column:
    """Places, from 0, of the hashes that the windows choose."""

    # A key has the hash's high bits, and below them the place, so that of equal hashes the
    # rightmost has the least key.
    def keyed(h: Column, i: Column) -> Column:
        return F.shiftleft(F.shiftright(h, _PLACE_BITS), _PLACE_BITS) + (F.lit(_LAST_PLACE) - i).cast("long")

    def wider(least: Column, width: int) -> Column:
        # Least keys of ``width`` neighbours; two such stretches, which may overlap, are a wider one.
        if width == window:
            return least
        more = min(width, window - width)
        return _let(_followed(least, least, more, F.least), lambda x: wider(x, width + more))

    def least(keys: Column) -> Column:
        return (
            F.when(F.size(keys) == 0, keys)
            .when(F.size(keys) < window, F.array(F.array_min(keys)))
            .otherwise(F.array_distinct(wider(keys, 1)))
        )

    def place(key: Column) -> Column:
        return (F.lit(_LAST_PLACE) - key.bitwiseAND(F.lit(_LAST_PLACE).cast("long"))).cast("int")

    return F.transform(_let(F.transform(hashes, keyed), least), place)


def fingerprint_of(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The chosen hashes of a text and their places, ``struct<hashes, places>`` of arrays, by place.

    Words are runs without white space; in them, each character of a script that is written without
    spaces is a word.  A null text and one without words have an empty fingerprint.
    """
    text = F.coalesce(text, F.lit(""))
    spaced = F.when(text.rlike(_FAR), F.regexp_replace(text, _UNSPACED, " $0 ")).otherwise(text)
    words = F.filter(F.split(spaced, r"\s+"), lambda w: w != "")
    return _let(
        _grams(words, gram),
        lambda hashes: _let(
            _chosen(hashes, window),
            lambda places: F.struct(
                F.transform(places, lambda p: F.element_at(hashes, p + 1)).alias("hashes"),
                places.alias("places"),
            ),
        ),
    )


def hashes_of(fingerprint: Column) -> Column:
    return F.array_distinct(fingerprint["hashes"])


def likeness(left: Column, right: Column) -> Column:
    """Common hashes of two fingerprints as a share of all; 1 if both are empty."""

    def share(sides: Column) -> Column:
        a, b = sides["a"], sides["b"]
        common = F.size(F.array_intersect(a, b))
        return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(
            common / (F.size(a) + F.size(b) - common)
        )

    return _let(F.struct(hashes_of(left).alias("a"), hashes_of(right).alias("b")), share)


def as_text(fingerprint: Column) -> Column:
    """A fingerprint in print: hash in hex and place of each choice."""
    return F.array_join(
        F.zip_with(
            fingerprint["hashes"],
            fingerprint["places"],
            lambda h, p: F.concat(F.lower(F.hex(h)), F.lit("@"), p.cast("string")),
        ),
        " ",
    )


def matches(left: DataFrame, right: DataFrame, id_col: str = "doc_id", print_col: str = "print") -> DataFrame:
    """Places at which fingerprints of two tables have the same hash: ``left_id, left_place,
    right_id, right_place, hash``, one row for each pair of choices."""

    def choices(rows: DataFrame, side: str) -> DataFrame:
        pairs = F.arrays_zip(F.col(f"{print_col}.hashes"), F.col(f"{print_col}.places"))
        rows = rows.select(F.col(id_col).alias(f"{side}_id"), F.explode(pairs).alias("x"))
        return rows.select(
            f"{side}_id", F.col("x.places").alias(f"{side}_place"), F.col("x.hashes").alias("hash")
        )

    return choices(left, "left").join(choices(right, "right"), "hash")


#: Bytes that a bucket of neighbouring rows should have, buckets at most, and rows looked at for each to
#: find where it begins.
BUCKET_BYTES, MOST_BUCKETS, LOOKS = 1 << 20, 1 << 18, 8
_PART = 1 << 20


def _beginnings(rows: DataFrame) -> DataFrame | None:
    """The least key of each bucket, ``part, bounds``: neighbouring buckets are put in parts, as many as
    each has buckets.  ``rows`` have ``key`` and ``weight``; nothing if there is nothing to part.

    Rows are looked at by a hash of their key, the heavier the more often, and each row that is as heavy as a bucket's
    share: ``MOST_BUCKETS * LOOKS`` keys or so at most, however many rows there are.  They decide
    where buckets begin, and so how even they are, but not what any result is.
    """
    total = rows.agg(F.sum("weight")).first()[0]
    if not total:
        return None
    many = min(MOST_BUCKETS, max(1, math.ceil(total / BUCKET_BYTES)))
    if many == 1:
        return None
    share = total / (many * LOOKS)
    chance = F.shiftrightunsigned(F.xxhash64("key"), 11) / F.lit(float(1 << 53))
    seen = rows.where(chance < F.col("weight") / share)
    seen = seen.groupBy("key").agg(F.sum(F.greatest(F.col("weight").cast("double"), F.lit(share))).alias("weight"))
    inward = Window.orderBy("key")
    ahead = F.coalesce(F.sum("weight").over(inward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    slots = seen.select("key", F.floor(ahead / (total / many)).alias("slot"))
    bounds = slots.groupBy("slot").agg(F.min("key").alias("key"))
    part = F.floor((F.row_number().over(inward) - 1) / math.ceil(math.sqrt(many))).cast("int")
    bounds = bounds.select("key", part.alias("part")).groupBy("part")
    return stored(bounds.agg(F.sort_array(F.collect_list("key")).alias("bounds")), "bounds")


def _keyed(rows: DataFrame, order: list[str]) -> DataFrame:
    first, *others = order
    key = F.struct(
        F.col(first).isNotNull().alias("known"),
        F.coalesce(F.col(first).cast("long"), F.lit(0)).alias("value"),
        *others,
    )
    return rows.withColumn("key", key)


def _dealt(rows: DataFrame, weight: Column) -> DataFrame:
    """``rows`` with ``bucket``, a long that never falls as ``key`` rises."""
    bounds = _beginnings(rows.select("key", weight.cast("long").alias("weight")))
    if bounds is None:
        return rows.withColumn("bucket", F.lit(0).cast("long"))

    def below(keys: Column) -> Column:
        return F.size(F.filter(keys, lambda k: k <= F.col("key")))

    # The parts' beginnings, the square root of MOST_BUCKETS or so, are literals.
    kind = bounds.schema["bounds"].dataType.elementType
    begin = bounds.select("part", F.get("bounds", F.lit(0)).alias("key")).sort("part").collect()
    lows = F.array(*[F.struct(*map(F.lit, row["key"])).cast(kind) for row in begin])
    rows = rows.withColumn("part", F.greatest(below(lows) - 1, F.lit(0)))
    rows = rows.join(F.broadcast(bounds), "part", "left")  # a row a part, a key a bucket
    bucket = F.col("part").cast("long") * _PART + below(F.col("bounds"))
    return rows.withColumn("bucket", bucket).drop("part", "bounds")


def with_next(
    rows: DataFrame,
    order: list[str],
    carried: list[str],
    weight: Column | None = None,
    derive: Callable[[DataFrame], DataFrame] = lambda dealt: dealt,
) -> DataFrame:
    """``rows`` with ``next``: a struct of the ``carried`` columns of the row that follows in
    descending order, and of the first row for the last.

    The columns of ``order`` are longs; nulls of the first come last, the others have none.  Rows are dealt into
    buckets of neighbouring rows, each about ``BUCKET_BYTES`` of ``weight`` (``None``: one a row), so no
    task sees all rows, and rows move once.  A bucket ends anywhere in the order, also among rows of one value of
    its first columns; only rows equal in all of them share a bucket.  There are ``MOST_BUCKETS`` at most, so
    beyond 256 GB buckets grow; 100 TB give 400 MB each.  Only the first row of each bucket is
    looked up for the bucket before it, by a table of a row for each bucket.  ``derive`` adds columns once
    rows are dealt: they do not move.
    """
    rows = _keyed(rows, order)
    dealt = _dealt(rows, F.lit(1) if weight is None else weight)

    # The first row of each bucket, for the bucket of larger keys before it.  One row a bucket.
    tops = dealt.groupBy("bucket").agg(F.max("key").alias("key"))
    larger = F.lag("bucket").over(Window.orderBy(F.col("bucket").desc()))
    last = F.min("bucket").over(Window.partitionBy())
    tops = tops.select("key", F.coalesce(larger, last).alias("for_bucket"))
    heads = derive(rows.join(F.broadcast(tops), "key"))
    heads = heads.select(F.col("for_bucket").alias("bucket"), F.struct(*carried).alias("head"))
    heads = heads.groupBy("bucket").agg(F.first("head").alias("head"))

    after = F.lead(F.struct(*carried)).over(Window.partitionBy("bucket").orderBy(F.col("key").desc()))
    return (
        derive(dealt.repartition("bucket"))
        .withColumn("following", after)
        .join(heads, "bucket", "left")
        .withColumn("next", F.coalesce("following", "head"))
        .drop("bucket", "following", "head", "key")
    )


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    In descending order of ids a null id comes last, and rows of one id stand by a hash of their
    text, then by a hash of their place in the table's files.  A null text counts as empty.
    """
    docs = table(spark, sf_dir, "documents")
    origin = docs.metadataColumn("_metadata")
    docs = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("doc_id").cast("long").alias("rank"),
        F.xxhash64(origin["file_path"], origin["row_index"]).alias("place"),
    ).withColumn("tie", F.xxhash64("text"))
    # Texts move once, without their fingerprints, which are computed where the texts arrive.
    rows = with_next(
        docs,
        ["rank", "tie", "place"],
        ["text", "print"],
        F.octet_length("text") + 16,
        lambda dealt: dealt.withColumn("print", fingerprint_of(F.col("text"))),
    )
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next.text", F.lit(1), half))
    rows = rows.withColumns({"n_chars": size.cast("long"), "edited": edited})
    rows = rows.withColumn("edited_print", fingerprint_of(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next.print")).alias("near_next"),
    )
