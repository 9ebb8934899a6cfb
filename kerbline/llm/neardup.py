"""Groups of near-duplicate documents by a multi-index Hamming join of MinHash signatures.

A signature has ``CHUNKS * WIDTH`` places of ``16`` bits, one MinHash each, and is split into
``CHUNKS`` chunks of ``WIDTH`` places.  One place of a chunk may be wrong: a signature is filed
under each chunk with each place left out in turn.  Two signatures that differ in fewer than
``2 * CHUNKS`` places have, by pigeonhole, a chunk with at most one wrong place, so they meet under
some key.  For 12 chunks of 5 places that holds for all pairs up to 23 of 60 places.  At a
similarity of 0.8 a place differs with a chance of 0.2; a pair meets nowhere with a chance of
(1 - 0.8**5 - 5 * 0.2 * 0.8**4) ** 12 = 1e-7, and less if it is more similar.

Every pair that meets is confirmed on the full sets of shingles, but for those whose sizes rule a link out.  As groups of copies may hold a third of all
rows, pairs are never listed group by group.  Documents of equal sets are one class.  In a bucket
(all signatures under one key) everyone is first compared with the bucket's least member, then,
where a bucket still holds several components, with a few other members, and at last with all
members of other components, in blocks of bounded size that give back links alone.  The last step is exhaustive, so no link
between components is lost; links inside a component change nothing and are not looked for.

A class goes by 64 bits of its set's digest, ``rep``; ids come back in at the end.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.llm.bytesets import Rolling, Words, chunks, last_starts, mixed, text_buffer
from kerbline.llm.components import components
from kerbline.llm.shared import LAST_ID, in_arrow, known_id, stored, table
from kerbline.llm.wordcache import joined

CHUNKS, WIDTH = 12, 5
PLACES = CHUNKS * WIDTH
SHINGLE, PERCENT = 5, 80
#: Other members that a document is compared with before all members are.
SECOND_TRY = 4
#: Members of a bucket that one block of the exhaustive step takes.
BLOCK = 1024

_SEEDS = mixed(np.arange(1, 2 * PLACES + 1, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _shingle_sets(rows: np.ndarray, data: np.ndarray, size: int):
    """For each row the sorted distinct hashes of its shingles."""
    words = Words(rows, data)
    words.data = _LOWER[words.data]
    hashes = words.hashes()
    rolled = Rolling(hashes)
    windows = mixed(rolled.windows(size) ^ np.uint64(size))
    good = last_starts(words.first, size)[: len(windows)]
    for r in range(len(rows) - 1):
        f, g = int(words.first[r]), int(words.first[r + 1])
        if g - f >= size:
            last = g - size + 1
            yield np.unique(windows[f:last][good[f:last]])
        elif g > f:
            whole = rolled.slices(np.array([f]), np.array([g]))
            yield mixed(whole ^ np.uint64(g - f))
        else:
            yield np.zeros(0, np.uint64)


def _signature(shingles: np.ndarray) -> bytes:
    places = np.empty(PLACES, np.uint64)
    for k in range(PLACES):
        places[k] = ((shingles ^ _SEEDS[2 * k]) * (_SEEDS[2 * k + 1] | np.uint64(1))).min()
    return (mixed(places) & np.uint64(0xFFFF)).astype(np.uint16).tobytes()


def _signatures_of(size: int):
    def run(batches):
        for batch in batches:
            rows, data = text_buffer(batch["text"])
            counts, keys, signatures, originals = [], [], [], []
            for a, b in chunks(rows):
                for r, shingles in enumerate(_shingle_sets(rows[a : b + 1], data, size), a):
                    counts.append(len(shingles))
                    key = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
                    keys.append(int.from_bytes(key, "little", signed=True))
                    signatures.append(_signature(shingles) if len(shingles) else b"")
                    originals.append(hashlib.md5(data[rows[r] : rows[r + 1]]).digest())
            yield pa.RecordBatch.from_pydict(
                {
                    "did": batch["did"],
                    "n_shingles": pa.array(counts, pa.int64()),
                    "rep": pa.array(keys, pa.int64()),
                    "signature": pa.array(signatures, pa.binary()),
                    "original": pa.array(originals, pa.binary()),
                }
            )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, PLACES)


def _keys(batches):
    """Each class under each chunk with each place left out."""
    for batch in batches:
        places = _matrix(batch["signature"]).astype(np.uint64)
        rep, n = batch["rep"].to_numpy(), len(places)
        if not n:
            continue
        for chunk in range(CHUNKS):
            keys = []
            for out in range(WIDTH):
                value = np.zeros(n, np.uint64)
                for place in (p for p in range(WIDTH) if p != out):
                    value = (value << np.uint64(16)) | places[:, chunk * WIDTH + place]
                keys.append(mixed(mixed(value) ^ _SEEDS[chunk * WIDTH + out]))
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(np.concatenate(keys).view(np.int64)),
                    "number": pa.array(
                        np.repeat(np.arange(chunk * WIDTH, (chunk + 1) * WIDTH, dtype=np.int32), n)
                    ),
                    "rep": pa.array(np.tile(rep, WIDTH)),
                }
            )


def _confirm(size: int, percent: int):
    """Keeps pairs whose full sets are similar enough."""

    def run(batches):
        for batch in batches:
            left, left_data = text_buffer(batch["a_text"])
            right, right_data = text_buffer(batch["b_text"])
            linked = np.zeros(batch.num_rows, bool)
            for first, last in chunks(left + right):
                ours = _shingle_sets(left[first : last + 1], left_data, size)
                others = _shingle_sets(right[first : last + 1], right_data, size)
                for i, (x, y) in enumerate(zip(ours, others, strict=True), first):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked[i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
            chosen = batch.filter(pa.array(linked))
            yield pa.RecordBatch.from_pydict({"a": chosen["a"], "b": chosen["b"]})

    return run


def _by_block(work):
    """A task function that gathers the rows of each block, which arrive sorted, for ``work``."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        at = None
        for batch in batches:
            blocks = list(zip(*(batch[c].to_pylist() for c in BLOCK_OF), strict=True))
            start = 0
            for i in range(len(blocks) + 1):
                if i < len(blocks) and blocks[i] == at:
                    continue
                if i > start:
                    held.append(batch.slice(start, i - start))
                if i < len(blocks):
                    if held:
                        yield from work(pa.Table.from_batches(held))
                    held, at, start = [], blocks[i], i
        if held:
            yield from work(pa.Table.from_batches(held))

    return run


BLOCK_OF = ["bucket", "low", "high"]
_MEMBER = (
    "bucket long, low int, high int, number int, block int, rep long, component long, "
    "n_shingles long, signature binary"
)


def _candidates(rows: pa.Table, percent: int):
    """For each member of a block the later ones that it has to be compared with: those of other
    components whose size allows a link, if this is the first key they share."""
    places = np.concatenate([_matrix(c) for c in rows["signature"].chunks])
    rep, component = rows["rep"].to_numpy(), rows["component"].to_numpy()
    part, size = rows["block"].to_numpy(), rows["n_shingles"].to_numpy()
    low, high, number = (rows[c][0].as_py() for c in ("low", "high", "number"))
    chunk, out = divmod(number, WIDTH)
    for i in range(len(rep)):
        others = np.flatnonzero(
            (component != component[i])
            & (rep > rep[i])
            & ((part != part[i]) | (low == high))
            & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
        )
        if len(others):
            same = (places[others] == places[i]).reshape(-1, CHUNKS, WIDTH)
            wrong = WIDTH - same.sum(axis=2)
            earlier = (wrong[:, :chunk] <= 1).any(axis=1)
            here = np.where(wrong[:, chunk] == 0, 0, np.argmin(same[:, chunk], axis=1))
            others = others[~earlier & (here == out)]
        if len(others):
            yield i, others


def _compared(percent: int):
    """The members of a block that have to be compared with others."""

    def work(rows: pa.Table):
        chosen = np.zeros(len(rows), bool)
        for i, others in _candidates(rows, percent):
            chosen[i] = chosen[others] = True
        if chosen.any():
            yield from rows.filter(pa.array(chosen)).to_batches()

    return _by_block(work)


def _linked(percent: int):
    """Links between components in a block, by the members' full sets.  Of a member's links with
    one component the first will do."""

    def work(rows: pa.Table):
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
        sizes = np.array([len(x) for x in sets])
        offsets, flat = np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(sets)
        rep, component = rows["rep"].to_numpy(), rows["component"].to_numpy()
        pairs = []
        for i, others in _candidates(rows, percent):
            values = joined(offsets, flat, others)
            place = np.minimum(np.searchsorted(sets[i], values), len(sets[i]) - 1)
            shared = (sets[i][place] == values).astype(np.int64)
            both = np.add.reduceat(shared, np.cumsum(sizes[others]) - sizes[others])
            good = others[100 * both >= percent * (sizes[i] + sizes[others] - both)]
            _, first = np.unique(component[good], return_index=True)
            pairs += [(rep[i], rep[k]) for k in good[first]]
        if pairs:
            a, b = zip(*pairs, strict=True)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return _by_block(work)


def _sets_of(size: int):
    def run(batches):
        for batch in batches:
            rows, data = text_buffer(batch["text"])
            found: list[bytes] = []
            for a, b in chunks(rows):
                found += [x.tobytes() for x in _shingle_sets(rows[a : b + 1], data, size)]
            yield pa.RecordBatch.from_pydict({"rep": batch["rep"], "shingles": pa.array(found, pa.binary())})

    return run


class _Join:
    """The state of one join: classes, buckets of several classes, and components so far."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.size, self.percent = size, percent
        self.sets = stored(
            in_arrow(
                docs,
                _signatures_of(size),
                "did long, n_shingles long, rep long, signature binary, original binary",
            ),
            "sets",
        )
        self.classes = stored(
            self.sets.where("n_shingles > 0")
            .groupBy("rep", "n_shingles", "signature")
            .agg(F.min(F.struct("did", "original")).alias("first")),
            "classes",
        )
        keyed = in_arrow(
            self.classes.select("rep", "signature"), _keys, "bucket long, number int, rep long"
        )
        several = (
            keyed.groupBy("bucket")
            .agg(F.min("rep").alias("least"), F.max("rep").alias("most"))
            .where("least < most")
        )
        self.members = stored(keyed.join(several.select("bucket", "least"), "bucket"), "members")
        involved = self.classes.join(self.members.select("rep").distinct(), "rep")
        involved = involved.select("rep", "first.did", "first.original")
        # By id and text: an id, or a missing one, may stand for many texts.
        self.texts = stored(
            docs.withColumn("original", F.unhex(F.md5("text")))
            .join(involved, ["did", "original"])
            .select("rep", "text")
            .dropDuplicates(["rep"]),
            "texts",
        )
        self.places: DataFrame | None = None
        self.links: DataFrame | None = None

    def located(self) -> DataFrame:
        """``members`` with the component each is in so far."""
        if self.places is None:
            return self.members.withColumn("component", F.col("rep"))
        places = self.places.select(F.col("node").alias("rep"), "component")
        return self.members.join(places, "rep", "left").withColumn(
            "component", F.coalesce("component", "rep")
        )

    def add(self, pairs: DataFrame) -> None:
        """Confirms pairs and joins what they link."""
        a = self.texts.select(F.col("rep").alias("a"), F.col("text").alias("a_text"))
        b = self.texts.select(F.col("rep").alias("b"), F.col("text").alias("b_text"))
        linked = stored(
            in_arrow(
                pairs.join(a, "a").join(b, "b"),
                _confirm(self.size, self.percent),
                "a long, b long",
            ),
            "links",
        )
        self.links = linked if self.links is None else self.links.unionAll(linked)
        self.places = components(self.links)

    def close(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (``a``, ``b``) whose sizes allow a link."""

        def side(name):
            return self.classes.select(F.col("rep").alias(name), F.col("n_shingles").alias(f"{name}_n"))

        sizes = F.expr(f"100 * least(a_n, b_n) >= {self.percent} * greatest(a_n, b_n)")
        return pairs.join(side("a"), "a").join(side("b"), "b").where(sizes).select("a", "b")

    def with_least(self) -> None:
        """Everyone with one of the least members of its buckets: that which is least in most."""
        met = self.members.where("least < rep").groupBy("rep", "least").agg(F.count("*").alias("keys"))
        best = F.max_by("least", F.struct("keys", -F.col("least")))
        pairs = met.groupBy(F.col("rep").alias("b")).agg(best.alias("a"))
        self.add(self.close(pairs.select("a", "b")))

    def mixed_buckets(self, rows: DataFrame) -> DataFrame:
        """Rows of buckets that hold several components, with a member picked by hash."""
        several = (
            rows.groupBy("bucket")
            .agg(
                F.min("component").alias("c_lo"),
                F.max("component").alias("c_hi"),
                F.count("*").alias("many"),
                F.min_by(F.struct("rep", "component"), F.xxhash64("rep", "bucket")).alias("other"),
            )
            .where("c_lo < c_hi")
        )
        return rows.join(several, "bucket")

    def with_some(self) -> None:
        """Everyone with a few members of its buckets that are in other components."""
        rows = self.mixed_buckets(stored(self.located(), "located"))
        apart = rows.where("component <> other.component")
        pairs = apart.select("rep", F.col("other.rep").alias("other")).distinct()
        order = Window.partitionBy("rep").orderBy(F.xxhash64("rep", "other"))
        some = pairs.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= SECOND_TRY)
        both = some.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b"))
        self.add(self.close(both.distinct()))

    def with_all(self) -> None:
        """All pairs of different components that share a bucket."""
        rows = self.mixed_buckets(stored(self.located(), "located"))
        parts = F.ceil(F.col("many") / BLOCK).cast("int")
        rows = rows.select(
            "bucket",
            "number",
            "rep",
            "component",
            F.pmod(F.xxhash64("rep"), parts).cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0), parts - 1)).alias("mate"),
        )
        rows = rows.join(self.classes.select("rep", "n_shingles", "signature"), "rep")
        rows = rows.withColumns({"low": F.least("block", "mate"), "high": F.greatest("block", "mate")})
        members = [f.split()[0] for f in _MEMBER.split(", ")]
        rows = rows.select(*members).repartition(*BLOCK_OF).sortWithinPartitions(*BLOCK_OF)
        # Full sets travel only to the blocks in which signatures leave something to compare.
        compared = stored(in_arrow(rows, _compared(self.percent), _MEMBER), "compared")
        sets = in_arrow(
            self.texts.join(compared.select("rep").distinct(), "rep"),
            _sets_of(self.size),
            "rep long, shingles binary",
        )
        rows = compared.join(sets, "rep").select(*members, "shingles")
        rows = rows.repartition(*BLOCK_OF).sortWithinPartitions(*BLOCK_OF)
        self.add(in_arrow(rows, _linked(self.percent), "a long, b long").distinct())


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_md5`` for every row of ``docs``; the last tells
    rows of one id apart.

    Words are runs without ASCII white space after A-Z become a-z.  A document's set holds its
    distinct shingles of ``shingle`` words; a shorter text is one shingle; a null or empty text has
    none and is linked with nothing.  Two documents are linked if their sets' intersection is at
    least ``percent`` hundredths of the union; ``component_id`` is the least id that links reach,
    and the document of that id is kept.  Rows of one id may have different texts and then belong
    to different groups; equal rows are kept together.  A null id counts as larger than all
    others and is given back as null.  Other columns are not read.
    """
    plain = docs.select(
        known_id(id_col).alias("did"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    join = _Join(plain, shingle, percent)
    join.with_least()
    join.with_some()
    join.with_all()
    places = join.places.toDF("rep", "component")
    placed = join.classes.select("rep", "first.did").join(places, "rep", "left")
    placed = placed.withColumn("component", F.coalesce("component", "rep"))
    least = placed.groupBy("component").agg(F.min("did").alias("least"))
    placed = placed.select("rep", "component").join(least, "component")
    rows = join.sets.where("n_shingles > 0").join(placed, "rep")
    rows = rows.select("did", "n_shingles", "least", "original")
    empty = join.sets.where("n_shingles = 0").withColumn("least", F.col("did"))
    empty = empty.select("did", "n_shingles", "least", "original")
    return rows.unionAll(empty).select(
        F.nullif("did", F.lit(LAST_ID)).alias("doc_id"),
        "n_shingles",
        F.nullif("least", F.lit(LAST_ID)).alias("component_id"),
        (F.col("did") == F.col("least")).alias("kept"),
        F.lower(F.hex("original")).alias("text_md5"),
    )


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups by sets of two-word shingles."""
    groups = near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


OP6_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS sh
  FROM t),
n AS (SELECT doc_id, len(sh) AS n FROM s),
c AS (SELECT sh AS shs, min(doc_id) AS rep, len(sh) AS n FROM
        (SELECT doc_id, list_sort(sh) AS sh FROM s WHERE len(sh) > 0) GROUP BY sh),
e AS (SELECT rep, n, unnest(shs) AS x FROM c),
f AS (SELECT rep, n, x, row_number() OVER (PARTITION BY rep ORDER BY d, x) AS k
      FROM (SELECT e.*, count(*) OVER (PARTITION BY x) AS d FROM e)),
p AS (SELECT * FROM f WHERE k <= n - ceil(n * 0.8) + 1),
q AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM p a JOIN p b
      ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
v AS (SELECT q.a, q.b, count(*) AS i, any_value(x.n) + any_value(y.n) - count(*) AS u
      FROM q JOIN e x ON x.rep = q.a JOIN e y ON y.rep = q.b AND y.x = x.x GROUP BY q.a, q.b),
l AS (SELECT a, b FROM v WHERE 100 * i >= 80 * u),
g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS src, a AS dst FROM g UNION SELECT r.src, g.b FROM r JOIN g ON g.a = r.dst),
m AS (SELECT src, min(dst) AS component FROM r GROUP BY src)
SELECT s.doc_id, n.n AS n_shingles, coalesce(m.component, c.rep, s.doc_id) AS component_id,
  s.doc_id = coalesce(m.component, c.rep, s.doc_id) AS kept
FROM s JOIN n USING (doc_id) LEFT JOIN c ON c.shs = list_sort(s.sh) LEFT JOIN m ON m.src = c.rep
"""
