"""Near-duplicate groups: banded MinHash, sequential Bayesian verification, exact confirmation.

1. Every document becomes the set of its shingles' hashes.  Documents of one set form a class, numbered in the order of their smallest ids.
2. The classes' signatures are banded, in as many bands as the threshold and ``MISS`` ask for.  Every member of a bucket is a candidate with
   the bucket's smallest class.
3. Candidates are verified: batches of the signatures are compared and a pair is pruned once the posterior probability (uniform
   prior) that its similarity reaches the threshold falls below ``MISS``; the survivors are confirmed on their full sets.
4. The links found so far make components.  A bucket that lies in one component needs nothing more.  In another one, all pairs
   of different components are verified too, if it has at most ``SMALL`` members.
5. Members of larger unresolved buckets go through an exact prefix filter: a pair at the threshold shares one of the
   first shingles of both, in an order from rare to frequent, at positions that leave enough room.  In the groups of
   copies that such buckets hold, this leaves few pairs; none is lost.

So no bucket is capped, and no group is paired with itself in whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimwise.llm.common import WordHashes, mixed, short_batches, stored, words_of
from claimwise.llm.components import components

#: Values of a band; bands come in steps of as many, so that their values fill whole batches.
ROWS = 5
#: Values compared at once in the Bayesian test, and the probability of losing a pair at the threshold that it may take.
BATCH = 25
MISS = 1e-6
#: Buckets up to this size are paired directly, larger ones go through the prefix filter: two exact ways.
SMALL = 32
#: Counters of the frequency sketch that orders the shingles in step 5 (its errors cost time, not links).
SKETCH_BITS, SKETCH_CHUNK = 18, 1024
SHINGLE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=16)
def bands_for(percent: int, miss: float = MISS) -> int:
    """Bands with which a pair at the threshold shares no bucket with a probability of ``miss`` at most."""
    needed = math.log(miss) / math.log1p(-min(percent / 100, 1 - 1e-9) ** ROWS)
    return -(-math.ceil(needed) // ROWS) * ROWS


@lru_cache(maxsize=16)
def multipliers(bands: int) -> np.ndarray:
    rng = np.random.default_rng(51)
    return rng.integers(0, 1 << 63, ROWS * bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles; of fewer words the whole sequence; of none nothing."""
    h = hashes.of(words_of(text))
    if not len(h):
        return h
    k = min(k, len(h))
    x = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        x = x * SHINGLE + h[j:len(h) - k + 1 + j]
    return np.unique(mixed(x))


def signature(x: np.ndarray, bands: int) -> np.ndarray:
    """Smallest values of the set under each multiplier (their upper halves)."""
    by = multipliers(bands)
    low = np.full(len(by), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(x), 2048):
        np.minimum(low, (x[None, at:at + 2048] * by[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


@lru_cache(maxsize=16)
def least_matches(percent: int, total: int, batch: int = BATCH, miss: float = MISS) -> tuple[int, ...]:
    """For each number of compared values (a batch, two, ...) the fewest matches that keep a pair.

    With a uniform prior, after m matches of n the similarity has the posterior Beta(m + 1, n - m + 1); its mass above t is the
    chance of at most m successes in n + 1 trials of probability t."""
    t, out = min(percent / 100, 1 - 1e-9), []
    for n in range(batch, total + 1, batch):
        mass, m = 0.0, -1
        while m < n:
            m += 1
            ways = math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
            mass += math.exp(ways + m * math.log(t) + (n + 1 - m) * math.log1p(-t))
            if mass >= miss:
                break
        out.append(m)
    return tuple(out)


def likely(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of two signature matrices survive all batches; later batches compare survivors only."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, least in enumerate(least_matches(percent, a.shape[1])):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def _signed(rows: DataFrame, k: int, bands: int) -> DataFrame:
    """doc_id, text_id, n_shingles, digest of the set (null: empty set), signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, digests, signs = [], [], []
            for text in batch.column(2):
                x = shingles(text.as_py(), k, hashes)
                sizes.append(len(x))
                digests.append(xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None)
                signs.append(signature(x, bands).tobytes() if len(x) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())],
                ["doc_id", "text_id", "n_shingles", "digest", "signature"])

    return rows.mapInArrow(run, "doc_id long, text_id binary, n_shingles long, digest binary, signature binary")


def _buckets(signs: pd.Series) -> pd.Series:
    """The bucket of each signature in every band, as one hash of band and values."""
    if not len(signs):
        return pd.Series([], dtype=object)
    m = np.frombuffer(b"".join(signs), np.uint32).reshape(len(signs), -1, ROWS).astype(np.uint64)
    x = np.broadcast_to(np.arange(1, m.shape[1] + 1, dtype=np.uint64), m.shape[:2]).copy()
    for r in range(ROWS):
        x = mixed(x * SHINGLE + m[:, :, r])
    return pd.Series(list(x.view(np.int64)))


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets' similarity reaches the threshold: by size, by Bayesian test, by the full sets."""

    @F.pandas_udf("boolean")
    def test(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(s), np.uint32).reshape(len(s), -1) for s in (a, b))
        return pd.Series(likely(x, y, percent))

    @F.pandas_udf("boolean")
    def exact(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        held: dict[int, np.ndarray] = {}

        def of(i: int, text: str) -> np.ndarray:
            if i not in held:
                if len(held) >= 64:
                    held.clear()
                held[i] = shingles(text, k, hashes)
            return held[i]

        for a, ta, b, tb in batches:
            out = []
            for i, t, j, u in zip(a, ta, b, tb, strict=True):
                x, y = of(i, t), of(j, u)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pd.Series(out, dtype=bool)

    sides = [classes.select(F.col("id").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("signature").alias(f"s_{c}")) for c in "ab"]
    found = (pairs.join(sides[0], "a").join(sides[1], "b")
             .filter("100 * least(n_a, n_b) >= " + str(percent) + " * greatest(n_a, n_b)")
             .filter(test("s_a", "s_b")).select("a", "b"))
    found = stored(found, "dedup-likely")
    sides = [texts.select(F.col("id").alias(c), F.col("text").alias(f"t_{c}")) for c in "ab"]
    return stored(found.join(sides[1], "b").join(sides[0], "a").filter(exact("a", "t_a", "b", "t_b")).select("a", "b"), "dedup-links")


def _prefixes(members: DataFrame, k: int, percent: int) -> DataFrame:
    """For each of ``members`` (id, component, text) its first shingles, rare ones first: token, id, component, place, n."""
    spark = members.sparkSession

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, total = WordHashes(), np.zeros(1 << SKETCH_BITS, np.int64)
        for df in batches:
            for text in df["text"]:
                total += np.bincount((shingles(text, k, hashes) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        chunks = total.reshape(-1, SKETCH_CHUNK)
        some = np.flatnonzero(chunks.any(axis=1))
        yield pd.DataFrame({"chunk": some, "counts": [chunks[i].tobytes() for i in some]})

    def summed(df: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.int64) for x in df["counts"]], axis=0)
        return pd.DataFrame({"chunk": df["chunk"][:1], "counts": [total.tobytes()]})

    schema = "chunk long, counts binary"
    counts = np.zeros((1 << SKETCH_BITS) // SKETCH_CHUNK * SKETCH_CHUNK, np.int64).reshape(-1, SKETCH_CHUNK)
    for r in members.select("text").mapInPandas(sketch, schema).groupBy("chunk").applyInPandas(summed, schema).collect():
        counts[r["chunk"]] = np.frombuffer(r["counts"], np.int64)
    frequency = spark.sparkContext.broadcast(counts.ravel().astype(np.uint32))  # 2 ** SKETCH_BITS numbers

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for df in batches:
            out = []
            for i, c, text in zip(df["id"], df["component"], df["text"], strict=True):
                x = shingles(text, k, hashes)
                order = np.lexsort((x, frequency.value[(x >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))
                take = len(x) - -(-percent * len(x) // 100) + 1
                head = x[order[:take]].view(np.int64)
                out.append(pd.DataFrame({"token": head, "id": i, "component": c, "place": np.arange(len(head)), "n": len(x)}))
            yield pd.concat(out) if out else pd.DataFrame({x: pd.Series(dtype=np.int64) for x in ("token", "id", "component", "place", "n")})

    return members.mapInPandas(first, "token long, id long, component long, place long, n long")


def _prefix_pairs(members: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may reach the threshold; none that does is missing."""
    rows = stored(_prefixes(members, k, percent), "dedup-prefix")
    # overlap that sizes n and m need for the threshold t: t / (1 + t) * (n + m), rounded up
    needed = f"ceil({percent} * ({{}} + {{}}) / {100 + percent}D - 1e-9)"
    least = stored(rows.groupBy("token").agg(F.min("n").alias("least"), F.count("*").alias("count")).filter("count > 1"), "dedup-tokens")
    smallest = f"greatest(least, ceil({percent} * n / 100D - 1e-9))"
    rows = rows.join(least, "token").filter(f"n - place >= {needed.format('n', smallest)}").drop("least", "count")
    by_component = rows.groupBy("token", "component").agg(F.count("*").alias("count"))
    # all but the largest component of a token look for partners: a group that is linked already is not paired with itself
    major = (by_component.groupBy("token").agg(F.max_by("component", F.struct("count", "component")).alias("major"), F.count("*").alias("kinds"))
             .filter("kinds > 1").drop("kinds"))
    major = stored(major, "dedup-major")
    rows = stored(rows.join(major, "token"), "dedup-postings")
    left = rows.filter("component != major").select("token", *[F.col(c).alias(f"{c}_l") for c in ("id", "component", "place", "n")])
    met = left.join(rows, "token").filter(
        "component != component_l AND least(n - place, n_l - place_l) >= " + needed.format("n", "n_l"))
    return met.select(F.least("id", "id_l").alias("a"), F.greatest("id", "id_l").alias("b")).distinct()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_id (128 bits of the text), text: what tells rows of one id, or without one, apart."""
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("text_id"), text.alias("text"))


def _components(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """Per row: doc_id, text_id, n_shingles, digest, ``component`` (number of a component, null for an empty set) and ``component_id`` (smallest doc_id in it)."""
    spark = docs.sparkSession
    short_batches(spark)
    rows = _rows(docs, id_col, text_col)
    signed = stored(_signed(rows, k, bands_for(percent)), "dedup-signed")
    # rising numbers in the order of the smallest ids, rows without an id last: the smallest number of a component has its smallest id
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id")).alias("least")
    classes = (signed.filter("digest IS NOT NULL").groupBy("digest")
               .agg(first, F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
               .orderBy("least", "digest").select(F.monotonically_increasing_id().alias("id"), "digest", "least.doc_id", "least.text_id", "n_shingles", "signature"))
    classes = stored(classes, "dedup-classes")

    banded = classes.select("id", F.explode(F.pandas_udf(_buckets, "array<long>")("signature")).alias("bucket"))
    # aggregates that rows are joined with are tables of their own: right below a join they would keep it from splitting a hot bucket or token
    hubs = stored(banded.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("members")).filter("members > 1"), "dedup-hubs")
    members = stored(banded.join(hubs, "bucket"), "dedup-members")
    wanted = classes.join(members.select("id").distinct(), "id", "left_semi").select("id", F.col("doc_id").alias("i"), F.col("text_id").alias("t"))
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_id") == F.col("t"))
    texts = stored(rows.join(wanted, same).select("id", "text").dropDuplicates(["id"]), "dedup-texts")

    stars = stored(members.filter("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "dedup-stars")
    links = _confirmed(stars, classes, texts, k, percent)

    known = components(links).select(F.col("node").alias("id"), "component")
    labelled = members.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = stored(labelled, "dedup-labelled")
    open_buckets = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("bucket")
    open_buckets = stored(open_buckets, "dedup-open-buckets")
    unresolved = stored(labelled.join(open_buckets, "bucket"), "dedup-open")
    small = unresolved.filter(F.col("members") <= SMALL).select("bucket", "id", "component")
    other = small.select("bucket", F.col("id").alias("id_2"), F.col("component").alias("component_2"))
    few = small.join(other, "bucket").filter("id < id_2 AND component != component_2").select(F.col("id").alias("a"), F.col("id_2").alias("b"))
    many = unresolved.filter(F.col("members") > SMALL).select("id", "component").distinct().join(texts, "id")
    rest = few.unionAll(_prefix_pairs(many, k, percent)).distinct().join(stars, ["a", "b"], "left_anti")
    links = links.unionAll(_confirmed(rest, classes, texts, k, percent))

    own = classes.select("id", "digest").join(components(links), F.col("id") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "id").alias("component"))
    named = own.join(classes.select(F.col("id").alias("component"), F.col("doc_id").alias("component_id")), "component")
    return signed.select("doc_id", "text_id", "n_shingles", "digest").join(named, "digest", "left")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents linked by similar shingle sets: ``100 * intersection >= percent * union``.

    Words are runs without ASCII white space, A-Z lower-cased; a document's set has its distinct ``k``-word shingles, with fewer
    words the whole sequence.  Per row: ``doc_id``, ``n_shingles`` (set size), ``component_id`` (smallest id reachable over
    links, its own included), ``kept`` (doc_id = component_id).

    Null, empty and blank texts have an empty set and are linked with nothing, not even each other.  A row without an id belongs to
    its group, whose smallest id it gets, null if there is none; it is not kept.  Different texts under one id are rows of their own, each
    linked by its own text.  Repeated rows get equal results.  Ids are integers.  An empty table gives an empty result.
    Other columns are not read."""
    out = _components(docs, id_col, text_col, k, percent)
    component = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one of the smallest id, of rows without an id any one if the group has no other.

    Different texts under one id, and texts of rows without an id, stay unless they are duplicates of what is kept.  Texts without a word
    are duplicates of nothing and stay.  Of repeated rows one stays (those that differ in other columns count as repeated if id
    and text are equal).  See ``near_duplicates`` for the other cases."""
    found = _components(docs, id_col, text_col, k, percent).filter("component IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id")).alias("first")
    kept = found.groupBy("component").agg(first).select(F.col("first.doc_id").alias("i"), F.col("first.text_id").alias("t"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.unhex(F.md5(text)).alias("t"), whole, text.rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    order = F.row_number().over(Window.partitionBy("i", "t").orderBy(F.xxhash64("row")))
    one = (named.filter("worded").join(kept.withColumnsRenamed({"i": "ki", "t": "kt"}), F.col("i").eqNullSafe(F.col("ki")) & (F.col("t") == F.col("kt")), "left_semi")
           .withColumn("copy", order).filter("copy = 1").select("row"))
    return one.unionAll(named.filter("NOT worded").select("row")).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
