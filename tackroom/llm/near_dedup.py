"""MinHash near-dedup by b-bit signatures (operator 3).

1. One pass over the texts gives per document the size and a digest of its
   shingle set, the keys of its MinHash bands and a b-bit signature: the two
   low bits of each minimum, packed into longs.
2. Documents with equal sets collapse to the smallest id before any pairing, so
   a group of copies costs one grouped row, whatever its size.
3. Band buckets are paired as stars: every member with the smallest id of its
   bucket. Bit counts of the xor-ed signatures, corrected for chance collisions,
   drop pairs that are far below the threshold; a parity bitmap of the set drops
   those with too many differing shingles; the rest are confirmed on the full
   shingle sets. Buckets that still hold several components afterwards are
   completed: only pairs across components are compared, so a large group of
   near copies never expands into all its pairs, and no link is lost.
4. Connected components of the confirmed links.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tackroom.llm.components import components
from tackroom.llm.hashing import MinHasher, band_keys, low_bits, parity_bits, shingle_hashes, word_hashes
from tackroom.llm.storage import materialize

PERMUTATIONS = 128   # 32 bands of 4 rows: a pair of similarity 0.8 shares no band once in 2 * 10**7
ROWS = 4
BITS = 2
# Standard deviations below the threshold at which an estimate still goes on to
# the exact comparison; the chance to lose a true pair is about 1e-9.
MARGIN = 6.0
PARITY = 1024        # bits of the bitmap that bounds how many shingles differ
_SIGNATURE = [f"s{i}" for i in range(BITS * PERMUTATIONS // 64)]
_PARITY = [f"p{i}" for i in range(PARITY // 64)]

_SIGNATURE_SCHEMA = ("id long, n_shingles long, digest binary, bands array<long>, "
                     + ", ".join(f"{c} long" for c in _SIGNATURE + _PARITY))


def _arrow_list(values: np.ndarray) -> pa.Array:
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * k, k, dtype=np.int32)), pa.array(values.ravel()))


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Per row: id, set size, set digest, band keys (none for an empty set) and the b-bit signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(PERMUTATIONS)
        for batch in batches:
            words, first = word_hashes(batch.column(1))
            sh, at = shingle_hashes(words, first, shingle)
            n = np.zeros(len(at) - 1, dtype=np.int64)
            digests, parity = [], np.zeros((len(n), len(_PARITY)), dtype=np.int64)
            for t in range(len(n)):
                distinct = np.unique(sh[at[t]:at[t + 1]])
                n[t] = len(distinct)
                digests.append(blake2b(distinct.tobytes(), digest_size=16).digest())
                parity[t] = parity_bits(distinct, PARITY)
            minima = hasher.minima(sh, at)
            low = low_bits(minima, BITS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(digests, pa.binary()),
                 _arrow_list(band_keys(minima, ROWS)), *(pa.array(x.copy()) for x in low.T), *(pa.array(x.copy()) for x in parity.T)],
                names=["id", "n_shingles", "digest", "bands", *_SIGNATURE, *_PARITY])
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, _SIGNATURE_SCHEMA))


def _estimate(x: str, y: str):
    """Collision-corrected similarity of two b-bit signatures: minima differ where any plane differs."""
    words = PERMUTATIONS // 64
    differ = F.lit(0)
    for w in range(words):
        diff = F.lit(0).cast("long")
        for b in range(BITS):
            c = f"s{b * words + w}"
            diff = diff.bitwiseOR(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}")))
        differ = differ + F.bit_count(diff)
    chance = 2.0 ** -BITS
    return (1.0 - differ / F.lit(float(PERMUTATIONS)) - chance) / (1.0 - chance)


def _possible(x: str, y: str, num: int, den: int):
    """False only for pairs that cannot reach the similarity (sizes, bound on differing shingles) or whose estimate
    lies far below it."""
    nx, ny = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    differ = F.lit(0)
    for c in _PARITY:
        differ = differ + F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}")))
    return ((F.least(nx, ny) * den >= F.greatest(nx, ny) * num) & (differ * (num + den) <= (nx + ny) * (den - num))
            & (_estimate(x, y) >= estimate_floor(num / den)))


def estimate_floor(threshold: float) -> float:
    """The estimate below which a pair of similarity ``threshold`` practically never falls."""
    chance = 2.0 ** -BITS
    p = chance + (1 - chance) * threshold
    return threshold - MARGIN * (p * (1 - p) / PERMUTATIONS) ** 0.5 / (1 - chance)


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """The (a, b) pairs with den * |A and B| >= num * |A or B| over their full shingle sets.

    The text of ``a`` travels to ``b``'s, pair by pair; a ``b`` that many pairs
    share is split by adaptive execution, since nothing is grouped here.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for c in (2, 3):
                words, first = word_hashes(batch.column(c))
                sets.append(shingle_hashes(words, first, shingle))
            (sa, fa), (sb, fb) = sets
            keep = []
            for i in range(batch.num_rows):
                a, b = np.unique(sa[fa[i]:fa[i + 1]]), np.unique(sb[fb[i]:fb[i + 1]])
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both > 0 and den * both >= num * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    ta = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return (pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb")
            .mapInArrow(run, "a long, b long").distinct())


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_shingles, component_id, kept.

    Two documents are linked if similarity[1] * |A and B| >= similarity[0] *
    |A or B| over their sets of distinct ``shingle``-word shingles (words: runs
    of anything but ASCII white space, A-Z lower-cased; a text of fewer words,
    but not none, has its whole sequence as one shingle). ``component_id`` is
    the smallest id reachable over links, the document itself included.

    Null and empty texts have no shingles and are linked with nothing. A row
    without an id gets a null component and is kept. Rows that share an id are
    one document: it is linked if any of its texts is; each row is returned.
    Exact copies give one group with ties broken by the smallest id. An empty
    table gives no rows; other columns are ignored, whatever their names.
    """
    num, den = similarity
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sig = materialize(signatures(base, "id", "text", shingle), "minhash")
    linked = sig.where("n_shingles > 0 and id is not null")
    # one representative per distinct set; partial aggregation absorbs the copies
    rep = linked.groupBy("digest").agg(F.min("id").alias("rep"))
    longs = ["n_shingles", *_SIGNATURE, *_PARITY]
    own = materialize(linked.join(rep, (linked.id == rep.rep) & (linked.digest == rep.digest), "left_semi")
                      .select("id", "bands", *longs), "representatives")
    member = own.select("id", F.explode("bands").alias("key"))
    texts = base.join(own.select("id"), "id", "left_semi")

    def confirm(pairs: DataFrame, name: str) -> DataFrame:
        return materialize(_confirmed(pairs, texts, shingle, num, den), name)

    bits = own.select("id", *longs)
    pivot = member.groupBy("key").agg(F.min("id").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    star = member.select("key", F.col("id").alias("a")).join(pivot, "key").where("a <> b").select("a", "b").distinct()
    near = (star.join(bits.alias("x"), F.col("a") == F.col("x.id")).join(bits.alias("y"), F.col("b") == F.col("y.id"))
            .where(_possible("x", "y", num, den)).select("a", "b"))
    # rows that share an id are one document: the representatives of its texts are linked
    several = linked.groupBy("id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo < hi").select("id")
    sets = linked.select("id", "digest").join(several, "id", "left_semi").join(rep, "digest").select("id", "rep").distinct()
    first = sets.groupBy("id").agg(F.min("rep").alias("b"))
    shared = materialize(sets.join(first, "id").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct(), "shared-ids")
    links = confirm(near, "star-links").union(shared)
    found = components(links)

    # Buckets in which the stars left more than one component: the pairs across components.
    labelled = (member.select("key", "id").join(found, "id", "left")
                .select("key", "id", F.coalesce("component", "id").alias("component")))
    open_keys = (labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                 .where("lo < hi").select("key"))
    rest = materialize(labelled.join(open_keys, "key", "left_semi").join(bits, "id")
                       .select("key", "id", "component", *longs), "open-buckets")
    x, y = rest.alias("x"), rest.alias("y")
    across = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component"))
                     & _possible("x", "y", num, den))
              .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
    more = confirm(across, "cross-links")
    if more.limit(1).count():
        found = components(links.union(more))

    group = (rep.join(found, rep.rep == found.id, "left")
             .select("digest", F.coalesce("component", "rep").alias("group")))
    grouped = sig.select("id", "n_shingles", "digest").join(group, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("group")).otherwise(F.col("id"))
    return grouped.select(F.col("id").alias(id_col), "n_shingles",
                          F.when(F.col("id").isNotNull(), component).alias("component_id"),
                          F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept: one document of each group, documents without words, rows without an id."""
    gone = (near_groups(docs, id_col, text_col, **options).where("not kept")
            .select(F.col(id_col).alias("__gone")).distinct())
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__gone"), "left_anti")
