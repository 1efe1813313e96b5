"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

1. Each text becomes a set of 64-bit hashes of five-word shingles, and band keys of its minima. Texts of equal
   sets form a class (its key is a 128-bit digest of the set), so copies are met once and never paired.
2. Classes that share a band key are candidates, in the first band that they share. In a bucket, signatures that are
   independent of the bands are compared batch by batch; a pair is dropped as soon as the posterior probability
   that it reaches the threshold falls below a bound. Classes that have a pair left get their full sets, and
   the pairs are verified on these where they are, so that what is given out are links, at most one for each class of a bucket.
3. A bucket above ``BLOCK`` classes is dealt out in blocks. At first each block is compared with itself and with the
   next one, which joins what is alike everywhere. Where a bucket still holds several components, the
   members of its largest one are compared with those of the others, and these with one another, block by
   block; members of one component are never compared again. So a large group of copies costs as much as
   its size, and only a bucket of many texts that are not linked costs its square.
4. Components take the smallest id of their documents.

A pair at the threshold is missed with at most the probability ``miss`` in the comparison of signatures, over all its
looks, and with at most ``miss`` for sharing no band, (1 - t^ROWS)^bands; above it with far less. With the default of
1e-4 and 85 percent there are 20 bands, and the two are 7e-5 and 8e-5.

Cases: null and empty texts, and texts of white space, have no shingles and are linked with nothing; with one
to four words the whole sequence is the one shingle; texts are read whole; rows that repeat an id are judged
by their text each, and all rows of the smallest id of a component are kept; a row without id takes the id of
its component, and if that has none it is kept; an empty table gives an empty result. Extra columns are not used.
``keep_one`` keeps just one row of each component, that of the smallest id, and all rows without shingles, in all their
columns, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import ceil, inf, log, log1p

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm.common import drop, packed, stored, table, unpacked
from spanforge.llm.components import connected

SHINGLE, ROWS = 5, 6
#: Hashes of the signature that pairs are verified by, and of each batch.
SIGNATURE, BATCH = 512, 64
#: Slots of ids by which texts are left out early.
SLOTS = 1 << 20
#: Classes and shingles of a block, and parts that rows of one bucket or component are joined in.
BLOCK, BLOCK_SHINGLES, SALTS = 1024, 1 << 20, 8
U = np.uint64


def band_count(percent: int, miss: float) -> int:
    """As many bands that a pair at the threshold shares none with the probability ``miss`` at most."""
    return ceil(log(miss) / log1p(-((percent / 100) ** ROWS))) if percent < 100 else 1


def least_set(percent: int) -> float:
    """The fewest shingles of a set that can reach the threshold with another set: n / (n + 1) at best."""
    return ceil(percent / (100 - percent)) if percent < 100 else inf


@cache
def _parameters(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**63, n, dtype=U) * U(2) + U(1), rng.integers(0, 2**63, n, dtype=U)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text. ``bytes.lower`` and ``bytes.split`` know ASCII only."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    mixed = np.full(n, min(len(words), SHINGLE), U)
    for k in range(min(SHINGLE, len(words))):
        mixed = _mix(mixed * U(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(mixed)


def minima(shingles: np.ndarray, n: int, seed: int) -> np.ndarray:
    a, b = _parameters(n, seed)
    out = np.full(n, 2**32 - 1, np.uint32)
    for at in range(0, len(shingles), 1024):
        hashed = (shingles[at : at + 1024, None] * a + b) >> U(32)
        np.minimum(out, hashed.min(axis=0).astype(np.uint32), out=out)
    return out


def band_keys(shingles: np.ndarray, bands: int) -> np.ndarray:
    rows = minima(shingles, bands * ROWS, 1).astype(U).reshape(bands, ROWS)
    keys = np.arange(1, bands + 1, dtype=U)
    for k in range(ROWS):
        keys = _mix(keys * U(0x9E3779B97F4A7C15) + rows[:, k])
    return keys.view(np.int64)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def posterior_bounds(threshold: float, bound: float) -> tuple[int, ...]:
    """After each batch, the fewest equal bytes at which the posterior of a uniform prior still gives the threshold more
    than ``bound``. Bytes of different minima are equal once in 256."""
    x = (np.arange(20_000) + 0.5) / 20_000
    equal = x + (1 - x) / 256
    out = []
    for n in range(BATCH, SIGNATURE + 1, BATCH):
        for m in range(n + 1):
            logs = m * np.log(equal) + (n - m) * np.log1p(-equal)
            p = np.exp(logs - logs.max())
            if p[x >= threshold].sum() > bound * p.sum():
                out.append(m)
                break
    return tuple(out)


def drop_probability(least: tuple[int, ...], similarity: float) -> float:
    """How often a pair of this similarity is dropped after any of the batches."""
    equal = similarity + (1 - similarity) / 256
    step = np.array([1.0])
    for _ in range(BATCH):
        step = np.convolve(step, [1 - equal, equal])
    alive = np.array([1.0])
    for m in least:
        alive = np.convolve(alive, step)
        alive[:m] = 0
    return float(1 - alive.sum())


@cache
def least_matches(threshold: float, miss: float) -> tuple[int, ...]:
    """Posterior bounds at which a pair at the threshold is dropped with the probability ``miss`` at most, all looks together."""
    bound = miss
    while drop_probability(least := posterior_bounds(threshold, bound), threshold) > miss:
        bound /= 1.5
    return least


def signature(shingles: np.ndarray) -> bytes:
    """The lowest byte of each minimum."""
    return minima(shingles, SIGNATURE, 2).astype(np.uint8).tobytes()


def similarities(left: np.ndarray, right: np.ndarray, wanted: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Shares of equal bytes of the pairs in the mask ``wanted``; 0 for those pruned after some batch."""
    out = np.zeros(wanted.shape, np.float32)
    for begin in range(0, len(left), 128):
        rows, cols = np.nonzero(wanted[begin : begin + 128])
        rows += begin
        equal = np.zeros(len(rows), np.int32)
        for k, m in enumerate(least):
            part = slice(k * BATCH, (k + 1) * BATCH)
            for at in range(0, len(rows), 65_536):
                some = slice(at, at + 65_536)
                equal[some] += (left[rows[some], part] == right[cols[some], part]).sum(axis=1, dtype=np.int32)
            alive = equal >= m
            rows, cols, equal = rows[alive], cols[alive], equal[alive]
        out[rows, cols] = equal / SIGNATURE
    return out


class Block:
    """Classes of a bucket that are compared with one another: those of one side, or those of two sides across."""

    def __init__(self, band: int, rows: pa.Table, percent: int, miss: float):
        rows = rows.sort_by([("id", "ascending"), ("side", "ascending")])
        self.rows, self.percent = rows, percent
        self.node, self.comp = (rows.column(c).to_numpy() for c in ("id", "comp"))
        side, self.size = rows.column("side").to_numpy(), rows.column("n").to_numpy()
        sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(-1, SIGNATURE)
        bands = np.array(rows.column("bands").to_pylist(), np.int64).reshape(len(side), -1)
        pairs = np.triu(self.comp[:, None] != self.comp, 1)
        # A pair that shares several bands is compared in the first of them alone.
        for earlier in bands[:, : int(np.flatnonzero(bands[0] == band)[0])].T:
            pairs &= earlier[:, None] != earlier
        pairs &= 100 * np.minimum(self.size[:, None], self.size) >= percent * np.maximum(self.size[:, None], self.size)
        if rows.column("across")[0].as_py():
            pairs &= side[:, None] != side
        else:
            # Of a ring of blocks, the later one is compared with itself elsewhere.
            pairs &= (side == 0)[:, None] | (side == 0)
        self.alive = similarities(sig, sig, pairs, least_matches(percent / 100, miss)) > 0

    def survivors(self) -> pa.Table:
        """The rows with a pair that is not dropped."""
        return self.rows.filter(pa.array(self.alive.any(axis=0) | self.alive.any(axis=1)))

    def links(self) -> list[tuple[int, int]]:
        """Links that join the components of this block, from full sets. A class is held against all its partners that it is
        not joined with yet, at once."""
        sets = [np.frombuffer(x.as_py(), U) for x in self.rows.column("shingles")]
        group = np.unique(self.comp, return_inverse=True)[1]
        alive, out = self.alive | self.alive.T, []
        for u in range(len(sets)):
            others = np.flatnonzero(alive[u])
            for at in range(0, len(others), 64):
                some = others[at : at + 64]
                some = some[group[some] != group[u]]
                if not len(some):
                    continue
                every = np.concatenate([sets[v] for v in some])
                place = np.minimum(np.searchsorted(sets[u], every), len(sets[u]) - 1)
                both = np.add.reduceat((sets[u][place] == every).astype(np.int64), np.concatenate([[0], np.cumsum(self.size[some])[:-1]]))
                for v in some[100 * both >= self.percent * (self.size[u] + self.size[some] - both)]:
                    if group[v] != group[u]:
                        group[group == group[v]] = group[u]
                        out.append((int(self.node[u]), int(self.node[v])))
        return out


def shingled(docs: DataFrame, bands: int, least: float) -> DataFrame:
    """row, doc_id, n_shingles, node (the key of its set, null without shingles), h (of the text), bands (none of sets below
    ``least`` shingles, since these are linked with equal ones only) of ``docs`` (row, doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 512) for whole in batches for i in range(0, whole.num_rows, 512)):
            sizes, nodes, found = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py())
                sizes.append(len(shingles))
                nodes.append(set_key(shingles) if len(shingles) else None)
                found.append(band_keys(shingles, bands) if len(shingles) >= least else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id", "h")), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                names=["row", "doc_id", "h", "n_shingles", "node", "bands"],
            )

    rows = docs.select("row", "doc_id", F.xxhash64("text").alias("h"), "text")
    return rows.mapInArrow(run, "row long, doc_id long, h long, n_shingles long, node binary, bands array<long>")


def _signed(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, n, sig, shingles, bands of the classes in ``wanted`` (id, node, rep, bands), from the text of one document of each.

    Texts that fall in no slot of a wanted one are left out where they are read: there are at most ``SLOTS``
    slots to broadcast, whatever the number of classes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 512) for whole in batches for i in range(0, whole.num_rows, 512)):
            rows = []
            for text, at, node, bands in zip(batch.column("text"), *(batch.column(c).to_pylist() for c in ("id", "node", "bands"))):
                shingles = shingle_set(text.as_py())
                if len(shingles) and set_key(shingles) == node:
                    rows.append((at, len(shingles), signature(shingles), shingles.tobytes(), bands))
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=["id", "n", "sig", "shingles", "bands"])

    slot = lambda *c: F.pmod(F.xxhash64(*c), F.lit(SLOTS)).cast("int")
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    slots = wanted.select(slot("rep.doc_id", "rep.h").alias("_slot")).distinct()
    rows = rows.join(F.broadcast(slots), slot("doc_id", "h") == F.col("_slot"), "left_semi")
    same = rows["doc_id"].eqNullSafe(F.col("rep.doc_id")) & (rows["h"] == F.col("rep.h"))
    joined = rows.join(wanted, same).select("text", "id", "node", "bands")
    return joined.mapInArrow(run, "id long, n long, sig binary, shingles binary, bands array<long>").dropDuplicates(["id"])


def _joined(rows: DataFrame, small: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``small`` (one row for each ``key``) in ``SALTS`` parts of each key, dealt by ``by``."""
    salt = F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")
    each = small.withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return rows.withColumn("_salt", salt).join(each, [key, "_salt"], how).drop("_salt")


def _links(dealt: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """Verified links (u, v) of ``dealt`` (band, i, j, id, comp, side, across): blocks of a bucket, i and j, in which
    classes of different components are compared."""
    def compare(key, rows):
        return Block(key[0].as_py(), rows, percent, miss).survivors().select(kept)

    def verify(key, rows):
        found = Block(key[0].as_py(), rows, percent, miss).links()
        return pa.table({"u": pa.array([min(x) for x in found], pa.int64()), "v": pa.array([max(x) for x in found], pa.int64())})

    kept = ["band", "i", "j", "id", "comp", "side", "across"]
    block = ["band", "i", "j"]
    compared = dealt.join(sets.select("id", "n", "sig", "bands"), "id").groupBy(*block)
    alive = stored(compared.applyInArrow(compare, "band long, i int, j int, id long, comp long, side int, across boolean"), "near-pairs")
    # Few classes are left. Sets that fall in no slot of theirs aren't shuffled; slots are at most ``SLOTS``.
    slot = F.pmod(F.xxhash64("id"), F.lit(SLOTS)).cast("int")
    near = sets.join(F.broadcast(alive.select(slot.alias("_slot")).distinct()), slot == F.col("_slot"), "left_semi")
    return alive.join(near, "id").groupBy(*block).applyInArrow(verify, "u long, v long")


def _blocks(classes: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(classes / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _own(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("id"), blocks).cast("int")


def ring(buckets: DataFrame) -> DataFrame:
    """Each block of a bucket with itself and with the next one."""
    rows = buckets.withColumn("_blocks", _blocks(F.col("members"), F.col("weight"))).withColumn("_own", _own(F.col("_blocks")))
    several = F.col("_blocks") > 1
    places = F.when(several, F.array(F.struct(F.col("_own").alias("i"), F.lit(0).alias("side")), F.struct(F.pmod(F.col("_own") - 1, F.col("_blocks")).alias("i"), F.lit(1).alias("side"))))
    rows = rows.select("band", "id", F.explode(F.coalesce(places, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("side"))))).alias("_p"))
    return rows.select("band", "_p.i", F.lit(0).alias("j"), "id", F.col("id").alias("comp"), "_p.side", F.lit(False).alias("across"))


def apart(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Of buckets of several blocks that still hold several components: blocks of the largest component across those of
    the others, and the others' blocks with themselves and one another."""
    rows = buckets.where(_blocks(F.col("members"), F.col("weight")) > 1).select("band", "id", "n")
    rows = rows.join(roots.withColumnRenamed("u", "id"), "id", "left").withColumn("comp", F.coalesce("root", "id")).drop("root")
    parts = rows.groupBy("band", "comp").agg(F.count("*").alias("_c"), F.sum("n").alias("_w"))
    whole = parts.groupBy("band").agg(
        F.max_by(F.struct("comp", "_c", "_w"), F.struct("_c", "comp")).alias("_top"), F.sum("_c").alias("_all"), F.sum("_w").alias("_sum"), F.count("*").alias("_parts")
    ).where("_parts > 1")
    sizes = whole.select(
        "band", F.col("_top.comp").alias("_comp"), _blocks(F.col("_top._c"), F.col("_top._w")).alias("_large"),
        _blocks(F.col("_all") - F.col("_top._c"), F.col("_sum") - F.col("_top._w")).alias("_rest"),
    )
    rows = _joined(rows, sizes, "band", "id").withColumn("_top", F.col("comp") == F.col("_comp"))
    rows = rows.withColumn("_own", _own(F.when(F.col("_top"), F.col("_large")).otherwise(F.col("_rest"))))
    place = lambda i, j, side, across: F.struct(i.alias("i"), j.alias("j"), side.cast("int").alias("side"), across.alias("across"))
    # Blocks of the largest component have the numbers below 0.
    inside = F.transform(F.sequence(F.lit(0), F.col("_rest") - 1), lambda o: place(F.least("_own", o), F.greatest("_own", o), F.col("_own"), o != F.col("_own")))
    outside = F.transform(F.sequence(-F.col("_large"), F.lit(-1)), lambda o: place(o, F.col("_own"), F.lit(1), F.lit(True)))
    large = F.transform(F.sequence(F.lit(0), F.col("_rest") - 1), lambda o: place(-1 - F.col("_own"), o, F.lit(0), F.lit(True)))
    rows = rows.select("band", "id", "comp", F.explode(F.when(F.col("_top"), large).otherwise(F.concat(inside, outside))).alias("_p"))
    # In a block of its own, every class is on one side.
    return rows.select("band", "_p.i", "_p.j", "id", "comp", F.when(F.col("_p.across"), F.col("_p.side")).otherwise(0).alias("side"), "_p.across")


def _resolved(docs: DataFrame, percent: int, miss: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``docs`` (row, doc_id, text): the rows with their sets; node, component_id of all sets; and the first row of each component."""
    rows = stored(shingled(docs, band_count(percent, miss), least_set(percent)), "shingled")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    some = F.struct("doc_id", "h")
    classes = rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min(some).alias("rep"), first.alias("first"), F.min("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    # Numbers of classes, short to shuffle; they hold from here on, since the table is written.
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    bands = classes.where("bands is not null").select("id", "n", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("members"), F.sum("n").alias("weight")).where("members > 1")
    buckets = stored(_joined(bands, shared, "band", "id"), "buckets")
    wanted = stored(classes.select("id", "node", "rep", "bands").join(buckets.select("id").distinct(), "id", "left_semi"), "wanted")
    sets = stored(_signed(docs, wanted), "sets")
    links = stored(_links(ring(buckets), sets, percent, miss), "links")
    roots = connected(links)
    more = stored(_links(apart(buckets, roots), sets, percent, miss), "more-links")
    if more.head(1):
        roots = connected(more.union(roots.toDF("u", "v")))
    placed = classes.select("id", "node", "least", "first").join(roots.withColumnRenamed("u", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    placed = stored(placed, "placed")
    drop(classes, buckets, wanted, sets)
    whole = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("first"))
    # The smallest id, for the classes of components of several.
    several = whole.select("root", "component_id").join(roots.select("root").distinct(), "root", "left_semi")
    ids = _joined(placed, several, "root", "id", "left").select("node", F.coalesce("component_id", "least").alias("component_id"))
    return rows, ids, whole.select("first.row")


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def near_duplicates(docs: DataFrame, *, percent: int = 85, miss: float = 1e-4) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text)."""
    rows, ids, _ = _resolved(_numbered(docs), percent, miss)
    found = rows.select("doc_id", "n_shingles", "node").join(ids, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def keep_one(docs: DataFrame, *, percent: int = 85, miss: float = 1e-4) -> DataFrame:
    """One row of each component, in the columns of ``docs``. The rows are written with a number each, since an id may repeat."""
    row = F.monotonically_increasing_id().alias("_row")
    numbered = stored(packed(docs, row, F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text")), "numbered")
    rows, _, first = _resolved(numbered.select(F.col("_row").alias("row"), F.col("_id").alias("doc_id"), F.col("_text").alias("text")), percent, miss)
    kept = first.union(rows.where("node is null").select("row")).select(F.col("row").alias("_row"))
    return unpacked(_marked(numbered, kept), docs.columns)


def _marked(numbered: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``numbered`` (_row, ...) whose numbers are in ``kept`` (_row). One bit for each number goes to all executors, in pieces of 32,768 numbers of
    a partition, so that no text is shuffled."""
    marks = kept.groupBy(F.bitmap_bucket_number("_row").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_row")).alias("_bits"))
    marks = stored(marks, "kept-rows")
    place = F.bitmap_bit_position("_row")
    byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = numbered.join(F.broadcast(marks), F.bitmap_bucket_number("_row") == F.col("_bucket"))
    return rows.where(F.pmod(F.call_function("shiftright", byte, (place % 8).cast("int")), F.lit(2)) == 1)
