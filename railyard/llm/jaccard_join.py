"""Word n-gram Jaccard self-join by PartEnum signatures (operator 9).

Sets of one size band that are similar enough differ in at most k elements. The feature domain is dealt into n1
partitions, each into n2 cells; for every partition and every subset of n2 - k2 of its cells, a signature hashes the
set's elements in that subset. As k < n1 * (k2 + 1), two such sets share a signature. A set emits signatures for its
own band and for those its larger partners may be in, so no linked pair is missed.

Spark does the rest: signatures that different sets share are found by a pre-aggregated group-by; a bounded Bloom
filter lets only their rows shuffle again. Buckets of at most ``FEW`` members are compared within. In larger ones all
members are compared with one pivot. Members of unsettled buckets of one pivot, up to ``MANY``, are then compared block
by block on their sketches in numpy. Of more, those that don't reach the pivot's component go on in new, smaller buckets
of members that share a difference from the pivot (``_closer_buckets`` says why none that link are parted), with a pivot
each again, and only what is in several components even then is compared block by block. So the components are exact, without emitting the
pairs of a large group. Sizes and 1024-bit parity sketches (whose Hamming distance bounds the sets' difference from
below) dismiss pairs. A sketch of so many bits says nothing of a set with more elements, so pairs of large sets meet
on fine sketches too, of one to two bits an element; only what is left is verified on whole sets.

Defined cases: null, empty or blank texts have no shingles and link with nothing. Texts of fewer words than a shingle
form one shingle. Rows with equal sets (copies, repeated rows, repeated or null ids) are one class and share a
component; component_id is the smallest non-null doc_id of the component (null if there is none). Other columns take
no part. Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import bloom
from railyard.llm.common import bounded_batches, discard, documents, stored
from railyard.llm.components import components
from railyard.llm.wordhash import list_column, mix, shingle_sets, sums, text_chunks, word_hashes

_U = np.uint64
BAND_RATIO = 1.3  # largest size of a band against its smallest
FEW = 16  # members of a bucket that are compared with each other
SKETCH_WORDS = 16
LARGE = 512  # elements from which on a set has a fine sketch
MANY = 4096  # members of a cluster of buckets that are compared block by block
ROWS = 1024  # texts hashed at a time
PIVOT_BYTES = 32 << 20  # sets of the pivots of huge clusters up to which they are broadcast
BLOCK = 2048  # members of a block of a large bucket


@dataclass(frozen=True)
class Join:
    """Shingle width and the Jaccard threshold ``num / den``."""

    width: int = 5
    num: int = 8
    den: int = 10

    def largest_difference(self, total: int) -> int:
        """Of two linked sets whose sizes sum to ``total``."""
        return total * (self.den - self.num) // (self.den + self.num)


def bands(join: Join, largest: int) -> np.ndarray:
    """First sizes of the bands up to the one that holds ``largest``."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * BAND_RATIO) + 1))
    return np.array(out, np.int64)


@lru_cache(maxsize=None)
def layout(join: Join, top: int) -> tuple[int, int, int, int] | None:
    """(n1, n2, k2, spare) for sets of at most ``top`` elements; None if only equal sets can link.

    ``spare`` partitions more than the pigeonhole needs let every set leave out its thinnest signatures (``_kept``)."""
    k = join.largest_difference(2 * top)
    if not k:
        return None
    if k <= 2:
        return 1, k + 2, k, 0
    k2, n2 = (1, 3) if k <= 24 else (0, 1)
    covered = top / (k + 1) * (k2 + 1) * (n2 - k2) / n2
    spare = 1 + k // (12 if covered >= 8 else 6)
    return k // (k2 + 1) + 1 + spare, n2, k2, spare


def _kept(covered: np.ndarray, value: np.ndarray, spare: int) -> np.ndarray:
    """Which signatures (set, partition, subset) a set emits: it leaves out the first ones, by number of elements, then
    by value, as long as they lie in no more than ``spare`` partitions.

    Two linked sets share signatures in ``spare`` + 1 partitions at least, in the same order. The last of them comes
    after those of ``spare`` other partitions in either set, so both emit it. Signatures over no or one element, which
    sets that have nothing to do with each other share, are the first to go."""
    order = (covered.astype(np.uint64) << _U(32)) | (value >> _U(32))
    first = np.partition(order.min(2), spare, axis=1)[:, spare]
    return order >= first[:, None, None]


def _cell_sums(cell: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64; float64 holds sums of 32-bit halves exactly."""
    low = np.bincount(cell, (values & _U(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64)
    high = np.bincount(cell, (values >> _U(32)).astype(np.float64), n).astype(np.uint64)
    return low + (high << _U(32))


def signatures(join: Join, sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures end to end and, for each, the number of its set."""
    sizes = np.diff(at)
    starts = bands(join, int(sizes.max(initial=1)) * join.den // join.num + 1)
    own = np.searchsorted(starts, sizes, "right") - 1
    upper = np.searchsorted(starts, sizes * join.den // join.num, "right") - 1
    found, owner = [], []
    mixed = mix(sets)
    for band in range(int(upper.max(initial=0)) + 1):
        plan = layout(join, int(starts[band + 1]) - 1) if band + 1 < len(starts) else None
        which = np.flatnonzero((own <= band) & (band <= upper) & (sizes > 0))
        if plan is None or not len(which):
            continue
        n1, n2, k2, spare = plan
        spans = [slice(at[w], at[w + 1]) for w in which]
        elements = np.concatenate([mixed[s] for s in spans])
        row = np.repeat(np.arange(len(which)), sizes[which])
        part = (mix(elements + _U(band)) >> _U(33)) % _U(n1 * n2)
        cell = row * (n1 * n2) + part.astype(np.int64)
        shape = (len(which), n1, n2)
        total = _cell_sums(cell, mix(elements ^ _U(0x5851F42D4C957F2D)), len(which) * n1 * n2).reshape(shape)
        count = np.bincount(cell, minlength=len(which) * n1 * n2).reshape(shape)
        subsets = list(combinations(range(n2), n2 - k2))
        covered = np.stack([count[:, :, list(s)].sum(2) for s in subsets], 2)
        tag = mix(np.arange(n1 * len(subsets), dtype=np.uint64) + _U(band << 32)).reshape(n1, len(subsets))
        value = mix(np.stack([total[:, :, list(s)].sum(2, dtype=np.uint64) for s in subsets], 2) + tag)
        keep = _kept(covered, value, spare)
        found.append(value[keep])
        owner.append(np.repeat(which, keep.sum((1, 2))))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owner)


def _sketch(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Parity of the number of elements in each of SKETCH_WORDS * 64 cells."""
    n, bits = len(at) - 1, SKETCH_WORDS * 64
    cell = np.repeat(np.arange(n), np.diff(at)) * bits + (mix(sets ^ _U(0xA0761D6478BD642F)) % _U(bits)).astype(np.int64)
    odd = (np.bincount(cell, minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits)
    return np.packbits(odd, axis=1).view(np.uint64)


def _node(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(sums(mix(sets), at) + np.diff(at).astype(np.uint64)).view(np.int64)


def _profiles(join: Join, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch.column(1), rows=ROWS):
            sets, at = shingle_sets(*word_hashes(data, offsets), join.width)
            sketch = _sketch(sets, at)
            fine = list_column(*_fine(sets, at))
            n = end - first
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, n), batch.column(2).slice(first, n), pa.array(np.diff(at)), pa.array(_node(sets, at)),
                list_column(sketch.ravel(), np.arange(n + 1) * SKETCH_WORDS), fine], ["doc_id", "text_hash", "n", "node", "sketch", "fine"])


def _signature_rows(join: Join, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(0), rows=ROWS):
            sets, at = shingle_sets(*word_hashes(data, offsets), join.width)
            found, owner = signatures(join, sets, at)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(_node(sets, at)[owner])], ["sig", "node"])


def _sets(join: Join, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(0), rows=ROWS):
            sets, at = shingle_sets(*word_hashes(data, offsets), join.width)
            yield pa.RecordBatch.from_arrays([pa.array(_node(sets, at)), list_column(sets, at)], ["node", "elements"])


def _fine(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity sketches of 1 to 2 bits an element (a power of two), end to end, and their offsets; none for sets of so
    few elements that a partner has no more than LARGE. Half of one's words XOR the other half are the sketch of half as many bits."""
    sizes = np.diff(at)
    has = sizes > LARGE // 2
    bits = np.where(has, 1 << (np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)), 0)
    ends = np.cumsum(bits)
    inside = np.repeat(has, sizes)
    cell = mix(sets[inside] ^ _U(0x8EBC6AF09C88C6E3)).astype(np.int64) & (np.repeat(bits, sizes)[inside] - 1)
    odd = np.bincount(cell + np.repeat(ends - bits, sizes)[inside], minlength=int(ends[-1]) if len(ends) else 0) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64), np.concatenate([[0], ends // 64])


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def _near_on_fine(join: Join, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (u, v, u_n, v_n) whose fine sketches don't dismiss them."""
    for batch in batches:
        n = batch.num_rows
        total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
        sides = [(c.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy())]))
                 for c in (batch.column(4), batch.column(5))]
        keep = np.zeros(n, bool)
        for i in range(n):
            a, b = (words[at[i]:at[i + 1]] for words, at in sides)
            if not len(a) or not len(b):  # a partner of less than half the size
                keep[i] = True
                continue
            apart = int(np.bitwise_count(_folded(a, len(b)) ^ _folded(b, len(a))).sum(dtype=np.int64))
            keep[i] = apart * (join.den + join.num) <= total[i] * (join.den - join.num)
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep)) for k in range(4)], ["u", "v", "u_n", "v_n"])


def _shared(texts: DataFrame, n_texts: int, join: Join) -> DataFrame:
    """(sig, node) of signatures that at least two different sets have.

    First only short prints of the signatures are counted, 7 bits longer than their number needs, which takes half of
    the room; then the signatures whose print occurs twice are compared as they are, with their sets. Computing them
    again is cheaper than keeping them."""
    rows = texts.mapInArrow(partial(_signature_rows, join), "sig long, node long")
    bits = min(max(32, int(math.log2(128 * max(1, n_texts))) + 7), 62)
    rows = rows.withColumn("print", F.col("sig").bitwiseAND(F.lit((1 << bits) - 1)))
    prints = stored(rows.groupBy("print").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select(
        F.xxhash64("print").alias("h")), "repeated-prints")
    n_words = bloom.words_for(prints.count())
    table = stored(bloom.filter_table(prints, "h", n_words), "repeated-print-bits")
    near = bloom.probe(rows.select("sig", "node", F.xxhash64("print").alias("h")), "h", table, n_words, "maybe").where("maybe")
    near = stored(near.select("sig", "node").distinct(), "likely-shared")
    discard(prints, table)
    # stored, so that the join has a table on either side and a hot signature's partition is split
    multi = stored(near.groupBy("sig").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("sig"),
                   "shared-signatures")
    buckets = stored(near.join(multi, "sig", "left_semi"), "buckets")
    discard(near, multi)
    return buckets


def _side(table: DataFrame, name: str) -> DataFrame:
    return table.select(*[F.col(c).alias(name if c == "node" else f"{name}_{c}") for c in table.columns])


def _close(pairs: DataFrame, nodes: DataFrame, join: Join) -> DataFrame:
    """The pairs (u, v) that sizes and sketches don't dismiss, with u_n and v_n."""
    both = pairs.join(_side(nodes, "u"), "u").join(_side(nodes, "v"), "v")
    low, high, total = F.least("u_n", "v_n"), F.greatest("u_n", "v_n"), F.col("u_n") + F.col("v_n")
    apart = sum((F.bit_count(F.col("u_sketch")[i].bitwiseXOR(F.col("v_sketch")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    return both.where((low * join.den >= high * join.num)
                       & (apart * (join.den + join.num) <= total * (join.den - join.num))).select("u", "v", "u_n", "v_n")


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()


def _verified(close: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The pairs (u, v) that link."""
    whole = close.join(_side(sets, "u"), "u").join(_side(sets, "v"), "v")
    common = F.size(F.array_intersect("u_elements", "v_elements"))
    return whole.where(common * join.den >= (F.col("u_n") + F.col("v_n") - common) * join.num).select("u", "v")


def _closer_buckets(rows: DataFrame, sets: DataFrame, of_pivots: DataFrame, join: Join) -> DataFrame:
    """(key, node, weight): buckets of members that may link though they don't reach their pivot's component.

    rows: (cluster, pivot, pivot_comp, node, comp, weight). Take a member x that doesn't link with pivot p, and a y that
    links with x. Let d be the elements in which a set differs from p's, and c = (den - num) / (den + num). As x and y
    differ in at most c * (x + y) elements and x and p in more than c * (x + p), d(x) and d(y) share more than
    ((|d(x)| - c * (x + p)) + (1 - c) * |d(y)|) / 2 elements, either term of which alone is a bound too. So, in any
    fixed order, the first elements of d(x) and of d(y), as many as are left without that number and one more, have one
    in common. Here elements that p hasn't come first: a copy's own edits, which hardly any other member has. A bucket
    therefore holds the few members that share an edit, and never the pivot.

    Far from the pivot the usual prefix of a set is shorter. In the same order, own elements before those that p has
    too, let L(x) be one more than the elements of x that a linked set may lack. The first element that x and y share is
    among the first L(x) of x and the first L(y) of y. If x is far, with L(x) own elements or more, that element is an
    own one of both. So far members go into the buckets of their first L own elements, near ones into those of all
    their own and of the rule above, which holds for two near members."""
    both = rows.join(sets, "node").join(of_pivots.select(F.col("node").alias("pivot"), F.col("elements").alias("of_pivot")), "pivot")
    both = both.select("cluster", "node", "weight", (F.col("comp") != F.col("pivot_comp")).alias("outside"),
                       F.array_except("elements", "of_pivot").alias("own"), F.array_except("of_pivot", "elements").alias("lacked"),
                       F.size("elements").alias("n"), (F.size("elements") + F.size("of_pivot")).alias("total"))
    apart, whole = F.size("own") + F.size("lacked"), join.den + join.num
    shared = F.when(F.col("outside"), (apart * whole - F.col("total") * (join.den - join.num)) / (2 * whole)).otherwise(apart * join.num / whole)
    of_apart = F.greatest(apart - F.greatest(F.floor(shared).cast("int"), F.lit(0)), F.size("own"))
    prefix = F.floor(F.col("n") * (join.den - join.num) / join.den).cast("int") + 1
    elements = F.when(F.size("own") >= prefix, F.slice("own", F.lit(1), prefix)).otherwise(
        F.slice(F.concat("own", "lacked"), F.lit(1), of_apart))
    return both.select(F.explode(elements).alias("element"), "cluster", "node", "weight").select(
        F.xxhash64("cluster", "element").alias("key"), "node", "weight")


def _met(rows: DataFrame) -> DataFrame:
    """The rows (key, node, weight) of keys that occur twice, and few others; ``rows``, a stored table, is deleted."""
    keys = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("key"), "repeated-keys")
    n_words = bloom.words_for(keys.count())
    table = stored(bloom.filter_table(keys, "key", n_words), "repeated-key-bits")
    met = stored(bloom.probe(rows, "key", table, n_words, "maybe").where("maybe").drop("maybe"), "met")
    discard(rows, keys, table)
    return met


def _compare_block(join: Join, rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one cell of a bucket (rows of block i with rows of block j) that sizes and sketches don't dismiss."""
    one, other = rows[rows["i_side"]], rows[rows["j_side"]]
    other = other.reset_index(drop=True)
    node, comp, n = other["node"].to_numpy(), other["comp"].to_numpy(), other["n"].to_numpy()
    by_width: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]] = {}  # kind of sketch -> width -> rows, words
    for kind in ("sketch", "fine"):
        widths = np.array([0 if x is None else len(x) for x in other[kind]], np.int64)
        by_width[kind] = {int(w): (at := np.flatnonzero(widths == w), np.stack([np.asarray(x, np.int64) for x in other[kind][at]]).view(np.uint64))
                          for w in np.unique(widths[widths > 0])}
    folded: dict[tuple[int, int], np.ndarray] = {}

    def words_of(kind: str, own: int, width: int) -> np.ndarray:
        if own == width:
            return by_width[kind][own][1]
        if (own, width) not in folded:
            folded[own, width] = _folded(by_width[kind][own][1], width)
        return folded[own, width]

    found = []
    for x in one.itertuples(index=False):
        ok = (comp != x.comp) & (np.minimum(n, x.n) * join.den >= np.maximum(n, x.n) * join.num)
        told = np.zeros(len(n), bool)  # by the sketch of fixed width where both have it, else by the fine one
        for kind, words in (("sketch", x.sketch), ("fine", x.fine)):
            if words is None or not len(words):
                continue
            mine = np.asarray(words, np.int64).view(np.uint64)
            for own, (at, _) in by_width[kind].items():
                open_ = ok[at] & ~told[at]
                if not open_.any():
                    continue
                width = min(own, len(mine))
                apart = np.bitwise_count(words_of(kind, own, width)[open_] ^ _folded(mine, width)).sum(1, dtype=np.int64)
                rows = at[open_]
                ok[rows] = apart * (join.den + join.num) <= (n[rows] + x.n) * (join.den - join.num)
                told[rows] = True
        found += [(x.node, y) for y in node[ok]]
    return pd.DataFrame(found, columns=["node", "other"], dtype="int64")


def _within(members: DataFrame, nodes: DataFrame, join: Join) -> DataFrame:
    """(node, other) of different components that may link, from (key, members, node, comp).

    A bucket is dealt into blocks of about BLOCK members and every two blocks meet in one cell, so that a task never
    holds more than two blocks; pairs that can't link are never emitted."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = members.join(nodes, "node").withColumn("blocks", blocks).withColumn("own", own).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("own", "with"), F.greatest("own", "with")
    cells = dealt.select("key", i.alias("i"), j.alias("j"), (F.col("own") == i).alias("i_side"), (F.col("own") == j).alias("j_side"),
                         "node", "comp", "n", F.when(F.col("n") <= LARGE, F.col("sketch")).alias("sketch"), "fine")
    return cells.groupBy("key", "i", "j").applyInPandas(partial(_compare_block, join), "node long, other long")


def _connect(buckets: DataFrame, nodes: DataFrame, sets_of: Callable[..., DataFrame], join: Join) -> DataFrame:
    """(node, comp) of all nodes that link with another, from (sig, node). ``sets_of`` gives whole sets of nodes."""
    # the member with most shared signatures differs least from the others: a good pivot
    weight = stored(buckets.groupBy("node").agg(F.count(F.lit(1)).alias("weight")), "weights")
    rows = stored(buckets.join(weight, "node").select(F.col("sig").alias("key"), "node", "weight"), "bucket-rows")
    discard(weight, buckets)
    links, comps = None, nodes.select("node", F.col("node").alias("comp")).limit(0)

    def with_comp(table: DataFrame) -> DataFrame:
        return table.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def open_members(table: DataFrame) -> DataFrame:
        """Rows of buckets that hold several components, with the bucket's size and pivot."""
        known = stored(with_comp(table), "rows")
        keys = stored(known.groupBy("key").agg(
            F.count(F.lit(1)).alias("members"), F.min("comp").alias("a"), F.max("comp").alias("b"),
            F.max(F.struct("weight", "node", "comp")).alias("p")).where("a < b").select(
            "key", "members", F.col("p.node").alias("pivot"), F.col("p.comp").alias("pivot_comp")), "open-buckets")
        members = stored(known.join(keys, "key"), "members")
        discard(known, keys)
        return members

    def add_links(pairs: DataFrame) -> None:
        nonlocal links, comps
        pairs = pairs.select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")).distinct()
        close = stored(_close(pairs, nodes, join), "close-pairs")
        is_large = F.greatest("u_n", "v_n") > LARGE
        large = close.where(is_large)
        if not large.isEmpty():
            fine = nodes.select("node", "fine")
            both = large.join(_side(fine, "u"), "u").join(_side(fine, "v"), "v").select("u", "v", "u_n", "v_n", "u_fine", "v_fine")
            near = both.mapInArrow(partial(_near_on_fine, join), "u long, v long, u_n long, v_n long")
            left = stored(close.where(~is_large).unionByName(near), "close-pairs")
            discard(close)
            close = left
        if close.isEmpty():
            return
        sets = sets_of(_nodes_of(close))
        new = stored(_verified(close, sets, join), "links")
        discard(close, sets)
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            comps = stored(components(links), "components")

    def star(table: DataFrame) -> DataFrame:
        """Compare few members with each other, more with the pivot; returns the rows of the larger buckets without it."""
        members = open_members(table)
        few = members.where(F.col("members") <= FEW)
        others = few.select("key", F.col("node").alias("other"), F.col("comp").alias("other_comp"))
        add_links(few.join(others, "key").where("node > other and comp <> other_comp").select("node", "other").unionByName(
            members.where((F.col("members") > FEW) & (F.col("comp") != F.col("pivot_comp"))).select("node", F.col("pivot").alias("other"))))
        return members.where((F.col("members") > FEW) & (F.col("node") != F.col("pivot"))).drop("comp", "pivot_comp")

    larger = star(rows)
    discard(rows)
    # members of buckets of one pivot go on together; what the pivot can tell of them is known
    rest = with_comp(larger.select(F.col("pivot").alias("cluster"), "pivot", "node", "weight").distinct())
    of_pivot = comps.select(F.col("node").alias("pivot"), F.col("comp").alias("pivot_comp"))
    rest = stored(rest.join(of_pivot, "pivot", "left").withColumn("pivot_comp", F.coalesce("pivot_comp", "pivot")), "rest")
    unsettled = rest.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"), F.min("comp").alias("a"), F.max("comp").alias("b"))
    unsettled = stored(unsettled.where("a < b").drop("a", "b"), "unsettled-clusters")
    rest = stored(rest.join(unsettled, "cluster"), "unsettled")
    if rest.isEmpty():
        return comps
    add_links(_within(rest.where(F.col("members") <= MANY).select(F.col("cluster").alias("key"), "members", "node", "comp"), nodes, join))
    huge = rest.where(F.col("members") > MANY)
    if not huge.isEmpty():
        of_pivots = sets_of(huge.select(F.col("pivot").alias("node")).distinct())
        held = of_pivots.agg(F.coalesce(F.sum(F.size("elements")), F.lit(0))).first()[0] * 8
        if held <= PIVOT_BYTES:  # else they meet in a shuffle, with the members' sets
            of_pivots = F.broadcast(of_pivots)
        # the members' sets, the largest thing here, are dealt by node once, for the join as well
        rows = _met(stored(_closer_buckets(huge, sets_of(huge.select("node").distinct(), keep=False), of_pivots, join), "closer-buckets"))
        left = open_members(star(rows).select("key", "node", "weight"))
        add_links(_within(left.select("key", "members", "node", "comp"), nodes, join))
    return comps


def _classified(docs: DataFrame, join: Join, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: doc_id, text_hash, n_shingles, component_id."""
    bounded_batches(docs.sparkSession)
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"))
    profiles = stored(two.mapInArrow(partial(_profiles, join), "doc_id long, text_hash long, n long, node long, sketch array<long>, fine array<long>"),
                      "profiles")
    some = profiles.where("n > 0")
    classes = stored(some.groupBy("node").agg(F.min("n").alias("n"), F.min("doc_id").alias("first_id"),
                                              F.min("sketch").alias("sketch"), F.min("fine").alias("fine")), "classes")

    def sets_of(nodes: DataFrame, keep: bool = True) -> DataFrame:
        """Whole sets: from one document of each class, found by a bounded filter on its id. A stored table, or, if it
        isn't to be kept, a plan that deals them by node."""
        wanted = classes.join(nodes, "node", "left_semi").select("node", F.coalesce("first_id", F.lit(0).cast("long")).alias("first_id"))
        candidates = stored(wanted, "candidates")
        wanted = candidates.withColumn("h", F.xxhash64("first_id"))
        n_words = bloom.words_for(wanted.count())
        table = bloom.filter_table(wanted, "h", n_words)
        hashed = two.select("text", F.xxhash64(F.coalesce("doc_id", F.lit(0).cast("long"))).alias("h"))
        texts = bloom.probe(hashed, "h", table, n_words, "maybe").where("maybe").select("text")
        sets = texts.mapInArrow(partial(_sets, join), "node long, elements array<long>").join(
            wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])
        if keep:
            sets = stored(sets, "sets")
            discard(candidates)
        return sets

    buckets = _shared(two.select("text"), profiles.count(), join)
    if buckets.isEmpty():
        comps = classes.select("node", F.col("node").alias("comp"))
    else:
        comps = _connect(buckets, classes.select("node", "n", "sketch", "fine"), sets_of, join)
    labelled = stored(classes.join(comps, "node", "left").select("node", "first_id", F.coalesce("comp", "node").alias("comp")), "labelled")
    ids = stored(labelled.groupBy("comp").agg(F.min("first_id").alias("component_id")), "component-ids")
    by_node = stored(labelled.join(ids, "comp").select("node", "component_id"), "components-by-node")
    linked = some.join(by_node, "node").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id")
    alone = profiles.where("n = 0").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def near_components(docs: DataFrame, join: Join, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    return _classified(docs, join, id_col, text_col).drop("text_hash")


def keep_one_of_each(docs: DataFrame, join: Join, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with the smallest doc_id of each component only; rows without an id stay.

    Rows are told apart by id and text: several of the smallest id stay. Only rows whose text hash may be that of a
    dropped one are shuffled."""
    rows = stored(_classified(docs, join, id_col, text_col), "classified")
    dropped = rows.where("doc_id <> component_id").select("doc_id", "text_hash").distinct()
    dropped = stored(dropped.withColumnsRenamed({"doc_id": "dropped_id", "text_hash": "dropped_hash"}), "dropped")
    n_words = bloom.words_for(dropped.count())
    table = stored(bloom.filter_table(dropped, "dropped_hash", n_words), "dropped-bits")
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    hashed = row.withColumn("h", F.xxhash64(F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))))
    flagged = bloom.probe(hashed, "h", table, n_words, "maybe")
    same = (F.col("h") == F.col("dropped_hash")) & (F.col(f"row.`{id_col}`").cast("long") == F.col("dropped_id"))
    stay = flagged.where("maybe").join(dropped, same, "left_anti")
    return flagged.where(~F.col("maybe")).select("row").unionByName(stay.select("row")).select("row.*")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir), Join(width=3, num=90, den=100))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE list_distinct(
    list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh
  FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS u, doc_id AS c FROM documents UNION SELECT p.v, r.c FROM r JOIN p ON p.u = r.u),
m AS (SELECT u, min(c) AS component_id FROM r GROUP BY u)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN m ON m.u = s.doc_id
"""
