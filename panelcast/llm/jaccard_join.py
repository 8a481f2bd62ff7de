"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

A document's set is its distinct shingles, as XXH64. Two documents link when
``100 * intersection >= percent * union``; components are closed over all links.

1. **One node per set.** The node is a hash of the sorted set; copies are one
   node from the start and never meet each other.
2. **Size bands.** Band bounds grow by the similarity, so linked sets lie in one
   band or in neighbouring ones (``bands``). A *level* compares sets of band k
   with those of bands k and k - 1.
3. **Tile keys.** At a level, linked sets differ in at most D shingles, a number that follows from
   the band's upper bound. Hash space is cut into D + 1 + e ranges; two linked sets
   agree exactly on at least e + 1 of them, so the contents of a range, hashed, are a
   key that linked sets share (``keys_of``). Up to e ranges, those with the least
   content, need no key: contents of no or one shingle, which many texts share by chance,
   almost never become keys. Only keys with two or more nodes go on.
4. **Families.** Sets connected by common keys are a family. One that fits a tile (bounded
   in sets and bytes) is a tile: every set is sent once. In a tile, sets
   are compared by *bitmaps*: every shingle sets one bit of a bitmap whose
   width follows from the sizes. Each bit that one set has and the other lacks is
   at least one shingle outside the intersection, so bit counts bound the intersection from
   above. Pairs that the bound leaves open are decided by intersecting the sorted
   arrays, until they are connected. A tile emits a spanning forest of its links, never the pairs.
5. **Larger families.** Every node is compared with the smallest node of each of its keys:
   linear in the number of keys, and a group of near copies becomes one component. Keys that still hold
   several components are laid out in tiles; a key with more members than a tile holds is
   cut into parts, and the pairs of parts are tiles of their own, on any task.
6. Connected components of all links (``components``).

Step 3 loses no link and a key shared by chance costs a comparison only, so results are exact but for
64-bit hashes: among 10^9 different sets, two have one hash with a chance of 3 percent.

Edge cases: a text of fewer words than a shingle is one shingle, its whole
word sequence. A NULL text, or one without words, has the empty set and is linked
with nothing, not even with its like. Rows with a NULL ``doc_id`` take part but
name no component: theirs is NULL if no member has an id. Repeated rows are kept
and linked (unless empty). An empty table gives no rows. Columns other than ``doc_id, text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import LOWER_AZ, map_arrow, map_slices, written
from panelcast.llm.components import components

SLACK_PERCENT = 12
TILE_BYTES = 1 << 25
SEEN = 1 << 18
FILTER_BITS = 26
FAMILY = 8192
SALT = np.uint64(0x9E3779B97F4A7C15)  # odd: multiplying by it permutes the 64-bit numbers


# ---- sets --------------------------------------------------------------------------------------

def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct XXH64 of a text's word shingles; of the whole sequence if there are fewer words."""
    words = text.encode().translate(LOWER_AZ).split() if text else []
    if not words:
        return np.empty(0, dtype="<u8")
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([h(joined)], dtype="<u8")
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    return np.unique(np.array([h(joined[a:b - 1]) for a, b in zip(starts, starts[size:])], dtype="<u8"))


def node_of(shingles: np.ndarray) -> int | None:
    """Signed 64-bit name of a set; None for the empty one."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), 7)).astype("<i8")) if len(shingles) else None


def bitmap(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Hashed signature of ``bits`` (a power of two, 64 at least) as 64-bit words."""
    flags = np.zeros(bits, dtype=np.uint8)
    flags[((shingles * SALT) >> np.uint64(32)).astype(np.int64) & (bits - 1)] = 1
    return np.packbits(flags, bitorder="little").view("<u8")


# ---- size bands and tile keys ------------------------------------------------------------------

def bands(n: int, percent: int) -> list[tuple[int, int]]:
    """``level, upper``: the levels at which a set of ``n`` shingles is compared, with the largest size there.

    Bands start where two different sets can first be linked; smaller sets have no level."""
    if percent >= 100:
        return []
    low = 1
    while 2 * low * (100 - percent) < 100 + percent:  # 2 * low * (1 - t) / (1 + t) < 1: no difference allowed
        low += 1
    if n < low - 1:
        return []
    level, upper = 0, low
    while n > upper:
        upper = upper * 100 // percent + 1
        level += 1
    return [(level, upper), (level + 1, upper * 100 // percent + 1)]


@lru_cache(maxsize=256)
def _edges(ranges: int) -> np.ndarray:
    """Where hash space is cut into equal ranges."""
    return np.array([k * (1 << 64) // ranges for k in range(1, ranges)], dtype="<u8")


def keys_of(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Tile keys of a set, for all its levels: linked sets share one, equal keys mean nothing else."""
    found = []
    for level, upper in bands(len(shingles), percent):
        differ = 2 * upper * (100 - percent) // (100 + percent)
        if not differ:
            continue
        slack = max(1, -(-differ * SLACK_PERCENT // 100))
        ranges = differ + 1 + slack
        cuts = np.concatenate([[0], np.searchsorted(shingles, _edges(ranges)), [len(shingles)]])
        sums = np.concatenate([np.zeros(1, dtype="<u8"), np.cumsum(shingles * SALT, dtype="<u8")])
        content = sums[cuts[1:]] - sums[cuts[:-1]]
        size = np.diff(cuts)
        # The highest size that at most ``slack`` ranges do not pass: those need no key. Sets that agree on a range
        # agree on its size, so of their slack + 1 or more common ranges one stays, whichever set skips more.
        least = np.sort(size)[slack]
        tag = np.uint64((level << 32) * 2 + 1) * np.arange(1, ranges + 1, dtype="<u8")
        mixed = (content ^ (content >> np.uint64(29))) * SALT + tag
        found.append(((mixed ^ (mixed >> np.uint64(31))) * SALT)[size >= least])
    return np.concatenate(found).view("<i8") if found else np.empty(0, dtype="<i8")


# ---- comparisons -------------------------------------------------------------------------------

def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact: both arrays are sorted and distinct."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def width_for(n: int) -> int:
    return max(64, 1 << (2 * n - 1).bit_length())


def open_pairs(maps: np.ndarray, sizes: np.ndarray, queries: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the first rows, the later rows whose intersection with it may be large enough, by bit counts."""
    bits = np.bitwise_count(maps).sum(axis=1).astype(np.int64)
    for i in range(min(queries, len(maps) - 1)):
        rest = slice(i + 1, None)
        both = np.bitwise_count(maps[i] & maps[rest]).sum(axis=1).astype(np.int64)
        most = np.minimum(sizes[i] - (bits[i] - both), sizes[rest] - (bits[rest] - both))
        yield i, i + 1 + np.flatnonzero(100 * most >= percent * (sizes[i] + sizes[rest] - most))


def forest(nodes: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], queries: int, percent: int) -> list[tuple[int, int]]:
    """Links of the first ``queries`` sets that join the tile's components: bitmaps first, then arrays, until a pair is connected."""
    comps = comps.copy()
    sizes = np.array([len(s) for s in sets])
    bits = width_for(int(sizes.max()))
    maps = np.array([bitmap(s, bits) for s in sets])
    edges = []
    for i, others in open_pairs(maps, sizes, queries, percent):
        others = others[comps[others] != comps[i]]
        while len(others):
            j, others = others[0], others[1:]
            if linked(sets[i], sets[j], percent):
                comps[comps == comps[j]] = comps[i]
                edges.append((int(nodes[i]), int(nodes[j])))
                others = others[comps[others] != comps[i]]
    return edges


# ---- Spark -------------------------------------------------------------------------------------

def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _named(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``doc_id, node, n_shingles, keys`` of every row; the packed tile keys come once per set and task (a set may
    come again when the task's memory of sets is full)."""
    def make():
        new = _once()

        def of_slice(cols):
            sets = [shingle_set(t, shingle) for t in cols["text"]]
            nodes = [node_of(s) for s in sets]
            return {"doc_id": cols["doc_id"], "node": nodes, "n_shingles": [len(s) for s in sets],
                    "keys": [keys_of(s, percent).tobytes() if new(n) else None for s, n in zip(sets, nodes)]}
        return of_slice

    return map_slices(_read(docs), make, "doc_id long, node long, n_shingles long, keys binary")


def _keyed(named: DataFrame, among: Filter | None = None) -> DataFrame:
    """``key, node``: the tile keys (that ``among`` may hold)."""
    def make():
        def of_slice(cols):
            keys, nodes = [], []
            for node, packed in zip(cols["node"], cols["keys"]):
                k = np.frombuffer(packed, "<i8")
                if among is not None:
                    k = k[among.may_hold(k)]
                keys.append(k)
                nodes.append(np.full(len(k), node, dtype="<i8"))
            return {"key": np.concatenate(keys), "node": np.concatenate(nodes)} if keys else None
        return of_slice

    return map_slices(named.where("length(keys) > 0").select("node", "keys"), make, "key long, node long")


def _sets(docs: DataFrame, shingle: int, among: Filter) -> DataFrame:
    """``node, shingles`` (packed) of the sets that ``among`` may hold."""
    def make():
        new = _once()

        def of_slice(cols):
            out = {"node": [], "shingles": []}
            for t in cols["text"]:
                s = shingle_set(t, shingle)
                node = node_of(s)
                if new(node) and among.may_hold(np.array([node], dtype="<i8"))[0]:
                    out["node"].append(node)
                    out["shingles"].append(s.tobytes())
            return out
        return of_slice

    return map_slices(_read(docs).select("text"), make, "node long, shingles binary")


def _once():
    """Tells whether a node is there and new to the task; the memory of nodes is bounded."""
    seen: set[int] = set()

    def new(node):
        if node is None or node in seen:
            return False
        if len(seen) >= SEEN:
            seen.clear()
        seen.add(node)
        return True

    return new


class Filter:
    """A set of 64-bit hashes as ``FILTER_BITS`` bits: a fixed size, whatever the data. It only spares rows
    a shuffle; who passes is joined exactly."""

    def __init__(self, hashes: DataFrame, column: str):
        at = F.shiftrightunsigned(column, 64 - FILTER_BITS)
        words = (hashes.groupBy(F.shiftright(at, 6).alias("word"))
                 .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - FILTER_BITS}) & 63 AS INT))")).alias("bits")))
        found = words.toArrow()
        flags = np.zeros(1 << (FILTER_BITS - 6), dtype="<i8")
        flags[found.column("word").to_numpy()] = found.column("bits").to_numpy()
        self._held = hashes.sparkSession.sparkContext.broadcast(flags.tobytes())

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.view("<u8") >> np.uint64(64 - FILTER_BITS)
        words = np.frombuffer(self._held.value, "<u8")
        return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _star_links(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of every node with the smallest node of each of its keys."""
    pairs = shared.where("node <> hub").select("node", "hub").distinct()
    one = sets.select("node", F.col("shingles").alias("a"))
    two = sets.select(F.col("node").alias("hub"), F.col("shingles").alias("b"))
    fits = (100 * F.least(F.length("a"), F.length("b")) >= percent * F.greatest(F.length("a"), F.length("b")))
    both = pairs.join(one, "node").join(two, "hub").where(fits).select("node", "hub", "a", "b")

    def make():
        def of_slice(cols):
            keep = []
            for k, (a, b) in enumerate(zip(cols["a"], cols["b"])):
                a, b = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                bits = width_for(max(len(a), len(b)))
                maps, sizes = np.array([bitmap(a, bits), bitmap(b, bits)]), np.array([len(a), len(b)])
                if len(next(open_pairs(maps, sizes, 1, percent))[1]) and linked(a, b, percent):
                    keep.append(k)
            return {"a": [cols["node"][k] for k in keep], "b": [cols["hub"][k] for k in keep]}
        return of_slice

    return map_slices(both, make, "a long, b long")


def _tiles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a key: ``members`` has ``key, node, comp``.

    A key's largest component is its major one, the others its minor ones. Minor sets
    are compared with each other and with the major ones; major ones are not compared with
    each other, so a large component that a few strays touch is laid out once."""
    sizes = members.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark"))
    group = (sizes.groupBy("key").agg(F.sum("n").alias("many"), F.max(F.struct("n", "comp")).alias("top"), F.count("*").alias("comps"),
                                      F.sum("mark").alias("mark")).where("comps > 1"))
    # Groups with the same members say the same: one key of them stays.
    once = (group.groupBy("many", "top", "mark").agg(F.min("key").alias("key"))
            .select("key", F.col("top.comp").alias("major"), F.col("top.n").alias("majors"), (F.col("many") - F.col("top.n")).alias("minors")))
    sized = members.join(once, "key").join(sets, "node")
    # Sets of one key are of neighbouring bands: any of them tells how many fill half a tile.
    half = F.greatest(F.lit(16), F.least(F.lit(1024), F.floor(F.lit(TILE_BYTES // 2) / F.max(F.length("shingles")))))
    filled = once.join(sized.groupBy("key").agg(half.alias("half")), "key").select(
        "key", *[F.ceil(F.col(c) / F.col("half")).cast("int").alias(f"{c}_parts") for c in ("majors", "minors")])
    mine = F.pmod(F.xxhash64("node", "key"), F.when(F.col("minor"), F.col("minors_parts")).otherwise(F.col("majors_parts"))).cast("int")
    tile = F.when(F.col("minor"), F.concat(
        F.transform(F.sequence(F.lit(0), F.col("majors_parts") - 1), lambda j: F.struct(F.lit(0).alias("kind"), F.col("mine").alias("p"), j.alias("q"))),
        F.transform(F.filter(F.sequence(F.lit(0), F.col("minors_parts") - 1), lambda i: i != F.col("mine")),
                    lambda i: F.struct(F.lit(1).alias("kind"), F.least("mine", i).alias("p"), F.greatest("mine", i).alias("q"))))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("minors_parts") - 1), lambda i: F.struct(F.lit(0).alias("kind"), i.alias("p"), F.col("mine").alias("q"))))
    dealt = (sized.join(filled, "key").withColumn("minor", F.col("comp") != F.col("major")).withColumn("mine", mine)
             .withColumn("tile", F.explode(tile))
             .select("key", "tile.kind", "tile.p", "tile.q", "minor", "node", "comp", "shingles"))
    return _compare(dealt, ("key", "kind", "p", "q"), percent)


def _compare(rows: DataFrame, tile_of: tuple[str, ...], percent: int) -> DataFrame:
    """Links within each tile. ``rows``: the columns of ``tile_of`` and ``minor`` (compared with all, else
    only with those), ``node, comp, shingles``."""
    spread = rows.repartition(*tile_of).sortWithinPartitions(*tile_of, F.desc("minor"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []

        def done():
            if len(held) < 2:
                return []
            return forest(np.array([r[0] for r in held]), np.array([r[1] for r in held]), [r[2] for r in held],
                          sum(r[3] for r in held), percent)

        def batch_of(edges):
            return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in (*tile_of, "node", "comp", "shingles", "minor")]
            for *here, node, comp, packed, minor in zip(*cols):
                if here != tile:
                    if edges := done():
                        yield batch_of(edges)
                    tile, held = here, []
                held.append((node, comp, np.frombuffer(packed, "<u8"), minor))
        if edges := done():
            yield batch_of(edges)

    return map_arrow(spread, run, "a long, b long")


def _links(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect what is linked among the sets of ``shared`` (``key, node, hub``)."""
    edges = shared.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    of = sets.select("node", F.length("shingles").alias("bytes")).join(components(edges), "node", "left")
    families = written(of.select("node", "bytes", F.coalesce("root", "node").alias("family")), "jaccard-families")
    total = families.groupBy("family").agg((((F.count("*") <= FAMILY) & (F.sum("bytes") <= TILE_BYTES))).alias("fits"))
    families = written(families.join(total, "family").select("node", "family", "fits"), "jaccard-fits")
    fitting = (families.where("fits").join(sets, "node")
               .select("family", F.lit(True).alias("minor"), "node", F.col("node").alias("comp"), "shingles"))
    found = written(_compare(fitting, ("family",), percent), "jaccard-links")
    large = families.where("not fits").select("node")
    if large.isEmpty():
        return found
    rest = shared.join(large, "node", "left_semi")
    stars = written(_star_links(rest, sets, percent), "jaccard-stars")
    near = components(stars)
    members = written(rest.join(near, "node", "left").select("key", "node", F.coalesce("root", "node").alias("comp")), "jaccard-members")
    return found.unionByName(stars).unionByName(written(_tiles(members, sets, percent), "jaccard-across"))


def jaccard_components(docs: DataFrame, *, shingle: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    if not 1 <= percent <= 100 or shingle < 1:
        raise ValueError("percent must lie in 1 to 100, shingle must be positive")
    named = written(_named(docs, shingle, percent), "jaccard-nodes")
    # A key's least and greatest node are gathered in the map tasks, so a key that many sets share sends one row a task.
    hubs = written(_keyed(named).groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
                   .where("hub < last").select("key", "hub"), "jaccard-hubs")
    shared = written(_keyed(named, Filter(hubs, "key")).join(hubs, "key").distinct(), "jaccard-shared")
    wanted = shared.select("node").distinct()
    sets = written(_sets(docs, shingle, Filter(wanted, "node")).join(wanted, "node", "left_semi").dropDuplicates(["node"]), "jaccard-sets")
    roots = components(_links(shared, sets, percent))
    filled = named.where("node is not null")
    placed = (filled.groupBy("node").agg(F.min("doc_id").alias("least")).join(roots, "node", "left")
              .withColumn("root", F.coalesce("root", "node")))
    first = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    owned = placed.join(first, "root").select("node", "component_id")
    return (filled.join(owned, "node").select("doc_id", "n_shingles", "component_id")
            .unionByName(named.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))))
