"""Vector code compression: product codes from exact k-means, accelerated by metric trees.

1. Vectors become integers (``floor(scale * x)``) and are cut into ``parts`` equal
   runs. Every chunk of a few thousand vectors gets one metric tree per part,
   built once by the anchors hierarchy and written to the shared folder: points go
   to their nearest anchor, the farthest point of the widest anchor becomes the
   next one, and an anchor's points that are nearer to its pivot than half the way
   to the newcomer need no comparison. About sqrt(n) anchors are the middle; from
   there balls are merged upwards, the pair with the smallest common ball first,
   and large anchors are built downwards the same way. A ball caches its points'
   sum and count.
2. A round hands each tree the codebook (``entries`` x ``dim`` integers, broadcast
   with the task; its size does not depend on the data). Balls inherit their
   parent's list of candidate entries and strike out every entry that lies, for the
   whole ball, farther than the nearest one. A ball with one candidate left is wholly
   owned: its cached sum and count go to that entry, its points are never looked
   at. Only leaves with several candidates compare points, exactly and in
   integers, and only against those candidates; ties go to the lower index.
3. Sums per part and entry are added within each task, then by Spark; at most
   ``entries * dim`` rows reach the driver a round.
4. A last descent writes the codes.

A strike needs a margin above floating-point error, so rounding can only leave a
candidate too many, never one too few: results equal brute force.

Edge cases: rows whose vector is NULL, empty, or holds a NULL or non-finite
component are dropped. Rows without a ``vec_id`` are coded and come last in the order
that fills the first codebook, as do repeated ids after their first, by vector. With fewer than ``entries``
vectors the codebook is that short. An entry that repeats a lower one never
owns anything and stays as it is. An empty table gives no rows. Kept
vectors of different lengths, lengths that ``parts`` does not divide, and components
whose squared distances may pass a long raise ``ValueError``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import map_arrow, written

LEAF = 48
SALTS = 16
TREE = ("order", "span", "kids", "pivot", "radius", "total")
_DDL = ", ".join(f"{f} array<binary>" for f in TREE)


# ---- metric trees of one chunk and part --------------------------------------------------------

def anchors(points: np.ndarray, count: int) -> np.ndarray:
    """Anchor (0, 1, ...) of every point; fewer than ``count`` if no two points differ within an anchor."""
    owner = np.zeros(len(points), dtype=np.int64)
    pivots = points[:1]
    dist = np.sqrt(((points - pivots[0]) ** 2).sum(axis=1))
    for new in range(1, count):
        far = int(dist.argmax())  # the farthest point of the widest anchor
        if dist[far] == 0:
            break
        pivot = points[far]
        between = np.sqrt(((pivots - pivot) ** 2).sum(axis=1))
        open_ = np.flatnonzero(2 * dist > between[owner])  # nearer points cannot change hands
        theirs = np.sqrt(((points[open_] - pivot) ** 2).sum(axis=1))
        won = theirs < dist[open_]
        owner[open_[won]] = new
        dist[open_[won]] = theirs[won]
        pivots = np.vstack([pivots, pivot])
    return owner


class Tree:
    """Balls of one chunk's part vectors; node 0 .. len - 1, the root last."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(float)
        self.exact = points
        self.members: list[np.ndarray] = []
        self.kids: list[tuple[int, int]] = []
        self.pivot: list[np.ndarray] = []
        self.radius: list[float] = []
        self.total: list[np.ndarray] = []
        self._build(np.arange(len(points)))

    def _ball(self, idx: np.ndarray, kids: tuple[int, int], total: np.ndarray) -> int:
        pivot = total / len(idx)
        self.members.append(idx)
        self.kids.append(kids)
        self.pivot.append(pivot)
        self.radius.append(float(np.sqrt(((self.points[idx] - pivot) ** 2).sum(axis=1).max())))
        self.total.append(total)
        return len(self.kids) - 1

    def _build(self, idx: np.ndarray) -> int:
        if len(idx) > LEAF:
            owner = anchors(self.points[idx], max(2, int(np.sqrt(len(idx)))))
            by = np.argsort(owner, kind="stable")
            groups = np.split(idx[by], np.flatnonzero(np.diff(owner[by])) + 1)
            if len(groups) > 1:
                return self._merge([self._build(g) for g in groups])
        return self._ball(idx, (-1, -1), self.exact[idx].sum(axis=0))

    def _merge(self, nodes: list[int]) -> int:
        """Joins the pair with the smallest common ball until one is left."""
        pivot = np.array([self.pivot[k] for k in nodes])
        radius = np.array([self.radius[k] for k in nodes])
        size = np.array([float(len(self.members[k])) for k in nodes])
        nodes = list(nodes)

        def common(i):
            share = size / (size + size[i])
            gap = np.sqrt(((pivot - pivot[i]) ** 2).sum(axis=1))
            return np.maximum((1 - share) * gap + radius, share * gap + radius[i])

        cost = np.array([common(i) for i in range(len(nodes))])
        np.fill_diagonal(cost, np.inf)
        for _ in range(len(nodes) - 1):
            a, b = sorted(map(int, np.unravel_index(cost.argmin(), cost.shape)))
            one, two = nodes[a], nodes[b]
            new = self._ball(np.concatenate([self.members[one], self.members[two]]), (one, two), self.total[one] + self.total[two])
            nodes[a], pivot[a], radius[a], size[a] = new, self.pivot[new], self.radius[new], len(self.members[new])
            cost[b, :] = cost[:, b] = np.inf
            gone = np.isinf(cost[a]) & (np.arange(len(nodes)) != a)
            row = common(a)
            row[gone] = row[a] = np.inf
            cost[a, :] = cost[:, a] = row
        return nodes[0]

    def packed(self) -> dict[str, bytes]:
        """The balls with points in depth-first order, so that each ball is one span."""
        n = len(self.kids)
        span = np.zeros((n, 2), dtype="<i4")
        order, todo = [], [n - 1]
        at = {n - 1: 0}
        while todo:
            k = todo.pop()
            start = at[k]
            span[k] = start, start + len(self.members[k])
            left, right = self.kids[k]
            if left < 0:
                order.append((start, self.members[k]))
            else:
                at[left], at[right] = start, start + len(self.members[left])
                todo += [left, right]
        flat = np.concatenate([m for _, m in sorted(order, key=lambda x: x[0])])
        return {"order": flat.astype("<i4").tobytes(), "span": span.tobytes(),
                "kids": np.array(self.kids, dtype="<i4").tobytes(), "pivot": np.array(self.pivot, dtype="<f8").tobytes(),
                "radius": np.array(self.radius, dtype="<f8").tobytes(), "total": np.array(self.total, dtype="<i8").tobytes()}


def descend(tree: dict[str, bytes], points: np.ndarray, book: np.ndarray, codes: bool = False) -> tuple:
    """``count, total`` per entry, or with ``codes`` the nearest entry of every point, and how many point
    comparisons the leaves made. ``points`` (n, w) and ``book`` (entries, w) are integers."""
    width = points.shape[1]
    order = np.frombuffer(tree["order"], "<i4")
    span, kids = (np.frombuffer(tree[f], "<i4").reshape(-1, 2) for f in ("span", "kids"))
    pivot = np.frombuffer(tree["pivot"], "<f8").reshape(-1, width)
    radius = np.frombuffer(tree["radius"], "<f8")
    totals = np.frombuffer(tree["total"], "<i8").reshape(-1, width)
    entry = book.astype(float)
    apart = np.sqrt(((entry[:, None] - entry) ** 2).sum(axis=-1))
    count, total = np.zeros(len(book), dtype=np.int64), np.zeros(book.shape, dtype=np.int64)
    found = np.zeros(len(points), dtype=np.int64)
    _, first = np.unique(book, axis=0, return_index=True)
    distinct = np.zeros(len(book), dtype=bool)
    distinct[first] = True
    front, lists = np.array([len(span) - 1]), distinct[None, :]
    compared = 0

    def give(which: np.ndarray, to: np.ndarray) -> None:
        np.add.at(count, to, span[which, 1] - span[which, 0])
        np.add.at(total, to, totals[which])
        if codes:
            for k, e in zip(which, to):
                found[order[span[k, 0]:span[k, 1]]] = e

    while len(front):
        away = ((pivot[front][:, None] - entry) ** 2).sum(axis=-1)
        away[~lists] = np.inf
        near = away.argmin(axis=1)
        least = away[np.arange(len(front)), near][:, None]
        reach = 2 * radius[front][:, None] * apart[near]
        lists = lists & (away - least <= reach + 1e-9 * (1 + least + reach))
        owned = lists.sum(axis=1) == 1
        give(front[owned], near[owned])
        front, lists = front[~owned], lists[~owned]
        leaf = kids[front, 0] < 0
        sizes = lists[leaf].sum(axis=1)
        for k in np.unique(sizes):  # leaves with equally long lists together
            some = front[leaf][sizes == k]
            choice = np.nonzero(lists[leaf][sizes == k])[1].reshape(-1, k)
            mine = np.concatenate([order[a:b] for a, b in span[some]])
            which = np.repeat(choice, span[some, 1] - span[some, 0], axis=0)
            gap = ((points[mine][:, None] - book[which]) ** 2).sum(axis=-1)
            to = which[np.arange(len(mine)), gap.argmin(axis=1)]  # candidates ascend: the first least is the lowest index
            compared += gap.size
            np.add.at(count, to, 1)
            np.add.at(total, to, points[mine])
            found[mine] = to
        front, lists = kids[front[~leaf]].reshape(-1), np.repeat(lists[~leaf], 2, axis=0)
    return (found if codes else (count, total)), compared


# ---- Spark -------------------------------------------------------------------------------------

def _usable(vectors: DataFrame) -> DataFrame:
    wrong = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("embedding"), "label")
            .where("size(embedding) > 0").where(~wrong))


def _integers(values, rows: int, scale: int, parts: int) -> np.ndarray:
    """(rows, dim) integers of an Arrow list column's values."""
    flat = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(float))
    if rows and (len(flat) % rows or len(flat) // rows % parts):
        raise ValueError(f"vectors must be equally long, by a multiple of {parts}")
    width = max(1, len(flat) // max(rows, 1) // parts)
    if len(flat) and 4 * float(np.abs(flat).max()) ** 2 * width >= 2 ** 62:
        raise ValueError("components so large that a squared distance may pass a long")
    return flat.astype("<i8").reshape(rows, -1)


def plant(vectors: DataFrame, *, scale: int = 256, parts: int = 16, chunk: int = 4096) -> DataFrame:
    """One row per chunk: its ids, labels, integer vectors and a tree for every part."""
    label = vectors.schema["label"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held += [batch.slice(at, chunk) for at in range(0, batch.num_rows, chunk)]
            while sum(b.num_rows for b in held) >= chunk:
                table = pa.Table.from_batches(held).combine_chunks()
                yield grown(table.slice(0, chunk))
                held = table.slice(chunk).to_batches()
        if held and (table := pa.Table.from_batches(held)).num_rows:
            yield grown(table)

    def grown(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        lists = table.column("embedding").combine_chunks()
        if len(set(lists.value_lengths().to_pylist())) > 1:
            raise ValueError(f"vectors must be equally long, by a multiple of {parts}")
        grid = _integers(lists.flatten(), table.num_rows, scale, parts)
        width = grid.shape[1] // parts
        trees = [Tree(grid[:, p * width:(p + 1) * width]).packed() for p in range(parts)]
        cols = {"vec_id": pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                "label": pa.array([table.column("label").to_pylist()], pa.list_(table.column("label").type)),
                "dim": pa.array([grid.shape[1]], pa.int32()), "grid": pa.array([grid.tobytes()], pa.binary()),
                **{f: pa.array([[t[f] for t in trees]], pa.list_(pa.binary())) for f in TREE}}
        return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return map_arrow(vectors, run, f"vec_id array<long>, label array<{label.simpleString()}>, dim int, grid binary, {_DDL}")


def _chunks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[dict[str, bytes]]]]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            if row.column("dim")[0].as_py() != dim:
                raise ValueError("vectors must be equally long")
            grid = np.frombuffer(row.column("grid")[0].as_py(), "<i8").reshape(-1, dim)
            fields = {f: row.column(f)[0].as_py() for f in TREE}
            yield row, grid, [{f: fields[f][p] for f in TREE} for p in range(len(fields["order"]))]


def _round(forest: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (parts, entries, width) after one round."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), dtype=np.int64), np.zeros(books.shape, dtype=np.int64)
        for _, grid, trees in _chunks(batches, parts * width):
            for p, tree in enumerate(trees):
                (c, t), _ = descend(tree, grid[:, p * width:(p + 1) * width], books[p])
                count[p] += c
                total[p] += t
        p, e = np.nonzero(count)
        at = np.tile(np.arange(width), len(p))
        p, e = np.repeat(p, width), np.repeat(e, width)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (p, e, at, count[p, e], total[p, e, at])],
                                         names=["part", "entry", "at", "n", "total"])

    sums = (map_arrow(forest.select("dim", "grid", *TREE), run, "part long, entry long, at long, n long, total long")
            .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
    out = books.copy()
    for r in sums:
        out[r.part, r.entry, r.at] = r.total // r.n
    return out


def _codes(forest: DataFrame, books: np.ndarray, label: str) -> DataFrame:
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, grid, trees in _chunks(batches, parts * width):
            code = np.empty((len(grid), parts), dtype=np.uint8)
            error = np.zeros(len(grid), dtype=np.int64)
            for p, tree in enumerate(trees):
                points = grid[:, p * width:(p + 1) * width]
                code[:, p], _ = descend(tree, points, books[p], codes=True)
                error += ((points - books[p][code[:, p]]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [row.column("vec_id").flatten(), row.column("label").flatten(),
                 pa.array([c.tobytes().hex() for c in code]), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return map_arrow(forest, run, f"vec_id long, label {label}, code string, error long")


def encode(vectors: DataFrame, *, scale: int = 256, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every usable row (``vec_id, embedding, label``)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    usable = _usable(vectors)
    label = vectors.schema["label"].dataType.simpleString()
    start = [r.embedding for r in usable.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()]
    if not start:
        return usable.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                             F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")).where("false")
    if len({len(v) for v in start}) > 1:
        raise ValueError("vectors must be equally long")
    grid = _integers(pa.array([x for v in start for x in v], pa.float64()), len(start), scale, parts)
    books = np.ascontiguousarray(grid.reshape(len(start), parts, -1).transpose(1, 0, 2))
    dim = grid.shape[1]
    forest = written(plant(usable, scale=scale, parts=parts, chunk=max(256, min(4096, 2 ** 18 // dim))), "vector-trees")
    for _ in range(rounds):
        books = _round(forest, books)
    coded = written(_codes(forest, books, label), "vector-codes")
    digest = hashlib.sha256(",".join(str(int(x)) for x in books.reshape(-1)).encode()).hexdigest()
    # A label may hold a third of the rows: its one total is copied SALTS times, so its rows spread over as many tasks.
    sums = (coded.groupBy(F.col("label").alias("__of")).agg(F.sum("error").alias("label_error"))
            .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    dealt = coded.withColumn("__mine", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return (dealt.join(sums, F.col("label").eqNullSafe(F.col("__of")) & (F.col("__mine") == F.col("__salt")))
            .select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
