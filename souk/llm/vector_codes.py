"""Product codes for vectors: each of ``PARTS`` equal parts of a vector becomes the index of its
nearest codebook entry, after ``ROUNDS`` rounds of k-means over all vectors in whole numbers.

Assignment goes through anchors-hierarchy metric trees. Vectors are cut into blocks once, and each
part of a block gets a tree that is written and serves every round:

* anchors are placed where their ball is widest, each taking over the points nearer to it; points
  within half the distance of two anchors need no comparison;
* the anchors' balls are merged upwards, tightest pair first, and split downwards by the same
  procedure (middle-out); a ball keeps its points' sums and count;
* a round passes the codebook's entries down the tree. A ball inherits its parent's candidates and
  drops every entry that is farther than its best one for all of its points; once one is left, the
  ball's cached sums go to that entry and nothing below is looked at. Points of a last ball are
  compared with the candidates that are left.

All distances that decide are exact whole numbers; the drop test leaves a margin for rounding. Only
codebooks and sums per entry go through the driver: PARTS x ENTRIES x part length numbers.

Defined results: null vectors and those with a null or non-finite component are dropped, and so are
vectors whose length differs from the first kept one's (smallest id, nulls last) or is not a
multiple of PARTS. Fewer than ENTRIES kept vectors make a smaller codebook. Rows of one id
are ordered by their vectors; repeated rows are coded one by one. An empty table gives no rows.
Components are limited to 2 ** 28 whole steps, beyond which squared sums leave 64 bits: an error
is raised. Columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import written

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors in a block, and points in a ball that is not split further.
BLOCK, LEAF = 4096, 64
LIMIT = 1 << 28


# ----------------------------------------------------------------------------- trees
@dataclass
class Tree:
    """Balls over ``points`` (rows in tree order): ball i holds points[start:stop]."""

    order: np.ndarray
    points: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    #: children, -1 for a last ball
    left: np.ndarray
    right: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def anchors(x: np.ndarray, k: int) -> list[np.ndarray]:
    """The points (by index) of at most ``k`` anchors, each point with its nearest."""
    owner = np.zeros(len(x), dtype=np.int64)
    dist = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    at = [x[0]]
    while len(at) < k:
        far = int(dist.argmax())  # of the widest ball the farthest point
        if dist[far] == 0:
            break
        new = x[far]
        apart = np.sqrt(((np.array(at) - new) ** 2).sum(axis=1))
        open_ = np.flatnonzero(dist > apart[owner] / 2)
        d = np.sqrt(((x[open_] - new) ** 2).sum(axis=1))
        closer = d < dist[open_]
        taken = open_[closer]
        owner[taken], dist[taken] = len(at), d[closer]
        owner[far], dist[far] = len(at), 0.0
        at.append(new)
    return [g for i in range(len(at)) if len(g := np.flatnonzero(owner == i))]


def merged(x: np.ndarray, balls: list) -> tuple:
    """One binary tree over ``balls`` (index arrays or trees of them), tightest pair first."""
    n = len(balls)
    members = [_members(b) for b in balls]
    count = np.array([len(m) for m in members], dtype=float)
    center = np.array([x[m].mean(axis=0) for m in members])
    radius = np.array([np.sqrt(((x[m] - c) ** 2).sum(axis=1).max()) for m, c in zip(members, center, strict=True)])
    live = list(balls)

    def widths(i: int) -> np.ndarray:
        apart = np.sqrt(((center - center[i]) ** 2).sum(axis=1))
        wide = np.maximum(np.maximum(radius, radius[i]), (apart + radius + radius[i]) / 2)
        wide[gone] = np.inf
        wide[i] = np.inf
        return wide

    gone = np.zeros(n, dtype=bool)
    table = np.array([widths(i) for i in range(n)])
    for _ in range(n - 1):
        i, j = divmod(int(table.argmin()), n)
        live[i] = (live[i], live[j])
        wide, total = table[i, j], count[i] + count[j]
        center[i] = (center[i] * count[i] + center[j] * count[j]) / total
        radius[i], count[i], gone[j] = wide, total, True
        table[j, :] = table[:, j] = np.inf
        table[i, :] = table[:, i] = widths(i)
        last = live[i]
    return last


def _members(ball) -> np.ndarray:
    return ball if isinstance(ball, np.ndarray) else np.concatenate([_members(b) for b in ball])


def grown(x: np.ndarray, at: np.ndarray, leaf: int):
    """A ball over the points ``at``: an index array, or a pair of balls."""
    if len(at) <= leaf:
        return at
    groups = anchors(x[at], int(np.ceil(np.sqrt(len(at)))))
    if len(groups) == 1:  # all points are equal
        return at
    return merged(x, [grown(x, at[g], leaf) for g in groups])


def tree_of(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree over whole-number points."""
    x = points.astype(np.float64)
    order: list[np.ndarray] = []
    start, stop, left, right = [], [], [], []
    # Depth first, parents before their children; a ball's points are contiguous.
    todo, filled = [(grown(x, np.arange(len(x)), leaf), -1, False)], 0
    while todo:
        ball, parent, is_right = todo.pop()
        me = len(start)
        if parent >= 0:
            (right if is_right else left)[parent] = me
        start.append(filled)
        left.append(-1)
        right.append(-1)
        if isinstance(ball, np.ndarray):
            order.append(ball)
            filled += len(ball)
            stop.append(filled)
        else:
            stop.append(start[me] + len(_members(ball)))
            todo += [(ball[1], me, True), (ball[0], me, False)]
    at = np.concatenate(order)
    p = points[at]
    totals = np.concatenate((np.zeros((1, p.shape[1]), dtype=np.int64), np.cumsum(p, axis=0)))
    a, b = np.array(start), np.array(stop)
    sums = totals[b] - totals[a]
    center = sums / (b - a)[:, None]
    y = x[at]
    radius = np.array([np.sqrt(((y[i:j] - c) ** 2).sum(axis=1).max()) for i, j, c in zip(a, b, center, strict=True)])
    small = np.int32 if np.abs(p).max(initial=0) < 1 << 31 else np.int64
    return Tree(at.astype(np.int32), p.astype(small), a, b, np.array(left), np.array(right), center, radius, sums)


# ----------------------------------------------------------------------------- assignment
class Codebook:
    """The entries of one part position, equal ones as their lowest index."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        _, first = np.unique(entries, axis=0, return_index=True)
        self.index = np.sort(first)
        self.own = entries[self.index]
        self.real = self.own.astype(np.float64)
        self.squares = (self.real**2).sum(axis=1)
        between = self.squares[:, None] + self.squares - 2 * self.real @ self.real.T
        self.apart = np.sqrt(np.maximum(between, 0))

    def nearest(self, points: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """The nearest candidate (positions in ``own``, ascending) of each point, exactly."""
        largest = max(int(np.abs(points).max(initial=0)), int(np.abs(self.own).max(initial=0)))
        if points.shape[1] * (2 * largest) ** 2 < 1 << 53:
            score = self.squares[candidates] - 2 * points.astype(np.float64) @ self.real[candidates].T
        else:
            c = self.own[candidates]
            score = (c * c).sum(axis=1) - 2 * points.astype(np.int64) @ c.T
        return candidates[score.argmin(axis=1)]


def assigned(tree: Tree, book: Codebook) -> tuple[list[tuple[int, int]], list[tuple[int, int, np.ndarray]]]:
    """(ball, entry) of balls that one entry owns wholly, and (start, stop, entries) of the points
    of last balls that were compared one by one; entries as positions in ``book.own``."""
    owned, single = [], []
    balls, candidates = np.array([0]), np.ones((1, len(book.own)), dtype=bool)
    most = float((tree.center**2).sum(axis=1).max() + book.squares.max())
    margin = 1e-9 * (1 + most)
    while len(balls):
        c, r = tree.center[balls], tree.radius[balls]
        square = (c**2).sum(axis=1)[:, None] + book.squares - 2 * c @ book.real.T
        square = np.where(candidates, square, np.inf)
        best = square.argmin(axis=1)
        lead = square - square[np.arange(len(balls)), best][:, None]
        candidates &= lead <= 2 * (r[:, None] * 1.000001) * book.apart[best] + margin
        sole = candidates.sum(axis=1) == 1
        owned += zip(balls[sole].tolist(), candidates[sole].argmax(axis=1).tolist(), strict=True)
        last = tree.left[balls] < 0
        for i in np.flatnonzero(last & ~sole):
            a, b = tree.start[balls[i]], tree.stop[balls[i]]
            single.append((a, b, book.nearest(tree.points[a:b], np.flatnonzero(candidates[i]))))
        on = ~last & ~sole
        down = balls[on]
        balls = np.concatenate((tree.left[down], tree.right[down]))
        candidates = np.concatenate((candidates[on], candidates[on]))
    return owned, single


def entry_sums(tree: Tree, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """Count and sums of the points of each entry, by index in the codebook."""
    owned, single = assigned(tree, book)
    n, sums = np.zeros(len(book.entries), np.int64), np.zeros(book.entries.shape, np.int64)
    for ball, k in owned:
        n[book.index[k]] += tree.stop[ball] - tree.start[ball]
        sums[book.index[k]] += tree.sums[ball]
    for a, b, k in single:
        np.add.at(n, book.index[k], 1)
        np.add.at(sums, book.index[k], tree.points[a:b])
    return n, sums


def codes(tree: Tree, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """Entry index and squared distance per point, in the points' original order."""
    owned, single = assigned(tree, book)
    code = np.empty(len(tree.points), dtype=np.int64)
    for ball, k in owned:
        code[tree.start[ball] : tree.stop[ball]] = book.index[k]
    for a, b, k in single:
        code[a:b] = book.index[k]
    error = ((tree.points - book.entries[code]) ** 2).sum(axis=1)
    out, errors = np.empty_like(code), np.empty_like(error)
    out[tree.order], errors[tree.order] = code, error
    return out, errors


# ----------------------------------------------------------------------------- jobs
def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector has only finite components and a length that is a multiple of PARTS."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % PARTS == 0) & finite)


def whole(values) -> np.ndarray:
    """Vectors in whole steps."""
    steps = np.floor(np.vstack(values).astype(np.float64) * SCALE)
    if np.abs(steps).max(initial=0) > LIMIT:
        raise ValueError(f"a component is beyond {LIMIT} steps of 1/{SCALE}")
    return steps.astype(np.int64)


def planted(vectors: DataFrame, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """A row per block of vectors: their ids, labels, and a tree for each part, written."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame()
        for batch in batches:
            held = pd.concat([held, batch]) if len(held) else batch
            while len(held) >= block:
                yield plant(held.iloc[:block])
                held = held.iloc[block:]
        if len(held):
            yield plant(held)

    def plant(rows: pd.DataFrame) -> pd.DataFrame:
        parts = np.split(whole(rows["vector"]), PARTS, axis=1)
        trees = [pickle.dumps(tree_of(p, leaf), protocol=5) for p in parts]
        return pd.DataFrame({"ids": [rows["id"].tolist()], "labels": [rows["label"].tolist()], "trees": [trees]})

    return written(vectors.mapInPandas(cut, "ids array<string>, labels array<string>, trees array<binary>"), "codes-trees")


def summed(trees: DataFrame, books: list[np.ndarray]) -> dict[tuple[int, int, int], int]:
    """Over all vectors: (part, entry, place) -> sum, and the count at place -1."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = [Codebook(b) for b in books]
        n = np.zeros((PARTS, len(books[0])), np.int64)
        sums = np.zeros((PARTS, *books[0].shape), np.int64)
        for batch in batches:
            for row in batch["trees"]:
                for part, (blob, book) in enumerate(zip(row, ready, strict=True)):
                    more = entry_sums(pickle.loads(blob), book)
                    n[part] += more[0]
                    sums[part] += more[1]
        part, entry, place = np.indices(sums.shape).reshape(3, -1)
        used = n[part, entry] > 0
        yield pd.DataFrame({"part": part, "entry": entry, "place": place, "value": sums.ravel()})[used]
        part, entry = np.nonzero(n)
        yield pd.DataFrame({"part": part, "entry": entry, "place": -1, "value": n[part, entry]})

    rows = trees.select("trees").mapInPandas(add, "part int, entry int, place int, value long")
    total = rows.groupBy("part", "entry", "place").agg(F.sum("value").alias("value"))
    return {(r["part"], r["entry"], r["place"]): r["value"] for r in total.collect()}


def moved(books: list[np.ndarray], total: dict[tuple[int, int, int], int]) -> list[np.ndarray]:
    """Each used entry as the floor of its points' mean."""
    out = [b.copy() for b in books]
    for (part, entry, place), value in total.items():
        if place >= 0:
            out[part][entry, place] = value // total[part, entry, -1]
    return out


def first_books(vectors: DataFrame) -> list[np.ndarray]:
    """The parts of the ENTRIES kept vectors of the smallest ids; none of an empty table."""
    rows = vectors.orderBy(F.col("_order").asc_nulls_last(), "vector").limit(ENTRIES).collect()
    if not rows:
        return []
    return np.split(whole([r["vector"] for r in rows if len(r["vector"]) == len(rows[0]["vector"])]), PARTS, axis=1)


def encode(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) per kept vector, written, and the final codebooks."""
    v = F.col(vector_col).cast("array<double>").alias("vector")
    own = {"id": vectors.schema[id_col].dataType.simpleString(), "label": vectors.schema[label_col].dataType.simpleString()}
    kept = usable(vectors, vector_col).select(
        F.col(id_col).alias("_order"), F.col(id_col).cast("string").alias("id"),
        F.col(label_col).cast("string").alias("label"), v,
    )
    books = first_books(kept)
    length = PARTS * books[0].shape[1] if books else 0
    if books and len(books[0]) < ENTRIES:
        # Too few of the first length among the smallest ids; those that follow may have it.
        books = first_books(kept.where(F.size("vector") == length))
    trees = planted(kept.where(F.size("vector") == length).select("id", "label", "vector"))
    for _ in range(rounds if books else 0):
        books = moved(books, summed(trees, books))

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = [Codebook(b) for b in books]
        for batch in batches:
            for ids, labels, blobs in batch[["ids", "labels", "trees"]].itertuples(index=False):
                found = [codes(pickle.loads(b), book) for b, book in zip(blobs, ready, strict=True)]
                hexes = [bytes(row).hex() for row in np.stack([c for c, _ in found], axis=1).astype(np.uint8)]
                yield pd.DataFrame({"id": ids, "label": labels, "code": hexes, "error": sum(e for _, e in found)})

    coded = written(trees.mapInPandas(final, "id string, label string, code string, error long"), "codes")
    typed = (F.col("id").cast(own["id"]).alias("vec_id"), F.col("label").cast(own["label"]).alias("label"))
    return coded.select(*typed, "code", "error"), books


def books_digest(books: list[np.ndarray]) -> str:
    """Lower-case hex SHA-256 of all components by part, entry and place, comma-joined."""
    numbers = ",".join(str(x) for b in books for x in b.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def compress(vectors: DataFrame, **columns: str) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error and the digest of all codebooks."""
    coded, books = encode(vectors, **columns)
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    both = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
