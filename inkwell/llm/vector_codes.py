"""Product codes of vectors: integer k-means per part over anchors-hierarchy metric trees.

Vectors are cut into equal parts with a codebook each. Every block of vectors holds one metric tree per
part, built once middle-out: about sqrt(n) anchors take their points from each other, are joined upwards
into balls and split downwards again; each ball caches its centre, radius, sum and count. A round walks
the trees from the root with the list of codebook entries that may still own a point of the ball. The
list shrinks on the way down; a ball with one entry left is owned whole and gives its cached sum.
Distances that decide are integers, so codes, sums and ties are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import join_unique, written

UNIT = 256
LIMIT = 1 << 27
BLOCK_VALUES = 1 << 16
LEAF = 16
FIXED = 5


def anchors(points: np.ndarray) -> np.ndarray:
    """The anchor of each of some distinct points. Every new anchor is the point farthest from its own;
    only points farther from their anchor than half the way to the new one are looked at."""
    owner = np.zeros(len(points), dtype=np.int64)
    pivots = points[:1]
    far = np.sqrt(((points - pivots[0]) ** 2).sum(axis=1))
    for new in range(1, int(np.sqrt(len(points)))):
        pivot = points[far.argmax()]
        half = np.sqrt(((pivots - pivot) ** 2).sum(axis=1)) / 2
        near = np.flatnonzero(far > half[owner])
        apart = np.sqrt(((points[near] - pivot) ** 2).sum(axis=1))
        taken = apart < far[near]
        owner[near[taken]], far[near[taken]] = new, apart[taken]
        pivots = np.append(pivots, pivot[None], axis=0)
    return owner


def join_upwards(points: np.ndarray, groups: list[np.ndarray], trees: list) -> tuple | np.ndarray:
    """One tree of the groups' trees: the two balls with the smallest common ball are joined first."""
    count = np.array([len(g) for g in groups], dtype=float)
    centre = np.array([points[g].mean(axis=0) for g in groups])
    radius = np.array([np.sqrt(((points[g] - c) ** 2).sum(axis=1)).max() for g, c in zip(groups, centre)])
    width = np.sqrt(((centre[:, None] - centre) ** 2).sum(axis=2)) + radius[:, None] + radius
    np.fill_diagonal(width, np.inf)
    trees = list(trees)
    for _ in range(len(trees) - 1):
        a, b = divmod(int(width.argmin()), len(trees))
        apart = width[a, b] - radius[a] - radius[b]
        whole = count[a] + count[b]
        trees[a], trees[b] = (trees[a], trees[b]), None
        middle = (centre[a] * count[a] + centre[b] * count[b]) / whole
        radius[a] = max(radius[a] + apart * count[b] / whole, radius[b] + apart * count[a] / whole)
        centre[a], count[a] = middle, whole
        width[b], width[:, b] = np.inf, np.inf
        row = np.sqrt(((centre - middle) ** 2).sum(axis=1)) + radius + radius[a]
        live = np.isfinite(width[a])
        live[b] = False
        width[a, live] = width[live, a] = row[live]
        last = trees[a]
    return last


def grow(points: np.ndarray, chosen: np.ndarray) -> tuple | np.ndarray:
    """A nested tree over some points: a leaf is an array of places, a ball a pair of trees."""
    if len(chosen) <= LEAF:
        return chosen
    owner = anchors(points[chosen])
    order = np.argsort(owner, kind="stable")
    groups = np.split(chosen[order], np.flatnonzero(np.diff(owner[order])) + 1)
    return join_upwards(points, groups, [grow(points, g) for g in groups])


def metric_tree(points: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that lays every ball's points side by side, and a row per ball:
    ``left, right, start, end, radius, centre.., sum.., count`` (left -1: a leaf)."""
    rows, order, at = [], [], 0
    stack = [(grow(points.astype(float), np.arange(len(points))), -1, 0)]
    opened: list[list] = []
    while stack:
        tree, parent, side = stack.pop()
        place = len(opened)
        if parent >= 0:
            opened[parent][side] = place
        if isinstance(tree, tuple):
            opened.append([-1, -1, at, -1])
            stack += [(tree[1], place, 1), (tree[0], place, 0)]
        else:
            opened.append([-1, -1, at, at + len(tree)])
            order.append(tree)
            at += len(tree)
    for node in reversed(opened):
        if node[3] < 0:
            node[3] = opened[node[1]][3]
    order = np.concatenate(order)
    laid, weight = points[order], counts[order]
    sums = np.concatenate([np.zeros((1, points.shape[1]), dtype=np.int64), np.cumsum(laid * weight[:, None], axis=0)])
    totals = np.concatenate([[0], np.cumsum(weight)])
    for left, right, start, end in opened:
        inside = laid[start:end]
        centre = inside.mean(axis=0)
        radius = np.sqrt(((inside - centre) ** 2).sum(axis=1).max())
        rows.append((left, right, start, end, radius, *centre, *(sums[end] - sums[start]), totals[end] - totals[start]))
    return order, np.array(rows, dtype=float)


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``[start, end)``, one after the other."""
    size = ends - starts
    return np.arange(size.sum()) + np.repeat(starts - np.cumsum(size) + size, size)


def walk(nodes: np.ndarray, points: np.ndarray, book: np.ndarray) -> tuple:
    """Owned balls with their entries, and the points of the leaves left over with theirs.

    An entry leaves a ball's list if the ball lies wholly on the other side of the plane between it and
    the entry nearest to the centre. A tie never removes an entry, and rounding is allowed for.
    """
    width = points.shape[1]
    centres, entries = nodes[:, FIXED : FIXED + width], book.astype(float)
    between = np.sqrt(((entries[:, None] - entries) ** 2).sum(axis=2))
    at, lists = np.array([0]), np.ones((1, len(book)), dtype=bool)
    owned, owners, left_places, left_codes = [], [], [], []
    while len(at):
        apart = ((centres[at][:, None] - entries) ** 2).sum(axis=2)
        nearest = np.where(lists, apart, np.inf).argmin(axis=1)
        least = apart[np.arange(len(at)), nearest][:, None]
        lists &= apart - least <= 2 * nodes[at, 4][:, None] * between[nearest] * (1 + 1e-9) + 1e-9 * (apart + least) + 1e-6
        single = lists.sum(axis=1) == 1
        owned.append(at[single])
        owners.append(nearest[single])
        leaf = ~single & (nodes[at, 0] < 0)
        if leaf.any():
            starts, ends = nodes[at[leaf], 2].astype(int), nodes[at[leaf], 3].astype(int)
            places = ranges(starts, ends)
            distance = ((points[places][:, None] - book) ** 2).sum(axis=2)
            distance[~np.repeat(lists[leaf], ends - starts, axis=0)] = np.iinfo(np.int64).max
            left_places.append(places)
            left_codes.append(distance.argmin(axis=1))
        inner = ~single & ~leaf
        at = nodes[at[inner], :2].astype(int).ravel()
        lists = np.repeat(lists[inner], 2, axis=0)
    none = [np.zeros(0, dtype=int)]
    return np.concatenate(owned), np.concatenate(owners), np.concatenate(left_places or none), np.concatenate(left_codes or none)


def ball_sums(nodes: np.ndarray, points: np.ndarray, counts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Sum and count of the points of each entry: rows of a part's components and the count."""
    width = points.shape[1]
    owned, owners, places, codes = walk(nodes, points, book)
    total = np.zeros((len(book), width + 1), dtype=np.int64)
    np.add.at(total, owners, nodes[owned, FIXED + width :].astype(np.int64))
    weight = counts[places][:, None]
    np.add.at(total, codes, np.concatenate([points[places] * weight, weight], axis=1))
    return total


def point_codes(nodes: np.ndarray, points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The nearest entry of every point, ties to the lower index."""
    owned, owners, places, codes = walk(nodes, points, book)
    out = np.empty(len(points), dtype=np.int64)
    starts, ends = nodes[owned, 2].astype(int), nodes[owned, 3].astype(int)
    out[ranges(starts, ends)] = np.repeat(owners, ends - starts)
    out[places] = codes
    return out


def units_of(vector: Column) -> Column:
    """Each component in units of 1/256, rounded down, within the limit."""
    return F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * UNIT), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))


def usable(vector: Column) -> Column:
    """True for vectors that are there and hold finite components only."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(ok, F.lit(False))


ARRAYS = ("places", "points", "counts", "sizes", "nodes")


def build_blocks(rows: DataFrame, dims: int, parts: int) -> DataFrame:
    """One row per block of vectors: ids, labels and the trees of all parts as flat arrays."""
    width, size = dims // parts, max(64, BLOCK_VALUES // dims)
    kinds = dict(rows.dtypes)

    def packed(block: pd.DataFrame) -> pd.DataFrame:
        units = np.array(block["units"].tolist(), dtype=np.int32).reshape(len(block), dims)
        kept: dict[str, list] = {name: [] for name in ARRAYS}
        for part in range(parts):
            distinct, inverse, counts = np.unique(units[:, part * width : (part + 1) * width], axis=0, return_inverse=True, return_counts=True)
            order, nodes = metric_tree(distinct.astype(np.int64), counts)
            place = np.empty(len(order), dtype=np.int32)
            place[order] = np.arange(len(order))
            arrays = place[inverse.ravel()], distinct[order], counts[order].astype(np.int32), np.array([len(order), len(nodes)], dtype=np.int32), nodes
            for name, array in zip(ARRAYS, arrays):
                kept[name].append(array.tobytes())
        out = {name: [b"".join(found)] for name, found in kept.items()}
        return pd.DataFrame({"ids": [block["id"].tolist()], "labels": [block["label"].tolist()], **out})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        held = 0
        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            while len(batch):
                waiting.append(batch.iloc[: size - held])
                batch = batch.iloc[size - held :]
                held += len(waiting[-1])
                if held == size:
                    yield packed(pd.concat(waiting))
                    waiting, held = [], 0
        if held:
            yield packed(pd.concat(waiting))

    schema = f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, " + ", ".join(f"{name} binary" for name in ARRAYS)
    return rows.mapInPandas(run, schema)


def block_parts(row, parts: int, width: int) -> Iterator[tuple]:
    """``places, points, counts, nodes`` of each part of a block's row."""
    n, columns = len(row.ids), FIXED + 2 * width + 1
    places = np.frombuffer(row.places, dtype=np.int32).reshape(parts, n)
    points = np.frombuffer(row.points, dtype=np.int32).reshape(-1, width).astype(np.int64)
    counts = np.frombuffer(row.counts, dtype=np.int32).astype(np.int64)
    nodes = np.frombuffer(row.nodes).reshape(-1, columns)
    sizes = np.frombuffer(row.sizes, dtype=np.int32).reshape(parts, 2)
    ends = np.cumsum(sizes, axis=0)
    for part, ((u, m), (u_end, m_end)) in enumerate(zip(sizes, ends)):
        yield places[part], points[u_end - u : u_end], counts[u_end - u : u_end], nodes[m_end - m : m_end]


def entry_sums(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Per part and entry the sums of its points' components and their count: a table bounded by the codebooks."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for batch in batches:
            for row in batch.itertuples(index=False):
                for part, (_, points, counts, nodes) in enumerate(block_parts(row, parts, width)):
                    total[part] += ball_sums(nodes, points, counts, books[part])
        yield pd.DataFrame({"slot": np.arange(total.size), "value": total.ravel()})

    slots = blocks.mapInPandas(run, "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value"))
    total = np.zeros(parts * entries * (width + 1), dtype=np.int64)
    for row in slots.collect():
        total[row["slot"]] = row["value"]
    return total.reshape(parts, entries, width + 1)


def fit_codebooks(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after some rounds; an entry without points stays as it is."""
    for _ in range(rounds):
        total = entry_sums(blocks, books)
        count = total[:, :, -1:]
        books = np.where(count > 0, total[:, :, :-1] // np.maximum(count, 1), books)
    return books


def code_blocks(blocks: DataFrame, books: np.ndarray, id_type: str, label_type: str) -> DataFrame:
    """``id, label, code, error`` of every vector."""
    parts, _, width = books.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                n = len(row.ids)
                codes, error = np.empty((n, parts), dtype=np.int64), np.zeros(n, dtype=np.int64)
                for part, (places, points, _, nodes) in enumerate(block_parts(row, parts, width)):
                    found = point_codes(nodes, points, books[part])
                    codes[:, part] = found[places]
                    error += ((points - books[part][found]) ** 2).sum(axis=1)[places]
                digits = [f"{i:0{2 if books.shape[1] <= 256 else 4}x}" for i in range(books.shape[1])]
                text = ["".join(digits[c] for c in line) for line in codes.tolist()]
                yield pd.DataFrame({"id": pd.Series(list(row.ids), dtype=object), "label": pd.Series(list(row.labels), dtype=object), "code": text, "error": error})

    return blocks.mapInPandas(run, f"id {id_type}, label {label_type}, code string, error long")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16,
    entries: int = 64, rounds: int = 2,
) -> DataFrame:
    """``id, label, code, error, label_error, codebooks_sha256`` of every usable vector.

    Codebooks start as the parts of the ``entries`` rows of smallest id. Vectors that are null or hold a null,
    NaN or infinite component are left out, and so are those of another length than the first row's.
    A component beyond 2**27 units of 1/256 counts as 2**27. Null ids come after all others; repeated
    rows and equal ids each count; rows of one id are taken in the order of their components. Fewer
    rows than ``entries`` give as many entries; an empty table gives no rows. Other columns play no
    part. Nothing is shuffled but one row per task, part and entry, and the errors per label.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    rows = rows.where(usable(F.col("vector"))).select("id", "label", units_of(F.col("vector")).alias("units"))
    seeds = [r["units"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "units").limit(entries).collect()]
    dims = len(seeds[0]) if seeds else parts
    if dims % parts or not dims:
        raise ValueError(f"{dims} components cannot be cut into {parts} equal parts")
    books = np.array([s for s in seeds if len(s) == dims], dtype=np.int64).reshape(-1, parts, dims // parts).swapaxes(0, 1)
    kinds = dict(rows.dtypes)
    blocks = written(build_blocks(rows.where(F.size("units") == dims), dims, parts), "vector-trees")
    books = fit_codebooks(blocks, books, rounds) if seeds else books
    coded = written(code_blocks(blocks, books, kinds["id"], kinds["label"]), "vector-codes")
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    coded = coded.withColumn("label_key", key)
    totals = coded.groupBy("label_key").agg(F.sum("error").alias("label_error"), F.count("*").alias("label_rows"))
    out = join_unique(coded, written(totals, "label-errors"), ["label_key"], "label_rows")
    return out.select("id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
