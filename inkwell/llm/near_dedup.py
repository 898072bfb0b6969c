"""Near-duplicate documents by an LSH forest: several sorted orders of MinHash signatures.

Texts with the same shingle set are one node. A tree of the forest is the sorted order of all
nodes' signatures, rotated so that every tree begins with hashes of its own. Nodes that share at
least the first ``DEPTH`` hashes in some tree are candidates; in a sparse region that is all a tree
needs, in a dense one the sorted order leads each node to the neighbour with the longest common
prefix first. Links of neighbours are confirmed on full sets and joined to components. Then only
pairs of a region whose ends are still in different components are looked at: first the most alike
of each node, then all whose signatures do not exclude a link. So a region of thousands of near
copies costs no pair of two members that are already connected, and no link is lost to a cap.
Signatures rule a pair out only far below the threshold (``NEAR``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import BROADCAST_MB, WORDS, free_names, lookup, mix, slices, small_batches, stream, word_hashes, written

SHINGLE = 5
DEPTH = 4
TREES = 24
HASHES = DEPTH * TREES
KEY_LEVELS = 12
NEAR = 0.55
LAST = (1 << 63) - 1
BLOCK = 256
#: About what a link of two nodes takes in a broadcast table.
LINK_BYTES = 128
ODD = stream(21, HASHES) | np.uint64(1)
FLIP = stream(22, HASHES)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle, a text without words none."""
    hashes, firsts = word_hashes(texts, lower=True)
    sums = WORDS.prefix(hashes)
    out = []
    for a, b in zip(firsts[:-1], firsts[1:]):
        starts = np.arange(a, max(b - size, a) + 1) if b > a else np.zeros(0, dtype=np.int64)
        out.append(np.unique(WORDS.spans(sums, starts, np.minimum(starts + size, b))))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The MinHash signatures of non-empty sets as big-endian 16-bit numbers."""
    flat = np.concatenate(sets)
    starts = np.append(0, np.cumsum([len(s) for s in sets])[:-1])
    out = np.empty((len(sets), HASHES), dtype=np.uint64)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat((flat ^ FLIP[k]) * ODD[k], starts)
    return (mix(out) >> np.uint64(48)).astype(">u2")


def digest(values: np.ndarray) -> bytes:
    """16 bytes that stand for a set."""
    with np.errstate(over="ignore"):
        one, two = mix(values).sum(dtype=np.uint64), mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(one).to_bytes(8, "big") + int(two).to_bytes(8, "big")


def document_nodes(docs: DataFrame) -> DataFrame:
    """``doc_id, doc_key, text_hash, n_shingles, node, signature`` of keyed texts; node is null for an empty set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, texts in slices(batch["text"]):
                sets = shingle_sets(texts)
                full = [i for i, s in enumerate(sets) if len(s)]
                nodes, marks = [None] * len(sets), [None] * len(sets)
                if full:
                    table = signatures([sets[i] for i in full])
                    for row, i in enumerate(full):
                        nodes[i], marks[i] = digest(sets[i]), table[row].tobytes()
                own = batch.iloc[first : first + len(texts)]
                yield pd.DataFrame({
                    "doc_id": own["doc_id"].astype("Int64").to_numpy(), "doc_key": own["doc_key"].to_numpy(), "text_hash": own["text_hash"].to_numpy(),
                    "n_shingles": [len(s) for s in sets], "node": nodes, "signature": marks,
                })

    schema = "doc_id long, doc_key long, text_hash long, n_shingles long, node binary, signature binary"
    return docs.select("doc_id", "doc_key", "text_hash", "text").mapInPandas(run, schema)


def tree_key(tree: Column) -> Column:
    """The signature rotated to the tree's own hashes, as far as the sorted order looks."""
    return F.expr(f"substring(concat(signature, signature), {2 * DEPTH} * tree + 1, {2 * KEY_LEVELS})")


def neighbour_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs that stand next to each other in some tree and share its first hashes."""
    rows = nodes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = rows.select("tree", tree_key(F.col("tree")).alias("key"), "node")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "tree", "key").sortWithinPartitions("tree", "key", "node")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            tree, key, node = list(batch["tree"]), list(batch["key"]), list(batch["node"])
            if last is not None:
                tree.insert(0, last[0]), key.insert(0, last[1]), node.insert(0, last[2])
            if tree:
                last = (tree[-1], key[-1], node[-1])
            found = [
                (min(node[i], node[i + 1]), max(node[i], node[i + 1]))
                for i in range(len(tree) - 1)
                if tree[i] == tree[i + 1] and key[i][: 2 * DEPTH] == key[i + 1][: 2 * DEPTH]
            ]
            yield pd.DataFrame({"a": [f[0] for f in found], "b": [f[1] for f in found]})

    return ordered.mapInPandas(run, "a binary, b binary").distinct()


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` of the wanted nodes, from the text of the row that stands for each."""
    rows = docs.join(wanted, ["doc_key", "text_hash"]).select("node", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, texts in slices(batch["text"]):
                sets = [s.tobytes() for s in shingle_sets(texts)]
                yield pd.DataFrame({"node": batch["node"].iloc[first : first + len(texts)].to_numpy(), "shingles": sets})

    return rows.mapInPandas(run, "node binary, shingles binary").dropDuplicates(["node"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets meet ``100 * intersection >= percent * union``."""

    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right):
            a, b = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
            if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                out.append(False)
                continue
            both = np.concatenate([a, b])
            both.sort()
            same = int((both[1:] == both[:-1]).sum())
            out.append(100 * same >= percent * (len(a) + len(b) - same))
        return pd.Series(out, dtype=bool)

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(F.pandas_udf(linked, "boolean")("left", "right")).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node each other node of the written ``edges`` reaches, by alternating star contraction.

    It ends when all links are stars. While the links are few, the least neighbours are broadcast, so that a
    round shuffles sums and never the links themselves.
    """
    links, n = edges.select("a", "b"), edges.count()
    while True:
        near = F.broadcast if n * LINK_BYTES <= BROADCAST_MB << 20 else lambda df: df
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(near(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b"), "large-star")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(near(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        links = written(small.where("a <> b").distinct(), "small-star")
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(links.select("b", F.lit(0)))
        ends = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
        n, bent = ends.agg(F.coalesce(F.sum("ups"), F.lit(0)), F.count_if(F.expr("ups > 1 or (ups = 1 and least = 0)"))).first()
        if not bent:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def joined_components(labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """The components of ``labels`` joined by the links ``found``: only links between different components are contracted."""
    if labels is None:
        return components(found)
    known = lookup(labels, LINK_BYTES)
    for end in ("a", "b"):
        found = found.join(known.select(F.col("node").alias(end), F.col("component").alias(f"{end}_top")), end, "left")
    found = found.select(F.coalesce("a_top", "a").alias("a"), F.coalesce("b_top", "b").alias("b"))
    found = written(found.where("a <> b").distinct(), "component-links")
    if found.isEmpty():
        return labels
    tops = components(found)
    moved = labels.join(lookup(tops.select(F.col("node").alias("component"), F.col("component").alias("top")), LINK_BYTES), "component", "left")
    return written(moved.select("node", F.coalesce("top", "component").alias("component")).union(tops.select("node", "component")), "components")


def alike(left: Column, right: Column) -> Column:
    """The share of equal hashes of two signatures."""

    def share(left: pd.Series, right: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(x), dtype=np.uint16).reshape(-1, HASHES) for x in (left, right))
        return pd.Series((a == b).mean(axis=1))

    return F.pandas_udf(share, "double")(left, right)


def best_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """For each node the four neighbours (of at most two a tree) with the most equal hashes, if enough are equal."""
    for end in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(end), F.col("signature").alias(f"{end}_marks")), end)
    rated = pairs.select("a", "b", alike(F.col("a_marks"), F.col("b_marks")).alias("s")).where(F.col("s") >= NEAR)
    both = rated.union(rated.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
    best = both.groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct("s", "b")), False), 1, 4).alias("top"))
    best = best.select("a", F.explode("top.b").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def crossing_cells(nodes: DataFrame, labels: DataFrame, sets: DataFrame | None) -> DataFrame:
    """``region, asked, block, row, asks``: cells that hold every pair of a region whose ends are in different components.

    A region is what shares the first hashes of a tree. The members outside its largest component ask,
    in blocks of about ``BLOCK``; all its members answer, in blocks of that size too. A cell is one
    block of each, so its size does not grow with the region. ``sets`` are added to the rows.
    """
    known = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = known.select("node", "component", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = rows.withColumn("region", F.expr(f"concat(unhex(lpad(hex(tree), 2, '0')), substring(signature, {2 * DEPTH} * tree + 1, {2 * DEPTH}))"))
    sizes = rows.groupBy("region", "component").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("region").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("c"))
    mixed = mixed.where("c > 1").select("region", F.col("top.component").alias("main"), "n", (F.col("n") - F.col("top.n")).alias("few"))
    inside = rows.join(written(mixed, "mixed-regions"), "region").select("region", "tree", "node", "component", "signature", "main", "n", "few")
    for name, size, key in (("block", "n", F.xxhash64("node")), ("asked", "few", F.xxhash64("node", F.lit(1)))):
        inside = inside.withColumn(f"{name}s", F.greatest(F.lit(1), F.ceil(F.col(size) / BLOCK)).cast("int"))
        inside = inside.withColumn(name, F.pmod(key, F.col(f"{name}s")).cast("int"))
    inside = written(inside, "mixed-members")
    if sets is not None:
        inside = inside.join(sets, "node")
        row = F.struct("tree", "node", "component", "signature", "shingles")
    else:
        row = F.struct("tree", "node", "component", "signature", F.lit(None).cast("binary").alias("shingles"))
    every_block = lambda name: F.explode(F.sequence(F.lit(0), F.col(f"{name}s") - 1)).alias(name)
    every = inside.select("region", every_block("asked"), "block", row.alias("row"), F.lit(False).alias("asks"))
    few = inside.where("component <> main").select("region", "asked", every_block("block"), row.alias("row"), F.lit(True).alias("asks"))
    return every.union(few)


def crossing_pairs(nodes: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, best: int | None) -> DataFrame:
    """Pairs of a region whose ends are in different components and that may be linked.

    ``best`` gives the most alike of each asking member in a cell. None compares the sets of all pairs
    that the signatures do not exclude, and gives the first that passes for each other component.
    """

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        asks = cell["asks"].to_numpy(dtype=bool)
        rows = list(cell["row"])
        group = np.array([r["component"] for r in rows], dtype=object)
        marks = np.array([np.frombuffer(r["signature"], dtype=np.uint16) for r in rows])
        heads = marks.reshape(len(rows), TREES, DEPTH)
        found = {}
        others = np.flatnonzero(~asks)
        for i in np.flatnonzero(asks) if len(others) else []:
            share = (marks[others] == marks[i]).mean(axis=1)
            fit = (share >= NEAR) & (group[others] != group[i])
            hits, share = others[fit], share[fit]
            # a pair is looked at in the first tree that holds it
            first = (heads[hits] == heads[i]).all(axis=2).argmax(axis=1) == rows[i]["tree"]
            hits = hits[first][np.argsort(-share[first], kind="stable")]
            if best is not None:
                hits = hits[:best]
            elif len(hits):
                own, parts = np.frombuffer(rows[i]["shingles"], dtype=np.uint64), [np.frombuffer(rows[j]["shingles"], dtype=np.uint64) for j in hits]
                sizes = np.array([len(x) for x in parts])
                flat = np.concatenate(parts)
                same = np.add.reduceat(own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat, np.append(0, np.cumsum(sizes)[:-1]), dtype=np.int64)
                hits = hits[100 * same >= percent * (sizes + len(own) - same)]
            for j in hits:
                key = (i, group[j]) if best is None else (i, j)
                found.setdefault(key, (min(rows[i]["node"], rows[j]["node"]), max(rows[i]["node"], rows[j]["node"])))
        return pd.DataFrame(sorted(set(found.values())), columns=["a", "b"])

    cells = crossing_cells(nodes, labels, sets if best is None else None)
    return cells.groupBy("region", "asked", "block").applyInPandas(run, "a binary, b binary").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    A text's set holds its distinct 5-word shingles (A-Z lower-cased); a text with fewer words is one
    shingle; a null text or one without words has an empty set and is linked with nothing. Texts are
    linked if 100 * intersection >= ``percent`` * union. ``component_id`` is the smallest id
    reachable; ``kept`` marks the rows that carry it. Equal sets are linked at once. A row with a
    null id can connect others and gets their component; it is kept only where no row of its
    component has an id. Repeated rows of one id are marked alike; an empty table gives no rows;
    other columns are left out.
    """
    out = grouped_rows(docs, id_col, text_col, percent)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest id. Rows without words are kept; repeated rows are one.

    All columns of ``docs`` stay as they are, whatever their names.
    """
    out = grouped_rows(docs, id_col, text_col, percent)
    stay = out.where(F.col("node").isNull() | F.col("first")).select("doc_key", "text_hash").distinct()
    key, digest = free_names(docs, "doc_key", "text_hash")
    keyed = docs.withColumn(key, F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))).withColumn(digest, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    stay = written(stay, "kept").select(F.col("doc_key").alias(key), F.col("text_hash").alias(digest))
    return keyed.join(stay, [key, digest], "left_semi").dropDuplicates([key, digest]).select(*docs.columns)


def grouped_rows(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Every row with ``doc_id, doc_key, text_hash, n_shingles, node, component_id`` and whether it is its group's first."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    keyed = keyed.withColumn("doc_key", F.coalesce("doc_id", F.lit(LAST))).withColumn("text_hash", F.xxhash64("text"))
    rows = written(document_nodes(keyed), "document-nodes")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min(F.struct("doc_key", "text_hash", "signature")).alias("first"), F.min("doc_id").alias("least_id"))
    nodes = written(nodes.select("node", "first.*", "least_id"), "nodes")
    neighbours = written(neighbour_pairs(nodes), "neighbours")
    ends = neighbours.select(F.col("a").alias("node")).union(neighbours.select("b")).distinct()
    # whoever shares a region with another node has a neighbour there, so these are all nodes that can be linked
    linkable = written(nodes.join(ends, "node", "left_semi"), "linkable")
    sets = written(full_sets(keyed, linkable.select("node", "doc_key", "text_hash")), "sets")
    joined, labels = None, spark.createDataFrame([], "node binary, component binary")
    for best in (0, 1, None):
        pairs = best_pairs(neighbours, linkable) if best == 0 else crossing_pairs(linkable, labels, sets, percent, best)
        found = written(confirm(written(pairs, "pairs"), sets, percent), "links")
        if not found.isEmpty():
            labels = joined = joined_components(joined, found)
    named = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least_id").alias("component_id"), F.min(F.struct("doc_key", "text_hash")).alias("top"))
    owner = written(named.select("node", "component").join(smallest, "component").select("node", "component_id", "top"), "owners")
    out = rows.join(owner, "node", "left")
    found = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    first = (F.col("doc_key") == F.col("top.doc_key")) & (F.col("text_hash") == F.col("top.text_hash"))
    return out.select("doc_id", "doc_key", "text_hash", "n_shingles", "node", found.alias("component_id"), F.coalesce(first, F.lit(False)).alias("first"))
