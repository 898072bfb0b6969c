"""The trie of conversation prefixes, from fingerprints that are combined and never from rebuilt texts.

A conversation is rebuilt from the head of another one and its own suffix. The hash of a sequence is
the sum of its turns' digests times powers of a base, modulo four primes: a monoid of affine maps, in
which a run of turns stands for ``x -> add + scale * x``. The hash of every rebuilt prefix is put
together from the head's product and the own suffix's, so a turn is read once, where it is stored.

Turns are sorted over all tasks, so one conversation may hold any share of them: each task hashes its
run, and the runs of a conversation are composed in order. The trie is cut in paths: a node belongs to
its smallest member, whose nodes form one path downwards; paths hang on nodes of other paths. Sums
over subtrees are sums along paths plus totals of hanging paths, which pointer doubling adds up in as
many rounds as the logarithm of the paths' depth.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import join_unique, stream, written
from inkwell.operators.order import running_totals

# Primes below 2**31.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
HALF, LOW = 31, (1 << 31) - 1
NOT_SPACE = r"[^\x20\x09-\x0D]+"
CHUNK = 1 << 16
SEEDS = 8
KEY = ["depth", "f", "g"]


def pack(parts: list) -> tuple:
    """Four residues as two numbers of 62 bits."""
    return (parts[0] << HALF) | parts[1], (parts[2] << HALF) | parts[3]


def unpack(f: int, g: int) -> list[int]:
    return [f >> HALF, f & LOW, g >> HALF, g & LOW]


def powers(base: int, exponents: np.ndarray, prime: int) -> np.ndarray:
    out, step, left = np.ones(len(exponents), dtype=np.int64), base, exponents.copy()
    while left.any():
        odd = (left & 1).astype(bool)
        out[odd] = out[odd] * step % prime
        step, left = step * step % prime, left >> 1
    return out


def bases_of(seed: int) -> list[int]:
    return [int(x) % (p - 2) + 2 for x, p in zip(stream(1000 + seed, 4), PRIMES)]


def read_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turn, t1, t2, words``: 120 bits of each turn's SHA-256 and its number of words."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    whole = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said).cast("binary"), 256)
    number = lambda at: F.conv(F.substring(whole, at, 15), 16, 10).cast("long")
    words = F.regexp_count(said, F.lit(NOT_SPACE)).cast("long")
    kept = rows.where(F.col(conv).isNotNull())
    return kept.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), number(1).alias("t1"), number(16).alias("t2"), words.alias("words"))


PLACED = "conv_id long, block int, local long, t1 long, t2 long, words long, l1 long, l2 long, q1 long, q2 long"


def hash_runs(turns: DataFrame, bases: list[int]) -> DataFrame:
    """Every turn with its place in its task's run of the conversation and the run's product up to it
    (``l1, l2``) and before it (``q1, q2``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, local, held = None, 0, [0, 0, 0, 0]
        for batch in batches:
            if not len(batch):
                continue
            ids = batch["conv_id"].to_numpy(np.int64)
            fresh = np.append(True, ids[1:] != ids[:-1])
            first = np.flatnonzero(fresh)
            group = np.cumsum(fresh) - 1
            continues = conv is not None and ids[0] == conv
            place = np.arange(len(ids)) - first[group] + 1
            place[group == 0] += local if continues else 0
            after, before = [], []
            for k, (base, prime) in enumerate(zip(bases, PRIMES)):
                digest = batch["t1" if k < 2 else "t2"].to_numpy(np.int64) % prime
                term = digest * powers(base, place, prime) % prime
                sums = np.cumsum(term)
                start = (sums - term)[first]
                total = sums - start[group]
                if continues:
                    total[group == 0] += held[k]
                after.append(total % prime)
                before.append((total - term) % prime)
                held[k] = int(after[-1][-1])
            conv, local = ids[-1], int(place[-1])
            (l1, l2), (q1, q2) = pack(after), pack(before)
            yield pd.DataFrame({"conv_id": ids, "block": batch["block"], "local": place, "t1": batch["t1"], "t2": batch["t2"],
                                "words": batch["words"], "l1": l1, "l2": l2, "q1": q1, "q2": q2})

    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")]
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("block", F.spark_partition_id())
    return placed.mapInPandas(run, PLACED)


RUN = "struct<block int, shift long, skip long, a1 long, a2 long, c1 long, c2 long>"
HEAD = "struct<depth long, f long, g long, pf long, pg long, t1 long, t2 long, words long>"


def compose(placed: DataFrame, bases: list[int], family: int, heads: int) -> DataFrame:
    """Per conversation: how to turn its runs' products into hashes of rebuilt prefixes, the turns it takes
    from its family's head, and its last node.

    A conversation has at most one run per task, and only its first ``heads - 1`` turns come along.
    """
    early = F.when(F.col("local") < heads, F.struct("local", "t1", "t2", "words", "l1", "l2"))
    runs = placed.groupBy("conv_id", "block").agg(
        F.max("local").alias("size"), F.max_by("l1", "local").alias("l1"), F.max_by("l2", "local").alias("l2"),
        F.sort_array(F.collect_list(early)).alias("early"),
    )
    convs = runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "size", "l1", "l2", "early"))).alias("runs"))
    convs = convs.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % family)
    firsts = written(convs, "conversation-runs")
    base = firsts.where("conv_id = base_id").select("base_id", F.col("runs").alias("base_runs"))

    def opened(runs: list | None) -> tuple[list, list]:
        """Per run ``block, turns before, product before, scale, size, product``; the first turns with their products."""
        found, early, before, product = [], [], 0, [0, 0, 0, 0]
        for run in [] if runs is None else runs:
            scale = [pow(b, before, p) for b, p in zip(bases, PRIMES)]
            whole = unpack(run["l1"], run["l2"])
            for turn in run["early"]:
                if before + turn["local"] == len(early) + 1 < heads:
                    part = unpack(turn["l1"], turn["l2"])
                    early.append((turn, [(s + c * x) % p for s, c, x, p in zip(product, scale, part, PRIMES)]))
            found.append((run["block"], before, product, scale, run["size"]))
            product = [(s + c * x) % p for s, c, x, p in zip(product, scale, whole, PRIMES)]
            before += run["size"]
        return [*found, (None, before, product, None, 0)], early

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv, base_id, own, other in zip(batch["conv_id"], batch["base_id"], batch["runs"], batch["base_runs"]):
                h = zlib.crc32(str(conv).encode()) % heads
                (*mine, (_, n, product, _, _)), early = opened(own)
                head = opened(other)[1][:h]
                taken = len(head)
                start = head[-1][1] if head else [0, 0, 0, 0]
                gone = early[h - 1][1] if 0 < h <= n else [0, 0, 0, 0]
                back = [pow(b, taken - h, p) for b, p in zip(bases, PRIMES)]
                moved = lambda part: [(s + (x - g) * c) % p for s, x, g, c, p in zip(start, part, gone, back, PRIMES)]
                maps = [
                    (block, before - h + taken, h - before, *pack(moved(sums)), *pack([c * x % p for c, x, p in zip(back, scale, PRIMES)]))
                    for block, before, sums, scale, size in mine
                    if before + size > h
                ]
                turns, last = [], [0, 0, 0, 0]
                for depth, (turn, sums) in enumerate(head, 1):
                    turns.append((depth, *pack(sums), *pack(last), turn["t1"], turn["t2"], turn["words"]))
                    last = sums
                length = taken + max(0, n - h)
                out.append((conv, base_id, length, *pack(moved(product) if n > h else last), maps, turns))
            yield pd.DataFrame(out, columns=["conv_id", "base_id", "length", "end_f", "end_g", "maps", "heads"])

    schema = f"conv_id long, base_id long, length long, end_f long, end_g long, maps array<{RUN}>, heads array<{HEAD}>"
    return firsts.join(base, "base_id", "left").select("conv_id", "base_id", "runs", "base_runs").mapInPandas(run, schema)


def applied(first: str, second: str) -> list[Column]:
    """A run's affine map on a packed product, both halves."""
    out = []
    for k, column in enumerate((first, second), 1):
        add, scale, x = F.col(f"a{k}"), F.col(f"c{k}"), F.col(column)
        high = (F.shiftright(add, HALF) + F.shiftright(scale, HALF) * F.shiftright(x, HALF)) % PRIMES[2 * k - 2]
        low = (add.bitwiseAND(LOW) + scale.bitwiseAND(LOW) * x.bitwiseAND(LOW)) % PRIMES[2 * k - 1]
        out.append(F.shiftleft(high, HALF).bitwiseOR(low))
    return out


def prefix_nodes(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node below the root: key, smallest member, members, parent's key, its turn's reference and
    words, and whether all members agree on turn and parent."""
    maps = convs.select("conv_id", F.explode("maps").alias("m")).select("conv_id", "m.*")
    own = placed.join(maps, ["conv_id", "block"]).where("local > skip")
    (f, g), (pf, pg) = applied("l1", "l2"), applied("q1", "q2")
    own = own.select(
        "conv_id", (F.col("local") + F.col("shift")).alias("depth"), f.alias("f"), g.alias("g"), pf.alias("pf"), pg.alias("pg"),
        "t1", "t2", "words", F.col("conv_id").alias("turn_conv"),
    )
    heads = convs.select("conv_id", "base_id", F.explode("heads").alias("t"))
    heads = heads.select("conv_id", *[f"t.{c}" for c in (*KEY, "pf", "pg", "t1", "t2", "words")], F.col("base_id").alias("turn_conv"))
    same = ("pf", "pg", "t1", "t2")
    nodes = own.unionByName(heads).groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
        F.min_by("turn_conv", "conv_id").alias("turn_conv"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"max_{c}") for c in same],
    )
    agree = F.lit(True)
    for c in same:
        agree = agree & (F.col(c) == F.col(f"max_{c}"))
    return nodes.select(*KEY, "conv_id", "n_convs", "pf", "pg", "words", "turn_conv", agree.alias("agree"))


def ends_digests(convs: DataFrame) -> DataFrame:
    """``depth, f, g, ends_sha256`` of the nodes where conversations end.

    The members of one node may lie in many tasks, each of which writes them as chunks of text; the
    digest is then fed chunk by chunk. SHA-256 has no parallel form, so the bytes of one node's chunks go
    through one task as a stream, held a batch at a time.
    """
    order = [*KEY, "conv_id"]
    ends = convs.select(F.col("length").alias("depth"), F.col("end_f").alias("f"), F.col("end_g").alias("g"), "conv_id")

    def cut_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, first, held, size = None, None, [], 0
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False, name=None):
                if row[:3] != key or size > CHUNK:
                    if held:
                        out.append((*key, first, ",".join(held)))
                    key, first, held, size = row[:3], row[3], [], 0
                held.append(str(row[3]))
                size += len(held[-1]) + 1
            yield pd.DataFrame(out, columns=[*KEY, "first", "chunk"])
        if held:
            yield pd.DataFrame([(*key, first, ",".join(held))], columns=[*KEY, "first", "chunk"])

    def feed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False, name=None):
                if row[:3] != key:
                    if digest is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = row[:3], hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(row[4].encode())
            yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
        if digest is not None:
            yield pd.DataFrame([(*key, digest.hexdigest())], columns=[*KEY, "ends_sha256"])

    schema = "depth long, f long, g long"
    chunks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(cut_chunks, f"{schema}, first long, chunk string")
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInPandas(feed, f"{schema}, ends_sha256 string")


def path_totals(paths: DataFrame) -> DataFrame:
    """``conv_id, saved, leaves`` summed over each path and all that hang below it.

    ``paths`` holds ``conv_id, up, saved, leaves``, ``up`` being the path it hangs on. In each round every path
    gives its sum to the path twice as far up as in the round before.
    """
    state = paths
    while state.where("up IS NOT NULL").limit(1).count():
        below = state.where("up IS NOT NULL").groupBy(F.col("up").alias("conv_id"))
        gain = written(below.agg(F.sum("saved").alias("more"), F.sum("leaves").alias("more_leaves"), F.count("*").alias("weight")), "path-sums")
        grown = state.join(gain, "conv_id", "left")
        next_up = gain.join(state.select("conv_id", F.col("up").alias("next")), "conv_id").select(F.col("conv_id").alias("up"), "next", "weight")
        jumped = join_unique(grown.drop("weight").where("up IS NOT NULL"), written(next_up, "path-jumps"), ["up"], "weight")
        sums = [(F.col(a) + F.coalesce(b, F.lit(0))).alias(a) for a, b in (("saved", "more"), ("leaves", "more_leaves"))]
        roots = grown.where("up IS NULL").select("conv_id", "up", *sums)
        state = written(jumped.select("conv_id", F.col("next").alias("up"), *sums).unionByName(roots), "path-totals")
    return state.select("conv_id", "saved", "leaves")


def prefix_trie(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", family: int = 20, heads: int = 4,
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``, and ``turn_conv``, the conversation that stores the node's last turn.
    Conversation c is rebuilt from the first h turns of c - c % ``family``, h = crc32(c) % ``heads``, and
    its own turns after the first h. Null role and text count as empty. A null turn comes first; turns that
    tie are in the order of their digests; repeated rows are turns of their own. Rows of null conversations
    are left out. An empty table gives no rows. Other columns play no part. Two turns are equal if 120 bits of SHA-256 of role and text
    are; a node's members are checked for the same parent and the same turn, and hashing starts anew
    with other bases if some differ.
    """
    turns = read_turns(rows, conv, turn, role, text)
    for seed in range(SEEDS):
        bases = bases_of(seed)
        placed = written(hash_runs(turns, bases), "turn-products")
        convs = written(compose(placed, bases, family, heads), "conversation-maps")
        nodes = written(prefix_nodes(placed, convs), "prefix-nodes")
        if not nodes.where("NOT agree").limit(1).count():
            break
    else:
        raise RuntimeError(f"fingerprints of different prefixes met under {SEEDS} bases")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in KEY], "conv_id", "n_convs", none.alias("pf"), none.alias("pg"), zero.alias("words"), none.alias("turn_conv"))
    nodes = root.unionByName(nodes.drop("agree"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pf").alias("f"), F.col("pg").alias("g"))
    nodes = nodes.join(children.agg(F.count("*").alias("n_children")), KEY, "left").na.fill(0, ["n_children"])
    nodes = written(nodes, "prefix-children")
    up = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("f").alias("pf"), F.col("g").alias("pg"), F.col("conv_id").alias("parent_conv_id"),
        F.col("n_children").alias("weight"),
    )
    linked = join_unique(nodes.where("depth > 0"), up, ["depth", "pf", "pg"], "weight")
    linked = linked.unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", none))
    linked = linked.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    linked = written(linked.drop("pf", "pg", "words"), "prefix-links")

    tops = linked.where("parent_conv_id <> conv_id").select("conv_id", F.col("parent_conv_id").alias("up"), (F.col("depth") - 1).alias("at"))
    paths = linked.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves")).join(tops, "conv_id", "left")
    paths = written(paths, "prefix-paths")
    totals = path_totals(paths.select("conv_id", "up", "saved", "leaves"))
    hung = paths.where("up IS NOT NULL").select("conv_id", "up", "at").join(totals, "conv_id")
    hung = hung.groupBy(F.col("up").alias("conv_id"), F.col("at").alias("depth")).agg(F.sum("saved").alias("hung_saved"), F.sum("leaves").alias("hung_leaves"))
    summed = linked.join(hung, ["conv_id", "depth"], "left").na.fill(0, ["hung_saved", "hung_leaves"])
    summed = summed.withColumn("saved", F.col("saved") + F.col("hung_saved")).withColumn("leaf", F.col("leaf") + F.col("hung_leaves"))
    summed = running_totals(summed.withColumn("up_order", -F.col("depth")), ["up_order"], {"saved_tokens": "saved", "n_leaves": "leaf"}, ["conv_id"])
    out = summed.join(ends_digests(convs), KEY, "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), "turn_conv",
    )
