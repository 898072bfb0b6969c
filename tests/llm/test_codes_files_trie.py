"""Vector codes, token files and the prefix trie against brute force and exact round trips."""

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from inkwell.llm import prefix_trie, queries, token_files, vector_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_codes(rows, parts, entries, rounds):
    """``id, label, code, error, label_error`` and the codebooks of usable vectors, with Python's own integers."""
    kept = sorted(((i is None, i or 0, [int(np.floor(256 * float(x))) for x in v]), i, lab) for i, v, lab in rows
                  if v is not None and all(x is not None and np.isfinite(x) for x in v))
    cut = [[tuple(u[p * len(u) // parts : (p + 1) * len(u) // parts]) for p in range(parts)] for (_, _, u), _, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda part, book: min(range(len(book)), key=lambda e: (far(part, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[near(c[p], books[p])].append(c[p])
            for e, members in groups.items():
                books[p][e] = tuple(sum(col) // len(members) for col in zip(*members))
    out, by_label = [], defaultdict(int)
    for (_, i, lab), c in zip(kept, cut):
        codes = [near(c[p], books[p]) for p in range(parts)]
        error = sum(far(c[p], books[p][e]) for p, e in enumerate(codes))
        by_label[lab] += error
        out.append((i, lab, "".join(f"{e:02x}" for e in codes), error))
    return [(*o, by_label[o[1]]) for o in out], books


@pytest.mark.parametrize("entries", [3, 16])
def test_codes_against_brute_force(spark, frame, entries):
    rng = random.Random(entries)
    rows = [(i, [rng.choice((rng.gauss(0, 1), 0.25, -0.5)) for _ in range(8)], rng.randrange(4)) for i in range(400)]
    rows += [(1000 + i, [0.5] * 8, None) for i in range(200)]  # a third are copies
    rows += [(7, [1.0] * 8, 1), (7, [1.0] * 8, 1), (None, [2.0] * 8, 2), (2000, None, 1), (2001, [None] + [1.0] * 7, 1),
             (2002, [float("nan")] * 8, 1), (2003, [float("inf")] * 8, 0), (2004, [-1e-9] * 8, 0)]
    want, books = brute_codes(rows, 4, entries, 2)
    table = frame([(*r, 1, "c") for r in rows], "vec_id long, embedding array<double>, label int, error int, label_key string")
    out = vector_codes.compress(table, parts=4, entries=entries)
    got = [(r["id"], r["label"], r["code"], r["error"], r["label_error"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    assert {r["codebooks_sha256"] for r in out.collect()} == {hashlib.sha256(text.encode()).hexdigest()}


def test_codes_of_odd_tables(frame):
    schema = "vec_id long, embedding array<double>, label int"
    assert vector_codes.compress(frame([], schema), parts=2).collect() == []
    assert vector_codes.compress(frame([(1, None, 1)], schema), parts=2).collect() == []
    one = vector_codes.compress(frame([(1, [1.0, 1e300], 1), (2, [1.0], 1)], schema), parts=2).collect()
    assert [(r["id"], r["code"], r["error"]) for r in one] == [(1, "0000", 0)]  # of another length, beyond the limit
    with pytest.raises(ValueError):
        vector_codes.compress(frame([(1, [1.0] * 3, 1)], schema), parts=2)


def test_trees_own_their_points():
    rng = np.random.default_rng(5)
    for width, n in ((1, 40), (3, 700)):
        points = np.unique(rng.integers(-60, 60, (n, width)), axis=0)
        counts = rng.integers(1, 5, len(points))
        order, nodes = vector_codes.metric_tree(points, counts)
        assert sorted(order.tolist()) == list(range(len(points)))
        book = np.concatenate([rng.integers(-60, 60, (12, width)), np.zeros((2, width), dtype=int)])  # two equal entries
        laid = points[order]
        want = ((laid[:, None] - book) ** 2).sum(axis=2).argmin(axis=1)
        assert (vector_codes.point_codes(nodes, laid, book) == want).all()
        sums = vector_codes.ball_sums(nodes, laid, counts[order], book)
        for e in range(len(book)):
            mine = want == e
            assert (sums[e, :-1] == (laid[mine] * counts[order][mine, None]).sum(axis=0)).all() and sums[e, -1] == counts[order][mine].sum()
        owned = vector_codes.walk(nodes, laid, book[:2])[0]
        assert (nodes[owned, 3] - nodes[owned, 2]).max() > vector_codes.LEAF or width == 1  # some ball is owned whole


@pytest.mark.parametrize("bits", [1, 7, 13, 15, 16, 17, 31, 32])
def test_bits_round_trip(bits):
    for n in (0, 1, 7, 8, 9, 1001):
        ids = np.random.default_rng(n).integers(0, 1 << bits, n).astype(np.uint32)
        data = token_files.pack_bits(ids, bits)
        assert len(data) == -(-n * bits // 8) and (token_files.unpack_bits(data, bits, n) == ids).all()


def test_file_random_access(tmp_path):
    rng = np.random.default_rng(1)
    docs = [(None, 0), (5, 3), (5, 1000), (9, 1), (12, 257)]
    path = f"file:{tmp_path}/a/b.bits"
    writer = token_files.TokenWriter(path, 13, block=100)
    lists = [rng.integers(0, 1 << 13, n).astype(np.uint32) for _, n in docs]
    for (doc, _), ids in zip(docs, lists):
        writer.add(doc, ids)
    with pytest.raises(ValueError):
        writer.add(1, np.array([1 << 13], dtype=np.uint32))
    writer.close()
    file, whole = token_files.TokenFile(path), np.concatenate(lists)
    assert file.docs == [d for d, _ in docs] and file.n_ids == len(whole)
    for first, count in ((0, 0), (0, 1), (99, 2), (100, 100), (37, 900), (len(whole) - 1, 1)):
        assert (file.read(first, count) == whole[first : first + count]).all()
    assert all((file.document(k) == lists[k]).all() for k in range(len(docs)))
    assert [(d, len(x)) for d, _, x in file.documents(limit=300)] == docs
    assert os.path.getsize(f"{tmp_path}/a/b.bits") == 56 + 12 * 163 + -(-61 * 13 // 8) + 8 * 14 + 17 * 5 + 8
    file.close()


def test_files_against_the_library(spark, frame):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = [(9, "Some words  of\ttext."), (3, None), (4, ""), (-5, "é 漢字 😀"), (None, "no id"), (9, "again"), (4, ""), (70, "<|endoftext|> x"), (71, "word " * 5000)]
    folder = token_files.write_tokens(frame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, part int, ids string"), file_ids=2000)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.token_rows(folder).collect())
    sizes = defaultdict(list)
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        sizes[i].append((len(ids), zlib.crc32(ids.tobytes())))
    assert [g[1] for g in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [g[0] for g in got] == np.cumsum([0, *[g[2] for g in got]])[:-1].tolist()
    for i, found in sizes.items():
        assert sorted(found) == sorted(g[2:] for g in got if g[1] == i)
    assert token_files.token_rows(token_files.write_tokens(frame([]))).collect() == []


def brute_trie(rows, family=20, heads=4):
    stored = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            stored[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in stored.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        rebuilt[c] = tuple(own.get(c - c % family, [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[: d - 1]].add(s[:d])
    saved = {k: (len(m) - 1) * len(WORD.findall(k[-1][1])) if k else 0 for k, m in members.items()}
    leaves = {k: int(not children[k]) for k in members}
    for k in sorted(members, key=len, reverse=True):
        if k:
            saved[k[:-1]] += saved[k]
            leaves[k[:-1]] += leaves[k]
    digest = lambda k: hashlib.sha256(",".join(str(c) for c in sorted(members[k]) if len(rebuilt[c]) == len(k)).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k], digest(k)) for k, m in members.items())


def trie_rows(seed=2):
    """Conversations with shared openings, a third equal, a caterpillar of ever deeper branches, a very long one."""
    rng = random.Random(seed)
    texts = ["", "a", "a b", "a  b\tc", None, "long " * 400]
    rows = []
    for c in range(90):
        if rng.random() < 0.1:
            continue  # a base may be missing
        for turn in range(rng.randrange(1, 7)):
            rows.append((c, turn, rng.choice(("user", "bot", None)), rng.choice(texts[:4])))
    for c in range(100, 145):
        rows += [(c, t, "user", f"same {t}") for t in range(3)]
    for c in range(200, 230):
        rows += [(c, t, "user", f"deep {t}") for t in range(4, c - 192)] + [(c, 500, "bot", str(c))]
    rows += [(400, t, "user", f"turn {t % 7}") for t in range(1500)]
    rows += [(403, t, "user", f"turn {t % 7}") for t in range(1499)]
    rows += [(410, None, "x", "first"), (410, 0, "x", "then"), (411, 1, "ab", "c"), (412, 1, "a", "bc"), (413, 5, "again", "again"), (413, 5, "again", "again")]
    return rows + [(None, 1, "user", "lost"), (414, 1, None, None), (415, 1, "", "")]


def test_trie_against_brute_force(spark, frame):
    rows = trie_rows()
    random.Random(1).shuffle(rows)
    table = frame([(*r, 7, 8) for r in rows], "conv_id long, turn long, role string, text string, depth int, block int").repartition(5)
    got = sorted(tuple(r)[:8] for r in prefix_trie.prefix_trie(table).collect())
    want = brute_trie(rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert got == want
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(frame([], schema)).collect() == []
    few = [(21, 1, "a", "b"), (22, 1, "a", "b")]  # bases are missing, so a conversation may be left without turns
    assert sorted(tuple(r)[:8] for r in prefix_trie.prefix_trie(frame(few, schema)).collect()) == brute_trie(few)


def test_trie_starts_anew_when_fingerprints_meet(spark, frame, monkeypatch):
    seeds = []
    honest = prefix_trie.bases_of

    def bases(seed):
        seeds.append(seed)
        return [0, 0, 0, 0] if seed == 0 else honest(seed)  # base 0 gives every sequence the same hash

    monkeypatch.setattr(prefix_trie, "bases_of", bases)
    monkeypatch.setattr(prefix_trie, "pow", lambda b, e, p: 0 if b == 0 else pow(b, e, p), raising=False)
    rows = [(c, t, "user", f"{c % 3} {t}") for c in range(25) for t in range(3)]
    got = sorted(tuple(r)[:8] for r in prefix_trie.prefix_trie(frame(rows, "conv_id long, turn long, role string, text string")).collect())
    assert got == brute_trie(rows) and seeds == [0, 1]


def test_registered_queries(spark):
    folder = "/root/testdata/sf0.001"
    table = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    codes = queries.op11_vector_codes(spark, folder).collect()
    want, _ = brute_codes([(r["vec_id"], r["embedding"], r["label"]) for r in table("embeddings").collect()], 16, 64, 2)
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in codes) == [(w[0], *w[2:]) for w in want]
    trie = sorted(tuple(r) for r in queries.op13_prefix_trie(spark, folder).collect())
    assert trie == brute_trie([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table("conversations").collect()])
    files = queries.op12_token_files(spark, folder).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in files] == sorted(r["doc_id"] for r in table("documents").collect())
    assert [r["start"] for r in files] == np.cumsum([0, *[r["n_tokens"] for r in files]])[:-1].tolist()
