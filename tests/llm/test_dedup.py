"""Repeated windows and near copies against brute force."""

import random
import re
from collections import Counter

from inkwell.llm import near_dedup, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = [a + b for a in "abcdefgh" for b in "ijklmnop"]


def corpus(seed=3, n=120):
    """Texts with shared passages, near copies, exact copies, periodic and short texts, nulls and repeated rows."""
    rng = random.Random(seed)
    passage = [rng.choice(LETTERS) for _ in range(80)]
    base = [rng.choice(LETTERS) for _ in range(150)]
    rows = []
    for i in range(n):
        words = [rng.choice(LETTERS) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 200))]
        if i % 4 == 0:
            cut, at = rng.randrange(30, 80), rng.randrange(len(words))
            words[at:at] = passage[:cut] if i % 8 else passage[80 - cut :]
        if i % 5 == 0:
            words = [w if rng.random() > rng.choice((0.01, 0.03, 0.06)) else "new" + str(i) for w in base]
        rows.append((i, rng.choice((" ", "\n", " \t")).join(words).title() if i % 5 else " ".join(words)))
    rows += [(500, "again " * 90), (501, "x y " * 40), (502, ""), (503, None), (504, " \n "), (505, "one two"), (506, "ONE two"), (507, rows[7][1]), (7, rows[7][1])]
    rows += [(None, rows[9][1]), (None, None), (508, "é à ü " * 3), (509, "É à ü " * 3)]
    return rows


def test_windows_against_brute_force(spark, frame):
    rows = corpus()
    words = [WORD.findall(t or "") for _, t in rows]
    counts = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for s in range(len(w) - 34):
            if counts[tuple(w[s : s + 35])] > 1:
                gone[s : s + 35] = [True] * 35
        want.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    clash = frame([(i, t, "c", "d", 1, 2, 3) for i, t in rows], "doc_id long, text string, spans string, cut_result string, doc_key int, text_hash int, n_words int")
    out = substring_dedup.remove_repeats(frame(rows)).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in out))) == sorted(map(str, want))
    assert sum(w[2] for w in want) > 1000
    own = substring_dedup.remove_repeats(clash).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in own))) == sorted(map(str, want))
    assert {(r["spans"], r["cut_result"], r["doc_key"], r["text_hash"]) for r in own} == {("c", "d", 1, 2)}
    assert substring_dedup.remove_repeats(frame([(1, "a", "b")], "doc_id long, text string, kept string")).collect()[0]["kept"] == "a"
    assert substring_dedup.remove_repeats(frame([])).count() == 0


def test_tidy_keeps_untouched_text(spark, frame):
    out = substring_dedup.remove_repeats(frame([(1, " a\n b  "), (2, "w " * 40 + "\nend\there ")]), tidy=True).collect()
    assert {r["doc_id"]: r["kept"] for r in out} == {1: " a\n b  ", 2: "end\there"}


def shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                up[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(s), least.get(find(k))) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def test_near_groups_against_brute_force(spark, frame):
    rows = corpus()
    want = [(i, n, c, i == c) for i, n, c in brute_components(rows)]
    out = near_dedup.near_groups(frame(rows)).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out))) == sorted(map(str, want))


def test_a_large_region_of_near_copies_is_one_group(spark, frame):
    rng = random.Random(5)
    base = [rng.choice(LETTERS) + str(rng.randrange(50)) for _ in range(140)]
    rows = [(i, " ".join("edit" + str(rng.randrange(9999)) if rng.random() < 0.02 + 0.04 * (i % 3 > 0) else w for w in base)) for i in range(400)]
    want = {i: c for i, _, c in brute_components(rows)}
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(frame(rows)).collect()}
    assert got == want and len(set(want.values())) > 1


def test_drop_near_copies_keeps_one_of_each_group(spark, frame):
    rows = corpus()
    groups = {}
    for (i, text), (_, n, c) in zip(rows, brute_components(rows)):
        groups.setdefault(("group", c) if n else ("alone", i, text), set()).add(i)
    kept = near_dedup.drop_near_copies(frame(rows)).collect()
    assert len(kept) == len(groups)
    assert near_dedup.drop_near_copies(frame([])).count() == 0


def test_cells_of_a_crowded_region_are_bounded_and_hold_every_pair(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng, n = random.Random(8), 300
    head = bytes(2 * near_dedup.DEPTH)
    rows = [(bytes([i // 256, i % 256]), head + rng.randbytes(2 * near_dedup.HASHES - len(head))) for i in range(n)]
    nodes = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in rows], "node binary, signature binary")
    labels = spark.createDataFrame([(bytearray(rows[i][0]), bytearray(rows[0][0])) for i in range(40)], "node binary, component binary")
    cells, pairs = {}, set()
    for r in near_dedup.crossing_cells(nodes, labels, None).collect():
        cells.setdefault((bytes(r["region"]), r["asked"], r["block"]), ([], []))[r["asks"]].append(bytes(r["row"]["node"]))
    assert max(len(a) + len(b) for a, b in cells.values()) < 6 * 16
    for others, asking in cells.values():
        pairs |= {frozenset((a, b)) for a in asking for b in others}
    names = [a for a, _ in rows]
    assert all(frozenset((names[i], names[j])) in pairs for i in range(n) for j in range(max(i + 1, 40), n))


def test_columns_of_the_caller_stay(frame):
    rows = [(1, "a b c d e f", 7, 8, "x"), (2, "a b c d e f", 7, 8, "y"), (3, "g h i j k", 9, 9, "z"), (None, None, None, None, None)]
    clash = frame(rows, "doc_id long, text string, doc_key int, text_hash int, node string")
    out = near_dedup.drop_near_copies(clash)
    assert out.columns == clash.columns
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [rows[0], *rows[2:]]))


def test_components_end_with_stars_and_later_links_join_only_components(spark, monkeypatch):
    rng = random.Random(5)
    name = lambda i: bytes([i >> 8, i & 255])
    steps, keep = [], near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, step: steps.append(step) or keep(df, step))

    def brute(pairs):
        top = list(range(600))
        find = lambda i: i if top[i] == i else find(top[i])
        for a, b in pairs:
            a, b = sorted((find(a), find(b)))
            top[b] = a
        return {name(i): name(find(i)) for i in range(600) if find(i) != i}

    def links(pairs):
        return spark.createDataFrame([(name(min(p)), name(max(p))) for p in pairs], "a binary, b binary").coalesce(1)

    def found(labels):
        rows = labels.collect()
        assert len(rows) == len({bytes(r["node"]) for r in rows})
        return {bytes(r["node"]): bytes(r["component"]) for r in rows}

    star = [(0, i) for i in range(1, 40)]
    assert found(near_dedup.components(links(star))) == brute(star)
    assert steps == ["large-star", "small-star"]
    first = [(i, i + 1) for i in range(100, 180)] + [(rng.randrange(600), rng.randrange(600)) for _ in range(150)]
    first = [p for p in first if p[0] != p[1]]
    labels = near_dedup.joined_components(None, links(first))
    assert found(labels) == brute(first)
    assert near_dedup.joined_components(labels, links(first[::7])) is labels
    more = [(3, 150), (599, 0), (170, 400), (100, 180)]
    assert found(near_dedup.joined_components(labels, links(more))) == brute(first + more)
    monkeypatch.setattr(near_dedup, "BROADCAST_MB", 0)
    assert found(near_dedup.joined_components(None, links(first + more))) == brute(first + more)
