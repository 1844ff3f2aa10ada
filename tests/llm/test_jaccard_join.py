import random
import re

import numpy as np
import pytest

from larkspan.llm import components
from larkspan.llm import jaccard_join as m


def sets_of(rows):
    out = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda x: x[0].lower(), t or ""))
        out[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute(rows):
    sets, top = sets_of(rows), {i: i for i, _ in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in sets)


def corpus(seed):
    rng = random.Random(seed)
    words = lambda n: [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(50)) for _ in range(n)]
    rows, passage = [], words(60)
    for _ in range(12):
        base = words(rng.randrange(5, 120))
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = "edit" + str(rng.randrange(1000))
            if rng.random() < 0.3:
                own += passage
            rows.append(" ".join(own).title() if rng.random() < 0.3 else "  ".join(own))
    rows += [None, "", " \t", "one two", "One  two", "a b c d", *rows[:10]]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, settings", [(1, {}), (2, {"block_bytes": 1000, "pivots": 3, "part_bytes": 4000})])
def test_against_brute_force(docs, seed, settings):
    rows = corpus(seed)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in m.jaccard_components(docs(rows), **settings).collect())
    assert got == brute(rows)


def test_empty_and_null_ids(docs):
    assert m.jaccard_components(docs([])).count() == 0
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in m.jaccard_components(docs([(None, "a b c d e f"), (4, "a b c d e f"), (None, None)])).collect()}
    assert got == {(None, 2, None), (4, 2, 4), (None, 0, None)}


def test_rows_that_repeat_ids(docs):
    """Each text of an id has its own links, and there is a row for each row."""
    rows = [(1, "a b c d e f"), (1, "g h i j k l m"), (2, "a b c d e f"), (3, "g h i j k l m"), (3, "g h i j k l m"), (4, None), (4, "x")]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in m.jaccard_components(docs(rows)).collect())
    assert got == [(1, 2, 1), (1, 3, 1), (2, 2, 1), (3, 3, 1), (3, 3, 1), (4, 0, 4), (4, 1, 4)]


def test_long_structured_words_do_not_link(docs):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, word)]
    assert sorted((r.doc_id, r.component_id) for r in m.jaccard_components(docs(rows)).collect()) == [(1, 1), (2, 2), (3, 1)]


def test_families_at_middle_distance_end(docs):
    """Sets of 10 of 20 passages: no region shrinks, so the block is joined in tiles, exactly."""
    rng = random.Random(7)
    passages = [" ".join(f"p{k}w{j}" for j in range(20)) for k in range(20)]
    rows = [(i, " ".join(passages[k] for k in rng.sample(range(20), 10))) for i in range(200)]
    rows += [(i, " ".join([passages[k] for k in rng.sample(range(20), 2)] + [passages[0]] * 20)) for i in range(200, 215)]
    rows += [(300 + i, rows[i][1] + f" tail{i} of words") for i in range(0, 60, 3)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in m.jaccard_components(docs(rows), block_bytes=40_000).collect())
    assert got == brute(rows)


def test_tiles_find_every_link(spark):
    rng = random.Random(8)
    sets = {}
    for i in range(150):
        own = rng.sample(range(60), rng.randrange(10, 60))
        sets[i] = own
    frame = spark.createDataFrame([("x" if i % 2 else "y", i, len(s), s) for i, s in sets.items()], "block string, id long, n long, hs array<long>")
    edges = {(r.src, r.dst) for r in m.tile_links(frame, 1500).collect()}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    def joined(pairs):
        top.update({i: i for i in sets})
        for a, b in pairs:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
        return [find(i) for i in sets]

    links = [(a, b) for a in sets for b in sets if a < b and (b - a) % 2 == 0 and m._near(len(sets[a]), len(sets[b]), len({*sets[a]} & {*sets[b]}))]
    assert links and joined(edges) == joined(links)


def test_chain_in_block():
    """Neighbours link, ends don't: the triangle inequality must not cut the chain."""
    sets = [np.arange(k, k + 50, dtype=np.int64) for k in range(0, 60, 4)]
    ids = np.arange(100, 100 + len(sets))
    assert set(m.block_components(ids, np.full(len(sets), 50), sets).tolist()) == {100}
    apart = [np.arange(k, k + 50, dtype=np.int64) for k in (0, 4, 40, 44)]
    assert m.block_components(np.arange(4), np.full(4, 50), apart).tolist() == [0, 0, 2, 2]


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in top}
