import random

import numpy as np

from larkspan.llm import decontamination as m


def words(rng, n):
    return ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(n)]


def planted():
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, rng.randrange(6, 50)))) for i in range(30)] + [(90, "too few"), (91, None), (None, "no id at all here now")]
    rows, truth = [], set()
    for d in range(120):
        own = words(rng, rng.randrange(0, 300))
        if d % 4 == 0:
            item = items[rng.randrange(30)]
            leak = item[1].split()
            if d % 8 == 0 and len(leak) > 10:  # a paraphrase: one word in ten is another
                for k in range(3, len(leak), 10):
                    leak[k] = "zzz"
            own[len(own) // 2 : len(own) // 2] = leak
            truth.add((d, item[0]))
        rows.append((d, " ".join(own).capitalize()))
    rows += [(500, None), (501, ""), (502, "word " * 60_000)]
    return items, rows, truth


def brute(items, rows):
    """Every window of every document against every item, by the same check."""
    lexicon = m.Lexicon([(t or "").encode() for _, t in items])
    out = set()
    for d, t in rows:
        w = lexicon.read([(t or "").encode()])[0].tolist()
        for (i, _), x in zip(items, lexicon.items, strict=True):
            if i is not None and len(x) >= m.MIN_WORDS and len(w) < 10_000:
                size = max(m.window_sizes(len(x)))
                if any(m.is_leak(x.tolist(), w[max(0, at - size) : at + 2 * size])[0] for at in range(0, max(1, len(w)), size // 2)):
                    out.add((d, i))
    return out


def test_planted_and_brute_force(spark, docs):
    items, rows, truth = planted()
    bench = docs(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in m.leaks(docs(rows), bench).collect()}
    assert truth <= got
    want = brute(items, rows)
    assert len(got & want) >= 0.95 * len(want) and got <= want
    blocks = {(r.doc_id, r.item_id) for r in m.leaks(docs(rows), bench, block_bytes=1500).collect()}
    assert truth <= blocks


def test_directions_come_from_all_passages(docs, monkeypatch):
    """With fewer words than the random matrix has columns the directions are exact."""
    rng = random.Random(6)
    names = [f"w{k}" for k in range(70)]
    items = [(k, " ".join(names[10 * k : 10 * k + 10])) for k in range(7)]
    rows = [(d, " ".join(["of"] * 3 + (rng.choices(names[: 10 + d // 100], k=4) if d % 4 == 0 else []))) for d in range(6000)]
    directions, kept = m.latent_directions, []
    monkeypatch.setattr(m, "latent_directions", lambda own, lexicon, idf: kept.append((lexicon, idf, directions(own, lexicon, idf))) or kept[-1][-1])
    m.leaks(docs(rows), docs(items, "item_id long, text string")).count()
    (lexicon, idf, found), *more = kept
    assert not more and found.shape == (70, m.RANK)
    gram = np.zeros((70, 70))
    for _, text in rows + items:
        words = lexicon.read([text.encode()])[0]
        tf = np.bincount(words[words >= 0], minlength=70) * idf
        if tf.any():
            gram += np.outer(tf, tf) / (tf @ tf)
    want, got = np.linalg.eigvalsh(gram)[::-1][: m.RANK], found.T @ gram @ found
    assert np.abs(got - np.diag(want)).max() < 1e-4 * want[0]


def test_pipeline_fits_on_all_rows(spark, docs, monkeypatch):
    import corpus_pipeline

    directions, seen = m.latent_directions, []
    monkeypatch.setattr(m, "latent_directions", lambda own, lexicon, idf: seen.append(sum(len(r.words) // 4 for r in own.select("words").collect())) or directions(own, lexicon, idf))
    monkeypatch.setattr(corpus_pipeline.queries, "table", lambda *_: docs([(1, "a b c d e f g h")], "item_id long, text string"))
    rows = [(d, "of of " + ("a" if d % 100 == 0 else "")) for d in range(6000)]
    corpus_pipeline.drop_leaks(spark, docs(rows), "").count()
    assert seen == [60]


def test_pipeline_directions_are_those_of_all_rows(spark, docs, monkeypatch):
    """By value: what the pipeline's stage searches with spans the main directions of every passage of its rows."""
    import corpus_pipeline

    rng = random.Random(7)
    names = [f"w{k}" for k in range(70)]
    items = [(k, " ".join(names[10 * k : 10 * k + 10])) for k in range(7)]
    rows = [(d, " ".join(["of"] * 3 + (rng.choices(names[: 10 + d // 100], k=4) if d % 4 == 0 else []))) for d in range(6000)]
    kept = []

    class Searcher(m.Searcher):
        def __init__(self, lexicon, ids, weights, directions):
            kept.append((lexicon, weights, directions))
            super().__init__(lexicon, ids, weights, directions)

    monkeypatch.setattr(m, "Searcher", Searcher)
    monkeypatch.setattr(corpus_pipeline.queries, "table", lambda *_: docs(items, "item_id long, text string"))
    corpus_pipeline.drop_leaks(spark, docs(rows), "")
    (lexicon, weights, found), *more = kept
    gram = np.zeros((70, 70))
    for _, text in rows + items:
        words = lexicon.read([text.encode()])[0]
        tf = np.bincount(words[words >= 0], minlength=70) * weights
        if tf.any():
            gram += np.outer(tf, tf) / (tf @ tf)
    want = np.linalg.eigvalsh(gram)[::-1][: m.RANK]
    assert not more and np.abs(found.T @ gram @ found - np.diag(want)).max() < 1e-4 * want[0]


def test_passages_are_runs_of_a_text(docs):
    texts = [" ".join(f"w{k % 50}" for k in range(n)) for n in (0, 1, 32, 33, 100)]
    lexicon = m.Lexicon([" ".join(f"w{k}" for k in range(0, 50, 2)).encode()])
    got = []
    for r in m.passages(docs([(k, t) for k, t in enumerate(texts)]).coalesce(1), lexicon, np.ones(25)).collect():
        words, own = np.frombuffer(r.words, np.int32).tolist(), np.frombuffer(r.passages, np.int32).tolist()
        got += [sorted(w for w, p in zip(words, own, strict=True) if p == q) for q in sorted(set(own))]
    numbers = [lexicon.read([t.encode()])[0].tolist() for t in texts]
    want = [sorted(w for w in n[at : at + 32] if w >= 0) for n in numbers for at in range(0, len(n), 32)]
    assert sorted(got) == sorted(w for w in want if w)


def test_empty(docs):
    items = docs([(1, "a b c d e f g h")], "item_id long, text string")
    assert m.leaks(docs([]), items).count() == 0
    assert m.leaks(docs([(1, "a b c d e f g h")]), docs([], "item_id long, text string")).count() == 0


def test_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert m.common_subsequence(a, b) == best[-1][-1]
