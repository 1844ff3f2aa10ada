import hashlib
import random
from collections import Counter

import pytest

from larkspan.llm import suffix_dedup as m


def brute(rows):
    data = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(t[s : s + 200] for _, t in data for s in range(len(t) - 199))
    out = []
    for i, t in data:
        mask = bytearray(len(t))
        for s in range(len(t) - 199):
            if times[t[s : s + 200]] > 1:
                mask[s : s + 200] = b"\1" * 200
        kept = bytes(c for c, x in zip(t, mask, strict=True) if not x)
        spans = sum(x and not (k and mask[k - 1]) for k, x in enumerate(mask))
        out.append((i, len(t), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgh é ") for _ in range(n))
    passages = [text(n) for n in (150, 199, 200, 201, 260, 420, 900)]
    rows = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(0, 4)):
            parts += [text(rng.randrange(0, 300)), rng.choice(passages)[rng.randrange(0, 5) :]]
        rows.append("".join(parts))
    rows += [None, "", "x" * 199, "y" * 200, "z" * 201, "ab" * 400, rows[5], rows[5], passages[-1]]
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, hot, batches", [(1, 20_000, 4), (2, 2, 3)])
def test_against_brute_force(docs, monkeypatch, seed, hot, batches):
    monkeypatch.setattr(m, "SEGMENT", 700)
    rows = corpus(seed)
    got = m.suffix_dedup(docs(rows), hot_contexts=hot, batches=batches)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got.collect()), key=repr) == brute(rows)


def test_empty_null_and_repeated_ids(docs):
    assert m.suffix_dedup(docs([])).count() == 0
    t = "".join(str(i) for i in range(200))
    got = sorted((r.n_bytes, r.n_removed) for r in m.suffix_dedup(docs([(None, t), (1, t), (1, t + "!"), (1, "other")])).collect())
    assert got == [(5, 0), (len(t), len(t)), (len(t), len(t)), (len(t) + 1, len(t))]
