import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from larkspan.llm import exact_dedup as m


def brute(rows):
    groups = defaultdict(list)
    key = lambda t: hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", t or "").encode()).hexdigest()
    for i, t in rows:
        groups[key(t)].append(i)
    return sorted((i, min(groups[key(t)]), len(groups[key(t)]), i == min(groups[key(t)]), key(t)) for i, t in rows)


def result(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


@pytest.mark.parametrize("until", [None, -1, 5, 10_000])
def test_against_brute_force(docs, until):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "", " ", "a b", "a  b", "a\t\nb", "b a", "é", "x" * 100_000, f"t{i % 40}"])) for i in range(400)]
    assert result(m.exact_dedup(docs(rows), history_until=until)) == brute(rows)


def test_empty_and_null_ids(docs):
    assert m.exact_dedup(docs([])).count() == 0
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in m.exact_dedup(docs([(None, "a"), (2, "a"), (None, "b")])).collect()}
    assert got == {(None, 2, 2, False), (2, 2, 2, True), (None, None, 1, True)}


@pytest.mark.parametrize("n", [1, 2, 3, 50, 4096])
def test_minimal_perfect_hash(n):
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), np.uint8).reshape(-1, 32)
    assert sorted(m._slots(m.minimal_perfect_hash(digests), digests, n).tolist()) == list(range(n))
