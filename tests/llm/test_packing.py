import zlib
from collections import defaultdict

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from larkspan.llm import packing as m  # noqa: E402

PATH = P.path("word_bpe_49k.json")
TEXTS = [None, "", "Hello, world's  end!!\n\tnaïveté ***x*** don't", "<|endoftext|> a <|startoftext|>", "a\x1cb\x85c\xa0d İstanbul ΣΑΣ ½ 12³", "word " * 9000, "é́ ﬁ K"]


def ids_of(texts):
    t = Tokenizer.from_file(PATH)
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for x in texts]


def checked(df, texts, length, rows):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in df.collect():
        by_doc[r.id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, ids in enumerate(ids_of(texts)):
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            if rows:
                assert bytes(r.ids) == ids[at : at + r.length].tobytes()
            at += r.length
        assert at == len(ids)
    used = []
    for s in sorted(by_sequence):
        at = 0
        for r in sorted(by_sequence[s], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        used.append(at)
    assert sorted(by_sequence) == list(range(len(used))) and all(u == length for u in used[:-1]) and used[-1] <= length
    return by_sequence


@pytest.mark.parametrize("length, window, targets", [(4096, 64, None), (64, 4, None), (64, 4, {"a": 0.7, "b": 0.2, "c": 0.1}), (32, 1, {"a": 1.0})])
def test_round_trip(docs, length, window, targets):
    texts = TEXTS + [f"some words {i} " * (i % 50) for i in range(60)]
    rows = [(i, t, [None, "a", "b", "c"][i % 4]) for i, t in enumerate(texts)]
    tokens = m.tokenised(docs(rows, "doc_id long, text string, source string"), PATH)
    checked(m.pack(tokens, targets, length, window), texts, length, True)


def test_windows_keep_proportions(docs):
    texts = ["alpha beta gamma delta " * 50 for _ in range(80)]
    rows = [(i, t, "a" if i < 60 else "b") for i, t in enumerate(texts)]
    by_sequence = checked(m.pack(m.tokenised(docs(rows, "doc_id long, text string, source string"), PATH), {"a": 0.5, "b": 0.5}, 256, 1, with_ids=False), texts, 256, False)
    for s in range(20):  # both queues still have tokens
        assert abs(sum(r.length for r in by_sequence[s] if r.source == "a") - 128) <= 1


def test_empty(docs):
    assert m.pack(m.tokenised(docs([], "doc_id long, text string, source string"), PATH)).count() == 0
    assert m.padded_length(512) == 512 and m.padded_length(513) == 4096


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_many_sources_share_queues_and_long_structured_words(docs):
    """Words that cancel out in a power series modulo 2 ** 64 keep their own ids; rows without an id stay."""
    word = thue_morse(1024)
    texts = [word, word.translate(str.maketrans("ab", "ba")), thue_morse(4096), *[f"text {i} " * (i % 9) for i in range(40)]]
    rows = [(i, t, f"host{i % 11}") for i, t in enumerate(texts)]
    tokens = m.tokenised(docs(rows, "doc_id long, text string, source string"), PATH)
    for targets in (None, {"host1": 0.5, "host2": 0.5}):
        checked(m.pack(tokens, targets, 64, 2, max_queues=3), texts, 64, True)
    odd = m.pack(m.tokenised(docs([(None, "a b", "s"), (None, None, None)], "doc_id long, text string, source string"), PATH)).collect()
    assert [r.id for r in odd] == [None, None] and sum(r.length for r in odd) == 4
