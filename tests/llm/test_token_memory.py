"""op13_token_store: what a worker holds is bounded, and parts known from earlier slices give the same ids."""

import tracemalloc

import numpy as np
import public_tokenizers as tokens
import pytest

from palimpsest.llm import token_store

PATH = tokens.path("word_bpe_49k.json")


def slice_of(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def words(seed, n):
    rng = np.random.default_rng(seed)
    letters = rng.integers(97, 123, (n, 8), dtype=np.uint8)
    return b" ".join(row.tobytes() for row in letters).decode()


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda t: tokenizer.encode(t, add_special_tokens=False).ids


def ids_of(code, texts):
    return [np.frombuffer(x, f"<u{code.width}").tolist() for x in code.ids(*slice_of(texts))]


def test_known_parts_over_slices(plain):
    code = token_store.Encoder(PATH)
    code.known.most = 40
    for seed in range(12):  # parts of this slice, of earlier ones that are kept, and of such that are not
        texts = [words(k % 5, 30) + " don't CAFÉ 東京 12 " + words(k, 3) + "x" * 90 for k in (seed, seed + 1, 0)] + [""]
        assert ids_of(code, texts) == [plain(t) for t in texts]
        names, others, at, n, flat = code.known.new
        assert len(names) <= 40 and len(code.known.old[0]) <= 40 and (names[1:] > names[:-1]).all()
        assert len(names) == len(others) == len(at) == len(n) and n.sum() == len(flat)


def test_equal_first_hashes_are_told(plain):
    known = token_store.Known("<u2")
    fit = np.ones(2, bool)
    made = lambda ids: lambda missing: [np.array(ids[k], "<u2").tobytes() for k in missing]
    for others, ids in (([7, 8], [[1, 2], [3]]), ([9, 8], [[4], [5]]), ([9, 8], [[6], [6]])):
        flat, first, size = known.find(np.array([1, 2], np.uint64), np.array(others, np.uint64), made(ids), fit)
        found = [flat[a : a + n].tolist() for a, n in zip(first, size, strict=True)]
        assert found == ([[1, 2], [3]] if others[0] == 7 else [[4], [3]])


def test_memory_of_kept_parts():
    code = token_store.Encoder(PATH)
    given = [slice_of([words(seed * 100 + k, 1_000) for k in range(100)]) for seed in range(3)]
    code.ids(*given[0])  # what is made once
    tracemalloc.start()
    try:
        for each in given[1:]:
            code.ids(*each)
        held, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert held < 200_000 * 80  # of as many parts a dictionary holds over 140 bytes each


def test_many_texts_are_split_some_at_a_time(monkeypatch):
    texts = ["Don't stop, CAFÉ 12!", "", " ", "é東京 x", words(1, 50)] * 4
    data, offsets = slice_of(texts)
    whole = token_store.named(data, offsets)
    monkeypatch.setattr(token_store, "NAMED_BYTES", 30)
    for a, b in zip(whole, token_store.named(data, offsets), strict=True):
        assert a.tolist() == b.tolist()
