"""Repetitive strings that any polynomial hash modulo a power of two confuses: a Thue-Morse word and its complement."""
from __future__ import annotations

import numpy as np
import pytest

from llm import kernels, passages, pieces, shingle_join, suffix_dedup


def thue_morse(n: int, a: str, b: str) -> str:
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


@pytest.mark.parametrize("n", [512, 1024, 4096])
@pytest.mark.parametrize("signs", ["ab", "+M", "yz"])
def test_complements_hash_apart(n, signs):
    data = np.frombuffer((thue_morse(n, *signs) + thue_morse(n, *signs[::-1])).encode(), np.uint8)
    one, two = kernels.RollingHash(data).slices(np.array([0, n]), np.array([n, 2 * n]))
    assert one != two


def test_slices_and_grams_follow_content():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 70_000).astype(np.uint8)  # more than one stride of the kernel
    rolling = kernels.RollingHash(data)
    start = rng.integers(0, len(data) - 12, 20_000)
    end = start + rng.integers(0, 12, len(start))
    seen = {}
    for s, e, h in zip(start.tolist(), end.tolist(), rolling.slices(start, end).tolist()):
        assert seen.setdefault(data[s:e].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)
    grams = {}
    for i, h in enumerate(rolling.grams(9).tolist()):
        assert grams.setdefault(data[i:i + 9].tobytes(), h) == h
    assert len(set(grams.values())) == len(grams)
    assert not len(kernels.RollingHash(data[:3]).grams(4))


@pytest.fixture(params=[(1024, "ab"), (512, "+M"), (4096, "ab")])
def words(request):
    n, signs = request.param
    return thue_morse(n, *signs), thue_morse(n, *signs[::-1])


def test_jaccard_keeps_complements_apart(spark, words):
    rest = " ".join(f"w{i}" for i in range(6)), " ".join(f"v{i}" for i in range(6))
    rows = [(1, words[0]), (2, words[1]), (3, f"{rest[0]} {words[0]} {rest[1]}"), (4, f"{rest[0]} {words[1]} {rest[1]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["key"]: r["component_id"] for r in shingle_join.near_duplicate_groups(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4}


def test_pieces_stay_lossless(spark, words):
    import public_tokenizers
    docs = spark.createDataFrame([(i, w) for i, w in enumerate([*words, *words])], "doc_id long, text string")
    got = pieces.encoded_documents(docs.coalesce(1), public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert all(r["lossless"] for r in got) and len(got) == 4


def test_units_of_equal_hash_are_told_apart(monkeypatch):
    """Byte comparison behind the hash: with a hash that is always equal, units still differ."""
    class Blind:
        def __init__(self, data):
            pass

        def slices(self, start, end):
            return np.zeros(len(start), dtype=np.uint64)
    monkeypatch.setattr(pieces, "RollingHash", Blind)
    data = np.frombuffer(b" ab cd ab x", np.uint8)
    start = np.array([0, 3, 6, 9])
    sample, of = pieces._distinct(data, start, np.diff(np.append(start, len(data))))
    texts = [data[s:s + n].tobytes() for s, n in zip(start[sample][of], (3, 3, 3, 2))]
    assert texts == [b" ab", b" cd", b" ab", b" x"]


def test_passages_keep_windows_apart(spark, words):
    def text(word):
        return " ".join([*(f"w{i}" for i in range(6)), word, *(f"v{i}" for i in range(6))])
    docs = spark.createDataFrame([(1, text(words[0])), (2, text(words[1]))], "doc_id long, text string")
    assert all(r["n_removed"] == 0 for r in passages.passage_report(docs).collect())


def test_repeated_bytes_of_complements(spark, words):
    rows = [(1, words[0]), (2, words[1])]
    want = suffix_brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.dedup_report(docs).collect()}
    assert got == want


def suffix_brute(rows, length=200):
    seen, out = {}, {}
    for k, text in rows:
        for i in range(len(text) - length + 1):
            seen.setdefault(text[i:i + length], []).append((k, i))
    for k, text in rows:
        gone = set()
        for places in seen.values():
            if len(places) > 1:
                for d, i in places:
                    if d == k:
                        gone.update(range(i, i + length))
        out[k] = len(gone)
    return out
