"""Rows that share an id and differ, and words and chunks made to collide: against SQL and the libraries."""

from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

from roundhaul.llm import bpe, embedding_dedup, merkle, minhash, sentencepieces
from roundhaul.llm.chunks import ChunkTable
from roundhaul.llm.common import Scratch
from roundhaul.llm.hashing import hash_words, range_hashes, words_of
from roundhaul.llm.oracles import ORACLES


def against_sql(frame, name, table):
    database = duckdb.connect()
    database.register(table, frame["given"].toArrow())
    expected = database.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    got = [tuple(r[c] for c in columns) for r in frame["found"].collect()]
    assert sorted(got, key=repr) == sorted(expected.fetchall(), key=repr)


def near(text, k):
    words = text.split()
    words[k] = f"other{k}"
    return " ".join(words)


def test_documents(spark):
    a, b, c = (" ".join(f"{p}{i}" for i in range(60)) for p in "abc")
    rows = [(5, a), (5, b), (7, near(b, 59)), (5, a), (3, c), (9, near(a, 0)), (2, near(near(b, 59), 58)), (None, a), (5, None), (11, "one two")]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(given, Scratch(spark, "test"), words=4)
    against_sql({"given": given, "found": found}, "op3_minhash_near_duplicates", "documents")
    by = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()}
    assert (7, 57, 2) in by and (5, 57, 2) in by and (5, 57, 5) in by and (9, 57, 5) in by
    kept = minhash.one_of_each(given, Scratch(spark, "test"), words=4).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["11", "2", "3", "5", "5", "5", "5", "None"]


def test_vectors(spark):
    e, f, g = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(5, e, 1), (5, f, 1), (6, [1.0, 0.01, 0.0], 1), (7, [0.01, 1.0, 0.0], 1), (5, e, 1), (2, g, 1), (3, g, 1), (5, g, 2), (None, g, 1)]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = embedding_dedup.near_duplicates(given, Scratch(spark, "test"))
    against_sql({"given": given, "found": found}, "op1_near_duplicate_vectors", "embeddings")
    assert {r["n_links"] for r in found.where("vec_id IN (5, 6, 7)").collect()} == {0, 1}


def complements(size):
    """A word in which neither letter ever comes three times in a row, of `size` letters, and its mirror image."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(size))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_cancel_out(spark):
    one, two = complements(1024)
    texts = [one, two, f"{one} {two}", f"{two} {one}"]
    sp = sentencepieces.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    word = bpe.word_bpe(public_tokenizers.path("word_bpe_49k.json"))
    byte = bpe.byte_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = {
        sp: sp.library.encode,
        word: lambda t: word.library.encode(t, add_special_tokens=False).ids,
        byte: byte.library.encode_ordinary,
    }
    for encoder, expected in known.items():
        ids, borders = encoder.encode(texts)
        for text, a, b in zip(texts, borders[:-1], borders[1:], strict=True):
            assert ids[a:b].tolist() == expected(text)
    values, borders = minhash.shingle_sets([one, two], 5)
    assert borders.tolist() == [0, 1, 2] and values[0] != values[1]
    trees = merkle.trees([one, two])
    assert trees[0][0] != trees[1][0] and merkle.likeness(*trees) == 0


@pytest.mark.parametrize("size", [0, 1, 7, 8, 9, 16, 31, 32, 33, 100])
def test_hashes_follow_the_bytes_alone(size):
    rng = np.random.default_rng(size)
    cells = [rng.integers(0, 256, size).astype(np.uint8).tobytes() for _ in range(50)]
    cells += [cells[0], cells[1] + b"\0", cells[1][:-1]]
    for shift in (b"", b"xyz"):
        data = np.frombuffer(shift + b"".join(cells), np.uint8)
        ends = len(shift) + np.cumsum([len(c) for c in cells])
        starts = ends - [len(c) for c in cells]
        hashes = range_hashes(data, starts, ends)
        if shift:
            assert (hashes == before).all()  # noqa: F821 - set in the first turn
        before = hashes  # noqa: F841
        assert len(set(hashes.tolist())) == len(set(cells))
        assert (range_hashes(data, starts, ends, 3) != hashes).all()
        words, borders = words_of(data, starts, ends)
        for i, cell in enumerate(cells):
            assert words[borders[i] : borders[i + 1]].tobytes()[: len(cell)] == cell


def test_chunks_that_share_a_hash_start_a_new_table(monkeypatch):
    table = ChunkTable(lambda chunks: [[int.from_bytes(c[:3], "big")] for c in chunks])
    real, calls = hash_words, []

    def colliding(*given):
        calls.append(given[-1])
        return real(*given) if len(calls) > 2 else np.zeros(len(given[3]), np.uint64)

    monkeypatch.setattr("roundhaul.llm.chunks.hash_words", colliding)
    data = np.frombuffer(b"abcdefabc", np.uint8)
    ids, borders = table.encode(data, np.array([0, 3, 6]), np.array([0, 3]))
    assert ids.tolist() == [0x616263, 0x646566, 0x616263] and borders.tolist() == [0, 3] and len(calls) == 3


def test_a_full_table_forgets_what_is_rare():
    asked = Counter()

    def segment(chunks):
        asked.update(chunks)
        return [[c[0]] * (c[0] % 3) for c in chunks]

    table = ChunkTable(segment, capacity=8)
    rng = np.random.default_rng(1)
    for _ in range(200):
        text = bytes(rng.choice([97, 98, 99, *range(100, 120)], rng.integers(1, 30), p=[0.2] * 3 + [0.02] * 20).tolist())
        ids, borders = table.encode(np.frombuffer(text, np.uint8), np.arange(len(text)), np.array([0, len(text)]))
        assert ids.tolist() == [c for c in text for _ in range(c % 3)] and borders.tolist() == [0, len(ids)]
        assert len(table.keys) <= 8 + len(set(text))
    assert asked[b"a"] < 5 < asked[b"m"]
