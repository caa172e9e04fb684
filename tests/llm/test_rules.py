"""The rules of packing, votes and likeness by brute force, shards, the packed files, and odd rows in the pipeline."""

import base64
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roundhaul.llm import hashing, merkle, packing, pieces, quality, token_output
from roundhaul.llm.queries import QUERIES


def squares(lengths, capacity):
    """Each piece where the squared counts of open sequences per gap become smallest; a new one only where nothing fits."""
    gaps, out = [], []
    for length in lengths:
        fits = sorted({g for g in gaps if length <= g < capacity})
        if not fits:
            gaps.append(capacity)
            choice = len(gaps) - 1
        else:

            def after(gap):
                counts = Counter(g for g in gaps if g)
                counts[gap] -= 1
                if gap - length:
                    counts[gap - length] += 1
                return sum(n * n for n in counts.values())

            best = min(fits, key=lambda g: (after(g), g))
            choice = max(i for i, g in enumerate(gaps) if g == best)
        gaps[choice] -= length
        out.append(gaps[choice])
    return out, len(gaps)


def best(lengths, capacity):
    """Each piece where the least room is left."""
    gaps, out = [], []
    for length in lengths:
        fits = [i for i, g in enumerate(gaps) if g >= length]
        choice = min(fits, key=lambda i: gaps[i]) if fits else len(gaps)
        if not fits:
            gaps.append(capacity)
        gaps[choice] -= length
        out.append(gaps[choice])
    return out, len(gaps)


@pytest.mark.parametrize(("rule", "brute"), [(packing.sum_of_squares, squares), (token_output.best_fit, best)])
@pytest.mark.parametrize("seed", range(25))
def test_placement(rule, brute, seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(2, 40))
    lengths = np.sort(rng.integers(1, capacity + 1, rng.integers(0, 80)))[::-1]
    sequence, offset = rule(lengths, capacity)
    left, count = brute(lengths.tolist(), capacity)
    assert (capacity - offset - lengths).tolist() == left and len(set(sequence.tolist())) == count


def test_several_shards_and_equal_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(i, "some words " * (i % 50)) for i in range(300)] + [(7, "the same words again")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    shards = pieces.shard_count(docs, 8000)
    found = packing.pack_documents(docs, path, capacity=64, shard_bytes=8000).collect()
    assert len({r["sequence_id"] >> 32 for r in found}) == shards > 10
    held = Counter(r["sequence_id"] >> 32 for r in found if r["doc_id"] == 7 and r["length"] == 5)
    assert sum(held.values()) == 2000 and max(held.values()) < 4 * 2000 / shards + 20
    places = {}
    for r in found:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        spans.sort()
        assert [a for a, _ in spans] == np.cumsum([0, *[n for _, n in spans[:-1]]]).tolist() and sum(spans[-1]) <= 64


def test_packed_files(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.createDataFrame([(i, "word " * (7 * i)) for i in range(40)] + [(99, None)], "doc_id long, text string")
    made = token_output.packed_matrices(docs, path, capacity=32)
    token_output.write_packed(made, f"{folder}/packed")
    back = spark.read.parquet(f"{folder}/packed").collect()
    assert sorted(map(str, back)) == sorted(map(str, made.collect()))
    ids = {}
    for r in back:
        row, positions = (np.frombuffer(r[name], "<u2") for name in ("input_ids", "position_ids"))
        spans = list(zip(r["cu_seqlens"][:-1], r["cu_seqlens"][1:], strict=True))
        for (a, b), doc, start in zip(spans, r["doc_ids"], r["starts"], strict=True):
            ids.setdefault(doc, {})[start] = row[a:b].tolist()
            assert positions[a:b].tolist() == list(range(b - a))
    library = pieces.ENCODERS["byte"](path).library
    for doc, text in [(r["doc_id"], r["text"] or "") for r in docs.collect()]:
        held = [i for _, part in sorted(ids[doc].items()) for i in part]
        assert held == [*library.encode_ordinary(text), token_output.END_ID]


def test_ids_that_do_not_fit(spark, folder):
    with open(f"{folder}/large.tiktoken", "wb") as file:
        for rank in range(256):
            file.write(base64.b64encode(bytes([rank])) + b" %d\n" % rank)
        file.write(base64.b64encode(b"ab") + b" 65536\n")
    docs = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    with pytest.raises(Exception, match="does not fit"):
        token_output.packed_matrices(docs, f"{folder}/large.tiktoken").collect()
    assert pieces.token_pieces(docs, f"{folder}/large.tiktoken", "byte", 8, 0, "<u4").first()["ids"][:4] == b"\0\0\1\0"


def test_votes(spark, sf_dir):
    """Scores of all documents from every cosine, one pair at a time in double precision."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    model = quality.fit(docs, labels)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    known = model.vectors.astype(float)
    for row in QUERIES["op7_quality_votes"](spark, sf_dir).collect()[::7]:
        point = quality.features([texts[row["doc_id"]]])[0].astype(float) @ model.space.astype(float)
        cosines = known @ (point / max(np.linalg.norm(point), 1e-12))
        near = sorted(range(len(cosines)), key=lambda i: -cosines[i])[: quality.NEIGHBOURS]
        votes = [(max(cosines[i], 1e-3) ** quality.SHARPNESS, model.labels[i]) for i in near]
        assert row["score"] == pytest.approx(sum(w * v for w, v in votes) / sum(w for w, _ in votes), abs=2e-3)


def test_fit_takes_one_text_of_an_id(spark):
    rows = [(i % 40, f"text {i} " * (1 + i % 3)) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    one = quality.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), labels)
    two = quality.fit(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(3), labels)
    assert np.array_equal(one.vectors, two.vectors) and np.array_equal(one.labels, two.labels)


def spans(text):
    """The spans of words of each line, by the rule: cut after a word whose hash says so, or each word of a short line."""
    out = []
    for line in re.findall(rb"[^\n]*\n|[^\n]+", text.encode()):
        words, place = [], 0
        blanks = b" \t\x0b\x0c\r\n"
        while place < len(line):
            if line[place] in blanks:
                place += 1
                continue
            end = place
            while end < len(line) and line[end] not in blanks:
                end += 1
            while end < len(line) and line[end] in blanks:
                end += 1
            words.append(line[place:end])
            place = end
        held = b""
        for k, word in enumerate(words):
            # A word lasts to the next one of the line, the last one to the line's end mark.
            data = np.frombuffer(word, np.uint8)
            value = hashing.range_hashes(data, np.array([0]), np.array([len(word)]))[0]
            held += word
            if value % np.uint64(merkle.SPAN_WORDS) == 0 or len(words) < merkle.SHORT_PARAGRAPH or k == len(words) - 1:
                out.append(held)
                held = b""
    return Counter(out)


def test_likeness(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    order = sorted(docs, reverse=True)
    after = dict(zip(order, [*order[1:], order[0]], strict=True))
    for row in QUERIES["op9_merkle_fingerprints"](spark, sf_dir).collect()[::5]:
        text, other = docs[row["doc_id"]], docs[after[row["doc_id"]]]
        for found, second in (("near_edited", merkle.edited_text(text, other)), ("near_next", other)):
            one, two = spans(text), spans(second)
            larger = max(one.total(), two.total())
            expected = 1.0 if text == second else (one & two).total() / larger if larger else 0.0
            assert row[found] == pytest.approx(expected, abs=1e-6)


def test_followers_of_ids_that_repeat_and_few_ranges(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SLOTS_PER_PARTITION", 2)
    rows = [(i // 3, f"text {i}") for i in range(999)]
    found = merkle.followed(spark.createDataFrame(rows, "doc_id long, text string"), slot_rows=5).collect()
    order = sorted(rows, key=lambda r: (-r[0], r[1]))
    expected = [(*r, n[1]) for r, n in zip(order, [*order[1:], order[0]], strict=True)]
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_pipeline_with_odd_rows(spark, folder, sf_dir):
    """NULLs, an empty and a very long text, repeated rows, a name that the stages use themselves; and no rows at all."""
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = given.where("n_chars BETWEEN 200 AND 900").limit(60)
    extra = [(None, "no id " * 50, None, None, None), (-1, None, "en", "src0", None), (-2, "", None, "src0", 0), (-3, "one long text " * 30_000, "en", None, 7)]
    rows = good.unionByName(spark.createDataFrame(extra, given.schema)).unionByName(good.limit(3))
    rows = rows.withColumns({"slot": F.lit("x"), "kept": F.lit(1), "sequence_id": F.lit("y")})
    for name, docs in (("odd", rows), ("none", rows.where("false"))):
        docs.write.parquet(f"{folder}/{name}/documents.parquet")
        spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{folder}/{name}/labels.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            held = spark.read.parquet(f"{folder}/{name}/documents.parquet")
            assert stage(spark, held, f"{folder}/{name}").columns == rows.columns
        found = corpus_pipeline.run(spark, f"{folder}/{name}").collect()
        assert bool(found) == (name == "odd")
        ids = {r["doc_id"] for r in found}
        assert ids <= {r["doc_id"] for r in rows.select("doc_id").collect()}
