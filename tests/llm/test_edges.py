"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roundhaul.llm import (
    chat,
    embedding_dedup,
    html_text,
    merkle,
    minhash,
    packing,
    pieces,
    quality,
    secrets,
    sentencepieces,
    token_output,
)
from roundhaul.llm.common import Scratch
from roundhaul.llm.components import components

LONG = "lorem ipsum dolor " * 20_000
DOCS = "doc_id long, text string, slot string, extra int, ids string, sequence_id string, spans int, bucket int, n int"


def documents(spark, rows):
    """Rows of (doc_id, text) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "s", 1, "x", "y", 2, 3, 4) for i, t in rows], DOCS)


ODD = [(1, None), (2, ""), (3, "one"), (4, LONG), (5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, " \n\t ")]


def rows_of(frame):
    return frame.toArrow().to_pylist()


def test_sentencepieces(spark):
    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepieces.pieces(model).library
    texts = [t or "" for _, t in ODD]
    found = sorted(rows_of(sentencepieces.round_trip(documents(spark, ODD), model)), key=lambda r: str(r))
    expected = [(i, library.encode(t), library.decode(library.encode(t))) for (i, _), t in zip(ODD, texts, strict=True)]
    assert sorted(str(tuple(r.values())) for r in found) == sorted(str(e) for e in expected)
    named = sentencepieces.encode(documents(spark, ODD), model)
    assert named.columns == documents(spark, []).columns
    back = rows_of(named.select("doc_id", sentencepieces.decoded(spark, "ids", model).alias("text")))
    assert sorted(len(r["text"]) for r in back) == sorted(len(library.decode(library.encode(t))) for t in texts)
    assert rows_of(sentencepieces.round_trip(documents(spark, []), model)) == []


def test_packing(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    found = rows_of(packing.pack_documents(documents(spark, ODD), path, capacity=512))
    whole = pieces.bpe.word_bpe(path).library
    by_sequence = {}
    for row in found:
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in by_sequence.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [at for at, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 512
    total = sum(len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)
    assert sum(r["length"] for r in found) == total
    assert len(by_sequence) == -(-total // 512)
    four = sorted((r for r in found if r["doc_id"] == 4), key=lambda r: r["piece"])
    ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in four])
    assert ids.tolist() == [*whole.encode(LONG, add_special_tokens=False).ids, 0]
    assert [r["start"] for r in four] == [512 * i for i in range(len(four))]
    assert rows_of(packing.pack_documents(documents(spark, []), path)) == []


def test_token_output(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = rows_of(token_output.packed_matrices(documents(spark, ODD), path, capacity=512))
    texts = {}
    for row in found:
        ids, positions = np.frombuffer(row["input_ids"], "<u2"), np.frombuffer(row["position_ids"], "<u2")
        assert len(ids) == len(positions) == 512 and row["cu_seqlens"][-1] == row["n_tokens"]
        for doc, piece, a, b in zip(row["doc_ids"], row["pieces"], row["cu_seqlens"], row["cu_seqlens"][1:], strict=False):
            assert positions[a:b].tolist() == list(range(b - a))
            texts.setdefault(doc, []).append((piece, ids[a:b].tolist()))
    library = pieces.bpe.byte_bpe(path).library
    long = [i for _, part in sorted(texts[4]) for i in part]
    assert library.decode(long[:-1]) == LONG and long[-1] == token_output.END_ID
    assert len(texts[5]) == 2 and texts[1] == [(0, [token_output.END_ID])]
    assert rows_of(token_output.packed_matrices(documents(spark, []), path)) == []


def test_secrets(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    given = [*ODD, (8, "éé token: 'abcdef' AKIA" + "Z9" * 8), (9, "secret: token: abcdef"), (10, "x qX7zKv9bNm2RwPsLd4F y")]
    found = {r["doc_id"]: r["spans"] for r in rows_of(secrets.scan(documents(spark, given), path))}
    assert found[1] == found[2] == found[4] == []
    assert [(s["kind"], s["start"], s["end"]) for s in found[8]] == [("assign", 3, 17), ("access", 19, 39)]
    assert found[9] == []  # the first match takes the key word of the second and is dropped
    assert [(s["kind"], s["start"], s["end"]) for s in found[10]] == [("token", 2, 21)]
    clean = documents(spark, given).select("doc_id", secrets.redacted(spark, "text", path).alias("text"))
    texts = {r["doc_id"]: r["text"] for r in rows_of(clean)}
    assert texts[1] is None and texts[4] == LONG and texts[8] == "éé [secret]' [secret]"
    assert rows_of(secrets.scan(documents(spark, []), path)) == []


def test_random_runs_of_one_case(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    runs = ["qzxjkvbpwmfhgtrlqzxjkvbp", "XKQZJWVPLMTRBNHGDSFA", "qzxjkvbp-wmfhgtrl-xjkvbpwm", "xkqz-jwvp-lmtr-bnhg"]
    plain = [
        *("internationalization", "MAX_BUFFER_LENGTH", "getHttpResponseCode", "2024-01-10-12-30-00", "9" * 20),
        "123e4567-e89b-12d3-a456-426614174000",
        hashlib.sha256(b"").hexdigest().upper(),
    ]
    found = rows_of(secrets.scan(documents(spark, list(enumerate(f"a {run} b" for run in runs + plain))), path))
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in found}
    assert [spans[i] for i in range(len(runs))] == [[("token", 2, 2 + len(run))] for run in runs]
    assert not any(spans[i] for i in range(len(runs), len(runs + plain)))


def test_every_run_is_counted(sf_dir):
    """Token spans against every run of key characters, by plain string work."""
    vocabulary = pieces.bpe.byte_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = [t or "" for t in pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"])["text"].to_pylist()]
    rng = np.random.default_rng(7)
    letters = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklm-nopqrstuvwxyz"]
    texts += ["; ".join("".join(rng.choice(list(a), n)) for n in range(12, 60)) for a in letters]
    keys, total = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"), 0
    for text in texts:
        known, wanted = secrets.pattern_spans(text), []
        edges = [-1, *(i for i, c in enumerate(text) if c not in keys), len(text)]
        for start, end in ((a + 1, b) for a, b in zip(edges, edges[1:], strict=False) if b - a > 16):
            run = text[start:end]
            digest = len(run) in (32, 40, 56, 64, 96, 128) and (set(run) <= set("0123456789abcdef") or set(run) <= set("0123456789ABCDEF"))
            uuid = [len(p) for p in run.split("-")] == [8, 4, 4, 4, 12] and set(run.lower()) <= set("0123456789abcdef-")
            if digest or uuid or not any(c.isalpha() for c in run) and run[0].isdigit():
                continue
            if len(run) < 2 * len(vocabulary.library.encode_ordinary(run)) and not any(a < end and start < b for a, _, b in known):
                wanted.append((start, 3, end))
        assert [s for s in secrets.spans_of(text, vocabulary) if s[1] == 3] == wanted
        total += len(wanted)
    assert total > 100


def test_quality(spark):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(40)] + [(1, None, 1)], "doc_id long, quality int, text string")
    docs = documents(spark, [(i, "good plain words here " * 9 if i % 2 else "### !! $$$ " * 30) for i in range(40)] + ODD)
    model = quality.fit(docs, labels)
    scores = rows_of(docs.select("text", quality.score(spark, "text", model).alias("score")))
    assert all(0 <= r["score"] <= 1 for r in scores)
    assert all((r["score"] > 0.5) == r["text"].startswith("good") for r in scores if r["text"] and r["text"][:1] in "g#")
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() >= 20
    nothing = quality.fit(docs, labels.where("false"))
    assert {r["score"] for r in rows_of(docs.select(quality.score(spark, "text", nothing).alias("score")))} == {0.5}
    assert quality.accepted(docs.where("false"), labels).count() == 0


def test_pairs_at_the_threshold_share_a_table():
    """Of pairs with 72 of 90 shingles in common, about 4 in 100,000 have no key in common."""
    rng = np.random.default_rng(11)
    missed = 0
    for _ in range(10):
        pairs = rng.integers(0, 1 << 63, (3000, 90), dtype=np.uint64)
        both = [pairs[:, :81], pairs[:, 9:]]  # 72 in both, 90 in all
        keys = [minhash.half_keys(side.ravel(), np.arange(3001) * 81, minhash.HALVES, minhash.BAND) for side in both]
        same = (keys[0] == keys[1]).reshape(3000, 2, minhash.HALVES)
        missed += int((~same.any(axis=2).all(axis=1)).sum())
    assert missed <= 5  # of 30,000


def test_html(spark):
    page = "<nav>m</nav><article><h1>T</h1><p>a &amp; b<br>c<p>d</article><aside>x</aside><script>1<2</script>"
    given = [(1, "http://h/1", page), (1, "http://h/1", page), (2, None, None), (None, "u", ""), (3, "http://h/3", "<p>" + LONG)]
    frame = spark.createDataFrame([(*r, 1, "k") for r in given], "page_id long, url string, html string, n int, bucket string")
    found = rows_of(html_text.extract(frame))
    assert sorted((r["page_id"] or 0, r["text"]) for r in found) == sorted(
        [(1, "T\na & b c\nd"), (1, "T\na & b c\nd"), (2, ""), (0, ""), (3, LONG.strip())]
    )
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert rows_of(html_text.extract(frame.where("false"))) == []


def page_texts(spark, pages, **settings):
    """The main text by page_id of (page_id, host, html)."""
    given = [(i, f"http://{host}/{i}", page) for i, host, page in pages]
    frame = spark.createDataFrame(given, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in rows_of(html_text.extract(frame, **settings))}


def words_of(label, n=20):
    return " ".join(f"{label}{i}" for i in range(n))


def test_host_repeats_decide_open_blocks(spark):
    told = words_of("told")
    pages = [
        (i, "h", f"<div>{told}</div><div>{words_of(f'body{i}x')}</div><article>card {i}</article><nav>{words_of(f'nav{i}')}</nav>")
        for i in range(3)
    ]
    pages += [(i, "h", f"<div>{told}</div><p>{words_of(f'plain{i}x')} {told}") for i in range(3, 6)]
    pages += [(6, "h", f"<main>{told}</main><div>{told}</div><div>{words_of('after')}</div>")]
    found = page_texts(spark, pages)
    assert [found[i] for i in range(3)] == [f"{words_of(f'body{i}x')}\ncard {i}" for i in range(3)]
    assert [found[i] for i in range(3, 6)] == [words_of(f"plain{i}x") for i in range(3, 6)]
    assert found[6] == f"{told}\n{words_of('after')}"


def test_repeats_do_not_depend_on_the_size_of_a_host(spark):
    rng = np.random.default_rng(5)
    shared = [words_of(f"shared{k}x", 15) for k in range(40)]  # each on two pages, or on a few
    pages = []
    for i in range(300):
        body = words_of(f"own{i}x")
        held = [shared[k] for k in range(40) if i in (2 * k, 2 * k + 101) or k > 30 and rng.random() < 0.02]
        told = f"<div>{' '.join(held)}</div>" if i % 3 else f"<nav>{' '.join(held)}</nav>"
        pages.append((i, "big" if i < 290 else "small", f"<div>{body}</div>{told}<p>{body} {words_of(f'end{i}x', 5)}</p>"))
    pages += [pages[7]]  # a repeated row is no second page
    whole = page_texts(spark, pages, bucket_pages=1000)
    assert page_texts(spark, pages, bucket_pages=10) == whole
    assert whole[7].startswith(f"{words_of('own7x')}\n") and not any("shared" in whole[i] for i in range(60))


def test_slugs_in_an_article_are_text():
    def kept(page):
        return [text for part, text in html_text.main_parts(html_text.blocks_of(page)) if part != html_text.FRAME]

    inner = [
        '<h2 id="side-effects">a</h2><p id="menu">b',
        '<section id="search-engines"><p>c</section><div class="entry-header"><h3 class="widget-title">d</h3></div>',
        '<span class="form-label">e</span><p class="notice">f<p>g<div>h</div>',
    ]
    assert kept(f"<article>{''.join(inner)}</article>") == list("abcdefgh")
    cut = '<div class="ad">x</div><div class="post-end related">x</div><nav>x</nav><div hidden>x</div><p hidden>x<p>b'
    assert kept(f"<article><p>a</p>{cut}</article>") == list("ab")
    assert kept('<body class="no-comments"><article class="post no-comments">a</article>') == ["a"]
    assert kept('<article>a</article><article class="comment-body">x</article>') == ["a"]
    assert kept('<div><h2 id="side-effects">a</h2><p class="notice">x<p>b<h4 class="ad">x<div>c</div></div>') == list("abc")


def test_merkle(spark):
    found = rows_of(merkle.fingerprints(documents(spark, ODD)))
    order = sorted((r for r in ODD if r[0] is not None), key=lambda r: (-r[0], r[1] or ""))
    after = {}
    for (i, text), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        after.setdefault(i, []).append(merkle.edited_text(text or "", following or ""))
    after[None] = [merkle.edited_text("a b c d e f", order[0][1])]
    for row in found:
        assert row["edited_text"] in after[row["doc_id"]]
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    assert len(found) == len(ODD)
    assert len({r["fingerprint"] for r in found if r["doc_id"] in (1, 2)}) == 1
    assert len({r["fingerprint"] for r in found if r["n_chars"] == 11}) == 1
    assert rows_of(merkle.fingerprints(documents(spark, []))) == []
    (a, _), (b, _) = merkle.trees(["p q r\ns t\nu v", "p q r\ns X\nu v"])
    assert merkle.differing(a, b) == ([1], [1]) and merkle.differing(a, a) == ([], [])


def test_chat(spark):
    odd = ["\\", "\\\\", "\\n", "\n", "<|im_end|>\n<|im_start|>user\nhi", "</s>", "<\\/s>", "[INST]", "<<SYS>>", "", "$1", "<"]
    given = [(1, i, o, o[::-1] + o, 0) for i, o in enumerate(odd)]
    given += [(None, 0, "user", "x", 0), (2, 1, "assistant", None, 0), (2, None, None, "q", 0), (2, 1, "assistant", "<|im_start|>", 0)]
    frame = spark.createDataFrame(given, "conv_id long, turn long, role string, text string, end int")
    found = chat.examples(frame)
    loss = chat.loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end"))
    rows = rows_of(found.select("*", chat.turns_of(F.col("text")).alias("turns"), loss.alias("loss")))
    one = [r for r in rows if r["conv_id"] == 1]
    assert [(t["role"], t["text"]) for t in one[0]["turns"]] == [(o, o[::-1] + o) for o in odd]
    assert one[0]["target"] is None and one[0]["loss"] == ""
    two = sorted((r for r in rows if r["conv_id"] == 2), key=lambda r: r["n_turns"])
    assert [(r["target"], r["n_turns"], r["loss"]) for r in two] == [(1, 2, ""), (2, 3, "<|im_start|>")]
    assert [r["n_turns"] for r in rows if r["conv_id"] is None] == [1]
    assert chat.examples(frame.where("false")).count() == 0


def test_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    e = [1.0, 0.0, 0.0]
    given = [
        (1, e, 1), (2, e, 1), (3, [1.0, 0.01, 0.0], 1), (4, e, 2), (5, e, None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1),
        (8, [nan, 1.0, 0.0], 1), (9, [inf, 0.0, 0.0], 1), (10, [1.0, None, 0.0], 1), (11, [], 1), (12, [2.0, 0.0], 1),
        (None, e, 1), (2, e, 1), (13, [1e-200, 0.0, 0.0], 1),
    ]
    frame = spark.createDataFrame([(*r, "b") for r in given], "vec_id long, embedding array<double>, label int, bucket string")
    found = rows_of(embedding_dedup.near_duplicates(frame, Scratch(spark, "test")))
    assert len(found) == len(given)
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found}
    assert by[1] == (3, 1, True) and by[2] == (3, 1, False) and by[3] == (3, 1, False) and by[13] == (3, 1, False)
    assert all(by[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12)) and by[None] == (0, None, True)
    assert rows_of(embedding_dedup.near_duplicates(frame.where("false"), Scratch(spark, "test"))) == []


def test_minhash(spark):
    base = [f"w{i}" for i in range(40)]
    given = [*ODD, (20, " ".join(base)), (21, " ".join([*base, "x"])), (22, " ".join(reversed(base))), (23, "ONE"), (0, "One\x1f")]
    found = rows_of(minhash.near_duplicates(documents(spark, given), Scratch(spark, "test")))
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found}
    assert by[1] == (0, 1, True) and by[7] == (0, 7, True) and by[None] == (2, None, True)
    assert by[3] == (1, 3, True) and by[23] == (1, 3, False) and by[0] == (1, 0, True)
    assert by[20] == (36, 20, True) and by[21] == (37, 20, False) and by[22] == (36, 22, True)
    assert by[4][0] == 3 and len(found) == len(given)
    kept = minhash.one_of_each(documents(spark, given), Scratch(spark, "test"))
    assert kept.columns == documents(spark, []).columns and kept.count() == len(given) - 2
    assert rows_of(minhash.near_duplicates(documents(spark, []), Scratch(spark, "test"))) == []


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 150)] + [(7, i) for i in range(200, 260)] + [(5, 5), (None, 3)]
    found = components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"))
    by = {r["node"]: r["component"] for r in rows_of(found)}
    assert all(by[i] == 100 for i in range(100, 151)) and all(by[i] == 7 for i in range(200, 260))
    assert 5 not in by and len(by) == 51 + 61


@pytest.mark.parametrize("size", [0, 1, 3000])
def test_block_links_find_every_pair(size):
    rng = np.random.default_rng(size)
    sets = [np.unique(rng.integers(0, 40, 30)) for _ in range(min(size, 60))]
    if not sets:
        return
    table = pa.table(
        {
            "id": pa.array(range(len(sets)), pa.int64()),
            "own": pa.array([0] * len(sets), pa.int32()),
            "component": pa.array(range(len(sets)), pa.int64()),
            "apart": pa.array([False] * len(sets)),
            "shingles": pa.array([s.tolist() for s in sets], pa.list_(pa.int64())),
        }
    )
    a, b = minhash.block_links(table, 60)
    least = list(range(len(sets)))
    for _ in sets:
        for i, one in enumerate(sets):
            for j, two in enumerate(sets):
                common = len(np.intersect1d(one, two))
                if 100 * common >= 60 * (len(one) + len(two) - common):
                    least[i] = min(least[i], least[j])
    reached = dict(zip(a.tolist(), b.tolist(), strict=True))
    assert [reached.get(i, i) for i in range(len(sets))] == least


def test_digest_of_nothing():
    assert merkle.trees([""])[0][0] == hashlib.blake2b(b"", digest_size=16).hexdigest() + "#"


def test_edited_paragraphs(spark):
    """The numbers name, once each, the lines that either text has more often."""
    rng = np.random.default_rng(3)
    lines = [f"line {k}" for k in range(30)] + [""] * 6
    texts = ["\n".join(rng.choice(lines, rng.integers(1, 60))) + "\n" for _ in range(80)]
    rows = {r["doc_id"]: r for r in rows_of(merkle.fingerprints(documents(spark, list(enumerate(texts)))))}
    for i, text in enumerate(texts):
        own, edited = text.splitlines(True), rows[i]["edited_text"].splitlines(True)
        for side, other, column in ((own, edited, "edited_out"), (edited, own, "edited_in")):
            numbers = [int(n) for n in rows[i][column].split(",") if n]
            assert numbers == sorted(set(numbers))
            assert Counter(side[n] for n in numbers) == Counter(side) - Counter(other)
    assert merkle.differing(rows[0]["fingerprint"], rows[0]["fingerprint"]) == ([], [])
