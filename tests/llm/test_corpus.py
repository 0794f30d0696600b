"""Near-duplicates, scores, packing, token files and the pipeline against brute force and exact round trips."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from docmill.llm import components, lm_score, packing, quality_fm, secrets, simhash, token_codec
from docmill.llm.kernels import NOT_SPACE, slices, word_hash
from docmill.llm.queries import QUERIES
from docmill.llm.subwords import Encoder, default_vocabulary

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "a", "a b", "word " * 60, "ab cd " * 20_000, "Ünï cödé 日本語 " * 30, "a", "<|endoftext|> x   y \n z"]


def plain_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, min(len(words), 1)))]
    bits = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in bits) > len(bits))


def joined(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_fingerprints_and_groups_match_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    want = [plain_print(r.text) for r in rows]
    got = {r.doc_id: r for r in QUERIES["op6_simhash_near_dedup"](spark, SF).collect()}
    assert [got[r.doc_id].fingerprint for r in rows] == [f"{w:016x}" for w in want]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (want[i] ^ want[j]).bit_count() <= 3]
    assert [got[r.doc_id].component_id for r in rows] == [rows[c].doc_id for c in joined(len(rows), links)]


def test_balls_find_every_link(spark):
    """Chains of fingerprints up to five bits apart, many with all flips inside one block."""
    rng = np.random.default_rng(1)
    prints = []
    for start in rng.integers(0, 2**63, 60, dtype=np.uint64):
        x = int(start)
        for _ in range(6):
            prints.append(x)
            for k in rng.choice(64 if rng.random() < 0.5 else 16, rng.integers(1, 6), replace=False):
                x ^= 1 << int(k)
    prints = np.unique(np.array(prints, np.uint64))
    rows = [(i, int(p)) for i, p in enumerate(prints.view(np.int64))]
    got = {r.low: r.component_id for r in simhash.fingerprint_classes(spark.createDataFrame(rows, "doc_id long, bits long")).collect()}
    links = [(i, j) for i in range(len(prints)) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= 3]
    assert [got[i] for i in range(len(prints))] == joined(len(prints), links)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {k: 100 for k in range(101, 140)}
    u, v = components.stars(np.array([5, 4, 9]), np.array([4, 3, 8]))
    assert sorted(zip(u.tolist(), v.tolist(), strict=True)) == [(4, 3), (5, 3), (9, 8)]


def test_near_dedup_edge_cases(spark, frame):
    docs = frame(ODD, [None, *range(1, len(ODD))])
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(ODD)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    kept = simhash.one_of_each(docs.unionByName(docs))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in rows})
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.one_of_each(docs.limit(0)).count() == 0


def ids_of(text, end):
    t = Encoder.of(default_vocabulary()).tokenizer
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_encoder_equals_the_tokenizer():
    rng, encode = random.Random(3), Encoder.of(default_vocabulary())
    texts = ["".join(rng.choice([*" \n\t.,'sta1é 日_-\x1c", *" " * 6]) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    for t in [*(x or "" for x in ODD), *texts, "it's don't 'tis a''s b'. ǅ ª b́. ٣٤ abc٣"]:
        assert np.append(encode(t), np.uint32(7)).tolist() == ids_of(t, 7).tolist()


def test_packing_keeps_every_id_once(spark, frame):
    texts = [*ODD, *(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect())]
    rows = packing.pack(frame(texts).repartition(3)).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert len(by_doc) == len(texts)
    for d, pieces in by_doc.items():
        ids, at = ids_of(texts[d], 0), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        total += at
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding < 0.01 * total
    assert packing.pack(frame([])).count() == 0


@pytest.mark.parametrize("n", [*range(1, 40), 511, 512, 513, 700, 1000, 1023, 1024, 1025, 5000])
def test_cuts_are_whole(n):
    assert sum(packing.cuts(n)) == n and max(packing.cuts(n)) <= 1024


def test_codec_round_trip_and_independence():
    rng = np.random.default_rng(0)
    blocks = [np.minimum(rng.zipf(1.3, n), 65535).astype("<u4") for n in (4096, 4000, 7, 1, 300)] + [np.tile(np.array([5, 900, 65535, 0], "<u4"), 500), rng.integers(0, 65536, 2000).astype("<u4")]
    codes = token_codec.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, token_codec.decode_blocks(codes, [len(b) for b in blocks]), strict=True))
    for b, c in zip(blocks, codes, strict=True):  # alone as among others
        assert token_codec.encode_blocks([b]) == [c] and (token_codec.decode_blocks([c], [len(b)])[0] == b).all()
    assert len(codes[5]) < 0.2 * 2 * len(blocks[5])


def test_mixed_shares_tile_the_code_range():
    """After any ids the shares of all known numbers and of new ones lie one after another over the whole range, each is found by
    every place in it, and a number guessed by two orders has both their shares and its frequency's."""
    rng = np.random.default_rng(4)
    model, whole = token_codec.Model(3), token_codec.WHOLE
    numbers, news = zip(*(token_codec._numbered(rng.integers(0, k, 200)) for k in (6, 40, 150)), strict=True)
    for t in range(200):
        model.predict(3, t)
        lane = slice(0, 3)
        own, new = np.array([x[t] for x in numbers]), np.array([x[t] for x in news])
        escape = model.escape()
        edge, shares = np.zeros(3, np.int64), []
        for k in range(int(model.kinds.max())):
            start, end = model.interval(np.full(3, k), lane)
            known = k < model.kinds
            assert (start[known] == edge[known]).all() and (end > start)[known].all()
            edge = np.where(known, end, edge)
            shares.append((k, start, end, known))
        assert (edge == escape).all() and (escape < whole).all()
        for place in (np.zeros(3, np.int64), escape - 1, escape, np.full(3, whole - 1), rng.integers(0, whole, 3)):
            place = np.maximum(place, 0)
            got, fresh, start, end = model.find(place)
            assert ((start <= place) & (place < end)).all() and (fresh == (place >= escape)).all()
            for k, low, high, known in shares:
                mine = known & (got == k) & ~fresh
                assert (start[mine] == low[mine]).all() and (end[mine] == high[mine]).all()
        start, end = model.interval(own, lane)
        both = (model.guess2 == own) & (model.guess1 == own) & (model.level2 > 0) & (model.level1 > 0) & ~new
        assert (end - start > model.share2 + model.share1)[both].all()
        width = np.where(new, whole - escape, end - start)
        model.learn(own, new, width)
    assert both.any() or model.weight2.any()


def test_blocks_without_and_with_nothing_but_repeats():
    every = np.random.default_rng(1).permutation(65536)[:4096].astype("<u4")
    same = np.full(4096, 65535, "<u4")
    for lanes in ([every, same], [same], [every], []):
        codes = token_codec.encode_blocks(lanes)
        back = token_codec.decode_blocks(codes, [len(b) for b in lanes])
        assert all((a == b).all() for a, b in zip(lanes, back, strict=True)) and len(back) == len(lanes)
    assert len(token_codec.encode_blocks([same])[0]) < 200


def test_joined_checksums():
    ids = np.random.default_rng(2).integers(0, 60000, 9000).astype("<u4")
    cut = [0, 1, 1000, 5000, 9000]
    parts = [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    got = token_codec.joined_checksums([[zlib.crc32(p.tobytes()) for p in parts], [7]], [[len(p) for p in parts], [1]])
    assert got == [zlib.crc32(ids.tobytes()), 7]


def test_token_files_round_trip(spark, frame):
    texts = [*ODD, *(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect())]
    order = random.Random(1).sample(range(len(texts)), len(texts))
    rows = {r.doc_id: r for r in token_codec.round_trip(frame([texts[i] for i in order], order).repartition(3)).collect()}
    at = 0
    for i, text in enumerate(texts):
        ids = ids_of(text, 2)
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_codec.round_trip(frame([])).count() == 0


def test_word_hash_is_the_same_everywhere():
    import pyarrow as pa

    for part in slices(pa.array(["One two", None, "two  one\n"]), lower=True):
        part.words(NOT_SPACE)
        assert part.hash.tolist() == [word_hash(w) for w in (b"one", b"two", b"two", b"one")] and part.n_words.tolist() == [2, 0, 2]


def check_scores(rows, texts):
    words = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = Counter(w for i in texts if not held[i] for w in words[i])
    n, v = sum(count.values()), len(count)
    assert len(rows) == len(texts)
    for r in rows:
        own = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(count[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), rel=1e-9)
        assert np.isfinite(r.score) and r.score < 0


def test_scores_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_scores(QUERIES["op1_lm_scoring"](spark, SF).collect(), texts)


def test_scores_of_odd_texts(spark, frame):
    check_scores(lm_score.scores(frame(ODD)).collect(), dict(enumerate(ODD)))
    assert lm_score.scores(frame([])).count() == 0


def test_every_window_is_trained_on(spark):
    """Whatever a text's number in its block, and however few windows it has, a round's gradient sees each of its windows."""
    vocabulary = default_vocabulary()
    for n in range(1, 4):  # the last text alone is for training
        rows = [(i, i < n, "one text of a single window") for i in range(n + 1)]
        blocks = lm_score.build_blocks(spark.createDataFrame(rows, "doc_id long, held boolean, text string").coalesce(1), vocabulary)
        of, _, log_shares = lm_score.classes(lm_score.subword_counts(blocks, Encoder.of(vocabulary).size))
        assert not np.allclose(lm_score.train(blocks, of, log_shares), lm_score.first_weights(log_shares))
    lens = np.array([1, 30, 100, 700])
    first = np.concatenate([[0], np.cumsum(lens)])
    words = {"first": first.tobytes(), "tokens": bytes(4 * int(first[-1])), "sub_lens": np.uint32(1).tobytes(), "sub_ids": np.uint32(0).tobytes()}
    streams = lm_score.Streams(words, np.zeros(2, np.int64))
    seen = np.concatenate([streams.windows(lm_score.ROUNDS, r)[1] for r in range(lm_score.ROUNDS)])
    assert sorted(seen.tolist()) == sorted(streams.windows()[1].tolist())


def test_blocks_are_the_same_whatever_the_batches(spark):
    """Texts meet in blocks of a size across Arrow batches, so a batch may be as small as memory asks."""
    rows = [(i, i % 3 == 0, f"text {i} " * (i % 5)) for i in range(40)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, found = spark.conf.get(key), []
    for n in ("1", "7", "10000"):
        spark.conf.set(key, n)
        try:
            docs = spark.createDataFrame(rows, "doc_id long, held boolean, text string").coalesce(1)
            found.append(list(map(tuple, lm_score.build_blocks(docs, default_vocabulary()).collect())))
        finally:
            assert spark.conf.get(key) == n
            spark.conf.set(key, before)
    assert len(found[0]) == 1 and found[0] == found[1] == found[2]


@pytest.mark.parametrize("limit", [1, 10, 11, 50, 10_000])
def test_gathered_batches_are_the_slices_of_the_whole(limit):
    texts = ["a" * 5, None, "", "b" * 60, "c" * 5, "é" * 3, "d", None, "e" * 9, "f" * 51, ""]
    whole = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    for n in (1, 2, 3, 20):
        cut = [whole.slice(i, n) for i in range(0, len(texts), n)]
        got = [b.column("doc_id").to_pylist() for b in lm_score.gathered(iter([whole.slice(0, 0), *cut, whole.slice(0, 0)]), limit)]
        assert got == [list(range(p.lo, p.hi)) for p in slices(whole.column("text"), limit=limit)]
    assert not list(lm_score.gathered(iter([whole.slice(0, 0)]), limit))


def test_word_store_is_small_and_right():
    """Any number of words costs arrays of at most `kept` words, or those of one block; ids are those spelled."""
    rng = np.random.default_rng(12)
    all_words = np.unique(rng.integers(0, 2**64, 60_000, dtype=np.uint64))
    ids = {int(h): rng.integers(0, 50_000, int(h) % 5).astype("<u4").tobytes() for h in all_words}
    words = lm_score.Words(kept=20_000)
    for n in (10, 5000, 0, 9000, 9000, 15_000, 30_000, 100):
        asked = np.sort(rng.choice(all_words, n, replace=False))
        spelled = []
        got, size = words(asked, lambda i: spelled.append(i) or ids[int(asked[i])])  # noqa: B023
        assert got.tobytes() == b"".join(ids[int(h)] for h in asked) and got.dtype == size.dtype == np.uint32
        assert size.tolist() == [len(ids[int(h)]) // 4 for h in asked] and len(spelled) == len(set(spelled))
        assert len(words.hashes) <= max(20_000, n) and (np.diff(words.hashes) > 0).all()
        assert sum(x.nbytes for x in (words.hashes, words.start, words.size, words.ids)) <= 40 * max(20_000, n)
        words(asked, None)  # all are known by now


def test_ranges_of_words_are_bounded(spark, monkeypatch):
    """How many words a worker sums at a time follows the words, not the session's number of partitions."""
    monkeypatch.setattr(lm_score, "RANGE_WORDS", 100)
    texts = {i: " ".join(f"w{(i * 37 + j) % 400}" for j in range(150)) for i in range(12)}
    docs = spark.createDataFrame([(i, False, t) for i, t in texts.items()], "doc_id long, held boolean, text string").repartition(4)
    blocks = lm_score.build_blocks(docs, default_vocabulary())
    own = blocks.selectExpr("sum(length(hashes)) / 8").first()[0]
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        rows = lm_score.word_counts(blocks, int(own)).collect()
    finally:
        spark.conf.set(key, before)
    sums, count = Counter(), Counter(w for t in texts.values() for w in t.split())
    for r in rows:
        sums[r.part] += len(r.counts) // 4
    assert sum(sums.values()) == own and max(sums.values()) < 300 < own
    assert sum(r.kinds for r in rows) == len(count)
    got = {b: b"".join(r.counts for r in sorted(rows, key=lambda r: r.part) if r.block == b) for b in {r.block for r in rows}}
    hashes = {word_hash(w.encode()): n for w, n in count.items()}
    for b in blocks.collect():
        assert [hashes[h] for h in np.frombuffer(b.hashes, np.uint64).tolist()] == np.frombuffer(got[b.block], np.uint32).tolist()


def test_chances_sum_to_one_and_look_back_only():
    """Each id's class chances sum to one, and a later id changes nothing before it."""
    weights = lm_score._split(lm_score.first_weights(np.full(lm_score.CLASSES, -np.log(lm_score.CLASSES))).astype(np.float32))
    seen = np.random.default_rng(4).integers(0, lm_score.CLASSES, (3, lm_score.SPAN))
    h, _ = lm_score.attend(weights, seen)
    odds, raised, total = lm_score.chances(weights, h)
    assert np.allclose((raised / total[:, None]).sum(axis=1), 1, atol=1e-5)
    other = seen.copy()
    other[:, -1] = (other[:, -1] + 1) % lm_score.CLASSES
    again, _ = lm_score.attend(weights, other)
    shape = (3, lm_score.STRIDE, lm_score.DIM)
    assert np.allclose(h.reshape(shape)[:, :-1], again.reshape(shape)[:, :-1], atol=1e-5)


def test_scorer_is_the_model():
    weights = lm_score._split(lm_score.first_weights(np.full(lm_score.CLASSES, -np.log(lm_score.CLASSES))).astype(np.float32))
    seen = np.random.default_rng(8).integers(0, lm_score.CLASSES + 1, (5, lm_score.SPAN))
    for scale in (1, 60):  # the second leaves single precision's range
        w = {k: v * np.float32(scale) for k, v in weights.items()}
        odds, _, total = lm_score.chances(w, lm_score.attend(w, seen)[0])
        got, sums = lm_score.Scorer(w)(seen)
        assert np.allclose(got - np.log(sums)[:, None], odds - np.log(total)[:, None], rtol=1e-3, atol=1e-3)


def test_gradient_is_the_slope():
    rng = np.random.default_rng(6)
    flat = lm_score.first_weights(np.full(lm_score.CLASSES, -np.log(lm_score.CLASSES)))
    seen, target = rng.integers(0, lm_score.CLASSES, (4, lm_score.SPAN)), rng.integers(0, lm_score.CLASSES + 1, (4, lm_score.STRIDE))

    def loss(f):
        w = lm_score._split(f)
        odds, _, total = lm_score.chances(w, lm_score.attend(w, seen)[0])
        y = target.ravel()
        own = np.flatnonzero(y != lm_score.PAD)
        return float(np.mean(np.log(total[own]) - odds[own, y[own]]))

    g = lm_score.gradient(lm_score._split(flat), seen, target)
    for k in rng.choice(len(flat), 40, replace=False):
        step = np.zeros(len(flat))
        step[k] = 1e-4
        assert g[k] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-4, abs=2e-4)


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_fm.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = {r.doc_id: r for r in quality_fm.score(docs, model).collect() if r.quality_kept}
    prints = {i: plain_print(r.text) for i, r in rows.items()}
    order = sorted(rows)
    links = [(a, b) for a in range(len(order)) for b in range(a) if (prints[order[a]] ^ prints[order[b]]).bit_count() <= 3]
    alone = {order[c] for c in joined(len(order), links)}
    found = {r.doc_id: r.contaminated for r in QUERIES["op10_benchmark_decontamination"](spark, SF).collect()}
    clean = sorted(i for i in alone if not found[i])
    last = docs
    want = [sorted(rows), sorted(alone), clean, clean]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, last, SF).write.parquet(str(tmp_path / str(k)))
        last = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert last.columns == docs.columns and sorted(r.doc_id for r in last.collect()) == want[k]
        if k == 3:
            texts = {r.doc_id: r.text for r in last.collect()}
            assert all(not r.secret_spans for r in secrets.scan(last).collect() if "[secret]" in r.text)
    sizes = {}
    for r in last.collect():
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == {i: len(ids_of(t, 0)) for i, t in texts.items()}
    assert corpus_pipeline.run(spark, SF).count() == last.count()
