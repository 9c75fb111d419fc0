"""Brute-force versions, exact round trips and held-out accuracy of the training-data operators."""

import hashlib
import itertools
import os
import random
import re
import subprocess
import sys
import types
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import bpe, common, components, decontam, lm, media, minhash, quality, queries, spans, suffix, token_store, warc

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, start bigint, n bigint, row string, key string, score double"


def some(spark, texts, ids=None):
    """A documents table with extra columns whose names clash with the operators' own."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), 1, 2, "r", "k", 0.5) for i, t in zip(ids, texts, strict=True)], DOCS)


@pytest.fixture(scope="session")
def odd_texts():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", ".", ",", "\n"]) for _ in range(n))
    base = [prose(rng.choice([3, 20, 80, 200])) for _ in range(40)]
    near = []
    for t in base[:20]:
        parts = t.split(" ")
        for _ in range(3):
            changed = list(parts)
            changed[rng.randrange(len(changed))] = rng.choice(words)
            near.append(" ".join(changed))
    glued = [prose(15) + " " + base[k][20:400] + " " + prose(15) for k in range(20)]
    out = [None, "", " ", "   ", "a", "\n \n  x  \t y ", "aaaa " * 200, "ab" * 500, "x" * 3000, "<|endoftext|> don't I'll 12345 　   z", "日本語 テスト。" * 40, *base, *near, *glued, *base[:5], *[base[0]] * 10]
    rng.shuffle(out)
    return out


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# -- operator 1


def test_token_store_round_trip(spark, odd_texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = common.scratch(spark, "test-store")
    name = public_tokenizers.path("byte_bpe_50k.json")
    token_store.write_store(some(spark, odd_texts), path, name)
    tokenizer = Tokenizer.from_file(name)
    got, ids, start = rows_of(token_store.read_digests(spark, path)), rows_of(token_store.read_ids(spark, path)), 0
    assert len(got) == len(odd_texts)
    for i, text in enumerate(odd_texts):
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert list(ids[i].ids) == want
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() == chunks.select("digest").distinct().count()
    token_store.verify(spark, path)
    top = spark.read.parquet(f"{path}/manifest").where("segment = -1").first()
    assert (top.n_docs, top.n_tokens) == (len(odd_texts), start)


def test_op1_query_encodes_as_the_file_defines(spark, odd_texts, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = [*odd_texts, "a <|endoftext|> b", "x<|endoftext|>", "<|endoftext|><|endoftext|>", "a  <|endoftext|>  b", "<|endoftext|", "no token"]
    some(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got, start = rows_of(queries.op1_token_store(spark, str(tmp_path))), 0
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in enumerate(texts):
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)


def test_token_store_odd_tables(spark):
    import public_tokenizers

    name = public_tokenizers.path("byte_bpe_50k.json")
    path = common.scratch(spark, "test-store")
    token_store.write_store(some(spark, []), path, name)
    assert token_store.read_digests(spark, path).count() == 0
    path = common.scratch(spark, "test-store")
    token_store.write_store(some(spark, ["one", "one", None], [5, 5, None]), path, name)
    got = sorted((r.start, r.n_tokens, r.doc_id is None) for r in token_store.read_digests(spark, path).collect())
    assert got == [(0, 1, True), (1, 2, False), (3, 2, False)]


def test_token_store_detects_damage(spark):
    import public_tokenizers

    path = common.scratch(spark, "test-store")
    token_store.write_store(some(spark, ["some words here", "and others there"]), path, public_tokenizers.path("byte_bpe_50k.json"))
    chunks = spark.read.parquet(f"{path}/chunks").collect()
    other = common.scratch(spark, "test-store")
    spark.createDataFrame([(c.digest, bytes(c.ids[:-2]) + b"\1\0") for c in chunks], "digest binary, ids binary").write.parquet(f"{other}/chunks")
    spark.read.parquet(f"{path}/recipes").write.parquet(f"{other}/recipes")
    with pytest.raises(Exception, match="doesn't match its digest"):
        token_store.read_digests(spark, other).collect()
    recipes = spark.read.parquet(f"{path}/recipes")
    for n, bad in enumerate((recipes.withColumn("digests", F.reverse("digests")).where("size(digests) > 1").union(recipes.withColumn("root", F.unhex(F.lit("00")))), recipes.limit(1))):
        changed = common.scratch(spark, f"test-store-{n}")
        bad.write.parquet(f"{changed}/recipes")
        spark.read.parquet(f"{path}/manifest").write.parquet(f"{changed}/manifest")
        with pytest.raises(Exception, match="doesn't match"):
            token_store.verify(spark, changed)


def test_crc_moved():
    rng = np.random.default_rng(1)
    for a, b in [(0, 0), (3, 10), (100, 4096), (7, 1)]:
        left, right = rng.bytes(a), rng.bytes(b)
        moved = token_store.crc_moved(np.array([zlib.crc32(left)]), np.array([b]))[0]
        assert moved ^ zlib.crc32(right) == zlib.crc32(left + right)


def test_chunks_resist_shifts():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 50_000, 20_000).astype("<u2")
    one, two = ids, np.concatenate([ids[:5], np.array([1, 2, 3], "<u2"), ids[5:]])
    pieces = [{x[a:b].tobytes() for a, b in itertools.pairwise([0, *token_store.cuts(token_store.chunk_ends(x), len(x))])} for x in (one, two)]
    assert len(pieces[0] & pieces[1]) > 0.9 * len(pieces[0])


# -- operator 2


def test_warc(spark):
    html = [None, "", "short", "short", "ä" * 60, "long " * 50, "long " * 50, "long " * 50, "x" * 99, "x" * 99, "y" * 100, "y" * 100]
    pages = spark.createDataFrame([(10 + i, None if i == 3 else f"http://a/{i} \r\nb", h, "extra") for i, h in enumerate(html)], "page_id bigint, url string, html string, digest string")
    path = common.scratch(spark, "test-warc")
    warc.write_archives(pages, path)
    index = warc.read_index(spark, path)
    got, first = rows_of(warc.read_archives(index), "page_id"), {}
    for i, h in enumerate(html):
        raw = (h or "").encode()
        owner = first.setdefault(raw, 10 + i) if len(raw) >= 100 else 10 + i
        r = got[10 + i]
        assert r.digest == hashlib.sha256(raw).hexdigest()
        assert (r.record_type, r.refers_to) == (("response", None) if owner == 10 + i else ("revisit", owner))
        assert bytes(r.payload) == (raw if owner == 10 + i else b"")
        assert r.refers_to_record == (None if owner == 10 + i else got[owner].record_id)
    assert len({r.record_id for r in got.values()}) == len(html)
    swapped = index.withColumn("page_id", F.col("page_id") + 1)
    with pytest.raises(Exception, match="another page"):
        warc.read_archives(swapped).collect()
    assert warc.read_archives(index.where("page_id in (12, 17)")).count() == 2
    empty = common.scratch(spark, "test-warc")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(warc.read_index(spark, empty)).count() == 0
    odd = common.scratch(spark, "test-warc")
    same = spark.createDataFrame([(1, "u", "z" * 200), (1, "u", "z" * 200), (None, "u", "z" * 200), (2, "u", "z" * 200)], "page_id bigint, url string, html string")
    warc.write_archives(same, odd)
    kinds = Counter((r.page_id, r.record_type) for r in warc.read_index(spark, odd).collect())
    assert kinds == {(1, "response"): 2, (None, "response"): 1, (2, "revisit"): 1}
    read = warc.read_archives(warc.read_index(spark, odd)).collect()
    assert len({r.record_id for r in read}) == 4
    assert {(r.page_id, r.refers_to, r.refers_to_record) for r in read} == {(1, None, None), (None, None, None), (2, 1, None)}
    long = common.scratch(spark, "test-warc")
    text = "ab<é" * (1 << 20)
    warc.write_archives(spark.createDataFrame([("x\n: y", "u", text), ("b", "u", text)], "page_id string, url string, html string"), long)
    got = rows_of(warc.read_archives(warc.read_index(spark, long)), "page_id")
    assert bytes(got["b"].payload).decode() == text and got["x\n: y"].refers_to_record == got["b"].record_id and got["x\n: y"].refers_to == "b"


def test_warc_records_are_standard_gzip_members(spark, tmp_path):
    import gzip

    pages = spark.createDataFrame([(1, "http://a", "q" * 300), (2, "http://b", "w" * 10)], "page_id bigint, url string, html string").coalesce(1)
    warc.write_archives(pages, f"file://{tmp_path}/w")
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w/data").iterdir())
    assert whole.count(b"WARC/1.1\r\n") == 2 and b"q" * 300 in whole


def test_op2_query(spark, sf):
    got = rows_of(queries.op2_warc(spark, sf), "page_id")
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    first = {}
    for p in sorted(pages, key=lambda p: p.page_id):
        raw = (p.html or "").encode()
        owner = first.setdefault(raw, p.page_id) if len(raw) >= 100 else p.page_id
        r = got[p.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (r.record_type, r.refers_to) == (("response", None) if owner == p.page_id else ("revisit", owner))


def test_slices_are_encoded_alike():
    own = token_store.Encoder(queries._vocabulary("byte_bpe_50k.json"))
    texts = [f"text {i} " + "é word, " * i for i in range(40)]
    for spelt in (None, 17):
        some_texts = [t + "<|endoftext|> x" if i == spelt else t for i, t in enumerate(texts)] + [None, ""]
        got = own.encode(pa.array(some_texts).slice(9, 33))
        assert [x.tolist() for x in got] == [own.tokenizer.encode(t or "", add_special_tokens=False).ids for t in some_texts[9:]]


# -- operator 3


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_components(texts):
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return [root(x) for x in range(len(texts))], [len(s) for s in sets]


def test_near_duplicates(spark, odd_texts):
    got = rows_of(minhash.near_duplicates(some(spark, odd_texts)))
    want, sizes = brute_components(odd_texts)
    assert [(got[i].component_id, got[i].n_shingles, got[i].kept) for i in range(len(odd_texts))] == [(c, n, c == i) for i, (c, n) in enumerate(zip(want, sizes, strict=True))]


def test_near_duplicates_on_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want, _ = brute_components([d.text for d in docs])
    got = rows_of(queries.op3_minhash(spark, sf))
    assert [got[d.doc_id].component_id for d in docs] == [docs[c].doc_id for c in want]


def test_near_duplicates_large_group(spark):
    """Copies that differ from a common base, mostly not similar to the group's first document."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(150):
        own = list(base)
        for at in rng.sample(range(0, 200, 5), 5):
            own[at] = f"x{rng.random()}"
        texts.append(" ".join(own))
    texts += [" ".join(base), *texts[:30]]
    got = rows_of(minhash.near_duplicates(some(spark, texts)))
    assert [got[i].component_id for i in range(len(texts))] == brute_components(texts)[0]


def test_near_duplicates_odd_tables(spark):
    assert minhash.near_duplicates(some(spark, [])).count() == 0
    got = minhash.near_duplicates(some(spark, [None, "", "a b", "a  b", "a b"], [1, 2, 3, 3, None])).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(False, 1, 1, True), (False, 2, 2, True), (False, 3, 3, True), (False, 3, 3, True)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    kept = minhash.drop_near_duplicates(some(spark, ["q w e", "q w e", "z"], [4, 2, 9]))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 9] and kept.columns == some(spark, []).columns


def test_near_duplicates_in_a_cluster_of_several_components(spark):
    """Families that share half of their text: one cluster, many components, no link between them."""
    rng = random.Random(15)
    common_part = [f"c{i}" for i in range(120)]
    texts = []
    for family in range(40):
        own = common_part + [f"f{family}x{i}" for i in range(90)]
        for _ in range(rng.randint(1, 6)):
            text = list(own)
            text[rng.randrange(125, 205)] = f"y{rng.random()}"
            texts.append(" ".join(text))
    rng.shuffle(texts)
    got = rows_of(minhash.near_duplicates(some(spark, texts)))
    assert [got[i].component_id for i in range(len(texts))] == brute_components(texts)[0]


def test_near_duplicates_broadcast_counted_ids_alone(spark, odd_texts, monkeypatch):
    """Files of ids are small beside what they take in the driver, so their size is no reason to broadcast them."""
    plans, write, settings = [], common.write, (common.ESTIMATED, common.MEASURED)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "write", lambda df, *a, **b: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, *a, **b))
    before = [spark.conf.get(k, None) for k in settings]
    got = rows_of(minhash.near_duplicates(some(spark, odd_texts)))
    assert [got[i].component_id for i in range(len(odd_texts))] == brute_components(odd_texts)[0]
    assert sum("SortMergeJoin" in p for p in plans) > 5 and not [p for p in plans if "Broadcast" in p]
    assert [spark.conf.get(k, None) for k in settings] == before


def test_more_ids_than_may_be_broadcast_are_shuffled(spark, monkeypatch):
    ids = common.stored(spark.range(3).toDF("doc_id"), "ids")
    for most, kind in ((3, "Broadcast"), (2, "SortMerge")):
        monkeypatch.setattr(common, "BROADCAST_ROWS", most)
        found = some(spark, ["a", "b"], [1, 7]).join(common.small(ids), "doc_id", "left_semi")
        assert f"{kind}HashJoin" in (plan := found._jdf.queryExecution().executedPlan().toString()) or f"{kind}Join" in plan
        assert [r.doc_id for r in found.collect()] == [1]


def test_banding_and_sketches_find_similar_pairs():
    """Of 2,000 pairs at the threshold none is lost by bands or sketches."""
    rng = np.random.default_rng(17)
    for union in (20, 100, 400):
        sets = []
        for _ in range(2000):
            x = rng.integers(0, 2**64, union, np.uint64)
            part = union // 8
            sets += [np.sort(x[part:]), np.sort(x[: union - part])]
        values = minhash.signatures(sets)
        keys, sketches = minhash.band_keys(values), values.astype(np.uint8)
        assert (keys[::2] == keys[1::2]).any(axis=1).all()
        assert minhash._near(sketches[::2], sketches[1::2]).all()


def test_components(spark):
    rng = random.Random(8)
    for links in ([(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(rng.randrange(80), rng.randrange(80)) for _ in range(60)]):
        parent = {}

        def root(x, parent=parent):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for a, b in links:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        got = {r.node: r.component_id for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
        assert got == {x: root(x) for link in links if link[0] != link[1] for x in link}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# -- operator 4


def test_png_filters():
    rng = np.random.default_rng(4)
    pixels = rng.integers(0, 256, (40, 24), dtype=np.uint8)
    for kinds in ([0] * 40, [1] * 40, [2] * 40, [3] * 40, [4] * 40, rng.integers(0, 5, 40)):
        data = media.encode_png(pixels.tobytes(), 24, np.array(kinds, np.uint8))
        assert (media.decode_png(data)[0] == pixels).all()
    images = [rng.integers(0, 256, (h, w), dtype=np.uint8) for h, w in ((1, 24), (30, 24), (3, 7), (3000, 7), (2, 24))]
    stored = [media.encode_png(x.tobytes(), x.shape[1], np.array(rng.integers(0, 5, len(x)), np.uint8)) for x in images]
    assert all((a == b).all() for a, b in zip(images, media.decode_png(*stored), strict=True))
    slope = np.add.outer(np.arange(2500) * 3, np.arange(40) * 5).astype(np.uint8)  # over more than a band
    rows = media.filtered(slope)
    for r in (0, 1, 2047, 2048, 2499):
        rests = [media.filtered(slope, np.full(len(slope), k))[r, 1:] for k in range(5)]
        costs = [int(np.minimum(x.astype(int), 256 - x.astype(int)).sum()) for x in rests]
        assert rows[r, 0] == costs.index(min(costs)) and (rows[r, 1:] == rests[rows[r, 0]]).all()
    assert set(rows[:, 0]) - {0} and (media.decode_png(media.encode_png(slope.tobytes(), 40))[0] == slope).all()
    damaged = bytearray(data)
    damaged[60] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        media.decode_png(bytes(damaged))
    with pytest.raises(ValueError):
        media.decode_png(data[:-12])


def test_media(spark, odd_texts):
    path = common.scratch(spark, "test-media")
    media.write_media(some(spark, odd_texts), path)
    stored, got = rows_of(spark.read.parquet(path)), rows_of(media.features(spark.read.parquet(path)))
    features = {}
    for i, text in enumerate(odd_texts):
        raw = (text or "").encode()
        full = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        r, own = got[i], bytes(stored[i].media)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(own), hashlib.sha256(own).hexdigest())
        assert features.setdefault(raw, r.feature) == r.feature and len(r.feature) == 16
    assert {k for r in stored.values() for k in media.inflated(bytes(r.media))[:, 0].tolist()} - {0}  # filters are used
    empty = common.scratch(spark, "test-media")
    media.write_media(some(spark, []), empty)
    assert media.features(spark.read.parquet(empty)).count() == 0


def test_cosine_hash_is_robust():
    rng = np.random.default_rng(6)
    smooth = np.kron(rng.integers(0, 256, (8, 8)), np.ones((6, 72)))  # energy in all low frequencies
    one = np.frombuffer(media.cosine_hash(smooth), np.uint8)
    two = np.frombuffer(media.cosine_hash(smooth + rng.normal(0, 3, smooth.shape)), np.uint8)
    assert np.unpackbits(one ^ two).sum() <= 16


# -- operator 5


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = rows_of(queries.op5_quality(spark, sf))
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(got[r.doc_id].held_out for r in held) and sum(r.held_out for r in got.values()) < len(got) / 2
    right = sum(got[r.doc_id].predicted == r.quality for r in held) / len(held)
    assert right > 0.95 and all(0 <= r.score <= 1 for r in got.values())


def test_quality_uses_no_held_out_label(spark, tmp_path):
    """Turning the held-out labels around changes no score."""
    sf = "/root/testdata/sf0.001"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for name, turned in (("a", labels), ("b", labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")).cast("int")))):
        spark.read.parquet(f"{sf}/documents.parquet").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        turned.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    one, two = (rows_of(queries.op5_quality(spark, f"{tmp_path}/{n}")) for n in "ab")
    assert {k: r.score for k, r in one.items()} == {k: r.score for k, r in two.items()}


def test_quality_scores_are_exact_votes():
    rng = np.random.default_rng(9)
    sample, labels = rng.random((80, quality.WIDTH)).astype(np.float32), (rng.random(80) > 0.4).astype(int)
    model = quality.Model(np.ones(quality.WIDTH, np.float32), sample, labels, {0: 0.4, 1: 0.6})
    tests = rng.random((30, quality.WIDTH)).astype(np.float32)
    latent = model.latent(tests)
    for row, got in zip(latent, model.scores(tests, block=7), strict=True):
        cosine = model.points @ row
        near = np.argsort(-cosine)[: quality.NEIGHBOURS]
        vote = np.maximum(cosine[near], 1e-6) ** 4 * model.weight[near]
        assert got == pytest.approx((vote * model.labels[near]).sum() / vote.sum(), abs=1e-4)


def test_scores_do_not_depend_on_the_block():
    rng = np.random.default_rng(5)
    sample = (rng.random((700, 300)) ** 4).astype(np.float32)
    model = quality.Model(np.ones(300, np.float32), sample, (np.arange(700) % 3 == 0).astype(np.int64), {0: 0.6, 1: 0.4})
    dense = (rng.random((1300, 300)) ** 4).astype(np.float32)
    whole = model.scores(dense)
    assert (model.scores(dense[::-1])[::-1] == whole).all()
    for k in (0, 7, 511, 512, 1299):
        assert (model.scores(dense[k : k + 1]) == whole[k]).all() and (model.scores(dense[k : k + 40])[0] == whole[k]).all()


_PLACES = """
import numpy as np
from tallyspark.llm import quality

rng = np.random.default_rng(5)
sample = (rng.random((700, 300)) ** 4).astype(np.float32)
model = quality.Model(np.ones(300, np.float32), sample, np.arange(700) % 3 % 2, {0: 0.6, 1: 0.4})
dense = (rng.random((1300, 300)) ** 4).astype(np.float32)
print(sum(int((model.latent(dense[k:])[::-1] != model.latent(dense[::-1])[: 1300 - k]).sum()) for k in (0, 1, 7)), int((model.scores(dense[::-1])[::-1] != model.scores(dense)).sum()))
"""


@pytest.mark.parametrize("kernels", ["Haswell", "Zen", "SkylakeX"])
def test_scores_do_not_depend_on_the_kernels(kernels):
    """BLAS sums a row's products in an order that depends on the row's place, with some machines' kernels."""
    env = os.environ | {"OPENBLAS_CORETYPE": kernels, "PYTHONPATH": str(Path(quality.__file__).parents[2])}
    assert subprocess.run([sys.executable, "-c", _PLACES], env=env, capture_output=True, check=True, text=True).stdout.split() == ["0", "0"]


def test_words_of_any_length_tell_texts_apart():
    one, two = quality.vectors(pa.array(["magnificent laboratory discovery published yesterday", "abominable gibberish advertising clickbait worthless"]))
    assert (one[: quality.SHAPES] == two[: quality.SHAPES]).all() and (one != two).any()
    one, two = quality.vectors(pa.array(["x" * 300 + "a", "x" * 300 + "b"]))
    assert (one != two).any()


def test_quality_odd_tables(spark, odd_texts):
    docs, none = some(spark, odd_texts), spark.createDataFrame([], "doc_id bigint, label int")
    vectors = quality.vectorize(docs)
    assert {r.score for r in quality.score(vectors, quality.fit(vectors, none)).collect()} == {0.5}
    labels = spark.createDataFrame([(3, 1), (4, 0), (4, 1), (None, 1), (5, None), (6, 7)], "doc_id bigint, label int")
    assert quality.score(vectors, quality.fit(vectors, labels)).count() == len(odd_texts)
    empty = some(spark, [])
    assert quality.drop_poor(empty, labels).count() == 0
    assert quality.drop_poor(docs, none).count() == len(odd_texts)


# -- operator 6


def test_bpe_equals_the_library(spark, odd_texts, sf):
    import base64

    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*odd_texts, *(r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect())]
    for i, r in rows_of(bpe.encode(some(spark, texts), path, public_tokenizers.PATTERN)).items():
        assert list(r.ids) == library.encode_ordinary(texts[i] or "") and r.n_tokens == len(r.ids)
        assert bytes(r.decoded) == (texts[i] or "").encode()
    assert bpe.encode(some(spark, []), path, public_tokenizers.PATTERN).count() == 0
    clash = some(spark, ["one two", None]).selectExpr("*", "1 AS part", "2 AS block", "3 AS ids")  # in two blocks, too
    assert sorted(r.n_tokens for r in bpe.encode(clash.repartition(2), path, public_tokenizers.PATTERN).collect()) == [0, len(library.encode_ordinary("one two"))]
    query = rows_of(queries.op6_bpe(spark, sf))
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(d.text)
        assert query[d.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert query[d.doc_id].decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_pieces_around_spaces():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), random.Random(2)
    own = token_store.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["".join(rng.choice([" ", " ", "\n", "\t", "a", "b1", "'s", "!", " ", "é"]) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    for text, ids in zip(texts, own.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


# -- operator 7


def test_decontamination(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [f"{prose(rng.randint(8, 30))}. {prose(rng.randint(4, 20))}." for _ in range(40)]
    benchmark = spark.createDataFrame([*((i, t, 1.0) for i, t in enumerate(items)), (98, None, 1.0), (99, " . ", 1.0)], "item_id bigint, text string, score double")
    texts = [None, "", prose(500), items[3], f"{prose(200)} {items[7].upper()} {prose(90)} {items[8]}", " ".join(items[5].split()[:6]) + prose(50), prose(63) + " " + items[9] + " " + prose(5000)]
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(some(spark, texts), benchmark).collect()}
    assert got == {(3, 3), (4, 7), (4, 8), (6, 9)}
    clean = decontam.drop_leaks(some(spark, texts), benchmark)
    assert sorted(r.doc_id for r in clean.collect()) == [0, 1, 2, 5] and clean.columns == some(spark, []).columns
    assert decontam.leaks(some(spark, []), benchmark).count() == 0
    assert decontam.leaks(some(spark, texts), benchmark.limit(0)).count() == 0


def test_pruned_search_equals_full_scoring():
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(50)]
    index = decontam.Index(items)
    for _ in range(200):
        own = rng.choice(items)[1].split()
        text = " ".join(rng.choices(words, k=rng.randint(0, 80)) + own[: rng.randint(0, 12)])
        (ids,) = index.numbers(pa.array([text]))
        want = set()
        for start in range(0, max(1, len(ids) - index.passage + index.stride), index.stride):
            passage = ids[start : start + index.passage]
            for item in range(50):
                total = sum(float(x[list(at).index(item)]) for t in set(passage[passage >= 0].tolist()) for at, x in [(index.items[t], index.impacts[t])] if item in at)
                shares = [np.isin(codes, index.codes(passage, n)).mean() if n else 1.0 for n, codes in index.parts[item]]
                if total >= decontam.THRESHOLD - 1e-9 and min(shares) >= decontam.OVERLAP:
                    want.add(item)
        assert {f[0] for f in index.search(ids)} == want


def test_shards_give_equal_scores(spark, sf, monkeypatch):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    whole = sorted(decontam.leaks(docs, items).collect())
    monkeypatch.setattr(decontam, "SHARD_BYTES", items.agg(F.sum(F.octet_length("text"))).first()[0] // 4)
    parts = sorted(decontam.leaks(docs, items).collect())
    assert whole and [r[:2] for r in parts] == [r[:2] for r in whole]
    assert np.allclose([r[2:] for r in parts], [r[2:] for r in whole])


def test_a_long_item_leaves_the_others_alone():
    """One item of 3,000 words among short ones: the passages and findings of the others stay."""
    rng = random.Random(14)
    words = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(15, 60)))) for i in range(200)]
    long = (999, " ".join(f"x{i}" for i in range(3000)))
    texts = [" ".join(rng.choices(words, k=300) + items[k][1].split() + rng.choices(words, k=300)) for k in range(20)] + [" ".join(rng.choices(words, k=4000)), long[1]]
    found = []
    for some_items in (items, [*items, long]):
        got = set()
        for index in decontam.indexes(some_items, decontam.Statistics.of([t for _, t in some_items])):
            assert index.passage == (128 if index.ids != [999] else 8192)
            got |= {(k, index.ids[f[0]]) for k, ids in enumerate(index.numbers(pa.array(texts))) for f in index.search(ids)}
        found.append(got)
    assert found[1] - {(21, 999)} == found[0] and (21, 999) in found[1]
    assert found[0] >= {(k, k) for k in range(20)}


def test_decontamination_on_table(spark, sf):
    """Every document with an item's whole text is found, no other."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if " ".join(decontam.terms(i.text)) in " ".join(decontam.terms(d.text))}
    assert {(r.doc_id, r.item_id) for r in queries.op7_decontam(spark, sf).collect()} == want


# -- operator 8


def brute_repeats(texts, length=suffix.LENGTH):
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            w = raw[at : at + length]
            if w in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((len(raw), sum(gone), len([1 for k, _ in itertools.groupby(gone) if k]), kept))
    return out


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(500):
        text = [rng.randint(0, rng.choice([1, 3, 20])) for _ in range(rng.randint(0, 40))]
        assert suffix.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_removed_repeats(spark, odd_texts):
    got = rows_of(suffix.remove_repeats(some(spark, odd_texts)))
    assert [(got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) for i in range(len(odd_texts))] == brute_repeats(odd_texts)


def test_removed_repeats_by_window(spark, odd_texts, monkeypatch):
    """The way for anchors with very many different segments gives the same."""
    monkeypatch.setattr(suffix, "MOST", 1)
    got = rows_of(suffix.remove_repeats(some(spark, odd_texts)))
    assert [bytes(got[i].kept) for i in range(len(odd_texts))] == [x[3] for x in brute_repeats(odd_texts)]


def test_removed_repeats_on_table(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda d: d.doc_id)
    got = rows_of(queries.op8_suffix(spark, sf))
    for d, (n, removed, runs, kept) in zip(docs, brute_repeats([d.text for d in docs]), strict=True):
        r = got[d.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, runs, hashlib.sha256(kept).hexdigest())


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(suffix, "BATCH_BYTES", 100)
    rng = np.random.default_rng(3)
    text = bytes(rng.integers(97, 101, 3000, np.uint8))
    whole, found = suffix.segments([text]), set()
    windows = lambda s, o, n, a: {(int(x + k), int(x + y), int(h)) for x, y, m, h in zip(s, o, n, a, strict=True) for k in range(int(m))}
    for _, offsets, pieces in suffix._parts([text]):
        owner, start, offset, n, anchor, _ = suffix.segments(pieces)
        found |= windows(start + np.array(offsets)[owner], offset, n, anchor)
    assert found == windows(*whole[1:5])


def test_removed_repeats_odd_tables(spark):
    assert suffix.remove_repeats(some(spark, [])).count() == 0
    long = "".join(random.Random(1).choices("abcdefgh", k=150))
    got = sorted((r.doc_id is None, r.n_removed) for r in suffix.remove_repeats(some(spark, [long, long, long, long], [1, 1, 2, None])).collect())
    assert got == [(False, 0), (False, 0), (False, 150), (True, 0)]


# -- operator 9


def test_lm_scores(spark, odd_texts, monkeypatch):
    """Plain counting of words and windows over all texts, and the network's probability word by word."""
    monkeypatch.setattr(lm, "PART", 1 << 9)
    texts = [*odd_texts[:40], None, "", "One", "One", "one two three four", "zero two three four"]
    corpus = lm.gather(some(spark, texts).repartition(3))
    assert corpus.parts > 3
    model = lm.fit(corpus)
    tokens = [(t or "").lower().split() for t in texts]
    window = lambda x, k: tuple(x[k + j] if 0 <= k + j < len(x) else None for j in (-2, -1, 1, 2))
    places = Counter(window(x, k) for x in tokens for k in range(len(x)))
    same = Counter((window(x, k), x[k]) for x in tokens for k in range(len(x)))
    n = Counter(w for x in tokens for w in x)
    name = {w: lm.xxhash.xxh3_64_intdigest(w.encode()) for w in n}
    code = {w: int(model.coder.codes(np.array([h], np.uint64))[0]) for w, h in name.items()} | {None: lm.EDGE}
    top = sorted(n, key=lambda w: (-n[w], np.array([name[w]], np.uint64).view(np.int64)[0]))
    assert [code[w] for w in top[:20]] == list(range(20))
    mass = Counter()
    for w in n:
        mass[code[w]] += n[w]
    got = rows_of(lm.score(corpus, model))
    assert len(got) == len(texts)
    for i, x in enumerate(tokens):
        want = 0.0
        for k, w in enumerate(x):
            at = window(x, k)
            net = float(np.exp(model.network.log_p(np.array([[code[v] for v in at]]), np.array([code[w]]))[0])) * n[w] / mass[code[w]]
            want += np.log((same[at, w] - 1 + lm.WEIGHT * net) / (places[at] - 1 + lm.WEIGHT))
        assert got[i].n_tokens == len(x) and got[i].log_likelihood == pytest.approx(want, rel=1e-4, abs=1e-3)
        assert got[i].per_token == (pytest.approx(want / len(x), rel=1e-4, abs=1e-4) if x else None)
    blank = lm.gather(some(spark, [None, "", " "]))
    assert [(r.n_tokens, r.log_likelihood, r.per_token) for r in lm.score(blank, lm.fit(blank)).collect()] == [(0, 0.0, None)] * 3
    empty = lm.gather(some(spark, []))
    assert lm.score(empty, lm.fit(empty)).count() == 0


def test_lm_tells_texts_that_occur_twice(spark):
    rng = random.Random(4)
    prose = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(60)) for _ in range(80)]
    corpus = lm.gather(some(spark, [*prose, *prose[:20]]))
    got = rows_of(lm.score(corpus, lm.fit(corpus)))
    once = [got[i].per_token for i in range(20, 80)]
    assert all(got[i].per_token > max(once) + 1 for i in [*range(20), *range(80, 100)])


def test_lm_network():
    """Probabilities sum to 1 over all codes, gradients are those of the loss, and both sides are learnt."""
    rng = np.random.default_rng(2)
    network = lm.Network(rng.integers(0, 50, lm.CODES))
    window = rng.integers(0, lm.CODES + 1, (1, 4))
    assert np.exp(network.log_p(np.repeat(window, lm.CODES, axis=0), np.arange(lm.CODES)).astype(float)).sum() == pytest.approx(1, abs=1e-4)
    windows, codes = rng.integers(0, 6, (40, 4)), rng.integers(0, 6, 40)
    grads = network.gradients(windows, codes)
    for k in ("embedding", "inner", "outer", "last", "last_bias"):
        at = np.unravel_index(np.abs(grads[k]).argmax(), grads[k].shape)
        loss = []
        for step in (1e-2, -2e-2):
            network.weights[k][at] += step
            loss.append(-network.log_p(windows, codes).astype(float).mean())
        network.weights[k][at] += 1e-2
        assert (loss[0] - loss[1]) / 2e-2 == pytest.approx(float(grads[k][at]), rel=0.05, abs=1e-4)
    left, right = rng.integers(0, 8, (2, 30_000))
    windows = np.stack([rng.integers(0, 8, 30_000), left, right, rng.integers(0, 8, 30_000)], axis=1)
    codes = 8 + (left + right) % 8
    network = lm.Network(np.bincount(codes, minlength=lm.CODES))
    before = network.log_p(windows, codes).mean()
    assert network.learn(iter([(windows, codes)] * 60)) == 60 * 30_000
    assert network.log_p(windows, codes).mean() > before + 1


def test_lm_network_in_blocks():
    """Places are done in blocks of any size, also where a class goes on from one block to the next."""
    rng = np.random.default_rng(4)
    network = lm.Network(rng.integers(0, 50, lm.CODES))
    windows, codes = rng.integers(0, lm.CODES + 1, (300, 4)), np.append(rng.integers(0, lm.CODES, 200), rng.integers(0, 64, 100))
    whole = network.gradients(windows, codes, block=300)
    for k, g in network.gradients(windows, codes, block=7).items():
        assert np.allclose(g, whole[k], atol=1e-6)
    assert np.allclose(network.log_p(windows, codes, block=7), network.log_p(windows, codes), atol=1e-5)
    assert network.log_p(windows[:0], codes[:0]).shape == (0,)  # a slice without words


def test_lm_network_with_great_scores():
    """Scores beyond the range of float32's exponential are shifted, others are not: the probabilities are those of float64."""
    rng = np.random.default_rng(6)
    for scale in (1, 50, 300):
        scores = rng.normal(0, scale, (lm.CLASSES, 40)).astype(np.float32)
        scores[:, 7] -= 4 * scale
        exact = scores.astype(float) - scores.max(axis=0)
        exact -= np.log(np.exp(exact).sum(axis=0))
        assert np.allclose(lm.Network._softmax(scores.copy()), np.exp(exact), atol=1e-6)
        at = rng.integers(0, lm.CLASSES, 40)
        assert np.allclose(lm.Network._log_softmax_at(scores.copy(), at), exact[at, np.arange(40)], rtol=1e-5, atol=1e-4)


_STEPS = """
import time
import numpy as np
from tallyspark.llm import lm

rng = np.random.default_rng(3)
codes = np.minimum(rng.zipf(1.2, lm.BATCH * 4), lm.CODES) - 1
windows = codes[rng.integers(0, len(codes), (len(codes), 4))]
network = lm.Network(np.bincount(codes, minlength=lm.CODES))
new = lambda *shape: rng.random(shape, dtype=np.float32)
inside, hidden, scores = (new(lm.BATCH, k) for k in (4 * lm.EMBEDDING, lm.HIDDEN, lm.CLASSES))
inner, outer = new(4 * lm.EMBEDDING, lm.HIDDEN), new(lm.HIDDEN, lm.CLASSES)
first, second, third = np.empty_like(hidden), np.empty_like(scores), np.empty_like(outer)

def products():
    for _ in range(4):
        np.matmul(inside, inner, out=first), np.matmul(hidden, inner.T, out=second), inside.T @ hidden
        for _ in range(2):
            np.matmul(hidden, outer, out=second), np.matmul(scores, outer.T, out=first), np.matmul(hidden.T, scores, out=third), np.exp(scores, out=second)

def took(f):
    start = time.process_time()
    f()
    return time.process_time() - start

pairs = [(took(lambda: network.learn(iter([(windows, codes)]))), took(products)) for _ in range(25)]
print(min(a for a, _ in pairs) / min(b for _, b in pairs))
"""


def test_lm_steps_are_mostly_products():
    """A step of learning takes little more than its matrix products and exponentials do, on one core."""
    root = str(Path(lm.__file__).parents[2])
    env = os.environ | {"OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1", "PYTHONPATH": root}
    ratios = (float(subprocess.run([sys.executable, "-c", _STEPS], env=env, capture_output=True, check=True, text=True).stdout) for _ in range(4))
    assert any(r < 3.5 for r in ratios)


def test_lm_learns_from_every_place(spark, odd_texts):
    """Over all rounds the network sees each place of the corpus once."""
    corpus = lm.gather(some(spark, odd_texts[:40]))
    rows = corpus.slices.select("sizes", "codes", "words").toArrow().to_batches()
    shared = types.SimpleNamespace(value=(lm.Coder(corpus.frequent), np.ones(lm.CODES, np.int64), None))
    seen = [next(lm._learn(shared, turn)(iter(rows))).column("n")[0].as_py() for turn in range(lm.ROUNDS)]
    assert sum(seen) == sum(len((t or "").split()) for t in odd_texts[:40]) and min(seen) > 0


# -- operator 10


def brute_spans(texts):
    """The texts without what spans repeat, by plain loops over words."""
    seen, out = set(), []
    rank_of = {}
    for text in texts:
        text = text or ""
        found = list(re.finditer("[\u3000-\U0010ffff]|[^\t-\r \u3000-\U0010ffff]+", text))
        words, n = [m[0].encode().lower() for m in found], len(found)
        for w in words:
            if w not in rank_of:
                rank_of[w] = int(spans.Words([w]).hashes[0][0]) >> 28
        closed = [re.search(rb"[.!?][\"')\]]?$", w) for w in words]
        opens = [k == 0 or bool(closed[k - 1]) or "\n" in text[found[k - 1].end() : found[k].start()] for k in range(n)]
        begins = {k for k in range(n) if opens[k]}
        for k in range(n - spans.WINDOW + 1):
            if not any(opens[k : k + spans.WINDOW]):
                begins.add(min(range(k, k + spans.WINDOW), key=lambda j: (rank_of[words[j]], -j)))
        gone, places = bytearray(len(text)), []
        for k in sorted(begins):
            if k + spans.WORDS <= n:
                places.append((k, min((j for j in begins if j >= k + spans.WORDS), default=n)))
        if spans.LEAST <= n < spans.WORDS:
            places.append((0, n))
        for a, b in places:
            key = tuple(words[a:b])
            if key in seen:
                start, end = found[a].start(), found[b].start() if b < n else len(text)
                gone[start:end] = b"\1" * (end - start)
            seen.add(key)
        out.append("".join(c for c, g in zip(text, gone, strict=True) if not g))
    return out


def test_long_texts_are_read_in_stretches(monkeypatch):
    rng = random.Random(12)
    texts = [" ".join(rng.choice(["ab", "cde.", "f\ng", "日本", "x" * 300]) for _ in range(rng.randint(1, 400))).encode() for _ in range(30)]
    whole = spans.spans(texts)
    monkeypatch.setattr(spans, "STRETCH", 500)
    for one, other in zip(whole, spans.spans(texts), strict=True):
        assert (one == other).all()


def test_repeated_spans(spark, odd_texts):
    rng = random.Random(6)
    lines = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.randint(3, 12))) + rng.choice([". ", "! ", "\n", "? "]) for _ in range(60)]
    texts = [*odd_texts, *("".join(rng.choices(lines, k=rng.randint(1, 12))) for _ in range(60))]
    found = spans.remove_repeated_spans(some(spark, texts))
    got, want = rows_of(found), brute_spans(texts)
    assert [got[i].text or "" for i in range(len(texts))] == want and any(len(w) < len(t or "") for w, t in zip(want, texts, strict=True))
    assert [got[i].removed_chars for i in range(len(texts))] == [len(t or "") - len(w) for w, t in zip(want, texts, strict=True)]
    assert found.columns == [*some(spark, []).columns, "removed_chars"]


def test_repeated_spans_on_table(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda d: d.doc_id)
    got = rows_of(queries.op10_spans(spark, sf))
    for d, want in zip(docs, brute_spans([d.text for d in docs]), strict=True):
        assert got[d.doc_id].kept_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_repeated_spans_odd_tables(spark):
    assert spans.remove_repeated_spans(some(spark, [])).count() == 0
    text = "One two three four five six. Seven eight nine ten eleven twelve. "
    got = spans.remove_repeated_spans(some(spark, [text, text, text, text, None], [1, 1, 2, None, 3])).collect()
    assert sorted((r.doc_id or 0, r.text is not None and len(r.text)) for r in got) == [(0, len(text)), (1, len(text)), (1, len(text)), (2, 0), (3, False)]


def test_a_passage_of_all_texts_gathers_nowhere(monkeypatch):
    """Each batch sends one copy of it to be compared, all others to parts that batches share."""
    monkeypatch.setattr(spans, "FLUSH", 20_000)
    passage = " ".join(f"word{k}" for k in range(60)) + ". "
    texts = [passage + f"own {k} " * 5 for k in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array(texts)], ["doc_id", "text"])
    sent = [r for b in spans._scan(50, pa.int64())(iter([batch.slice(k, 20) for k in range(0, 600, 20)])) for r in b.to_pylist()]
    starts = {p: 0 for p in range(-50, 50)}
    for r in sent:
        assert (r["part"] < 0) == (r["n"] == 0)
        starts[r["part"]] += len(r["start"]) // 4
    batches = sum(r["part"] < 0 for r in sent)
    assert batches >= 10 and sum(n for p, n in starts.items() if p < 0) > 5 * 550
    assert all(n <= 60 * batches for p, n in starts.items() if p >= 0) and sum(n for p, n in starts.items() if p >= 0) < 600 * 8
    assert max(n for p, n in starts.items() if p < 0) < 0.5 * sum(n for p, n in starts.items() if p < 0)


def test_repeated_passages_without_whole_sentences(spark):
    rng = random.Random(8)
    some_words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    texts, passages = [], []
    for k in range(120):
        # one sentence, or the middle of one, or parts of two or three sentences: over 50 words each
        parts = rng.choice([[51], [90], [40, 15], [16, 35], [17, 17, 17], [16, 19, 16], [25, 1, 25]])
        passage = ". ".join(some_words(n) for n in parts)
        own = lambda: rng.choice(["", some_words(rng.randint(1, 30)) + rng.choice([" ", ". "])]), lambda: rng.choice([" ", ". "]) + some_words(rng.randint(1, 30))  # noqa: B023, E731
        texts += [own[0]() + passage + own[1](), own[0]() + passage + own[1]()]
        passages.append(passage)
    clean = [some_words(rng.randint(1, 80)) + "." for _ in range(60)]
    single = [some_words(n) + "." for n in (16, 30, 70)]
    got = rows_of(spans.remove_repeated_spans(some(spark, [*texts, *clean, *single, *single])))
    for k, passage in enumerate(passages):
        assert got[2 * k].removed_chars == 0
        assert got[2 * k + 1].removed_chars >= spans.WORDS * 7 - 1 and passage not in got[2 * k + 1].text
        first, second = passage.split(), set(got[2 * k + 1].text.split())
        own = [w for w in texts[2 * k + 1].split() if w.strip(".") not in {x.strip(".") for x in first}]
        assert set(own) <= second  # what isn't repeated stays
    rest = [got[i] for i in range(len(texts), len(texts) + len(clean) + 6)]
    assert all(r.removed_chars == 0 for r in rest[:-3])
    assert rest[-3].text == rest[-2].text == rest[-1].text == ""


# -- pipeline


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 120")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    stages = dict(corpus_pipeline.STAGES)
    kept = common.stored(stages["quality"](spark, docs, sf), "test")
    vectors = quality.vectorize(docs)
    score = rows_of(quality.score(vectors, quality.fit(vectors, queries._quality_labels(spark, sf))))
    assert {r.doc_id for r in kept.collect()} == {i for i, r in score.items() if r.score >= quality.ACCEPT}
    before = sorted(kept.collect(), key=lambda r: r.doc_id)
    single = common.stored(stages["near duplicates"](spark, kept, sf), "test")
    roots, _ = brute_components([r.text for r in before])
    assert sorted(r.doc_id for r in single.collect()) == [r.doc_id for i, r in enumerate(before) if roots[i] == i]
    before = sorted(single.collect(), key=lambda r: r.doc_id)
    stripped = common.stored(stages["repeated passages"](spark, single, sf), "test")
    assert stripped.columns == docs.columns
    assert [(r.text, r.n_chars) for r in sorted(stripped.collect(), key=lambda r: r.doc_id)] == [(t, len(t)) for t in brute_spans([r.text for r in before])]
    clean = common.stored(stages["decontamination"](spark, stripped, sf), "test")
    whole = [" ".join(decontam.terms(i.text)) for i in benchmark]
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in stripped.collect() if not any(w in " ".join(decontam.terms(r.text)) for w in whole)}
    assert rows_of(stages["tokens"](spark, clean, sf)).keys() == {r.doc_id for r in clean.collect()}


def test_scratch_needs_a_shared_folder(spark):
    assert common.shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
