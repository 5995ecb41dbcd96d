"""Each operator against a plain version, with nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import itertools
import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokentrail.llm import fingerprints, fm_index, gif, jaccard_join, lang_id, line_dedup, mixing, pieces, quality, queries, substring_dedup, token_store
from tokentrail.llm.common import mix64, unmix64, work_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in er th on an re ing ed Ünit naïve 日本 x1 a.b".split()


def corpus(n=40, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ","]) for _ in range(rng.randint(1, 60)))
        rows.append((i, t.replace(". ", ".\n"), rng.choice(["en", "de"]), rng.choice(["a", "b", None]), len(t)))
    return rows + [(n, rows[3][1], "en", "a", 1), (n + 1, None, None, None, None), (n + 2, "", "en", "b", 0), (n + 3, " \n\t ", None, "b", 4), (n + 4, "word " * 3000, "en", "a", 15000), (n + 5, rows[3][1], "de", "a", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    # columns whose names the operators use inside must not matter
    df = spark.createDataFrame(corpus(), SCHEMA)
    return df.withColumns({c: F.lit(1) for c in ("size", "start", "shard", "spans", "n", "score")}).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def texts():
    return {r[0]: r[1] or "" for r in corpus()}


def test_token_store(spark, docs, none):
    from tokenizers import Tokenizer

    path = work_path(spark, "t")
    token_store.write_tokens(docs, path, queries.WORD_BPE, tokens_per_file=500)
    got = {r.doc_id: r for r in token_store.with_crc32(token_store.read_tokens(spark, path)).collect()}
    t, start = Tokenizer.from_file(queries.WORD_BPE), 0
    for d, text in sorted(texts().items()):
        ids = t.encode(text, add_special_tokens=False).ids + [1]
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    path = work_path(spark, "t")
    token_store.write_tokens(none, path, queries.WORD_BPE)
    assert token_store.read_tokens(spark, path).count() == 0


def test_ids_are_the_librarys():
    """Words over all of Unicode, with letters that grow or turn into marks in lower case."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    t, rng = Tokenizer.from_file(queries.WORD_BPE), random.Random(1)
    words = token_store.Words(t, "<u2")
    odd = "İıſßŉǰΐẞΣςσAaZz.,!?'`\"-’“\u0327\u0301\u0307\u00a0\u200b\t\x0b\x85 ½Ⅷ日カ가ﬁ"

    def char():
        k = rng.random()
        c = rng.randint(0, 0x10FFFF)
        return rng.choice("abcXYZ .,!'019") if k < 0.35 else rng.choice(odd) if k < 0.6 else chr(c % 0x2500) if k < 0.8 or 0xD800 <= c < 0xE000 else chr(c)

    letters = [chr(c) for c in (*range(0xC0, 0x250), *range(0x400, 0x482), *b"abcdeXYZ")]
    runs = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) + rng.choice(["", ".", "'s", "!?"]) for _ in range(30)) for _ in range(300)]
    some = ["EVİ.", "TÜRKİ, x", "İ!", "ΑΣ.", "", *runs, *("".join(char() for _ in range(rng.randint(1, 14))) for _ in range(20_000))]
    got = token_store._ids_of(pa.array(some), words, 2)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [e.ids for e in t.encode_batch(some, add_special_tokens=False)]


def test_token_store_of_repeated_ids(spark):
    """Many rows of one id go to several shards, in one order whatever the shards."""
    rows = [(5, f"word{i % 70} b{i}") for i in range(400)] + [(None, "x"), (None, None), (1, "a"), (9, "z"), (5, "word1 b1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("shard", "hash", "ids", "width")})
    found = []
    for parts, per_file in ((4, 100), (3, 10**6)):
        path = work_path(spark, "t")
        token_store.write_tokens(df.repartition(parts), path, queries.WORD_BPE, tokens_per_file=per_file)
        got = token_store.with_crc32(token_store.read_tokens(spark, path)).orderBy("start").collect()
        assert [r.doc_id for r in got] == [None, None, 1, *[5] * 401, 9]
        assert all(a.start + a.n_tokens == b.start for a, b in itertools.pairwise(got))
        found.append(list(map(tuple, got)))
    assert found[0] == found[1]
    files = spark.read.parquet(f"{path}/files")
    assert files.select("shard").distinct().count() > 2
    ids, cuts = np.array([5] * 1000 + [4, 6]), np.array([5, 5, 5])
    shards = token_store.shard_of(ids, mix64(np.arange(1002, dtype=np.uint64)), cuts)
    assert set(shards[:1000].tolist()) == {0, 1, 2} and shards[1000:].tolist() == [0, 3]


def test_random_access():
    ids = np.random.default_rng(0).integers(0, 1 << 21, 3000)
    f = token_store.DacFile(io.BytesIO(token_store.dac_file([5, 9], np.array([0, 1000, 3000]), ids)))
    assert [f.token(i) for i in range(3000)] == ids.tolist() == f.all_tokens().tolist()
    assert f.doc_ids().tolist() == [5, 9] and f.offsets().tolist() == [0, 1000, 3000]
    with pytest.raises(IndexError):
        f.token(3000)


def test_quality(spark, none):
    rng = random.Random(1)
    good = [(i, " ".join(rng.choice(WORDS) for _ in range(40)), "en", "s", 1) for i in range(300)]
    bad = [(1000 + i, " ".join(rng.choice(WORDS).upper() + "!!" for _ in range(40)), "en", "s", 1) for i in range(100)]
    df = spark.createDataFrame([*good, *bad, (5000, None, None, None, None), (5001, "", None, None, None)], SCHEMA)
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000), 0) for r in good + bad] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(df, labels).collect()
    held = [r for r in rows if r.held_out and r.doc_id < 5000]
    assert len(rows) == 402 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == (r.doc_id < 1000) for r in held) >= 0.95 * len(held)
    assert {r.doc_id: r.held_out for r in rows} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows}
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and kept.filter("doc_id < 1000").count() >= 299
    assert quality.classify(none, labels).count() == 0
    assert {r.score for r in quality.classify(df, labels.limit(0)).collect()} == {1.0}


def test_quality_parts_against_plain_ones():
    """Log-count ratios by counting, and the descent's solution by its conditions: no other weights are better."""
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 12, 5)) for _ in range(40)]
    y = rng.integers(0, 2, 40)
    y[:2] = 0, 1
    ratio = quality.log_count_ratios(rows, y, 12)
    p, q = ([1 + sum(f in r for r, c in zip(rows, y, strict=True) if c == k) for f in range(12)] for k in (1, 0))
    assert ratio == pytest.approx([np.log((a / sum(p)) / (b / sum(q))) for a, b in zip(p, q, strict=True)])
    x = np.zeros((40, 12))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r]
    sign, c = np.where(y == 1, 1.0, -1.0), np.full(40, 0.7)
    w, b = quality.dual_coordinate_descent([r for r in rows], [ratio[r] for r in rows], sign, 12, c, rounds=3000)

    def loss(v):
        return (v @ v) / 2 + (c * np.maximum(0, 1 - sign * (x @ v[:12] + v[12])) ** 2).sum()

    best = np.append(w, b)
    # plain gradient steps from elsewhere come to the same least loss
    v = rng.normal(size=13)
    for _ in range(20_000):
        slack = np.maximum(0, 1 - sign * (x @ v[:12] + v[12]))
        v -= 0.005 * (v - 2 * np.append(x.T @ (c * sign * slack), (c * sign * slack).sum()))
    assert loss(best) == pytest.approx(loss(v), rel=1e-4) and np.abs(best - v).max() < 0.02


def test_quality_of_odd_rows(spark):
    rows = [(i, f"good words number {i}" if i % 3 else f"BAD!!! {i} ###") for i in range(90)]
    rows += [(None, "good words"), (5, "BAD!!! ### other"), (6, rows[6][1]), (200, "good words again " * 40_000), (201, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("l_id", "quality", "score", "bits", "held_out")})
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(90)] + [(4, 1)], "doc_id long, quality int").withColumn("text", F.lit("own"))
    got = quality.classify(df, labels).collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.doc_id == 6}) == 1
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {200, None}
    index = quality.features(b"good words again " * 3000)
    assert (quality._unpacked(quality._packed(index)) == index).all() and (quality._unpacked(quality._packed(np.arange(20_000))) == np.arange(20_000)).all()


def shingles(text, n):
    w = text.split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_fingerprints(docs, none):
    t = texts()
    ids = sorted(t)
    for r in fingerprints.fingerprints(docs).collect():
        nxt = t[ids[ids.index(r.doc_id) - 1]]
        own, cut = t[r.doc_id], len(t[r.doc_id]) // 3
        edited = own[: len(own) - cut] + nxt[:cut]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(own)
        for got, other in ((r.near_edited, edited), (r.near_next, nxt)):
            a, b = shingles(own, 5), shingles(other, 5)
            assert got == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)  # sets below k: exact
    assert fingerprints.fingerprints(none).count() == 0


def test_estimates_of_sets_above_k(spark):
    """Sampled estimates are near the truth, and sketches of parts merge into that of the whole."""
    rng, k = random.Random(3), 128
    own = [f"w{rng.randint(0, 10**6)}" for _ in range(4000)]
    rows = [(" ".join(own), " ".join(own[:3000])), (" ".join(own[:2500]), " ".join(own[1500:])), (" ".join(own), "other " * 9)]
    df = spark.createDataFrame(rows, "a string, b string").select(*(fingerprints.words_of(F.col(c)).alias(c) for c in "ab"))
    df = df.select(*(fingerprints.sketch_of(F.col(c), k).alias(c) for c in "ab"))
    f = df.select(*(c.alias(n) for n, c in {"j": fingerprints.resemblance(F.col("a"), F.col("b"), k), "in_": fingerprints.containment(F.col("b"), F.col("a"), k), "n": fingerprints.distinct_count(F.col("a"), k), "size": F.size("a"), "back": fingerprints.from_text(fingerprints.as_text(F.col("a"))) == F.col("a")}.items()))
    for r, (a, b) in zip(f.collect(), rows, strict=True):
        x, y = shingles(a, 5), shingles(b, 5)
        assert r.size == k and r.back and abs(r.j - len(x & y) / len(x | y)) < 0.15 and abs(r.n / len(x) - 1) < 0.3
        assert abs(r["in_"] - len(x & y) / len(y)) < 0.3
    parts = spark.createDataFrame([(1, " ".join(own[i : i + 504])) for i in range(0, 4000, 500)], "g int, t string").select("g", fingerprints.words_of(F.col("t")).alias("t"))
    whole = spark.createDataFrame([(" ".join(own),)], "t string").select(fingerprints.words_of(F.col("t")).alias("t")).select(fingerprints.sketch_of(F.col("t"), k).alias("s")).first().s
    assert fingerprints.merged(parts.select("g", fingerprints.sketch_of(F.col("t"), k).alias("sketch")), ["g"], k=k).first().sketch == whole


def test_merged_fingerprints(spark):
    df = spark.createDataFrame([(1, [1, 5, 9]), (1, [2, 5]), (2, [7])], "g int, sketch array<long>")
    assert {r.g: r.sketch for r in fingerprints.merged(df, ["g"], k=3).collect()} == {1: [1, 2, 5], 2: [7]}


def classes(rows, words, percent):
    sets = {d: shingles((t or "").encode().lower().decode(), words) for d, t in rows}
    index, both = defaultdict(list), Counter()
    for d, s in sets.items():
        for e in s:
            index[e].append(d)
    for x in index.values():
        both.update((a, b) for i, a in enumerate(x) for b in x[:i])
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, b), c in both.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


@pytest.mark.parametrize(("words", "percent", "long"), [(4, 85, 6), (2, 80, 1000)])
def test_jaccard(spark, words, percent, long):
    rng = random.Random(2)
    bases = [[rng.choice("abcdefgh") for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(120):
        x = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            x[rng.randrange(60)] = rng.choice("xyz")
        rows.append((i, " ".join(x)))
    rows += [(900, None), (901, ""), (902, "a"), (903, "A"), (904, " a ")]
    got = jaccard_join.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"), words, percent, long)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == classes(rows, words, percent)


def test_block_pairs_are_those_that_can_link():
    rng = np.random.default_rng(4)
    for percent in (50, 80, 85):
        n = 300
        element, low = rng.integers(0, 6, n), rng.integers(1, 40, n)
        high = low + rng.integers(0, 3, n) * rng.integers(0, 2, n)
        rest = rng.integers(1, high + 1)
        order = np.lexsort((-rest, low, element))
        element, low, high, rest = (x[order] for x in (element, low, high, rest))
        want = set()
        for i, j in itertools.combinations(range(n), 2):
            need = -(-percent * int(low[i] + low[j]) // (100 + percent))
            if element[i] == element[j] and (percent * low[j] <= 100 * high[i] or low[i] == low[j]) and min(rest[i], rest[j]) >= need:
                want.add((i, j))
        got = [(int(i), int(j)) for a, b in jaccard_join.block_pairs(element, low, high, rest, percent, 50) for i, j in zip(a, b, strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize(("percent", "long"), [(70, 2), (80, 1000)])
def test_jaccard_between_groups(spark, percent, long):
    """Chains of copies that drift apart: groups whose leaders do not link while members do."""
    rng, rows = random.Random(percent), []
    for family in range(6):
        x = [f"{family}w{i}" for i in range(40)]
        for step in range(25):
            rows.append((rng.randint(0, 10**9), " ".join(x)))
            for _ in range(rng.randint(1, 4)):
                x[rng.randrange(40)] = f"{family}n{rng.randint(0, 60)}"
    got = jaccard_join.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"), 1, percent, long)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == classes(rows, 1, percent)


def test_jaccard_of_odd_rows(spark):
    """Null ids have no component; rows of one id are one document; columns may have any names."""
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, a), (5, b), (5, a), (7, a), (8, b), (None, a), (None, None), (9, "x " * 60_000), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("n_shingles", "component_id", "signature", "leader", "element")})
    got = Counter(map(tuple, jaccard_join.similarity_classes(df).collect()))
    five = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    with_a = five[a] < five[b]
    assert got == Counter([(5, 27, 5), (5, 27, 5), (5, 27, 5), (7, 27, 5 if with_a else 7), (8, 27, 8 if with_a else 5), (None, 27, None), (None, 0, None), (9, 1, 9), (3, 0, 3)])


def test_bucket_counts_of_large_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (3, 4000, 5000, 900_000)]
    sets.append(np.concatenate([sets[2][:4500], sets[3][:200]]))
    for most in (0, 5, 255):
        table = jaccard_join.Counts(np.array([jaccard_join._counts(s, most) for s in sets], object))
        plain = np.stack([np.bincount((s % np.uint64(jaccard_join.BUCKETS)).astype(int), minlength=jaccard_join.BUCKETS) for s in sets])
        for i, j in itertools.product(range(5), repeat=2):
            got = np.minimum(table[np.array([i, 0])], table[np.array([j, 0])]).sum(axis=1, dtype=np.int64)
            assert got.tolist() == [np.minimum(plain[i], plain[j]).sum(), 3] and got[0] >= len(np.intersect1d(sets[i], sets[j]))


def test_jaccard_of_very_long_texts_in_long_lists(spark):
    """Sets of more than 142,160 shingles that meet in long lists only link by their whole counts."""
    words = [f"{i:x}" for i in range(150_000)]
    rows = [(d, " ".join([*words[: 30_000 * d], f"new{d}", *words[30_000 * d :]])) for d in range(1, 5)] + [(9, "a b c d e")]
    got = jaccard_join.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"), long=2)
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 9: 9}


def test_jaccard_of_nothing(none):
    assert jaccard_join.similarity_classes(none).count() == 0


def test_lzw_and_gif():
    rng = np.random.default_rng(1)
    for n, size in ((0, 8), (1, 2), (5000, 3), (70000, 8)):
        data = rng.integers(0, 1 << size, n).astype(np.uint8).tobytes()
        assert gif.lzw_decode(gif.lzw_encode(data, size), size, n) == data
    with pytest.raises(ValueError):
        gif.lzw_decode(gif.lzw_encode(b"abc"), 8, 9)
    red_blue = bytes([255, 0, 0, 0, 0, 255])
    frames = [gif.Frame(0, 0, 8, 9, bytes(72), delay=5, interlaced=True), gif.Frame(1, 1, 2, 2, bytes([1, 0, 1, 1]), delay=7, disposal=3, transparent=0), gif.Frame(0, 0, 1, 1, b"\1", disposal=2), gif.Frame(7, 8, 1, 1, b"\0", palette=bytes([1, 2, 3, 0, 0, 0]))]
    (s0, _, a), (s1, d1, b), (_, _, c), (_, _, e) = gif.decode_gif(gif.encode_gif(8, 9, frames, red_blue))
    assert (s0, s1, d1) == (0, 5, 7) and (a[..., 0] == 255).all()
    assert b[1, 1].tolist() == [0, 0, 255, 255] and b[1, 2].tolist() == [255, 0, 0, 255]
    assert c[1, 1].tolist() == [255, 0, 0, 255] and c[0, 0].tolist() == [0, 0, 255, 255]
    assert e[0, 0].tolist() == [0, 0, 0, 0] and e[8, 7].tolist() == [1, 2, 3, 255]


def test_media(docs, none):
    for r in gif.stored_media(docs).collect():
        raw = texts()[r.doc_id].encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        levels = np.bincount(np.frombuffer(payload, np.uint8) >> 4, minlength=16).tolist()
        rows = -(-len(payload) // 192)
        assert [(f.start, f.delay, f.width) for f in r.frames] == [(4 * i, 4, 192) for i in range(-(-rows // 256))]
        assert all([sum(f[c][k] for f in r.frames) for k in range(16)] == levels for c in ("red", "green", "blue"))
    feature = {r.doc_id: r.feature for r in gif.stored_media(docs).select("doc_id", gif.feature_of("frames").alias("feature")).collect()}
    assert feature[3] == feature[40] != feature[4] and feature[41] == "1;4;" + ";".join([",".join(["0"] * 2 + ["192"] + ["0"] * 13)] * 3)
    assert gif.stored_media(none).count() == 0


def test_media_frames(spark):
    """Timed frames as they are shown, and damaged files told apart."""
    red_blue = bytes([255, 0, 0, 0, 0, 255])
    good = gif.encode_gif(2, 2, [gif.Frame(0, 0, 2, 2, bytes([0, 0, 0, 1]), delay=5), gif.Frame(1, 0, 1, 2, bytes([1, 0]), delay=7, disposal=2, transparent=0), gif.Frame(0, 0, 1, 1, b"\1")], red_blue)
    rows = [(1, bytearray(good)), (1, bytearray(good)), (2, None), (3, bytearray(b"GIF89a")), (4, bytearray(b"nothing")), (None, bytearray(good[:-4])), (5, bytearray(good[:30]))]
    df = spark.createDataFrame(rows, "doc_id long, media binary").withColumn("frame", F.lit("own"))
    got = gif.media_frames(df).collect()
    frames = [r for r in got if r.doc_id == 1]
    assert Counter((r.frame, r.start, r.delay, r.width, r.height) for r in frames) == Counter({(0, 0, 5, 2, 2): 2, (1, 5, 7, 2, 2): 2, (2, 12, 0, 2, 2): 2})
    # red and blue of the pixels shown: 3 and 1; the right column half blue; its area gone but for the left one
    assert {(r.frame, r.red[15], r.blue[15], sum(r.green)) for r in frames} == {(0, 3, 1, 4), (1, 2, 2, 4), (2, 1, 1, 2)}
    assert {r.doc_id for r in got if r.error} == {3, 4, None, 5} and all(r.frame is None for r in got if r.error)
    assert gif.media_frames(df.limit(0)).count() == 0
    for cut in range(6, len(good)):
        with pytest.raises(ValueError):
            gif.decode_gif(good[:cut])


def test_lines(spark, none):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["a", " b", "c ", "", "d"]) for _ in range(rng.randint(0, 12)))) for i in range(80)] + [(200, None), (201, "")]
    seen, want = set(), {}
    for d, t in rows:
        lines = [x.strip() for x in (t or "").split("\n")]
        at, gone = [i for i, x in enumerate(lines) if x], set()
        for k in range(len(at) - 2):
            run = tuple(lines[i] for i in at[k : k + 3])
            if run in seen:
                gone.update(range(at[k], at[k + 2] + 1))
            seen.add(run)
        want[d] = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.report(df).collect()} == want
    assert line_dedup.report(none).count() == 0 and line_dedup.without_repeats(none).count() == 0


def test_lines_with_many_words(spark):
    """Every maximal matched run counts that has three lines, or fewer with enough words."""
    rng = random.Random(8)
    pool = [" ".join(f"{c}{k}" for k in range(n)) for c, n in zip("abcdefgh", (1, 2, 3, 5, 6, 7, 10, 12), strict=True)] + ["", " "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 4)))) for i in range(120)]
    rows += [(300, "u v w\n" + pool[7]), (301, pool[7]), (302, None), (303, "")]
    lines = {d: [(i, x.strip()) for i, x in enumerate((t or "").split("\n")) if x.strip()] for d, t in rows}
    want = {}
    for d, t in rows:
        own, gone = lines[d], set()
        for e in (e for e in lines if e <= d):
            other = lines[e]
            for i, j in itertools.product(range(len(own)), range(len(other))):
                n = 0
                while (e < d or j < i) and i + n < len(own) and j + n < len(other) and own[i + n][1] == other[j + n][1]:
                    n += 1
                if n >= 3 or n and sum(len(x.split()) for _, x in own[i : i + n]) >= 10:
                    gone.update(k for k, _ in own[i : i + n])
        for (i, _), (j, _) in itertools.pairwise(own):
            if i in gone and j in gone:
                gone.update(range(i, j))
        want[d] = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.report(df, words=10).collect()} == want
    long = " ".join(f"w{i}" for i in range(50))
    some = spark.createDataFrame([(1, f"x\n{long}"), (2, long), (3, f"y\n {long}"), (4, long[:-4]), (5, long[:-4])], "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.without_repeats(some).collect()} == {1: f"x\n{long}", 3: "y", 4: long[:-4], 5: long[:-4]}


def test_positions_are_selected_ones():
    """Fewer rows than runs; each run is in the rows of one position; and without the fingerprint's match nothing goes."""
    h = mix64(np.arange(400, dtype=np.uint64))
    prints, at, first, last = line_dedup.positions(h, 2, 2)
    assert len(prints) < 0.8 * (len(h) - 2) and len(set(at.tolist())) == len(at)
    assert [k for a, b in zip(first, last, strict=True) for k in range(a, b + 1)] == list(range(len(h) - 2))
    assert all(a - 1 <= x and y <= a for a, x, y in zip(at, first, last, strict=True))


@pytest.mark.parametrize(("gram", "window"), [(2, 2), (1, 3), (2, 4), (3, 1)])
def test_extents(spark, gram, window):
    """Every line in a run of lines that also starts earlier goes, and no other; also with repeated and null ids, clashing
    columns and a long text."""
    rng, run = random.Random(gram), gram + window - 1
    rows = [(i, "\n".join(rng.choice("abcd") for _ in range(rng.randint(0, 14)))) for i in range(60)]
    rows += [(7, "p\nq\nr\ns\nt\nu"), (None, "p\nq\nr\ns\nt\nu"), (None, None), (3, rows[3][1]), (99, "\n".join(rng.choice("efghijkl") for _ in range(3000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("_extents", "_doc_id", "_text_hash", "print", "head", "n_chars")})
    keys = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    seen, want = {}, {}
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, keys[r[1]])):
        lines, gone = (t or "").split("\n"), set()
        at = [i for i, x in enumerate(lines) if x.strip()]
        for k in range(len(at) - run + 1):
            if seen.setdefault(tuple(lines[i] for i in at[k : k + run]), (d, t, k)) != (d, t, k):
                gone.update(range(at[k], at[k + run - 1] + 1))
        want[d, t] = None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    got = line_dedup.report(df, gram, window).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((d, want[d, t]) for d, t in rows)
    left = line_dedup.without_repeats(df.drop("n_chars"), gram, window, None)
    assert left.columns == df.drop("n_chars").columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter((d, want[d, t]) for d, t in rows if want[d, t] == t or (want[d, t] or "").strip())


def test_winnow_takes_one_of_each_window():
    g = mix64(np.arange(50, dtype=np.uint64) // np.uint64(2))
    at = line_dedup.winnow(g, 4)
    assert all(k <= a < k + 4 and g[a] == g[k : k + 4].min() for k, a in enumerate(at))


def test_substrings(spark, none):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(150)] + [(500, None), (501, ""), (502, "a b " * 300)]
    seen, want = set(), {}
    for d, t in rows:
        w, gone = (t or "").split(), set()
        for i in range(len(w) - 5):
            k = tuple(w[i : i + 6])
            if k in seen:
                gone.update(range(i, i + 6))
            seen.add(k)
        want[d] = (len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 6, 3)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()} == want
    assert substring_dedup.remove_repeats(none).count() == 0


def test_substrings_of_heavy_anchors(spark):
    """A very common passage in other surroundings: its windows go one by one, and all repeats are found."""
    rng = random.Random(9)
    common = [f"c{i}" for i in range(14)]
    rows = []
    for d in range(300):
        own = [rng.choice("xyz") + str(rng.randint(0, 3)) for _ in range(rng.randint(0, 9))]
        rows.append((d, " ".join([*own, *common, *own[::-1]])))
    rows += [(1, "another text with that id " + rows[5][1]), (2, rows[2][1]), (None, rows[3][1])]
    seen, want = {}, Counter()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    keys = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    for d, t in sorted(order, key=lambda r: (r[0] is not None, r[0] or 0, keys[r[1]])):
        w, gone = t.split(), set()
        for i in range(len(w) - 9):
            k = tuple(w[i : i + 10])
            if seen.setdefault(k, (d, t, i)) != (d, t, i):
                gone.update(range(i, i + 10))
        want[d, len(w), len(gone)] += 1
    for held in (5, 60_000):
        base = df.select("doc_id", "text")
        repeated = substring_dedup.repeated_anchors(base, 10, 4)
        assert len(repeated.heavy)
        spans = substring_dedup.repeated_spans(substring_dedup.contexts(base, repeated, 10, 4, held), 10).collect()
        gone = defaultdict(set)
        for s in spans:
            gone[s.doc_id, s.text_hash].update(range(s.first, s.last + 10))
        got = Counter((d, len(t.split()), len(gone[-(2**63) if d is None else d, keys[t]])) for d, t in rows)
        assert got == want
    found = substring_dedup.remove_repeats(df, 10, 4)
    assert Counter((r.doc_id, r.n_words, r.n_removed) for r in found.collect()) == want


def test_fm_index():
    rng = np.random.default_rng(0)
    for _ in range(30):
        t = int(rng.integers(1, 6))
        seqs = [rng.integers(1, 4, rng.integers(1, 15)) for _ in range(3)]
        index = fm_index.FMIndex(seqs, t, 3)
        text = [int(c) for s in seqs for c in [*s, 0]]
        at = lambda p: [i for i in range(len(text) - len(p) + 1) if text[i : i + len(p)] == p]  # noqa: B023, E731
        places = sorted(range(len(text)), key=lambda i: text[i:])  # noqa: B023
        assert index.locate(np.arange(len(text))).tolist() == [p if text[p] else -1 for p in places]
        queries_ = [*seqs, rng.integers(1, 6, 9)]
        for q, length, row in zip(queries_, *index.matching_statistics(queries_), strict=True):
            q = q.tolist()
            for i in range(len(q)):
                m = max(n for n in range(t + 1) if i + n <= len(q) and (n == 0 or at(q[i : i + n])))
                found = at(q[i : i + t])
                assert length[i] == m and (row[i] >= 0) == (m == t)
                if m == t:
                    assert index.first_places(row[i : i + 1])[0] == (found[0] if len(found) > 1 else -1)
                    assert index.locate(row[i : i + 1])[0] in found
        pattern = seqs[0][:t]
        assert index.count(pattern) == len(at(pattern.tolist()))


def test_fm_index_is_compressed():
    rng = np.random.default_rng(1)
    some = [rng.integers(1, 9000, 27) for _ in range(2000)]
    index = fm_index.FMIndex([*some, *(np.concatenate([x[5:], rng.integers(1, 9000, 5)]) for x in some)], 20)
    assert index.n > 100_000 and index.size_in_bytes < 6 * index.n and not hasattr(index, "text")


def test_bits():
    rng = np.random.default_rng(2)
    for n in (1, 63, 64, 65, 1000):
        bits = rng.random(n) < 0.4
        bits[0] = True
        b = fm_index.Bits(bits)
        at = np.arange(n)
        assert b.rank1(at).tolist() == [int(bits[:i].sum()) for i in range(n)] and (b.get(at) == bits).all()
        assert (b.select1(np.arange(int(bits.sum()))) == np.flatnonzero(bits)).all()


def test_language(spark, none):
    en, de = "the quick brown fox jumps over the lazy dog and then some more words".split(), "der schnelle braune fuchs springt über den faulen hund und noch viele wörter".split()
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(de if i % 2 else en) for _ in range(20)), "de" if i % 2 else "en") for i in range(120)]
    rows += [(900, None, "en"), (901, "", None), (902, "123 !!", "de"), (903, "über den hund", None)]
    got = {r.doc_id: r for r in lang_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[d].lang_pred == lang and 0 <= got[d].score <= 1 for d, _, lang in rows[:120])
    assert [got[d].lang_pred for d in (900, 901, 902, 903)] == ["und", "und", "und", "de"]
    assert lang_id.identify(none).count() == 0


def greedy(text, sample):
    n = i = 0
    while i < len(text):
        k = 0
        while i + k < len(text) and text[i : i + k + 1] in sample:
            k += 1
        i, n = i + max(k, 1), n + 1
    return n


def test_cross_parsing_counts_greedy_phrases(monkeypatch):
    p = lang_id.CrossParser({"x": "abcabd"})
    # ab | abca | zz twice alone | d
    assert p.phrases(["ababca"])[0, 0] == 2 and p.phrases(["zzd"])[0, 0] == 3
    rng = random.Random(0)
    for _ in range(25):
        for name, values in (("SEGMENT", (3, 7, 20)), ("LANES", (2, 5, 100)), ("ALPHABET", (3, 6, 64))):
            monkeypatch.setattr(lang_id, name, rng.choice(values))
        letters = "abcdefg日本語"
        samples = {k: "".join(rng.choice(letters[: rng.randint(2, 10)]) for _ in range(rng.randint(1, 60))) for k in "xyz"}
        many = ["".join(rng.choice(letters + "Z") for _ in range(rng.randint(0, 90))) for _ in range(9)]
        parser = lang_id.CrossParser(samples)
        assert parser.phrases(many).tolist() == [[greedy(t, samples[k]) for k in "xyz"] for t in many]
        known = [t for t in many if t]
        cost = [[greedy(t.lower(), samples[k]) * np.log2(max(2, len(samples[k]))) for k in "xyz"] for t in known]
        assert parser.predict(known)[0] == ["xyz"[int(np.argmin(c))] for c in cost]


def test_suffix_automaton():
    rng = random.Random(1)
    for _ in range(30):
        text = [rng.randint(0, 2) for _ in range(rng.randint(1, 25))]
        to = lang_id.suffix_automaton(text)
        parts = {tuple(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)}
        for n in range(6):
            for word in itertools.product(range(3), repeat=n):
                state = 0
                for c in word:
                    state = None if state is None else to[state].get(c)
                assert (state is not None) == (word in parts)


def test_language_of_odd_rows(spark):
    long = "the quick brown fox jumps over the lazy dog " * 5000
    rows = [(1, long, "en"), (1, "der schnelle braune fuchs", "de"), (None, "the lazy fox", "en"), (None, "der braune fuchs", None), (2, "the fox", "en"), (2, "the fox", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in ("rank", "h", "size", "over", "held_out", "score")})
    got = lang_id.identify(df).collect()
    assert Counter((r.doc_id, r.lang_pred) for r in got) == Counter((d, "de" if "der" in t else "en") for d, t, _ in rows)


def test_targets_and_seats():
    t = mixing.sources_targets([("b", 100), ("a", 10), (None, 50)])
    assert t["a"] == 20 and sum(t.values()) == pytest.approx(240) and all(t[s] <= 2 * n for s, n in (("b", 100), ("a", 10), (None, 50)))
    rng = random.Random(6)
    for _ in range(50):
        w, seats = [rng.randint(1, 100) for _ in range(5)], rng.randint(0, 60)
        plain = [0] * 5
        for _ in range(seats):
            i = max(range(5), key=lambda k: (w[k] / (2 * plain[k] + 1), -k))
            plain[i] += 1
        assert mixing.sainte_lague(w, seats) == plain


def test_mix(docs, none, spark):
    rows = mixing.mix(docs, block_words=4).collect()
    again = mixing.mix(docs.repartition(2), block_words=4).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again)) and len(rows) == len(corpus())
    assert all(r.taken <= 2 * r["size"] for r in rows)
    sources = {r[0]: r[3] for r in corpus()}
    taken = Counter()
    for r in rows:
        taken[sources[r.doc_id]] += r.taken
    for s in ("a", "b", None):
        target = next(r.target for r in rows if sources[r.doc_id] == s)
        assert abs(taken[s] - target) <= 8
    out = mixing.mixed_documents(docs, spark, block_words=4)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
    assert {r.doc_id: r.taken for r in rows if r.taken} == dict(words)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none, spark).count() == 0


def test_mix_of_rows_with_one_id(spark):
    """Repeated and null ids with other texts, and equal rows: each row is taken by its own plan."""
    rows = [(d, " ".join(f"{i}w{k}" for k in range(9 + i)), "en", s, 1) for i, (d, s) in enumerate([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a"), (None, None), (2, "b"), (3, None)])]
    rows += [rows[0], (1, None, "en", "a", 1), (None, "", "en", "a", 0), (0, rows[3][1], "en", "a", 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("_mix_id", "row", "id", "hash", "key", "nth", "plan", "plans", "passes", "spans", "taken_text")})
    for share in (0.4, 1.5):
        want, got = Counter(), Counter()
        for r in mixing.mix(df, share=share, block_words=4).collect():
            want[r.doc_id, r["size"]] += r.taken
        out = mixing.mixed_documents(df, spark, share=share, block_words=4).collect()
        whole = {(r[0], r[3], r[1].split("w")[0]): r[1].split() for r in rows if r[1]}
        for r in out:
            own = whole[r.doc_id, r.source, r.text.split("w")[0]]
            assert set(r.text.split()) <= set(own)
            got[r.doc_id, len(own)] += len(r.text.split())
        assert got == +want
        assert sorted(map(str, out)) == sorted(map(str, mixing.mixed_documents(df.repartition(3), spark, share=share, block_words=4).collect()))


def test_pieces(docs, none):
    model = pieces.load(queries.PIECES)
    for text in ["ab cd", "hello", "a  b", "é ñ", "x\ny", "日本", "▁a", "\t q", ""]:
        found = []

        def go(at, score, ids, chunk, found=found):
            if at == len(chunk):
                found.append((score, np.array(ids, "<u2").tobytes()))
            for end in range(at + 1, len(chunk) + 1):
                for start, s, piece in model._edges(chunk, end):
                    if start == at:
                        go(end, score + s, ids + piece, chunk)

        go(0, 0, (), f" {text}" if text else "")
        ids, best, n_best = model.encode(text)
        assert model.decode(ids) == text if text else ids == b""
        assert [s for s, _ in n_best] == sorted((s for s, _ in found), reverse=True)[:3] and n_best[0] == (best, ids)
        assert len({x for _, x in n_best}) == len(n_best) and set(n_best) <= set(found)
        assert [round(s * pieces.UNIT) for s, _ in model.n_best_of(text)] == [s for s, _ in n_best]
    rng = random.Random(5)
    chunks = {" " + "".join(rng.choice("abeilnorst'.é日\t▁\0") for _ in range(rng.randint(1, 40))) for _ in range(600)} | {" ", "   ", "\n"}
    model.solve_all(chunks)
    for chunk in chunks:
        gap = [a - b for a, b in itertools.pairwise([s for s, _ in model.search(chunk, 2)])]
        assert model.solved[chunk] == model._solve(chunk) and gap in ([], [model.solved[chunk][2]])
    rows = pieces.encode_pieces(docs, queries.PIECES).collect()
    assert len(rows) == len(corpus()) and all(r.round_trip for r in rows)
    for r in rows:
        wide = lambda x: zlib.crc32(np.frombuffer(bytes(x), "<u2").astype("<u4").tobytes())
        assert r.ids == r.n_best_ids[0] and r.ids_crc32 == wide(r.ids) and r.n_best_crc32 == list(map(wide, r.n_best_ids))
        assert r.n_best_scores == sorted(r.n_best_scores, reverse=True) and r.n_best_scores[0] == r.score
    assert pieces.encode_pieces(none, queries.PIECES).count() == 0


def test_best_pieces_are_mostly_the_librarys(spark):
    import sentencepiece

    library, model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES), pieces.load(queries.PIECES)
    words = Counter(w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() for w in (r.text or "").split())
    same = sum(n for w, n in words.items() if np.frombuffer(model.encode(w)[0], "<u2").tolist() == library.encode(w))
    assert same >= 0.9 * sum(words.values())


def test_mix64():
    x = np.random.default_rng(7).integers(0, 1 << 63, 100).astype(np.uint64)
    assert (unmix64(mix64(x)) == x).all()


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.createDataFrame(corpus(60), SCHEMA)
    sf = work_path(spark, "sf")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf)
        assert at.columns == docs.columns, name
    assert corpus_pipeline.run(spark, sf).filter("NOT round_trip").count() == 0
    near = corpus_pipeline.stage_near_duplicates(spark, docs, sf)
    plain = classes([(r[0], r[1]) for r in corpus(60)], 5, 80)
    assert sorted(r.doc_id for r in near.select("doc_id").collect()) == sorted(d for d, (_, c) in plain.items() if c == d)


def test_the_fit_holds_no_values_of_all_rows():
    """The driver's memory for the fit of quality is far below that of its sample."""
    import tracemalloc

    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 1 << 12, 2000)).astype(np.int32) for _ in range(1000)]
    tracemalloc.start()
    quality.fit_features(rows, [i % 2 for i in range(1000)], 1 << 12)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < sum(r.nbytes for r in rows) / 4
