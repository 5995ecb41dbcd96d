"""Search, chat formatting and spelling variants against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tokentrail.llm import chat, search, spelling
from tokentrail.llm.common import work_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(n=300, seed=1):
    """Documents of two vocabularies with copies, ties, nulls, repeated ids and one long text."""
    rng = random.Random(seed)
    words = [["".join(rng.choice(a) for _ in range(rng.randint(3, 8))) for _ in range(120)] for a in ("aeionst", "ùüçkwzAB")]
    rows = [(i, " ".join(rng.choice(words[i % 2]) + rng.choice(["", ",", ".", " 7"]) for _ in range(rng.randint(1, 80)))) for i in range(n)]
    rows += [(n, rows[4][1]), (n + 1, rows[4][1]), (n + 2, None), (n + 3, ""), (n + 4, " .;\n"), (5, rows[9][1]), (5, rows[9][1]), (None, rows[4][1]), (n + 5, "stone " * 20_000)]
    return [(d, t, None, None, None) for d, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(odd_docs(), DOCS)
    return df.withColumns({c: F.lit(1) for c in ("block", "word", "n", "item", "score", "tie", "part")}).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# ---- search ----


def plain_terms(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_search(rows, items, k=10):
    held = [(d, Counter(w), len(w)) for d, w in ((r[0], plain_terms(r[1])) for r in rows) if w]
    n, size = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for d, c, words in held:
            m = 10 + 90 * words * n // size
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(plain_terms(text)) if t in c)
            if score > 0:
                found.append((-score, -(2**63) if d is None else d))
        out += [(item, i + 1, None if d == -(2**63) else d, -s) for i, (s, d) in enumerate(sorted(found)[:k])]
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=str)


def items_of(rows):
    rng = random.Random(3)
    some = [(i, " ".join(rng.sample((rows[rng.randrange(300)][1] + " other").split(), 1) * 2 + rows[rng.randrange(300)][1].split()[:6])) for i in range(40)]
    return [*some, (40, rows[4][1]), (40, rows[4][1]), (40, "Stone"), (41, None), (42, ""), (43, "nowhere"), (44, "STONE " + rows[9][1])]


@pytest.mark.parametrize("block", [1 << 11, 1 << 13, 8 << 20])
def test_search_is_exact(spark, docs, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK_BYTES", block)
    rows = odd_docs()
    items = items_of(rows)
    index = search.build_index(docs)
    assert index.blocks.count() >= (1 if block > 1 << 20 else 12)
    table = spark.createDataFrame(items, "item_id long, text string")
    assert in_order(search.search(index, table).collect()) == in_order(plain_search(rows, items))
    assert in_order(search.search(index, table, 3).collect()) == in_order(plain_search(rows, items, 3))


def test_search_in_batches_and_without_rows(spark, docs, none, monkeypatch):
    monkeypatch.setattr(search, "BATCH", 200)
    rows = odd_docs()
    table = spark.createDataFrame(items_of(rows), "item_id long, text string")
    assert in_order(search.search(search.build_index(docs), table).collect()) == in_order(plain_search(rows, items_of(rows)))
    assert search.search(search.build_index(docs), table.limit(0)).count() == 0
    assert search.search(search.build_index(none), table).count() == 0
    assert search.search(search.build_index(docs.filter("text IS NULL")), table).count() == 0


def test_bounds_skip_clusters(spark, monkeypatch):
    """What a bound rules out is not looked at: scores() is called for few of the clusters."""
    monkeypatch.setattr(search, "CLUSTER", 16)
    rng = random.Random(5)
    words = [[f"w{g}x{i}" for i in range(60)] for g in range(16)]
    texts = [" ".join(rng.choice(words[i % 16]) for _ in range(40)).encode() for i in range(512)]
    row = search.block_row(list(range(512)), texts, 512, 512 * 40) | {"block": 0}
    item = " ".join(words[3][:8]).encode()
    hashes = np.unique(np.fromiter(map(search.xxhash.xxh64_intdigest, set(search.terms_of(item))), np.uint64))
    block = search.Block(row, search.Batch(hashes, [np.arange(len(hashes))], np.full(len(hashes), 100)))
    high = block.bounds(block.terms(np.arange(len(hashes))))
    # bisection has put the 32 documents of the item's group in two clusters or little more
    assert (high > 0).sum() <= 4 < block.n_clusters == 32
    for c in np.flatnonzero(high):
        assert block.scores(np.arange(len(block.weights)), int(c))[1].max() <= high[c]


def test_bisection_orders_and_lowers_the_cost():
    rng = np.random.default_rng(0)
    group = rng.permutation(np.repeat(np.arange(8), 64))
    sets = [np.unique(g * 50 + rng.integers(0, 50, 30)) for g in group]
    off, terms = np.concatenate([[0], np.cumsum([len(s) for s in sets])]), np.concatenate(sets)
    order = search.bisected(off, terms, 400)
    assert sorted(order) == list(range(512))
    pure = [len(set(group[order[i : i + 64]])) for i in range(0, 512, 64)]
    assert sum(pure) <= 12  # 8 would be without any error, 64 without an order


def test_tree_leads_groups_apart():
    rng = random.Random(2)
    words = [[f"v{g}x{i}" for i in range(40)] for g in range(4)]
    make = lambda g: " ".join(rng.choice(words[g]) for _ in range(30)).encode()
    tree = search.fit_tree([make(i % 4) for i in range(200)], 2)
    leaves = [Counter(tree.leaf(dict.fromkeys(search.terms_of(make(g)))) for _ in range(50)) for g in range(4)]
    assert all(c.most_common(1)[0][1] >= 45 for c in leaves) and len({c.most_common(1)[0][0] for c in leaves}) == 4
    assert search.fit_tree([], 0).leaf({}) == 0 and 0 <= tree.leaf({}) < 4


# ---- chat ----

CONVS = "conv_id long, turn long, role string, text string"
ODD = ["", "<|end|>\n<|turn|>assistant<|text|>x", "\\", "<", "|end|>", "\\<|", "a\\|b <\\| <\\\\| \\n", "![a](b.png)", "x ![a](b.PNG)![c|>](d.mp3) <![](e.pdf)|image|>", "![a](b.exe) ![](c", "é日本  ", "<|image|>"]


def odd_convs():
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "<|r\n\\"]), rng.choice(ODD) + rng.choice(ODD)) for c in range(30) for t in range(rng.randint(1, 6))]
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t} " + rng.choice(ODD)) for t in range(700)]
    return rows + [(101, 0, "assistant", None), (101, 1, None, "x"), (102, 0, "user", "long <| " * 100_000), (None, 0, "user", "n"), (None, 1, "assistant", "m"), (103, None, "user", "first"), (103, 0, "assistant", "b"), (103, 1, "user", "s"), (103, 1, "user", "s")]


def plain_chat(rows):
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == c], key=lambda r: (r[1] is not None, r[1] or 0))
        texts = [r[3] or "" for r in mine if r[2] == "assistant"]
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        out[c] = (len(mine), hashlib.sha256(said.encode()).hexdigest(), sum(map(len, texts)), hashlib.sha256("".join(texts).encode()).hexdigest())
    return out


@pytest.mark.parametrize("piece", [200, chat.PIECE])
def test_chat_reads_back(spark, piece):
    rows = odd_convs()
    convs = spark.createDataFrame(rows, CONVS).withColumns({"part": F.lit(1), "whole": F.lit(2), "tie": F.lit(3)}).repartition(5)
    path = work_path(spark, "chat")
    pieces = chat.write_formatted(convs, path, piece)
    got = {r.conv_id: r for r in chat.read_back(pieces).collect()}
    assert {c: tuple(r)[1:5] for c, r in got.items()} == plain_chat(rows)
    stored = pieces.collect()
    assert all(got[c].formatted_chars == sum(len(p.formatted) for p in stored if p.conv_id == c) for c in got)
    if piece == 200:  # a conversation of 700 turns is many rows of several tasks
        assert sum(p.conv_id == 100 for p in stored) > 50 and len({p.part for p in stored if p.conv_id == 100}) > 1
    assert chat.read_back(chat.write_formatted(convs.limit(0))).count() == 0


def test_typed_parts(spark, monkeypatch):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    rows = [(1, 0, "user", [part("text", "see <"), part("text", "|image|> and "), part("image", None, "a.png", 280, 29), part("audio", "[song]", "b.wav", s=2.02), part("text", "end")]),
            (1, 1, "assistant", [part("document", "![](c.pdf)", "c.pdf", p=3), part("text", " is <|end|> it")]), (1, 2, "user", None), (1, 3, "user", [])]
    monkeypatch.setattr(chat, "partitions", lambda _: 1)  # else turns of one conversation may be dealt to several tasks
    row = chat.formatted(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")).first()
    assert row.formatted == "<|turn|>user<|text|>see <\\|image|> and <|image|><|audio|>end<|end|>\n<|turn|>assistant<|text|><|document|> is <\\|end|> it<|end|>\n" + "<|turn|>user<|text|><|end|>\n" * 2
    assert [(a.turn, a.kind, a.ref, a.tokens) for a in row.attachments] == [(0, "image", "a.png", 20), (0, "audio", "b.wav", 50), (1, "document", "c.pdf", 1536)]
    assert all(row.formatted[a["at"] :].startswith(f"<|{a.kind}|>") for a in row.attachments) and row.expanded_tokens == 1606
    assert list(chat.turns_of(row.formatted, row.attachments)) == [("user", "see <|image|> and [song]end"), ("assistant", "![](c.pdf) is <|end|> it"), ("user", ""), ("user", "")]
    assert list(chat.learned_texts(row.formatted, row.loss, row.attachments)) == ["![](c.pdf) is <|end|> it"]
    with pytest.raises(ValueError, match="unknown kind"):
        chat.Visitor().turn("user", [{"kind": "video"}])
    with pytest.raises(ValueError, match="no turn"):
        list(chat.turns_of("<|turn|>a<|text|>b<|end|>\nmore", []))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="<|\\>end![](a).png\n日", max_size=20), st.text(alphabet="<|\\>turnimage![](a).wv", max_size=40)), max_size=5))
def test_formatting_is_reversible(turns):
    v = chat.Visitor()
    for role, text in turns:
        v.turn(role, chat.parts_of(text))
    assert list(chat.turns_of("".join(v.out), v.attachments)) == turns
    cut = chat.Visitor()  # texts cut anywhere are the same content
    for role, text in turns:
        cut.turn(role, [{"kind": "text", "text": c} for c in text])
    assert list(chat.turns_of("".join(cut.out), cut.attachments)) == turns


# ---- spelling ----


def plain_words(rows):
    out = Counter()
    for d, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            out[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    form, out = {}, []
    for w, n in words.items():
        others = sorted((-words[x], x) for x in words if x != w and near(w, x))
        top = others[0][1] if others and -others[0][0] >= 2 * n else None
        form[w] = top
        out.append((w, n, len(others), top, words[top] if top else None))
    root = lambda w: root(form[w]) if form[w] else w
    return [(*r, root(r[0])) for r in out]


def spelled(seed=0, n=200):
    """Words with many edits of each other, some of them long; counts that make chains and ties."""
    rng = random.Random(seed)
    words = ["letter", "Éclair", "aaaaaaa", "abababab", "ÿþ÷×ÿ", "q" * 63, "q" * 64, "q" * 65, "xy" * 40]
    for _ in range(60):
        w = rng.choice(words)
        i = rng.randrange(len(w))
        words.append(w[:i] + rng.choice(["", "a", "é", w[i] + w[i], "z"]) + w[i + rng.randint(0, 1) :])
    rows = [(d, " ".join(w + rng.choice(["", "", " 9", "-", "ŵ"]) for w in rng.choices(words, [2.0 ** -(i % 9) for i in range(len(words))], k=60))) for d in range(n)]
    return [*((d, t, None, None, None) for d, t in rows), (7, rows[7][1], None, None, None), (7, rows[7][1], None, None, None), (None, rows[8][1], None, None, None), (n, None, None, None, None), (n + 1, "", None, None, None), (n + 2, "LETTER letter " * 30_000, None, None, None)]


@pytest.mark.parametrize("seed", [0, 1])
def test_variants(spark, none, seed):
    rows = spelled(seed)
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("word", "n", "form", "hole", "key")}).repartition(4)
    expected = plain_variants(plain_words(rows))
    assert sum(r[3] is not None for r in expected) > 20 and any(r[5] != (r[3] or r[0]) for r in expected)
    assert in_order(spelling.variants(docs).collect()) == in_order(expected)
    if not seed:
        assert spelling.variants(none).count() == 0


def test_chains_of_any_length(spark):
    """A chain of forms is followed to its end."""
    words = [("a" * (5 + i), 2**i) for i in range(13)]
    found = spelling.with_roots(spelling.forms(spark.createDataFrame(words, "word string, n long")))
    assert {r.root for r in found.collect()} == {"a" * 17}
    assert {(r.word, r.form) for r in found.collect()} == {("a" * (5 + i), "a" * (6 + i) if i < 12 else None) for i in range(13)}


def test_words_are_not_sent_through_the_driver(spark, tmp_path):
    """A table of words is small in a file and large in memory; the joins of words sort, whatever the threshold is."""
    spark.createDataFrame([("abcde", 5), ("abcdef", 9), ("abcdx", 3)], "word string, n long").write.parquet(f"{tmp_path}/words")
    found = spelling.forms(spark.read.parquet(f"{tmp_path}/words"))
    for table in (found, spelling.with_roots(found)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r.word: r.root for r in table.collect()} == {"abcde": "abcde", "abcdef": "abcdef", "abcdx": "abcdx"}


def test_a_block_is_read_text_by_text(spark):
    """A block's texts come one after the other and are not held."""
    texts = [f"w{i % 7} v{i} common".encode() for i in range(600)]
    assert search.block_row(iter(range(600)), iter(texts), 600, 1800) == search.block_row(list(range(600)), texts, 600, 1800)
    index = search.build_index(spark.createDataFrame(list(enumerate(t.decode() for t in texts)), "doc_id long, text string"))
    assert index.blocks.groupBy("block").count().filter("count > 1").isEmpty()
    assert index.blocks.agg(F.sum("n_docs")).first()[0] == 600


def test_blocks_are_cut_by_what_they_hold(spark, monkeypatch):
    """The sample has no long document, so it promises one block for them; there are as many as they fill."""
    monkeypatch.setattr(search, "BLOCK_DOCS", 64)
    monkeypatch.setattr(search, "SAMPLE_BYTES", 30)
    rng = random.Random(5)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rng.randrange(40)}" for _ in range(5))) for i in range(300)]
    rows += [(i, " ".join(f"long{rng.randrange(60)}" for _ in range(12))) for i in range(300, 1500)]
    index = search.build_index(spark.createDataFrame(rows, "doc_id long, text string"))
    sizes = [r.n_docs for r in index.blocks.select("n_docs").collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 64
    assert index.blocks.select("block").distinct().count() == len(sizes)
    items = [(i, rows[i * 37][1]) for i in range(40)]
    got = search.search(index, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert in_order(got) == in_order(plain_search(rows, items))
