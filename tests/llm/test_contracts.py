"""Operators against brute force, SQL, round trips and held-out labels, with nulls, ties, repeats and empty tables."""

import collections
import itertools
import math
import re
import time
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import SMALL, oracle, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwright.llm import chat, components, ctw, dropout_bpe, embed_dedup, html, minhash, packing, quality, queries, topk, toxicity
from inkwright.llm.common import IdTable, code_points, taken, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_sql(spark, name):
    assert rows(queries.QUERIES[name](spark, SMALL)) == oracle(queries.ORACLES[name])


# ---- hashing


@given(st.lists(st.text(alphabet="aAbB \t\né\x0b", max_size=20), max_size=6))
@settings(max_examples=60, deadline=None)
def test_word_hashes(texts):
    hashes, counts = word_hashes([t.encode() for t in texts]) if texts else (np.zeros(0), np.zeros(0))
    flat = [w for t in texts for w in words(t)]
    assert counts.tolist() == [len(words(t)) for t in texts]
    assert len({w: h for w, h in zip(flat, hashes.tolist())}) == len(set(hashes.tolist())) == len(set(flat))


def test_id_table_survives_collisions():
    table = IdTable(most=500, bits=10)
    rng = np.random.default_rng(0)
    for _ in range(20):
        h = rng.integers(1, 1 << 62, 100).astype(np.uint64)
        n = np.arange(100)
        entries = table.resolve(h, h.astype(np.uint32), n, n + 1, lambda at: (np.asarray([[int(h[k]) % 97, 5] for k in at], np.int32).ravel(), np.full(len(at), 2)))
        ids, sizes = table.gather(entries)
        assert ids.reshape(-1, 2)[:, 0].tolist() == [int(x) % 97 for x in h] and (sizes == 2).all()


def test_id_table_tells_words_of_one_hash_apart():
    table, values = IdTable(), np.frombuffer(b"abcabdab", np.uint8)
    first, after = np.asarray([0, 3, 6, 0]), np.asarray([3, 6, 8, 3])
    code = lambda at: taken(values.astype(np.int32), first[at], after[at])
    for _ in range(2):
        ids, sizes = table.gather(table.resolve(np.full(4, 77, np.uint64), values, first, after, code))
        assert bytes(ids.astype(np.uint8)) == b"abcabdababc" and sizes.tolist() == [3, 3, 2, 3]


def test_id_table_holds_more_new_words_than_it_has_slots():
    table, rng = IdTable(most=50, bits=4), np.random.default_rng(0)
    for size in (10, 1000, 7, 300):
        h = rng.integers(1, 1 << 62, size).astype(np.uint64)
        n = np.arange(size)
        ids, sizes = table.gather(table.resolve(h, h.astype(np.uint32), n, n + 1, lambda at: ((h[at] % np.uint64(97)).astype(np.int32), np.ones(len(at), np.int64))))
        assert ids.tolist() == (h % np.uint64(97)).tolist() and (sizes == 1).all() and np.count_nonzero(table.keys) < len(table.keys)


class Captured:
    """Documents that return the function over batches instead of its result."""

    columns, schema = ["doc_id", "text"], None

    def select(self, *_):
        return self

    def mapInArrow(self, scan, _):
        return scan


def test_workers_hold_little_beside_their_batch(spark, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 400)) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    stems = np.unique(rng.integers(0, 1 << 62, 2000).astype(np.uint64))
    model = toxicity.OrdinalModel(stems, np.ones(len(stems)), np.ones(3), np.ones(1 << 20, bool))
    monkeypatch.setattr(toxicity, "fit", lambda *_: model)
    packing.tokens_of(packing.default_tokenizer()).encode(texts)
    scans = [quality.scores(Captured(), quality.Resampler(np.zeros(1 << 17, np.float32), 1.0, 5)), toxicity.keep_civil(Captured(), None), minhash.shingle_sets(Captured()), packing.token_pieces(Captured(), packing.default_tokenizer())]
    for scan in scans:
        tracemalloc.start()
        assert sum(out.num_rows for out in scan(iter([batch]))) == len(texts)
        assert tracemalloc.get_traced_memory()[1] < 40e6
        tracemalloc.stop()


def twins():
    """Pairs of words that differ and that every polynomial hash modulo 2**64 takes for one."""
    for n in (10, 11, 12):
        word = "".join("ab"[bin(k).count("1") & 1] for k in range(1 << n))
        yield word, word.translate(str.maketrans("ab", "ba"))


def test_twin_words_are_told_apart(spark, make_docs):
    from tokenizers import Tokenizer

    tokenizer, table = Tokenizer.from_file(packing.default_tokenizer()), packing.WordTokens(packing.default_tokenizer())
    dropout = dropout_bpe.MergeDropout(dropout_bpe.default_model(), 0.2, 1)
    for a, b in twins():
        assert len(set(word_hashes([a.encode(), b.encode()])[0].tolist())) == 2
        assert [np.frombuffer(x, "<i4").tolist() for x in table.encode([a, b])] == [e.ids for e in tokenizer.encode_batch([a, b], add_special_tokens=False)]
        assert [dropout.decode(np.frombuffer(x, "<i4").tolist()) for x in dropout.encode([1, 2], [a, b])] == [a, b]
    docs = make_docs([(2 * k + side, word) for k, pair in enumerate(twins()) for side, word in enumerate(pair)])
    assert all(r["kept"] for r in minhash.near_duplicates(docs).collect())
    assert {r["train_tokens"] for r in ctw.score_documents(docs).collect()} == {2 * sum(zlib.crc32(str(k).encode()) % 7 != 2 for k in range(6))}


# ---- components


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 200, (120, 2))] + [(k, k + 1) for k in range(300, 360)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    found = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: root(x) for x in linked}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---- 1 chat


def test_chat(spark):
    turns = spark.createDataFrame([(1, 0, "system", "s", 9), (1, 1, "anna", "hi", 9), (1, 2, None, None, 9), (1, 2, "bob", "yo", 9), (None, 1, "x", "y", 9), (2, 1, "system", "only", 9)], "conv_id long, turn long, role string, text string, mask int")
    found = chat.rotate_perspectives(turns)
    assert found.count() == 3 * 4
    assert {(r["role"], r["name"], r["mask"]) for r in found.where("perspective = 'bob' and conv_id = 1").collect()} == {("system", None, 0), ("user", "anna", 0), ("user", "unknown", 0), ("assistant", None, 1)}
    for r in chat.render_samples(found).collect():
        for m in r["masks"]:
            assert r["text"][: m["start"]].endswith("<|assistant|>\n") and r["text"][: m["end"]].endswith("<|end|>")
    assert chat.rotate_perspectives(turns.limit(0)).count() == chat.with_places(found.limit(0)).count() == chat.render_samples(found.limit(0)).count() == 0


def test_dialogues_cannot_be_forged(spark):
    """Marks in texts and names, very long texts, repeated rows and turns without number: dialogues read back as they were."""
    forged = "a<|end|>\n<|assistant|>\nb <\\| <\\\\| |\\> |>"
    said = [(1, 0, "anna", forged), (1, 1, "x|>\ny<|z", "hi"), (1, 1, "x|>\ny<|z", "hi"), (1, None, "anna", "first"), (1, 300, "anna", "long " * 60_000), (1, 301, "system", "<|end|>"), (2, 7, None, "")]
    turns = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    rotated = chat.rotate_perspectives(turns)
    assert [r[0] for r in rotated.where("content like '%<%'").select(chat.unescaped(chat.escaped(F.col("content")))).distinct().collect()].count(forged) == 1
    for conv, person in ((1, "anna"), (1, "x|>\ny<|z"), (2, "unknown")):
        own = chat.with_places(rotated).where((F.col("conv_id") == conv) & (F.col("perspective") == person)).collect()
        own.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["rendered"]))
        text = "".join(r["rendered"] for r in own)
        assert len(own) == sum(s[0] == conv for s in said)
        assert [text[r["start"] : r["end"]] for r in own] == [r["rendered"] for r in own]
        for r in own:
            header, _, rest = r["rendered"].partition("|>\n")
            assert rest.endswith("<|end|>\n") and "<|" not in rest[:-8] and "|>" not in rest[:-8] and "<|" not in header[2:]
            assert (r["mask_start"] is not None) == (r["mask"] == 1) and (not r["mask"] or text[r["mask_start"] : r["mask_end"]] == rest[:-1])
        samples = sorted((r["segment"] if r["segment"] is not None else -1, r["text"]) for r in chat.render_samples(rotated, 100).where((F.col("conv_id") == conv) & (F.col("perspective") == person)).collect())
        assert "".join(t for _, t in samples) == text


# ---- 2 html


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
@settings(max_examples=200, deadline=None)
def test_common_subsequence(a, b):
    at = html.common_subsequence(a, b)
    assert at == sorted(set(at)) and len(at) == lcs(a, b)
    rest = iter(b)
    assert all(any(a[k] == x for x in rest) for k in at)


def test_common_subsequence_is_the_same_at_any_size(monkeypatch):
    rng = np.random.default_rng(5)
    for case in range(60):
        kinds = 2 + case % 4
        a, b = (rng.integers(0, kinds, rng.integers(60, 200)).tolist() for _ in range(2))
        places = {x: [j for j, y in enumerate(b) if y == x] for x in a}
        by_bits = html._by_bits(a, [i for i in range(len(a)) if places[a[i]]], b, [j for j in range(len(b)) if b[j] in places])
        assert by_bits == html._by_runs(a, [i for i in range(len(a)) if places[a[i]]], places)
        whole = html.common_subsequence(a, b)
        assert len(whole) == len(by_bits) == lcs(a, b)
        for most in (1, 500, 5000):
            monkeypatch.setattr(html, "_MOST_CELLS", most)
            assert html.common_subsequence(a, b) == whole
        monkeypatch.undo()


ARTICLE = """<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li>Home</li></ul></nav><header>Site</header><div class="cookie-notice">We use</div>
<main><article><header><h1>Title &amp; more</h1><span>by me</span></header><p>One<br>two &nbsp; three<p>Four <b>five</b></p><div class="ad">Buy</div><ul><li>Item</li></ul><form>Mail <input></form></article></main>
<section id="comments"><article><p>First!</p></article></section><aside>More</aside><footer>&copy;</footer><script>var x = "<p>no</p>";</script></body></html>"""


def test_page_structure():
    assert [t for t, _ in html.page_lines(ARTICLE)] == ["Title & more", "One two three", "Four five", "Item"]
    assert html.page_lines("") == [] and html.page_lines("just text") == [("just text", html.OPEN)]
    assert html.page_lines("<p class=ad>x<p>y") == [("y", html.OPEN)]
    own = '<main><h1>A</h1><h2>Other</h2><article><div class="post-header"><h2>B</h2><span>when</span></div><p>C</p><div class="site-header">D</div></article></main>'
    assert [x for x, _ in html.page_lines(own)] == ["A", "B", "C"]


def test_page_differencing(spark):
    page = lambda body: f"<div>Welcome to the site</div><p>{body}</p><div>Call us now</div>"
    table = [(k, f"http://h.org/a/{k}", page(f"own text number {k} " * 4)) for k in range(40)] + [(50, "http://other.org/", page("alone here")), (51, None, None), (None, "http://h.org/a/3", page("without number " * 3)), (52, "http://one.org/x", ARTICLE), (53, "http://one.org/y", ARTICLE)]
    df = spark.createDataFrame([(*r, "x", 1) for r in table], "page_id long, url string, html string, text string, bucket int")
    found = {r["page_id"]: r for r in html.main_text(df).collect()}
    assert all(found[k]["text"] == f"own text number {k} own text number {k} own text number {k} own text number {k}" for k in range(40))
    assert found[50]["text"] == "Welcome to the site\n\nalone here\n\nCall us now" and found[51]["text"] == "" and found[51]["n_chars"] == 0
    assert found[None]["text"] == "without number without number without number"
    assert found[52]["text"] == found[53]["text"] == "Title & more\n\nOne two three\n\nFour five\n\nItem"  # articles that occur twice stay whole
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    assert {r["page_id"]: r for r in html.main_text(df).collect()} == found
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert html.main_text(df.limit(0)).count() == 0


def test_short_bodies_lose_their_furniture(spark):
    menu = "".join(f"<div>Entry {k} of a long list</div>" for k in range(14))
    table = [(k, f"http://h.org/a/{k}", f"{menu}<p>what only page number {k} says of itself</p><div>Call us now</div>") for k in range(6)]
    copies = [(10 + k, f"http://copy.org/{k}", f"{menu}<p>the same body on both pages</p>") for k in range(2)]
    df = spark.createDataFrame(table + copies, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html.main_text(df).collect()}
    assert all(found[k] == f"what only page number {k} says of itself" for k in range(6))
    assert all(found[k].endswith("the same body on both pages") for k in (10, 11))


def texts_by_hand(table):
    """Texts and numbers of deleted blocks, page by page over plain lists, with the textbook table of subsequences."""
    split = {}
    for k, (page_id, url, source) in enumerate(table):
        blocks = html.page_blocks(source or "")
        m = re.match(r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub(r":\d*$", "", re.sub(r"^.*@", "", m[1])).lower(), m[2]) if m else ("", re.match("[^?#]*", url or "")[0])
        split[k] = (host, path, -(2**63) if page_id is None else page_id, tuple(blocks))
    standing = {}
    for host, path, order, blocks in sorted(split.values(), key=lambda x: x[:3]):
        standing.setdefault((host, blocks), (host, path, order, blocks))
    ordered = sorted(standing.values(), key=lambda x: x[:3])
    gone = {}
    for n, (host, path, _, blocks) in enumerate(ordered):
        own = [(k, x) for k, (x, z) in enumerate(blocks) if z != html.KEPT]
        prose = [x for x, z in blocks if z == html.KEPT]
        near = [ordered[k] for k in (n - 1, n + 1) if 0 <= k < len(ordered) and ordered[k][0] == host]
        alike = lambda o: (len([1 for _ in itertools.takewhile(lambda x: x[0] == x[1], zip(path.split("/"), o[1].split("/")))]), len([1 for _ in itertools.takewhile(lambda x: x[0] == x[1], zip(path, o[1]))]))  # noqa: B023, E731
        for other in sorted(near, key=alike, reverse=True):
            theirs = [x for x, z in other[3] if z != html.KEPT]
            size = [[0] * (len(theirs) + 1) for _ in range(len(own) + 1)]
            for i, j in itertools.product(range(len(own)), range(len(theirs))):
                size[i + 1][j + 1] = size[i][j] + 1 if own[i][1] == theirs[j] else max(size[i][j + 1], size[i + 1][j])
            i, j, common = len(own), len(theirs), []
            while i and j:
                if own[i - 1][1] == theirs[j - 1]:
                    i, j = i - 1, j - 1
                    common.append(own[i])
                elif size[i - 1][j] >= size[i][j - 1]:
                    i -= 1
                else:
                    j -= 1
            number = lambda lines: sum(len(x.split()) for x in lines)
            rest = max(number(x for _, x in own), number(theirs)) - number(x for _, x in common)
            other_prose = [x for x, z in other[3] if z == html.KEPT]
            if prose != other_prose:
                rest += max(number(prose), number(other_prose))
            if rest > 3 or sum(len(x) for _, x in common) <= 0.8 * sum(len(x) for _, x in own):
                gone[host, blocks] = {k for k, _ in common}
                break
    for host, _, _, blocks in split.values():
        away = gone.get((host, blocks), set())
        yield "\n\n".join(x for k, (x, z) in enumerate(blocks) if k not in away and z != html.FURNISHING), len(away)


def test_texts_by_hand(spark):
    def page(k, body):
        notice = "".join(f"<div>Notice {x} to readers</div>" for x in range(k % 3 + 1))
        return f"<nav>Home page {k % 5}</nav>{notice}<p>{body}</p><div>Call us now</div><footer>Site of {k % 2}</footer>"

    table = [(k, f"http://u:p@H.org:80/{'abc'[k % 3]}/{k}?q", page(k, f"text number {k // 2} of its own kind, told at some length")) for k in range(60)]
    table += [(r[0], r[1], r[2]) for r in duckdb.sql(f"SELECT page_id + 1000000, url, html FROM '{SMALL}/pages.parquet'").fetchall()] + [(900_000, None, "<p>x"), (900_001, "no scheme", None)]
    found = {r["page_id"]: (r["text"], r["n_shared"]) for r in html.main_text(spark.createDataFrame(table, "page_id long, url string, html string")).collect()}
    wanted = dict(zip((t[0] for t in table), texts_by_hand(table)))
    assert found == wanted
    assert sum(n > 0 for _, n in wanted.values()) > 60  # differencing deletes blocks of many pages
    assert any("Notice" in "\n\n".join(x for x, _ in html.page_lines(t[2])) and "Notice" not in found[t[0]][0] for t in table[:60])  # and changes their texts


def test_copies_lose_their_furniture(spark):
    """A run of copies, exact ones, is compared with the next other page."""
    menu = "".join(f"<div>Entry {k} of a long list</div>" for k in range(9))
    table = [(k, f"http://h.org/a/{k:03}", f"{menu}<p>{'the same body' if 2 < k < 40 else f'another body number {k}'} with more words beside it</p>") for k in range(42)]
    found = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(table, "page_id long, url string, html string")).collect()}
    assert all(found[k] == ("the same body with more words beside it" if 2 < k < 40 else f"another body number {k} with more words beside it") for k in found) and len(found) == 42


def test_pages_of_one_address(spark):
    """Rows that repeat URL and page_id, or lack them, have a place of their own: the result does not depend on the number of ranges."""
    notice = "<div>We tell every reader the same long thing at the top</div>"
    table = [(None if k % 2 else 7, "http://h.org/same", f"{notice}<p>text {k} with many words of its own beside the notice</p>") for k in range(12)]
    table += [(None, None, f"{notice}<p>no address {k} but many words of its own too</p>") for k in range(5)] + [table[0]] * 3
    df = spark.createDataFrame(table, "page_id long, url string, html string")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in ("1", before, "23"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(rows(html.main_text(df)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] and len(found[0]) == len(table)
    assert not any("every reader" in str(r) for r in found[0])


def test_hostile_pages_take_linear_time():
    pages = ['<a "' * 250_000, "<div>" * 100_000 + "</section>" * 80_000, "<a" * 500_000, "<script>" + "</script" * 120_000, '<a b="x>' * 100_000, "<p>a<p>b" * 60_000, "<p " + "a " * 400_000 + ">x"]
    for source in pages:
        began = time.process_time()
        html.page_blocks(source)
        assert time.process_time() - began < 5, source[:20]
    a, b = ["a", "b"] * 2000, ["b", "a", "a"] * 1333
    began = time.process_time()
    assert len(html.common_subsequence(a, b)) > 2600 and time.process_time() - began < 2


# ---- 3 context-tree weighting


def test_canonical_bytes():
    data, ends = ctw.canonical([b"", b"  A b\n\tC ", b"x", b"   ", b" y"])
    pad = b"\n" * ctw.DEPTH
    assert bytes(data) == b"".join(pad + t for t in (b"\n", b"a b c\n", b"x\n", b"\n", b"y\n")) and ends[-1] == len(data)


def _tree(texts):
    keys, n = np.unique(ctw.grams(*ctw.canonical(texts))[0], return_counts=True)
    orders = []
    for d in range(ctw.DEPTH + 1):
        short, at = np.unique(keys & np.uint64(ctw._mask(d)), return_inverse=True)
        orders.append((short, np.bincount(at, n)))
    return ctw.weigh_tree(orders)


def test_tree_gives_probabilities():
    tree = _tree([b"abra cadabra abra", b"abba", b"cab cad"])
    for before in (b"abra c", b"zzzzzz", b"\n\n\n\nab", b" cadab"):
        context = sum(c << 8 * (k + 1) for k, c in enumerate(reversed(before)))
        keys = np.uint64(context) | np.arange(256, dtype=np.uint64)
        assert abs(np.exp(tree.log_probability(keys)).sum() - 1) < 1e-4


def test_tree_against_direct_recursion():
    texts = [b"abab abba baab", b"aab ab"]
    data, ends = ctw.canonical(texts)
    seen = collections.defaultdict(lambda: [0, 0])
    key, _ = ctw.grams(data, ends)
    for k in key.tolist():
        byte, past = k & 255, (k >> 8).to_bytes(ctw.DEPTH, "little")
        for bit in range(8):
            for d in range(ctw.DEPTH + 1):
                seen[past[:d], 1 << bit | byte >> 8 - bit][byte >> 7 - bit & 1] += 1

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(past, prefix):
        own = kt(*seen[past, prefix])
        if len(past) == ctw.DEPTH:
            return own, 1.0
        below = sum(weighted(p, q)[0] for p, q in list(seen) if q == prefix and len(p) == len(past) + 1 and p[:-1] == past)
        both = np.logaddexp(own, below)
        return both - math.log(2), math.exp(own - both)

    tree = _tree(texts)
    for k in set(key.tolist()):
        byte, past, total = k & 255, (k >> 8).to_bytes(ctw.DEPTH, "little"), 0.0
        for bit in range(8):
            prefix, p, left = 1 << bit | byte >> 8 - bit, 0.0, 1.0
            for d in range(ctw.DEPTH + 1):
                zeros, ones = seen[past[:d], prefix]
                stop = weighted(past[:d], prefix)[1]
                p += left * stop * (ones + 0.5) / (zeros + ones + 1)
                left *= 1 - stop
            total += math.log(p if byte >> 7 - bit & 1 else 1 - p)
        assert abs(total - tree.log_probability(np.asarray([k], np.uint64))[0]) < 1e-4


def test_scores(spark, make_docs):
    texts = [(k, f"The cat number {k % 5} sat on the mat. " * (k % 4)) for k in range(40)] + [(90, None), (91, ""), (92, " \t "), (40, "the"), (40, "the")]
    found = ctw.score_documents(make_docs(texts)).collect()
    assert len(found) == len(texts)
    held = lambda k: zlib.crc32(str(k).encode()) % 7 == 2
    count = collections.Counter()
    for k, t in texts:
        if not held(k):
            count.update([*words(t), "\n"])
    n, v = sum(count.values()), len(count)
    own = {k: t for k, t in texts}
    for r in found:
        tokens = [*words(own[r["doc_id"]]), "\n"]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(r["doc_id"]), len(tokens), sum(count[w] > 0 for w in tokens), n)
        assert abs(r["base_score"] - sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens)) < 1e-6
        assert r["score"] < 0
    assert ctw.score_documents(make_docs([])).count() == 0


def test_scores_of_hot_ids_and_long_texts(spark, make_docs):
    """One id, or none, for most rows; equal rows score alike, whatever chunk they fall into."""
    texts = [(None, f"word number {k % 7} of many") for k in range(60)] + [(7, f"word number {k % 7} of many") for k in range(60)] + [(8, "very long text " * 40_000), (9, "x" * 300_000)]
    found = ctw.score_documents(make_docs(texts), chunk_bytes=4096).collect()
    assert len(found) == len(texts)
    by = collections.defaultdict(set)
    for r in found:
        by[r["doc_id"], r["n_tokens"], round(r["base_score"], 6)].add(round(r["score"], 3))
    assert all(len(v) <= 7 for v in by.values()) and {r["n_tokens"] for r in found if r["doc_id"] in (8, 9)} == {120_001, 2}


def test_scores_use_every_context(spark, make_docs):
    """More grams than any one table held before; the whole tree weighed in one place says the same."""
    random = np.random.default_rng(7)
    texts = [(k, bytes(random.integers(97, 123, 7000, np.uint8)).decode() + " the end") for k in range(80)]
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in texts}
    tree = _tree([t.encode() for k, t in texts if not held[k]])
    found = {r["doc_id"]: r["score"] for r in ctw.score_documents(make_docs(texts)).collect()}
    for k, t in texts:
        own = tree.log_probability(ctw.grams(*ctw.canonical([t.encode()]))[0]).sum() / math.log(10)
        assert abs(found[k] - own) < 1e-5 * abs(own), (k, held[k])


# ---- 4 packing


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), max_size=6), st.integers(0, 60))
@settings(max_examples=150, deadline=None)
def test_fullest_combination(counts, room):
    found = packing.fullest(counts, room)
    total = sum(x * n for x, n in found.items())
    pieces = [x for x, n in counts.items() for _ in range(n)]
    best = max(s for s in (sum(c) for k in range(len(pieces) + 1) for c in set(itertools.combinations(pieces, k))) if s <= room) if len(pieces) < 13 else total
    assert total == best and all(n <= counts[x] for x, n in found.items())


def test_packing(spark, make_docs):
    from tokenizers import Tokenizer

    texts = [(k, "word " * (k * 13 % 700)) for k in range(60)] + [(70, None), (71, ""), (72, "it's We'LL don''t ²½ x1"), (73, "漢字 İ é"), (74, "<|endoftext|> a\x1cb"), (75, "long " * 5000), (72, "it's We'LL don''t ²½ x1")]
    found = packing.pack_documents(make_docs(texts), packing.default_tokenizer()).collect()
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    wanted = collections.Counter()
    for k, t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            wanted[k, n, at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == wanted
    by = collections.defaultdict(list)
    for r in found:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= math.ceil(sum(r["length"] for r in found) / 2048) + 1
    assert packing.pack_documents(make_docs([]), packing.default_tokenizer()).count() == 0


@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from("'stremvld 19\t\n.-_")), max_size=40), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_word_tokens_are_the_tokenizer(tokens4, texts):
    assert tokens4.splits
    assert [np.frombuffer(x, "<i4").tolist() for x in tokens4.encode(texts)] == [e.ids for e in tokens4.tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def tokens4():
    return packing.WordTokens(packing.default_tokenizer())


def test_other_word_splits_go_to_the_tokenizer_whole(tmp_path):
    import json

    with open(packing.default_tokenizer(), encoding="utf-8") as f:
        stated = json.load(f)
    stated["pre_tokenizer"] = {"type": "WhitespaceSplit"}
    (tmp_path / "other.json").write_text(json.dumps(stated), encoding="utf-8")
    other = packing.WordTokens(str(tmp_path / "other.json"))
    texts = ["it's 22 (a)", "plain words"]
    assert not other.splits and [np.frombuffer(x, "<i4").tolist() for x in other.encode(texts)] == [e.ids for e in other.tokenizer.encode_batch(texts, add_special_tokens=False)]


# ---- 5 embeddings, 6 search


def _vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16))
    data = [(k, (centres[k % 12] + 0.22 * rng.standard_normal(16)).tolist(), k % 2) for k in range(240)]
    data += [(300 + k, data[k][1], data[k][2]) for k in range(0, 40, 3)]  # copies
    data += [(400, None, 1), (401, [0.0] * 16, 1), (402, [math.nan] * 16, 1), (403, [math.inf] + [1.0] * 15, 1), (404, [None] + [1.0] * 15, 1), (405, data[0][1], None), (406, [1.0, 2.0], 0), (407, [1.0, 2.0], 0), (408, [], 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "vec_id long, embedding array<float>, label int, key string, rep int")
    return data, df


def test_embedding_links(spark):
    data, df = _vectors(spark)
    good = {k: (np.asarray(np.asarray(v, np.float32), np.float64), y) for k, v, y in data if v and y is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = collections.defaultdict(set)
    for (a, (x, p)), (b, (y, q)) in itertools.combinations(good.items(), 2):
        if p == q and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
            links[a].add(b)
            links[b].add(a)
    assert 200 < sum(map(len, links.values()))

    def reach(k):
        found, todo = {k}, [k]
        while todo:
            for n in links[todo.pop()] - found:
                found.add(n)
                todo.append(n)
        return min(found)

    wanted = {k: (len(links[k]), reach(k)) for k, _, _ in data}
    for chunk_rows in (2048, 60, 20, 4):  # one coordinate a block, two, three, and crowded cells
        found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_duplicates(df, chunk_rows=chunk_rows).collect()}
        assert found == wanted
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0
    again = embed_dedup.near_duplicates(df.where("vec_id in (1, 13)").union(df.where("vec_id = 1")).union(df.where("vec_id = 1").selectExpr("cast(null as long)", "embedding", "label", "key", "rep"))).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in again if r["vec_id"] != 13) == [("1", 1 + (13 in links[1]), "1")] * 2 + [("None", 0, "None")]


def test_search(spark):
    data, df = _vectors(spark)
    floor = {k: np.floor(256 * np.asarray(np.asarray(v, np.float32), np.float64)) for k, v, _ in data if v and all(x is not None and math.isfinite(x) for x in v)}
    found = topk.exact_top_k(df, df.where("vec_id % 50 = 0"), shard_rows=40, fan_in=2).collect()
    wanted = []
    for q in (k for k in floor if k % 50 == 0):
        scored = sorted((-int(floor[q] @ floor[c]), c) for c in floor if c != q and len(floor[c]) == len(floor[q]))[:5]
        wanted += [(q, r, c, -s) for r, (s, c) in enumerate(scored, 1)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == sorted(wanted)
    assert topk.exact_top_k(df.limit(0), df.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, [9.0, 9.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    again = topk.exact_top_k(odd, odd.where("vec_id = 0 or vec_id is null"), k=3).collect()
    # a null id takes no part; the two vectors of id 0 are one query; repeated candidates are separate
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in again) == [(0, 1, 1, 65536), (0, 2, 1, 65536), (0, 3, 2, 65536)]


# ---- 7 merge-dropout


@pytest.fixture(scope="module")
def tokenizers7():
    return dropout_bpe.MergeDropout(dropout_bpe.default_model(), 0.0, 1), dropout_bpe.MergeDropout(dropout_bpe.default_model(), 0.2, 1)


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_dropout_is_lossless(tokenizers7, text):
    for t in tokenizers7:
        ids = np.frombuffer(t.encode([3], [text])[0], "<i4").tolist()
        assert t.decode(ids) == text


def test_no_dropout_is_the_library(tokenizers7):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=dropout_bpe.default_model())
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SMALL}/documents.parquet'").fetchall()] + ["a  b", "x" * 300, "漢字\n\té"]
    assert [np.frombuffer(b, "<i4").tolist() for b in tokenizers7[0].encode(list(range(len(texts))), texts)] == sp.encode(texts, num_threads=1)


def merged_by_hand(t, key, segment):
    """The agenda stated plainly: of all neighbours that make a piece and are not skipped, the best and then the first merges."""
    symbols = [(k, "▁" if c == " " else c) for k, c in enumerate(segment)]
    while True:
        offers = []
        for n, ((i, a), (_, b)) in enumerate(zip(symbols, symbols[1:])):
            k = t.ids.get(a + b)
            if k is not None and not dropout_bpe._mix(key ^ (i * 0xD6E8FEB86659FD93 + k & (1 << 64) - 1)) < t.limit:
                offers.append((int(t.rank[k]), i, n))
        if not offers:
            return [t.ids[s] for _, s in symbols]
        n = min(offers)[2]
        symbols[n : n + 2] = [(symbols[n][0], symbols[n][1] + symbols[n + 1][1])]


def test_dropout_against_the_plain_agenda(tokenizers7):
    t = tokenizers7[1]
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice("internationalization the of there different water understanding a".split(), 30)) for _ in range(12)]
    for _ in range(2):  # the second time from the tables
        for doc, coded in enumerate(t.encode(list(range(12)), texts)):
            wanted, of_text = [], dropout_bpe._mix(doc ^ dropout_bpe._mix(t.seed + 0x2545F491))
            for number, word in enumerate(texts[doc].split(" ")):
                key = dropout_bpe._mix(of_text + dropout_bpe._mix(number) & (1 << 64) - 1)
                wanted += merged_by_hand(t, key, " " + word)
            assert np.frombuffer(coded, "<i4").tolist() == wanted


def test_dropout_varies_and_repeats(spark, make_docs, tokenizers7):
    t = tokenizers7[1]
    text = "internationalization " * 400
    a, b, again = t.encode([1], [text])[0], t.encode([2], [text])[0], t.encode([1], [text])[0]
    assert a != b and a == again
    ids, ways = np.frombuffer(a, "<i4").tolist(), set()
    while ids:  # words open with the pieces that start with a space
        n = next((k for k in range(1, len(ids)) if t.surface[ids[k]].startswith(b" ")), len(ids))
        ways.add(tuple(ids[:n]))
        ids = ids[n:]
    assert len(ways) > 40  # every occurrence draws for itself
    some = [" " + w for w in "internationalization the of, word. über x 12345 a-b".split()] + ["   "]
    keys = np.arange(1, len(some) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    end = np.cumsum([len(w) for w in some])
    flat, counts = t.code(keys, code_points(some), np.append(0, end[:-1]), end)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [np.frombuffer(t._agenda(int(k), w), "<i4").tolist() for k, w in zip(keys, some)]
    docs = make_docs([(1, text), (1, text), (2, None), (3, ""), (None, "▁ odd ▁▁"), (4, "y" * 20000)])
    coded = dropout_bpe.encode_documents(docs, dropout_bpe.default_model())
    assert all(r["lossless"] for r in coded.collect()) and len({tuple(r["ids"]) for r in coded.where("doc_id = 1").collect()}) == 1
    assert sorted(r["text"] for r in dropout_bpe.decode_documents(coded, dropout_bpe.default_model()).collect()) == sorted(r["text"] or "" for r in docs.collect())
    assert dropout_bpe.encode_documents(make_docs([]), dropout_bpe.default_model()).count() == 0
    assert dropout_bpe.decode_documents(coded.limit(0), dropout_bpe.default_model()).count() == 0


# ---- 8 toxicity, 9 quality


def test_ordinal_regression_recovers_order():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 3))
    grade = np.digitize(x @ [2.0, -1.0, 0.0] + 0.3 * rng.standard_normal(600), [-1.0, 0.5, 2.0])
    r, c = np.divmod(np.arange(1800), 3)
    w, theta = toxicity.fit_cumulative_link(r, c, x.ravel(), grade, 3, 4)
    assert (np.diff(theta) > 0).all() and w[0] > 1 > 0 > w[1] and abs(w[2]) < 0.5
    expected = toxicity._sigmoid((x @ w)[:, None] - theta).sum(1)
    assert (np.rint(expected) == grade).mean() > 0.7


def _labelled(spark, make_docs):
    rng = np.random.default_rng(5)
    plain = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"]
    text = lambda bad, junk: " ".join(("grubblo" + rng.choice(["a", "en", "us"])) if bad and rng.random() < 0.2 else "".join(rng.choice(list("qzxj#$"), 7)) if junk else rng.choice(plain) for _ in range(60))
    table = [(k, text(k % 5 == 0, k % 4 == 1)) for k in range(200)] + [(900, None), (901, ""), (None, "alpha beta gamma"), (902, "alpha " * 30000)]
    labels = [(k, int(k % 4 != 1), int(k % 5 == 0), "x") for k in range(0, 200, 2)] + [(k, int(k % 4 != 1), int(k % 5 == 0), "x") for k in range(1, 100, 2)] + [(None, 1, 1, "x"), (3, None, None, "x")]
    return make_docs(table), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, y string")


def test_toxicity(spark, make_docs):
    docs, labels = _labelled(spark, make_docs)
    found = {r["doc_id"]: r for r in toxicity.severity(docs, labels).collect()}
    assert all(found[k]["toxic"] == (k % 5 == 0) for k in range(200))
    assert not found[900]["toxic"] and not found[901]["toxic"] and not found[None]["toxic"] and not found[902]["toxic"]
    assert min(found[k]["severity"] for k in range(0, 200, 5)) > max(found[k]["severity"] for k in range(200) if k % 5)
    kept = toxicity.keep_civil(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 160 + 4
    assert toxicity.severity(docs, labels.limit(0)).where("toxic").count() == 0
    twice = toxicity.severity(docs.union(docs.where("doc_id < 20")), labels).where("doc_id < 20").groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("severity").alias("k")).collect()
    assert all((r["n"], r["k"]) == (2, 1) for r in twice) and len(twice) == 20
    assert toxicity.severity(docs.limit(0), labels).count() == 0


def test_quality(spark, make_docs):
    docs, labels = _labelled(spark, make_docs)
    found = {r["doc_id"]: r for r in quality.resample(docs, labels).collect()}
    assert all(found[k]["kept"] == (k % 4 != 1) for k in range(200))
    assert not found[900]["kept"] and not found[901]["kept"] and found[None]["kept"] and found[902]["kept"]
    kept = quality.keep_drawn(docs, labels)
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == sorted(str(k) for k, r in found.items() if r["kept"])
    assert quality.resample(docs, labels, size=17).where("kept").count() == 17
    assert quality.resample(docs, labels.limit(0)).where("kept").count() == 202
    assert quality.resample(docs.limit(0), labels).count() == 0


def test_quality_counts_every_occurrence(spark, make_docs):
    texts = [(1, "spam " * 500 + "end"), (2, "good words here " * 100), (3, None)]
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    model, _ = quality.fit(make_docs(texts), labels, buckets=1 << 12)
    raw, target = np.ones(1 << 12), np.ones(1 << 12)
    for k, t in texts:
        own = np.log2(1 + np.bincount(quality.ngram_buckets([(t or "").encode()], 1 << 12)[0], minlength=1 << 12))
        raw += own
        target += own * (k == 2)
    assert np.allclose(model.ratio, np.log(target / target.sum()) - np.log(raw / raw.sum()), atol=1e-5)


def weights_by_hand(texts, labels, buckets=1 << 17):
    """log_weight of the query's options by one dictionary of counts a model."""
    grams = {i: collections.Counter(quality.ngram_buckets([(t or "").encode()], buckets)[0].tolist()) for i, t in texts}
    raw, target = collections.Counter(), collections.Counter()
    for i, own in grams.items():
        assert sum(own.values()) == max(0, 2 * len(words(dict(texts)[i])) - 1)  # words and pairs, repeats included
        raw.update(own)
        if labels.get(i) == 1:
            target.update(own)
    r, t = sum(raw.values()) + buckets, sum(target.values()) + buckets
    ratio = {g: math.log((target[g] + 1) / t) - math.log((raw[g] + 1) / r) for g in raw}
    return {i: sum(n * ratio[g] for g, n in own.items()) / math.sqrt(sum(own.values())) if own else None for i, own in grams.items()}


def test_resampling_by_hand(spark, make_docs):
    """Weights, draw and size of the query's options, on whole small tables."""
    texts = [(r[0], r[1]) for r in duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()] + [(10**7, "spam " * 5000), (10**7 + 1, None)]
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SMALL}/labels.parquet' WHERE quality IS NOT NULL").fetchall())
    found = {r["doc_id"]: r for r in quality.resample(make_docs(texts), spark.read.parquet(f"{SMALL}/labels.parquet"), **quality.SAMPLING).collect()}
    wanted = weights_by_hand(texts, labels)
    assert all((found[i]["log_weight"] is None) == (w is None) and (w is None or abs(found[i]["log_weight"] - w) < 1e-3) for i, w in wanted.items())
    some = [r for r in found.values() if r["key"] is not None]
    n = math.ceil(len(some) * sum(y == 1 for y in labels.values()) / len(labels))
    edge = sorted((r["key"] for r in some), reverse=True)[n - 1]
    assert all(r["kept"] == (r["key"] is not None and r["key"] >= edge - 1e-5) for r in found.values())
    kept = quality.keep_drawn(make_docs(texts), spark.read.parquet(f"{SMALL}/labels.parquet"), **quality.SAMPLING)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in found.items() if r["kept"])


def test_gumbel_top_k_draws_by_weight():
    """Inclusion rates over many seeds against the exact ones of drawing two of four by weight without replacement."""
    weight = np.log([1.0, 2.0, 3.0, 4.0])
    p = np.exp(weight) / np.exp(weight).sum()
    exact = p + np.asarray([sum(p[j] * p[i] / (1 - p[j]) for j in range(4) if j != i) for i in range(4)])
    drawn = np.zeros(4)
    for seed in range(20_000):
        drawn[np.argsort(weight + quality.gumbel(np.arange(4), seed))[-2:]] += 1
    assert np.abs(drawn / 20_000 - exact).max() < 0.015


def test_kth_largest(spark):
    rng = np.random.default_rng(6)
    values = np.concatenate((rng.standard_normal(500) * 100, np.zeros(5)))
    df = spark.createDataFrame([(float(v),) for v in values], "key double")
    for k in (1, 7, 250, 255, 505):
        edge = quality.kth_largest_key(df, k)
        assert edge == int(np.trunc(np.sort(values)[-k] * 2**20)) + (1 << 60)


# ---- 10 near-duplicates


def brute_force(table, per_cent):
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := words(t)) else frozenset() for _, t in table]
    up = list(range(len(table)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(table)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= per_cent * (len(sets[i]) + len(sets[j]) - both):
            up[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(table):
        least[root(k)] = min(least.get(root(k), i), i)
    return {i: (len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(table)}


def near_table():
    rng = np.random.default_rng(7)
    vocabulary = [f"w{k}" for k in range(400)]
    base = rng.choice(vocabulary, 120).tolist()
    table = []
    for k in range(90):  # variants of one text: like the text itself, often not like each other
        own = list(base)
        for at in rng.choice(120, rng.integers(0, 4), replace=False):
            own[at] = f"v{k}_{at}"
        table.append((1000 - k, " ".join(own)))
    drift = list(base)
    for k in range(60):  # a chain in which neighbours are alike and ends are not
        drift[k * 2 % 120] = f"d{k}"
        table.append((2000 + k * 7 % 60, " ".join(drift)))
    for k in range(60):
        table.append((3000 + k, " ".join(rng.choice(vocabulary, 30))))
    table += [(4000 + k, table[k * 3][1].upper()) for k in range(30)]  # copies
    table += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "a b"), (5004, "A  b"), (5005, "a b c"), (5006, "x " * 30000), (5007, "x " * 29000)]
    return table


def test_near_duplicates(spark, make_docs):
    table = near_table()
    wanted = brute_force(table, 85)
    assert len({c for _, c in wanted.values()}) < len(table) - 60
    for tile_rows in (1024, 8):
        found = minhash.near_duplicates(make_docs(table), tile_rows=tile_rows).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == wanted
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    with_null = make_docs([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")])
    assert sorted(str(r["component_id"]) for r in minhash.near_duplicates(with_null).collect()) == ["1", "1", "None"]
    assert minhash.near_duplicates(make_docs([])).count() == 0


def crowd_table(size):
    """Variants of one text, a third near it and the others far from all but one, with which some are linked."""
    rng = np.random.default_rng(size)
    base = [f"w{k}" for k in range(150)]
    for k in range(size):
        own = list(base)
        for at in rng.choice(150, rng.integers(5, 9) if k % 3 else 1, replace=False):
            own[at] = f"v{k}_{at}"
        yield 2 * k, " ".join(own)
        for at in rng.choice(150, rng.integers(0, 3) if k % 3 else 0, replace=False):
            own[at] = f"u{k}_{at}"
        yield 2 * k + 1, " ".join(own)


def test_crowded_buckets_cost_no_square(spark, make_docs, monkeypatch):
    put, dealt = minhash.Scratch.put, []

    def counted(self, df):
        out = put(self, df)
        if out.columns[:3] == ["band", "x", "y"] and "part" in out.columns and "sig" not in out.columns:
            dealt.append(out.count())
        return out

    monkeypatch.setattr(minhash.Scratch, "put", counted)
    made = []
    for size in (40, 160):
        table = list(crowd_table(size))
        dealt.clear()
        found = minhash.near_duplicates(make_docs(table), tile_rows=16).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_force(table, 85)
        made.append(dealt[0])
    assert made[1] <= 6 * made[0], made  # four times the documents


def test_variants_meet_at_their_base(spark, make_docs, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(150)]
    table = [(900, " ".join(base))]
    for k in range(60):  # each is linked with the base, which has the largest id, and mostly with no other
        own = list(base)
        for at in (10 + k, 80 + rng.integers(60)):
            own[at] = f"v{k}_{at}"
        table.append((k, " ".join(own)))
    put, dealt = minhash.Scratch.put, []

    def counted(self, df):
        out = put(self, df)
        if out.columns[:3] == ["band", "x", "y"] and "part" in out.columns:
            dealt.append(out.count())
        return out

    monkeypatch.setattr(minhash.Scratch, "put", counted)
    for tile_rows in (1024, 16):
        dealt.clear()
        found = minhash.near_duplicates(make_docs(table), tile_rows=tile_rows).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_force(table, 85)
        assert max(dealt) <= len(table), dealt


def test_texts_that_are_not_wanted_are_not_shuffled(spark, make_docs):
    docs = make_docs([(k, f"a b c d e f {k}") for k in range(3000)] + [(None, "a b"), (7, "a b c d e f 7")])
    wanted = docs.where("doc_id % 100 = 7").select("doc_id").distinct()
    near, far = (minhash.perhaps_among(docs, wanted, "doc_id", among) for among in (True, False))
    assert near.count() + far.count() == docs.count() and far.where("doc_id % 100 = 7").count() == 0 and near.count() <= 40
    assert near.where("doc_id % 100 = 7").count() == 31 and near.columns == far.columns == docs.columns
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many wanted ids
        sets = minhash._sets_of(wanted, docs.select("doc_id", "text"))
        plan = sets._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")
        assert sorted(r["doc_id"] for r in sets.collect()) == sorted([7, *range(7, 3000, 100)])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_prefixes_keep_every_link():
    rng = np.random.default_rng(3)
    for per_cent in (80, 85, 100):
        for n, m in rng.integers(1, 400, (4000, 2)).tolist():
            both = -(-per_cent * (n + m) // (100 + per_cent))
            if both <= min(n, m):  # the least that links them: what is left out of each is less than that
                firsts = [dict(minhash.prefixes(x, per_cent))[minhash._size_class(y)] for x, y in ((n, m), (m, n))]
                assert n - firsts[0] < both and m - firsts[1] < both


def test_bayes_thresholds():
    for n, least in minhash.least_matches(0.85, 1e-6):
        tail = lambda m: sum(math.comb(n + 1, i) * 0.85**i * 0.15 ** (n + 1 - i) for i in range(m + 1))  # noqa: B023, E731
        assert tail(least) >= 1e-6 and (least == 0 or tail(least - 1) < 1e-6)
