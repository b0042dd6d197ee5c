"""The corpus operators against brute force, on small tables with nulls, ties, repeats and odd columns."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import chat, decontamination, extraction, fingerprints, packing, quality, sharding, simhash, substrings, toxicity
from tidemark.llm.graph import components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, bucket string, h string"


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", None, None if t is None else len(t), 1, "b", "h") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n, words=40):
    draw = random.Random(seed)
    return " ".join(draw.choice([f"w{i}" for i in range(words * 50)]) for _ in range(n))


COPY = prose(1, 120)
TEXTS = [None, "", "   ", "one", "A b\tc\nd", COPY, COPY, COPY.upper(), prose(2, 60) + " " + prose(3, 50), prose(4, 9) + "\n" + prose(3, 50),
         "a " * 200, "é´ß 日本語 " * 30, prose(5, 30000)]
IDS = [5, None, 3, 3, 8, 20, 21, None, 40, 41, 42, 43, 44]


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, TEXTS, IDS)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_shards_are_even_and_positions_gapless(docs, none):
    rows = sharding.shard_rows(docs).collect()
    assert len(rows) == len(TEXTS) and sum(r.size for r in rows) == sum(len((t or "").encode()) + 1 for t in TEXTS)
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert {r.text_crc32 for r in rows} == {zlib.crc32((t or "").encode()) for t in TEXTS}
    assert sharding.shard_rows(none).count() == 0


def test_growing_a_map_evens_it_out_and_moves_little(spark):
    sizes = spark.range(64).select(F.col("id").cast("int").alias("vslot"), F.lit(10).cast("long").alias("bytes"))
    first = sharding.first_map(spark, 4, 64)
    before = {r.vslot: r.shard for r in first.collect()}
    after = {r.vslot: r.shard for r in sharding.rebalance(first, sizes, 5).collect()}
    assert sum(after[s] != before[s] for s in before) <= 16  # what the old shards hold above the mean
    loads = [sum(v == s for v in after.values()) for s in range(5)]
    assert max(loads) - min(loads) <= 1


def windows_hit(text, items, n=10):
    words = decontamination.words_of((text or "").encode())
    hit, names = set(), set()
    for name, item in items:
        phrase = decontamination.words_of((item or "").encode())
        for i in range(max(1, len(phrase) - n + 1)) if phrase else ():
            part = phrase[i : i + n]
            for j in range(len(words) - len(part) + 1):
                if words[j : j + len(part)] == part:
                    hit.update(range(j, j + len(part)))
                    names.add(name)
    return len(words), sorted(hit), sorted(names)


def test_passages_are_found_as_by_comparing_all_windows(spark, none):
    items = [("7", prose(7, 25)), ("8", "Tiny, item"), ("9", None), ("10", "..."), ("7", prose(8, 12)), ("11", "aa bb " * 12)]
    texts = [None, "", prose(7, 25).upper(), "x " + prose(7, 14) + " y", "a TINY item! tiny\nitem", "aa bb " * 40, prose(8, 12) + " " + prose(7, 25), prose(9, 300)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    docs = frame(spark, texts)
    want = {i: windows_hit(t, items) for i, t in enumerate(texts)}
    for block, shard in ((1 << 20, 1 << 20), (100, 64)):
        for r in decontamination.find_passages(docs, bench, block_bytes=block, shard_bytes=shard).collect():
            n, hit, names = want[r.doc_id]
            spans = [p for a, b in zip(r.bench_spans[::2], r.bench_spans[1::2], strict=True) for p in range(a, b)]
            assert (r.bench_words, spans, r.bench_items) == (n, hit, names)
    cut = {r.doc_id: r for r in decontamination.remove_passages(docs, bench).collect()}
    assert cut[0].text is None and cut[3].text == "x  y" and cut[3].n_chars == 4 and cut[7].text == texts[7]
    assert decontamination.find_passages(none, bench).count() == 0
    assert decontamination.find_passages(docs, bench.limit(0)).where(F.size("bench_spans") > 0).count() == 0


def test_items_without_id_are_cut_but_not_named(spark):
    bench = spark.createDataFrame([("7", prose(7, 25)), (None, prose(8, 12))], "item_id string, text string")
    docs = frame(spark, [prose(8, 12) + " " + prose(7, 25), prose(8, 12), "x"])
    for block in (1 << 20, 100):
        rows = {r.doc_id: r for r in decontamination.find_passages(docs, bench, block_bytes=block).collect()}
        assert [rows[i].bench_items for i in range(3)] == [["7"], [], []]
        assert rows[0].bench_spans == [0, 37] and rows[1].bench_spans == [0, 12] and rows[2].bench_spans == []
    assert {r.doc_id: r.text for r in decontamination.remove_passages(docs, bench).collect()} == {0: "", 1: "", 2: "x"}


def test_fm_index_counts_and_locates():
    draw = np.random.default_rng(3)
    symbols = draw.integers(0, 4, 400)
    index = decontamination.FMIndex(symbols, 4)
    for length in (1, 2, 5):
        for start in range(0, 390, 13):
            phrase = symbols[start : start + length]
            lo, hi = index.search(phrase[None, :], np.array([length]))
            want = [i for i in range(len(symbols) - length + 1) if (symbols[i : i + length] == phrase).all()]
            assert sorted(index.locate(np.arange(lo[0], hi[0]))) == want


def test_pieces_hold_every_token_once_and_fill_sequences(docs, none):
    path, ranks = packing.tokenizer_path(), packing.tokenizer_path(packing.RANKS)
    rows = packing.pack(docs, path, ranks, sequence=256).collect()
    exact = packing.Tokens(path, None)
    want = sorted((len(ids) // 4, zlib.crc32(ids[:1024])) for ids in (exact.encode(t or "") + (1).to_bytes(4, "little") for t in TEXTS))
    assert sorted((r.doc_tokens, r.ids_crc32) for r in rows if r.start == 0) == want
    assert sum(r.length for r in rows) == sum(n for n, _ in want)
    for number in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == number), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    assert packing.pack(none, path, ranks).count() == 0


def test_histogram_packing_places_every_length():
    draw = random.Random(1)
    counts = {n: draw.randint(1, 50) for n in draw.sample(range(1, 2049), 300)}
    packs = packing.pack_histogram(counts)
    placed: dict[int, int] = {}
    for n, pattern in packs:
        assert sum(pattern) <= 2048
        for length in pattern:
            placed[length] = placed.get(length, 0) + n
    assert placed == counts
    assert sum(n for n, _ in packs) <= 1.05 * sum(k * v for k, v in counts.items()) / 2048 + 1


@pytest.mark.parametrize("counts", [{300: 600_000}, {1000: 7}, {2048: 3, 1500: 2, 300: 100_001, 7: 5}, {1: 5000}])
def test_equal_lengths_share_packs(counts):
    packs = packing.pack_histogram(counts)
    placed: dict[int, int] = {}
    for n, pattern in packs:
        assert sum(pattern) <= 2048
        for length in pattern:
            placed[length] = placed.get(length, 0) + n
    assert placed == counts
    assert sum(n for n, _ in packs) <= sum(-(-n // (2048 // length)) for length, n in counts.items())


def test_tokens_by_ranks_equal_those_of_the_tokenizer():
    fast = packing.Tokens(packing.tokenizer_path(), packing.tokenizer_path(packing.RANKS))
    draw = random.Random(4)
    plain = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(161, 592))]
    for text in ["".join(draw.choices(plain, k=50)) for _ in range(500)] + ["a<|endoftext|>b", "\x85\x1c 日本 🙂", " \n\n  x"]:
        assert fast.encode(text) == fast.whole(text)


def test_chat_windows_read_back_whole(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    turns = [(1, 0, "system", "rules <\\|x|>"), (1, 1, "user", None), (1, 2, "assistant", said), (1, 3, "user", prose(1, 200)), (1, 4, "assistant", prose(2, 300)),
             (1, 5, "assistant", ""), (2, 0, None, "x"), (None, 0, "assistant", "lone"), (None, None, "user\nodd", "<|<\\|"), (3, 1, "assistant", "b"), (3, 1, "assistant", "b")]
    df = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn int, role string, text string, tokens string")
    for budget in (64, 700, 100_000):
        windows = chat.format_windows(df, packing.tokenizer_path(), budget=budget)
        for r in chat.read_back(windows).collect():
            mine = sorted(((t, ro, x) for c, t, ro, x in turns if c == r.conv_id), key=lambda x: [(v is not None, v or 0) if k == 0 else (v is not None, v or "") for k, v in enumerate(x)])
            loss = "".join(x or "" for _, ro, x in mine if ro == "assistant")
            assert r.n_turns == len(mine)
            assert r.turns_sha256 == hashlib.sha256("".join(f"{ro or ''}\n{x or ''}\n" for _, ro, x in mine).encode()).hexdigest()
            assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        for w in windows.where("window > 0 and conv_id = 1").collect():
            assert w.formatted.startswith("<|im_start|>system") and w.repeated_turns >= 1
    assert chat.format_windows(df.limit(0), packing.tokenizer_path()).count() == 0


def brute_components(prints, distance=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(prints))]


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components_equal_those_of_all_pairs(spark, docs, none):
    texts = [t for t in TEXTS[:12]] + [COPY + " extra", COPY.replace(COPY.split()[50], "zz")]
    rows = simhash.near_duplicates(frame(spark, texts)).collect()
    prints = [plain_simhash(t) for t in texts]
    assert {r.doc_id: r.fp % (1 << 64) for r in rows} == dict(enumerate(prints))
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(brute_components(prints)))
    kept = simhash.drop_near_duplicates(docs).collect()
    assert len(kept) == len({r.component_id for r in rows if r.doc_id < 12}) + 1  # the long text too
    assert all(r.doc_id is not None for r in kept) and simhash.drop_near_duplicates(none).count() == 0


def test_crowded_keys_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "SMALL", 4)
    draw = random.Random(5)
    centre = draw.getrandbits(64)
    prints = list({centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 6))) for _ in range(120)} | {draw.getrandbits(64) for _ in range(50)})
    signed = np.array(prints, dtype=np.uint64).view(np.int64)
    over = simhash._link_keys(np.zeros(len(prints), dtype=np.int64), np.array(prints, dtype=np.uint64), 4)[2]
    assert over == [(0, len(prints))]
    found = components(simhash.find_links(spark.createDataFrame([(int(p),) for p in signed], "fp long"))).collect()
    group = {r.node: r.root for r in found}
    want = brute_components(prints)
    for i in range(len(prints)):
        for j in range(i):
            same = group.get(int(signed[i]), i) == group.get(int(signed[j]), j)
            assert same == (want[i] == want[j])


def test_golay_keys_meet_within_four_bits():
    draw = random.Random(2)
    for _ in range(1500):
        a = draw.getrandbits(64)
        b = a ^ sum(1 << i for i in draw.sample(range(64), draw.randint(0, 4)))
        row, key = simhash.fuzzy_keys(np.array([a, b], dtype=np.uint64))
        assert set(key[row == 0]) & set(key[row == 1])


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 130)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(41)} | {j: 100 for j in range(100, 130)}


def cut_by_brute_force(texts, n):
    words = [(t or "").encode().split() for t in texts]
    starts: dict[tuple, int] = {}
    for w in words:
        for i in range(len(w) - n + 1):
            starts[tuple(w[i : i + n])] = starts.get(tuple(w[i : i + n]), 0) + 1
    out = []
    for w in words:
        gone = {p for i in range(len(w) - n + 1) if starts[tuple(w[i : i + n])] > 1 for p in range(i, i + n)}
        out.append(b" ".join(x for p, x in enumerate(w) if p not in gone).decode() if gone else None)
    return out


def test_repeated_passages_go_everywhere(docs, none):
    want = cut_by_brute_force(TEXTS, substrings.WINDOW)
    got = sorted((str(r.text), r.n_chars) for r in substrings.remove_repeats(docs).collect())
    assert got == sorted((str(t if w is None else w), (None if t is None else len(t)) if w is None else len(w)) for t, w in zip(TEXTS, want, strict=True))
    assert substrings.remove_repeats(docs).columns == docs.columns and substrings.remove_repeats(none).count() == 0


@pytest.mark.parametrize("crowd", [substrings.CROWD, 8, 0])
def test_small_automata_and_buckets_give_the_same(spark, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "CROWD", crowd)  # anchors above it are settled window by window
    texts = [prose(i % 5, 80) + " " + prose(100 + i, 30) + " " + prose(i % 3 + 50, 36) for i in range(30)]

    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("doc_id", LongType()), StructField("kept", StringType())])

    def finish(body, words, cut):
        return (b" ".join(w for w, c in zip(words, cut, strict=True) if not c).decode(),)

    want = {i: w if w is not None else " ".join(t.split()) for i, (t, w) in enumerate(zip(texts, cut_by_brute_force(texts, 35), strict=True))}
    assert {r.doc_id: r.kept for r in substrings.cut_repeats(frame(spark, texts), finish, schema, bucket_bytes=2000).collect()} == want


def test_fingerprints_follow_edits(docs, none, spark):
    texts = ["a b c d e\nf g h i j", "f g h i j\na b c d e", "", None, prose(1, 90), prose(1, 60) + " " + prose(2, 30)]
    rows = {r.doc_id: r for r in fingerprints.edited_fingerprints(frame(spark, texts)).collect()}
    order = [*range(len(texts) - 1, -1, -1)]
    for at, i in enumerate(order):
        text, following = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + following[:k]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i].edited_fingerprint == fingerprints.Fingerprint.of(edited).hex() and rows[i].n_chars == len(text)
    assert rows[0].fingerprint == rows[1].fingerprint and rows[2].fingerprint == rows[3].fingerprint != rows[4].fingerprint
    assert rows[5].near_next > 0.4 and rows[4].near_edited > 0.5
    assert fingerprints.edited_fingerprints(docs).count() == len(TEXTS) and fingerprints.edited_fingerprints(none).count() == 0


def test_fingerprints_insert_delete_and_merge():
    a = fingerprints.Fingerprint.of("one two three\nfour five six")
    assert a.insert("seven").delete("seven").hex() == a.hex()
    assert fingerprints.Fingerprint.of("one two three").merge(fingerprints.Fingerprint.of("four five six")).hex() == a.hex()
    assert fingerprints.Fingerprint.from_hex(a.hex()).likeness(a) == 1.0


@pytest.mark.parametrize("n", [40_000, 50_000])
def test_likeness_of_a_line_repeated_very_often(n):
    whole = fingerprints.Fingerprint.of("a b c\n" * n)
    part = fingerprints.Fingerprint.of("a b c\n" * (2 * n // 3) + "\n".join(prose(i, 9) for i in range(100)))
    assert 0.9 < whole.likeness(part) < 0.95
    assert fingerprints.Fingerprint.from_hex(part.hex()).likeness(whole) == whole.likeness(part)


def test_ranges_of_neighbours_meet(spark):
    df = frame(spark, [f"t{i}" for i in range(50)], [7 * i for i in range(50)])
    parts = fingerprints.neighbours(df, rows_per_range=6).collect()
    assert sum(not r.guest for r in parts) == 50 and sum(r.guest for r in parts) == len({r.part for r in parts})


PAGE = ('<!DOCTYPE html><html><head><title>T &lt;</title><script>var x="</head><p>";</script></head><body><header>Site</header><nav><li>Menu {n}</nav>'
        '<div class="ad">Buy {n}</div><main><h1>Head {n}</h1><p class="share-bar">Share<p>First &amp; {n}<br>line<p>  Second\n <b>bold</b> {n}</p>'
        '<form>Mail me</form><section id="comments"><p>Reader {n}</p></section><p>Always the same</p></main><footer>Foot {n}')


def test_extraction_keeps_the_article(spark):
    pages = [(i, f"http://a.example/{i}", PAGE.replace("{n}", f"number {i}"), "x") for i in range(9)]
    pages += [(100, None, None, "x"), (101, "no url", "", "x"), (102, "http://b.example/", "<p>alone", "x"), (103, "http://a.example/0", pages[0][2], "x"),
              (104, "http://c.example/", "<div>Long text of a page without a main part.</div><nav>x</nav>" + "<" * 50, "x")]
    rows = {r.page_id: r for r in extraction.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string, host string")).collect()}
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) for r in rows.values())
    for i in range(9):
        # what is the same on all pages of the host is template
        assert rows[i].text == f"Head number {i}\n\nFirst & number {i} line\n\nSecond bold number {i}"
    assert rows[100].text == rows[101].text == "" and rows[102].text == "alone" and rows[103].text == rows[0].text
    assert rows[104].text.startswith("Long text of a page")


def test_extraction_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", body)]
        want[r.page_id] = "\n\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in extraction.extract_text(pages).collect()} == want


def test_all_pages_of_a_host_are_judged_by_one_wrapper(spark, monkeypatch):
    page = "<body><div>Our menu</div><article><p>Text {n}</p><p>Same notice</p></article><div>Imprint</div></body>"
    pages = [(i, f"http://a.example/{i}", page.replace("{n}", f"number {i}"), "x") for i in range(40)]
    pages += [(100 + i, f"http://b{i}.example/", "<p>alone", "x") for i in range(3)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    want = {i: f"Text number {i}" for i in range(40)} | {100 + i: "alone" for i in range(3)}
    monkeypatch.setattr(extraction, "HOST_SHARE", 40)
    for pages_per_part, rows in ((512, 1024), (2, 1024), (512, 3), (2, 3)):
        monkeypatch.setattr(extraction, "HOST_PAGES", pages_per_part, raising=False)
        with_rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
        try:
            assert {r.page_id: r.text for r in extraction.extract_text(df).collect()} == want
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_rows)


def test_extraction_without_article_keeps_every_varying_text(spark):
    page = ('<body><div>Our menu</div><h1>Headline {n}</h1><div><p>Intro {n}</p><div>' + "Long body {n} " * 5 + "</div></div><nav>Other {n}</nav>"
            "<div>Second section {n}</div></body>")
    pages = [(i, f"http://a.example/{i}", page.replace("{n}", f"number {i}")) for i in range(9)] + [(9, "http://b.example/", page.replace("{n}", "x"))]
    rows = {r.page_id: r.text for r in extraction.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(9):
        body = " ".join([f"Long body number {i}"] * 5)
        assert rows[i] == f"Headline number {i}\n\nIntro number {i}\n\n{body}\n\nSecond section number {i}"
    assert rows[9].split("\n\n") == ["Our menu", "Headline x", "Intro x", " ".join(["Long body x"] * 5), "Second section x"]


def test_extraction_of_deeply_nested_pages(spark):
    pages = [(i, f"http://a.example/{i}", "<p>x" * (i % 2) + "<div>" * 3000 + f"number {i}" + "<div><p>y" * i) for i in range(3)]
    rows = {r.page_id: r.text for r in extraction.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert rows == {0: "number 0", 1: "x\n\nnumber 1\n\ny", 2: "number 2\n\ny\n\ny"}


def test_quick_alignment_equals_the_table(monkeypatch):
    draw = random.Random(2)

    def tree(depth):
        node = extraction.Node(draw.choice(["div", "p", "#"]) if depth else "html")
        if node.tag != "#" and depth < 4:
            node.children = [tree(depth + 1) for _ in range(draw.randint(0, 4))]
        return node

    shapes = [extraction.flatten(tree(0))[0] for _ in range(60)]

    def wrapper_and_places():
        root = extraction.Node("html")
        for shape in shapes:
            extraction.align(root, extraction.tree_of(shape)[0])
        done = extraction.tree_of(extraction.flatten(root)[0])[0]
        return extraction.flatten(root)[0], [extraction.places(done, shape) for shape in shapes]

    quick = wrapper_and_places()
    assert all(p >= 0 for at in quick[1] for p in at)
    monkeypatch.setattr(extraction, "_embedding", lambda *_: None)
    assert wrapper_and_places() == quick


def labelled(spark, good, bad, column):
    texts = [good(i) if i % 3 else bad(i) for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)] + [(None, 1), (7, None), (9999, 1)], f"doc_id long, {column} int")
    return texts, labels


def test_toxic_documents_score_higher(spark, none):
    texts, labels = labelled(spark, lambda i: prose(i, 60, 2), lambda i: prose(i, 30, 2) + " nasty fool " + prose(-i, 30, 2) + " FOOL!! nasty", "clean")
    labels = labels.select("doc_id", (1 - F.col("clean")).alias("toxic"))
    docs = frame(spark, [*texts, None, "", "12 34", texts[0]], [*range(240), 300, None, 301, 302])
    rows = toxicity.score_toxicity(docs, labels).collect()
    score = {r.doc_id: r.toxicity_score for r in rows}
    assert len(rows) == 244 and all(0 <= r.toxicity_score <= 1 for r in rows) and score[300] == score[301] and score[302] == score[0]
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(score[i] >= 0.5) == (i % 3 == 0) for i in held]) > 0.9
    assert toxicity.score_toxicity(none, labels).count() == 0
    assert toxicity.score_toxicity(docs, labels.limit(0)).count() == 244
    named = docs.withColumn("toxicity_score", F.lit("mine"))
    kept = toxicity.drop_toxic(named, labels).collect()
    assert {r.toxicity_score for r in kept} == {"mine"} and kept[0].__fields__ == named.columns
    left = {r.doc_id for r in kept}
    assert np.mean([(i in left) == (i % 3 > 0) for i in held]) > 0.9 and len(kept) == len([r for r in kept if r.doc_id is not None]) + 1
    assert toxicity.drop_toxic(none, labels).count() == 0


def test_cut_is_fair_to_both_classes():
    y = np.array([0, 0, 0, 0, 1, 1, 1, 1])
    assert toxicity.balanced_cut(np.array([0.1, 0.1, 0.2, 0.6, 0.3, 0.3, 0.7, 0.9]), y) == 0.3
    assert toxicity.balanced_cut(np.array([0.1] * 8), np.zeros(8)) == toxicity.REJECT


def test_good_documents_score_higher(spark, none):
    texts, labels = labelled(spark, lambda i: prose(i, 80) + ".", lambda i: "SPAM!! " * (20 + i % 9), "quality")
    docs = frame(spark, [*texts, None, "", texts[1]], [*range(240), 300, None, 302])
    rows = quality.score_quality(docs, labels).collect()
    score = {r.doc_id: r.score for r in rows}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(rows) == 243 and np.mean([(score[i] >= 0.3) == (i % 3 > 0) for i in held]) > 0.95 and score[302] == score[1]
    assert quality.score_quality(none, labels).count() == 0 and quality.score_quality(docs, labels.limit(0)).count() == 243


def test_stages_bring_columns_of_any_name_back(spark):
    passage = prose(7, 40)
    texts = [passage + " a", passage + " b", prose(8, 60), prose(8, 60), None, ""]
    docs = frame(spark, texts)
    extra = ["bench_words", "bench_spans", "bench_items", "_n_chars", "_changed", "_text_hash", "_kept_id", "_kept_hash", "bucket", "body", "missing", "c0", "c1", "C2",
             "toxicity_score", "fp", "first", "root", "tree"]
    for i, c in enumerate(extra):
        docs = docs.drop(c).withColumn(c, F.concat(F.lit(f"{i}-"), F.col("doc_id").cast("string")))
    bench = spark.createDataFrame([(1, prose(7, 12))], "item_id long, text string")
    for out, ids in ((decontamination.remove_passages(docs, bench), [0, 1, 2, 3, 4, 5]), (substrings.remove_repeats(docs), [0, 1, 2, 3, 4, 5]),
                     (simhash.drop_near_duplicates(docs), None)):
        rows = sorted(out.collect(), key=lambda r: r.doc_id)
        assert out.columns == docs.columns and (ids is None or [r.doc_id for r in rows] == ids)
        assert all(r[c] == f"{i}-{r.doc_id}" for r in rows for i, c in enumerate(extra))


def test_names_of_parts_do_not_overrule_the_wrapper():
    def of(page):
        shape, texts = extraction.flatten(extraction.parse(page))
        return extraction.content(shape, texts, [False] * len(texts))

    inside = '<nav>menu</nav><article><h1>T</h1>{}</article><footer>f</footer>'
    for part, want in (
        ('<div class="related work"><p>Body</p></div>', ["Body"]), ('<p class="search">Searched</p>', ["Searched"]),
        ('<p>A <span class="sponsor">sponsor</span> pays</p>', ["A sponsor pays"]), ('<p>Let <math><mi>x</mi><mo>=</mo><mn>3</mn></math> hold.</p>', ["Let x=3 hold."]),
        ("<aside><p>A pull quote</p></aside>", ["A pull quote"]), ('<div class="ad-box">Buy</div>', []), ('<ul class="comment-list"><li>me</li></ul>', []),
        ('<aside class="sidebar">x</aside>', []),
    ):
        assert of(inside.format(part)) == ["T", *want], part
    assert of('<div id="ads">x</div><div class="news-ad-report"><p>Report body</p></div><aside>side</aside>') == ["Report body"]


def test_a_stored_map_is_edited_by_the_next_run(spark, tmp_path):
    folder = str(tmp_path / "map")
    docs = frame(spark, [prose(i, 20 + i % 60) for i in range(900)])
    sizes = {}
    for run, (rows, shards) in enumerate([(docs, 4), (docs, 4), (docs.where("doc_id < 700"), 5)]):
        placed = sharding.shard_rows(rows, shards, 256, folder=folder).collect()
        loads = [sum(r.size for r in placed if r.shard == s) for s in range(shards)]
        assert max(loads) < 1.05 * sum(loads) / shards
        sizes[run] = {r.doc_id: r.shard for r in placed}
        assert sharding._versions(spark, folder) == [[0, 1], [0, 1], [0, 1, 2]][run]  # nothing to edit in the second run
    assert sizes[0] == sizes[1]
    moved = sum(sizes[2][i] != sizes[1][i] for i in sizes[2])
    assert moved < 0.35 * 700  # about the fifth that the new shard takes
    before, after = ({r.vslot: r.shard for r in sharding.stored_map(spark, folder, v).collect()} for v in (1, 2))
    assert len(before) == len(after) == 256 and sum(before[v] != after[v] for v in before) < 110


def test_equal_rows_are_spread_over_shards(spark):
    docs = frame(spark, ["same text"] * 3000 + [prose(i, 9) for i in range(300)], [7] * 3000 + list(range(300)))
    rows = sharding.shard_rows(docs, 8, 512).collect()
    loads = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    assert len(rows) == 3300 and max(loads) < 1.05 * sum(loads) / 8
    for shard in range(8):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_registered_sharding_is_even_and_gapless(spark):
    got = sharding.op6_sharding(spark, SF)
    assert dict(got.dtypes) | {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"} == dict(got.dtypes)
    rows = got.collect()
    want = {r.doc_id: (len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == want and {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    loads = [sum(r.size for r in rows if r.shard == s) for s in range(16)]
    assert max(loads) - min(loads) <= max(r.size for r in rows)
