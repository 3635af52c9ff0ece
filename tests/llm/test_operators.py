"""The training-data operators on small tables, against brute force: edge cases, ties, repeats, nulls, empty tables."""

import math
import random
import zlib
from statistics import NormalDist

import numpy as np
import public_tokenizers as P
import pytest

from tidemark.llm import bpe, common, dedup, htmltext, langid, licenses, packing, quality, sharding, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string"
WORDS = "the of and to in a is that for it as was with be by on not he his but at are this have from or had".split()


def documents(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None, 1, "clash") for i, t in zip(ids, texts, strict=True)], DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    base = [" ".join(rng.choices(WORDS, k=rng.randint(5, 120))) for _ in range(40)]
    near = [" ".join(w if rng.random() > 0.01 else "zz" for w in t.split()) for t in base[:20]]
    passage = " ".join(rng.choices(WORDS, k=50))
    shared = [f"{passage} {' '.join(rng.choices(WORDS, k=rng.randint(0, 30)))} u{k}" for k in range(15)]
    return [None, "", " ", "one", "a b", "A B", *base, *near, *base[:5], *shared, "x " * 3000]


def jaccard_components(texts, words):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()

    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [len(s) for s in sets], [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(spark, texts, words):
    sizes, roots = jaccard_components(texts, words)
    got = {r["doc_id"]: r for r in dedup.near_duplicates(documents(spark, texts), words=words).collect()}
    assert len(got) == len(texts)
    for i, (n, root) in enumerate(zip(sizes, roots, strict=True)):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, root, i == root)


def test_long_lists_of_near_copies(spark):
    """More near copies than a short list holds, some of which only other copies connect."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for _ in range(60):
        own = list(base)
        for k in rng.sample(range(120), rng.randint(0, 4)):
            own[k] = f"v{rng.randint(0, 9999)}"
        texts.append(" ".join(own))
    _, roots = jaccard_components(texts, 4)
    got = {r["doc_id"]: r["component_id"] for r in dedup.near_duplicates(documents(spark, texts), words=4).collect()}
    assert [got[i] for i in range(60)] == roots


def test_blocks_of_long_lists(spark, monkeypatch):
    """Near copies at all distances in lists of many blocks: the components are those of brute force."""
    rng = random.Random(21)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for _ in range(150):
        own = list(base)
        for k in rng.sample(range(150), rng.choice([0, 2, 5, 9, 14])):
            own[k] = f"v{rng.randint(0, 9999)}"
        texts.append(" ".join(own))
    _, roots = jaccard_components(texts, 4)
    assert 10 < len(set(roots)) < 100
    monkeypatch.setattr(dedup, "LIST_BLOCK", 16)
    got = {r["doc_id"]: r["component_id"] for r in dedup.near_duplicates(documents(spark, texts), words=4).collect()}
    assert [got[i] for i in range(150)] == roots


def test_linked_pairs_match_brute_force():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype("u8") * np.uint64(0x9E3779B97F4A7C15)) for _ in range(60)]
    shared = dedup.shared_counts(sets[:20], sets[20:], 16)
    assert all(shared[i, j] == len(np.intersect1d(sets[i], sets[20 + j])) for i in range(20) for j in range(40))
    found = dedup.linked_pairs(sets, sets, list(range(60)), list(range(60)), 50, 64)
    root = list(range(60))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i, j in found:
        assert find(i) != find(j)
        root[find(i)] = find(j)
    for i in range(60):
        for j in range(60):
            a, b = dedup.jaccard(sets[i], sets[j])
            assert 100 * a < 50 * b or find(i) == find(j)


@pytest.mark.parametrize("size", [64, 200, 1000])
def test_contained_pairs(spark, size):
    """Every pair of nested texts at 80 to 85 % is linked, for sets around and above the sketch's size."""
    rng = random.Random(size)
    texts = []
    for k in range(120):
        whole = [f"w{rng.randint(0, 10**9)}" for _ in range(size + 3)]
        texts += [" ".join(whole[: math.ceil(size * (0.8, 0.85)[k % 2]) + 3]), " ".join(whole)]
    got = {r["doc_id"]: r["component_id"] for r in dedup.near_duplicates(documents(spark, texts), words=4).collect()}
    assert [k for k in range(0, 240, 2) if not got[k] == got[k + 1] == k] == []


def test_cut_and_appended_copies(spark):
    """Of two nested texts the larger sketch shares fewest values: all pairs at 80 to 85 % are still found."""
    rng = random.Random(12)
    texts = []
    for k in range(400):
        whole, share = [f"w{rng.randint(0, 10**9)}" for _ in range(503)], (0.8, 0.8, 0.82, 0.85)[k % 4]
        n = round(500 * share) + 3
        at = (0, 503 - n, (503 - n) // 2)[k % 3]  # appended to, cut at the front, cut on both sides
        texts += [" ".join(whole[at : at + n]), " ".join(whole)]
    got = {r["doc_id"]: r["component_id"] for r in dedup.near_duplicates(documents(spark, texts), words=4).collect()}
    assert [k for k in range(0, 800, 2) if not got[k] == got[k + 1] == k] == []


def test_empty_tables(spark):
    none = documents(spark, [])
    assert dedup.near_duplicates(none).count() == 0
    assert sharding.shard(none).count() == 0
    assert packing.pack(none, P.path("byte_bpe_50k.json")).count() == 0
    assert licenses.scan(none).count() == 0
    assert htmltext.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_duplicates(empty).count() == 0 and vectors.top_k(empty, empty).count() == 0


def test_nulls_and_repeats(spark):
    docs = documents(spark, ["same text here now", "same text here now", None, "other"], [5, 5, None, None])
    assert sorted(r["component_id"] or -1 for r in dedup.near_duplicates(docs).collect()) == [-1, -1, 5, 5]
    rows = sharding.shard(docs, shards=2).collect()
    assert len(rows) == 4 and sorted((r["shard"], r["slot"]) for r in rows) == sorted({(r["shard"], r["slot"]) for r in rows})
    assert packing.pack(docs, P.path("byte_bpe_50k.json")).count() == 4
    assert langid.identify(docs, langid.train(docs, common.F.lit(True))).count() == 4
    assert quality.score(docs, None).count() == 4


def test_shards_are_even_and_keep_groups(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(1, 60))) + f" {k}" for k in range(600)]
    texts += [texts[k % 30] for k in range(60)] + ["a copy of which there are very many " * 4] * 330 + [None]
    rows = sharding.shard(documents(spark, texts), shards=6).collect()
    assert len(rows) == len(texts)
    load, seen, where = {}, {}, {}
    for r in rows:
        t = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(t) + 8 and r["text_crc32"] == zlib.crc32(t) and r["law"] == "bytes" and r["grown_shard"] is None
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
        seen.setdefault(r["shard"], set()).add(r["slot"])
        where.setdefault(t, []).append(r["shard"])
    mean = sum(load.values()) / 6
    assert len(load) == 6 and all(abs(x - mean) <= 0.02 * mean for x in load.values())
    assert all(s == set(range(len(s))) for s in seen.values())
    assert all(len(set(s)) == 1 for s in where.values() if 1 < len(s) < 100)


def test_links_of_the_caller_are_kept_together(spark):
    """Planted communities: far fewer links are cut than by the hash that everything starts from, at even sizes."""
    rng = random.Random(17)
    texts = [f"text number {k} of some length" for k in range(800)]
    links = [(c * 20 + a, c * 20 + b) for c in range(30) for a in range(20) for b in rng.sample(range(20), 4) if a != b]
    links += [(rng.randrange(600), rng.randrange(600)) for _ in range(60)]
    df = spark.createDataFrame(links, "a long, b long").filter("a <> b")
    placed = sharding.shard(documents(spark, texts), shards=5, links=df).select("doc_id", "shard", "size").cache()
    n, cut = sharding.cut_edges(placed, df).first()
    start = documents(spark, texts).select("doc_id", common.F.pmod(common.F.xxhash64(common.F.col("doc_id").cast("string")), common.F.lit(5)).cast("int").alias("shard"))
    loads = [r["sum(size)"] for r in placed.groupBy("shard").sum("size").collect()]
    assert n == df.count() and cut < 0.5 * sharding.cut_edges(start, df).first()["cut"]
    assert len(loads) == 5 and max(loads) - min(loads) <= 0.02 * sum(loads)


def test_bpe_round_trip_and_tiktoken(spark):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    it = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "é", "'s", "1", "23", "　", "\x1c", "!", "日本", "the", "ing", " \n", "\x85", "😀", "aaaaaaa", "<|endoftext|>"]
    texts = [None, "", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(300)), "z" * 20_000]
    ids = bpe.encode(documents(spark, texts), path, P.PATTERN)
    for r in bpe.decode(ids, path).collect():
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == it.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()


def test_merge_takes_the_leftmost_pair():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"ab": 258}
    assert bpe.merge(b"aab", ranks) == [256, 98]


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    it = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    it.encode_special_tokens = True
    texts = [*texts, "<|endoftext|>"]
    rows = packing.pack(documents(spark, texts), P.path("byte_bpe_50k.json"), 512).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in enumerate(texts):
        ids, at = [*it.encode(text or "", add_special_tokens=False).ids, 0], 0
        for r in sorted(by_doc[i], key=lambda r: r["piece"]):
            part = ids[at : at + r["length"]]
            assert r["start"] == at and r["ids"] == part and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert r["length"] == 512 or r["piece"] == 0
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 512
    assert len(by_sequence) <= math.ceil(sum(r["length"] for r in rows) / 512) + 1


def test_plan_finds_full_sequences():
    assert sum(t for t, _ in packing.plan({6: 4, 5: 4, 4: 4, 3: 4, 2: 4}, 10)) == 8
    kinds = packing.plan({7: 3, 3: 2, 2: 2, 1: 1}, 10)
    assert sum(t for t, _ in kinds) == 4 and all(sum(x * n for x, n in f.items()) <= 10 for _, f in kinds)


def test_plan_beats_best_fit():
    """Pieces that best fit pairs badly: the search shares them between two fillings."""
    counts = {700: 3000, 690: 3000, 660: 3000}
    assert sum(t for t, _ in packing.best_fit(counts, 2048)) == 3500
    kinds = packing.plan(counts, 2048)
    assert sum(t for t, _ in kinds) <= 3375 and all(sum(x * n for x, n in f.items()) <= 2048 for _, f in kinds)
    assert all(sum(t * f.get(x, 0) for t, f in kinds) == n for x, n in counts.items())


def test_plan_is_optimal_on_small_instances():
    rng = random.Random(5)

    def fewest(pieces, capacity):
        """By trying every place of each piece."""
        best = [len(pieces)]

        def go(k, rooms):
            if len(rooms) >= best[0]:
                return
            if k == len(pieces):
                best[0] = len(rooms)
                return
            for i in {r: i for i, r in enumerate(rooms) if r >= pieces[k]}.values():
                go(k + 1, [r - pieces[k] if j == i else r for j, r in enumerate(rooms)])
            go(k + 1, [*rooms, capacity - pieces[k]])

        go(0, [])
        return best[0]

    beaten = 0
    for _ in range(150):
        pieces = sorted((rng.randint(8, 60) for _ in range(rng.randint(5, 11))), reverse=True)
        counts = {x: pieces.count(x) for x in pieces}
        kinds = packing.plan(counts, 100)
        assert sum(t for t, _ in kinds) == fewest(pieces, 100)
        assert all(sum(x * n for x, n in f.items()) <= 100 for _, f in kinds)
        assert all(sum(t * f.get(x, 0) for t, f in kinds) == n for x, n in counts.items())
        beaten += sum(t for t, _ in packing.best_fit(counts, 100)) > sum(t for t, _ in kinds)
    assert beaten > 0


def test_fillings_are_undominated():
    got = packing.fillings({50: 1, 40: 2, 30: 1, 20: 1}, [50, 40, 30, 20], 90, 12)
    assert got[0][0] == 0 and {tuple(sorted(f.items())) for _, f in got} >= {((40, 1), (50, 1)), ((20, 1), (30, 1), (40, 1))}
    assert all(w < 20 or all(x > w for x in (50, 40, 30, 20)) for w, _ in got)


def test_language_mixture(spark):
    rng = random.Random(3)
    syllables = {"en": ["the", "ing", "and", "er"], "xx": ["ökö", "zzi", "ulu", "kra"]}
    word = lambda lang: "".join(rng.choices(syllables[lang], k=rng.randint(1, 3)))
    text = lambda lang, n: " ".join(word(lang) for _ in range(n))
    rows = [(k, text(lang, 30), lang) for k, lang in enumerate(["en", "xx"] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, common.F.lit(True))
    test = [text("en", 4), text("xx", 4), text("en", 60) + " " + text("xx", 30), None, "", "12 34 !!"]
    got = {r["doc_id"]: r for r in langid.identify(documents(spark, test), model).collect()}
    assert [got[k]["lang_pred"] for k in range(6)] == ["en", "xx", "en", "und", "und", "und"]
    assert abs(got[2]["shares"][0] - 2 / 3) < 0.05 and got[2]["languages"] == ["en", "xx"]
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_chunks_keep_every_word():
    data, _ = langid.buffer(["ab " * 50, "cd"])
    old, langid.CHUNK = langid.CHUNK, 16
    try:
        pieces = list(langid.chunks(data))
        at, _ = langid.word_likelihoods(data, np.zeros((langid.PLACES, 2), "f4"))
    finally:
        langid.CHUNK = old
    assert len(pieces) > 3 and len(at) == 51


def test_quality(spark):
    rng = random.Random(6)
    good = [" ".join(rng.choices(WORDS, k=40)) for _ in range(120)]
    bad = [" ".join(w.upper() + "!!" for w in rng.choices(WORDS, k=40)) for _ in range(80)]
    texts = [*good, *bad, None, ""]
    labels = spark.createDataFrame([(k, int(k < 120), None) for k in range(200) if k % 4], "doc_id long, quality int, toxic int")
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in quality.score(docs, quality.train(docs, labels)).collect()}
    assert all(got[k]["predicted"] == int(k < 120) for k in range(0, 200, 4)) and 0 <= got[200]["score"] == got[201]["score"] <= 1


def test_held_out_accuracy(spark):
    """Held-out rows of the driver's labels."""
    from tidemark.llm import queries

    sf = "/root/testdata/sf0.001"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op5_nbsvm_quality(spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) >= 0.8
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in queries.op6_language_mixture(spark, sf).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in rows]) >= 0.95


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header>Top</header>
<nav><ul><li>Home<li>More</ul></nav><!-- x --><div class="ad">Buy</div><article><h1>A &amp; B</h1><p><b>One</b>&nbsp;two<br>three<p>four <i>fi</i>ve
<aside>side</aside><div class="comments">bad words</div><form><input>send</form></article><footer>&copy; us</footer>"""


def test_html(spark):
    rows = [(1, "http://h/1", PAGE), (2, "http://h/2", None), (3, None, ""), (4, "http://h/4", "<p>plain <!-- cut"), (5, "http://h/5", "a < b &lt;p&gt;")]
    boiler = " ".join(f"notice{k}" for k in range(20))
    rows += [(10 + k, f"http://s/{k}", f"<div>{boiler}</div><div>{' '.join(f'own{k}_{j}' for j in range(12))}</div>") for k in range(4)]
    got = {r["page_id"]: r for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1]["text"] == "A & B One two three four five"
    assert (got[2]["text"], got[3]["text"], got[4]["text"], got[5]["text"]) == ("", "", "plain", "a < b <p>")
    assert all(got[10 + k]["text"] == " ".join(f"own{k}_{j}" for j in range(12)) for k in range(4))
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_runs_repeat_across_a_large_host(spark):
    """A notice on two of a host's 600 pages is found, an unmarked article copied onto one url only is not."""
    words = lambda name, n=12: " ".join(f"{name}_{j}" for j in range(n))
    rows = [(k, f"http://big/{k}", f"<div>{words(f'notice{k % 300}', 9)}</div><div>{words(f'own{k}')}</div>") for k in range(600)]
    rows += [(1000 + k, "http://big/same", f"<div>{words('copied')}</div>") for k in range(300)]
    rows += [(2000 + k, None, f"<div>{words('copied')}</div>") for k in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    for at_once in (128, 16):
        got = {r["page_id"]: r["text"] for r in htmltext.extract(df, at_once).collect()}
        assert [k for k in range(600) if got[k] != words(f"own{k}")] == []
        assert len(got) == 1200 and all(text == words("copied") for k, text in got.items() if k >= 1000)


def test_repeated_runs_match_brute_force():
    rng = np.random.default_rng(1)
    tokens, page = rng.integers(0, 3, 300), np.repeat(np.arange(10), 30)
    want = np.zeros(300, bool)
    for i in range(300 - 7):
        if page[i] == page[i + 7] and any(page[j] == page[j + 7] and page[j] != page[i] and (tokens[i : i + 8] == tokens[j : j + 8]).all() for j in range(300 - 7)):
            want[i : i + 8] = True
    assert (htmltext.repeated(tokens, page, 8) == want).all()


def test_seeds_find_every_repeated_run():
    """Through the seeds of chunks of pages: all runs that brute force finds, and hardly any other, as words around a seed are compared by four bits."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(40)]
    passages = [[vocabulary[k] for k in rng.integers(0, 40, rng.integers(8, 14))] for _ in range(40)]
    pages = [[w for _ in range(6) for w in (*passages[rng.integers(0, 40)], *(vocabulary[k] for k in rng.integers(0, 40, rng.integers(0, 30))))] for _ in range(24)]
    pages += [["short"], [], pages[0][:9]]
    n, hashes = len(pages), dedup.WordHashes()
    tokens, page = np.concatenate([[hashes[w.encode()] for w in p] for p in pages if p]), np.repeat(np.arange(n), list(map(len, pages)))
    want = htmltext.repeated(tokens, page, 8)
    chunks = [range(0, 10), range(10, n)]
    own = [htmltext.entries(["h"] * len(c), [f"u{k}" for k in c], [" ".join(pages[k]) for k in c], hashes, 8) for c in chunks]
    mask = htmltext.repeats(*(np.concatenate([o[k] for o in own]) for k in ("seed", "around", "url")))
    got, cut = [], len(own[0]["seed"])
    for c, o, m in zip(chunks, own, (mask[:cut], mask[cut:]), strict=True):
        for j, k in enumerate(c):
            at = o["page"] == j
            begins = {int(a) - b for a, e in zip(o["at"][at], o["entry"][at], strict=True) for b in range(5) if m[e] >> b & 1}
            got.append(htmltext.cover(np.array([x for x in begins if 0 <= x <= len(pages[k]) - 8], "i8"), len(pages[k]), 8))
    got = np.concatenate(got)
    assert want.any() and not want.all() and (got >= want).all() and (got == want).mean() > 0.98


def test_licenses(spark):
    texts = ["intro\nReleased under the MIT License.\nend", "Licensed under the Apache License, Version 2.0", "a license to sing", None, "", licenses.TEMPLATES["ISC"].upper()]
    got = {r["doc_id"]: r for r in licenses.scan(documents(spark, texts)).collect()}
    assert got[0]["license"] == "MIT (line)" and got[0]["block"] == 1 and got[0]["n_changed"] == 0
    assert got[1]["license"] == "Apache-2.0 (line)" and set(got) <= {0, 1, 5}
    assert licenses.window("a b c d".split(), "a x c d".split()) == (0, 4, [("x", "b")])
    with pytest.raises(ValueError):
        licenses.scan(documents(spark, texts), templates={"none": " - "})


def test_wrapped_and_repeated_licenses(spark):
    """Wrapped headers among other text, and several licenses in one line."""
    import textwrap

    full = ("MIT", "BSD", "ISC", "GPL", "LGPL", "MPL-2.0", "Apache-2.0", "CC0-1.0")
    wrapped = {name: [f" * {line}" for line in textwrap.wrap(licenses.TEMPLATES[name], 60)] for name in full}
    texts = ["\n".join(["Some words and a title of the file", "", *wrapped[name], "", "and then the code is here to see"]) for name in full]
    two = "Released under the MIT License. And also: This work is licensed under the GNU General Public License, version 3."
    texts += [two, "\n".join(["x"] + wrapped["MIT"] + wrapped["BSD"] + ["y"]), "\n".join(["Released under the MIT License."] * 600)]
    got = {}
    for r in licenses.scan(documents(spark, texts)).collect():
        got.setdefault(r["doc_id"], []).append((r["block"], r["license"], r["n_changed"], r["matched"]))
    for k, name in enumerate(full):
        assert got[k] == [(2, name, 0, " ".join(licenses.words(licenses.TEMPLATES[name])))]
    assert [x[:3] for x in got[8]] == [(0, "MIT (line)", 0), (0, "GPL-3.0 (line)", 0)]
    assert [x[:3] for x in got[9]] == [(1, "MIT", 0), (1 + len(wrapped["MIT"]), "BSD", 0)]
    assert [x[0] for x in sorted(got[10])] == list(range(600))


def _vectors(spark, seed=5, n=400, dims=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dims))
    rows = []
    for i in range(n):
        x = base[i % len(base)] + rng.normal(size=dims) * rng.choice([0.02, 0.1, 0.3, 1.0])
        rows.append((i, [float(a) for a in x], int(i % 3)))
    rows += [(n, rows[0][1], 0), (n + 1, rows[0][1], 1), (n + 2, None, 0), (n + 3, [0.0] * dims, 0), (n + 4, [float("nan")] * dims, 0), (n + 5, [1.0, None], 0), (n + 6, rows[0][1], None), (n + 7, [1.0, 2.0], 0), (n + 8, [2.0, 4.0], 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_vector_near_duplicates(spark):
    rows, df = _vectors(spark)
    ok = {i: (np.array(x) / np.linalg.norm(x), lab) for i, x, lab in rows if x and lab is not None and None not in x and np.isfinite(x).all() and np.any(x)}
    links = {i: {j for j, (y, m) in ok.items() if j != i and m == lab and len(x) == len(y) and x @ y >= 0.93} for i, (x, lab) in ok.items()}
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    found = sum(r["n_links"] for r in got.values()) / max(1, sum(map(len, links.values())))
    assert found >= 0.999  # recall against brute force
    for i, r in got.items():
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert (r["n_links"], r["component_id"], r["kept"]) == (len(links.get(i, ())), min(seen), i == min(seen))


@pytest.mark.parametrize("cells", [25, 256])
def test_many_cells(spark, cells):
    """Grids of many cells: recall against brute force, links at the threshold among them, and only a part of the cells visited."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(40, 64))
    base = centres[rng.integers(0, 40, 700)] + 0.8 * rng.normal(size=(700, 64))
    near = base[:500] / np.linalg.norm(base[:500], axis=1)[:, None]
    cosine = rng.uniform(0.925, 0.995, 500)[:, None]
    side = rng.normal(size=near.shape)
    side -= (side * near).sum(1)[:, None] * near
    copies = cosine * near + np.sqrt(1 - cosine**2) * side / np.linalg.norm(side, axis=1)[:, None]
    x = np.concatenate([base, copies])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = (unit @ unit.T >= 0.93).sum(1) - 1
    visit = vectors.multi_sequence
    (a, walls_a), (b, walls_b) = (vectors.walls(h, vectors.fit_codebook(h, round(cells**0.5))) for h in (unit[:, :32], unit[:, 32:]))
    reach = NormalDist().inv_cdf(0.9995) * math.sqrt(2 - 2 * 0.93) / 8
    seen = [len(visit(p, q, reach)) for p, q in zip(walls_a, walls_b, strict=True)]
    assert np.mean(seen) < 0.6 * cells
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(df, rows_per_cell=len(x) / cells).collect()}
    assert want.sum() > 500 and all(got[i] <= want[i] for i in range(len(x))) and sum(got.values()) >= 0.998 * want.sum()


def test_top_k(spark):
    rows, df = _vectors(spark)
    got = {}
    for r in vectors.top_k(df, df.filter("vec_id % 20 = 0"), k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ok = {i: np.floor(256 * np.array(x)).astype("i8") for i, x, _ in rows if x and None not in x and np.isfinite(x).all()}
    for q in (i for i in ok if i % 20 == 0):
        want = sorted(((-int(ok[q] @ y), i) for i, y in ok.items() if i != q and len(y) == len(ok[q])))[:5]
        assert sorted(got.get(q, [])) == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]


def test_top_k_deals_packs(spark, monkeypatch):
    """No group holds more than a stated number of packs, however many queries there are; the answers stay."""
    rows, df = _vectors(spark)
    want = sorted(map(tuple, vectors.top_k(df, df, k=3).collect()))
    seen, cogroup = [], type(df.groupBy()).cogroup

    def watched(packs, other):
        seen.append((packs._df, packs.count()))
        return cogroup(packs, other)

    monkeypatch.setattr(type(df.groupBy()), "cogroup", watched)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 100)
    monkeypatch.setattr(vectors, "QUERY_ROWS", 8)
    monkeypatch.setattr(vectors, "PACKS_AT_ONCE", 3, raising=False)
    assert sorted(map(tuple, vectors.top_k(df, df, k=3).collect())) == want
    packed, groups = seen[0]
    assert max(r["count"] for r in groups.collect()) <= 3 < packed.select("pack").distinct().count()


def test_top_k_floors(spark, monkeypatch):
    """Waves of small blocks, with floors from those before: the answers of brute force, ties, short lengths and few candidates included."""
    rng = np.random.default_rng(17)
    rows = [(i, rng.integers(-3, 4, 40).astype("f8").tolist()) for i in range(700)]  # whole numbers: many equal scores
    rows += [(700 + i, rows[i % 5][1]) for i in range(60)] + [(800 + i, rng.normal(size=3).tolist()) for i in range(7)]
    rows += [(900, [1.0, 2.0]), (901, [3.0, 4.0]), (902, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: np.floor(256 * np.array(v)).astype("i8") for i, v in rows}
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 20)
    monkeypatch.setattr(vectors, "QUERY_ROWS", 50)
    monkeypatch.setattr(vectors, "WAVE", 3)
    got = {}
    for r in vectors.top_k(df, df, k=6).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, x in whole.items():
        want = sorted((-int(x @ y), i) for i, y in whole.items() if i != q and len(y) == len(x))[:6]
        assert sorted(got.get(q, [])) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]


def test_floors_drop_rows():
    """Rows below a floor leave before the last dimensions, those that reach it stay."""
    rows = np.eye(64, dtype="i8") * 10
    asked = np.full((1, 64), 3, "i8")
    asked[0, 0] = 5
    every = list(vectors.search_block(asked, np.array([99]), rows, np.arange(64), 2, np.array([vectors.NO_FLOOR])))
    assert every == [(99, 0, 50), (99, 1, 30)]
    assert list(vectors.search_block(asked, np.array([99]), rows, np.arange(64), 2, np.array([50]))) == [(99, 0, 50)]
    assert not list(vectors.search_block(asked, np.array([99]), rows, np.arange(64), 2, np.array([51])))


def test_queries_match_sql(spark):
    import duckdb

    from tidemark.llm import queries

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        df = queries.QUERIES[name](spark, sf)
        columns = sorted(df.columns)
        want = con.sql(sql)
        at = [want.columns.index(c) for c in columns]
        assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in want.fetchall())


def test_pipeline(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in docs.collect()}
    for _, stage in cp.STAGES[:-1]:
        docs = common.table(stage(spark, docs, sf), "stage")
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.columns == list(cp.COLUMNS) and now <= kept and now
        kept = now
    assert {r["doc_id"] for r in cp.run(spark, sf).collect()} == kept


def test_pipeline_distinct_rows(spark):
    """Null ids are ordinary rows, different texts of one id are apart, of repeated rows one stays."""
    import corpus_pipeline as cp

    text = lambda name, n=30: " ".join(f"{name}{k}" for k in range(n))
    texts = [text("a"), text("b"), text("b"), text("c"), text("c"), text("d"), text("e"), text("a"), text("f"), text("f") + " more", "", "", None]
    ids = [5, None, None, 7, 7, 7, None, -3, None, 2**62, 9, 9, None]
    got = cp.distinct(spark, documents(spark, texts, ids), "").collect()
    want = [(-3, text("a")), (None, text("b")), (7, text("c")), (7, text("d")), (None, text("e")), (2**62, text("f") + " more"), (9, ""), (9, ""), (None, None)]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in got))) == sorted(map(str, want))
