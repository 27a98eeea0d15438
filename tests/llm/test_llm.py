"""Operators for training data against plain versions, on small inputs with odd rows."""

import hashlib
import random
import re
import weakref
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as registry
from tablecheck.llm import (
    byte_bpe,
    hamming_search,
    html_text,
    near_duplicates,
    packing,
    passage_quality,
    personal_data,
    quality_rules,
    sharding,
    token_counts,
)
from tablecheck.llm.process import kept

from conftest import SF_DIR

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, kept int, score string"
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, "one two"), (6, "word " * 3000), (None, "no id here"),
    (7, "a@b.co 4111 1111 1111 1111 and +1 (555) 123-4567 from 10.0.0.255"), (7, "a@b.co 4111 1111 1111 1111 and +1 (555) 123-4567 from 10.0.0.255"),
    (8, "don't  <|endoftext|> héllo wörld 漢字 😀\x1f x"), (9, "x" * 3000), (10, "The cat sat on the mat and it was of no use to be in that place for the day."),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, None if i == 4 else f"s{(i or 0) % 2}", None, "clash", 1, "clash") for i, t in ODD]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def plain_texts():
    return Counter((i, t or "") for i, t in ODD)


def test_token_counts(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = token_counts.token_counts(docs, path, public_tokenizers.PATTERN).collect()
    expected = Counter()
    for i, t in ODD:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected[i, len((t or "").encode()), n, n > 512] += 1
    assert Counter(map(tuple, got)) == expected
    assert token_counts.token_counts(empty, path, public_tokenizers.PATTERN).count() == 0


def test_counts_of_every_prefix():
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter, library = token_counts.Counter(path, public_tokenizers.PATTERN), Tokenizer.from_file(path)
    random.seed(1)
    parts = ["a", "th", "'re", "'", " ", "  ", "\n", "é", "漢", "12", "!", "<|endoftext|>", "Hello", " world"]
    for _ in range(300):
        text = "".join(random.choices(parts, k=random.randint(0, 9)))
        expected = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert counter.prefixes(text).tolist() == expected


def test_byte_bpe(docs, empty):
    import base64

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter()
    for i, t in ODD:
        ids = library.encode_ordinary(t or "")
        expected[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, byte_bpe.digests(docs, path, public_tokenizers.PATTERN).collect())) == expected
    ids = byte_bpe.encode(docs, path, public_tokenizers.PATTERN)
    back = byte_bpe.decode(ids, path, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, bytes(r.data).decode()) for r in back) == plain_texts()
    assert byte_bpe.digests(empty, path, public_tokenizers.PATTERN).count() == 0


def test_packing_covers_every_id_once(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    pieces = packing.pack(docs, path, window=64).collect()
    expected = Counter()
    for i, t in ODD:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        expected.update((i, k, x) for k, x in enumerate(ids))
    assert Counter((p.doc_id, p.start + k, x) for p in pieces for k, x in enumerate(p.ids)) == expected
    assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and p.length == len(p.ids) for p in pieces)
    places = Counter((p.sequence_id, p.offset + k) for p in pieces for k in range(p.length))
    assert set(places) == {divmod(k, 64) for k in range(sum(expected.values()))} and max(places.values()) == 1
    assert packing.pack(empty, path).count() == 0


def test_packing_keeps_proportions(spark):
    rows = [(i, "word " * 19, None, "big" if i % 4 else "small", None, "", 1, "") for i in range(2000)]
    pieces = packing.pack(spark.createDataFrame(rows, DOCS).repartition(7), public_tokenizers.path("word_bpe_49k.json"), window=800, with_ids=False)
    share = pieces.groupBy("sequence_id").agg((F.sum(F.when(F.col("doc_id") % 4 == 0, F.col("length")).otherwise(0)) / 800).alias("x")).orderBy("sequence_id").collect()
    assert all(abs(r.x - 0.25) <= 0.06 for r in share[:-1])


def test_packing_mixes_documents_longer_than_a_window(spark):
    rows = [(i, "word " * (1999 if i % 3 else 9), None, f"s{i % 5}", None, "", 1, "") for i in range(300)]
    df = spark.createDataFrame(rows, DOCS).repartition(7)
    path = public_tokenizers.path("word_bpe_49k.json")
    tokens = Counter()
    for i, t, *_ in rows:
        tokens[i % 5] += len(t.split()) + 1
    goal = {s: 500 * n / sum(tokens.values()) for s, n in tokens.items()}
    for mixture, goal in ((None, goal), ({"s0": 0.5, "s1": 0.3, "s2": 0.2}, {0: 250, 1: 150, 2: 100, 3: 0, 4: 0})):
        pieces = packing.pack(df, path, window=500, mixture=mixture).collect()
        assert Counter((p.doc_id, p.start + k) for p in pieces for k in range(p.length)) == Counter((i, k) for i, t, *_ in rows for k in range(len(t.split()) + 1))
        assert {(p.sequence_id, p.offset + k) for p in pieces for k in range(p.length)} == {divmod(k, 500) for k in range(sum(tokens.values()))}
        held = Counter()
        for p in pieces:
            held[p.sequence_id, p.doc_id % 5] += p.length
        # Until the first queue of the mixture ends, in all windows but the last without one.
        whole = int(min(tokens[s] / x for s, x in goal.items() if x))
        assert whole > 10 and all(abs(held[w, s] - x) <= 6 for w in range(whole - 1) for s, x in goal.items())


def test_schedule_places_every_token_once():
    rng = np.random.default_rng(7)
    for window in (1, 7, 64):
        for _ in range(40):
            n = rng.integers(1, 60, rng.integers(1, 30))
            queue = rng.integers(0, 1 + rng.integers(0, 12), len(n))
            queue = np.unique(queue, return_inverse=True)[1]
            tokens = np.bincount(queue, n).astype(np.int64)
            start = np.array([n[:i][queue[:i] == queue[i]].sum() for i in range(len(n))], np.int64)
            weights = tokens.astype(float) if rng.random() < 0.5 else rng.choice([1e-5, 0.1, 1.0, 9.0], len(tokens))
            doc, begin, length, place = packing.Schedule(tokens, weights, window).pieces(queue, start, n)
            assert sorted((d, b + k) for d, b, x in zip(doc, begin, length) for k in range(x)) == [(d, k) for d in range(len(n)) for k in range(n[d])]
            assert sorted(p + k for p, x in zip(place, length) for k in range(x)) == list(range(n.sum()))
            assert (place // window == (place + length - 1) // window).all()


def test_sharding(spark, docs, empty):
    rows = sharding.shard(docs, 3).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ODD)
    for shard in {r.shard for r in rows}:
        places = sorted(r.slot for r in rows if r.shard == shard)
        assert places == list(range(len(places)))
    assert sharding.shard(empty, 3).count() == 0
    many = sharding.records(spark.range(20000).selectExpr("id as doc_id", "repeat('x', cast(id % 100 as int)) as text"))
    sizes = sharding.slot_sizes(many)
    first = sharding.new_map(sizes, 24)
    loads = [r[0] for r in first.join(sizes, "virtual_slot").groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(loads) == 24 and max(loads) - min(loads) < 0.01 * max(loads)
    grown = sharding.rebalanced(first, sizes, 25)
    moved = grown.alias("g").join(first.alias("f"), "virtual_slot").where("g.shard <> f.shard").count()
    assert grown.agg(F.max("version")).first()[0] == 2 and moved < 4096 * 0.1


def test_sharding_spreads_rows_that_share_an_id(spark):
    hot = "case when id % 3 = 0 then 7 when id % 3 = 1 then null else id end as doc_id"
    many = spark.range(30000).selectExpr(hot, "if(id % 2 = 0, 'same', concat('text', cast(10000 + id as string))) as text")
    rows = sharding.shard(many, 24).collect()
    plain = Counter((r.doc_id, len(r.text) + 8, zlib.crc32(r.text.encode())) for r in many.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == plain
    load = Counter()
    for r in rows:
        load[r.shard] += r["size"]
    assert len(load) == 24 and max(load.values()) < 1.02 * min(load.values())
    for shard in load:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_quality_rules(docs, empty):
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.quality_rules(docs).collect()}
    assert (None, 3, 8, 0, 0, 0, True) in got and (1, 0, 0, 0, 0, 0, True) in got and (6, 3000, 12000, 0, 0, 3000, True) in got
    kept = quality_rules.passing(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {10}
    assert quality_rules.quality_rules(empty).count() == quality_rules.passing(empty).count() == 0


def jaccard_components(rows, size):
    sets = {}
    for i, t in rows:
        words = (t or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return label


def test_near_duplicates(spark, docs, empty):
    random.seed(4)
    words = [f"w{k}" for k in range(500)]
    rows = []
    for group in range(25):
        base = random.choices(words, k=80)
        for copy in range(random.choice([1, 2, 6])):
            text = list(base)
            for _ in range(random.randint(0, 5)):
                text[random.randrange(80)] = random.choice(words)
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + k, t) for k, t in enumerate([None, "", "one two", "ONE two", "x"])]
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == jaccard_components(rows, 4)
    odd = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates.near_duplicates(docs).collect()}
    assert {(1, 1, True), (2, 2, True), (5, 4, False), (None, None, True)} <= odd
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_blocks_of_large_bands(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    random.seed(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(60):
        text = list(base)
        for k in random.sample(range(120), 5):
            text[k] = f"z{random.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == jaccard_components(rows, 4)


def test_sketches_merge():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 500).astype(np.uint64), rng.integers(0, 2**63, 300).astype(np.uint64)
    merged = np.maximum(near_duplicates.sketch(a), near_duplicates.sketch(b))
    assert (merged == near_duplicates.sketch(np.union1d(a, b))).all()


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 32))
    x[500:700] = x[500]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(9000, None, 1), (9100, [0.0] * 32, 1), (9200, [float("nan")] * 32, 1), (9300, [1.0], 1), (None, [1.0] * 32, 1)]
    got = hamming_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")).collect()
    hits = 0
    for q in range(0, 3000, 100):
        far = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        order = np.lexsort((np.arange(3000), far))[:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[0] for r in mine] == list(range(1, 11)) and all(abs(far[v] - s) < 1e-9 for _, v, s in mine)
        hits += len({r[1] for r in mine} & set(order.tolist()))
        if q in (500, 600):
            assert [r[1] for r in mine] == order.tolist()
    assert hits >= 0.95 * 300 and {r.query_id for r in got} == set(range(0, 3000, 100))
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<double>, rank int")
    assert hamming_search.nearest(few).count() == 3
    assert hamming_search.nearest(few.limit(0)).count() == 0


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 1 << 16, (5000, 16)).astype(np.uint16)
    codes[:600] = codes[0] ^ (1 << rng.integers(0, 16, (600, 16))).astype(np.uint16) * (rng.random((600, 16)) < 0.5)
    index = hamming_search.Index(codes)
    asked = codes[[0, 1, 700, 4999]]
    far = np.bitwise_count(codes ^ asked[:, None]).sum(axis=2, dtype=int)
    assert (index.far(asked) == far).all()
    assert index.probed(20) and not index.probed(113)
    for radius in (0, 5, 20, 31, 60, 113, 256):
        assert (index.within(asked, radius) == (far <= radius)).all()
        for line, f in zip(index.nearest(asked, radius, 30), far):
            reach = radius
            while (f <= reach).sum() < 30:
                reach = min(256, reach + max(8, reach // 8))
            assert (line == (f <= reach)).all()


def test_search_of_many_blocks(spark, monkeypatch):
    """Blocks and chunks in any number give what each block gives by itself, without copies of the queries for each block."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 12))
    x[200:260] = x[200]
    x[300:700] = x[300] + 0.01 * rng.standard_normal((400, 12))
    x[700] *= 1e25
    x[800] *= 1e180
    ids = np.append(np.arange(1300), rng.integers(0, 40, 200))
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    models = []
    learned = hamming_search.learn
    monkeypatch.setattr(hamming_search, "learn", lambda *a: models.append(learned(*a)) or models[0])
    monkeypatch.setattr(hamming_search, "BLOCK", 100)
    monkeypatch.setattr(hamming_search, "CHUNK", 16)
    answer = hamming_search.nearest(rows, k=5, every=10)
    got = sorted(map(tuple, answer.collect()))
    plan = answer._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan and "Broadcast" not in plan

    dealt = rows.select("vec_id", "embedding", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(15)).alias("block")).collect()
    found = {int(i): set() for i in ids if i % 10 == 0}
    for b in range(15):
        block = [r for r in dealt if r.block == b]
        vectors = np.array([r.embedding for r in block])
        codes = models[0].codes(vectors)
        for r in dealt:
            if r.vec_id % 10 == 0:
                far = np.bitwise_count(codes ^ models[0].codes(np.array([r.embedding]))).sum(axis=1, dtype=int)
                reach = models[0].radius
                while (far <= reach).sum() < 6 and reach < 256:
                    reach = min(256, reach + max(8, reach // 8))
                score = np.sqrt(((vectors - np.array(r.embedding)) ** 2).sum(axis=1))
                near = sorted((float(s), o.vec_id) for s, o, f in zip(score, block, far) if f <= reach and o.vec_id != r.vec_id)
                found[r.vec_id].update(near[:5])
    assert got == sorted((q, k, i, s) for q, near in found.items() for k, (s, i) in enumerate(sorted(near)[:5], 1))


def plain_spans(text):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and personal_data.luhn(digits):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], personal_data.KINDS.index(s[2])))


def test_rules_for_personal_data():
    random.seed(3)
    parts = ["a", "b.", "@", "1", "23", ".", "-", " ", "+", "(", ")", "255", "4111 1111 1111 1111", "x@y.z", "é", "1.2.3.4", "_%"]
    for _ in range(5000):
        text = "".join(random.choices(parts, k=random.randint(0, 12)))
        assert personal_data.base_spans(text) == plain_spans(text)


def test_tagger_and_spans(docs, empty):
    made = personal_data.made_examples(np.random.default_rng(1), 800)
    tagger = personal_data.train(made[:600], steps=150)
    found = tagger.find([t for t, _ in made[600:]])
    right = sum(len(set(a) & set(b)) for (_, a), b in zip(made[600:], found))
    assert right >= 0.7 * sum(len(a) for _, a in made[600:]) and right >= 0.7 * sum(map(len, found))
    rows = personal_data.spans(docs, tagger).collect()
    for r in rows:
        text = next(t or "" for i, t in ODD if i == r.doc_id)
        base = personal_data.written(plain_spans(text))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(filter(None, base.split(","))) <= set(r.spans.split(","))
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows if r.doc_id == 7] == [(1, 1, 1, 1)] * 2
    masked = personal_data.masked(docs, tagger)
    assert masked.columns == docs.columns and {r.text for r in masked.where("doc_id = 7").collect()} == {"[EMAIL] [CARD] and [PHONE] from [IP]"}
    assert masked.where("doc_id = 1 and text is null").count() == 1
    assert personal_data.spans(empty, tagger).count() == 0


class Letters(personal_data.Tagger):
    """Takes every run of some characters for an email."""

    def emissions(self, symbols):
        scores = np.zeros((*symbols.shape, personal_data.TAGS), np.float32)
        inside = np.isin(symbols, [ord(c) for c in "qz@. 7"])
        scores[..., 0] = np.where(inside, 0, 10)
        scores[..., 1], scores[..., 2] = np.where(inside, 5, 0), np.where(inside, 10, 0)
        return scores, ()


def test_spans_of_any_length():
    tagger = Letters({k: np.zeros_like(v) for k, v in personal_data.Tagger.new(np.random.default_rng(1)).parts.items()})
    texts, expected = [], []
    for n in (1, 19, 20, 21, 22, 31, 32, 33, 63, 64, 65, 200, 3000):
        for item in (f"{'q' * n} @ z.z", f"q @ {'z' * n}.z", f"{'q' * n} @ {'z' * n}.q.z", "q q " * n + "@ z.z", "q @" + " z" * n + ".z", f"q 7 {'q ' * n}@ z.z"):
            for left in ("", "x", "x " * 50 + "x", "x q@z.zx" * 3):
                text = f"{left}{item}x z.z x" + " x" * 60 + "7x"
                texts.append(text)
                runs = [(m.start(), m.end(), "email") for m in re.finditer("[qz@. 7]+", text)]
                expected.append([s for s in runs if s[1] - s[0] > 1 and "@" in text[s[0] : s[1]]])
    found = [[s for s in spans if "@" in text[s[0] : s[1]]] for text, spans in zip(texts, tagger.find(texts))]
    assert found == expected and tagger.find(["x" * 500, ""]) == [[], []]


def test_long_spaced_addresses_are_masked_whole():
    tagger = personal_data.train(personal_data.made_examples(np.random.default_rng(17), 1500))
    random.seed(8)
    word = lambda n: "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    right = 0
    for n in range(40):
        item = f"{word(5)} @ {word(21 + n % 20)}.example.com" if n % 2 else f"{word(21 + n % 20)} @ {word(6)}.com"
        text = f"Ask {item}, or come again."
        right += personal_data.mask(text, personal_data.all_spans([text], tagger)[1][0]) == "Ask [EMAIL], or come again."
    assert right >= 28


def test_page_text(spark):
    body = "".join(f"<p>Sentence {k} &amp; more of the\n story is told here at length.</p>" for k in range(6))
    page = f'<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy now</div><article><h1>Head</h1>{body}<br></article><footer>&copy; site</footer>'
    rows = [(k, "u", page, "clash") for k in range(30)] + [(31, "u", None, ""), (None, None, "", ""), (33, "u", "<p", ""), (34, "u", "<nav>Menu</nav>", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.main_text(df).collect()
    expected = "\n".join(["Head", *(f"Sentence {k} & more of the story is told here at length." for k in range(6))])
    assert all(r.text == expected and r.n_chars == len(expected) for r in got if r.page_id is not None and r.page_id < 30)
    assert all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (31, None, 33, 34)) and len(got) == len(rows)
    assert html_text.main_text(df.limit(0)).count() == 0


def test_pages_that_leave_the_end_of_the_head_out():
    texts = lambda page: [b.text for b in html_text.leaf_blocks(page)]
    for head in ("<head><title>T</title><meta charset=x>", "<html><head>\n<script>a</script><head>", "<head><noscript><link></noscript>", "<head><template><p>t</p></template>", "<head><title>T</title></head>"):
        for body in ("<body><p>Text</p>", "<p>Text</p>", "Text", "<style>s</style>Text", "<body><head><p>Text</p>"):
            assert texts(head + body) == ["Text"], head + body
    assert texts("<head><title>T</title><noscript>Text</noscript><p>more") == ["Text", "more"]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> hold.</p>") == ["Let x=2 hold."]


def test_passage_quality_on_held_out_labels(spark, docs, empty):
    documents, labels = (spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    model = passage_quality.trained(documents, labels)
    rows = passage_quality.scores(documents, model).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert passage_quality.scores(docs, model).where("score between 0 and 1").count() == len(ODD)
    assert passage_quality.accepted(docs, model).columns == docs.columns
    assert passage_quality.trained(empty, labels) is None and passage_quality.scores(empty, None).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs.count()
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = packing.materialise(stage(spark, docs, SF_DIR))
        assert docs.columns == columns and 0 < docs.count() <= before, name
        before = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_leaves_one_row_of_each_group(spark):
    import corpus_pipeline

    random.seed(9)
    rows = []
    for group in range(12):
        base = [f"w{random.randrange(10**6)}" for _ in range(60)]
        other = list(base)
        other[30] = f"z{group}"
        ids = random.sample(range(1000 * group, 1000 * group + 900), 3)
        rows += [(ids[0], " ".join(base))] * 4 + [(ids[1], " ".join(other))] * 2 + [(None, " ".join(base))] * 3
        # One id with two texts, of which one is a copy of another row's.
        rows += [(ids[1], f"own text of this group {group} that nothing else is like"), (ids[2], " ".join(base[:1] + other[1:]))]
        rows += [(None, f"a text of group {group} twice without any id at all")] * 2
    random.shuffle(rows)
    group_of = jaccard_components([(k, t) for k, (_, t) in enumerate(rows)], 5)
    best = {}
    for k, (i, t) in enumerate(rows):
        order = (i is None, i or 0)
        best[group_of[k]] = min(best.get(group_of[k], (order, i)), (order, i), key=lambda x: x[0])
    docs = spark.createDataFrame([(i, t, None, None, None, "", 1, "") for i, t in rows], DOCS).repartition(5)
    got = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter(i for _, i in best.values()) and len(best) == 36


def test_queries_are_registered():
    assert [f"op{n}" for n in range(1, 14)] == sorted((k.split("_")[0] for k in registry.queries() if re.match(r"op\d+_", k)), key=lambda x: int(x[2:]))
    assert "pipeline" in registry.queries()


def test_words_are_encoded_as_the_library_does():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = packing.WordEncoder(path), Tokenizer.from_file(path)
    random.seed(6)
    parts = ["a", "Th", "'S", "'re", "'", "''", "#", "<", "|", ">", "12", "½", "é", "É", "e\u0301", "ß", "µ", "ª", "İ", "é", "漢", "Σ", "ς", "\xa0", "\x85", "\xad", "\x1f", "\n", " ", " ", "<|endoftext|>", "Hello", "y" * 70]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(6000)]
    expected = [np.array(library.encode(t, add_special_tokens=False).ids, encoder.type).tobytes() for t in texts]
    assert encoder.encode_all(texts) == expected and encoder.encode_all(texts[:100]) == expected[:100]


def test_new_words_are_merged_without_the_library(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = packing.WordEncoder(path), Tokenizer.from_file(path)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("aeinrstÉéßü", k=rng.randint(1, 8))) + rng.choice(["", ",", "...", "7"]) for _ in range(50)) for _ in range(40)]
    monkeypatch.setattr(encoder, "_encode", None)
    monkeypatch.setattr(encoder, "_apart", lambda words: [b""] * len(words) if not words else pytest.fail(words[0]))
    assert [np.frombuffer(x, encoder.type).tolist() for x in encoder.encode_all(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_odd_words_in_a_small_table_of_pieces(monkeypatch):
    monkeypatch.setattr(packing, "PIECES", 64)
    monkeypatch.setattr(packing, "CHUNK", 200)
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = packing.WordEncoder(path), Tokenizer.from_file(path)
    rng = random.Random(9)
    parts = [
        "a", "TH", "'re", "'", "'s", "''", " ", " ", "\n", "é", "É", "ß", "×", "÷", "Ÿ", "ª", "µ", "漢", "12", "!", "...", "\0", "\x85", "\xa0", "\u2003",
        "İ", "Σ", "e\u0301", "\u0301", " world", "x" * 17, "y" * 16, "z" * 15 + "é", "z" * 300, "<", "|", "\x7f", "½", "Å", "K", "<|endoftext|>", "\x1c",
    ]
    for _ in range(40):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(20)] + [""]
        assert [np.frombuffer(x, encoder.type).tolist() for x in encoder.encode_all(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_process_keeps_one_object():
    class Model:
        pass

    first = kept("a", Model)
    assert kept("a", Model) is first
    gone = weakref.ref(first)
    del first
    kept("b", Model)
    left = gone() is not None
    assert not left
