"""SimHash classes, collocations and source divergence against plain versions, with odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tablecheck.llm import bitmaps, divergence, golay_near_duplicates, phrase_counting, words

MIXED = "doc_id long, text string, lang string, source string, fp string, salt long, n long, shard int, term string"


def table(spark, rows):
    """Rows (id, text, lang, source) beside columns named like those that the operators make."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "y") for r in rows], MIXED).repartition(3)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- fingerprints -------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    label = list(range(len(nodes)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                label[root(i)] = root(j)
    return [root(i) for i in range(len(nodes))]


def plain_classes(rows):
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    roots = plain_components(fps, lambda a, b: bin(a ^ b).count("1") <= 2)
    low = {}
    for (i, *_), r in zip(rows, roots):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return sorted(((i, f"{fp:016x}", low.get(r)) for (i, *_), fp, r in zip(rows, fps, roots)), key=repr)


def test_golay_words_within_two_bits_share_a_codeword():
    errors = golay_near_duplicates.error_table()
    assert sorted(Counter(len(set(row)) for row in errors.tolist()).items()) == [(1, 277), (6, 1771)]
    random.seed(1)
    words = np.array([random.getrandbits(23) for _ in range(400)], dtype=np.int64)
    for flips in [0, *(1 << b for b in range(23)), *(1 << a | 1 << b for a in range(23) for b in range(a))]:
        one, other = golay_near_duplicates.codeword_indices(words, errors), golay_near_duplicates.codeword_indices(words ^ flips, errors)
        assert (one[:, :, None] == other[:, None, :]).any(axis=(1, 2)).all()


@pytest.mark.parametrize("bucket", [1, 3, 64])
def test_links_of_fingerprints(spark, bucket):
    random.seed(2)
    fps = set()
    for _ in range(12):
        base = random.getrandbits(64)
        fps |= {base, *(base ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) for _ in range(9))}
        fps.add(base ^ sum(1 << b for b in random.sample(range(64), 3)))
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = golay_near_duplicates.links(spark.createDataFrame([(f,) for f in fps], "fp long"), bucket).collect()
    place = {f: i for i, f in enumerate(fps)}
    pairs = {frozenset((place[r.a], place[r.b])) for r in found}
    expected = plain_components(fps, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 2)
    got = plain_components(range(len(fps)), lambda i, j: frozenset((i, j)) in pairs)
    assert len(set(expected)) < len(fps) and [expected.index(x) for x in expected] == [got.index(x) for x in got]


@pytest.mark.parametrize("bucket", [1, 64])
def test_near_duplicates_by_fingerprint(spark, bucket):
    random.seed(3)
    words = [f"W{i}É" for i in range(60)]
    rows = []
    for group in range(8):
        base = random.choices(words, k=300)
        rows += [(group * 10, " ".join(base)), (group * 10 + 1, "\t ".join(base)), (group * 10 + 1, " \n".join(base + ["tail"]))]
        rows.append((group * 10 + 2, " ".join(base[:150] + ["other"] + base[151:])))
    rows += [(900, None), (901, ""), (902, " \x0b "), (None, "a b"), (None, "a b"), (None, ""), (905, "A B"), (905, "a\x1cb c"), (-7, "a b")]
    rows = [(i, t, None, None) for i, t in rows]
    got = sorted(map(tuple, golay_near_duplicates.near_duplicates(table(spark, rows), bucket=bucket).collect()), key=repr)
    assert got == plain_classes(rows)
    assert golay_near_duplicates.near_duplicates(table(spark, rows).limit(0)).count() == 0


def test_long_texts_hash_as_whole_ones(monkeypatch):
    random.seed(4)
    text = " ".join(random.choices(["aa", "b", "c" * 50, "\n", "d\te"], k=400))
    whole = np.concatenate(list(golay_near_duplicates.shingle_hashes(text.encode())))
    monkeypatch.setattr(golay_near_duplicates, "spaced_words", lambda t: words.spaced_words(t, 7))
    assert np.array_equal(np.concatenate(list(golay_near_duplicates.shingle_hashes(text.encode()))), whole)
    assert golay_near_duplicates.fingerprints_of([text.encode()])[0] == plain_fingerprint(text)


# --- collocations -------------------------------------------------------------------------------


def plain_collocations(rows, threshold=10, limit=2000):
    f = defaultdict(Counter)
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in (1, 2, 3):
                f[lang if lang is not None else "und"].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        often = {p: a for p, a in c.items() if len(p) > 1 and a >= threshold}
        left = []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in often.items()):
                continue
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            left.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(left)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def phrase_rows(n=400):
    random.seed(5)
    words = ["New", "york", "city", "of", "the", "É", "a#b", "x y", "rare", "San", "josé"]
    rows = []
    for i in range(n):
        parts = random.choices(words, weights=[5, 5, 5, 9, 9, 2, 1, 1, 0.1, 3, 3], k=random.randint(0, 12))
        text = "".join(p + random.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n"]) for p in parts)
        rows.append((random.choice([i, None, 7]), text, random.choice(["en", "en", "en", None, "", "und"]), None))
    return rows + [(1, None, "en", None), (2, "", None, None), (3, "new york city " * 30, "few", None)]


@pytest.mark.parametrize("shards", [1, 3])
def test_collocations(spark, shards):
    rows = phrase_rows()
    got = sorted(map(tuple, phrase_counting.collocations(table(spark, rows), shards=shards, limit=25).collect()))
    assert got == plain_collocations(rows, limit=25) and len(got) > 30


def test_collocations_do_not_depend_on_wrong_admissions(spark, monkeypatch):
    rows = phrase_rows(200)
    exact, noise = bitmaps.bitmap, np.random.default_rng(6).integers(0, 256, (9, len(bitmaps.empty())), dtype=np.uint8)
    turn = iter(noise)
    monkeypatch.setattr(bitmaps, "bitmap", lambda slots: exact(slots) | next(turn))
    assert sorted(map(tuple, phrase_counting.collocations(table(spark, rows), shards=2).collect())) == plain_collocations(rows)


def test_collocations_of_long_texts_and_of_none(spark, monkeypatch):
    monkeypatch.setattr(phrase_counting, "UNIT", 40)
    rows = phrase_rows(60) + [(5, " ".join(["one two. three"] * 300), "en", None), (6, "w" * 500 + " one two", "en", None)]
    assert sorted(map(tuple, phrase_counting.collocations(table(spark, rows)).collect())) == plain_collocations(rows)
    assert phrase_counting.collocations(table(spark, rows).limit(0)).count() == 0


# --- divergence of sources ----------------------------------------------------------------------


def plain_divergence(rows, least, limit=50):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(count):
            size = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (size + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            term = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(sorted(pair), 1)]
            out += [(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(sorted(term)[:limit], 1)]
    return sorted(out)


def source_rows():
    random.seed(7)
    words = [f"{a}{b}" for a in "aBcé漢" for b in "xYzẞ"]
    rows = []
    for i in range(300):
        source = random.choice(["news", "web", "web", "web", None, "", "Books", *"abcdefghij"])
        mine = random.choices(words, weights=[(sum(map(ord, w + (source or ""))) % 5 + 1) for w in words], k=random.randint(0, 30))
        rows.append((i % 5, "".join(w + random.choice(" 1-\n_[`{\x7f") for w in mine), random.choice(["en", "en", "de", None]), source))
    return rows + [(1, None, "en", "silent"), (2, "", "fr", "alone"), (3, "some words", "it", "a"), (4, "12 34", "it", "b")]


@pytest.mark.parametrize("tile, block", [(8, 256), (2, 3)])
def test_divergence(spark, monkeypatch, tile, block):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "ENTRIES", 8 * block)
    monkeypatch.setattr(divergence, "TOKENS", 50)
    rows = source_rows()
    got = divergence.divergence(table(spark, rows), min_documents=12, limit=5)
    assert sorted(map(tuple, got.collect())) == plain_divergence(rows, 12, 5)
    assert divergence.divergence(table(spark, rows).limit(0)).count() == 0


def test_divergence_without_kept_terms(spark):
    rows = source_rows()
    got = sorted(map(tuple, divergence.divergence(table(spark, rows), min_documents=10**6).collect()))
    assert got == plain_divergence(rows, 10**6) and {r[4] for r in got} == {0}


def test_joint_tables_price_as_plain_sums():
    rng = np.random.default_rng(8)
    left, right = rng.integers(1, 6, (90, 4)) * 10**8, rng.integers(1, 9, (90, 3)) * 10**7
    assert np.array_equal(divergence.block_prices(left, right), np.abs(left[:, :, None] - right[:, None, :]).sum(axis=0))


def test_slot_map_is_stored_edited_and_read_back(spark, tmp_path):
    """Two stored versions, each against a plain loop over the slots."""
    from tablecheck.llm import sharding

    random.seed(11)
    sizes = [random.choice([0, random.randrange(1, 2000)]) for _ in range(300)]
    shards, path = 7, str(tmp_path / "map")

    def given(held, n):
        """Slots without a shard, heaviest first, to the lightest shard."""
        loads = [sum(sizes[s] for s, h in held.items() if h == i) for i in range(n)]
        out = dict(held)
        for s in sorted((s for s in range(len(sizes)) if s not in held), key=lambda s: (-sizes[s], s)):
            out[s] = loads.index(min(loads))
            loads[out[s]] += sizes[s]
        return out

    df = spark.createDataFrame(list(enumerate(sizes)), "virtual_slot int, size long")
    sharding.write_map(sharding.new_map(df, shards), path)
    first = {r.virtual_slot: r.shard for r in sharding.read_map(spark, path).collect()}
    assert first == given({}, shards)
    sharding.write_map(sharding.rebalanced(sharding.read_map(spark, path), df, shards + 1), path)
    share, held = sum(sizes) / (shards + 1) * 1.01, {}
    for i in range(shards):
        total = 0
        for s in sorted((s for s, h in first.items() if h == i), key=lambda s: (sizes[s], s)):
            total += sizes[s]
            if total <= share:
                held[s] = i
    assert {r.virtual_slot: r.shard for r in sharding.read_map(spark, path).collect()} == given(held, shards + 1)
    assert {r.virtual_slot: r.shard for r in sharding.read_map(spark, path, 1).collect()} == first
    assert {r.version for r in sharding.read_map(spark, path).collect()} == {2}


def test_deeply_nested_pages_take_linear_time():
    import time

    from tablecheck.llm import html_text

    started = time.process_time()
    blocks = html_text.leaf_blocks("<div class='x'>word" * 100_000 + "</span></em>" * 100_000, {"in div": 1.0, "name x": 0.5, "at div": 2.0, "bias": 0.25})
    assert len(blocks) == 100_000 and {b.score for b in blocks} == {3.75}
    assert time.process_time() - started < 20
    page = "<body><div class='a b'><p>one <b>two</b><p>three</div><nav><ul><li>m<li><a>n</a></ul></nav>four"
    weights = {f: i + 0.5 for i, f in enumerate(sorted({f for b in html_text.leaf_blocks(page) for f in html_text.path_features(b.path)}))}
    for plain, weighed in zip(html_text.leaf_blocks(page), html_text.leaf_blocks(page, weights), strict=True):
        assert plain.text == weighed.text and weighed.score == sum(weights[f] for f in html_text.path_features(plain.path))
