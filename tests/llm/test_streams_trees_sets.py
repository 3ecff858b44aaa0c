"""Collocation streams, the Merkle manifest and the Jaccard join against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import find_roots, odd_texts, sentence, table  # noqa: F401

from lanewise.llm import collocations, jaccard_join, merkle

# Collocations


def brute_collocations(rows, least, first):
    """rows: (text, lang)."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] = counts.get((lang, tuple(words[i : i + k])), 0) + 1
    out = []
    for lang in totals:
        found = []
        for (of, words), a in counts.items():
            if of != lang or len(words) == 1 or a < least:
                continue
            cuts = [
                (collocations.SCALE * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k)
                for k in range(1, len(words))
            ]
            score, k = min(cuts)
            covered = any(
                of2 == lang and len(w) == 3 and n >= least and len(words) == 2 and words in (w[:2], w[1:]) and 100 * n >= 50 * a
                for (of2, w), n in counts.items()
            )
            if not covered:
                found.append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("ranges", [4, 50_000])
def test_collocations(spark, ranges, monkeypatch):
    monkeypatch.setattr(collocations, "_RANGE_ROWS", ranges)
    monkeypatch.setattr(collocations, "_HELD", 50)
    monkeypatch.setattr(collocations, "_HASHES", 100)
    monkeypatch.setattr(collocations, "_SLICE", 40)
    rng = random.Random(3)
    words = ["a", "a\x01", "b", "B", "of", "the", "été", "\U0010ffff", "x\x00", "new", "york"]
    rows = [(None, "en"), ("", "en"), (" \t\n", None), ("...", "de")]
    for i in range(120):
        text = "".join(
            ("new york city" if rng.random() < 0.1 else rng.choice(words)) + rng.choice([" "] * 8 + ["\t", ". ", "\n", "; ", "\r"])
            for _ in range(rng.randint(1, 60))
        )
        rows.append((text, rng.choice(["en", "en", "fr", None])))
    rows += rows[-20:]
    docs = spark.createDataFrame(
        [(i, t, lang, "x", 1, "y") for i, (t, lang) in enumerate(rows)],
        "doc_id long, text string, lang string, phrase string, n int, words string",
    )
    got = collocations.mine_collocations(docs, least=3, first=40).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 3, 40)
    assert collocations.mine_collocations(docs.limit(0)).count() == 0


def test_scores_past_64_bits():
    huge = 10**17
    assert collocations.weakest_cut(huge, [huge + 7], [huge + 9])[0] == 10**6 * huge * huge // ((huge + 7) * (huge + 9))
    # Ties after flooring go to the first cut.
    assert collocations.weakest_cut(10, [100, 100], [100, 100]) == (10_000, 100, 100)


def test_texts_of_phrases_and_bounded_holding(spark, monkeypatch):
    flat = np.frombuffer(b"a \t b  c\nd\n\xc3\xa4 b\n", np.uint8)
    starts, ends = np.array([11, 0, 9, 0]), np.array([15, 8, 10, 5])
    assert collocations.phrase_texts(flat, starts, ends).to_pylist() == ["\xe4 b", "a b c", "d", "a b"]
    assert collocations.phrase_texts(flat, starts[:0], ends[:0]).to_pylist() == []

    class Texts:
        def mapInArrow(self, run, schema):
            self.run = run
            return self

        def groupBy(self, *keys):
            return self

        def agg(self, *columns):
            return self.run

    monkeypatch.setattr(collocations, "_HELD_BYTES", 100)
    monkeypatch.setattr(collocations, "_SLICE", 40)
    every = SimpleNamespace(value=np.full((1 << collocations.FILTER_BITS) // 8, 255, np.uint8))
    texts = collocations.pa.RecordBatch.from_pydict({"lang": ["x"] * 50, "text": ["some rare words here"] * 50})
    # What is held is sent on and let go after a hundred bytes of text.
    sent = list(collocations.count_phrases(Texts(), [every])(iter([texts])))
    counts = Counter()
    for row in (r for b in sent for r in b.to_pylist()):
        counts[row["phrase"]] += row["n"]
    assert len(sent) > 8 and counts == {"some": 50, "rare": 50, "words": 50, "here": 50, None: 200}


def test_bitmap_has_every_frequent_phrase(spark):
    rng = np.random.default_rng(1)
    hashes = np.r_[rng.integers(-(2**63), 2**63, 3000, np.int64), [0, -1, 2**63 - 1, -(2**63)]]
    bits = collocations._bitmap(spark.createDataFrame([(int(x),) for x in hashes], "hash long"))
    assert collocations.passes(hashes.view(np.uint64), bits).all()
    other = rng.integers(0, 2**63, 3000, np.uint64)
    assert collocations.passes(other, bits).sum() < 30


def test_a_sieve_sends_few_bytes_a_hash(monkeypatch):
    """What the hashes of a sieve take on their way, and what it finds."""
    batches, groups = [], {}

    class Texts:
        def mapInArrow(self, run, schema):
            batches.extend(run(iter([texts])))
            return self

        def groupBy(self, *keys):
            for batch in batches:
                for row in batch.to_pylist():
                    groups.setdefault(row["deal"], []).append(row)
            return self

        def applyInArrow(self, frequent, schema):
            self.found = [frequent(collocations.pa.Table.from_pylist(rows)) for rows in groups.values()]
            return self

        def toLocalIterator(self):
            return (SimpleNamespace(**row) for table in self.found for row in table.to_pylist())

    rng = random.Random(8)
    words = [f"w{i}" for i in range(20_000)]
    texts = [" ".join(rng.choices(words, k=100)) for _ in range(2000)] + ["often " * 9, "seldom " * 8]
    texts = collocations.pa.RecordBatch.from_pydict({"lang": ["x"] * len(texts), "text": texts})
    bits = collocations.sieve(Texts(), [], 9)
    assert sum(batch.nbytes for batch in batches) < 5 * 200_000
    slices = [slice_ for _, slice_ in collocations._slices(iter([texts]))]
    hashes, n = np.unique(np.concatenate([s.words for s in slices]), return_counts=True)
    assert collocations.passes(hashes[n >= 9], bits).all()
    assert collocations.passes(hashes[n < 9], bits).mean() < 0.01


def test_long_texts_are_cut_at_borders(monkeypatch):
    monkeypatch.setattr(collocations, "_SLICE", 10)
    text = b"one two three four\nfive\nsix seven\n\neight nine ten eleven"
    found = list(collocations.parts(text))
    assert b"\n".join(found) == text and max(map(len, found)) == 21 and len(found) > 3


# Merkle manifest


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    """Root, and for every leaf (place in the run, others of the run) level by level."""
    paths, nodes, places = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for i, place in enumerate(places):
            run = nodes[place - place % 3 : place - place % 3 + 3]
            paths[i].append((place % 3, run[: place % 3] + run[place % 3 + 1 :]))
            places[i] = place // 3
        nodes = [h(nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute_manifest(rows, tampered):
    def leaf(row, text):
        values = [row[0], row[1], row[2], row[3], text]
        return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)

    by = {}
    for row in rows:
        by.setdefault(row[1], []).append((row, leaf(row, row[4])))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for own in by.values():
        own.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = [brute_tree([d for _, d in by[s]]) for s in sources]
    root, tops = brute_tree([t[0] for t in trees])
    out = []
    for s, (subroot, paths), top in zip(sources, trees, tops, strict=True):
        for (row, digest), path in zip(by[s], paths, strict=True):
            whole = path + top
            value = leaf(row, tampered(row))
            for place, others in whole:
                value = h(others[:place] + [value] + others[place:])
            proof = h(d for _, others in whole for d in others)
            out.append(repr((row[0], digest, subroot, root, proof, value, value == root)))
    return sorted(out)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest(spark, height):
    rng = random.Random(height)
    rows = []
    for i in range(160):
        source = rng.choice([None, "", "hot", "hot", "hot", "b", "é", "z"])
        text = rng.choice([None, "", "a\nb", "one\n", sentence(rng, 5), "\n" + sentence(rng, 3)])
        rows.append((None if i % 40 == 3 else i % 120, source, rng.choice([None, "en", "fr"]), rng.choice([None, 7]), text))
    rows += rows[:3] + [(1, "alone", "en", 1, "x")]
    docs = spark.createDataFrame(
        [(*r, "x", "x", "x") for r in rows],
        "doc_id long, source string, lang string, n_chars long, text string, root string, leaf string, tree string",
    )

    def tampered(row):
        if row[0] is None or row[4] is None or zlib.crc32(str(row[0]).encode()) % 2:
            return row[4]
        return row[4].replace("\n", "")

    changed = merkle.without_newlines(F.col("doc_id"), F.col("text"))
    got = merkle.manifest(docs, tampered=changed, height=height).drop("source")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_manifest(rows, tampered)
    plain = merkle.manifest(docs, height=height)
    assert plain.filter("not verified").count() == 0 and plain.count() == len(rows)
    assert merkle.manifest(docs.limit(0), height=height).count() == 0


@pytest.mark.parametrize("levels", range(1, 8))
def test_van_emde_boas_order(levels):
    """Every node has a place of its own, and every lower subtree a stretch of its own."""
    places = merkle.addresses(levels)
    assert sorted(np.concatenate(places)) == list(range(merkle.nodes_of(levels)))

    def within(depth, index, height):
        rows = [places[depth + d][index * 3**d : (index + 1) * 3**d] for d in range(height)]
        return np.concatenate(rows)

    def contiguous(depth, index, height):
        found = np.sort(within(depth, index, height))
        assert found[-1] - found[0] == len(found) - 1
        if height > 1:
            top = height // 2
            contiguous(depth, index, top)
            for lower in range(3**top):
                contiguous(depth + top, index * 3**top + lower, height - top)

    contiguous(0, 0, levels)


# Jaccard join


def brute_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)} or ({" ".join(words)} if words else set())


def test_bands_hold_every_linked_pair():
    bands = jaccard_join.Bands(85)
    for small in range(1, 300):
        for large in range(small, small * 100 // 85 + 1):
            low, high = bands.of(small)[0], bands.of(large)[0]
            assert low <= high <= low + 1
            # The most that linked sets of these sizes can differ by is under m of the larger.
            shared = -(-(small + large) * 85 // 185)
            differ = small + large - 2 * shared
            schemes = dict(bands.segments(small)), dict(bands.segments(large))
            if shared > small or not differ:
                continue
            assert high in schemes[0] and schemes[0][high] == schemes[1][high] > differ


def test_sets_of_texts(monkeypatch):
    """As many shingles, and as many in common, as texts have; also where they are cut."""
    rng = random.Random(4)
    texts = [None, "", " \t", "a b c", "A B C", "a b c d", "a b c d a b c d", "é ñ ü", "x\x0by z w"]
    texts += [sentence(rng, n) for n in (5, 50, 400)] + [sentence(rng, 900) * 2]
    texts.append(texts[-2] + " tail")
    encoded = [t.encode() if t is not None else None for t in texts]
    for part in (1 << 19, 64):
        monkeypatch.setattr(jaccard_join, "_PART", part)
        found = [set(s.tolist()) for s in jaccard_join.shingle_sets(iter(encoded), 4)]
        brute = [brute_set(t, 4) for t in texts]
        assert list(map(len, found)) == list(map(len, brute))
        for (x, p), (y, q) in combinations(zip(found, brute), 2):
            assert len(x & y) == len(p & q)


def test_deletions_are_the_subsets_without_one():
    rng = np.random.default_rng(5)
    hashes = np.unique(rng.integers(0, 2**64, 60, np.uint64))
    segments, names = jaccard_join.deletions(hashes, 9, 7)
    for i in range(len(hashes)):
        rest = jaccard_join.subsets(np.delete(hashes, i), 9, 7)
        assert names[i] == rest[segments[i]]
    whole = jaccard_join.subsets(hashes, 9, 7)
    assert len(set(whole)) == 7 and not set(whole) & set(names)


def test_parities_never_say_too_much():
    rng = np.random.default_rng(6)
    for n, lost, new in [(10, 0, 0), (10, 1, 0), (300, 20, 15), (3000, 100, 200), (9000, 40, 0), (500, 500, 400)]:
        a = np.unique(rng.integers(0, 2**64, n, np.uint64))
        b = np.union1d(a[lost:], rng.integers(0, 2**64, new, np.uint64))
        differ = len(np.setxor1d(a, b))
        sketches = [jaccard_join._parities(s, jaccard_join.Bands(85).differ(2 * len(s))) for s in (a, b)]
        assert jaccard_join.least_difference(*sketches) <= differ
        assert jaccard_join.least_difference(*sketches) >= 0.7 * differ or differ > 0.2 * n


@pytest.mark.parametrize("limit,seed", [(64, 1), (1, 2)])
def test_jaccard_groups(spark, odd_texts, limit, seed):
    """Both ways, all pairs of a shared subset and the cheapest allocation, find every link."""
    rng = random.Random(seed)
    texts = list(odd_texts) + ["one two three", "ONE two\nthree", "a b c d", "a b c e"]
    for n in (7, 10, 20, 45, 90, 200):
        base = sentence(rng, n).split()
        for changes in (0, 0, 1, 1, 2, 3, 5):
            copy = list(base)
            for _ in range(changes):
                # Some changes shift or lengthen the text, which keeps more shingles than others.
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = sentence(rng, rng.randint(0, 2)).split()
            texts.append(" ".join(copy))
    passage = sentence(rng, 50)
    texts += [passage + " " + sentence(rng, k) for k in range(2, 14) for _ in range(3)]
    texts += [sentence(rng, 30) + " " + passage for _ in range(15)]
    docs = table(spark, texts)
    sets = [brute_set(t, 4) for t in texts]
    close = [
        (a, b)
        for a, b in combinations(range(len(texts)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    roots = find_roots(len(texts), close)
    got = {r.doc_id: r for r in jaccard_join.jaccard_groups(docs, list_rows=limit).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == roots
    assert 0 < len(close) and len(set(roots)) < len(texts)
    if limit == 64:
        twice = jaccard_join.jaccard_groups(docs.union(docs)).collect()
        assert sorted(r.component_id for r in twice) == sorted([*roots, *roots])
        assert jaccard_join.jaccard_groups(docs.limit(0)).count() == 0


def test_allocation_is_used(spark, monkeypatch):
    """Sets of one band that share many subsets: allowances are made up for, links are kept."""
    rng = random.Random(9)
    passage = sentence(rng, 200)
    texts = []
    for _ in range(12):
        own = passage + " " + sentence(rng, 20)
        texts += [own, own + " " + sentence(rng, 3)]
    spent = []
    real = jaccard_join._allocated

    def seen(*args):
        taken = real(*args)
        spent.append(taken.count())
        return taken

    monkeypatch.setattr(jaccard_join, "_allocated", seen)
    docs = table(spark, texts)
    sets = [brute_set(t, 4) for t in texts]
    close = [
        (a, b) for a, b in combinations(range(len(texts)), 2) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_groups(docs, percent=90, list_rows=3).collect()}
    assert [got[i] for i in range(len(texts))] == find_roots(len(texts), close)
    assert spent and spent[0] > 0
