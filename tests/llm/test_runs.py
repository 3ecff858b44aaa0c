"""The suffix tree that is a table, against plain dictionaries."""

import random
from collections import Counter, defaultdict
from math import log, log10

import pytest
from test_operators import WORDS, odd_texts, sentence, table  # noqa: F401

from lanewise.llm import suffix_tree


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def brute_scores(texts, least, divergence, discount):
    counts = Counter(w for t in texts for w in tokens(t))
    total = sum(counts.values())
    after = defaultdict(Counter)

    def places(t):
        seen = [b"\n"]
        for w in tokens(t):
            yield w, [tuple(seen[-d:]) for d in (1, 2, 3) if d <= len(seen)]
            seen.append(w)

    for t in texts:
        for w, contexts in places(t):
            for c in contexts:
                after[c][w] += 1
    kept = {}
    for c, nexts in after.items():
        stored = {w: n for w, n in nexts.items() if n >= least}
        below = after[c[1:]] if len(c) > 1 else counts
        p = {w: n / sum(nexts.values()) for w, n in stored.items()}
        q = {w: below[w] / sum(below.values()) for w in stored}
        apart = sum(p[w] * log(p[w] / q[w]) for w in stored)
        if len(stored) and sum(stored.values()) < sum(nexts.values()):
            left = 1 - sum(p.values())
            apart += left * log(left / (1 - sum(q.values())))
        if stored and apart >= divergence:
            kept[c] = stored, sum(nexts.values())

    def score(t):
        result = 0.0
        for w, contexts in places(t):
            chance = (counts[w] - discount) / total if w in counts else discount * len(counts) / total
            for c in contexts:
                if c in kept:
                    stored, n = kept[c]
                    weight = n - sum(stored.values()) + len(stored)
                    chance = (stored.get(w, 0) + weight * chance) / (n + len(stored))
            result += log10(chance)
        return result

    return score, len(kept)


def test_runs(spark, odd_texts):  # noqa: F811
    rng = random.Random(15)
    mill = "the old Mill by the stream"
    texts = odd_texts + [" ".join(rng.choices(WORDS, k=30)) + f" {mill} " + sentence(rng, 3) for _ in range(60)]
    texts += ["", None, "the old", mill, f"{mill}\n{mill}", "no word of these"]
    docs = table(spark, texts)
    train = docs.filter("doc_id < 50").repartition(5)
    for least, divergence in ((3, 0.05), (2, 0.5)):
        model = suffix_tree.fit_model(train, least=least, divergence=divergence)
        score, kept = brute_scores(texts[:50], least, divergence, model.discount)
        assert kept > 50
        for most_words, most_runs in ((200_000, 1_000_000), (3, 20), (3, 0)):
            got = suffix_tree.score_texts(docs, model, most_common=most_words, most_runs=most_runs).collect()
            assert sorted(r.doc_id for r in got) == list(range(len(texts)))
            for r in got:
                assert r.score == pytest.approx(score(texts[r.doc_id]))


def test_a_passage_is_not_forgotten_in_a_larger_corpus(spark):
    """What stands twelve times is known among many tokens as among few."""
    rng = random.Random(16)
    passage = "quiet harbour lamps burn over sleeping boats tonight"
    gains = []
    for size in (20, 1000):
        rows = [(i, " ".join(rng.choices(WORDS, k=200))) for i in range(size)]
        rows += [(size + i, passage) for i in range(12)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        scored = suffix_tree.score_texts(docs, suffix_tree.fit_model(docs)).filter(f"doc_id = {size}").first()
        gains.append(scored.score - scored.base_score)
    assert gains[1] > gains[0] > 10


def test_no_texts(spark):
    docs = table(spark, [None, "", "a b"])
    nothing = suffix_tree.fit_model(docs.limit(0))
    assert {r.train_tokens for r in suffix_tree.score_texts(docs, nothing).collect()} == {0}
    assert suffix_tree.score_texts(docs.limit(0), suffix_tree.fit_model(docs)).count() == 0
