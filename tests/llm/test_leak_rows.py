"""Leaks belong to rows, whatever the doc_ids and the blocks of the benchmark."""

import random

from test_operators import sentence

from lanewise.llm import decontaminate


def test_null_and_repeated_ids_with_many_blocks(spark):
    rng = random.Random(22)
    items = [sentence(rng, 8) for _ in range(9)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(None, f"a {item} b") for item in items] + [(7, f"c {item} d") for item in items]
    rows += [(7, sentence(rng, 9)), (None, sentence(rng, 9)), (None, None), (8, items[0] + " | " + items[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def leaks(block_bytes):
        found = decontaminate.find_items(docs, bench, block_bytes=block_bytes).collect()
        return sorted((repr(r.doc_id), sorted((x.item_id, x.errors) for x in r.leaks)) for r in found)

    one = sorted(
        (repr(i), [(j, 0) for j, item in enumerate(items) if item in (text or "")]) for i, text in rows
    )
    assert leaks(4 << 20) == one
    for block_bytes in (40, 200):
        assert leaks(block_bytes) == one
