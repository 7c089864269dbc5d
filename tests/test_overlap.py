"""J1 over all label pairs against sets; labels over chunks, repeats, NULLs, ids of any size."""

from __future__ import annotations

import random
from itertools import combinations

from dfinsight.operators.overlap import CHUNK, label_overlaps


def test_overlaps_equal_sets(spark):
    rnd = random.Random(5)
    ids = [*range(0, 300), *range(CHUNK - 100, CHUNK + 100), -5, -CHUNK - 1, 10**12, 2**62]
    have = {label: {i for i in ids if rnd.random() < p} for label, p in (("most", .9), ("half", .5), ("few", .02), ("", .1), ("é", .3))} | {"lone": {2**62 - 7}}
    rows = [(i, label) for label, own in have.items() for i in own]
    rows += rows[:50] + [(None, "most"), (1, None)]
    got = label_overlaps(spark.createDataFrame(rows, "i long, label string").repartition(4), "i", "label").collect()
    want = {(a, b, len(have[a] & have[b]), len(have[a]), len(have[b])) for a, b in combinations(sorted(have), 2) if have[a] & have[b]}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_many_labels_in_one_chunk(spark):
    rows = [(i, f"l{j:04d}") for i in range(40) for j in range(i, 1200, 40)] + [(i, "all") for i in range(40)]
    got = label_overlaps(spark.createDataFrame(rows, "i long, label string"), "i", "label")
    assert got.filter("label_a = 'all'").count() == 1200 and got.filter("label_a <> 'all'").count() == 40 * (30 * 29 // 2)
    assert label_overlaps(spark.createDataFrame([], "i long, label string"), "i", "label").count() == 0
