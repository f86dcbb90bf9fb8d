from __future__ import annotations

import random

import numpy as np
import pytest
from corpus_support import prose

from gondola.llm.near_texts import folded, near_text_components, parities
from gondola.llm.simhash import hash_shingles


def brute(rows, similarity=0.8):
    sets = [(i, frozenset(hash_shingles((t or "").encode(), 5))) for i, t in rows]
    group = {i: i for i, _ in sets}
    while True:
        new = {i: min(group[j] for j, b in sets if a == b or (a | b and len(a & b) >= similarity * len(a | b))) for i, a in sets}
        if new == group:
            return group
        group = new


def edited(text, every, rng):
    words = text.split()
    for k in range(rng.randint(0, every - 1), len(words), every):
        words[k] = "".join(rng.choices("xyz", k=4))
    return " ".join(words)


def copies():
    rng = random.Random(11)
    shared = prose(99, 60)
    rows = []
    for k in range(60):
        text = prose(k, rng.randint(3, 300)) + (" " + shared if k % 2 else "")
        rows += [text, *(edited(text, rng.choice([20, 40, 60, 90, 200]), rng) for _ in range(rng.randint(0, 4))), text.upper()]
    base = prose(1000, 200)
    rows += [edited(base, 50, rng) for _ in range(80)] + [None, "", " \n", "one", "One"]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("tile", [2048, 8])
def test_equals_brute_force(spark, tile):
    rows = copies()
    found = near_text_components(spark.createDataFrame(rows, "doc_id long, text string"), tile=tile).collect()
    assert {r.doc_id: r.component_id for r in found} == brute(rows) and len(found) == len(rows)


def test_repeats_within_a_text_lose_no_pair(spark):
    """A line that one text repeats and the other hardly does tells nothing about their sets."""
    rng, rows = random.Random(5), []
    for k in range(60):
        words = prose(k, 150).split()
        line = " " + prose(1000 + k, 8)
        rows.append((2 * k, " ".join(words) + 2 * line))
        words[rng.randrange(150)] = "zzzz"
        rows.append((2 * k + 1, " ".join(words) + 50 * line))
    found = {r.doc_id: r.component_id for r in near_text_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute(rows) == {i: i - i % 2 for i, _ in rows}


def test_parities_bound_the_difference():
    rng = np.random.default_rng(3)
    for n in (1, 5, 70, 127, 128, 900, 5000):
        own = np.unique(rng.integers(0, 2**64, n, np.uint64))
        for kept in (0, n // 2, n - n // 10, n):
            other = np.unique(np.concatenate([own[:kept], rng.integers(0, 2**64, n - kept + n // 9, np.uint64)]))
            odd = [parities(own).tobytes(), parities(other).tobytes()]
            flat, at = folded(odd, np.full(2, min(map(len, odd)) // 8))
            differ = int(np.bitwise_count(flat[: at[1]] ^ flat[at[1] :]).sum())
            assert differ <= len(np.setxor1d(own, other))
            assert kept or n < 900 or differ > (len(own) + len(other)) / 9


def test_table(small, empty):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    assert {r.doc_id: r.component_id for r in near_text_components(small).collect()} == brute(rows)
    assert near_text_components(empty).count() == 0


def similar_pairs(rows, similarity=0.8):
    """All pairs of different sets with that similarity, exactly: such a pair shares one of the rarest
    shingles of each."""
    from collections import Counter, defaultdict
    from math import ceil

    sets = list({frozenset(hash_shingles((t or "").encode(), 5)): i for i, t in rows})
    often = Counter(h for s in sets for h in s)
    holders, pairs = defaultdict(list), set()
    for k, own in enumerate(sets):
        rarest = sorted(own, key=lambda h: (often[h], h))[: len(own) - ceil(similarity * len(own)) + 1]
        for j in {j for h in rarest for j in holders[h]}:
            other = sets[j]
            if min(len(own), len(other)) >= similarity * max(len(own), len(other)) and len(own & other) >= similarity * len(own | other):
                pairs.add((j, k))
        for h in rarest:
            holders[h].append(k)
    return sets, pairs


def recall(spark, sf_dir):
    """Linked pairs of different texts, and how many of them lie in one group of the result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets, pairs = similar_pairs(rows)
    group = {r.doc_id: r.component_id for r in near_text_components(docs).collect()}
    of_set = {frozenset(hash_shingles((t or "").encode(), 5)): group[i] for i, t in rows}
    return len(pairs), sum(of_set[sets[a]] == of_set[sets[b]] for a, b in pairs)


def test_recall_on_a_thousand_documents(spark):
    linked, kept = recall(spark, "/root/testdata/sf0.01")
    print(f"linked pairs {linked}, kept together {kept}")
    assert kept == linked > 0
