from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gondola.llm import simhash


def plain(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints, ids, most):
    group = list(range(len(prints)))
    while True:
        new = [min(group[j] for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= most) for i in range(len(prints))]
        if new == group:
            break
        group = new
    least = {}
    for g, i in zip(group, ids, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [least.get(g) for g in group]


def test_whole_table_equals_brute_force(small):
    rows = simhash.near_components(small).join(small.select("doc_id", "text"), "doc_id").collect()
    prints = [plain(r.text) for r in rows]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    assert [r.component_id for r in rows] == brute(prints, [r.doc_id for r in rows], 4)
    assert len(rows) == small.count()


def test_odd_rows(odd, empty):
    rows = simhash.near_components(odd).collect()
    texts = odd.select("doc_id", "text").collect()
    prints = [plain(r.text) for r in texts]
    want = sorted(zip((str(r.doc_id) for r in texts), (f"{p:016x}" for p in prints), map(str, brute(prints, [r.doc_id for r in texts], 4)), strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want
    assert simhash.near_components(empty).count() == 0


@pytest.mark.parametrize("tile", [4096, 16])
def test_dense_groups_in_tiles(spark, tile):
    """Balls around a few centres, and random fingerprints: tiles, buckets and pivots lose no link."""
    rng = np.random.default_rng(8)
    centres = rng.integers(0, 2**64, 4, np.uint64)
    bits = {int(c) for c in centres} | {int(x) for x in rng.integers(0, 2**64, 200, np.uint64)}
    for c in centres:
        for _ in range(120):
            flips = sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 9), replace=False))
            bits.add(int(c) ^ flips)
    bits = sorted(bits)
    table = spark.createDataFrame([(b - 2**64 if b >= 2**63 else b,) for b in bits], "bits long")
    found = simhash.links(table, 4, tile).collect()
    at = {b: i for i, b in enumerate(bits)}
    i = np.array([at[r.a % 2**64] for r in found])
    j = np.array([at[r.b % 2**64] for r in found])
    # Links may name the smallest of a group instead of the neighbour, but never leave a component.
    whole = brute(bits, range(len(bits)), 4)
    assert all(whole[a] == whole[b] for a, b in zip(i, j, strict=True)) and len(i)
    root = simhash.unite(np.arange(len(bits)), i, j)
    assert root.tolist() == brute(bits, range(len(bits)), 4)


def test_pivots_discard_only_what_verification_would():
    rng = np.random.default_rng(9)
    bits = rng.integers(0, 2**64, 300, np.uint64)
    bits[150:] = bits[:150] ^ np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 8), replace=False)) for _ in range(150)], np.uint64)
    i, j = np.triu_indices(300, 1)
    a, b = simhash.linked(simhash.distance_table(bits, simhash.PIVOTS), bits, i, j, 4)
    near = np.bitwise_count(bits[i] ^ bits[j]) <= 4
    assert (a == i[near]).all() and (b == j[near]).all() and len(a)


@pytest.mark.parametrize("n", [1, 100, 10**4, 10**6, 10**9, 10**12])
def test_blocks_cover_all_bits(n):
    widths, same = simhash.plan_blocks(n, 4)
    assert sum(widths) == 64 and len(widths) - same == 4


def test_majority_of_many_hashes():
    rng = np.random.default_rng(2)
    counts = np.array([0, 1, 2, 254, 255, 256, 0, 1000, 511])
    hashes = rng.integers(0, 2**64, counts.sum(), np.uint64)
    want, at = [], 0
    for n in counts:
        own = hashes[at : at + n]
        at += n
        want.append(sum(1 << b for b in range(64) if 2 * int(((own >> np.uint64(b)) & np.uint64(1)).sum()) > n))
    assert simhash.majority(hashes, counts).tolist() == want


def test_copies_share_a_fingerprint(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("one two three four five six").alias("text"))
    assert {r.component_id for r in simhash.near_components(docs).collect()} == {0}


def test_what_pivot_tables_discard(spark):
    """Of the pairs that share a key on the table of 10,000 documents, how many no pivot lets pass,
    and how many of the rest are links: printed, and stated in the README."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    bits = np.array([r.bits for r in simhash.fingerprints(docs, 4).select("bits").distinct().collect()], np.int64)
    widths, same = simhash.plan_blocks(len(bits), 4)
    import pandas as pd

    keyed = pd.concat(simhash._keys(iter([pd.DataFrame({"bits": bits})]), widths, same))
    met = passed = near = 0
    for _, group in keyed.groupby("key")["bits"]:
        if len(group) > 1:
            own = group.to_numpy().view(np.uint64)
            i, j = np.triu_indices(len(own), 1)
            table = simhash.distance_table(own, simhash.PIVOTS)
            keep = (np.abs(table[:, i] - table[:, j]) <= 4).all(axis=0)
            met, passed = met + len(i), passed + int(keep.sum())
            near += int((np.bitwise_count(own[i] ^ own[j]) <= 4).sum())
    print(f"pairs that share a key {met}, left by the tables {passed}, links {near}")
    assert near <= passed < met
