from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gondola.llm import merkle
from gondola.llm.queries import signed

SF_DIR = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def record(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves, arity):
    """All levels, and for each leaf its siblings by level."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k : k + arity])) for k in range(0, len(last), arity)])
    paths = []
    for k in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            run = k // arity * arity
            path.append((level[run:k], level[k + 1 : run + arity]))
            k //= arity
        paths.append(path)
    return levels[-1][0], paths


def brute(rows, tamper, arity=2):
    """Rows (doc_id, source, lang, n_chars, text) -> expected results, sorted."""
    groups = {}
    for row in rows:
        changed = (*row[:3], row[3] if row[3] is None else row[3] + tamper(row[0]), row[4])
        groups.setdefault(row[2], []).append((row[0], record(row), record(changed)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = tree([r[1] for r in groups[g]], arity)
    root, crown = tree([trees[g][0] for g in order], arity)
    out = []
    for g, above in zip(order, crown, strict=True):
        for (i, leaf, changed), path in zip(groups[g], trees[g][1], strict=True):
            node = changed
            for before, after in path + above:
                node = sha("".join(before) + node + "".join(after))
            proof = sha("".join("".join(b) + "".join(a) for b, a in path + above))
            out.append((i, leaf, trees[g][0], root, proof, node, node == root))
    return sorted(out, key=str)


def seventh(doc_id):
    return int(zlib.crc32(str(doc_id).encode()) % 7 == 0) if doc_id is not None else 0


def run(docs, tamper, **options):
    names = [F.col(n) for n in FIELDS]
    found = merkle.manifest(docs, merkle.record_hash(*names), merkle.record_hash(*names[:3], tamper, names[4]), **options)
    assert found.columns[:8] == ["doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return found


def tampered():
    return F.col("n_chars") + F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, 1).otherwise(0)


@pytest.mark.parametrize(("arity", "depth"), [(2, 10), (2, 1), (2, 3), (3, 2)])
def test_table_in_superblocks_of_any_size(small, arity, depth):
    rows = [tuple(r) for r in small.select(*FIELDS).collect()]
    found = run(small, tampered(), arity=arity, depth=depth).drop("lang").collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, seventh, arity)
    assert 0 < sum(not r.verified for r in found) < len(found)


def test_odd_rows(odd):
    """Nulls in every column, a null group, repeated ids and rows."""
    rows = [tuple(r) for r in odd.select(*FIELDS).collect()]
    for docs in (odd, odd.unionByName(odd).repartition(3)):
        found = run(docs, tampered(), depth=2).drop("lang").collect()
        assert sorted(map(tuple, found), key=str) == brute(rows * (len(found) // len(rows)), seventh)


def test_proofs_can_be_followed(small):
    for r in run(small, F.col("n_chars"), depth=4, proofs=True).collect():
        assert r.verified and merkle.folded(r.leaf, r.proof) == r.root


def test_no_rows_and_one_row(small, empty):
    assert run(empty, F.col("n_chars")).collect() == []
    [one] = run(small.limit(1), F.col("n_chars")).collect()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == sha("")


def test_root_does_not_depend_on_the_layout(small):
    roots = {run(docs, F.col("n_chars")).select("root").first().root for docs in (small, small.repartition(7, "text"), small.orderBy("text"))}
    assert len(roots) == 1


def test_large_ids_and_text_ids(spark):
    docs = spark.createDataFrame([(2**62 + 1, None, None, None, "a"), (2**62, None, None, None, "b"), (None, None, None, 1, None)], "doc_id long, source string, lang string, n_chars long, text string")
    assert {r.doc_id for r in run(docs, F.col("n_chars")).collect()} == {2**62 + 1, 2**62, None}


def test_query_equals_brute_force(spark, small):
    rows = [tuple(r) for r in small.select(*FIELDS).collect()]
    assert sorted(map(tuple, signed(spark, SF_DIR).collect()), key=str) == brute(rows, seventh)
