"""Merkle manifest against a plain tree; tampering; odd tables."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from farthing.llm import merkle
from farthing.llm.queries import op12_merkle_manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, proof digest, root from the altered leaf), sorted."""
    groups, out = {}, []
    for r in rows:
        shown = r["text"].replace("\n", "") if r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 else r["text"]
        leaf, other = (digest(*(framed(v) for v in [*(r[f] for f in FIELDS[:-1]), text])) for text in (r["text"], shown))
        groups.setdefault(r["source"], []).append((r["doc_id"], leaf, other))
    trees = {s: levels([x[1] for x in sorted(g)]) for s, g in groups.items()}
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    top = levels([trees[s][-1][0] for s in names])
    for k, s in enumerate(names):
        for i, (doc, leaf, other) in enumerate(sorted(groups[s])):
            siblings, at = [], None
            for tree, at in ((trees[s], i), (top, k)):
                for level in tree[:-1]:
                    first = at // 3 * 3
                    run = level[first : first + 3]
                    siblings += run[: at - first] + run[at - first + 1 :]
                    other = digest(*run[: at - first], other, *run[at - first + 1 :])
                    at //= 3
            out.append((doc, leaf, trees[s][-1][0], top[-1][0], digest(*siblings), other))
    return sorted(out)


def found(rows):
    shown = merkle.leaf_digest(FIELDS, text=F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    m = merkle.manifest(rows, FIELDS, carry={"shown": shown})
    told = m.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("before"), F.col("after")), merkle.folded(F.col("shown"), F.col("before"), F.col("after")))
    return sorted(tuple(r) for r in told.collect())


def test_query_against_a_plain_tree(spark, folder, docs):
    got = op12_merkle_manifest(spark, folder).collect()
    want = plain(docs.collect())
    assert sorted((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got) == want
    assert all(r.verified == (r.folded_root == r.root) for r in got)
    changed = {r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (r["text"] or "")}
    assert changed and {r.doc_id for r in got if not r.verified} == changed


@pytest.mark.parametrize("size", [1, 2, 3, 4, 728, 729, 730, 2500])
def test_sizes_around_a_bundle(spark, size):
    """One source of ``size`` rows beside many of one row: every round of both trees."""
    rows = [(i, "hot", None, i, f"line {i}\n" * (i % 3)) for i in range(size)] + [(10_000 + i, f"s{i:04d}", "en", None, None) for i in range(min(size, 800))]
    rows += [(90_000, None, None, None, ""), (90_001, "", None, None, "x\n")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    assert found(df) == plain([r.asDict() for r in df.collect()])


def test_odd_rows(spark):
    rows = [(1, "a", "x", 1, "t\n"), (1, "a", "x", 1, "t\n"), (1, "a", "x", 1, "other"), (2, None, None, None, None), (3, "é", "x", 2, "ü" * 300_000)]
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    df = spark.createDataFrame([(*r, "k", 5, "p") for r in rows], schema + ", key string, place int, digest string")
    assert found(df) == plain([dict(zip(FIELDS, r)) for r in rows])
    nobody = spark.createDataFrame([(None, "a", None, None, None), (7, "a", None, None, "")], schema)
    told = merkle.manifest(nobody).collect()
    assert len({r.leaf for r in told}) == 2 and {r.doc_id for r in told} == {None, 7}
    none = merkle.manifest(spark.createDataFrame([], schema))
    assert none.columns == ["doc_id", "leaf", "subroot", "root", "before", "after"] and none.count() == 0


def test_queue_hands_over_in_label_order():
    nodes = merkle.rise([str(i) for i in range(10)], 3)
    assert [len(x) for x in nodes] == [10, 4, 2, 1] and nodes == levels([str(i) for i in range(10)])
    for place, proof in enumerate(merkle.fall(nodes, ("L", "R", ()))):
        own = nodes[0][place]
        while proof:
            before, after, proof = proof
            own = digest(before, own, after)
        assert own == digest("L", nodes[3][0], "R")
