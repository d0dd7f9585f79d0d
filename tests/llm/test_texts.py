"""Contamination, compression and toxicity against plain versions."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard

from farthing.llm import compression, contamination, toxicity
from farthing.llm.queries import held_out

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(texts, items):
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(len(w) - 12) if len(w) >= 13 else ([0] if w else []):
            windows[tuple(w[k : k + 13])].add(i)
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (q := tuple(w[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= {i for i in windows[q] if i is not None}
        out.append((len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def check_contamination(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = contamination.contamination(docs, bench).collect()
    rows = docs.select("doc_id", "text").collect()
    want = sorted(zip([r.doc_id for r in rows], plain_hits([r.text for r in rows], items)), key=repr)
    assert sorted(((r.doc_id, (r.n_words, r.n_hit, list(r.item_ids), r.contaminated)) for r in got), key=repr) == want
    for r in got:
        w = words(next(x.text for x in rows if x.doc_id == r.doc_id))
        by = dict(items)
        for m in r.matches:
            item = words(by[m.item_id])
            assert w[m.start : m.start + m.length] == item[m.item_start : m.item_start + m.length]
    kept = contamination.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not r.contaminated for r in got)


def test_contamination_of_the_tables(spark, docs, folder):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    check_contamination(spark, docs, items)


def test_contamination_special_cases(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 40)  # many test files
    items = [(1, "the quick brown fox jumps over the lazy dog and runs far away"), (2, "One  TWO"), (3, None), (4, ""), (5, "..."), (None, "école d'été"),
             (1, "adipiscing elit lorem ipsum dolor sit amet consectetur adipiscing elit lorem ipsum dolor sit"), (7, "two"), (8, "never seen words " * 9)]
    check_contamination(spark, odd_docs, [i for i in items if i[0] != 1] + [items[0]])
    check_contamination(spark, odd_docs, [])
    assert contamination.contamination(no_docs, spark.createDataFrame(items, "item_id bigint, text string")).count() == 0


@pytest.mark.parametrize("size,kinds", [(1, 1), (50, 1), (300, 2), (2000, 7)])
def test_suffix_array(size, kinds):
    tokens = np.random.default_rng(size).integers(0, kinds, size)
    for depth in (1, 5, 13, 64):
        got = contamination.suffix_array(tokens, depth)
        heads = [tuple(tokens[i : i + depth]) for i in got]
        assert heads == sorted(heads) and sorted(got) == list(range(size))


def plain_rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    three = Counter(zip(w, w[1:], w[2:]))
    hit = {k + d for k in range(len(w) - 2) if three[tuple(w[k : k + 3])] > 1 for d in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(hit), failed


def plain_bands(text):
    raw = text.encode()
    press = zstandard.ZstdCompressor(level=compression.LEVEL, write_content_size=False)

    def inside(part):
        low, high = compression.band(len(part))
        return low <= len(part) / len(press.compress(part)) <= high

    chunks = [raw[a : a + compression.CHUNK_BYTES] for a in range(0, len(raw), compression.CHUNK_BYTES)]
    return inside(raw) and 2 * sum(len(c) for c in chunks if inside(c)) >= len(raw)


def test_compression(spark, docs, odd_docs, no_docs):
    rng = np.random.default_rng(0)
    noise = "".join(chr(c) for c in rng.integers(0x4E00, 0x9FFF, 6000))
    spaced = " ".join(noise[i : i + 5] for i in range(0, 6000, 5))
    lines = "\n".join(f"{i} same words again" for i in range(3)) + "\nsame\nsame\n \n \n" + spaced
    more = spark.createDataFrame([(900, lines), (901, "ab " * 4000)], "doc_id bigint, text string")
    for table in (docs.select("doc_id", "text"), odd_docs, more):
        texts = {r.doc_id: r.text for r in table.select("doc_id", "text").collect()}
        for r in compression.compression_bands(table).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_rules(texts[r.doc_id])
            assert r.kept == (not r.base_failed and plain_bands(texts[r.doc_id]))
    assert not any(r.kept for r in compression.compression_bands(more).collect())
    assert compression.compression_bands(no_docs).count() == 0


def test_toxicity_on_held_out_labels(spark):
    """Accuracy on labels that the models never saw, at the size where they have some hundred toxic texts."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, ~held_out())
    got = toxicity.score(docs, model).join(labels, "doc_id").where(held_out()).select("score", "toxic").toPandas()
    toxic, flagged = got["toxic"] == 1, got["score"] >= 0.3
    assert (flagged & toxic).sum() / toxic.sum() > 0.7
    assert (flagged & ~toxic).sum() / (~toxic).sum() < 0.02


def test_toxicity_special_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 0), (5, 0), (7, 1), (7, None), (None, 1), (4, 1), (6, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit(odd_docs, labels)
    got = toxicity.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.without_toxic(odd_docs, model, 2.0).columns == odd_docs.columns
    one_class = toxicity.fit(odd_docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(odd_docs, one_class).collect()} == {0.0}
    assert {r.score for r in toxicity.score(odd_docs, toxicity.fit(odd_docs, labels.where("false"))).collect()} == {0.0}


def test_models_are_distributions():
    """Without trust and with it, each class model sums to one over the symbols."""
    rng = np.random.default_rng(1)
    cells = np.unique(rng.integers(0, 32**5, 500))
    toxic, ordinary = rng.integers(0, 4, len(cells)).astype(float), rng.integers(1, 9, len(cells)).astype(float)
    for trust in (0.0, 20.0):
        r = toxicity.ratios(cells, toxic, ordinary, trust)
        assert np.isfinite(r.values).all() and np.isfinite(r.others).all()
        same = toxicity.ratios(cells, ordinary, ordinary, trust)
        assert np.abs(same.values).max() < 1e-6 and np.abs(same.others).max() < 1e-6


def test_shards_stay_small(tmp_path):
    """A task never sorts many more words than a shard has, so that two workers fit an executor."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from farthing.llm import contamination

    pq.write_table(pa.table({"item_id": pa.array([1], pa.int64()), "text": pa.array([b"w1 w2 w3"])}), tmp_path / "a.parquet")
    words = " ".join(f"w{i % 900}" for i in range(2000)).encode()
    batch = pa.RecordBatch.from_arrays([pa.array([words] * 600)], ["text"])
    shards = [shard for _, shard in contamination._shards(iter([batch]), str(tmp_path))]
    assert sum(int(s.sizes.sum()) for s in shards) == 1_200_000 and max(len(s.tokens) for s in shards) < 1 << 20
