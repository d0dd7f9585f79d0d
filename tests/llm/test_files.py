"""WARC, token files, sharding, mixing and chat: round trips and laws."""

import base64
import gzip
import hashlib
import unicodedata
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farthing.llm import chat, cuts, huffman, mixing, resharding, token_files, warc
from farthing.llm.common import shared_folder, stored
from farthing.llm.queries import tokenizer

# --- WARC ---------------------------------------------------------------------


def archive(n=6, zipped=True):
    parts = []
    for i in range(n):
        body = f"<html>{i}{'x' * 300 * i}WARC/1.1\r\n</html>".encode()
        data = warc.record_bytes(i, f"http://a/{i}", body, hashlib.sha256(body).hexdigest(), None, False)
        parts.append(gzip.compress(data) if zipped else data)
    return parts


def salvaged(data, step=97):
    found = list(warc.salvage(data[i : i + step] for i in range(0, len(data), step)))
    return [f["page_id"] for k, f in found if k == "record"], [(f["gap_start"], f["gap_stop"]) for k, f in found if k == "gap"]


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage(zipped):
    parts = archive(zipped=zipped)
    at = np.cumsum([0, *map(len, parts)])
    whole = b"".join(parts)
    assert salvaged(whole) == ([0, 1, 2, 3, 4, 5], [])
    broken = bytearray(whole)
    broken[at[2] + len(parts[2]) // 2] ^= 0x5A
    assert salvaged(bytes(broken)) == ([0, 1, 3, 4, 5], [(at[2], at[3])])
    cut = whole[: at[3] + 40] + whole[at[4] :]
    assert salvaged(cut) == ([0, 1, 2, 4, 5], [(at[3], at[3] + 40)])
    assert salvaged(b"junk" + whole) == ([0, 1, 2, 3, 4, 5], [(0, 4)])
    assert salvaged(whole[:-5]) == ([0, 1, 2, 3, 4], [(at[5], len(whole) - 5)])
    assert salvaged(b"") == ([], []) and salvaged(b"nothing here") == ([], [(0, 12)])


def foreign(page, digest, block, kind="application/http; msgtype=response"):
    heads = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\nContent-Type: {kind}\r\nWARC-Payload-Digest: {digest}\r\nContent-Length: {len(block)}\r\n\r\n"
    return heads.encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage_of_other_writers(zipped):
    """Digests of HTTP bodies in base32 and hex are checked, others passed on; members hold several records."""
    head, body = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n", b"3\r\nabc\r\n2\r\nde\r\n0\r\n\r\n"
    sha1 = "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    parts = [
        foreign(0, sha1, head + body), foreign(1, "sha-1:" + hashlib.sha1(b"abcde").hexdigest(), head + body),
        foreign(2, "blake3:abc", head + body), foreign(3, "sha1:" + hashlib.sha1(b"x").hexdigest(), b"x", "text/plain"),
        foreign(4, "sha256:" + base64.b32encode(hashlib.sha256(body).digest()).decode(), head + body),
    ]
    bad = foreign(9, sha1, head + body.replace(b"abc", b"abX"))
    pack = gzip.compress if zipped else bytes
    assert salvaged(b"".join(map(pack, parts))) == ([0, 1, 2, 3, 4], [])
    assert salvaged(pack(bad) + pack(parts[0])) == ([0], [(0, len(pack(bad)))])
    if zipped:
        member = gzip.compress(b"".join(parts))
        assert salvaged(member + gzip.compress(parts[0])) == ([0, 1, 2, 3, 4, 0], [])
        member = gzip.compress(parts[0] + bad + parts[1])
        assert salvaged(member) == ([0, 1], [(0, len(member))])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3000), st.integers(0, 255)), max_size=4), st.booleans())
def test_every_byte_is_a_record_or_a_gap(damage, zipped):
    data = bytearray(b"".join(archive(5, zipped)))
    for at, value in damage:
        data[at % len(data)] = value
    spans = [(f.get("start", f.get("gap_start")), f.get("stop", f.get("gap_stop"))) for _, f in warc.salvage(iter([bytes(data)]))]
    assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == len(data)


def test_false_lengths_cost_nothing():
    """Damaged lengths, inside the file and beyond it: what is read grows with the file, what is held does not."""
    body = b"x" * 200_000
    parts = [warc.record_bytes(i, "u", body, hashlib.sha256(body).hexdigest(), None, False) for i in range(60)]
    for told in (b"Content-Length: 900000000", b"Content-Length: 000600000"):
        data = parts[0].replace(b"Content-Length: 200000", told, 1) + b"".join(parts[1:])
        asked = []

        def read(at, n, data=data, asked=asked):
            asked.append(n)
            return data[at : at + n]

        found = list(warc.salvage(warc.Source(read, len(data))))
        first = len(data) - sum(map(len, parts[1:]))
        assert [(f["gap_start"], f["gap_stop"]) for k, f in found if k == "gap"] == [(0, first)]
        assert [f["page_id"] for k, f in found if k == "record"] == list(range(1, 60))
        assert sum(asked) < 2 * len(data) and max(asked) <= warc.READ_STEP


def test_damaged_archives_of_the_query(spark, folder):
    """The query's archives with bytes flipped and cut out: whole records come back, all others lie in gaps."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    archives = warc.write(pages)
    whole = warc.read_records(archives, payload=False).collect()
    by_file = {}
    for r in whole:
        by_file.setdefault(r.file, []).append(r)
    names, lost = [], set()
    for k, (name, rows) in enumerate(sorted(by_file.items())):
        path = name.removeprefix("file://").removeprefix("file:")
        with open(path, "rb") as source:
            data = bytearray(source.read())
        rows.sort(key=lambda r: r.start)
        for r in rows[1::7]:
            data[(r.start + r.stop) // 2] ^= 0x55
            lost.add((r.page_id, r.record_type))
        last = rows[-1]
        lost.add((last.page_id, last.record_type))
        with open(f"{path}-damaged", "wb") as out:
            out.write(data[: last.stop - 3])
        names.append((f"{name}-damaged", k))
    damaged = spark.createDataFrame(names, "name string, k int")
    got = warc.read_records(damaged, payload=False).collect()
    assert {(r.page_id, r.record_type, r.payload_digest) for r in got} == {(r.page_id, r.record_type, r.payload_digest) for r in whole if (r.page_id, r.record_type) not in lost}
    gaps = warc.read_gaps(damaged).collect()
    assert len(lost) > 5 and all(g.gap_stop > g.gap_start for g in gaps) and len(gaps) >= len(names)


def test_archives(spark):
    long, longer = "a" * 200, "é" * 90
    pages = [(3, "u", long), (1, "u", long), (2, None, "short"), (9, "v\r\nX: y", "short"), (4, "u", None), (5, "u", ""), (None, "u", long),
             (6, "w", longer), (7, "w", longer), (7, "w", longer), (None, "n", "z" * 150), (None, "n", "z" * 150)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, html string, digest string")
    files = warc.write(df)
    rows = warc.read_records(files).collect()
    got = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in rows)

    def row(page, html, refers):
        raw = (html or "").encode()
        return page, "response" if refers is None else "revisit", refers, len(raw), hashlib.sha256(raw).hexdigest()

    first = {long: 1, longer: 6}
    assert got == Counter(row(p, h, first[h] if h in first and p != first[h] else None) for p, _, h in pages)
    assert warc.read_gaps(files).count() == 0
    assert warc.read_records(warc.write(df.limit(0))).count() == 0


# --- Huffman and token files ----------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=60), st.integers(6, 12))
def test_code_lengths(counts, limit):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, limit).astype(int)
    used = lengths[counts > 0]
    assert (lengths[counts == 0] == 0).all() and lengths.max() <= limit
    assert sum(Fraction(1, 2**int(n)) for n in used) <= 1
    # Optimal where the limit does not bind: the plain Huffman cost.
    import heapq

    heap, cost = sorted(int(c) for c in counts if c), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    mine = int((counts * lengths).sum())
    assert mine >= cost
    if limit == 12 and len(used) > 1 and used.max() < limit:
        assert mine == cost


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
def test_stream(n):
    rng = np.random.default_rng(n)
    counts = (1e5 / np.arange(1, 3000) ** 1.4).astype(int) + 1
    lengths = huffman.code_lengths(counts)
    ids = rng.choice(len(counts), n, p=counts / counts.sum())
    data, marks = huffman.encode(ids, huffman.canonical(lengths), lengths)
    if n:
        assert (huffman.decode(data, marks, n, huffman.decoding_table(lengths)) == ids).all()


def test_too_few_bits():
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, int), 3)


@settings(max_examples=120, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(" \n'.,sJ̌é<|>"), max_size=40))
def test_words_encode_like_whole_texts(text):
    encoder = token_files._encoder(tokenizer())
    got = np.frombuffer(encoder.encode([text.encode()])[0], encoder.kind).tolist()
    assert got == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_letters_before_stops_encode_like_whole_texts():
    """Every letter and mark before a comma and a full stop: some letters end in a mark once they are normalised."""
    encoder = token_files._encoder(tokenizer())
    letters = [c for c in map(chr, range(0x21, 0x30000)) if unicodedata.category(c)[0] in "LM"]
    for end in ",.":
        words = [c + end for c in letters] + [f"belediyes{c}{end}" for c in "İıẞ\u0958\u09dcé"]
        whole = encoder.tokenizer.encode_batch(words, add_special_tokens=False)
        wrong = [w for w, e in zip(words, whole) if np.frombuffer(encoder._encode(w.encode()), encoder.kind).tolist() != e.ids]
        assert wrong == []


def test_token_files(spark, docs, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 60_000)
    whole = token_files._encoder(tokenizer()).tokenizer
    for table in (docs, odd_docs):
        files, book = token_files.write(table, tokenizer())
        got = sorted(token_files.read(files, book).collect(), key=lambda r: r.start)
        rows = table.select("doc_id", "text").collect()
        ids = {i: whole.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
        assert [r.doc_id for r in got] == sorted(r.doc_id for r in rows)
        start = 0
        for r in got:
            raw = np.array(ids[r.doc_id], "<u4").tobytes()
            assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (start, len(ids[r.doc_id]), zlib.crc32(raw), raw)
            start += r.n_tokens
    files, book = token_files.write(no_docs, tokenizer())
    assert token_files.read(files, book).count() == 0


# --- Cuts, mixing, resharding -----------------------------------------------------


def test_cuts(spark):
    rng = np.random.default_rng(2)
    rows = [(int(g), int(rng.integers(1 << cuts.KEY_BITS)), int(w)) for g, w in zip(rng.integers(0, 3, 5000), rng.integers(0, 90, 5000))] + [(1, 77, 5)] * 900
    table = stored(spark.createDataFrame(rows, "grp int, key bigint, weight bigint"), "test")
    wanted = [(g, s) for g in range(3) for s in (0, 1, 5000, 40000, 10**9)]
    for (g, s), (cut, _) in zip(wanted, cuts.cuts(table, wanted)):
        own = sorted((k, w) for i, k, w in rows if i == g)
        under = sum(w for k, w in own if k < cut)
        rest = [k for k, _ in own if k >= cut]
        assert under <= s and (not rest or under + sum(w for k, w in own if k == rest[0]) > s)


def test_targets():
    weights = [5, 2, 1] * 4
    for sizes in ([10, 1000, 1000], [0, 5, 7, 9], [100] * 12, [1, 1, 1, 500], [3]):
        got = mixing.targets(sizes, weights[: len(sizes)])
        assert sum(got) == sum(sizes) and all(t <= 3 * s for t, s in zip(got, sizes))
        free = {t / w for t, s, w in zip(got, sizes, weights) if t < 3 * s}
        assert len(free) <= 1


def test_quotas():
    blocks = np.array([1000, 3, 0, 47])
    got = mixing.quotas(blocks, 7, seed=1)
    assert (got.sum(0) == blocks).all() and got.sum(1).max() - got.sum(1).min() <= 1 and (got >= 0).all()
    assert (got == mixing.quotas(blocks, 7, seed=1)).all()


def test_mix(spark, docs, odd_docs, no_docs):
    for table in (docs, odd_docs):
        taken = mixing.takes(table).collect()
        sizes = {r.doc_id: len((r.text or "").encode().split()) for r in table.collect()}
        source = {r.doc_id: r.source for r in table.collect()}
        by = Counter()
        for r in taken:
            assert r.size == sizes[r.doc_id] and r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
            by[source[r.doc_id]] += r.taken
        for r in taken:
            assert abs(by[source[r.doc_id]] - r.target) <= max(s for i, s in sizes.items() if source[i] == source[r.doc_id])
        assert sorted(map(tuple, taken)) == sorted(map(tuple, mixing.takes(table).collect()))
        drawn = mixing.mixed(table, shards=3)
        assert drawn.columns == [*table.columns, "mix_shard"]
        words = Counter()
        for r in drawn.collect():
            words[r.doc_id] += sizes[r.doc_id]
        want = Counter()
        for r in taken:
            want[r.doc_id] += r.taken
        assert +words == +want
    assert mixing.takes(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0
    blank = odd_docs.where("doc_id in (1, 2, 3)")
    assert {r.taken for r in mixing.takes(blank).collect()} == {0} and mixing.mixed(blank).count() == 0


def test_takes_are_the_rows_that_the_tree_deals(spark, docs, odd_docs):
    for table in (docs, odd_docs):
        taken = mixing.takes(table, shards=3).collect()
        dealt = Counter((r.doc_id, r.mix_shard) for r in mixing.mixed(table, shards=3).collect())
        assert dealt == Counter((r.doc_id, s) for r in taken for s in r.shards)
        assert all(len(r.shards) == len(r.places) and r.taken == r.size * len(r.shards) for r in taken)
        for shard in range(3):
            places = sorted(p for r in taken for s, p in zip(r.shards, r.places) if s == shard)
            assert places == list(range(len(places)))
    # Both sources are drawn once: 12 and 4 blocks hold rows, one for each of the first 16 shards.
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, "a").otherwise("b").alias("source"), F.lit("two words").alias("text"))
    assert {r.mix_shard for r in mixing.mixed(rows, shards=24, weights=(3, 1)).collect()} == set(range(16))


def least_cost_by_force(supply, room, price):
    from functools import lru_cache

    @lru_cache(None)
    def best(i, free):
        if i == len(supply):
            return 0
        return min(
            (sum(n * price(i, j) for j, n in enumerate(split)) + best(i + 1, tuple(f - n for f, n in zip(free, split))))
            for split in splits(supply[i], free)
        )

    def splits(n, free):
        if len(free) == 1:
            return [(n,)] if n <= free[0] else []
        return [(k, *rest) for k in range(min(n, free[0]) + 1) for rest in splits(n - k, free[1:])]

    return best(0, tuple(room))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=3), st.lists(st.integers(0, 4), min_size=1, max_size=3), st.lists(st.integers(0, 5), min_size=9, max_size=9))
def test_flow(supply, room, prices):
    room = [*room, max(0, sum(supply) - sum(room))]
    prices = [*prices, 4, 1, 3]

    def price(i, j):
        return prices[i * 4 + j]

    flow = resharding.least_cost_flow(supply, room, price)
    assert [sum(n for (i, _), n in flow.items() if i == k) for k in range(len(supply))] == supply
    assert all(sum(n for (_, j), n in flow.items() if j == k) <= room[k] for k in range(len(room)))
    assert sum(n * price(i, j) for (i, j), n in flow.items()) == least_cost_by_force(supply, room, price)


def test_reshard(spark, docs, odd_docs, no_docs):
    for table, shards in ((docs, 16), (odd_docs, 3)):
        rows, plan = resharding.reshard(table, resharding.old_layout(4), shards)
        got = resharding.slots(rows.withColumn("size", F.octet_length(F.coalesce("text", F.lit(""))) + 1)).collect()
        assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in table.collect())
        largest = max(r.size for r in got)
        by, slots = Counter(), {}
        for r in got:
            by[r.shard] += r.size
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        if table is docs:
            mean = sum(by.values()) / shards
            assert all(abs(by[k] - mean) <= 2 * largest for k in range(shards))
        assert sum(plan["flow"].values()) == plan["total_bytes"] >= plan["moved_bytes"]
    assert resharding.slots(resharding.reshard(no_docs, resharding.old_layout())[0]).count() == 0


def test_shard_that_nothing_enters_or_leaves_keeps_its_files(spark):
    table = spark.createDataFrame([(i, "x" * 9, i % 2) for i in range(20)] + [(99, "y" * 19, 0)], "doc_id bigint, text string, s int")
    rows, plan = resharding.reshard(table.where("doc_id < 20"), F.col("s"), 2)
    assert plan["moved_bytes"] == 0 and {(r.old_shard, r.shard) for r in rows.collect()} == {(0, 0), (1, 1)}


# --- Chat -----------------------------------------------------------------------

TRICKY = ["", "plain", "<|turn|>user\n", "<|end|>\n", "</s>[INST] ok [/INST]", "<\\|end|>", "<\\\\|x", "[\\INST]", "<<SYS>>a<</SYS>>", "<<|", "\n\n", "é[INST]]\\", "<|image:1|>"]


def test_chat(spark):
    turns = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(TRICKY)]
    turns += [(2, 0, None, None), (2, None, "a\nb\\n<|end|>\n", "x"), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (None, 5, "assistant", None)]
    df = spark.createDataFrame([(*t, "z") for t in turns], "conv_id bigint, turn bigint, role string, text string, piece string")
    out = chat.parsed(chat.formatted(df.select("*", chat.text_parts(F.col("text")).alias("parts")))).collect()
    got = {r.conv_id: ([tuple(t) for t in r.turns], list(r.loss_texts), r.formatted) for r in out}
    assert got[1][0] == [(r, t) for _, _, r, t in turns[: len(TRICKY)]]
    assert got[1][1] == [t for k, t in enumerate(TRICKY) if k % 2]
    assert got[1][2].count("<|turn|>") == len(TRICKY) and "[INST]" not in got[1][2] and "</s>" not in got[1][2]
    assert got[2][0] == [("a\nb\\n<|end|>\n", "x"), ("", "")] and got[3][1] == ["a", "a"] and got[None][1] == [""]
    assert chat.formatted(df.limit(0).select("*", chat.text_parts(F.col("text")).alias("parts"))).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(st.sampled_from("<[\\|/sINTSY>]a"), max_size=14), min_size=1, max_size=40))
def test_escapes(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e")).withColumn("u", chat.unescaped(F.col("e")))
    for r in df.collect():
        assert r.u == r.t and not any(c in r.e for c in ("<|", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>"))


def test_parts(spark):
    kind = f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}"

    def part(type=None, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
        return type, text, ref, width, height, seconds, pages

    rows = [
        (1, 0, "user", [part("text", "see <|"), part("image", None, "a.png", 57, 28), part(None, "and"), part("audio", None, "b.wav", seconds=2.0)]),
        (1, 1, "assistant", [part("text", "ok")]),
        (1, 2, "user", [part("document", None, "c.pdf", pages=3), part("video", None, None), part("image", None, "d.png")]),
        (2, 0, "assistant", None),
    ]
    out = {r.conv_id: r for r in chat.formatted(spark.createDataFrame(rows, kind)).collect()}
    text = out[1].formatted
    assert text == "<|turn|>user\nsee <\\|<|image:1|>and<|audio:2|><|end|>\n<|turn|>assistant\nok<|end|>\n<|turn|>user\n<|document:3|><|document:4|><|image:5|><|end|>\n"
    assert [tuple(a) for a in out[1].attachments] == [(1, "image", "a.png", 3), (2, "audio", "b.wav", 50), (3, "document", "c.pdf", 1536), (4, "document", "", 1), (5, "image", "d.png", 1)]
    assert out[1].media_tokens == 3 + 50 + 1536 + 2 and [text[s.start : s.start + s.length] for s in out[1].loss_spans] == ["ok"]
    assert out[2].formatted == "<|turn|>assistant\n<|end|>\n" and out[2].media_tokens == 0


def test_mixing_takes_any_column_names(spark, odd_docs):
    """Every name that mixing uses within, as a column of the caller's."""
    own = ["_key", "_size", "_shard", "_extras", "_copy", "_cell", "_slice", "_order", "_grp", "_whole", "_number", "_times", "_row", "a b.c"]
    named = odd_docs.select("*", *(F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in own), F.lit(9).alias("mix_shard"))
    got = mixing.mixed(named)
    assert got.columns == named.columns
    rows = got.collect()
    assert rows and all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in own)
    plain = mixing.mixed(odd_docs)
    assert Counter((r.doc_id, r.mix_shard) for r in rows) == Counter((r.doc_id, r.mix_shard) for r in plain.collect())
    assert mixing.mixed(named.where("false")).columns == named.columns


@pytest.mark.parametrize("master", ["spark://elsewhere:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    class Context:
        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = {}, Context()

    Context.master = master
    with pytest.raises(ValueError, match="share"):
        shared_folder(Session())
