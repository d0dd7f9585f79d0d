"""Secret spans against a plain scan; weak parts with and without their complements."""

import hashlib
import re

import pytest

from farthing.llm import secrets
from farthing.llm.queries import op11_secret_links

ORDER = ("assign", "access", "hex")


def plain(text):
    found = []
    names = "|".join("".join(f"[{c}{c.upper()}]" for c in n) for n in ("password", "passwd", "secret", "token"))
    api = "[aA][pP][iI]_?[kK][eE][yY]"
    for m in re.finditer(rf"""({names}|{api})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            found.append(("assign", *m.span()))
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[1], ORDER.index(s[0])))


CASES = [
    "",
    "token=abcdefghijkl",
    "token=abcdefghijk",
    "TOKEN : 'abcdefghijkl' Api_Key=\"a.b/c+d_e=f-g\" passwd=x",
    "secret: token: abcdefghijklmnop",
    "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop",
    "é password='0123456789abcdef0123' AKIAABCDEFGHIJKLMN AKIAABCDEFGHIJKLM XAKIAABCDEFGHIJ0123",
    "0123456789abcdeF 0123456789abcdef0",
]


@pytest.mark.parametrize("text", CASES)
def test_certain_spans(text):
    assert secrets.certain_spans(text) == plain(text)


def spans_of(spark, *texts):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id bigint, text string, row int, start int")
    out = {}
    for r in secrets.linked(df).collect():
        out[r.doc_id] = sorted((s.kind, texts[r.doc_id][s.start : s.stop]) for s in r.linked)
    return [out[i] for i in range(len(texts))]


def test_weak_parts_need_their_complements(spark):
    weak, name, host = "Zx8kQ2mP9vT4bN7s", "client_id=acme-77", "https://vault.example.org/x"
    got = spans_of(
        spark,
        f"a note {weak} here",  # alone
        f"{name} and {host}",  # no secret
        f"{name} then {weak}",
        f"{host} then {weak}",
        f"{name} {host} {weak}",
        f"{name}\n\n{weak}",  # other scopes
        f"{name}{' word' * 120} {weak}",  # out of reach
        "AKIAABCDEFGHIJKLMN with " + weak,  # a certain part as the complement
        f"user: bob token='abcdefghijklmnop' {host}",
        f"\n \n{'p ' * 2000}{name} {weak}\n\t\n{weak}",  # scopes over many bins
    )
    assert got[0] == got[1] == got[5] == got[6] == []
    assert got[2] == got[9] == [("identifier", name), ("secret", weak)]
    assert got[3] == [("secret", weak)]
    assert got[4] == [("endpoint", host), ("identifier", name), ("secret", weak)]
    assert got[7] == [("secret", weak)]
    assert got[8] == [("endpoint", host), ("identifier", "user: bob")]


def test_sweep_against_all_pairs(spark):
    """Dense text: what the sweep says about nearness, against comparing all parts of a scope."""
    import random

    rnd = random.Random(3)
    words = ["Zx8kQ2mP9vT4bN7s", "login=abc", "https://a.b/c", "AKIAABCDEFGHIJKLMN", "token=abcdefghijklm", "word " * 60, "word " * 105, "\n\n"]
    text = " ".join(rnd.choice(words) for _ in range(400))
    got = secrets.linked(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    want = set()
    parts = secrets.parts_of(text, secrets.certain_spans(text))
    for a, b in secrets.scopes_of(text):
        own = [p for p in parts if a <= p[1] < b]
        for p in own:
            near = {o[0] for o in own if o[1] <= p[2] + secrets.REACH and o[2] >= p[1] - secrets.REACH}
            good = {"secret": bool(near & {"identifier", "endpoint"}), "identifier": "secret" in near, "endpoint": {"secret", "identifier"} <= near}
            if not p[3] and good[p[0]]:
                want.add(p[:3])
    assert {(s.kind, s.start, s.stop) for s in got.linked} == want and len(want) > 50


def test_odd_tables(spark, odd_docs, no_docs):
    got = secrets.linked(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r.base == [] and r.linked == [] for r in got)
    assert secrets.linked(no_docs).count() == 0
    twice = spark.createDataFrame([(1, "token=abcdefghijkl")] * 2 + [(None, "user=bob Zx8kQ2mP9vT4bN7s")], "doc_id bigint, text string")
    assert sorted((len(r.base), len(r.linked)) for r in secrets.linked(twice).collect()) == [(0, 2), (1, 0), (1, 0)]


def test_query(spark, folder, docs):
    got = {r.doc_id: r for r in op11_secret_links(spark, folder).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        base = plain(r.text or "")
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        own = got[r.doc_id]
        assert (own.n_assign, own.n_access, own.n_hex) == tuple(sum(k == o for k, _, _ in base) for o in ORDER)
        assert own.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert set(filter(None, told.split(","))) <= set(own.spans.split(","))
        starts = [int(s.split(":")[1]) for s in own.spans.split(",") if s]
        assert starts == sorted(starts)
