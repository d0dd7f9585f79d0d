"""Secrets in texts: certain forms, and weak parts that only count where their complements stand near.

``scan`` finds certain spans (an assigned password or token, an access id, a long hex number) and
candidates of three roles: identifiers (an account, a client id), secrets (a token of mixed letters and digits, a
short password) and endpoints (an address of a service). A weak candidate alone is noise. ``linked`` joins
the candidates with the scopes of their text (stretches between blank lines) as intervals: both are
dealt by bins of ``BIN`` code points, so that a scope meets only parts of its own bins. Inside a scope
one sweep over the starts finds, for each part, the nearest part of each role; ``REACH`` code points at most count as
together. Reported are a secret near an identifier or endpoint, an identifier near a secret, and an
endpoint near both. The certain spans play their role as well, and always stay.

No pairs of parts are made: a text of n parts takes n rows. A text without a secret, or with neither an
identifier nor an endpoint, has no candidates at all.

Defined results: a null or empty text has no spans; repeated rows are scanned each; other columns
are ignored, whatever their names; no rows give no rows. Places are code points, the end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farthing.llm.common import in_batches, pieces, stored

REACH = 512
BIN = 1024

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")
#: Weak forms. A token counts if it mixes letters and digits; the other forms have a name or a scheme.
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_SHORT = re.compile(r"""\b(pass(?:word|wd|phrase|code)?|pwd|auth|credential|(?:secret|private)_?(?:access_?)?key)["']?\x20*[:=]\x20*["']?([^\s"']{4,})""", re.I | re.A)
_NAMED = re.compile(r"""\b(user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?|tenant(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]{3,})""", re.I | re.A)
_ADDRESS = re.compile(
    r"""\b(?:(?:https?|ftps?|sftp|ssh|s3|redis|amqps?|mongodb|mysql|postgres(?:ql)?|jdbc:[a-z0-9]+)://[^\s"'<>]+"""
    r"""|(?:host(?:_?name)?|endpoint|server|base_?url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:_/-]{4,}"""
    r"""|[a-z0-9][a-z0-9-]*(?:\.[a-z0-9-]+)*\.amazonaws\.com)""", re.I | re.A,
)
_BLANK = re.compile(r"\n[\x20\t\r\x0b\x0c]*\n\s*")

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
_ROLE = {"assign": "secret", "access": "identifier", "hex": "secret"}

SPANS = "array<struct<kind: string, start: bigint, stop: bigint>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
_PART = pa.list_(pa.struct([("role", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("certain", pa.bool_())]))
_SCOPE = pa.list_(pa.struct([("scope", pa.int64()), ("scope_end", pa.int64())]))
_SCHEMA = "parts array<struct<role: string, start: bigint, stop: bigint, certain: boolean>>, scopes array<struct<scope: bigint, scope_end: bigint>>"


def certain_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) by start, then kind as listed in ``KINDS``."""
    found = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", *m.span()) for m in _LONG_HEX.finditer(text)]  # shorter ones fail, and a match ends where its letters do
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _mixes(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.isalpha() for c in token) and len(set(token)) >= 8


def parts_of(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, bool]]:
    """(role, start, stop, certain) of all parts by start; none unless there is a secret and a complement."""
    taken = [(a, b) for _, a, b in base]

    def free(a: int, b: int) -> bool:
        return all(b <= x or y <= a for x, y in taken)

    certain = [(_ROLE[k], a, b, True) for k, a, b in base]
    weak = [("secret", *m.span(), False) for m in _TOKEN.finditer(text) if _mixes(m[0])]
    weak += [("secret", *m.span(), False) for m in _SHORT.finditer(text)]
    if not weak and not any(p[0] == "secret" for p in certain):
        return []
    weak += [("identifier", *m.span(), False) for m in _NAMED.finditer(text)]
    weak += [("endpoint", *m.span(), False) for m in _ADDRESS.finditer(text)]
    if not any(p[0] != "secret" for p in certain + weak):
        return []
    kept = []
    for part in sorted({p for p in weak if free(p[1], p[2])}, key=lambda p: (p[1], -p[2], p[0])):
        if not kept or part[1] >= kept[-1][2]:  # the longest of those that overlap, from the left
            kept.append(part)
    return sorted(certain + kept, key=lambda p: (p[1], p[2], p[0]))


def scopes_of(text: str) -> list[tuple[int, int]]:
    """The stretches between blank lines."""
    cuts = [0, *(m.end() for m in _BLANK.finditer(text)), len(text)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def scan(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, parts, scopes) of every text; ``row`` numbers the rows, as ids may repeat."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b in pieces(batch, "text"):
                part = batch.slice(a, b - a)
                spans, found, scopes = [], [], []
                for text in part.column("text").to_pylist():
                    base = certain_spans(text) if text else []
                    own = parts_of(text, base) if text else []
                    spans.append([dict(zip(("kind", "start", "stop"), s)) for s in base])
                    found.append([dict(zip(("role", "start", "stop", "certain"), p)) for p in own])
                    scopes.append([{"scope": s, "scope_end": e} for s, e in scopes_of(text)] if own else [])
                numbers = pa.array(range(row, row + len(part)), pa.int64())
                row += len(part)
                columns = [numbers, part.column("doc_id"), pa.array(spans, _SPAN), pa.array(found, _PART), pa.array(scopes, _SCOPE)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "base", "parts", "scopes"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(docs.select("doc_id", "text"), work, f"row bigint, doc_id {kind}, base {SPANS}, {_SCHEMA}")


def in_scopes(parts: DataFrame, scopes: DataFrame) -> DataFrame:
    """Interval join: every part with the scope that it starts in, bin by bin."""
    last = F.greatest(F.col("scope"), F.col("scope_end") - 1)
    covered = scopes.withColumn("bin", F.explode(F.sequence(F.expr(f"scope div {BIN}"), (last / BIN).cast("bigint"))))
    placed = parts.withColumn("bin", F.expr(f"start div {BIN}"))
    return placed.join(covered, ["row", "bin"]).where("scope <= start and start < scope_end").drop("bin", "scope_end")


def complemented(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The parts with, for each role, whether one of its parts is within ``reach`` in the same scope."""
    at = Window.partitionBy("row", "scope").orderBy("start", "stop", "role")
    before, after = at.rowsBetween(Window.unboundedPreceding, Window.currentRow), at.rowsBetween(Window.currentRow, Window.unboundedFollowing)

    def near(role: str) -> Column:
        own = F.col("role") == role
        ends, starts = F.max(F.when(own, F.col("stop"))).over(before), F.min(F.when(own, F.col("start"))).over(after)
        return F.coalesce(ends >= F.col("start") - reach, F.lit(False)) | F.coalesce(starts <= F.col("stop") + reach, F.lit(False))

    return parts.select("*", *(near(r).alias(f"near_{r}") for r in ("identifier", "secret", "endpoint")))


def linked(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, base, linked) of every text: its certain spans, and the weak ones that their complements confirm."""
    seen = stored(scan(docs), "parts")
    parts = seen.select("row", F.inline("parts"))
    found = complemented(in_scopes(parts, seen.select("row", F.inline("scopes"))), reach)
    counts = (
        F.when(F.col("role") == "secret", F.col("near_identifier") | F.col("near_endpoint"))
        .when(F.col("role") == "identifier", F.col("near_secret"))
        .otherwise(F.col("near_secret") & F.col("near_identifier"))
    )
    span = F.struct(F.col("role").alias("kind"), "start", "stop")
    confirmed = found.where(~F.col("certain") & counts).groupBy("row").agg(F.collect_list(span).alias("linked"))
    return seen.join(confirmed, "row", "left").select("doc_id", "base", F.coalesce("linked", F.array().cast(SPANS)).alias("linked"))


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def in_order(spans: Column) -> Column:
    """Spans by start, then by kind as listed in ``KINDS``."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("at"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, in order, comma-joined."""
    told = F.transform(in_order(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(told, ",")
