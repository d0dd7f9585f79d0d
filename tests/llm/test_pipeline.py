"""The stages against plain versions, and the registered queries against SQL."""

import math
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from farthing.llm import queries
from farthing.llm.common import stored

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def plain(rows, names):
    return sorted((tuple(None if isinstance(r[n], float) and math.isnan(r[n]) else r[n] for n in names) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    found = db.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    df = queries.QUERIES[name](spark, FOLDER)
    assert sorted(names) == sorted(df.columns)
    assert plain([r.asDict() for r in df.collect()], names) == sorted((tuple(r) for r in found.fetchall()), key=repr)


def test_registered():
    assert {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_chat_runs_no_python(spark):
    plan = queries.op4_chat_parts(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_ids"]
    held = docs
    wanted = {
        "toxicity": lambda d: [i for i, p in queries.op6_toxicity(spark, FOLDER).select("doc_id", "predicted").collect() if not p],
        "near_duplicates": lambda d: [r.doc_id for r in queries.minhash.near_duplicates(d).collect() if r.kept],
        "decontamination": lambda d: [
            r.doc_id for r in queries.contamination.contamination(d, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect() if not r.contaminated
        ],
        "mixing": lambda d: [r.doc_id for r in queries.mixing.takes(d).collect() for _ in range(r.taken // r.size if r.size else 0)],
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stored(stage(spark, held, FOLDER), "test")
        assert got.columns == docs.columns and got.schema == docs.schema
        assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(wanted[name](held))
        held = got
    last = corpus_pipeline.STAGES[-1][1](spark, held, FOLDER)
    assert last.count() == held.count()
    ends = sorted((r.start, r.n_tokens, r.doc_id) for r in last.collect())
    assert all(a[0] + a[1] == b[0] and a[2] <= b[2] for a, b in zip(ends, ends[1:]))
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, last.collect()))


def test_stages_of_nothing(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, FOLDER).count() == 0


def test_import_needs_no_session():
    assert "farthing.llm.queries" in sys.modules
