"""The pipeline against a plain version, and the queries' registration."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from dfinsight.llm import blob_ledger, lang_id, ngram_join, queries, source_mix

from .test_lang_id import plain_model, plain_predict
from .test_operators import encoding, plain_targets

SF = "/root/testdata/sf0.001"


def plain_run(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    votes = plain_model([(r[1], r[2]) for r in rows if r[2] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2])
    kept = [r for r in rows if (p := plain_predict(votes, r[1]))[0] != "und" and p[1] >= lang_id.MIN_SCORE]
    groups = ngram_join.brute_force([(r[0], r[1]) for r in kept])
    kept = [r for i, r in enumerate(kept) if groups[i][0] == 0 or groups[i][1] == r[0]]
    kept = [(i, blob_ledger.redact(t, [{"kind": k, "start": s, "end": e} for k, s, e in blob_ledger.find_secrets(t)]), lang, src) for i, t, lang, src in kept]
    size = {r[0]: len(r[1].encode().split()) for r in kept}
    total: dict = {}
    for i, _, _, s in kept:
        total[s] = total.get(s, 0) + size[i]
    target, before, out, enc = plain_targets(total), {}, [], encoding()
    for i, t, lang, s in sorted(kept, key=lambda r: hashlib.md5(f"{source_mix.SEED}:{r[0]}:{hashlib.md5(r[1].encode()).hexdigest()}".encode()).hexdigest()):
        at, n, b = before.get(s, 0), size[i], round(target[s])
        before[s] = at + n
        taken = sum(max(0, min(n, b - e * total[s] - at)) for e in range(2))
        ids = enc.encode_ordinary(t)
        row = (i, s, lang, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        out += [row] * ((2 * taken + n) // (2 * n) if n else 0)
    return sorted(out)


def test_pipeline_against_a_plain_version(spark):
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "source", "lang", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == plain_run(spark) and got


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes, name


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[name](spark, SF)
    order = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(order)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.select(order).collect())) == sorted(want)
