"""The pipeline against a brute-force version of its stages."""

import duckdb
import numpy as np

import corpus_pipeline
from tests.llm.test_methods import brute_components, brute_fingerprint, check_shards
from trailframe.llm import decontaminate, mixing, quality

SF = "/root/testdata/sf0.001"


def holds(item, words):
    number = {}
    code = lambda ws: np.array([number.setdefault(w, len(number)) for w in ws])
    a, b = code(item), code(words)
    n = len(item)
    return any(decontaminate.lcs(a, b[k:k + 2 * n]) >= decontaminate.COPY * n for k in range(0, max(1, len(b) - n), max(1, n // 4)))


def test_run_equals_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality.ORACLE}) WHERE kept").fetchall()}
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    roots = brute_components({i: brute_fingerprint(texts[i]) for i in good})
    single = [i for i in good if roots[i] == i]
    items = [decontaminate.tokens(t) for (t,) in con.execute(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    clean = [i for i in single if not any(holds(t, decontaminate.tokens(texts[i])) for t in items)]
    assert len(clean) < len(single) < len(good) < len(texts)
    con.execute("CREATE TABLE kept AS SELECT * FROM documents WHERE doc_id IN (SELECT unnest(?))", [clean])
    sql = mixing.oracle(corpus_pipeline.MIX_FRACTION, 1).replace("FROM documents", "FROM kept")
    want = {r[0] for r in con.execute(f"SELECT doc_id FROM ({sql})").fetchall()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == want and len(got) == len(want) > 10
    check_shards(got, texts)


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "simhash near-dedup", "benchmark decontamination", "mixing", "sharding"]
