import re

import brute
import corpus_pipeline as C
import __spark_entry__ as entry
from churnkit.llm import langid
from churnkit.llm.queries import REGISTRY, tokenizer_path

STRIP = {i: None for i in (32, 9, 10, 11, 12, 13)}


def test_stages_against_brute_force(spark, small, tmp_path):
    """Each stage against its plain version on its own input, and run() against them all."""
    d = "/root/testdata/sf0.001"
    assert [k for k, _ in C.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontamination", "packing"]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, schema = docs.columns, docs.schema
    norm = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [norm(r["text"]) for r in small("benchmark")]
    for k, (name, stage) in enumerate(C.STAGES):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = stage(spark, docs, d)
        if name == "packing":
            pieces = out.collect()
            break
        assert out.columns == columns
        out.write.parquet(str(tmp_path / f"{k}"))
        docs = spark.read.parquet(str(tmp_path / f"{k}"))
        assert docs.schema == schema
        got = sorted(r["doc_id"] for r in docs.collect())
        if name == "language_id":
            share = {r["doc_id"]: r for r in langid.label_languages(spark, spark.read.parquet(f"{d}/documents.parquet")).collect()}
            want = [i for i, _ in rows if share[i]["lang_pred"] != "und" and share[i]["score"] >= 0.5]
            assert len(want) > 0.95 * len(rows)
        elif name == "exact_dedup":
            best = {}
            for i, t in rows:
                key = t.translate(STRIP)
                best[key] = min(best.get(key, (0, 0)), (-len(t), i))
            want = [i for _, i in best.values()]
        elif name == "jaccard_join":
            want = [i for i, (_, c) in brute.jaccard(rows, 5, 80).items() if i == c]
        else:
            want = [i for i, t in rows if not any(x in norm(t) for x in items)]
        assert got == sorted(want), name
    whole = C.run(spark, d).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, pieces))
    left = {r["doc_id"] for r in pieces}
    assert left == {i for i, _ in rows}


def test_registered_queries():
    q, o = entry.queries(), entry.oracle_sql()
    numbers = [int(m[1]) for k in q if (m := re.match(r"op(\d+)_", k))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in q
    assert set(REGISTRY) <= set(q) and "op5_tree_merge_dedup" in o
    assert tokenizer_path().endswith("word_bpe_49k.json")


def test_exact_dedup_matches_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.01/documents.parquet')")
    want = con.sql(entry.oracle_sql()["op5_tree_merge_dedup"]).df()
    got = entry.queries()["op5_tree_merge_dedup"](spark, "/root/testdata/sf0.01").toPandas()[want.columns.tolist()]
    key = lambda f: f.sort_values("doc_id").reset_index(drop=True).astype(str)
    assert key(got).equals(key(want))
