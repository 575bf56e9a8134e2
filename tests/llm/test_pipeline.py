import corpus_pipeline as C
from civicspark.session import materialize

from .conftest import documents
from .test_line_dedup import brute as lines_kept
from .test_minhash import brute as groups


def test_each_stage_equals_brute_force_on_its_own_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in C.STAGES:
        before, out = docs, materialize(stage(spark, docs, sf), "stage")
        kept[name] = out
        rows, was = out.collect(), before.collect()
        if name != C.STAGES[-1][0]:
            assert out.columns == before.columns
        if name == "toxicity":
            assert {tuple(r) for r in rows} <= {tuple(r) for r in was}
            labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
            gone = {r["doc_id"] for r in was} - {r["doc_id"] for r in rows}
            assert sum(labels.get(d, 1) for d in gone) >= 0.8 * len(gone)
        if name == "line dedup":
            want = {d: t for d, _, _, t in lines_kept([(r["doc_id"], r["text"]) for r in was], 10)}
            assert {r["doc_id"]: r["text"] for r in rows} == want and all(r["n_chars"] == len(r["text"]) for r in rows if want[r["doc_id"]] != r["text"])
        if name == "MinHash near-dedup":
            want = {d for d, _, _, k in groups([(r["doc_id"], r["text"]) for r in was], 5) if k}
            assert {r["doc_id"] for r in rows} == want and len(rows) == len(want)
        if name == "mixing":
            ids = [r["doc_id"] for r in rows]
            assert set(ids) <= {r["doc_id"] for r in was} and max(map(ids.count, ids)) <= 3
        if name == "SentencePiece encoding":
            assert len(rows) == len(was) and all(r["restored"] for r in rows)
        docs = out


def test_the_run_is_the_stages(spark, sf):
    out = C.run(spark, sf)
    assert out.columns == ["doc_id", "lang", "source", "n_ids", "ids", "restored"] and out.count() > 100
    assert C.ORACLE_SQL is None


def test_odd_rows_pass_all_stages(spark, empty, tmp_path):
    docs = [(i, f"own{i} " * 30 + f"and {i * 7919} other words {i}", "ab"[i % 2]) for i in range(20)]
    docs += [(50, None), (51, ""), (52, " \n\t"), (None, "no id here"), (53, "long " * 60_000), (54, "twice"), (54, "twice"), (55, "of source null", None)]
    tables = {"odd": (documents(spark, docs), [(1, 1), *((i, 0) for i in range(2, 16)), (None, 1), (3, None)]), "empty": (empty, [])}
    for name, (rows, labels) in tables.items():
        rows.coalesce(1).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, toxic int").coalesce(1).write.parquet(f"{tmp_path}/{name}/labels.parquet")
    out = C.run(spark, f"{tmp_path}/odd").collect()
    assert out and all(r["restored"] for r in out)
    assert {r["doc_id"] for r in out} <= {d[0] for d in docs} and all(r["n_ids"] == len(r["ids"]) for r in out)
    assert C.run(spark, f"{tmp_path}/empty").collect() == []
