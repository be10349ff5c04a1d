import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import decontam, minhash, mixing

from .test_line_dedup import brute as line_brute
from .test_minhash import brute as near_brute


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """The documents before each stage, and after the last."""
    folder = str(tmp_path_factory.mktemp("stages"))
    out = [spark.read.parquet(f"{sf}/documents.parquet")]
    for i, (_, stage) in enumerate(cp.STAGES):
        stage(spark, out[-1], sf).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line dedup", "near-dedup", "decontamination", "mixing"]
    assert all(s.columns == stages[0].columns for s in stages)


def test_toxicity_keeps_texts_as_they_are(stages):
    assert stages[1].exceptAll(stages[0]).count() == 0 and 0 < stages[1].count() < stages[0].count()


def test_lines(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    want = sorted((i, t) for i, _, _, t in line_brute(rows))
    assert sorted((r["doc_id"], r["text"]) for r in stages[2].collect()) == want
    assert stages[2].filter(F.char_length("text") != F.col("n_chars")).count() == 0


def test_near(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    want = sorted(i for i, v in near_brute(rows, k=minhash.SHINGLE).items() if v[2])
    assert sorted(r["doc_id"] for r in stages[3].collect()) == want


def test_leaks(stages, spark, sf):
    items = [decontam.normalised(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = [decontam.normalised(r["text"]) for r in stages[4].collect()]
    assert not any(i in t for t in left for i in items if len(i) >= decontam.SHORT)
    assert stages[4].exceptAll(stages[3]).count() == 0


def test_mix(stages):
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan_copies(stages[4]).collect()}
    got = {r["doc_id"]: r["count"] for r in stages[5].groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in copies.items() if v}


def test_run_agrees(spark, sf, stages):
    assert sorted(r["doc_id"] for r in cp.run(spark, sf).collect()) == sorted(r["doc_id"] for r in stages[-1].collect())


@pytest.fixture
def folder(spark, sf, tmp_path):
    """Tables with given documents, and labels and benchmark items that fit them or not."""

    def make(name, docs):
        path = str(tmp_path / name)
        docs.write.parquet(f"{path}/documents.parquet")
        for t in ("labels", "benchmark"):
            spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
        return path

    return make


def test_odd_documents(spark, folder, documents, odd_rows):
    """NULLs, empty and long texts, repeated rows and ids, ties, and columns with the names of working columns go through."""
    docs = documents([*odd_rows, (20, "word"), (20, "other text"), (21, None, None), (22, "", None)])
    for c in ("_tox", "_ld_lines", "_mix_copies", "score", "rep", "component_id", "band", "kept"):
        docs = docs.withColumn(c, F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    path = folder("odd", docs)
    frame, seen = spark.read.parquet(f"{path}/documents.parquet"), []
    for i, (_, stage) in enumerate(cp.STAGES):
        stage(spark, frame, path).write.parquet(f"{path}/{i}")
        frame = spark.read.parquet(f"{path}/{i}")
        assert frame.columns == docs.columns
        for c in ("_tox", "_ld_lines", "_mix_copies", "score", "rep", "component_id", "band", "kept"):
            assert frame.filter(F.col(c) != F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))).count() == 0
        seen.append(frame)
    # rows without text or id outlast all stages but the mix
    assert seen[3].filter("doc_id IS NULL").count() == 2 and {r["doc_id"] for r in seen[3].select("doc_id").collect()} >= {1, 2, 3, 21, 22}


def test_no_documents(spark, folder, documents):
    assert cp.run(spark, folder("none", documents([]))).count() == 0
