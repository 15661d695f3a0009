"""The pipeline's stages one by one against plain Python, over documents with planted cases, null and repeated ids."""

import os
import re
import subprocess
import sys
import textwrap

import corpus_pipeline
from codeloom.llm import decontaminate, exact, minhash, packing, toxicity
from tests.llm.support import DOCS

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
ITEM = "the quick grey fox walks slowly over the old wooden bridge at dawn"
WORDS = [f"word{i}" for i in range(60)]


def planted():
    """(doc_id, text): a clean text, equal and near copies of it, a benchmark passage, and ids that are null or occur twice."""
    long = " ".join(WORDS)
    near = " ".join([*WORDS[:-1], "other"])
    leaked = "before " + ITEM + " after"
    own = " ".join(f"own{i}" for i in range(30))
    return [
        (1, long), (2, long.replace(" ", "  ")), (3, near), (4, leaked), (5, own), (5, long), (5, "one more text of five alone"),
        (None, long), (None, leaked), (None, "text that only a row without id holds"), (6, ""), (7, None), (8, own + " \n"), (9, own), (9, own),
    ]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], DOCS)


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def exact_kept(rows):
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    lowest = {n: min((i for (i, _), m in zip(rows, normal) if m == n and i is not None), default=None) for n in normal}
    return [r for r, n in zip(rows, normal) if lowest[n] is None or r[0] == lowest[n]]


def near_kept(rows):
    """Rows whose set, or one at least 75 % alike, belongs to no smaller doc_id. The planted groups are no chains."""
    kept = []
    for i, t in rows:
        own = shingles(t)
        alike = [j for j, u in rows if j is not None and own and (shingles(u) == own if i is None else 100 * len(own & shingles(u)) >= 75 * len(own | shingles(u)))]
        if not alike or i == min(alike):
            kept.append((i, t))
    return kept


def test_stages_judge_every_row(spark, sf, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = planted()
    after_exact = texts(exact.stage(spark, frame(spark, rows), ""))
    assert after_exact == sorted(exact_kept(rows), key=repr)
    after_near = texts(minhash.stage(spark, frame(spark, after_exact), ""))
    assert after_near == sorted(near_kept(after_exact), key=repr)
    after_leaks = texts(decontaminate.stage(spark, frame(spark, after_near), str(tmp_path)))
    assert after_leaks == sorted([r for r in after_near if ITEM not in (r[1] or "")], key=repr)
    assert (None, "text that only a row without id holds") in after_leaks and (5, "one more text of five alone") in after_leaks
    assert not any(ITEM in (t or "") or t == " ".join([*WORDS[:-1], "other"]) for _, t in after_leaks)
    pieces = packing.stage(spark, frame(spark, after_leaks), "").collect()
    assert sorted((str(r["doc_id"]) for r in pieces)) == sorted(str(i) for i, _ in after_leaks)
    for stage in (exact.stage, minhash.stage):
        assert stage(spark, frame(spark, []), "").collect() == [] and stage(spark, frame(spark, rows), "").columns == frame(spark, []).columns


def test_toxic_rows_go_and_others_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert {r["doc_id"] for r in toxicity.stage(spark, docs, sf).collect()} == {i for i, p in scored.items() if p == 0}


def test_run_chains_the_stages(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
    want = sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packing.token_pieces(docs).collect())
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in got) == want and want


def test_executors_need_no_copy_of_the_package(tmp_path, sf):
    """A session in another directory, whose workers cannot import the package, runs the queries that send objects to tasks."""
    script = textwrap.dedent(f"""
        import sys
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        spark.range(1).mapInArrow(lambda it: it, "id long").collect()
        sys.path.insert(0, {REPO!r})
        from codeloom.llm.queries import QUERIES
        for name in ("op3_urlfilter", "op4_toxicity", "op10_langid", "op11_nearest", "op12_repair", "op13_manifest"):
            print(name, QUERIES[name](spark, {sf!r}).count())
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0 and done.stdout.count("op") == 6, done.stderr[-1500:]
