"""The pipeline, stage by stage, against brute force on the smallest tables."""

import re
from pathlib import Path

import corpus_pipeline as P
from test_jaccard import brute
from tidemark.llm.common import shared_dir
from tidemark.llm.toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_names():
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact dedup", "SimHash near-dedup", "decontamination", "packing"]
    assert P.ORACLE_SQL is None


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        after_df = spark.read.parquet(str(tmp_path / str(k)))
        after = after_df.collect()
        ids = {r.doc_id for r in after}
        if name != "packing":
            assert after_df.columns == COLUMNS and len(after) == len(ids) and all(before[r.doc_id] == r for r in after)
        if name == "toxicity":
            scores = {r.doc_id: r.predicted for r in score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
            assert ids == {i for i in before if not scores[i]}
        elif name == "exact dedup":
            best = {}
            for i, r in before.items():
                key = (r.text or "").encode().lower()
                best[key] = max(best.get(key, i), i)
            assert ids == set(best.values())
        elif name == "SimHash near-dedup":
            assert ids == brute([(r.doc_id, r.text) for r in before.values()])
        elif name == "decontamination":
            plain = lambda t: re.sub(r"[^0-9a-z\x80-\U0010ffff]+", " ", t.lower())
            items = [plain(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            assert set(before) - ids == {i for i, r in before.items() if any(x.strip() in plain(r.text or "") for x in items)}
        else:
            assert ids == set(before)
            n = {}
            for r in after:
                n[r.doc_id] = n.get(r.doc_id, 0) + r.n_tokens
            assert n == {i: len(re.findall(rb"[^\x20\x09-\x0d]+", (r.text or "").encode())) for i, r in before.items()}
        docs = after_df


def test_run(spark, sf_dir):
    home = Path(shared_dir(spark).removeprefix("file:")) / "tidemark"
    before = set(home.iterdir()) if home.exists() else set()
    rows = P.run(spark, sf_dir).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.bin_id, []).append(r)
    assert rows and all(sum(r.n_tokens for r in b) <= 2048 and len({r.source for r in b}) == len(b) for b in bins.values())
    assert [p.name.rsplit("-", 1)[0] for p in set(home.iterdir()) - before] == ["stage-decontamination"]


def test_odd_rows(spark, sf_dir, tmp_path):
    """Nulls in any column, empty and repeated rows, repeated identifiers, clashing columns, an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _gone int, _digest binary, key string, cluster long, u long"
    text = "the quick brown fox jumps over the lazy dog and runs into the dark wood behind the house"
    rows = [(1, text), (1, text), (2, text.upper()), (1, "another text of the first one"), (None, text), (None, None), (3, None), (4, ""), (5, text + " again"), (6, None), (None, "q")]
    folder = tmp_path / "sf"
    folder.mkdir()
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(str(folder / f"{name}.parquet"))
    docs = spark.createDataFrame([(i, t, None, f"s{k}" if k % 2 else None, None, k, b"x", None, k, None) for k, (i, t) in enumerate(rows)], schema)
    docs.write.parquet(str(folder / "documents.parquet"))
    once = P.exact(spark, docs, str(folder)).persist()
    assert sorted((r.doc_id or 0, (r.text or "").lower()) for r in once.collect()) == sorted([(2, text), (1, "another text of the first one"), (6, ""), (5, text + " again"), (0, "q")])
    left = P.near(spark, once, str(folder))
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 6]
    for stage in (P.toxicity, P.decontaminate):
        out = stage(spark, docs, str(folder))
        assert out.columns == docs.columns and out.count() == len(rows)
    docs.limit(0).write.mode("overwrite").parquet(str(folder / "documents.parquet"))
    assert P.run(spark, str(folder)).count() == 0
