"""The pipeline stage by stage, and the driver contract of this package."""
import importlib
import sys

import duckdb
import pytest

from llm_helpers import AWKWARD, frame, prose

import random

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pipeline():
    return importlib.import_module("corpus_pipeline")


def test_stages_and_columns(spark, pipeline):
    assert [n for n, _ in pipeline.STAGES] == [
        "language_id", "line_dedup", "minhash_near_dedup", "decontamination", "bpe_round_trip"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        assert out.select("doc_id").subtract(docs.select("doc_id")).count() == 0


def test_run_matches_the_stages_on_their_own(spark, pipeline):
    """What the whole run returns is what brute-force versions of its decisions leave."""
    out = {r.doc_id: r for r in pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert out.keys() == texts.keys() and 0 < len(out) < 200
    import hashlib
    for i, r in out.items():
        assert r.decoded_sha256 == hashlib.sha256(texts[i].encode()).hexdigest()


def test_each_decision(spark, pipeline):
    rng = random.Random(2)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    one = prose(rng, 120)
    near = one.rsplit(" ", 1)[0] + " changed"
    rows = [(1, one), (2, near), (3, f"{prose(rng, 30)} {bench} {prose(rng, 30)}"), (4, "12 34 !!"), (5, None), (6, ""),
            (7, prose(rng, 90)), (8, "a line of its own here\n" + prose(rng, 40)), (9, "a line of its own here\n" + prose(rng, 40))]
    docs = frame(spark, rows)
    kept = lambda stage: {r.doc_id: r.text for r in stage(spark, docs, SF).collect()}
    assert kept(pipeline.identify_language).keys() == {1, 2, 3, 7, 8, 9}
    lines = kept(pipeline.dedup_lines)
    assert "its own" in lines[8] and "its own" not in lines[9] and lines[7] == rows[6][1]
    assert kept(pipeline.dedup_documents).keys() == {1, 3, 4, 5, 6, 7, 8, 9}
    assert kept(pipeline.drop_leaks).keys() == {1, 2, 4, 5, 6, 7, 8, 9}


def test_rows_are_judged_one_by_one(spark, pipeline):
    """Clean texts that share an id with a leaking or a repeated one stay; rows without an id go like others."""
    rng = random.Random(21)
    bench = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    items = spark.createDataFrame([(1, bench), (2, "三个问题的答案"), (3, "exactly three words")], "item_id long, text string")
    clean, other = prose(rng, 60), prose(rng, 60)
    rows = [(1, clean), (1, f"so {bench} it says"), (None, f"and {bench}."), (None, other), (2, "他说三个问题的答案是"), (3, "Exactly, three words."), (4, "exactly two words")]
    docs = frame(spark, rows)
    pipeline_table, pipeline.table = pipeline.table, lambda *a: items
    try:
        got = sorted((r.doc_id or 0, r.text) for r in pipeline.drop_leaks(spark, docs, SF).collect())
    finally:
        pipeline.table = pipeline_table
    assert got == sorted([(1, clean), (0, other), (4, "exactly two words")])
    twice = [(5, clean), (5, other), (6, clean + " end"), (None, other), (7, other)]
    got = sorted((r.doc_id or 0, r.text) for r in pipeline.dedup_documents(spark, frame(spark, twice), SF).collect())
    assert got == sorted([(5, clean), (5, other)])


def test_documents_between_80_and_85_per_cent_go(spark, pipeline):
    from balances.llm import hyperminhash
    words = prose(random.Random(7), 300).split()
    changed = list(words)
    for k in (30, 80, 130, 180, 230, 280):
        changed[k] = "changed"
    one, near = " ".join(words), " ".join(changed)
    sets = [hyperminhash.shingle_set(t) for t in (one, near)]
    assert 0.80 <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.85
    out = pipeline.dedup_documents(spark, frame(spark, [(1, one), (2, near), (3, prose(random.Random(8), 300))]), SF)
    assert {r.doc_id for r in out.collect()} == {1, 3}


def test_stages_take_awkward_and_empty_tables(spark, pipeline):
    for rows in ([], AWKWARD):
        docs = frame(spark, rows)
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            assert out.count() <= len(rows)
        assert pipeline.STAGES[-1][1](spark, docs, SF).count() == len(rows)


@pytest.mark.parametrize("name", ["op6_exact_dedup", "op9_decontaminate", "op11_hard_negatives", "op12_prefix_trie"])
def test_sql(spark, name):
    from balances.llm import registry
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    cols = sorted(want.columns)
    want = sorted(map(repr, want.select(*[f'"{c}"' for c in cols]).fetchall()))
    assert sorted(repr(tuple(r)) for r in registry.queries()[name](spark, SF).select(*cols).collect()) == want


def test_every_number_has_one_query():
    from balances.llm import registry
    assert sorted(int(q[2:].split("_")[0]) for q in registry.queries()) == list(range(1, 14))


def test_entry_works_without_the_package(monkeypatch):
    """As if the folder and the pipeline file were deleted."""
    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name.split(".")[:2] == ["balances", "llm"] or name == "corpus_pipeline":
                raise ModuleNotFoundError(f"No module named {name!r}", name="balances.llm" if "llm" in name else name)

    for m in [m for m in sys.modules if m.startswith("balances.llm") or m in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, m)
    import balances
    monkeypatch.delattr(balances, "llm", raising=False)
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert names and not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
    assert set(entry.oracle_sql()) <= set(names)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
