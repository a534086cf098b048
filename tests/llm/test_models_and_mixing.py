"""Held-out accuracy of the classifiers, mixing and exact dedup against SQL, and the pipeline stage by stage."""

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from tessera.llm import op02_toxicity, op10_mixing
from tessera.llm.queries import ORACLE_SQL, QUERIES

from ..conftest import SF_SMALL
from .helpers import lower_az
from .test_brute_force import _components, _simhash

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLE_SQL[name]).df()[list(got.columns)]
    key = "doc_id"
    got, want = (x.sort_values(key).reset_index(drop=True) for x in (got, want))
    assert len(got) == len(want)
    for c in got.columns:
        if got[c].dtype == float:
            assert np.allclose(got[c], want[c], rtol=0, atol=1e-8)
        else:
            assert got[c].tolist() == want[c].tolist()


@pytest.mark.parametrize(("name", "label", "least"), [("op2_toxicity", "toxic", 0.95), ("op4_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, duck, name, label, least):
    got = QUERIES[name](spark, SF).toPandas()
    ids = got["doc_id"].tolist()
    assert sorted(ids) == sorted(r[0] for r in duck.execute("SELECT doc_id FROM documents").fetchall())
    import zlib

    assert got["held_out"].tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in ids]
    assert got["score"].between(0, 1).all()
    marked = got.merge(duck.execute(f"SELECT doc_id, {label} AS y FROM labels").df(), on="doc_id")
    held = marked[marked["held_out"]]
    assert (held["predicted"] == held["y"]).mean() >= least


def test_toxicity_grammar_composes():
    g = op02_toxicity.Grammar({"glorp": 1.0})

    def matched(text):
        x = g.features(text)
        return {op02_toxicity.MATCHES[i]: x[i] for i in np.flatnonzero(x)}

    assert matched("What a fine day. You are an idiot!") == {("insult", 1, 0, 0): 1.0}
    assert matched("it is not stupid") == {("insult", 0, 1, 0): 1.0}
    assert matched("the paper reported that he was a moron") == {("insult", 1, 0, 1): 1.0}
    assert matched("she said you are not a clown") == {("insult", 1, 1, 1): 1.0}
    assert matched("You left. idiot") == {("insult", 0, 0, 0): 1.0}  # a scope ends with its clause
    assert matched("they will hurt you, glorpish") == {("threat", 1, 0, 0): 1.0, ("insult", 0, 0, 0): 1.0}
    assert matched("idiotic clownfish glow") == {}


def test_raking_meets_given_marginals(spark):
    rows = [("a", "en", "x", 700), ("a", "de", "y", 100), ("b", "en", "y", 150), ("b", "de", "x", 50), (None, "en", "x", 30), (None, "de", "y", 0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, n long")
    t = lambda rows: spark.createDataFrame(rows, "value string, target double")
    targets = {"source": t([("a", 0.4), ("b", 0.4), (None, 0.2)]), "lang": t([("en", 0.7), ("de", 0.3)]), "topic": t([("x", 0.5), ("y", 0.5)])}
    got = op10_mixing.rake(cells, op10_mixing.TEMPER, targets, sweeps=60).toPandas()
    total = got["w"].sum()
    assert np.isclose(got.groupby("topic")["w"].sum()["x"] / total, 0.5, atol=1e-6)
    assert np.isclose(got.groupby("lang")["w"].sum()["en"] / total, 0.7, atol=1e-3)
    assert np.isclose(got.groupby("source")["w"].sum()["a"] / total, 0.4, atol=1e-3)


def test_one_rare_cell_does_not_set_the_kept_share(spark):
    rows = [(i, "word " * (20 + i % 50), "en" if i % 4 else "de", f"s{i % 3}") for i in range(600)]
    schema = "doc_id long, text string, lang string, source string"
    for extra in ([], [(1000, "word", "xx", "s0")], [(1000, "word " * 50, "en", "new")]):
        got = op10_mixing.mix(spark.createDataFrame(rows + extra, schema)).toPandas()
        assert got["_probability"].max() <= 1
        assert np.isclose((got["_probability"] * got["_tokens"]).sum() / got["_tokens"].sum(), op10_mixing.SHARE, atol=1e-4)
        assert got[got["doc_id"] == 1000]["_kept"].all()  # a value whose target is over its tokens stays whole
        assert abs(got["_kept"].mean() - op10_mixing.SHARE) < 0.1


def test_bounded_raking_hands_on_what_full_cells_cannot_take(spark):
    rows = [("a", "en", "x", 800), ("a", "de", "x", 20), ("b", "en", "x", 100), ("b", "de", "x", 300), ("c", "en", "x", 10)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, n long")
    t = spark.createDataFrame([("a", 0.45), ("b", 0.35), ("c", 0.2)], "value string, target double")
    got = op10_mixing.rake(cells, op10_mixing.TEMPER, {"source": t}, sweeps=20, share=0.5).toPandas()
    by = got.groupby("source")["w"].sum()
    assert (got["w"] <= got["n"]).all() and np.isclose(got["w"].sum(), 615)
    assert np.allclose([by["a"], by["b"], by["c"]], [605 * 45 / 80, 605 * 35 / 80, 10], rtol=1e-3)


def test_raking_goes_on_until_sparse_cells_meet_their_targets(spark, caplog):
    cells = spark.createDataFrame([("a", "en", "x", 1000), ("a", "de", "x", 1), ("b", "de", "x", 1000)], "source string, lang string, topic string, n long")
    t = lambda rows: spark.createDataFrame(rows, "value string, target double")
    targets = {"source": t([("a", 0.6), ("b", 0.4)]), "lang": t([("en", 0.5), ("de", 0.5)])}
    got = op10_mixing.rake(cells, op10_mixing.TEMPER, targets).toPandas()
    assert np.isclose(got.groupby("source")["w"].sum()["a"] / got["w"].sum(), 0.6, rtol=op10_mixing.TOLERANCE)
    assert not caplog.records


def test_mixing_plan_is_native(spark):
    plan = QUERIES["op10_mixing"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage against what its predecessor kept, by brute force where SQL has no form."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cols = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == cols and all(after[i] == before[i] for i in after)
        if name == "toxicity":
            labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
            gone = set(before) - set(after)
            assert sum(labels[i].toxic == 0 for i in gone if i in labels) <= 1 and gone
        if name == "exact_dedup":
            best = {}
            for i, r in before.items():
                t = lower_az(r.text)
                best[t] = max(best.get(t, i), i)
            assert set(after) == set(best.values())
        if name == "simhash_near_dedup":
            assert set(after) == set(_components({i: _simhash(r.text or "") for i, r in before.items()}).values())
        if name == "mixing":
            want = {r.doc_id for r in op10_mixing.mix(spark.read.parquet(f"{tmp_path}/simhash_near_dedup")).collect() if r._kept}
            assert set(after) == want and want
        kept[name] = set(after)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {r.doc_id for r in packed} == kept["mixing"]
    whole = corpus_pipeline.run(spark, SF_SMALL).collect()
    pieces = lambda rows: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows)
    assert pieces(whole) == pieces(packed)
