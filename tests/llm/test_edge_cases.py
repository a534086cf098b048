"""Every operator and stage on awkward tables; each case has its defined result."""

import corpus_pipeline
import pytest
from tessera.llm import op01_minhash, op02_toxicity, op03_simhash, op04_quality, op05_exact_dedup, op06_packing, op07_substring_dedup, op08_token_counts, op09_repeated_bytes, op10_mixing, op11_resampling, op12_sharding, op13_search
from tessera.llm.queries import vocabulary

from .helpers import clashing, empty, marks, rows_of, tricky, tricky_rows

BPE = vocabulary("byte_bpe_50k.json")
OPERATORS = {
    "op1": lambda s, d: op01_minhash.document_fingerprints(d),
    "op2": lambda s, d: op02_toxicity.toxicity(d, marks(s)),
    "op3": lambda s, d: op03_simhash.simhash_components(d),
    "op4": lambda s, d: op04_quality.quality(d, marks(s)),
    "op5": lambda s, d: op05_exact_dedup.exact_dedup(d),
    "op6": lambda s, d: op06_packing.pack_documents(d, BPE),
    "op7": lambda s, d: op07_substring_dedup.substring_dedup(d).drop("spans"),
    "op8": lambda s, d: op08_token_counts.token_counts(d, BPE),
    "op9": lambda s, d: op09_repeated_bytes.remove_repeats(d),
    "op10": lambda s, d: op10_mixing.mix(d).select("doc_id", "text", "source", "lang", "_topic", "_tokens", "_probability", "_kept"),
    "op11": lambda s, d: op11_resampling.resample(d, tricky(s)),
    "op12": lambda s, d: op12_sharding.shard_documents(d).drop("shard", "slot"),
}
N = len(tricky_rows())


def _plain(df):
    cols = [c for c in df.columns if c not in ("sequence_id", "offset")]
    return rows_of(df, *cols)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_awkward_rows(spark, name):
    op = OPERATORS[name]
    got = _plain(op(spark, tricky(spark)))
    assert len({r[0] for r in got}) == len({r[0] for r in tricky_rows()})
    if name != "op6":
        assert len(got) == N
    # Extra columns, whatever their names, and the partitioning change nothing.
    assert _plain(op(spark, clashing(spark).repartition(7, "n_chars"))) == got


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(spark, name):
    out = OPERATORS[name](spark, empty(spark))
    assert out.count() == 0
    assert out.columns == OPERATORS[name](spark, tricky(spark)).columns


@pytest.fixture(scope="module")
def labelled(tmp_path_factory, spark):
    d = tmp_path_factory.mktemp("sf")
    marks(spark, [(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None)]).write.parquet(f"{d}/labels.parquet")
    return str(d)


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("table", [tricky, clashing, empty])
def test_stage_on_awkward_tables(spark, labelled, stage, table):
    docs = table(spark)
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, labelled)
    got = out.collect()
    if table is empty:
        assert got == []
    if stage != "packing":
        assert out.columns == docs.columns
        ids = [r.doc_id for r in got if r.doc_id is not None]
        if stage in ("exact_dedup", "simhash_near_dedup"):
            assert len(ids) == len(set(ids))  # the repeated row counts once
            assert len(got) - len(ids) == (0 if table is empty else 1)  # of the rows without an id only that with a text of its own stays


def test_dedup_stages_judge_rows_without_id_and_repeated_ids(spark):
    text, other = tricky_rows()[0][1], tricky_rows()[8][1][:600]
    near = text + " tail"
    rows = [(None, text), (None, text.upper()), (None, other), (3, other), (3, other.upper()), (4, text + " x"), (4, "quite another text"), (None, "quite another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stages = dict(corpus_pipeline.STAGES)
    exact = {(r.doc_id, r.text.lower()) for r in stages["exact_dedup"](spark, docs, "").collect()}
    assert exact == {(None, text), (3, other), (4, text + " x"), (4, "quite another text")}
    assert stages["exact_dedup"](spark, docs, "").count() == 4  # one row of each text, ids or not
    want = op03_simhash.fingerprint(text), op03_simhash.fingerprint(near)
    linked = bin(want[0] ^ want[1]).count("1") <= op03_simhash.MAX_BITS
    d = spark.createDataFrame([(None, text), (None, text), (None, near), (7, other), (7, "something else here"), (5, other)], "doc_id long, text string")
    got = stages["simhash_near_dedup"](spark, d, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in got if r.doc_id) == sorted([(5, other), (7, "something else here")])
    assert sum(r.doc_id is None for r in got) == (1 if linked else 2)


def test_defined_results(spark):
    by_id = lambda df: {r.doc_id: r for r in df.collect() if r.doc_id is not None}
    d = tricky(spark)
    o5 = by_id(op05_exact_dedup.exact_dedup(d))
    assert (o5[1].keep_id, o5[1].group_size, o5[2].kept) == (2, 3, True)  # two ids and one row without
    assert (o5[4].keep_id, o5[4].group_size) == (5, 3)
    twice = [r.kept for r in op05_exact_dedup.exact_dedup(d).collect() if r.doc_id == 12]
    assert sorted(twice) == [False, True]
    o3 = by_id(op03_simhash.simhash_components(d))
    assert o3[4].fingerprint == o3[6].fingerprint == "0" * 16 and o3[5].component_id == o3[6].component_id == 4
    assert o3[1].component_id == o3[2].component_id == 1
    o8 = by_id(op08_token_counts.token_counts(d, BPE))
    assert (o8[4].n_tokens, o8[5].n_bytes, o8[9].over_limit) == (0, 0, True)
    o9 = by_id(op09_repeated_bytes.remove_repeats(d))
    assert (o9[13].n_removed, o9[13].n_spans, o9[7].n_removed) == (1500, 1, 0)
    o1 = by_id(op01_minhash.document_fingerprints(d))
    assert o1[15].near_next == 1.0 and o1[4].fingerprint == "" and o1[5].near_next == 1.0
    assert o1[15].fingerprint == o1[16].fingerprint
    o10 = op10_mixing.mix(d).collect()
    assert all(0 <= r._probability <= 1 for r in o10) and max(r._probability for r in o10) == 1.0


def test_single_row_follows_itself(spark):
    one = spark.createDataFrame([(7, "a few words that follow themselves")], "doc_id long, text string")
    r = op01_minhash.document_fingerprints(one).collect()
    assert len(r) == 1 and r[0].near_next == 1.0


def test_new_operators_on_awkward_rows(spark):
    d = tricky(spark)
    by_id = lambda df: {r.doc_id: r for r in df.collect() if r.doc_id is not None}
    o11 = op11_resampling.resample(d, empty(spark), least_words=2, percent=100).collect()
    assert [(r.n_features, r.weight) for r in o11 if r.doc_id in (4, 5, 6)] == [(0, 0)] * 3
    ranks = sorted(r["rank"] for r in o11 if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == sum(r.n_features >= 2 for r in o11)
    twice = [r["rank"] for r in o11 if r.doc_id == 12]
    assert abs(twice[0] - twice[1]) == 1  # the repeated row follows
    o12 = op12_sharding.shard_documents(d).collect()
    assert {r.size for r in o12 if r.doc_id in (4, 5)} == {1} and {r.law for r in o12} == {"bytes"} and {r.grown_shard for r in o12} == {None}
    for j in range(op12_sharding.SHARDS):
        slots = sorted(r.slot for r in o12 if r.shard == j)
        assert slots == list(range(len(slots)))
    assert by_id(op12_sharding.shard_documents(d))[9].tokens == 20_000


def test_search_on_awkward_rows(spark):
    d = tricky(spark)
    items = d.select(d.doc_id.alias("item_id"), "text", d.lang.alias("rank"), d.n_chars.alias("score"))
    got = rows_of(op13_search.search(d, items), "item_id", "rank", "doc_id", "score")
    assert rows_of(op13_search.search(clashing(spark).repartition(5, "n_chars"), items.repartition(3)), "item_id", "rank", "doc_id", "score") == got
    assert not [r for r in got if r[0] in (4, 5, 6)]  # no terms, no rows
    first = {r[0]: r[2] for r in got if r[1] == 1}
    assert first[9] in (9, 10) and first[1] == first[2] == 1  # equal scores: the smaller id
    assert [r[2] for r in got if r[0] == 2][-1] is None or len([r for r in got if r[0] == 2]) <= 10
    assert op13_search.search(empty(spark), items).count() == op13_search.search(d, items.limit(0)).count() == 0
    assert op13_search.search(d, items).columns == ["item_id", "rank", "doc_id", "score"]
