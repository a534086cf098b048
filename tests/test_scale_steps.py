"""Steps that must not gather a growing table in one task or one broadcast."""

from pyspark.sql import functions as F

from tessera.operators import consent as C
from tessera.operators import identity as I
from tessera.streaming import pipeline as S
from tessera.streaming import state as K


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_consent_merge_broadcasts_no_consent_rows(spark):
    state = spark.createDataFrame([("a", "email", True), ("b", "email", False), ("a", "sms", True)], "student_id string, channel string, consented boolean")
    state = state.withColumns({"legal_basis": F.lit("consent"), "updated_at": F.current_timestamp(), "terms_version": F.lit("v1")})
    pairs = spark.createDataFrame([("a", "b")], "primary_id string, secondary_id string")
    new, rewrites = C.merge_consent(state, pairs, F.current_timestamp())
    assert "BroadcastHashJoin" not in _plan(rewrites) and "BroadcastHashJoin" not in _plan(new)
    assert {(r.student_id, r.channel): r.consented for r in rewrites.collect()}[("a", "email")] is False


def test_resolution_broadcasts_no_identifier_table(spark):
    ids = spark.createDataFrame([("p1", "email", "x"), ("p2", "email", "y")], "profile_id string, id_type string, id_value string")
    names = spark.createDataFrame([("p1", "Ann"), ("p2", "Bob")], "profile_id string, name string")
    rows = spark.createDataFrame([(1, 0, "email", "x")], "event_id long, pos int, id_type string, id_value string")
    hit = I.deterministic_match(rows, ids)
    assert "BroadcastHashJoin" not in _plan(hit) and hit.first().profile_id == "p1"
    q = ids.withColumnRenamed("profile_id", "qid")
    fuzzy = I.probabilistic_match(q, names.withColumnRenamed("profile_id", "qid"), ids, names)
    text = _plan(fuzzy)
    assert text.count("SortMergeJoin") >= 3 and {r.qid: r.profile_id for r in fuzzy.collect()} == {"p1": "p1", "p2": "p2"}


def test_a_chunk_of_many_rows_is_many_files_and_one_batch(spark):
    path = S.scratch_dir(spark, "chunks")
    # The last chunk holds a single row: its files are made up to the same number.
    df = spark.range(300).unionByName(spark.range(399, 400)).withColumnRenamed("id", "event_id")
    files = S.write_stream_files(df, path, "event_id", 4, file_rows=25)
    assert files == 4
    seen = []
    out = S.scratch_dir(spark, "seen")
    q = S.read_event_stream(spark, path, df.schema, files).writeStream.foreachBatch(lambda b, i: seen.append(sorted(r.event_id for r in b.collect()))).option("checkpointLocation", out).trigger(availableNow=True).start()
    q.awaitTermination()
    assert seen == [list(range(0, 100)), list(range(100, 200)), list(range(200, 300)), [399]]


class _Handle:
    """State of one key, with the requests that would go to Spark."""

    def __init__(self):
        self.held, self.requests = {}, 0

    def getMapState(self, *_):  # noqa: N802
        return self

    def getValueState(self, *_):  # noqa: N802
        return self

    def getValue(self, key):  # noqa: N802
        self.requests += 1
        return self.held.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.requests += 1
        self.held[key] = value


def test_a_key_costs_two_requests_per_category(spark):
    from pyspark.sql import Row

    p, h = K.RunningCounts(), _Handle()
    p.init(h)
    row = lambda us, c, chat=0: Row(event_id=1, us=us, category=c, chat=chat, started=0, completed=0)
    assert [tuple(r) for r in p.handleInputRows(("k",), iter([row(5, "a"), row(3, "a", 1)]), None)] == [("k", "counts", "a", 3, 5, 1, 0, 0, 2)]
    assert [tuple(r) for r in p.handleInputRows(("k",), iter([row(9, "a"), row(None, None)]), None)] == [("k", "counts", None, None, None, 0, 0, 0, 1), ("k", "counts", "a", 3, 9, 1, 0, 0, 3)]
    assert h.requests == 6
