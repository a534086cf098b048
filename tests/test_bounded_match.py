"""J2 with bounds: the matches of the full join, from a small part of its pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import identity as I
from tessera.plans.q_identity import _second_export

from .conftest import SF_SMALL


def _people(seed):
    rng = random.Random(seed)
    ids, names = [], []
    for i in range(60):
        names.append((f"e{i}", None if i == 7 else "".join(rng.choice("abc") for _ in range(rng.randint(0, 6)))))
        ids += [(f"e{i}", v) for v in {rng.choice(["hot", f"v{rng.randrange(25)}"]) for _ in range(rng.randint(0, 6))} | ({""} if i % 9 == 0 else set())]
    return ids, names


@pytest.mark.parametrize("least", [0.65, 0.85, 1.0])
def test_bounded_equals_full(spark, least):
    ids, names = _people(int(least * 100))
    p, pn = spark.createDataFrame(ids, "profile_id string, id_value string"), spark.createDataFrame(names, "profile_id string, name string")
    q, qn = p.withColumnRenamed("profile_id", "qid"), pn.withColumnRenamed("profile_id", "qid")
    row = lambda r: (r.qid, r.profile_id, round(r.confidence, 12), round(r.overlap, 12))
    full = {row(r) for r in I.probabilistic_match(q, qn, p, pn, exclude_self=True).where(F.col("confidence") >= least).collect()}
    got = I.bounded_match(q, qn, p, pn, least, exclude_self=True).collect()
    assert {row(r) for r in got} == full and len(got) == len(full)


def test_a_value_shared_by_all_makes_few_pairs(spark):
    q, qn, p, pn = _second_export(spark, SF_SMALL)
    n = qn.count()
    assert n * n <= q.join(p, "id_value").count()  # every query meets every profile by the switchboard
    assert I.candidate_pairs(q, qn, p, pn, 0.85).count() <= 3 * n
