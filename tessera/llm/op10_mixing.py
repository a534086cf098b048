"""Mixing sources to target weights by iterative proportional fitting (DataFrame functions only).

Documents fall into cells (source, language, topic); a cell's tokens are its first
weight.  Each sweep rakes the weights to the source, the language and the topic
marginals in turn.  A document is then kept with probability weight / tokens of its
cell.

The weights sum to a stated share of all tokens and no cell weighs more than its
tokens: what a full cell cannot take goes to the others of its source, language or
topic, and what a full value cannot take to the other values.  One rare cell so moves
its own tokens only.  Without a share the probabilities are scaled to a largest of 1:
nothing is clipped, but the rarest cell then sets how much of the corpus stays.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.session import cut_lineage

#: Sweeps go on, ten at a time, until no marginal is off its target by more than this part of it.
SWEEPS, TOLERANCE = 10, 1e-4
#: No further sweeps where this many brought the largest error down by less than a hundredth (inconsistent targets).
PATIENCE = 50
#: Share of all tokens that is kept (in expectation).
SHARE = 0.5
#: Target shares are the corpus shares to this power (1: as they are, 0: all equal).
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.7}
SEED = "mix-1"
_SCALE = float(1 << 48)
log = logging.getLogger(__name__)


def structural_topic(text: Column) -> Column:
    """A topic from what a text holds; pass another column to use a classifier's."""
    return (
        F.when(F.trim(text) == "", F.lit("empty"))
        .when(F.contains(text, F.lit("@")) | F.contains(text, F.lit("http")), F.lit("reference"))
        .when(F.contains(text, F.lit("icense")), F.lit("licensed"))
        .when(F.contains(text, F.lit("|")), F.lit("table"))
        .when(F.contains(text, F.lit("***")) | F.contains(text, F.lit("!!")), F.lit("noise"))
        .otherwise(F.lit("prose"))
    )


def word_tokens(text: Column) -> Column:
    """Tokens of a text for weighting: its separators plus one (empty: 0)."""
    gaps = F.length(text) - F.length(F.translate(text, " \n\t", ""))
    return F.when(text == "", F.lit(0).cast("long")).otherwise((gaps + 1).cast("long"))


def uniform(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by the id (by the text where the id is null)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), text)).cast("binary"))
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / F.lit(_SCALE)


def _scales(cells: DataFrame, axes: list[str], share: float) -> dict[str, float]:
    """Per axis the factor on its targets at which their sum, each at most the value's tokens, is ``share`` of all tokens."""
    values = [cells.groupBy(a).agg(F.sum("n").alias("n"), F.max(f"_t_{a}").alias("t")).select(F.lit(a).alias("axis"), "n", "t") for a in axes]
    values = cut_lineage(reduce(DataFrame.unionByName, values))
    goal = share * (cells.agg(F.sum("n")).first()[0] or 0)
    scales = dict.fromkeys(axes, 0.0)
    while True:  # factors only rise, and end when no further value is full
        scale = F.create_map(*[F.lit(x) for pair in scales.items() for x in pair])[F.col("axis")]
        full = F.col("n") <= scale * F.col("t")
        sums = values.groupBy("axis").agg(F.sum(F.when(full, F.col("n")).otherwise(0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("t"))).alias("open"))
        found = {r.axis: (goal - r.full) / r.open for r in sums.collect() if r.open > 0}  # a row per axis
        found = {a: f for a, f in found.items() if f > scales[a] * (1 + 1e-12)}
        if not found:
            return scales
        scales |= found


def _raked(out: DataFrame, axis: str, bounded: bool) -> DataFrame:
    """Weights ``w`` times the factor per value of ``axis`` that meets its target; bounded: a cell counts at most its tokens.

    Bounded, the cells now full are taken to stay so and the others' factor is solved
    for what they leave; where they leave nothing, all are scaled.  Either step moves
    towards the solution, and where the target is met the factor is 1.
    """
    value, target = Window.partitionBy(axis), F.col(f"_t_{axis}")
    full = F.col("w") > F.col("n")
    out = out.withColumn("_m", F.sum(F.when(full, 0.0).otherwise(F.col("w")) if bounded else F.col("w")).over(value))
    if not bounded:
        return out.withColumn("w", F.when(F.col("_m") > 0, F.col("w") * target / F.col("_m")).otherwise(0.0)).drop("_m")
    out = out.withColumn("_full", F.sum(F.when(full, F.col("n")).otherwise(0)).over(value))
    f = F.when((F.col("_m") > 0) & (target > F.col("_full")), (target - F.col("_full")) / F.col("_m")).when(F.col("_m") + F.col("_full") > 0, target / (F.col("_m") + F.col("_full")))
    return out.withColumn("w", F.col("w") * F.coalesce(f, F.lit(0.0))).drop("_m", "_full")


def marginal_error(out: DataFrame, axes: list[str], bounded: bool) -> float:
    """Largest error of a marginal share of ``w``, as a part of its target share."""
    w = F.least("w", F.col("n").cast("double")) if bounded else F.col("w")
    sums = [out.groupBy(a).agg(F.sum(w).alias("m"), F.max(f"_t_{a}").alias("t")).select(F.lit(a).alias("axis"), "m", "t") for a in axes]
    part = F.col("m") / F.col("t")  # null without a target: such values weigh nothing
    ends = reduce(DataFrame.unionByName, sums).where("t > 0").groupBy("axis").agg((F.sum("t") / F.sum("m")).alias("all"), F.min(part).alias("lo"), F.max(part).alias("hi"))
    return max((max(r.hi * r["all"] - 1, 1 - r.lo * r["all"]) for r in ends.collect() if r["all"]), default=0.0)  # a row per axis


def rake(cells: DataFrame, temper: dict[str, float], targets: dict[str, DataFrame] | None = None, sweeps: int | None = None, share: float | None = None) -> DataFrame:
    """Raked weights ``w`` of cells ``(source, lang, topic, n)``.

    ``targets`` maps an axis to its ``(value, target)`` shares; axes without one take
    the tempered corpus shares.  Cells without tokens keep weight 0.  With ``share``
    no weight is over ``n`` and all sum to that share of the tokens; a value whose
    target is over its tokens gets all of them, the others share the rest.

    ``sweeps`` fixes their number; else they go on until the marginals are met to
    ``TOLERANCE``.  Targets that no weights meet end with a warning of what is left.
    """
    targets = targets or {}
    out = cells.withColumn("w", F.col("n").cast("double"))
    for axis, power in temper.items():
        if axis in targets:
            t = targets[axis].select(F.col("value").alias("_v"), F.col("target").cast("double").alias(f"_t_{axis}"))
            out = out.join(t, F.col(axis).eqNullSafe(F.col("_v")), "left").drop("_v").na.fill(0.0, [f"_t_{axis}"])
        else:  # targets need no common total: a factor over all cells cancels in the probabilities
            m = F.sum("n").over(Window.partitionBy(axis))
            out = out.withColumn("_m", m).withColumn(f"_t_{axis}", F.when(F.col("_m") > 0, F.pow("_m", F.lit(power))).otherwise(0.0)).drop("_m")
    if share is not None:
        out = cut_lineage(out)
        for axis, scale in _scales(out, list(temper), share).items():
            out = out.withColumn(f"_t_{axis}", F.least(F.col(f"_t_{axis}") * scale, F.sum("n").over(Window.partitionBy(axis)).cast("double")))
    bounded, sweep, errors = share is not None, 0, []
    while sweep < (SWEEPS if sweeps is None else sweeps):
        if sweep and sweep % (2 if bounded else 10) == 0:  # plans stay short (bounded steps are longer)
            out = cut_lineage(out)
        for axis in temper:
            out = _raked(out, axis, bounded)
        sweep += 1
    while sweeps is None:
        out = cut_lineage(out)
        errors.append(marginal_error(out, list(temper), bounded))
        if errors[-1] <= TOLERANCE:
            break
        ago = PATIENCE // SWEEPS
        if len(errors) > ago and errors[-1] > 0.99 * errors[-1 - ago]:
            log.warning("mixing targets not met after %d sweeps: largest marginal error %.3g of its target", sweep, errors[-1])
            break
        for k in range(SWEEPS):
            if k and bounded and k % 2 == 0:
                out = cut_lineage(out)
            for axis in temper:
                out = _raked(out, axis, bounded)
        sweep += SWEEPS
    if bounded:
        out = out.withColumn("w", F.least("w", F.col("n").cast("double")))
    return out.select(*temper, "n", "w")


def mix(docs: DataFrame, topic: Column | None = None, temper: dict[str, float] | None = None, targets: dict[str, DataFrame] | None = None, share: float | None = SHARE) -> DataFrame:
    """``docs`` with ``_topic, _tokens, _probability, _kept`` added.

    Kept tokens are ``share`` of all in expectation; None: the largest probability of
    a cell with tokens is 1.
    A null source, language or topic is a value of its own.  Null text: empty, 0
    tokens.  A cell without tokens has probability 1 (its documents weigh nothing).
    Repeated rows share one decision.  An empty table gives an empty result; columns
    of ``docs`` other than doc_id, text, source and lang pass through.
    """
    temper = temper or TEMPER
    text = text_of(docs)
    rows = docs.withColumn("_topic", topic if topic is not None else structural_topic(text)).withColumn("_tokens", word_tokens(text))
    cells = rows.groupBy("source", "lang", F.col("_topic").alias("topic")).agg(F.sum("_tokens").alias("n"))
    # Two tables of a row per cell: their stored size lets the planner broadcast them only when small.
    ratio = F.when(F.col("n") > 0, F.col("w") / F.col("n"))
    raked = cut_lineage(rake(cut_lineage(cells), temper, targets, share=share).withColumn("ratio", ratio))
    top = 1.0 if share is not None else raked.agg(F.max("ratio")).first()[0] or 1.0
    rates = raked.select(*[F.col(c).alias(f"_c_{c}") for c in temper], F.coalesce(F.col("ratio") / F.lit(top), F.lit(1.0)).alias("_probability"))
    same = rows["source"].eqNullSafe(F.col("_c_source")) & rows["lang"].eqNullSafe(F.col("_c_lang")) & rows["_topic"].eqNullSafe(F.col("_c_topic"))
    joined = rows.join(rates, same).drop("_c_source", "_c_lang", "_c_topic")
    return joined.withColumn("_kept", uniform(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit(""))) < F.col("_probability"))


def oracle_sql() -> str:
    """The rows without a share in SQL (``SWEEPS`` sweeps unrolled: the same where those meet the tolerance, as on all test tables)."""
    steps = []
    for axis, power in TEMPER.items():
        steps.append(f"t_{axis} AS (SELECT {axis}, pow(sum(n), {power}) AS t FROM cells GROUP BY {axis} HAVING sum(n) > 0)")
    steps.append("r0 AS (SELECT *, n::DOUBLE AS w FROM cells)")
    k = 0
    for _ in range(SWEEPS):
        for axis in TEMPER:
            steps.append(
                f"r{k + 1} AS (SELECT r.source, r.lang, r.topic, r.n, coalesce(r.w * t.t / nullif(sum(r.w) OVER (PARTITION BY r.{axis}), 0), 0) AS w "
                f"FROM r{k} r LEFT JOIN t_{axis} t ON r.{axis} IS NOT DISTINCT FROM t.{axis})"
            )
            k += 1
    body = ",\n".join(steps)
    return f"""
WITH d AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS text,
    CASE WHEN trim(coalesce(text, '')) = '' THEN 'empty'
      WHEN contains(text, '@') OR contains(text, 'http') THEN 'reference'
      WHEN contains(text, 'icense') THEN 'licensed'
      WHEN contains(text, '|') THEN 'table'
      WHEN contains(text, '***') OR contains(text, '!!') THEN 'noise'
      ELSE 'prose' END AS topic,
    CASE WHEN coalesce(text, '') = '' THEN 0
      ELSE length(text) - length(replace(replace(replace(text, ' ', ''), chr(10), ''), chr(9), '')) + 1 END AS tokens
  FROM documents),
cells AS (SELECT source, lang, topic, sum(tokens)::BIGINT AS n FROM d GROUP BY ALL),
{body},
rates AS (SELECT source, lang, topic, coalesce((w / nullif(n, 0)) / (SELECT max(w / n) FROM r{k} WHERE n > 0), 1.0) AS p FROM r{k})
SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens::BIGINT AS tokens, round(p, 9) AS probability,
  ('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, d.text)), 1, 12))::BIGINT / {_SCALE} < p AS kept
FROM d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source AND d.lang IS NOT DISTINCT FROM r.lang AND d.topic = r.topic
"""
