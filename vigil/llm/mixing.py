"""Mixing documents to target weights, with DataFrame functions only.

Documents are summed into cells (one per source, language and topic).  A token
budget is spread over each dimension's values by their target shares; a value
that has fewer tokens than its part gives all it has, and the rest goes to the others.
These are the marginals that the cells are raked to (iterative proportional fitting): a cell
keeps the part min(1, f_source f_lang f_topic) of its tokens, and the factors of one
dimension after the other are set so that its marginals hold, with the cells that
already give all they have taken out of the sum.  So caps are part of the raking, not an
afterthought.  Rounds go on until no marginal is off by more than ``tolerance`` of the
budget, or until they no longer come nearer: then the cells contradict the targets,
and ``marginals`` shows target against expected result.
Each document is kept with its cell's probability, decided by a hash of its id,
so a decision never depends on partitions, order or retries.

Only the cells are raked, never the documents: their number is that of
the combinations, and a source with a third of all rows is summed by partial
aggregates.  Up to ``CELLS`` cells are raked by windows in one partition; more by aggregates
per value, joined back, so no task needs all cells.

Defined cases: null dimensions are the value ``unknown``; a null or empty text
weighs one token; a value with target 0, or not in its table of targets, gets nothing; rows
without an id are decided by their text; repeated rows share one decision; an empty
table gives an empty result; other columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.spark import frozen, table

DIMENSIONS = ("source", "lang", "topic")
#: Target share of a value: its present share to this power, scaled to one.
TEMPER = 0.7
#: Part of all tokens to keep.
KEEP = 0.5
#: How far a marginal may be off, as a part of the budget.
TOLERANCE = 1e-12
#: Rounds between two tests of that.
ROUNDS = 4
#: The most cells that are raked in one partition, and that are broadcast.
CELLS = 100_000
_U = 2**52


def words(text: Column) -> Column:
    """Words of a text, one at least."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(1)).cast("long")


def form(text: Column) -> Column:
    """A topic from a text's form, for tables without topics."""
    t = F.coalesce(text, F.lit(""))
    n = F.char_length(t)
    return (
        F.when(t.contains("@"), "contact")
        .when(F.lower(t).contains("rights reserved"), "notice")
        .when(n < 500, "note")
        .when(n > 5000, "long")
        .otherwise("article")
    )


def chance(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that the id and seed decide."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit(""))))))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / F.lit(float(_U))


def tempered(cells: DataFrame, dimension: str, power: float = TEMPER) -> DataFrame:
    """``dimension, target``: present shares to a power, scaled to one."""
    shares = cells.groupBy(dimension).agg(F.sum("tokens").alias("_t"))
    whole = shares.agg(F.sum("_t")).head()[0] or 1
    raised = shares.withColumn("_p", F.pow(F.col("_t") / F.lit(float(whole)), F.lit(power)))
    total = raised.agg(F.sum("_p")).head()[0] or 1.0
    return raised.select(dimension, (F.col("_p") / F.lit(total)).alias("target"))


def _one(cells: DataFrame, small: bool) -> DataFrame:
    """Stored cells, few ones known to be in one partition, so that nothing on them shuffles."""
    out = frozen(cells)
    return out.coalesce(1) if small else out


def aims(cells: DataFrame, dimension: str, target: DataFrame, budget: float, small: bool) -> DataFrame:
    """``dimension, aim``: the budget by target share, no value aimed at more than it has.

    The common scale rises while values run out; each step takes those out and spreads the
    rest, so it ends after as many steps as there are values that run out one by one.
    """
    have = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("_have"))
    have = _one(have.join(F.broadcast(target) if small else target, dimension, "left").fillna(0.0, ["target"]), small)
    part = lambda scale: F.col("target") * F.lit(scale)
    scale = 0.0
    while True:
        full = part(scale) >= F.col("_have")
        row = have.agg(F.sum(F.when(full, F.col("_have"))).alias("full"), F.sum(F.when(~full, F.col("target"))).alias("free")).head()
        if not row["free"]:
            break
        new = (budget - (row["full"] or 0.0)) / row["free"]
        if new <= scale * (1 + 1e-15):
            break
        scale = new
    return have.select(dimension, F.least("_have", part(scale)).alias(f"aim_{dimension}"))


def _fitted(cells: DataFrame, dimension: str, dimensions: Sequence[str], small: bool) -> DataFrame:
    """``cells`` with the factors of ``dimension`` set to meet its aims."""
    others = F.lit(1.0)
    for d in dimensions:
        if d != dimension:
            others = others * F.col(f"f_{d}")
    own, aim = F.col(f"f_{dimension}"), F.col(f"aim_{dimension}")
    told = cells.withColumn("_r", others).withColumn("_x", own * F.col("_r"))
    sums = {
        "_full": F.sum(F.when(F.col("_x") >= 1, F.col("tokens")).otherwise(F.lit(0.0))),
        "_rest": F.sum(F.when(F.col("_x") < 1, F.col("tokens") * F.col("_r")).otherwise(F.lit(0.0))),
        "_got": F.sum(F.least(F.lit(1.0), F.col("_x")) * F.col("tokens")),
    }
    if small:
        told = told.withColumns({n: c.over(Window.partitionBy(dimension)) for n, c in sums.items()})
    else:
        told = told.join(told.groupBy(dimension).agg(*[c.alias(n) for n, c in sums.items()]), dimension)
    factor = (
        F.when(aim <= 0, F.lit(0.0))
        .when((F.col("_rest") > 0) & (aim > F.col("_full")), (aim - F.col("_full")) / F.nullif("_rest", F.lit(0.0)))
        .when(F.col("_got") > 0, own * aim / F.nullif("_got", F.lit(0.0)))
        .otherwise(own)
    )
    return told.withColumn(f"f_{dimension}", factor).drop("_r", "_x", *sums)


def probability(dimensions: Sequence[str]) -> Column:
    out = F.lit(1.0)
    for d in dimensions:
        out = out * F.col(f"f_{d}")
    return F.least(F.lit(1.0), out)


def marginals(cells: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """``dimension, value, aim, expected``: tokens aimed at and tokens that the probabilities give."""
    parts = [
        cells.groupBy(F.lit(d).alias("dimension"), F.col(d).alias("value")).agg(
            F.max(f"aim_{d}").alias("aim"), F.sum(probability(dimensions) * F.col("tokens")).alias("expected")
        )
        for d in dimensions
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rake(cells: DataFrame, dimensions: Sequence[str], budget: float, n_cells: int, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (with ``aim_<dimension>``) with factors ``f_<dimension>`` that meet the aims."""
    small = n_cells <= CELLS
    whole = cells.agg(F.sum("tokens")).head()[0] or 1
    begin = (budget / whole) ** (1 / len(dimensions))
    out = cells.withColumns({f"f_{d}": F.lit(begin) for d in dimensions})
    before = float("inf")
    while True:
        for _ in range(ROUNDS):
            for d in dimensions:
                out = _fitted(out, d, dimensions, small)
                if not small:
                    out = frozen(out)
        out = _one(out, small)
        off = marginals(out, dimensions).agg(F.max(F.abs(F.col("expected") - F.col("aim")))).head()[0] or 0.0
        if off <= tolerance * budget or off >= before * 0.999:
            return out
        before = off


def mix(
    docs: DataFrame,
    dimensions: Mapping[str, Column],
    tokens: Column,
    doc_id: Column,
    text: Column,
    targets: Mapping[str, DataFrame] | None = None,
    keep: float = KEEP,
    tolerance: float = TOLERANCE,
    seed: str = "mix",
) -> DataFrame:
    """``row`` (a struct of all columns), the dimensions, ``tokens`` and
    ``probability`` of the documents that are kept.

    ``targets`` may give ``<dimension>, target`` tables; a value that is not in
    its table gets nothing.
    """
    names = list(dimensions)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        *[F.coalesce(c.cast("string"), F.lit("unknown")).alias(d) for d, c in dimensions.items()],
        tokens.alias("tokens"),
        chance(doc_id, text, seed).alias("_u"),
    )
    raked, n = raked_cells(rows, names, targets, keep, tolerance)
    found = raked.select(*names, probability(names).alias("probability"))
    if n <= CELLS:
        found = F.broadcast(found)
    return rows.join(found, names).where(F.col("_u") < F.col("probability")).select("row", *names, "tokens", "probability")


def raked_cells(
    rows: DataFrame, names: Sequence[str], targets: Mapping[str, DataFrame] | None = None, keep: float = KEEP, tolerance: float = TOLERANCE
) -> tuple[DataFrame, int]:
    """(cells with aims and factors, how many) of ``rows`` (the dimensions, ``tokens``)."""
    cells = frozen(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")))
    size = cells.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).head()
    n, budget = size["n"], float(size["t"]) * keep
    small = n <= CELLS
    cells = cells.coalesce(1) if small else cells
    aimed = cells
    for d in names:
        target = (targets or {}).get(d) or tempered(cells, d)
        aim = aims(cells, d, target.select(d, F.col("target").cast("double").alias("target")), budget, small)
        aimed = aimed.join(F.broadcast(aim) if small else aim, d)
    return rake(_one(aimed, small), names, budget, n, tolerance), n


def mix_documents(docs: DataFrame, keep: float = KEEP, seed: str = "mix", tolerance: float = TOLERANCE) -> DataFrame:
    """``mix`` for tables like ``documents``.

    These tables have no topic and no token column: topics come from the texts' form (``form``)
    and a token is a word (``words``).
    """
    return mix(
        docs,
        {"source": F.col("source"), "lang": F.col("lang"), "topic": form(F.col("text"))},
        words(F.col("text")),
        F.col("doc_id"),
        F.col("text"),
        keep=keep,
        tolerance=tolerance,
        seed=seed,
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents kept at half of all tokens, to tempered source, language and topic shares."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mix_documents(docs).select(
        "row.doc_id", "source", "lang", "topic", F.col("tokens").alias("n_words"), F.round("probability", 6).alias("probability")
    )


#: Rounds that the SQL goes through without a test: beyond double precision on such tables.
_SQL_ROUNDS = 20


def _sql() -> str:
    steps = []
    last = "aimed"
    for r in range(_SQL_ROUNDS):
        for d in DIMENSIONS:
            name, others = f"r{r}_{d}", " * ".join(f"f_{o}" for o in DIMENSIONS if o != d)
            steps.append(
                f"""{name} AS MATERIALIZED (SELECT * EXCLUDE (r, sat, rest, got) REPLACE (CASE WHEN aim_{d} <= 0 THEN 0
                WHEN rest > 0 AND aim_{d} > sat THEN (aim_{d} - sat) / rest WHEN got > 0 THEN f_{d} * aim_{d} / got ELSE f_{d} END AS f_{d}) FROM (
                SELECT *, sum(CASE WHEN f_{d} * r >= 1 THEN tokens ELSE 0 END) OVER w AS sat,
                  sum(CASE WHEN f_{d} * r < 1 THEN tokens * r ELSE 0 END) OVER w AS rest, sum(least(1, f_{d} * r) * tokens) OVER w AS got
                FROM (SELECT *, {others} AS r FROM {last}) WINDOW w AS (PARTITION BY {d})))"""
            )
            last = name
    targets = ", ".join(
        f"""p_{d} AS MATERIALIZED (SELECT {d}, t, pow(t / sum(t) OVER (), {TEMPER}) AS p FROM
            (SELECT {d}, CAST(sum(tokens) AS DOUBLE) AS t FROM cells GROUP BY {d})),
        s_{d} AS MATERIALIZED (SELECT *, p / sum(p) OVER () AS target FROM p_{d}),
        o_{d} AS MATERIALIZED (SELECT *, t / target AS ratio, ((SELECT b FROM budget) - coalesce(sum(t) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(target) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale FROM s_{d} WINDOW w AS (ORDER BY t / target, {d})),
        t_{d} AS MATERIALIZED (SELECT {d}, least(t, target * (SELECT arg_min(scale, ratio) FROM o_{d} WHERE scale <= ratio)) AS aim_{d} FROM o_{d})"""
        for d in DIMENSIONS
    )
    return f"""
WITH rows_ AS MATERIALIZED (
  SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang,
    CASE WHEN contains(t, '@') THEN 'contact' WHEN contains(lower(t), 'rights reserved') THEN 'notice'
         WHEN length(t) < 500 THEN 'note' WHEN length(t) > 5000 THEN 'long' ELSE 'article' END AS topic,
    greatest(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')), 1) AS tokens,
    CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(t))), 1, 13) AS UBIGINT) AS DOUBLE) / {float(_U)} AS u
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM rows_ GROUP BY ALL),
budget AS MATERIALIZED (SELECT sum(tokens) * {KEEP} AS b FROM cells),
{targets},
aimed AS MATERIALIZED (SELECT source, lang, topic, CAST(tokens AS DOUBLE) AS tokens, aim_source, aim_lang, aim_topic,
    {", ".join(f"pow({KEEP}, 1 / 3.0::DOUBLE) AS f_{d}" for d in DIMENSIONS)}
  FROM cells JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic)),
{", ".join(steps)},
chances AS MATERIALIZED (SELECT source, lang, topic, least(1.0, f_source * f_lang * f_topic) AS probability FROM {last})
SELECT doc_id, source, lang, topic, CAST(rows_.tokens AS BIGINT) AS n_words, round(probability, 6) AS probability
FROM rows_ JOIN chances USING (source, lang, topic) WHERE u < probability
"""


SQL = _sql()
