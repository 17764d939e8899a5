"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations alone.

The token weights of the cells of (source, language, topic) are raked in turn to the target
shares of sources, languages and topics until all three hold. A document is then sampled
with the probability that brings its cell from its share of the corpus to the fitted one.

A cell can't give more than all its documents, so its weight has a bound: its share of the
corpus over the share of all tokens that is kept. What bounded cells can't give, the other
cells of the category do; and what a category can't give of its target, the other categories
do in proportion to theirs. While the marginals don't fit, the kept share is lowered. So no
probability is ever cut, and the expected shares of the sample are the fitted ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed

#: Share of all tokens to keep at most, the part of a category's tokens that may be asked for,
#: and rounds in which targets beyond that are shared out (each round finds more such categories).
KEEP, SCARCE, FILLS = 0.6, 0.9, 20
#: Rounds of raking between two looks at the marginals, looks, the gap that ends it, and what
#: the kept share is multiplied by after a look that finds a larger one.
ROUNDS, LOOKS, TOLERANCE, LOWER = 10, 4, 1e-4, 0.8
#: Cells up to which the raking, which is over cells and not rows, takes place in one partition,
#: and its result is broadcast. It changes the plan only.
ONE_PLACE = 100_000

# The topic of a text is the first whose mark it has; targets are relative weights.
MARKS = (("table", " | "), ("licence", "icense"), ("contact", "@"))
OTHER = "prose"
LANGS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
TOPICS = {"prose": 0.85, "licence": 0.05, "contact": 0.08, "table": 0.02}
#: Sources aim at shares in proportion to this power of their tokens.
SOURCE_POWER = 0.5
#: Weight of a language or topic that has no target.
UNNAMED = 0.01

TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def tokens(text: Column) -> Column:
    """Runs of letters and digits, and single other marks."""
    return F.regexp_count(text, F.lit(TOKEN))


def topic(text: Column) -> Column:
    out = F.lit(OTHER)
    for name, mark in reversed(MARKS):
        out = F.when(text.contains(mark), F.lit(name)).otherwise(out)
    return out


def _target(name: str, weights: Mapping[str, float]) -> Column:
    out = F.lit(UNNAMED)
    for value, weight in weights.items():
        out = F.when(F.col(name) == value, F.lit(float(weight))).otherwise(out)
    return out


def celled(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the cell columns s, l, t; null sources and languages count as "none"."""
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"__s": none("source"), "__l": none("lang"), "__t": topic(body)})


def filled(sides: DataFrame, keep: float) -> DataFrame:
    """Adds g to the categories of one margin (have, asked): their targets within what they have.

    It is the target asked for times one factor for all, but no more than the category can
    give; the factor is raised until the sum is one. Only sums reach the driver.
    """
    cap = F.col("have") * F.lit(max(1.0, SCARCE / keep))
    factor, before = 1.0, -1
    for _ in range(FILLS):
        over = F.lit(factor) * F.col("asked") >= cap
        row = sides.agg(F.count_if(over).alias("n"), F.sum(F.when(over, cap).otherwise(0.0)).alias("full"), F.sum(F.when(over, 0.0).otherwise(F.col("asked"))).alias("free")).first()
        if row["n"] == before or not row["free"]:
            break
        before, factor = row["n"], (1.0 - row["full"]) / row["free"]
    return sides.withColumn("g", F.least(cap, F.lit(factor) * F.col("asked")))


def aimed(cells: DataFrame, keep: float) -> DataFrame:
    """cells with share, shares asked for as, al, at, target shares gs, gl, gt and weight w to begin with.

    Shares asked for are scaled to a sum of one over the categories that occur.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    cells = cells.withColumn("share", F.col("tokens") / F.lit(float(max(1, total))))
    for c in "slt":
        sides = cells.groupBy(c).agg(F.sum("share").alias("have"))
        raw = F.pow("have", F.lit(SOURCE_POWER)) if c == "s" else _target(c, LANGS if c == "l" else TOPICS)
        sides = checkpointed(sides.where("have > 0").withColumn("raw", raw))
        whole = sides.agg(F.sum("raw")).first()[0] or 1.0
        sides = filled(sides.withColumn("asked", F.col("raw") / F.lit(whole)), keep)
        cells = cells.join(sides.select(c, F.col("asked").alias(f"a{c}"), F.col("g").alias(f"g{c}")), c, "left").fillna(0.0, [f"a{c}", f"g{c}"])
    return checkpointed(cells.withColumn("w", F.col("share")))


def rounds(cells: DataFrame, kept: float, n: int = ROUNDS) -> DataFrame:
    """w of aimed() after n rounds: in turn each category is scaled to its target, no cell over its bound."""
    bound = F.col("share") / F.lit(kept)
    for _ in range(n):
        for c in "slt":
            over, target = Window.partitionBy(c), F.col(f"g{c}")
            cells = cells.withColumns({"have": F.sum("w").over(over), "full": F.sum(F.when(F.col("w") >= bound, F.col("w")).otherwise(0.0)).over(over)})
            free = F.col("have") - F.col("full")
            scaled = (
                F.when(F.col("have") >= target, F.when(F.col("have") > 0, F.col("w") * target / F.col("have")).otherwise(0.0))
                .when((F.col("w") >= bound) | (free <= 0), F.col("w"))
                .otherwise(F.col("w") * (target - F.col("full")) / free)
            )
            cells = cells.withColumn("w", F.least(bound, scaled)).drop("have", "full")
    return cells


def gap(cells: DataFrame) -> float:
    """The largest difference of a category's weight from its target."""
    away = [F.abs(F.sum("w").over(Window.partitionBy(c)) - F.col(f"g{c}")) for c in "slt"]
    return cells.select(F.greatest(*away).alias("away")).agg(F.max("away")).first()[0] or 0.0


def raked(cells: DataFrame, keep: float = KEEP) -> tuple[DataFrame, float]:
    """aimed() with the fitted weights, and the share of all tokens that is kept."""
    cells, kept = aimed(cells, keep), keep
    for look in range(LOOKS):
        cells = checkpointed(rounds(cells, kept))
        if gap(cells) <= TOLERANCE:
            break
        kept *= LOWER if look + 1 < LOOKS else 1.0
    return cells, kept


def cell_probabilities(docs: DataFrame, text: str = "text", keep: float = KEEP) -> DataFrame:
    """s, l, t, tokens, share, shares asked for, target shares, fitted, probability of each cell; only cells are raked, after a sum over all rows."""
    body = F.coalesce(F.col(text), F.lit(""))
    cells = celled(docs, text).groupBy(F.col("__s").alias("s"), F.col("__l").alias("l"), F.col("__t").alias("t"))
    cells = checkpointed(cells.agg(F.sum(tokens(body)).cast("long").alias("tokens")))
    if cells.count() <= ONE_PLACE:
        cells = cells.coalesce(1)
    fitted, kept = raked(cells, keep)
    p = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.lit(kept) * F.col("w") / F.col("share"))).otherwise(F.lit(1.0))
    return fitted.select("s", "l", "t", "tokens", "share", "as", "al", "at", "gs", "gl", "gt", F.col("w").alias("fitted"), p.alias("probability"))


def marginals(cells: DataFrame) -> DataFrame:
    """margin, category, share of the corpus, share asked for, target, fitted and expected share of the sample, of cell_probabilities()."""
    out = None
    for c, margin in (("s", "source"), ("l", "lang"), ("t", "topic")):
        given = F.sum(F.col("share") * F.col("probability"))
        one = cells.groupBy(F.col(c).alias("category")).agg(F.sum("share").alias("share"), F.max(f"a{c}").alias("asked"), F.max(f"g{c}").alias("target"), F.sum("fitted").alias("fitted"), given.alias("given"))
        one = one.withColumn("expected", F.try_divide("given", F.sum("given").over(Window.partitionBy(F.lit(c))))).drop("given")
        one = one.select(F.lit(margin).alias("margin"), "category", "share", "asked", "target", "fitted", "expected")
        out = one if out is None else out.unionByName(one)
    return out


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the md5 of the key as text."""
    hexed = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("none"))), 1, 8)
    return F.conv(hexed, 16, 10).cast("double") / F.lit(4294967296.0)


def _drawn(docs: DataFrame, text: str, key: str, keep: float) -> DataFrame:
    cells = checkpointed(cell_probabilities(docs, text, keep))
    if cells.count() <= ONE_PLACE:  # so the documents aren't shuffled
        cells = F.broadcast(cells)
    joined = celled(docs, text).join(cells, (F.col("__s") == cells.s) & (F.col("__l") == cells.l) & (F.col("__t") == cells.t))
    return joined.withColumn("__drawn", uniform(F.col(key)) < F.col("probability"))


def mixed(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: float = KEEP) -> DataFrame:
    """Each document's cell, its shares and the draw.

    Returns key, source, lang, topic string, share, fitted, probability double (rounded to 6),
    sampled boolean. The draw depends on the key alone, so equal keys share their fate where
    their cells agree. Null sources and languages are a category "none"; null texts count as
    empty; cells without any token are kept. An empty table gives an empty one. Targets
    that the corpus can't fill in any proportion leave a gap, which marginals() shows.
    Other columns aren't read.
    """
    rows = _drawn(docs.select(key, text, "source", "lang"), text, key, keep)
    return rows.select(
        key, F.col("__s").alias("source"), F.col("__l").alias("lang"), F.col("__t").alias("topic"),
        *[F.round(c, 6).alias(c) for c in ("share", "fitted", "probability")],
        F.col("__drawn").alias("sampled"),
    )


def draw(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: float = KEEP) -> DataFrame:
    """The sampled documents, with all their columns."""
    names = docs.columns
    rows = _drawn(docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumnsRenamed({f"c{names.index(n)}": n for n in (key, text, "source", "lang")}), text, key, keep)
    inner = [n if n in (key, text, "source", "lang") else f"c{i}" for i, n in enumerate(names)]
    return rows.where("__drawn").select(*[F.col(i).alias(n) for i, n in zip(inner, names, strict=True)])


def oracle(table: str = "documents", keep: float = KEEP) -> str:
    """The SQL of mixed() over a table."""
    marks = " ".join(f"WHEN contains(body, '{mark}') THEN '{name}'" for name, mark in MARKS)
    case = lambda c, w: f"CASE {' '.join(f"WHEN {c} = '{k}' THEN {v}::DOUBLE" for k, v in w.items())} ELSE {UNNAMED}::DOUBLE END"
    raws = {"s": f"pow(have, {SOURCE_POWER}::DOUBLE)", "l": case("l", LANGS), "t": case("t", TOPICS)}
    parts = []
    for c, raw in raws.items():
        parts.append(
            f"ask_{c} AS MATERIALIZED (SELECT {c}, have * {max(1.0, SCARCE / keep)}::DOUBLE AS cap, raw / sum(raw) OVER () AS asked "
            f"FROM (SELECT {c}, have, {raw} AS raw FROM (SELECT {c}, sum(share) AS have FROM shared GROUP BY {c}) WHERE have > 0))"
        )
        parts.append(f"x_{c}0 AS (SELECT 1.0::DOUBLE AS x)")
        for i in range(1, FILLS + 1):
            free = "sum(CASE WHEN x * asked >= cap THEN 0 ELSE asked END)"
            parts.append(
                f"x_{c}{i} AS MATERIALIZED (SELECT coalesce(CASE WHEN {free} > 0 THEN (1 - sum(CASE WHEN x * asked >= cap THEN cap ELSE 0 END)) / {free} ELSE max(x) END, 1) AS x FROM ask_{c}, x_{c}{i - 1})"
            )
        parts.append(f"side_{c} AS (SELECT {c}, least(cap, x * asked) AS g{c} FROM ask_{c}, x_{c}{FILLS})")
    sides = ", ".join(parts)
    steps, at = [], "f0"
    for look in range(LOOKS):
        for i in range(ROUNDS):
            for c in "slt":
                now = f"f{look}_{i}{c}"
                steps.append(f"""{now} AS (SELECT * EXCLUDE (have, full_) REPLACE (CASE WHEN done THEN w ELSE least(share / kept,
  CASE WHEN have >= g{c} THEN CASE WHEN have > 0 THEN w * g{c} / have ELSE 0 END WHEN w >= share / kept OR have - full_ <= 0 THEN w ELSE w * (g{c} - full_) / (have - full_) END) END AS w)
  FROM (SELECT *, sum(w) OVER (PARTITION BY {c}) AS have, sum(CASE WHEN w >= share / kept THEN w ELSE 0 END) OVER (PARTITION BY {c}) AS full_ FROM {at}))""")
                at = now
        if look + 1 < LOOKS:
            away = ", ".join(f"abs(sum(w) OVER (PARTITION BY {c}) - g{c})" for c in "slt")
            steps.append(f"a{look} AS (SELECT *, greatest({away}) AS away FROM {at})")
            steps.append(f"""b{look} AS MATERIALIZED (SELECT * EXCLUDE (away, most) REPLACE (most <= {TOLERANCE}::DOUBLE AS done, CASE WHEN most <= {TOLERANCE}::DOUBLE THEN kept ELSE kept * {LOWER}::DOUBLE END AS kept)
  FROM (SELECT *, max(away) OVER () AS most FROM a{look}))""")
            at = f"b{look}"
    return f"""
WITH body AS (
  SELECT doc_id, coalesce(source, 'none') AS s, coalesce(lang, 'none') AS l, coalesce(text, '') AS body FROM {table}
), rows AS (
  SELECT doc_id, s, l, CASE {marks} ELSE '{OTHER}' END AS t, len(regexp_extract_all(body, '[\\p{{L}}\\p{{N}}]+|[^\\s\\p{{L}}\\p{{N}}]')) AS n FROM body
), cells AS (
  SELECT s, l, t, sum(n)::BIGINT AS tokens FROM rows GROUP BY ALL
), shared AS (
  SELECT *, tokens::DOUBLE / greatest(1, sum(tokens) OVER ())::DOUBLE AS share FROM cells
), {sides}, f0 AS (
  SELECT s, l, t, tokens, share, coalesce(gs, 0) AS gs, coalesce(gl, 0) AS gl, coalesce(gt, 0) AS gt, share AS w, {keep}::DOUBLE AS kept, false AS done
  FROM shared LEFT JOIN side_s USING (s) LEFT JOIN side_l USING (l) LEFT JOIN side_t USING (t)
), {", ".join(steps)}, fit AS (
  SELECT s, l, t, share, w AS fitted, CASE WHEN tokens > 0 THEN least(1.0::DOUBLE, kept * w / share) ELSE 1.0::DOUBLE END AS probability
  FROM {at}
)
SELECT doc_id, s AS source, l AS lang, t AS topic, round(share, 6) AS share, round(fitted, 6) AS fitted, round(probability, 6) AS probability,
       CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'none')), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE < probability AS sampled
FROM rows JOIN fit USING (s, l, t)
"""
