"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic). Cell weights are raked
in turn to the goals of sources, languages and topics, until every category
is within ``TOLERANCE`` of its goal. A document cannot be taken more than
once, so a cell gives at most its tokens: the rake counts a cell that reaches
its own size at that size, and fits the others of the category to what is left
of the goal. Goals are the target shares of the budget; a category that holds
fewer tokens than its target asks for is kept whole (``reachable`` false in
``report``), and the others share what it leaves in proportion. The fitted
weights over the cells' tokens are the sampling probabilities. A coin from a
hash of the id decides, so reruns agree.

All of it is DataFrame functions. The cell table grows with the number of
sources, languages and topics, not with documents; sums over a source that
holds a third of all rows are pre-aggregated before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.storage import written

DIMENSIONS = ("source", "lang", "topic")
#: A float tempers the natural shares (share ** value); a dict names shares, and categories it lacks keep their natural share.
TARGETS = {"source": 0.7, "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
           "topic": {"licensed": 0.05, "contact": 0.10, "table": 0.05, "prose": 0.80}}
#: Topics by the first marker found in the text; without any, the last.
TOPICS = (("licensed", "icensed under"), ("contact", "@"), ("table", " | "))
OTHER_TOPIC = "prose"
NO_VALUE = "(null)"
KEEP_SHARE = 0.5
#: Raking ends when no category is farther from its goal than this share of the budget, or after so many rounds.
TOLERANCE, ROUNDS = 0.001, 50


def topic_of(text: Column) -> Column:
    found = F.lit(OTHER_TOPIC)
    for name, marker in reversed(TOPICS):
        found = F.when(F.contains(F.coalesce(text, F.lit("")), F.lit(marker)), name).otherwise(found)
    return found


def calibrated(weights: DataFrame, budget: float) -> DataFrame:
    """``weights`` (``tokens``, ``weight``) with ``expected``: min(tokens, s *
    weight), s such that they sum to ``budget`` (or to all there is). Rows that
    reach their tokens are set aside until no other does; each pass sets aside
    at least one more."""
    ratio = F.col("weight") / F.col("tokens")
    capped, s = -1, None
    while True:
        full = F.lit(False) if s is None else (ratio * F.lit(s) >= 1)
        row = weights.agg(
            F.sum(F.when(full, 1).otherwise(0)).alias("n"), F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("set_aside"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()  # one row
        if row["n"] is None or row["n"] <= capped or not row["open"]:
            break
        capped, s = row["n"], max(budget - row["set_aside"], 0.0) / row["open"]
    return weights.withColumn("expected", F.least(F.col("tokens").cast("double"), F.col("weight") * F.lit(s if s is not None else 1.0)))


def goals(cells: DataFrame, targets: dict, budget: float) -> dict[str, DataFrame]:
    """Per dimension: category, ``tokens``, ``asked`` (the target's share of
    the categories that occur) and ``goal`` (tokens to take)."""
    out = {}
    for name, target in targets.items():
        held = written(cells.groupBy(name).agg(F.sum("tokens").alias("tokens")), "categories")
        total = F.broadcast(held.agg(F.sum("tokens").alias("_all")))
        share = held.join(total).select(name, "tokens", (F.col("tokens") / F.col("_all")).alias("_share"))
        if isinstance(target, dict):
            named = F.lit(None).cast("double")
            for category, goal in target.items():
                named = F.when(F.col(name) == category, F.lit(float(goal))).otherwise(named)
            goal = F.coalesce(named, F.col("_share"))
        else:
            goal = F.pow("_share", F.lit(float(target)))
        share = share.withColumn("_g", goal)
        of = F.broadcast(share.agg(F.sum("_g").alias("_of")))
        asked = written(share.join(of).select(name, "tokens", (F.col("_g") / F.col("_of")).alias("weight")), "asked")
        out[name] = written(calibrated(asked, budget).select(
            name, "tokens", F.col("weight").alias("asked"), F.col("expected").alias("goal")), "goals")
    return out


def fitted(cells: DataFrame, aims: dict[str, DataFrame], budget: float, keep_share: float = KEEP_SHARE,
           rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (the dimensions and ``tokens`` > 0) with the raked ``weight``;
    ``aims``: see ``goals``. A cell gives min(tokens, weight).

    A round is one aggregation per dimension, cut by a written table; ``_off``
    is how far the categories were from their goals when it came to them.
    """
    full = F.col("weight") >= F.col("tokens")
    now = written(cells.withColumn("weight", F.col("tokens") * F.lit(keep_share)), "weights")
    for _ in range(rounds):
        step = now.withColumn("_off", F.lit(0.0))
        for name, aim in aims.items():
            sums = step.groupBy(name).agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("_full"),
                                          F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("_open"))
            whole = F.col("_full") + F.col("_open")
            factor = F.when((F.col("_open") > 0) & (F.col("goal") > F.col("_full")), (F.col("goal") - F.col("_full")) / F.col("_open")) \
                .when(F.col("goal") < whole, F.col("goal") / whole).otherwise(1.0)
            moves = sums.join(aim.select(name, "goal"), name).select(name, factor.alias("_factor"), F.abs(whole - F.col("goal")).alias("_gap"))
            step = step.join(moves, name).select(*cells.columns, (F.col("weight") * F.col("_factor")).alias("weight"),
                                                 F.greatest("_off", "_gap").alias("_off"))
        step = written(step, "weights")
        off = step.agg(F.max("_off").alias("off")).first()["off"]  # one number
        now = step.drop("_off")
        if off is None or off <= tolerance * budget:
            break
    return now


def _cells(rows: DataFrame) -> tuple[DataFrame, float]:
    cells = written(rows.groupBy(*DIMENSIONS).agg(F.sum("_n").alias("tokens")).where("tokens > 0"), "cells")
    return cells, float(cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"])  # one number


def _rates(rows: DataFrame, targets: dict, keep_share: float, rounds: int) -> tuple[DataFrame, dict[str, DataFrame], float]:
    """Cells with their ``probability``, the goals, and the budget in tokens."""
    cells, total = _cells(rows)
    budget = keep_share * total
    aims = goals(cells, targets, budget)
    weights = fitted(cells, aims, budget, keep_share, rounds)
    rates = weights.withColumn("probability", F.least(F.lit(1.0), F.col("weight") / F.col("tokens")))
    return written(rates.select(*DIMENSIONS, "tokens", "probability"), "rates"), aims, budget


def _rows(docs: DataFrame, id_col: str, text_col: str, topic: Column | None) -> DataFrame:
    text = F.col(text_col)
    # the row's own names stay inside a struct, apart from the working columns
    return docs.select(
        F.struct("*").alias("_row"), F.col(id_col).alias("_id"),
        F.coalesce(F.col("source").cast("string"), F.lit(NO_VALUE)).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_VALUE)).alias("lang"),
        (topic if topic is not None else topic_of(text)).alias("topic"),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("_n"))


def report(docs: DataFrame, targets: dict | None = None, keep_share: float = KEEP_SHARE, rounds: int = ROUNDS,
           id_col: str = "doc_id", text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """``dimension, category, tokens, asked_share, goal_share, expected_share,
    reachable``: per category the target's share of the budget, what it can
    have of it, and what the fitted probabilities are expected to take."""
    rates, aims, budget = _rates(_rows(docs, id_col, text_col, topic), targets or TARGETS, keep_share, rounds)
    out = None
    for name, aim in aims.items():
        taken = rates.groupBy(F.col(name).alias("_c")).agg(F.sum(F.col("probability") * F.col("tokens")).alias("_e"))
        one = aim.join(taken, aim[name] == taken["_c"]).select(
            F.lit(name).alias("dimension"), F.col(name).alias("category"), "tokens", F.col("asked").alias("asked_share"),
            (F.col("goal") / F.lit(budget)).alias("goal_share"), (F.col("_e") / F.lit(budget)).alias("expected_share"),
            (F.col("asked") * F.lit(budget) <= F.col("tokens")).alias("reachable"))
        out = one if out is None else out.unionByName(one)
    return out


def sampled(docs: DataFrame, targets: dict | None = None, keep_share: float = KEEP_SHARE, rounds: int = ROUNDS,
            id_col: str = "doc_id", text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """All columns of ``docs`` plus a struct ``mix``: ``topic, n_tokens,
    probability, kept``.

    A null source or language is a category of its own. Texts without words
    weigh nothing; they get the probability of their cell, or 1 in a cell
    without any token. Rows that repeat an id share its coin, and so do rows
    with a null id. Texts are counted whole. An empty table gives an empty
    result; a column of ``docs`` named ``mix`` is replaced.
    """
    rows = _rows(docs, id_col, text_col, topic)
    rates, _, _ = _rates(rows, targets or TARGETS, keep_share, rounds)
    rates = rates.select(*[F.col(k).alias(f"_mix_{k}") for k in DIMENSIONS], F.col("probability").alias("_mix_p"))
    joined = rows.join(rates, [F.col(k) == F.col(f"_mix_{k}") for k in DIMENSIONS], "left")
    coin = F.conv(F.substring(F.md5(F.coalesce(F.col("_id").cast("string"), F.lit(NO_VALUE)).cast("binary")), 1, 12), 16, 10)
    p = F.coalesce("_mix_p", F.lit(1.0))
    return joined.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c != "mix"], F.struct(
        "topic", F.col("_n").alias("n_tokens"), p.alias("probability"),
        (coin.cast("double") / F.lit(float(1 << 48)) < p).alias("kept")).alias("mix"))


def oracle_sql(targets: dict = TARGETS, keep_share: float = KEEP_SHARE, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> str:
    """The same fit in DuckDB SQL: windows over the cells instead of joins,
    goals from running sums over categories in order of what they ask for, and
    the rounds as a recursion."""
    topic = "CASE " + " ".join(f"WHEN contains(coalesce(text, ''), '{m}') THEN '{n}'" for n, m in TOPICS) + f" ELSE '{OTHER_TOPIC}' END"
    ctes = [f"""docs AS (SELECT doc_id, coalesce(source, '{NO_VALUE}') AS source, coalesce(lang, '{NO_VALUE}') AS lang,
        {topic} AS topic, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents)""",
            "cells AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM docs GROUP BY ALL HAVING sum(n_tokens) > 0)",
            f"budget AS (SELECT {keep_share} * sum(tokens) AS b FROM cells)"]
    for k in DIMENSIONS:
        goal = targets[k]
        if isinstance(goal, dict):
            case = f"CASE {k} " + " ".join(f"WHEN '{c}' THEN {float(v)!r}" for c, v in goal.items()) + " ELSE share END"
        else:
            case = f"pow(share, {float(goal)!r})"
        ctes.append(f"""asked_{k} AS (SELECT {k}, n, g / sum(g) OVER () AS g FROM (SELECT {k}, n, {case} AS g FROM (
            SELECT {k}, sum(tokens) AS n, sum(tokens) / (SELECT sum(tokens) FROM cells) AS share FROM cells GROUP BY {k})))""")
        ctes.append(f"""run_{k} AS (SELECT {k}, n, g, g / n AS r, coalesce(sum(n) OVER sooner, 0) AS aside, sum(g) OVER later AS open FROM asked_{k}
            WINDOW sooner AS (ORDER BY g / n DESC, {k} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   later AS (ORDER BY g / n DESC, {k} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""")
        ctes.append(f"""goal_{k} AS (SELECT {k}, least(n, coalesce(g * (SELECT max_by((b - aside) / open, r) FROM run_{k}, budget
            WHERE r * (b - aside) / open < 1), n)) AS goal_{k} FROM run_{k})""")

    def step(inner: str, k: str) -> str:
        sums = f"""SELECT *, sum(CASE WHEN w >= tokens THEN tokens ELSE 0 END) OVER (PARTITION BY {k}) AS f,
            sum(CASE WHEN w < tokens THEN w ELSE 0 END) OVER (PARTITION BY {k}) AS o FROM ({inner}) AS before_{k}"""
        return f"""SELECT t, source, lang, topic, tokens, goal_source, goal_lang, goal_topic,
            w * CASE WHEN o > 0 AND goal_{k} > f THEN (goal_{k} - f) / o WHEN goal_{k} < f + o THEN goal_{k} / (f + o) ELSE 1 END AS w,
            greatest(off, abs(f + o - goal_{k})) AS off FROM ({sums}) AS sums_{k}"""

    inner = "SELECT t + 1 AS t, source, lang, topic, tokens, goal_source, goal_lang, goal_topic, w, 0.0 AS off FROM going"
    for k in DIMENSIONS:
        inner = step(inner, k)
    ctes.append(f"""raked AS (
        SELECT 0 AS t, source, lang, topic, tokens, goal_source, goal_lang, goal_topic, tokens * {keep_share}::DOUBLE AS w, 'Infinity'::DOUBLE AS off
        FROM cells JOIN goal_source USING (source) JOIN goal_lang USING (lang) JOIN goal_topic USING (topic)
        UNION ALL
        SELECT t, source, lang, topic, tokens, goal_source, goal_lang, goal_topic, w, max(off) OVER () AS off FROM ({inner.replace(
            "FROM going", f"FROM raked, budget WHERE off > {tolerance} * b AND t < {rounds}")}) AS done)""")
    ctes.append("""rates AS (SELECT source, lang, topic, least(1.0, w / tokens) AS p FROM raked WHERE t = (SELECT max(t) FROM raked))""")
    return "WITH RECURSIVE " + ",\n".join(ctes) + """
        SELECT doc_id, topic, n_tokens, round(coalesce(p, 1.0), 6) AS probability,
               ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '(null)')), 1, 12))::BIGINT / 281474976710656.0 < coalesce(p, 1.0) AS kept
        FROM docs LEFT JOIN rates USING (source, lang, topic)"""
