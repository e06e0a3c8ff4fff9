"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic).  The cells' token weights
are raked: scaled to the target share of every source, then of every language,
then of every topic, again and again until all three marginals hold.  No
level can give more than all its tokens and no cell more than probability one:
a target beyond that is limited to what its level has, and the other levels of
the dimension share the rest in proportion (water-filling), so a rare level
costs the others nothing.  Then each document is drawn with its cell's
probability, by a hash of its id, so a second run draws the same documents.

Cells are summed map-side; a source with a third of all rows is one row per
cell and task.  All raking steps run on the cell table, which is written once a
round below the shared folder.
"""

import warnings

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, materialise, ship, utf8

CELLS_PER_TASK = 100_000
SHORTFALL = 0.05                 # of a level's limited target that may be missing without a warning
DIMENSIONS = ("source", "lang", "topic")
_FORM = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("topic", T.StringType())])
_SIGNS, _CAPITALS = b"#*$%&|<>{}=", bytes(range(65, 91))


def topic_of(text: bytes, n_words: int) -> str:
    """The form of a text, which stands for its topic where no topic column is given."""
    if not n_words:
        return "empty"
    if 10 * text.count(b"|") > n_words:
        return "table"
    if 4 * (len(text) - len(text.translate(None, _SIGNS))) > n_words:
        return "symbols"
    if 3 * (len(text) - len(text.translate(None, _CAPITALS))) > len(text):
        return "capitals"
    return "note" if n_words < 100 else "article" if n_words < 1000 else "book"


def _form(texts: pa.Array) -> pa.Array:
    rows = [(n := len(b.split()), topic_of(b, n)) for b in utf8(texts)]
    return pa.StructArray.from_arrays([pa.array([n for n, _ in rows], pa.int64()),
                                       pa.array([t for _, t in rows], pa.string())], names=_FORM.names)


def form(text: Column) -> Column:
    """struct(n_tokens, topic) of a text column: its words, and its form as topic; null counts as empty."""
    return F.arrow_udf(_form, _FORM)(text)


def tempered(cells: DataFrame, dimension: str, alpha: float) -> DataFrame:
    """(level, share): shares in proportion to the token share to the power ``alpha`` (1: as it is, 0: equal)."""
    levels = cells.groupBy(F.col(dimension).alias("level")).agg(F.sum("tokens").alias("t")).where("t > 0") \
        .select("level", F.pow(F.col("t").cast("double"), F.lit(alpha)).alias("p"))
    every = levels.agg(F.sum("p")).first()[0] or 1.0
    return levels.select("level", (F.col("p") / F.lit(every)).alias("share"))


def given(cells: DataFrame, dimension: str, shares: dict[str, float]) -> DataFrame:
    """(level, share) from given shares; levels that are not named divide what is left by their tokens."""
    spark = cells.sparkSession
    named = spark.createDataFrame([(k, float(v)) for k, v in shares.items()], "level string, named double")
    levels = cells.groupBy(F.col(dimension).alias("level")).agg(F.sum("tokens").alias("t")).where("t > 0") \
        .join(named, "level", "left")
    rest, got = levels.agg(F.sum(F.when(F.col("named").isNull(), F.col("t"))), F.sum("named")).first()
    left = max(0.0, 1.0 - sum(shares.values())) if rest else 0.0
    every = (left + (got or 0.0)) or 1.0
    share = F.coalesce("named", F.lit(left) * F.col("t") / F.lit(float(rest or 1)))
    return levels.select("level", (share / F.lit(every)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], keep: float, rounds: int = 8,
         tolerance: float = 0.005) -> DataFrame:
    """``cells`` with ``weight`` (their sum is all tokens) and ``probability`` = keep * weight / tokens, at most one.

    ``cells`` has a column per dimension and ``tokens``; ``targets`` has (level,
    share) per dimension.  The cells are written once a round.  Stops when a round changes no weight by more than
    ``tolerance`` of itself, or after ``rounds``; where the caps do not allow the
    targets, the last round is the answer.
    """
    total, n = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count(F.lit(1))).first()
    parts = 1 + n // CELLS_PER_TASK              # a small table is raked without an exchange
    most = F.col("tokens") / F.lit(keep)
    at = cells.coalesce(parts).withColumn("weight", F.col("tokens").cast("double"))
    targets = {d: materialise(t.coalesce(parts).withColumn("want", F.col("share") * F.lit(float(total))).select("level", "want"), "targets")
               for d, t in targets.items()}
    for _ in range(rounds if total else 0):
        at = at.withColumn("before", F.col("weight"))
        for d, target in targets.items():
            factor = at.groupBy(F.col(d).alias("level")).agg(F.sum("weight").alias("has")).join(target, "level") \
                .select(F.col("level").alias(d), F.when(F.col("has") > 0, F.col("want") / F.col("has")).otherwise(0.0).alias("factor"))
            at = at.join(factor, d, "left").withColumn(
                "weight", F.least(F.col("weight") * F.coalesce("factor", F.lit(0.0)), most)).drop("factor")
            at = at.coalesce(parts)
        at = materialise(at, "cells").coalesce(parts)
        change = at.agg(F.max(F.when(F.col("before") > 0, F.abs(F.col("weight") / F.col("before") - 1)))).first()[0]
        at = at.drop("before")
        if (change or 0.0) <= tolerance:
            break
    return at.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") / most))
                         .otherwise(F.lit(keep)))


def draw(id_col: Column, text: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on the id only (on the text if the id is null)."""
    of = F.coalesce(id_col.cast("string"), text, F.lit(""))
    return F.xxhash64(F.lit(seed), of).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def _measured(docs: DataFrame, text_col: str, topic_col: str | None) -> tuple[DataFrame, str]:
    ship(docs.sparkSession)
    m = free_name(docs, "form_of_row")
    shaped = docs.withColumn(m, form(F.col(text_col)))
    level = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    topic = level(topic_col) if topic_col else F.col(f"{m}.topic")
    return shaped.withColumn(m, F.struct(level("source").alias("source"), level("lang").alias("lang"),
                                         topic.alias("topic"), F.col(f"{m}.n_tokens").alias("n_tokens"))), m


def limited(cells: DataFrame, dimension: str, target: DataFrame, keep: float) -> DataFrame:
    """(level, share, limit) of (level, share): the share that a level can have when ``keep`` of all tokens are drawn.

    A level gives at most all its tokens; what it cannot give goes to the others
    in proportion to their shares, again and again until nobody is over.  Every
    step settles one level at least, and usually all that will be.
    """
    levels = materialise(target.join(cells.groupBy(F.col(dimension).alias("level")).agg(F.sum("tokens").alias("has")), "level"),
                         "levels")
    total = levels.agg(F.sum("has")).first()[0] or 0
    rate = drawn = keep * total                  # a level draws rate * share, or all it has
    while total:
        over = F.col("has") <= F.lit(rate) * F.col("share")
        full, share = levels.agg(F.sum(F.when(over, F.col("has"))), F.sum(F.when(~over, F.col("share")))).first()
        if not share or (drawn - (full or 0)) / share <= rate * (1 + 1e-12):
            break
        rate = (drawn - (full or 0)) / share
    limit = F.least(F.col("has").cast("double"), F.lit(float(rate)) * F.col("share")) / F.lit(float(drawn or 1))
    return levels.select("level", "share", limit.alias("limit"))


def reached(cells: DataFrame, targets: dict[str, DataFrame], weight: str = "weight") -> DataFrame:
    """(dimension, level, target, limited, reached): the shares that a level should have, can have, and has in ``weight``."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    out = None
    for d, target in targets.items():
        has = cells.groupBy(F.col(d).alias("level")).agg((F.sum(weight) / F.lit(total)).alias("reached"))
        rows = target.join(has, "level").select(F.lit(d).alias("dimension"), "level", F.col("share").alias("target"),
                                                F.col("limit").alias("limited"), "reached")
        out = rows if out is None else out.union(rows)
    return out


def fit(cells: DataFrame, targets: dict[str, DataFrame], keep: float, rounds: int = 8) -> tuple[DataFrame, DataFrame]:
    """(raked cells, ``reached`` shares): raking towards the limited targets.

    Where even these contradict each other (two dimensions that fix each other, cells at probability one), the last
    round is the answer and a warning tells the worst level.
    """
    targets = {d: materialise(limited(cells, d, t, keep), "targets") for d, t in targets.items()}
    raked = rake(cells, {d: t.select("level", F.col("limit").alias("share")) for d, t in targets.items()}, keep, rounds)
    rows = materialise(reached(raked, targets), "shares")
    worst = rows.where("limited > 0").agg(F.min(F.col("reached") / F.col("limited"))).first()[0]
    if worst is not None and worst < 1 - SHORTFALL:
        warnings.warn(f"mixing: the targets cannot all be met; the worst level reaches {worst:.3f} of its share", stacklevel=2)
    return raked, rows


def _fitted(measured: DataFrame, targets: dict[str, dict[str, float]] | None, alpha: float, keep: float,
            rounds: int) -> tuple[DataFrame, DataFrame]:
    cells = materialise(measured.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    wanted = {d: given(cells, d, targets[d]) if targets and d in targets else tempered(cells, d, alpha) for d in DIMENSIONS}
    return fit(cells, wanted, keep, rounds)


def fitted_cells(measured: DataFrame, targets: dict[str, dict[str, float]] | None, alpha: float, keep: float,
                 rounds: int) -> DataFrame:
    """The raked cells of rows with the three dimensions and n_tokens."""
    return _fitted(measured, targets, alpha, keep, rounds)[0]


def shares(docs: DataFrame, text_col: str = "text", topic_col: str | None = None,
           targets: dict[str, dict[str, float]] | None = None, alpha: float = 0.8, keep: float = 0.75,
           rounds: int = 8) -> DataFrame:
    """(dimension, level, target, limited, reached): what ``mix`` aims at, what the levels can give, what its weights reach."""
    shaped, m = _measured(docs, text_col, topic_col)
    return _fitted(shaped.select(f"{m}.*"), targets, alpha, keep, rounds)[1]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", topic_col: str | None = None,
        targets: dict[str, dict[str, float]] | None = None, alpha: float = 0.8, keep: float = 0.75,
        rounds: int = 8, seed: int = 42) -> DataFrame:
    """One row per input row: id, source, lang, topic, n_tokens, probability, selected.

    ``keep`` is the share of all tokens to draw, whatever the levels: a target
    that its level cannot give is limited (``shares`` tells target, limit and
    what was reached).  Very long texts count with all their words.  Dimensions without given ``targets`` are tempered by
    ``alpha``.  Null sources, languages and topics
    are the level ''.  Empty texts have no tokens: they weigh nothing and are
    drawn with the probability ``keep`` if their whole cell is empty.  Repeated rows
    share their draw; null ids are drawn by text.  An empty table gives an empty
    result; other columns of ``docs`` play no part.
    """
    shaped, m = _measured(docs, text_col, topic_col)
    rows = materialise(shaped.select(F.col(id_col).alias("id"), f"{m}.*",
                                     draw(F.col(id_col), F.col(text_col), seed).alias("u")), "mixing")
    cells = fitted_cells(rows, targets, alpha, keep, rounds)
    return rows.join(cells.select(*DIMENSIONS, "probability"), list(DIMENSIONS)).select(
        F.col("id").alias(id_col), *DIMENSIONS, "n_tokens", "probability",
        (F.col("u") < F.col("probability")).alias("selected"))


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", topic_col: str | None = None,
           targets: dict[str, dict[str, float]] | None = None, alpha: float = 0.8, keep: float = 0.75,
           rounds: int = 8, seed: int = 42) -> DataFrame:
    """The drawn rows of ``docs`` in their own columns."""
    shaped, m = _measured(docs, text_col, topic_col)
    cells = materialise(fitted_cells(shaped.select(f"{m}.*"), targets, alpha, keep, rounds)
                        .select(*DIMENSIONS, "probability"), "probabilities")
    c = free_name(docs, "cell_of_row")
    cells = cells.select(F.struct("*").alias(c))
    same = [F.col(f"{m}.{d}") == F.col(f"{c}.{d}") for d in DIMENSIONS]
    return shaped.join(cells, same) \
        .where(draw(shaped[id_col], shaped[text_col], seed) < F.col(f"{c}.probability")).select(*docs.columns)
