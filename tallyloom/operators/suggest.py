"""Suggestions: frequent phrases, spellings that may be the same, and chains among them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import makes
from tallyloom.functions import text as T
from tallyloom.functions.similarity import sequence_ratio
from tallyloom.operators.ranking import with_rank


def phrase_frequencies(rows: DataFrame, text: str, stop: list[str], most: int | None = 60) -> DataFrame:
    """(phrase, n_rows): two- and three-word phrases by the number of rows that hold them, each row counting once."""
    words = T.tokens(F.coalesce(F.col(text), F.lit("")), stop)
    phrases = rows.select(F.explode(F.array_distinct(F.concat(T.ngrams(words, 2), T.ngrams(words, 3)))).alias("phrase"))
    out = phrases.groupBy("phrase").agg(F.count("*").alias("n_rows"))
    return out if most is None else out.orderBy(F.desc("n_rows"), "phrase").limit(most)


def ranked_spellings(rows: DataFrame, column: str) -> DataFrame:
    """(spelling, n, rank) by falling count, then alphabetically.  Spellings, not rows, are ranked."""
    counts = rows.where(F.coalesce(F.col(column), F.lit("")) != "").groupBy(F.col(column).alias("spelling")).agg(F.count("*").alias("n"))
    return with_rank(counts, [F.desc("n"), "spelling"])


def _alike(keyed: DataFrame, least: float) -> DataFrame:
    """All pairs of which the sequence ratio can round to ``least``: it is at most 2 |A & B| / (|A| + |B|) of the letters' multisets."""
    bound = least - 0.0001
    size, sorted_ = F.length("k"), F.sort_array(F.filter(F.split("k", ""), lambda x: x != ""))
    marked = keyed.withColumn("size", size).withColumn("s", sorted_)
    marked = marked.withColumn("s", F.transform("s", lambda x, i: F.concat(x, (i - F.array_position("s", x)).cast("string"))))
    side = lambda p: marked.select(*[F.col(c).alias(p + c) for c in ("spelling", "n", "rank", "k", "m", "size", "s")])
    sizes = F.sequence(F.ceil(F.col("a_size") * (bound / (2 - bound))).cast("int"), F.floor(F.col("a_size") * ((2 - bound) / bound)).cast("int"))
    near = side("a_").withColumn("b_size", F.explode(sizes)).join(side("b_"), "b_size").where("a_rank > b_rank and a_m = b_m")
    shared = F.size(F.array_intersect("a_s", "b_s"))
    return near.where(2 * shared >= bound * (F.col("a_size") + F.col("b_size"))).drop("a_size", "b_size", "a_s", "b_s")


def alias_pairs(spellings: DataFrame, least: float = 0.75) -> DataFrame:
    """For each spelling the best more frequent one it may stand for: (alias, canonical, score, reason).

    Spellings with the same letters and digits count as one, shown as the most frequent of them; truncated ones are neither side of a pair.

    Pairs meet on a shared token, a shared collapsed prefix of four letters, or a shared initial token prefix, or if their lengths and
    letters allow a ratio of ``least``, which loses no like pair; different digit runs or roman numerals rule a pair out.  Abbreviation and plural come before likeness of ``least``, that before containment.
    """
    one = spellings.groupBy(T.collapse_key(F.col("spelling")).alias("k")).agg(F.max_by("spelling", F.struct("n", -F.col("rank"))).alias("spelling"), F.sum("n").alias("n"))
    spellings = with_rank(one.drop("k"), [F.desc("n"), "spelling"])
    keyed = spellings.where(~makes.is_truncated(F.col("spelling"))).select("spelling", "n", "rank", T.collapse_key(F.col("spelling")).alias("k"), makes.variant_markers(F.col("spelling")).alias("m"), makes.token_list(F.col("spelling")).alias("t"))
    blocks = F.array_distinct(F.concat(F.col("t"), F.array(F.concat(F.lit("^"), F.substring("k", 1, 4))), F.transform("t", lambda x: F.concat(F.lit("~"), F.substring(x, 1, 2)))))
    side = lambda p: keyed.select(*[F.col(c).alias(p + c) for c in ("spelling", "n", "rank", "k", "m")], F.explode(blocks).alias("block"))
    pairs = side("a_").join(side("b_"), "block").where("a_rank > b_rank").drop("block").where("a_m = b_m")
    pairs = pairs.unionByName(_alike(keyed, least)).distinct()
    a, b = F.col("a_spelling"), F.col("b_spelling")
    score = F.round(sequence_ratio(F.col("a_k"), F.col("b_k")), 4)
    within = makes.contains_whole_tokens(a, b) | makes.contains_whole_tokens(b, a)
    reason = F.when(makes.abbreviates(a, b), "ABBREVIATION").when(makes.plural_of(a, b), "PLURAL").when(score >= least, "SIMILAR").when(within, "CONTAINMENT")
    strength = F.when(F.col("reason") == "CONTAINMENT", 1).when(F.col("reason") == "SIMILAR", 2).otherwise(3)
    told = pairs.withColumn("score", score).withColumn("reason", reason).where("reason is not null")
    best = F.max_by(F.struct(b.alias("canonical"), "score", "reason"), F.struct(strength, "score", -F.col("b_rank")))
    return told.groupBy(a.alias("alias")).agg(best.alias("x")).select("alias", "x.*")


def follow_chains(links: DataFrame, alias: str = "alias", target: str = "canonical") -> DataFrame:
    """``links`` with every target replaced by the end of its chain, by doubling: as many rounds as the chain's length has bits.

    Links lead to more frequent spellings, so there are no cycles.
    """
    now = links
    for _ in range(32):
        step = now.select(F.col(alias).alias("__a"), F.col(target).alias("__t"))
        moved = now.join(step, F.col(target) == F.col("__a"), "left").withColumn("__go", F.col("__t").isNotNull())
        next_ = moved.withColumn(target, F.coalesce("__t", target)).drop("__a", "__t")
        if not next_.where("__go").limit(1).count():
            return now
        now = next_.drop("__go")
    raise ValueError("the links hold a cycle")
