"""Scores, samples and fills."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.ranking import with_rank


def dominant_fill(rows: DataFrame, group: str, column: str, least: int = 3, share: float = 0.8) -> DataFrame:
    """``rows`` with ``filled``: blanks get the group's value if ``least`` rows are labelled and ``share`` of them agree."""
    some = rows.where(F.coalesce(F.col(column), F.lit("")) != "")
    counts = some.groupBy(group, column).agg(F.count("*").alias("n"))
    top = counts.groupBy(group).agg(F.sum("n").alias("labelled"), F.min_by(F.struct(column, "n"), F.struct((-F.col("n")).alias("n"), column)).alias("t"))
    fill = top.where((F.col("labelled") >= least) & (F.col("t.n") >= share * F.col("labelled"))).select(group, F.col(f"t.{column}").alias("__fill"))
    return rows.join(fill, group, "left").withColumn("filled", F.when(F.coalesce(F.col(column), F.lit("")) != "", F.col(column)).otherwise(F.col("__fill"))).drop("__fill")


def self_consistency(items: DataFrame, unit: Column, total: Column, quantity: Column, verbatim: Column) -> DataFrame:
    """Rates over all items: negative, small, without price, arithmetic right, verbatim."""
    from tallyloom.functions.money import arithmetic_ok

    price = F.coalesce(unit, total)
    checkable = quantity.isNotNull() & unit.isNotNull() & total.isNotNull()
    rate = lambda a, b: F.when(b > 0, F.round(a * 100.0 / b, 2)).otherwise(0.0)
    n = F.count("*")
    return items.agg(
        n.alias("n_items"),
        rate(F.count_if(price < 0), n).alias("negative_pct"),
        rate(F.count_if((price >= 0) & (price < 1000)), n).alias("small_pct"),
        rate(F.count_if(price.isNull()), n).alias("no_price_pct"),
        F.count_if(checkable).alias("n_checkable"),
        rate(F.count_if(checkable & arithmetic_ok(quantity, unit, total)), F.count_if(checkable)).alias("arithmetic_ok_pct"),
        rate(F.count_if(verbatim), F.count("*")).alias("verbatim_pct"),
    )


def golden_score(golden: DataFrame, candidate: DataFrame, keys: list[str], fields: list[str], numeric: list[str], pos: str) -> DataFrame:
    """Per field exact, wrong and missing against a labelled set; of repeated candidates the last counts; numbers may differ by 1."""
    last = candidate.groupBy(*keys).agg(F.max_by(F.struct(*fields), pos).alias("c"))
    both = golden.join(last, keys, "left")
    out = []
    for f in fields:
        want, got = F.col(f), F.col(f"c.{f}")
        norm = lambda x: F.lower(F.trim(F.regexp_replace(x.cast("string"), r"\s+", " ")))
        same = F.abs(want.cast("double") - got.cast("double")) <= 1.0 if f in numeric else norm(want) == norm(got)
        absent = got.isNull()
        out.append(
            both.where(want.isNotNull()).agg(
                F.lit(f).alias("field"), F.count_if(~absent & F.coalesce(same, F.lit(False))).alias("exact"), F.count_if(~absent & ~F.coalesce(same, F.lit(False))).alias("wrong"), F.count_if(absent).alias("missing")
            )
        )
    result = out[0]
    for p in out[1:]:
        result = result.unionByName(p)
    return result


def strided_sample(rows: DataFrame, order: str, n: int) -> DataFrame:
    """Every (count // n)-th row in order, n at most."""
    total = rows.count()
    step = max(1, total // n)
    numbered = with_rank(rows, [order], "__r")
    return numbered.where(((F.col("__r") - 1) % step == 0) & (F.col("__r") <= step * n)).drop("__r")


def stratified_sample(rows: DataFrame, stratum: str, key: str, n: int, seed: int) -> DataFrame:
    """About n rows, each stratum in proportion and with one row at least; drawn by md5 of seed and key."""
    counts = rows.groupBy(stratum).agg(F.count("*").alias("size"))
    total = rows.agg(F.count("*").alias("total"))
    quota = counts.crossJoin(total).select(F.col(stratum).alias("__s"), F.greatest(F.lit(1), F.floor(F.col("size") * n / F.col("total"))).alias("quota"))
    drawn = rows.withColumn("__o", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    ranked = drawn.withColumn("__r", F.row_number().over(Window.partitionBy(stratum).orderBy("__o")))
    return ranked.join(F.broadcast(quota), F.col(stratum).eqNullSafe(F.col("__s"))).where("__r <= quota").drop("__o", "__r", "__s", "quota")


def greedy_pairs(expected: list[str], found: list[str]) -> list[tuple[int, int]]:
    """Pairs by equal item number, else the first unused at all; -1 where none is left."""
    used: set[int] = set()
    out = []
    for i, number in enumerate(expected):
        j = next((j for j, x in enumerate(found) if j not in used and number and x == number), None)
        if j is None:
            j = next((j for j in range(len(found)) if j not in used), None)
        if j is not None:
            used.add(j)
        out.append((i, -1 if j is None else j))
    return out


def greedy_match(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(key, expected_pos, found_pos) of the one-to-one matching of two item lists (key, pos, item_no) per example."""
    lists = lambda df, name: df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("item_no", F.lit("")).alias("item_no")))).alias(name))
    both = lists(expected, "a").join(lists(found, "b"), key, "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for k, a, b in zip(part[key], part["a"], part["b"], strict=True):
                b = [] if b is None else list(b)
                rows += [(k, a[i]["pos"], b[j]["pos"] if j >= 0 else None) for i, j in greedy_pairs([x["item_no"] for x in a], [x["item_no"] for x in b])]
            out = pd.DataFrame(rows, columns=[key, "expected_pos", "found_pos"])
            out["found_pos"] = out["found_pos"].astype("Int64")
            yield out

    return both.mapInPandas(run, f"{key} {expected.schema[key].dataType.simpleString()}, expected_pos long, found_pos long")
