"""MinHash near-duplicate detection: SuperMinHash signatures, banding, exact verification, union-find.

Steps, all distributed:

1. one pass over the texts makes each document's shingle set, its 128-bit fingerprint and its band keys;
2. documents with equal sets form a class, of which the least id goes on (copies never meet as pairs);
3. classes that share a band key are joined to the least of them, and the connected components of these
   candidate edges are *clusters*: every pair of documents that share a band lies in one cluster;
4. each cluster is solved exactly on full sets.  A document of which under 80 % of the shingles occur in another document
   of its group can have no link and is peeled off, repeatedly; the rest is searched breadth first,
   so one verified link per document is enough.  Clusters over ``group_docs`` documents or ``group_shingles`` shingles are peeled by
   distributed counts first, then solved in blocks of at most that size (a longer document is a block of its own) that share a few pivots;
   what is left outside of the cluster's main component is dealt anew into as few blocks as hold it, and those meet all blocks;
5. components of the verified links.

Hot bands, classes and hubs are joined to tables of one row a key, so adaptive execution splits their side.  Nodes are ids; a row is
known by its id and its set, so an id that stands for several texts keeps the links of each.

With m = 101 and 4 rows a band, two documents of similarity 0.8 share no band with probability 2e-6.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby as runs

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import arrow_rows, free_name, stored
from tallyloom.llm.components import components
from tallyloom.llm.superminhash import band_keys, signature
from tallyloom.llm.textops import U64, buffers, mix, shingles, words

PIVOTS = 16


def _sketch(k: int, m: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets, _ = buffers(batch.column(1))
            h, bounds = words(raw, offsets)
            n = batch.num_rows
            sizes, fp1, fp2 = np.zeros(n, np.int64), np.zeros(n, U64), np.zeros(n, U64)
            keys: list[np.ndarray | None] = [None] * n
            for i in range(n):
                s = shingles(h[bounds[i] : bounds[i + 1]], k)
                sizes[i] = len(s)
                if len(s):
                    fp1[i], fp2[i] = s.sum(dtype=U64), mix(s ^ U64(0x94D049BB133111EB)).sum(dtype=U64)
                    keys[i] = band_keys(signature(s, m), rows).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(fp1.view(np.int64)), pa.array(fp2.view(np.int64)), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "fp1", "fp2", "bands"],
            )

    return run


def solve(sets: list[np.ndarray], given: np.ndarray, percent: int) -> np.ndarray:
    """Component number (the least index) of each set under links of at least ``percent`` similarity.

    ``given`` joins sets beforehand: equal numbers are known to be connected.  Only pairs across known
    components are compared.
    """
    n = len(sets)
    parent = np.arange(n)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(x: int, y: int) -> None:
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)

    first: dict[int, int] = {}
    for i, g in enumerate(given.tolist()):
        union(first.setdefault(g, i), i)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    if n < 2:
        return parent
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(n), size)
    del values
    while True:  # peel: links need percent of a set's shingles in other sets
        df = np.bincount(codes, minlength=1)
        keep = df[codes] > 1
        shared = np.bincount(doc[keep], minlength=n)
        alive = 100 * shared >= percent * size
        keep &= alive[doc]
        if keep.all():
            break
        codes, doc = codes[keep], doc[keep]
        if not len(codes):
            return np.array([find(i) for i in range(n)])
    present = np.unique(doc)
    order = np.argsort(codes, kind="stable")
    posting_doc, starts = doc[order], np.searchsorted(codes[order], np.arange(codes.max() + 2))
    row_at = np.searchsorted(doc, np.arange(n + 1))
    todo = np.zeros(n, dtype=bool)
    todo[present] = True
    root = np.array([find(i) for i in range(n)])

    def neighbours(i: int) -> np.ndarray:
        mine = codes[row_at[i] : row_at[i + 1]]
        lo, hi = starts[mine], starts[mine + 1]
        count = hi - lo
        flat = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        met = np.bincount(posting_doc[flat], minlength=n)
        return np.flatnonzero((met > 0) & todo & (100 * met >= percent * (size[i] + size - met)))

    members: dict[int, list[int]] = {}
    for i in present.tolist():
        members.setdefault(int(root[i]), []).append(i)
    largest_first = sorted(members.values(), key=len, reverse=True)
    for group in largest_first:
        queue = [i for i in group if todo[i]]
        if not queue or len(members) == 1:
            continue
        todo[queue] = False
        while queue:
            if not todo.any():
                break
            i = queue.pop()
            for j in neighbours(i).tolist():
                union(i, j)
                for x in members.get(int(root[j]), [j]):
                    if todo[x]:
                        todo[x] = False
                        queue.append(x)
    return np.array([find(i) for i in range(n)])


def _solve_groups(k: int, percent: int):
    """Rows (group, doc_id, given, text), sorted by group: (a, b) for each doc that is joined to a lesser one."""

    def flush(ids: list[int], given: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        order = sorted(range(len(ids)), key=ids.__getitem__)
        ids_, sets_ = np.array([ids[i] for i in order], np.int64), [sets[i] for i in order]
        root = solve(sets_, np.array([given[i] for i in order], np.int64), percent)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(ids_[root[moved]]), pa.array(ids_[moved])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, given, sets = None, [], [], []
        for batch in batches:
            raw, offsets, _ = buffers(batch.column(3))
            h, bounds = words(raw, offsets)
            at = 0
            for group, rows in runs(batch.column(0).to_pylist()):
                count = len(list(rows))
                if group != now:
                    if len(ids) > 1:
                        yield flush(ids, given, sets)
                    now, ids, given, sets = group, [], [], []
                ids += batch.column(1).slice(at, count).to_pylist()
                given += batch.column(2).slice(at, count).to_pylist()
                sets += [shingles(h[bounds[i] : bounds[i + 1]], k) for i in range(at, at + count)]
                at += count
        if len(ids) > 1:
            yield flush(ids, given, sets)

    return run


def _exploded(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets, _ = buffers(batch.column(2))
            h, bounds = words(raw, offsets)
            for i in range(batch.num_rows):
                s = shingles(h[bounds[i] : bounds[i + 1]], k)
                if len(s):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(s), batch.column(0)[i].as_py())), pa.array(np.full(len(s), batch.column(1)[i].as_py())), pa.array(s.view(np.int64))], names=["cluster", "doc_id", "shingle"]
                    )

    return run


def _links(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified links of rows (group: string, doc_id, given, text), each group solved in one task."""
    ordered = texts.select("group", "doc_id", "given", "text").repartition("group").sortWithinPartitions("group")
    return ordered.mapInArrow(_solve_groups(k, percent), "a long, b long")


def _large(texts: DataFrame, k: int, percent: int, group_docs: int, group_shingles: int) -> DataFrame:
    """Links of large clusters: rows (cluster, doc_id, digest, n_shingles, size, volume, text)."""
    items = stored(texts.select("cluster", "doc_id", "text").mapInArrow(_exploded(k), "cluster long, doc_id long, shingle long"), "items")
    df = items.groupBy("cluster", "shingle").agg(F.count("*").alias("df")).where("df > 1")
    met = items.join(df, ["cluster", "shingle"], "left_semi").groupBy("doc_id").agg(F.count("*").alias("shared"))
    parts = lambda docs, shingles: F.greatest(F.lit(1), F.ceil(docs / group_docs), F.ceil(shingles / group_shingles)).cast("long")
    left = texts.join(met, "doc_id").where(F.col("shared") * 100 >= F.col("n_shingles") * percent).drop("shared").withColumn("blocks", parts(F.col("size"), F.col("volume")))
    left = stored(left.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks"))), "large")
    name = lambda *parts: F.concat_ws("/", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])
    # the same few members of a cluster, drawn by hash, stand in each of its blocks and so tie them together
    ranked = left.groupBy("cluster").agg(*[F.min_by("doc_id", F.xxhash64("doc_id", F.lit(i))).alias(f"p{i}") for i in range(PIVOTS)])
    pivots = ranked.select("cluster", F.explode(F.array_distinct(F.array(*[f"p{i}" for i in range(PIVOTS)]))).alias("doc_id"))
    shared = left.join(pivots, ["cluster", "doc_id"], "left_semi").withColumn("own", F.col("block")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("own != block").drop("own")
    local = left.unionByName(shared)
    first = stored(_links(local.select(name("cluster", "block").alias("group"), "doc_id", F.col("doc_id").alias("given"), "text"), k, percent), "links")
    comp = components(first).withColumnRenamed("node", "doc_id")
    placed = left.join(comp, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    sizes = placed.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("cluster").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    placed = stored(placed.join(main, "cluster"), "placed")
    outside = placed.where("component != main")
    if outside.isEmpty():
        return first
    dealt = outside.groupBy("cluster").agg(parts(F.count("*"), F.sum("n_shingles")).alias("outs"))
    outside = outside.join(dealt, "cluster").withColumn("u", F.pmod(F.xxhash64("component"), F.col("outs")))
    cells = outside.select("cluster", "u", "blocks").distinct().withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    cell = lambda: name("cluster", "u", "block").alias("group")
    mine = outside.drop("block").join(cells, ["cluster", "u"]).select(cell(), "doc_id", "digest", F.col("component").alias("given"), "text")
    theirs = placed.join(cells, ["cluster", "block"]).select(cell(), "doc_id", "digest", F.col("component").alias("given"), "text")
    second = _links(mine.unionByName(theirs).dropDuplicates(["group", "doc_id", "digest"]), k, percent)
    return first.unionByName(second)


def near_dedup(docs: DataFrame, k: int = 4, percent: int = 80, m: int = 101, rows: int = 4, group_docs: int = 512, group_shingles: int = 1 << 19, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if ``100 * |A & B| >= percent * |A | B|`` for their sets of k-word shingles.
    A text of fewer than k words is one shingle; a null, empty or blank text has no shingles and no links.
    Rows with a null id get a null component and are kept.  Rows that repeat an id are joined with each other, and each links by its own text.
    Other columns of ``docs`` are not used.
    """
    arrow_rows(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = stored(source.mapInArrow(_sketch(k, m, rows), "doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>"), "sketch")
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    by_set = full.groupBy("n_shingles", "fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"))
    classes = stored(by_set, "classes")
    keys = classes.select("rep", F.explode("bands").alias("band"))
    heads = keys.groupBy("band").agg(F.min("rep").alias("head"), F.max("rep").alias("last")).where("head != last").drop("last")
    star = keys.join(heads, "band").where("rep != head").select(F.col("head").alias("a"), F.col("rep").alias("b"))
    clusters = stored(components(star).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster")), "clusters")
    member = clusters.join(classes.groupBy(F.col("rep").alias("doc_id")).agg(F.min("n_shingles").alias("n_shingles"), F.max("n_shingles").alias("most")), "doc_id")
    sizes = member.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("most").alias("volume"))
    member = member.drop("most").join(sizes, "cluster")
    texts = source.where("doc_id is not null").join(member, "doc_id").withColumn("digest", F.md5("text"))
    texts = stored(texts.dropDuplicates(["doc_id", "digest"]), "members")
    small = (F.col("size") <= group_docs) & (F.col("volume") <= group_shingles)
    links = _links(texts.where(small).select(F.col("cluster").cast("string").alias("group"), "doc_id", F.col("doc_id").alias("given"), "text"), k, percent)
    large = texts.where(~small)
    if not large.isEmpty():
        links = links.unionByName(_large(large, k, percent, group_docs, group_shingles))
    joined = components(links.unionByName(_same_id(full, classes)))
    of_set = classes.select("n_shingles", "fp1", "fp2", "rep").join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
    of_set = of_set.select("n_shingles", "fp1", "fp2", F.coalesce("component", "rep").alias("component"))
    out = sketch.select("doc_id", "n_shingles", "fp1", "fp2").join(of_set, ["n_shingles", "fp1", "fp2"], "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _same_id(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of an id that stands for several sets."""
    of_set = F.struct("n_shingles", "fp1", "fp2")
    several = full.groupBy("doc_id").agg(F.min(of_set).alias("least"), F.max(of_set).alias("most")).where("least != most").select("doc_id")
    rep = full.join(several, "doc_id", "left_semi").select("doc_id", "n_shingles", "fp1", "fp2").distinct().join(classes.drop("bands"), ["n_shingles", "fp1", "fp2"]).select("doc_id", "rep")
    return rep.join(rep.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").select("a", F.col("rep").alias("b"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its group, with their columns; of rows that repeat an id one stays.

    That is the one whose text (then whose other columns) hashes lowest.  Rows without an id and texts without words all stay.
    """
    found = near_dedup(docs, **options).select("doc_id", "kept")
    at = free_name(docs, "gone_id")
    gone = found.where("not kept").select(F.col("doc_id").alias(at)).distinct()
    same = F.col("doc_id") == F.col(at)
    left = docs.join(gone, same, "left_anti")
    again = stored(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias(at)).count().where("count > 1").select(at), "again")
    if again.isEmpty():
        return left
    hashed = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    order = F.struct(F.xxhash64("text"), F.col("text"), F.xxhash64(*[F.col(f"`{c}`") for c in hashed]))
    one = left.join(again, same, "left_semi").groupBy(F.col("doc_id").alias(at)).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), order).alias("row"))
    return left.join(again, same, "left_anti").unionByName(one.select("row.*"))
