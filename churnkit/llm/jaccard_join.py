"""Exact Jaccard join of word-shingle sets by a size-aware heavy-light split.

A document's set are its distinct ``words``-word shingles (A-Z lower-cased).  Two
sets of sizes n and m link when they share at least c(n, m) shingles, the
smallest count that gives the similarity.  Equal sets are one node.

Light sets (at most ``x`` shingles) enumerate their subsets of the fixed sizes
c(n, m) over all light partner sizes m: linked light sets have a subset in
common, by definition.

Heavy sets scan inverted lists.  Linked sets differ in at most D = n + m - 2c
shingles, so of K parts, dealt by shingle hash, at least K - D are equal in both; a
list holds the sets with one equal part.  Listing parts rather than single shingles keeps
a frequent shingle from putting unrelated documents into one list.  K is about 1.5 D, and a set is scanned
only in its D + 1 shortest lists: two sets that share K - D lists share one of those, since all sets
order the lists alike.  So the lists of parts that lie wholly in a common passage are not scanned, unless the
passage makes up most of a document.  K follows the size class; a set
also enters the next class's lists where a larger partner may be there.  Light
sets that can link with a heavy one enter the lists too.

The boundary ``x`` is the one with the fewest postings, subsets and parts, for
the sizes found in the table.

A list links its members to its smallest one only; the components of these
candidate links are families, and every link lies within a family.  Families are
verified exactly, in blocks of bounded size: within blocks all pairs not yet
connected; then one set per component, again in blocks, while that joins
components; then the sets outside a family's largest component against all of
its blocks.  So no link is lost, and copies are never expanded into pairs.

Defined cases: null text, and a text without words, has an empty set and is its
own component; fewer than ``words`` words are one shingle; equal sets link
whatever their doc_ids; null doc_ids do not lower a component's id, which is null
only where all are; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnkit.llm.common import by_size, chunks, free_names, mix, release, signed, stored, words_of
from churnkit.operators.components import components

_BYTES = 2_000_000
#: Sets that a task remembers as listed, about.
_SEEN = 500_000
_A, _B = np.uint64(0x9FB21C651E98DF25), np.uint64(0xA0761D6478BD642F)
#: Sizes whose subsets are ever counted out; the boundary lies at or below it.
LIGHT_MOST = 24
#: A size class ends before CLASS_RATIO times its first size.
CLASS_RATIO = 1.5
#: Shingles verified against each other in one task (16 MB of hashes); a family of b blocks ships its texts b times at most.
BLOCK = 2_000_000


def needed(n: int, m: int, percent: int) -> int:
    """Fewest common shingles with 100 * common >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def subset_sizes(n: int, x: int, percent: int) -> list[int]:
    partners = range(-(-percent * n // 100), min(x, 100 * n // percent) + 1)
    return sorted({needed(n, m, percent) for m in partners if m})


def size_classes(most: int) -> list[int]:
    """First sizes of the classes up to ``most``, and the first beyond."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, int(out[-1] * CLASS_RATIO)))
    return out


def parts_of(beyond: int, percent: int) -> tuple[int, int]:
    """(differences at most, parts) for pairs whose larger set has a size below ``beyond``."""
    largest = 2 * (beyond - 1)  # the sum of both sizes; over 64 sums the rounding of needed() cannot hide the growth
    differ = max(t - 2 * needed(t, 0, percent) for t in range(max(2, largest - 64), largest + 1))
    return differ, differ + 1 + max(1, differ // 2)


def shingle_sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    h, _, _, first, _ = words_of(texts, lower=True)
    n = len(h)
    code = np.zeros(n, np.uint64)
    for k in range(words):
        code[: n - k] = mix(code[: n - k] * _A + h[k:] + np.uint64(k))
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(code[a: b - words + 1]))
        elif b > a:
            one = np.uint64(0)
            with np.errstate(over="ignore"):
                for x in h[a:b]:
                    one = mix(np.array([one * _B + x + np.uint64(b - a)]))[0]
            out.append(np.array([one]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def list_keys(s: np.ndarray, spaces: list[tuple[int, int, int]]) -> list[tuple[np.ndarray, int]]:
    """Per space (class, differences, parts): the keys of a set's inverted lists, one for each part with shingles, and
    how many of the longest lists it need not be scanned in.

    Linked sets have ``parts - differences`` equal parts, as many less the empty ones with shingles, so all but the longest
    that many minus one lists suffice.  Empty parts are listed only when so many are empty that an equal one might be.
    """
    total = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mix(s ^ _B), out=total[1:])
    out = []
    for number, differ, parts in spaces:
        cuts = (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64)
        at = np.concatenate([[0], np.searchsorted(s, cuts), [len(s)]])
        size = np.diff(at)
        key = mix(total[at[1:]] - total[at[:-1]] + np.arange(parts, dtype=np.uint64) * _A + np.uint64(number))
        equal = parts - differ - np.count_nonzero(size == 0)
        out.append((key, 0) if equal <= 0 else (key[size > 0], int(equal) - 1))
    return out


def spaces_of(n: int, firsts: list[int], percent: int, table: dict[int, tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The classes whose lists a set of size n enters: its own, and the next if a partner may be there."""
    own = int(np.searchsorted(firsts, n, "right")) - 1
    out = []
    for c in (own, own + 1):
        if c == own or 100 * n >= percent * firsts[c]:
            if c not in table:
                beyond = firsts[c + 1] if c + 1 < len(firsts) else max(firsts[c] + 1, int(firsts[c] * CLASS_RATIO))
                table[c] = parts_of(beyond, percent)
            out.append((c, *table[c]))
    return out


def postings(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n, node and second (the set's two hashes), keys (inverted lists: ``own`` of the set's class, then of the
    next), spare and spare2 (lists to leave out of each) and small (shingles of small sets).

    A set that occurs again among the rows of a task has no keys there.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[int, tuple[int, int]] = {}
        firsts = [1, 2]
        seen: set[int] = set()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in chunks([len(t or b"") for t in texts], _BYTES):
                sets = shingle_sets(texts[i:j], words)
                most = max(map(len, sets))
                if firsts[-2] <= most * 2:
                    firsts = size_classes(most * 4)
                node = np.array([np.bitwise_xor.reduce(mix(s + _A)) if len(s) else 0 for s in sets], np.uint64)
                second = np.array([mix(s ^ _A).sum() if len(s) else 0 for s in sets], np.uint64)
                if len(seen) > _SEEN:
                    seen.clear()
                new = []
                for s, h in zip(sets, node.tolist(), strict=True):
                    new.append(len(s) > 0 and h not in seen)
                    seen.add(h)
                none = np.zeros(0, np.uint64)
                spaces = [list_keys(s, spaces_of(len(s), firsts, percent, table)) if is_new else [] for s, is_new in zip(sets, new, strict=True)]
                keys = [np.concatenate([k for k, _ in p]) if p else none for p in spaces]
                count = lambda f: pa.array([f(p) for p in spaces], pa.int32())
                lists = lambda v: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, v)]).astype(np.int32)),
                                                           pa.array(signed(np.concatenate(v))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array([len(s) for s in sets], pa.int64()), pa.array(signed(node)), pa.array(signed(second)),
                     lists(keys), count(lambda p: len(p[0][0]) if p else 0), count(lambda p: p[0][1] if p else 0),
                     count(lambda p: p[1][1] if len(p) > 1 else 0),
                     lists([s if is_new and len(s) <= LIGHT_MOST else none for s, is_new in zip(sets, new, strict=True)])],
                    names=["doc_id", "n", "node", "second", "keys", "own", "spare", "spare2", "small"])

    return (docs.select("doc_id", F.col("text").cast("binary").alias("text"))
            .mapInArrow(work, "doc_id long, n long, node long, second long, keys array<long>, own int, spare int, spare2 int, small array<long>"))


def scanned(rows: DataFrame) -> DataFrame:
    """rows (node, keys, own, spare, spare2) -> (key, node) of the lists that hold other sets too, without each set's longest ones."""
    postings = rows.select("node", "own", "spare", "spare2", F.posexplode("keys").alias("i", "key")).select(
        "key", "node", F.when(F.col("i") < F.col("own"), 2 * F.col("spare")).otherwise(2 * F.col("spare2") + 1).alias("tag"))
    members = Window.partitionBy("key")
    shared = postings.withColumns({"long": F.count(F.lit(1)).over(members), "low": F.min("node").over(members), "high": F.max("node").over(members)})
    shared = shared.where("low <> high").select("key", "node", "tag", "long")
    # The tag is one number for all postings of a set in a space.
    longest = Window.partitionBy("node", "tag").orderBy(F.col("long").desc(), F.col("key").desc())
    shared = shared.dropDuplicates(["node", "tag", "key"])
    return shared.withColumn("i", F.row_number().over(longest)).where("i > floor(tag / 2)").select("key", "node")


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The light sizes end at the x with the fewest postings; ``sizes`` counts sets by size up to LIGHT_MOST."""
    firsts, table = size_classes(4 * LIGHT_MOST), {}
    parts = {n: sum(p for _, _, p in spaces_of(n, firsts, percent, table)) for n in range(1, LIGHT_MOST + 1)}

    def cost(x: int) -> int:
        light = sum(c * sum(math.comb(n, k) for k in subset_sizes(n, x, percent)) for n, c in sizes.items() if n <= x)
        return light + sum(c * parts[n] for n, c in sizes.items() if 100 * n >= percent * (x + 1))

    return min(range(LIGHT_MOST + 1), key=cost)


def _subsets(x: int, percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nodes = [], []
            for node, small in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = mix(np.array(small, np.int64).view(np.uint64))
                for k in subset_sizes(len(s), x, percent):
                    pick = np.array(list(combinations(range(len(s)), k)))
                    keys.append(mix(s[pick].sum(1) ^ np.uint64(k)))
                    nodes.append(np.full(len(pick), node))
            if keys:
                yield pa.record_batch([pa.array(signed(np.concatenate(keys))), pa.array(np.concatenate(nodes))], ["key", "node"])

    return work


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, node): a candidate link from each further node of a list to its first."""
    last_key, lead = None, 0
    for batch in batches:
        key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(key):
            continue
        new = np.concatenate([[last_key is None or key[0] != last_key], key[1:] != key[:-1]])
        at = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        first = np.where(at >= 0, node[at], lead)
        last_key, lead = key[-1], first[-1]
        other = np.flatnonzero(first != node)
        yield pa.record_batch([pa.array(first[other]), pa.array(node[other])], ["a", "b"])


class _Union:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if (up == self.up).all():
                return up
            self.up = up


def _similar(sets: list[np.ndarray], union: _Union, left: list[int], right: np.ndarray, percent: int) -> None:
    """Join i in ``left`` with each j in ``right`` that it links with, unless they are connected already."""
    size = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.cumsum(np.concatenate([[0], size]))[:-1]
    mark = np.zeros(int(ids.max()) + 1, bool)
    for i in left:
        roots = union.roots()
        todo = right[(roots[right] != roots[i]) & (100 * size[right] >= percent * size[i]) & (100 * size[i] >= percent * size[right])]
        if not len(todo):
            continue
        own = ids[start[i]: start[i] + size[i]]
        mark[own] = True
        take = np.repeat(start[todo] - np.concatenate([[0], np.cumsum(size[todo])[:-1]]), size[todo]) + np.arange(size[todo].sum())
        common = np.add.reduceat(mark[ids[take]], np.concatenate([[0], np.cumsum(size[todo])[:-1]]), dtype=np.int64)
        mark[own] = False
        for j in todo[100 * common >= percent * (size[i] + size[todo] - common)]:
            union.join(i, int(j))


def _block_links(words: int, percent: int):
    """Rows of one block (node, label, side, text): links between labels.  Side 0 meets all; side 1 meets side 0 only."""

    def work(table: pa.Table) -> pa.Table:
        rows = {}
        for node, label, side, text in zip(*(table.column(c).to_pylist() for c in ("node", "label", "side", "text")), strict=True):
            if node not in rows or side < rows[node][1]:
                rows[node] = (label, side, text)
        nodes = sorted(rows)
        sets = [s for i, j in chunks([len(rows[n][2]) for n in nodes], _BYTES) for s in shingle_sets([rows[n][2] for n in nodes[i:j]], words)]
        union, known = _Union(len(nodes)), {}
        for i, n in enumerate(nodes):
            union.join(known.setdefault(rows[n][0], i), i)
        side = np.array([rows[n][1] for n in nodes])
        _similar(sets, union, np.flatnonzero(side == 0).tolist(), np.arange(len(nodes)), percent)
        label = np.array([rows[n][0] for n in nodes], np.int64)
        roots = label[union.roots()]
        pairs = {(int(a), int(b)) for a, b in zip(roots, label, strict=True) if a != b}
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    return work


def _relabel(spark: SparkSession, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes (family, node, n, label) with the labels that ``links`` connects made one."""
    merged = components(spark, links).select(F.col("node").alias("label"), F.col("component").alias("to"))
    return stored(spark, nodes.join(merged, "label", "left")
                  .select("family", "node", "n", F.coalesce("to", "label").alias("label")), "jaccard-labels")


def _blocked(rows: DataFrame, block: int) -> DataFrame:
    """Rows with their family's number of blocks and their own block, by a hash."""
    weight = rows.groupBy("family").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    return rows.join(weight, "family").withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def verified(spark: SparkSession, texts: DataFrame, words: int, percent: int, block: int) -> DataFrame:
    """texts (family, node, n, blk, blocks, text) -> node, label: one label for all nodes that links connect."""
    links = _block_links(words, percent)
    columns = ["node", "label", "side", "text"]
    found = lambda rows, *by: stored(spark, rows.select("family", *by, *columns).groupBy("family", *by)
                                     .applyInArrow(links, "a long, b long"), "jaccard-links")
    nodes = texts.select("family", "node", "n", F.col("node").alias("label"))
    nodes = _relabel(spark, nodes, found(texts.withColumns({"label": F.col("node"), "side": F.lit(0)}), "blk"))
    if texts.where("blocks > 1").limit(1).count() == 0:
        return nodes.select("node", "label")
    # Families of several blocks; from here on only their texts are read.
    large = stored(spark, texts.where("blocks > 1").select("node", "text"), "jaccard-large")
    release(spark)
    mine = stored(spark, nodes.join(texts.where("blocks > 1").select("node"), "node", "left_semi"), "jaccard-labels")
    rest = nodes.join(texts.where("blocks = 1").select("node"), "node", "left_semi").select("node", "label")
    while True:  # one set for each component, in blocks, while that joins some
        heads = _blocked(mine.where("node = label"), block).withColumn("side", F.lit(0))
        new = found(heads.join(large, "node"), "blk")
        if new.limit(1).count() == 0:
            break
        mine = _relabel(spark, mine, new)
    share = mine.groupBy("family", "label").agg(F.count(F.lit(1)).alias("c"))
    top = share.groupBy("family").agg(F.max(F.struct("c", "label"))["label"].alias("top"))
    outer = _blocked(mine.join(top, "family").where("label <> top"), block)
    rounds = outer.groupBy("family").agg(F.max("blocks").alias("outer"))
    inner = _blocked(mine, block).withColumnRenamed("blocks", "inner").join(rounds, "family")
    # Each block of outer sets meets each block of the family.
    meets = inner.withColumn("oblk", F.explode(F.sequence(F.lit(0), F.col("outer") - 1))).select(
        "family", "oblk", "blk", "node", "label", F.lit(1).alias("side"))
    sizes = inner.groupBy("family").agg(F.max("inner").alias("inner"))
    meets = meets.unionByName(outer.join(sizes, "family").select(
        "family", F.col("blk").alias("oblk"), F.explode(F.sequence(F.lit(0), F.col("inner") - 1)).alias("blk"), "node", "label",
        F.lit(0).alias("side")))
    mine = _relabel(spark, mine, found(meets.join(large, "node"), "oblk", "blk"))
    return mine.select("node", "label").unionByName(rest)


def jaccard_components(spark: SparkSession, docs: DataFrame, *, words: int = 4, percent: int = 85, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    table = stored(spark, postings(docs, words, percent), "jaccard-postings")
    narrow = stored(spark, table.select("doc_id", "n", "node", "second"), "jaccard-narrow")
    sets = stored(spark, narrow.where("n > 0").groupBy("node").agg(F.min("n").alias("n"), F.min("doc_id").alias("doc"), F.min("second").alias("s0"),
                                                                   F.max("second").alias("s1"), F.max("n").alias("n1")), "jaccard-sets")
    if sets.where("s0 <> s1 OR n <> n1").limit(1).count():
        raise ValueError("two different sets have one 64-bit hash; change the hash constants")
    sizes = {int(r["n"]): r["c"] for r in sets.where(F.col("n") <= LIGHT_MOST).groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    x = boundary(sizes, percent)
    lists = scanned(table.where(100 * F.col("n") >= percent * (x + 1)))
    if x:
        light = table.where((F.col("n") > 0) & (F.col("n") <= x)).select("node", "small").mapInArrow(_subsets(x, percent), "key long, node long")
        lists = lists.unionByName(light)
    links = stored(spark, lists.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_lead, "a long, b long").distinct(),
                   "jaccard-candidates")
    del lists
    release(spark, table)
    families = components(spark, links).select("node", F.col("component").alias("family"))
    nodes = stored(spark, _blocked(families.join(sets, "node").select("family", "node", "n", "doc"), block), "jaccard-families")
    # The text of each set: the row of its smallest doc_id whose set this is.
    tagged = (docs.select("doc_id", F.col("text").cast("binary").alias("text"))
              .join(by_size(nodes.withColumnRenamed("doc", "id")), F.col("doc_id").eqNullSafe(F.col("id")))
              .select("node", "text", "family", "n", "blk", "blocks"))
    texts = stored(spark, tagged.mapInArrow(_own_text(words), "node long, text binary, family long, n long, blk int, blocks int"),
                   "jaccard-texts")
    release(spark, links)
    labels = verified(spark, texts, words, percent, block)
    named = stored(spark, narrow.join(labels.distinct(), "node", "left").select("doc_id", "n", F.coalesce("label", "node").alias("label")),
                   "jaccard-named")
    release(spark, texts)
    lowest = named.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = named.where("n > 0").join(lowest, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(named.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _own_text(words: int):
    """Rows (node, text, ...) whose text has the set of the node; a doc_id may stand for several texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, texts, keep = batch.column(0).to_numpy(), batch.column(1).to_pylist(), []
            for i, j in chunks([len(t or b"") for t in texts], _BYTES):
                for k, s in enumerate(shingle_sets(texts[i:j], words), i):
                    if len(s) and signed(np.bitwise_xor.reduce(mix(s + _A), keepdims=True))[0] == nodes[k]:
                        keep.append(k)
            yield batch.take(pa.array(keep, pa.int64()))

    return work


def one_of_each(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near copies: that with the smallest doc_id.

    A row without a doc_id stays unless it is linked to a row that has one; rows that share a doc_id stay together.
    """
    groups = jaccard_components(spark, docs, **options)
    name = free_names(docs, 1)[0]
    stays = stored(spark, groups.where("doc_id <=> component_id").select(F.col("doc_id").alias(name)).distinct(), "jaccard-stays")
    return docs.join(by_size(stays), F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")
