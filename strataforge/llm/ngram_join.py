"""N-gram Jaccard self-join by filtering under several global orders (operator 8).

A document is the set of its distinct five-word shingles, each a 64-bit hash keyed for the run.
Two different sets with Jaccard similarity t or more share a token among the first
|x| - ceil(t |x|) + 1 tokens of each, under any order of all tokens. Three orders are used. The
first sorts by how many blocks of documents hold a token, rare first, and makes candidates: pairs
that share a prefix token of it at positions that still allow enough overlap. The other two
shuffle all tokens by independent hashes, whatever their frequency, so that a prefix is a random
quarter of the set: a candidate stays only if under both of them the tokens common to the two
prefixes, and all those behind, could still make t. Only then are whole sets fetched and compared.

A token that occurs once links nothing: a document with too few other tokens, or with a prefix
without any, leaves the join at once, and no text is shuffled after that. Equal sets are one node,
named by 128 bits of two independent hashes. The nodes' prefixes and sets are written bucketed by
node once, and only candidates move to them.

Candidates of one token are not expanded into all pairs: in rounds of stars (each node against one
centre of its token's group, another one each round) most of a group links; after each round only
pairs of different components remain of interest. Each round writes all postings that are left, so
rounds end with the first that links nothing. What is left is then enumerated in full, so no link is
lost, however many rounds there were. Groups of heavy tokens are cut into parts, stars and pairs alike.

The result is exact unless several 64-bit hashes collide within one pair of documents.

Defined results: null or empty text, or text without words, is an empty set, linked with nothing
and a component of its own; fewer than five words are one shingle; repeated rows are equal sets;
an empty table gives no rows; other columns are ignored (``keep_one`` passes them through).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strataforge.llm import skew
from strataforge.llm.components import components
from strataforge.llm.repeats import Counter, classes_of, counted, filter_bits, in_blocks, member, repeated_in
from strataforge.llm.shared import Scratch, Words, arrow_bytes, chain_hashes, distinct, doc_runs, fresh_seeds, mix64, stored, window_starts

ORDERS = 3
#: At most so many rounds of stars, and none after one that joins no two components.
STAR_ROUNDS = 5
BUCKET_BYTES = 64 << 20  # of text, for each bucket of the sets
#: Nodes of a heavy token that share a centre, and that are paired in one task.
STAR, TILE = 256, 1000
PAIR = ("hub", "node", "hub_comp", "comp")


def _every_shingle(words: Words, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each shingle as it stands, and its document; fewer than ``n`` words are one shingle."""
    hashes = words.hashes(seed)
    starts, counts = window_starts(words.first, n), np.diff(words.first)
    values = [chain_hashes(hashes, starts, n, seed)]
    docs = [np.repeat(np.arange(len(counts)), np.maximum(counts - n + 1, 0))]
    for k in range(1, n):
        few = np.flatnonzero(counts == k)
        values.append(chain_hashes(hashes, words.first[few], k, seed))
        docs.append(few)
    return np.concatenate(values), np.concatenate(docs)


def _shingles(raw: np.ndarray, off: np.ndarray, n: int, seeds: list[int]):
    """Per run of documents: first row, rows, (document in the run, shingle, its second hash), sorted and distinct."""
    for a, b in doc_runs(off):
        words = Words(raw[off[a] : off[b]], off[a : b + 1] - off[a], lower=True)
        values, doc = _every_shingle(words, n, seeds[0])
        other, _ = _every_shingle(words, n, seeds[1])
        order = np.lexsort((values, doc))
        values, doc, other = values[order], doc[order], other[order]
        fresh = np.ones(len(values), bool)
        fresh[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
        yield a, b - a, doc[fresh], values[fresh], other[fresh]


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Least intersection of a set of n with a set it links to."""
    return -(-percent * n // 100)


def _profile(docs: DataFrame, percent: int, n: int, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """One row a document: id, n_shingles, node, row (its block), and for sets that may link: the tokens that occur elsewhere and,
    for each order, those of its prefix (for the first in order, with their positions). Of equal sets in one
    block only one row has them. Also the text's bytes."""
    blocks, n_blocks, total = in_blocks(docs, id_col, text_col)
    guess = max(1, total // 6)
    bits, seeds = filter_bits(guess), fresh_seeds(2 + ORDERS)
    shift, counter = np.uint64(64 - bits), Counter(n_blocks, guess, bits)

    def every(table: pa.Table) -> np.ndarray:
        """Leading bits of all shingles, document by document."""
        raw, off = arrow_bytes(table.column("text"))
        found = [np.zeros(0, np.uint64)]
        for a, b in doc_runs(off):
            values, doc = _every_shingle(Words(raw[off[a] : off[b]], off[a : b + 1] - off[a], lower=True), n, seeds[0])
            found.append(distinct(values) >> shift)
        return np.concatenate(found)

    longs = T.ArrayType(T.LongType())
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_shingles", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("row", T.IntegerType()), T.StructField("tokens", longs)]
        + [T.StructField(f"prefix{k}", longs) for k in range(ORDERS)]
        + [T.StructField("places", T.ArrayType(T.IntegerType()))]
    )

    def mark(table: pa.Table, returned: pa.Table) -> pa.Table:
        classes = classes_of(returned)
        raw, off = arrow_bytes(table.column("text"))
        size, nodes = np.zeros(table.num_rows, np.int64), [None] * table.num_rows
        lists: list[list] = [[None] * table.num_rows for _ in range(ORDERS + 2)]
        runs = list(_shingles(raw, off, n, seeds))
        every_one = np.concatenate([np.zeros(0, np.uint64), *(v >> shift for _, _, _, v, _ in runs)])
        known, own, seen = distinct(every_one), repeated_in(every_one), set()
        for a, m, doc, values, other in runs:
            cut = np.searchsorted(doc, np.arange(m + 1))
            short = values >> shift
            # rare first: nowhere else, in this block only, in so many blocks
            rank = classes[np.searchsorted(known, short)].astype(np.int64) + 1 if len(known) else np.zeros(0, np.int64)
            rank[(rank == 1) & ~member(short, own)] = 0
            counts = np.diff(cut)
            size[a : a + m] = counts
            prefix = counts - _needed(counts, percent) + 1
            shared = np.bincount(doc[rank > 0], minlength=m)
            possible = (shared >= _needed(counts, percent)) & (100 * counts >= percent * (counts + 1))
            for r in range(m):
                x, y = int(cut[r]), int(cut[r + 1])
                if x == y:
                    continue
                own_values = values[x:y]
                node = np.array([own_values.sum(), other[x:y].sum()], "<u8").tobytes()
                nodes[a + r] = node
                if not possible[r] or node in seen:
                    continue
                seen.add(node)
                order_rank, signed, p = rank[x:y], own_values.view(np.int64), int(prefix[r])
                found = []
                for k in range(ORDERS):
                    mixed = mix64(own_values ^ np.uint64(seeds[2 + k]))
                    first = (np.lexsort((mixed, order_rank)) if k == 0 else np.argsort(mixed))[:p]
                    found.append(first[order_rank[first] > 0])
                if not all(len(x) for x in found):
                    continue
                lists[0][a + r] = signed[order_rank > 0]  # no other set holds the rest
                for k, first in enumerate(found):
                    lists[1 + k][a + r] = signed[first]
                lists[-1][a + r] = np.arange(p - len(found[0]), p, dtype=np.int32)
        kinds = [pa.list_(pa.int64())] * (ORDERS + 1) + [pa.list_(pa.int32())]
        return pa.table([table.column("id"), pa.array(size), pa.array(nodes, pa.binary()), table.column("block"), *(pa.array(x, t) for x, t in zip(lists, kinds, strict=True))], names=schema.names)

    found = counted(blocks, counter, lambda t: distinct(every(t)))
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(mark, schema), total


def _possible(percent: int) -> F.Column:
    """Size and position filter of a candidate (n, place) against (m, spot), in integers."""
    n, m, p, q = (F.col(c) for c in ("n", "m", "place", "spot"))
    sizes = (100 * n >= percent * m) & (100 * m >= percent * n)
    return sizes & ((100 + percent) * (1 + F.least(n - p - 1, m - q - 1)) >= percent * (n + m))


def _reachable(percent: int, common: F.Column) -> F.Column:
    """Prefix filter of a pair whose prefixes have so many tokens in common: those and the larger rest must do.

    Of the two prefixes, take the one that ends first in the order: common tokens up to its end lie
    in both prefixes, and those behind it in the rest of its own set.
    """
    rest = lambda c: F.ceil(F.col(c) * percent / 100) - 1  # noqa: E731  tokens behind the prefix
    return (common > 0) & ((100 + percent) * (common + F.greatest(rest("n"), rest("m"))) >= percent * (F.col("n") + F.col("m")))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components of the candidate pairs (hub, node, hub_comp, comp) that pass the prefix filters of the other orders, and then link.

    ``sets`` stays where it is, bucketed by node; a hub's prefixes, and later its set, travel to its pairs' nodes.
    """
    others = [f"prefix{k}" for k in range(1, ORDERS)]
    near = sets.select("node", F.col("n_shingles").alias("n"), *others)
    far = sets.select(F.col("node").alias("hub"), F.col("n_shingles").alias("m"), *(F.col(c).alias(f"hub_{c}") for c in others))
    passes = F.lit(True)
    for c in others:
        passes = passes & _reachable(percent, F.size(F.array_intersect(c, f"hub_{c}")))
    left = pairs.join(far, "hub").join(near, "node").filter(passes).select(*pairs.columns)
    near = sets.select("node", F.col("n_shingles").alias("n"), "tokens")
    far = sets.select(F.col("node").alias("hub"), F.col("n_shingles").alias("m"), F.col("tokens").alias("hub_tokens"))
    common = F.size(F.array_intersect("tokens", "hub_tokens"))
    return left.join(far, "hub").join(near, "node").filter(100 * common >= percent * (F.col("n") + F.col("m") - common)).select(F.col("hub_comp").alias("a"), F.col("comp").alias("b")).distinct()


def _starred(named: DataFrame, sizes: DataFrame, turn: int, percent: int) -> DataFrame:
    """Postings (node, n, comp, token, place) of the tokens that are not done with, and the centre of their part of the token's group.

    A token is done with when all its nodes are of one component; heavy tokens, whose parts do not
    see each other, stay.
    """
    late = (F.col("place") * (100 + percent) > (100 - percent) * F.col("n")).alias("late")
    mixed = named.join(F.broadcast(sizes), "token", "left").withColumn("part", skew.chunk(F.col("node"), F.col("size"), STAR, turn))
    # the first round's centres agree between tokens, the later ones' differ
    order = [late, F.xxhash64("node", *(["token"] if turn else []), F.lit(turn)), F.col("node")]
    group = Window.partitionBy("token", "part")
    ordered = group.orderBy(*order)
    centre = F.first(F.struct(F.col("node").alias("hub"), F.col("n").alias("m"), F.col("place").alias("spot"), F.col("comp").alias("hub_comp"))).over(ordered)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    several = F.min("comp").over(whole) != F.max("comp").over(whole)
    return mixed.withColumn("c", centre).withColumn("several", several).filter(F.col("several") | F.col("size").isNotNull()).select(*named.columns, "c.*")


def _pairs(starred: DataFrame, percent: int) -> DataFrame:
    """Nodes with their centres, where both are of different components and may link."""
    return starred.filter((F.col("comp") != F.col("hub_comp")) & _possible(percent)).select(*PAIR).distinct()


def _leaders(rows: DataFrame) -> DataFrame:
    """(token): of the tokens that the same nodes hold, the first in the order.

    All these nodes hold it before the others, so it makes every candidate that they make. Sets of
    nodes are told apart by their size and 128 bits of hashes.
    """
    held = (F.bit_xor(F.xxhash64("node", F.lit(1))), F.bit_xor(F.xxhash64("node", F.lit(2))), F.count(F.lit(1)))
    each = rows.groupBy("token").agg(*(c.alias(f"s{k}") for k, c in enumerate(held)), F.min("place").alias("place"))
    return each.groupBy("s0", "s1", "s2").agg(F.min(F.struct("place", "token")).getField("token").alias("token")).select("token")


def _left(rows: DataFrame, sizes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """All pairs of one token's group that are of different components and may link, each pair once.

    Of tokens that the same nodes hold, one stands for all. A pair is made at its first common token
    alone; tokens within one component cannot be common to it. A heavy token's group is cut into
    parts, and two parts meet in a task of their own.
    """
    rows = scratch.stored(rows, "rows")
    own = rows.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("place", "token"))).getField("token").alias("mine"))
    rest = skew.attached(rows, _leaders(rows), "token").join(own, "node").join(F.broadcast(sizes), "token", "left").withColumn("part", skew.chunk(F.col("node"), F.col("size"), TILE))
    rest = scratch.stored(rest.withColumn("last", skew.parts(F.col("size"), TILE) - 1).drop("size"), "open")
    left = rest.withColumn("other", F.explode(F.sequence(F.col("part"), F.col("last")))).drop("last")
    right = rest.select("token", F.col("part").alias("other"), F.col("node").alias("hub"), F.col("n").alias("m"), F.col("place").alias("spot"), F.col("comp").alias("hub_comp"), F.col("mine").alias("theirs"))
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("other"))))
    both = F.array_intersect("mine", "theirs")
    first = F.element_at(both, 1) == F.col("token")
    once = (F.col("part") < F.col("other")) | (F.col("node") < F.col("hub"))
    # lists are compared only where the cheap conditions hold
    cheap = once & (F.col("comp") != F.col("hub_comp")) & _possible(percent)
    fits = F.when(cheap, first & _reachable(percent, F.size(both))).otherwise(False)
    return left.join(right, ["token", "part", "other"]).filter(fits).select(*PAIR)


def _postings(prefixes: DataFrame) -> DataFrame:
    """(node, n, comp, token, place) of the first order's prefixes."""
    each = prefixes.select("node", F.col("n_shingles").alias("n"), "comp", F.explode(F.arrays_zip("prefix0", "places")).alias("t"))
    return each.select("node", "n", "comp", F.col("t.prefix0").alias("token"), F.col("t.places").alias("place"))


def _links(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame | None:
    """(node, root) of all linked nodes, or none."""
    prefixes = sets.select("node", "n_shingles", "prefix0", "places", F.col("node").alias("comp"))
    named = _postings(prefixes)
    sizes = skew.heavy_keys(named, "token").withColumnRenamed("n", "size")
    roots, turn, last = None, 0, STAR_ROUNDS == 0
    while True:
        rows = None
        if last:
            pairs = _left(named, sizes, percent, scratch)
        elif not turn:
            pairs = _pairs(_starred(named, sizes, turn, percent), percent)
        else:
            rows = scratch.stored(_starred(named, sizes, turn, percent), "rows")
            pairs = _pairs(rows, percent)
        pairs = scratch.stored(pairs, "pairs")
        found = scratch.stored(_verified(pairs, sets, percent), "links")
        scratch.drop(pairs)
        step = None if found.isEmpty() else components(found, scratch)  # of components found so far
        scratch.drop(found)
        if step is not None:
            news = step.withColumnRenamed("root", "up")
            if roots is None:
                roots = step
            else:
                old = skew.attached(roots, news.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
                fresh = news.join(roots.select("node"), "node", "left_anti").select("node", F.col("up").alias("root"))
                roots = scratch.stored(old.unionByName(fresh), "roots")
        if last:
            return roots
        if not turn:
            named = _postings(prefixes if step is None else prefixes.drop("comp").join(step, "node", "left").withColumn("comp", F.coalesce("root", "node")))
        else:
            rows = rows.select("node", "n", "comp", "token", "place")
            named = rows if step is None else skew.attached(rows, news.withColumnRenamed("node", "comp"), "comp", "left").withColumn("comp", F.coalesce("up", "comp")).drop("up")
        turn += 1
        last = turn == STAR_ROUNDS or step is None


def similarity_classes(docs: DataFrame, percent: int = 75, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, n_shingles, component_id (smallest id that links reach, itself included)."""
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        found, total = _profile(docs, percent, n, id_col, text_col)
        profile = scratch.stored(found, "profile")
        # one row for each distinct set: equal sets have equal tokens and prefixes, so any row of a node will do
        alive = profile.filter("tokens is not null").select("node", "row", "n_shingles", "tokens", *(f"prefix{k}" for k in range(ORDERS)), "places")
        heavy = skew.heavy_keys(alive, "node").select("node")
        least = alive.join(F.broadcast(heavy), "node").groupBy("node").agg(F.min("row").alias("least"))
        one = alive.join(F.broadcast(least), "node", "left").filter(F.col("least").isNull() | (F.col("row") == F.col("least"))).drop("row", "least")
        buckets = max(2 * spark.sparkContext.defaultParallelism, -(-total // BUCKET_BYTES))
        sets = scratch.bucketed(one, "node", buckets, "sets")
        names = scratch.stored(profile.select("id", "n_shingles", "node"), "names")
        scratch.drop(profile)
        roots = _links(sets, percent, scratch)
        scratch.drop(sets)
        # smallest id of each node, then of each component, then of each document
        nodes = names.filter("n_shingles > 0").groupBy("node").agg(F.min("id").alias("component"))
        if roots is not None:
            held = scratch.stored(nodes.join(roots, "node", "left"), "held")
            linked = held.filter("root is not null")
            lows = scratch.stored(linked.groupBy("root").agg(F.min("component").alias("component")), "lows")
            of_root = skew.attached(linked.select("node", "root"), lows, "root").select("node", "component")
            nodes = scratch.stored(held.filter("root is null").select("node", "component").unionByName(of_root), "nodes")
        # a set that many documents share is a heavy key
        full = skew.attached(names.filter("n_shingles > 0").select("id", "n_shingles", "node"), nodes, "node").select("id", "n_shingles", "component")
        empty = names.filter("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component"))
        return stored(full.unionByName(empty).select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id")), "classes")


def keep_one(docs: DataFrame, percent: int = 75, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id. Empty documents stay.

    Rows without an id are not judged and stay. Rows that repeat the staying id and its text are
    one row afterwards; rows that repeat the id with another text stay.
    """
    classes = similarity_classes(docs.select(id_col, text_col), percent, n, id_col, text_col)
    go = classes.filter((F.col(id_col) != F.col("component_id")) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("goes"))
    left = docs.join(go, F.col(id_col) == F.col("goes"), "left_anti")
    named = left.filter(F.col(id_col).isNotNull()).dropDuplicates([id_col, text_col])
    return named.unionByName(left.filter(F.col(id_col).isNull()))
