"""Operator 8: n-gram Jaccard join with a count-vector R-tree.

Method: a document is the set of its hashed word shingles; the shingles fall into ``GROUPS``
groups by hash, and the counts per group are the set's point. The overlap of two sets is at most
the sum over groups of the smaller count, and for two tree nodes at most the sum of the minima
of their bounding boxes' upper corners. A self-join descends the tree, drops what cannot reach
the wanted overlap, and compares the surviving sets exactly.

One tree over all documents would not scale, as points of unrelated long texts lie close in few
dimensions. So trees are built per block: of two sets with Jaccard >= t the first l common shingles
(in any common order) are among the first |A| - ceil(t |A|) + l of each, for l = |A| // ``SHARED`` of
the smaller (1 at least). A block holds the sets that share one of these, merged under the least
set of that shingle. A set that does not share l of them with any others has no links, and one
that shares k keeps the k - l + 1 held by the fewest sets: a linked pair still has one in common. The order is by how often a shingle's hash
bucket occurs in the whole corpus (``SKETCH`` counters, an exact count per bucket), rarest
first, so common lines and passages do not make blocks. The order affects the cost only; no
link is lost.

Equal sets are one node from the start, so exact copies cost nothing. A block of more than
``TILE`` sets is split into tiles, each joined together with the block's lead; then only sets not
connected with the lead meet the whole block, again in groups of two tiles. Within a group pairs
already connected are skipped. So a large group of near copies is shipped once or twice and linked by a
few comparisons each, instead of all pairs.

``link_counts`` tells each row's number of links as well. There every tile of a block meets every
other, and a pair is counted in the one block whose lead is the least that both are dealt to; what
leaves a task is a sum per set, no pair. It costs a comparison per pair of near sets.

Nodes and shingles are 64-bit hashes (blake2b of the sorted set; a mixed polynomial of the
words' bytes).

Defined results: NULL, empty or blank text has an empty set and links with nothing; fewer than
four words are one shingle; rows are told apart by their set, not their id, so repeated ids,
repeated rows and NULL ids work (component_id is the smallest non-null id of the component, and
NULL only if there is none; for an empty set the row's own id); an empty table gives no rows.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltframe.llm.common import BROADCAST_ROWS, broadcast_if_small, cut_lineage, map_batches, map_sorted_groups, pick, table
from voltframe.llm.components import components

SHINGLE, PERCENT, SHARED = 4, 85, 24
GROUPS, LEAF, FANOUT, TILE = 512, 16, 8, 256
SKETCH_BITS = 18

_rng = np.random.default_rng(8)
#: Words are hashed by polynomials modulo two primes: modulo a power of two, whatever the base, words of
#: the Thue-Morse kind would meet.
_PRIMES = (2**31 - 1, 2**31 - 19)
_BASES = tuple(int(_rng.integers(2**20, p - 1)) for p in _PRIMES)
_BYTES = tuple(_rng.integers(1, p, 256, dtype=np.uint64) for p in _PRIMES)
for _b in _BYTES:
    _b[65:91] = _b[97:123]                                    # A-Z count as a-z
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_PLACE = _rng.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)


def _powers(n: int, base: int, prime: int) -> np.ndarray:
    out, size = np.ones(n, dtype=np.uint64), 1
    while size < n:
        part = out[size:2 * size]
        part[:] = out[:len(part)] * np.uint64(pow(base, size, prime)) % np.uint64(prime)
        size *= 2
    return out


class Shingler:
    """Sorted distinct shingle hashes of a text; keeps its power tables between texts."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self._grow(1 << 14)

    def _grow(self, n: int) -> None:
        self.length = n
        self.powers = [(_powers(n, base, p), _powers(n, pow(base, -1, p), p)) for base, p in zip(_BASES, _PRIMES)]

    def words(self, b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the words ``start:end`` of the bytes ``b``."""
        halves = []
        for (up, down), value, prime in zip(self.powers, _BYTES, map(np.uint64, _PRIMES)):
            total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(value[b] * up[:len(b)] % prime, dtype=np.uint64)])
            halves.append((total[end] - total[start]) % prime * down[start] % prime)
        return _mix(halves[0] | halves[1] << np.uint64(32))

    def __call__(self, text: str | None) -> np.ndarray:
        b = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        if len(b) >= self.length:
            self._grow(2 * len(b))
        blank = np.concatenate([[True], _BLANK[b], [True]])
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        start, end = edge[::2], edge[1::2]
        words = self.words(b, start, end)
        k = min(self.size, len(words))
        if k == 0:
            return words
        many = len(words) - k + 1
        out = np.full(many, k, dtype=np.uint64)
        for j in range(k):
            out += words[j:j + many] * _PLACE[j]
        return np.unique(_mix(out))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_shared(n: int) -> int:
    """How many shingles of their prefixes two linked sets share, the smaller of which has n."""
    return max(1, n // SHARED)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + least_shared(n)


def linked(overlap: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * overlap >= percent * (a + b - overlap)


class CountTree:
    """Bulk-loaded R-tree over group counts: leaves of ``LEAF`` consecutive points (sorted by size
    slab, then by the most varying coordinate), ``FANOUT`` children above."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        m = len(sizes)
        slab = np.argsort(np.argsort(sizes, kind="stable"), kind="stable") // max(LEAF, int(np.sqrt(m * LEAF)))
        axis = counts.var(axis=0).argmax()
        self.order = np.lexsort((counts[:, axis], slab))
        c, s = counts[self.order], sizes[self.order]
        step, self.levels = LEAF, []
        at = np.arange(0, m, step)
        level = (np.maximum.reduceat(c, at), np.minimum.reduceat(s, at), np.maximum.reduceat(s, at))
        while True:
            self.levels.append(level)
            if len(level[1]) == 1:
                break
            at = np.arange(0, len(level[1]), FANOUT)
            level = (np.maximum.reduceat(level[0], at), np.minimum.reduceat(level[1], at), np.maximum.reduceat(level[2], at))

    def leaf_pairs(self, percent: int):
        """Pairs (i <= j) of leaves that may hold linked points."""
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            depth, i, j = stack.pop()
            upper, least, most = self.levels[depth]
            if 100 * most[i] < percent * least[j] or 100 * most[j] < percent * least[i]:
                continue
            if (100 + percent) * int(np.minimum(upper[i], upper[j]).sum()) < percent * int(least[i] + least[j]):
                continue
            if depth == 0:
                yield i, j
                continue
            below = len(self.levels[depth - 1][1])
            for x in range(i * FANOUT, min((i + 1) * FANOUT, below)):
                stack.extend((depth - 1, x, y) for y in range(max(x, j * FANOUT) if i == j else j * FANOUT, min((j + 1) * FANOUT, below)))


def _points(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Group counts and sizes."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(m), sizes)
    group = (np.concatenate(sets) & np.uint64(GROUPS - 1)).astype(np.int64)
    return np.bincount(owner * GROUPS + group, minlength=m * GROUPS).reshape(m, GROUPS).astype(np.int32), sizes


def _verified(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    if len(s) > len(t):
        s, t = t, s
    at = np.minimum(np.searchsorted(t, s), len(t) - 1)
    return linked(int((t[at] == s).sum()), len(s), len(t), percent)


def count_links(sets: list[np.ndarray], tile: list[int], leads: list[list[int]], copies: list[int], lead: int, percent: int = PERCENT) -> np.ndarray:
    """For each set how many rows of others it is linked with, over the pairs that are counted
    here: of two different tiles (of one, if there is only one) and with ``lead`` as the least
    of the leads of both."""
    counts, sizes = _points(sets)
    side, of = np.array(tile), [set(x) for x in leads]
    one, out, tree = len(set(tile)) == 1, np.zeros(len(sets), dtype=np.int64), CountTree(counts, sizes)
    for i, j in tree.leaf_pairs(percent):
        a, b = tree.order[i * LEAF:(i + 1) * LEAF], tree.order[j * LEAF:(j + 1) * LEAF]
        ok = (100 + percent) * np.minimum(counts[a][:, None], counts[b][None]).sum(axis=2) >= percent * (sizes[a][:, None] + sizes[b][None])
        if not one:
            ok &= side[a][:, None] != side[b][None]
        if i == j:
            ok &= np.triu(np.ones_like(ok), 1)
        for x, y in zip(*np.nonzero(ok)):
            p, q = int(a[x]), int(b[y])
            if min(of[p] & of[q]) == lead and _verified(sets[p], sets[q], percent):
                out[p] += copies[q]
                out[q] += copies[p]
    return out


def link(sets: list[np.ndarray], percent: int = PERCENT, known: list[int] | None = None) -> list[tuple[int, int]]:
    """Linked pairs (positions) that connect all links among ``sets`` (a spanning forest); sets
    with the same ``known`` root count as connected."""
    counts, sizes = _points(sets)
    at_root: dict[int, int] = {}
    parent = [at_root.setdefault(r, i) for i, r in enumerate(known or range(len(sets)))]

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    tree, out = CountTree(counts, sizes), []
    for i, j in tree.leaf_pairs(percent):
        a, b = tree.order[i * LEAF:(i + 1) * LEAF], tree.order[j * LEAF:(j + 1) * LEAF]
        if len({find(x) for x in a} | {find(x) for x in b}) == 1:
            continue
        bound = np.minimum(counts[a][:, None], counts[b][None]).sum(axis=2)
        ok = (100 + percent) * bound >= percent * (sizes[a][:, None] + sizes[b][None])
        if i == j:
            ok &= np.triu(np.ones_like(ok), 1)
        for x, y in zip(*np.nonzero(ok)):
            p, q = int(a[x]), int(b[y])
            if find(p) == find(q):
                continue
            if _verified(sets[p], sets[q], percent):
                parent[find(p)] = find(q)
                out.append((p, q))
    return out


def _sketch(docs: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each hash bucket over all documents: ``2**SKETCH_BITS`` numbers, whatever the input."""
    def run(b: pa.RecordBatch) -> dict:
        make = Shingler(size)
        seen = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for t in b.column("text").to_pylist():
            np.add.at(seen, (make(t) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        at = np.flatnonzero(seen)
        return {"bucket": at, "n": seen[at]}

    rows = map_batches(docs.select("text"), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    out[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


def _leads(token: DataFrame) -> DataFrame:
    """The shingles of two nodes or more, with the least of them."""
    return token.groupBy("token").agg(F.min("node").alias("lead"), F.max("node").alias("top")).where("lead < top").select("token", "lead")


def _sharing(live: DataFrame, need: DataFrame, prune: bool = False) -> DataFrame:
    """The nodes that hold at least ``need`` shingles shared with others, with these shingles:
    (token, node) rows. ``prune`` keeps, of a node's k shared shingles, only the k - need + 1 that
    the fewest nodes hold. Of need shingles that a linked pair shares the least in that order is then
    kept by both, but no second one need be: prune once, as the last step."""
    held = live.join(live.groupBy("token").agg(F.count("*").alias("held")).where("held > 1"), "token").join(need, "node")
    mine = Window.partitionBy("node")
    kept = held.withColumn("k", F.count("*").over(mine)).where("k >= need")
    if prune:
        kept = kept.withColumn("place", F.row_number().over(mine.orderBy("held", "token"))).where("place <= k - need + 1")
    return kept.select("token", "node")


def _blocks(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: a row per row of ``docs`` (doc_id, a, b, node, n), the members of the blocks
    (lead, node), the sets of these (node, shingles). Two linked sets share a block."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"), "text")
    counts = docs.sparkSession.sparkContext.broadcast(_sketch(keyed, size))

    def signature(b: pa.RecordBatch) -> dict:
        make = Shingler(size)
        node, n, need, tokens = [], [], [], []
        for t in b.column("text").to_pylist():
            s = make(t)
            n.append(len(s))
            need.append(least_shared((percent * len(s) + 99) // 100))     # the smallest partner's
            node.append(node_of(s) if len(s) else None)
            rare = np.argsort(counts.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
            tokens.append(s[rare[:prefix_length(len(s), percent)]].view(np.int64) if len(s) else None)
        return {"doc_id": b.column("doc_id"), "a": b.column("a"), "b": b.column("b"), "node": node, "n": n, "need": need, "tokens": tokens}

    rows = cut_lineage(map_batches(keyed, signature, "doc_id long, a long, b long, node long, n long, need int, tokens array<long>"), "shingle-sets")
    token = rows.where("node IS NOT NULL").select("node", F.explode("tokens").alias("token"))
    live = cut_lineage(token.join(_leads(token).select("token"), "token").distinct(), "shared-shingles")
    need = rows.select("node", "need").distinct()
    for prune in (False, True):
        live = cut_lineage(_sharing(live, need, prune), "shared-shingles")
    member = cut_lineage(live.join(_leads(live), "token").select("lead", "node").distinct(), "blocks")

    # the sets of the nodes in blocks, made again from one text each
    where = rows.join(member.select("node").distinct(), "node").groupBy("node").agg(F.min(F.struct("a", "b")).alias("k")).select("k.a", "k.b")
    where = broadcast_if_small(cut_lineage(where, "block-texts"))

    def again(b: pa.RecordBatch) -> dict:
        make = Shingler(size)
        got = [make(t) for t in b.column("text").to_pylist()]
        return {"node": [node_of(s) for s in got], "shingles": [s.tobytes() for s in got]}

    sets = cut_lineage(map_batches(keyed.join(where, ["a", "b"]).select("text"), again, "node long, shingles binary").dropDuplicates(["node"]), "block-sets")
    return rows, member, sets


def _tiles(member: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How many tiles each block of more than one has, and each member's tile (lead, node, i, tiles)."""
    tiles = broadcast_if_small(cut_lineage(member.groupBy("lead").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")).where("tiles > 1"), "tiles"))
    tile = F.when(F.col("tiles").isNull(), 0).otherwise(F.pmod(F.xxhash64("node"), F.col("tiles"))).cast("int")
    return tiles, member.join(tiles, "lead", "left").select("lead", "node", tile.alias("i"), "tiles")


def _components(rows: DataFrame, member: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``rows`` of ``_blocks`` with the component's root."""
    # a block is dealt in tiles, each with the block's lead
    tiles, home = _tiles(member)
    leads = tiles.select("lead", F.col("lead").alias("node"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("i"))
    first = home.select("lead", "node", "i").unionByName(leads).distinct().withColumn("root", F.col("node"))

    def join_group(t: pa.Table) -> dict | None:
        nodes = t.column("node").to_pylist()
        found = link([np.frombuffer(x, dtype=np.uint64) for x in t.column("shingles").to_pylist()], percent, t.column("root").to_pylist()) if len(nodes) > 1 else []
        return {"a": [nodes[p] for p, _ in found], "b": [nodes[q] for _, q in found]} if found else None

    def links(groups: DataFrame, keys: list[str]) -> DataFrame:
        return cut_lineage(map_sorted_groups(groups.join(sets, "node"), keys, join_group, "a long, b long"), "links")

    edges = links(first, ["lead", "i"])
    roots = cut_lineage(components(edges), "roots")
    # what is not connected with its lead yet meets the whole block; two sets that both are need no comparison
    told = home.where("tiles IS NOT NULL").join(broadcast_if_small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    told = cut_lineage(told, "tiled")
    told = told.join(broadcast_if_small(cut_lineage(told.where("node = lead").select("lead", F.col("root").alias("lead_root")), "lead-roots")), "lead")
    late = told.where("root <> lead_root")
    parts = cut_lineage(late.groupBy("lead").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts")), "late-parts")
    if parts.limit(1).count():
        part = F.pmod(F.xxhash64(F.lit(1), "node"), F.col("parts")).cast("int")
        parts = broadcast_if_small(parts)
        asked = late.join(parts, "lead").select("lead", "node", "root", part.alias("j"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("i"))
        whole = told.join(parts, "lead").select("lead", "node", "root", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"), "i")
        edges = edges.unionByName(links(asked.unionByName(whole).distinct(), ["lead", "i", "j"]))
        roots = cut_lineage(components(edges), "roots")
    roots = broadcast_if_small(roots)
    return rows.select("doc_id", "a", "b", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def sets_and_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs(doc_id, text)`` -> a row per row: doc_id, a, b (two hashes of the text), n, root
    (the component's id among nodes; NULL for an empty set)."""
    return _components(*_blocks(docs, size, percent), percent).select("doc_id", "a", "b", "n", "root")


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_shingles, component_id, a row per row."""
    return _named(cut_lineage(sets_and_components(docs, size, percent), "components"))


def link_counts(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_shingles, component_id and n_links, a row per row: how many
    other rows it is linked with (equal texts and repeated rows count each; 0 for an empty set)."""
    rows, member, sets = _blocks(docs, size, percent)
    rooted = cut_lineage(_components(rows, member, sets, percent), "components")
    copies = cut_lineage(rows.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies")), "copies")
    leads = member.groupBy("node").agg(F.collect_list("lead").alias("leads"))      # no more than its prefix has shingles
    full = cut_lineage(sets.join(leads, "node").join(copies, "node"), "counted-sets")
    _, home = _tiles(member)
    many = F.coalesce("tiles", F.lit(1))
    # tiles i < j meet as (i, j), and a tile meets itself as (i, i)
    dealt = home.select("lead", "node", F.col("i").alias("tile"), F.explode(F.sequence(F.lit(0), many - 1)).alias("other"))
    dealt = dealt.select("lead", "node", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))

    def count_group(t: pa.Table) -> dict | None:
        nodes = t.column("node").to_pylist()
        if len(nodes) < 2 or (t.column("i")[0] != t.column("j")[0] and len(set(t.column("tile").to_pylist())) < 2):
            return None
        got = count_links([np.frombuffer(x, dtype=np.uint64) for x in t.column("shingles").to_pylist()], t.column("tile").to_pylist(),
                          t.column("leads").to_pylist(), t.column("copies").to_pylist(), t.column("lead")[0].as_py(), percent)
        at = np.flatnonzero(got)
        return {"node": [nodes[k] for k in at], "links": got[at]} if len(at) else None

    found = map_sorted_groups(dealt.join(full, "node"), ["lead", "i", "j"], count_group, "node long, links long")
    total = cut_lineage(copies.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
                        .select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")).where("n_links > 0"), "link-counts")
    with_links = rooted.join(broadcast_if_small(total), "node", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long"))
    return _named(with_links, "n_links")


def _named(rows: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_shingles, component_id (and ``more``) of rows with their component's root."""
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).where("rows > 1").select("root", "least")
    least = broadcast_if_small(cut_lineage(least, "least-ids"))      # a row alone in its component is its own least
    return rows.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), *more)


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` (all columns) with one row of each component: the one with the smallest doc_id (a
    NULL id last, then the text's hashes); rows with an empty set all stay."""
    ids = pick(docs, doc_id="long", text="string")
    rows = cut_lineage(sets_and_components(ids, size, percent).where("root IS NOT NULL"), "components")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "a", "b")
    keeper = rows.groupBy("root").agg(F.min(row).alias("keep"), F.count("*").alias("rows")).where("rows > 1").select("root", "keep")
    keeper = broadcast_if_small(cut_lineage(keeper, "keepers"), BROADCAST_ROWS // 4)
    gone = cut_lineage(rows.join(keeper, "root").where(~row.eqNullSafe(F.col("keep"))).select(F.col("doc_id").alias("_voltframe_id"), F.col("a").alias("_voltframe_a"), F.col("b").alias("_voltframe_b")).distinct(), "near-copies")
    twice = cut_lineage(rows.groupBy("doc_id", "a", "b").count().where("count > 1").select(F.col("doc_id").alias("_voltframe_id"), F.col("a").alias("_voltframe_a"), F.col("b").alias("_voltframe_b")), "repeated-rows")
    keyed = docs.withColumns({"_voltframe_vid": F.col("doc_id").cast("long"), "_voltframe_va": F.xxhash64(F.col("text").cast("string")), "_voltframe_vb": F.xxhash64(F.lit(1), F.col("text").cast("string"))})
    same = F.col("_voltframe_vid").eqNullSafe(F.col("_voltframe_id")) & (F.col("_voltframe_va") == F.col("_voltframe_a")) & (F.col("_voltframe_vb") == F.col("_voltframe_b"))
    kept = keyed.join(broadcast_if_small(gone), same, "left_anti")
    if twice.limit(1).count():
        kept = (kept.join(broadcast_if_small(twice), same, "left_anti")
                .unionByName(kept.join(broadcast_if_small(twice), same, "left_semi").dropDuplicates(["_voltframe_vid", "_voltframe_va", "_voltframe_vb"])))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(pick(table(spark, sf_dir, "documents"), doc_id="long", text="string"))


ORACLE_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
r AS (SELECT doc_id, doc_id AS m FROM d UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.doc_id WHERE r.m < e.b),
k AS (SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id)
SELECT k.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id FROM k LEFT JOIN n USING (doc_id)"""
