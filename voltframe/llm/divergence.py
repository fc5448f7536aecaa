"""Operator 12: how far the sources of a language lie apart, and by which terms.

Terms that occur in at least ``LEAST_DOCS`` documents of a language are kept; every (lang, source)
group and every language gives each kept term a smoothed share p (an integer, all arithmetic exact).
Part ``pair`` is the sum of |p - q| over all kept terms for each ordered pair of sources of a
language, part ``term`` the kept terms that a group uses more than its language.

Method (Gustavson row accumulation): the counts are a sparse matrix, groups x terms. Cut by
language and a hash of the term, a task holds a range of terms as a term-major index. Row by row, a
group scatters its terms through that index into a dense accumulator with one place per peer; no
pair of postings is ever emitted. A scattered term corrects the sum for the terms that both use;
what one or neither uses has the other's zero baseline b (the p of a count of 0), so with g, h the
sets of terms used

    sum |p - q| = sum over g of |p - b_h| + sum over h of |q - b_g| + (V - |g| - |h|) |b_g - b_h|
                  + sum over both of (|p - q| - |p - b_h| - |q - b_g| + |b_g - b_h|)

and the first two sums come from each group's sorted p. The accumulators of all ranges are added up
by an aggregate. A language of many sources is cut by rows too, so that a task's accumulators stay
within ``CELLS``. A hot source or language is spread by the hash of the term; terms are cut and
counted over the bytes of many texts at once, and summed in each map task before any shuffle.

Defined results: NULL text, lang and source are ''; rows that repeat count each; a language without
a kept term has pairs with value 0 and no terms; a language with one source has no pairs; an empty
table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltframe.llm.common import broadcast_if_light, cut_lineage, map_sorted_groups, pick, table

LEAST_DOCS, ALPHA, ONE, TOP = 30, 5, 1_000_000_000, 50
#: Bytes of rows that a task counts at once, counts that one range of terms holds at least, about,
#: and places of one task's accumulators.
HELD, RANGE, CELLS = 8 << 20, 1 << 16, 1 << 22

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: The same by bytes of UTF-8.
_LOWER_BYTE = np.arange(256, dtype=np.uint8)
_LOWER_BYTE[ord("A"):ord("Z") + 1] += 32
_IN_TERM = (np.arange(256) >= 128) | ((_LOWER_BYTE >= ord("a")) & (_LOWER_BYTE <= ord("z")))


def terms(text: str) -> list[str]:
    """A text's terms, as defined; the queries cut whole batches by ``split``."""
    return _TERM.findall(text.translate(_LOWER))


def split(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The terms of all texts, one after another, and the place of each one's text: as ``terms``, but
    cut at once, since a term is a run of those bytes in UTF-8 that are a letter's or not ASCII."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    inside = _IN_TERM[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = ends[ends < len(raw)]
    first[begins] = inside[begins]
    letters = _LOWER_BYTE[raw[inside]]
    start = np.append(np.flatnonzero(first[inside]), len(letters)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(start) - 1, pa.py_buffer(start), pa.py_buffer(letters))
    return words, np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(np.flatnonzero(first), ends)))


def count_rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Occurrences and documents per (lang, source, term) of some rows; a NULL term per group. One
    sort of (group, term, row) brings the occurrences to be counted together."""
    lang, source, text = (pa.concat_arrays([b.column(c).cast(pa.string()) for b in held]) for c in ("lang", "source", "text"))
    lang, source, (words, row) = lang.dictionary_encode(), source.dictionary_encode(), split(text)
    words, sources, rows = words.dictionary_encode(), len(source.dictionary), len(text)
    size = max(len(words.dictionary), 1)
    groups, group = np.unique(lang.indices.to_numpy().astype(np.int64) * sources + source.indices.to_numpy(), return_inverse=True)

    seen = np.sort((group[row] * size + words.indices.to_numpy()) * rows + row)
    of_term = seen // rows
    first = np.flatnonzero(np.diff(of_term, prepend=-1))
    n = np.diff(first, append=len(seen))
    docs = np.add.reduceat(np.diff(seen, prepend=-1) != 0, first, dtype=np.int64)
    g, t = np.divmod(of_term[first], size)
    of, none = np.concatenate([groups, groups[g]]), np.zeros(len(groups), np.int64)
    return pa.RecordBatch.from_arrays([
        lang.dictionary.take(pa.array(of // sources)), source.dictionary.take(pa.array(of % sources)),
        pa.concat_arrays([pa.nulls(len(groups), pa.string()), words.dictionary.take(pa.array(t))]),
        pa.array(np.concatenate([none, n])), pa.array(np.concatenate([none, docs]))], names=["lang", "source", "term", "n", "docs"])


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``count_rows`` over a task's batches, as many at once as ``HELD`` bytes hold, or one."""
    held, size = [], 0
    for b in batches:
        if held and size + b.nbytes > HELD:
            yield count_rows(held)
            held, size = [], 0
        if b.num_rows:
            held.append(b)
            size += b.nbytes
    if held:
        yield count_rows(held)


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs; a row with a NULL term for each group that occurs."""
    read = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    part = read.mapInArrow(count_batches, "lang string, source string, term string, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, terms_kept: str):
    """1 + floor(ONE * (n + ALPHA) / (total + ALPHA * terms_kept)), by whole decimals."""
    whole = lambda c: f"cast({c} as decimal(20, 0))"
    return F.expr(f"cast(1 + (cast({ONE} as decimal(10, 0)) * ({whole(n)} + {ALPHA}) div ({whole(total)} + {ALPHA} * {whole(terms_kept)})) as long)")


def accumulate(t: pa.Table) -> dict | None:
    """One range of terms of one language: per row group a dense array of partial sums, place = peer.

    Rows of kind 0 are the language's groups (``at``, baseline ``p``), others a count's p;
    ``mine`` marks the groups whose rows this task accumulates.
    """
    at, p, head = (t.column(c).to_numpy() for c in ("at", "p", "is_group"))
    words = t.column("term").combine_chunks().dictionary_encode()
    peers = int(at[head].max()) + 1
    base, mine = np.zeros(peers, np.int64), np.zeros(peers, bool)
    base[at[head]] = p[head]
    mine[at[head]] = t.column("mine").to_numpy()[head]
    at, p = at[~head], p[~head]
    names, term = np.unique(words.indices.to_numpy()[~head], return_inverse=True)

    by_term = np.argsort(term, kind="stable")  # the term-major index
    first = np.searchsorted(term[by_term], np.arange(len(names) + 1))
    post_at, post_p = at[by_term], p[by_term]
    by_row = np.argsort(at, kind="stable")
    row = np.searchsorted(at[by_row], np.arange(peers + 1))
    used = np.diff(row)

    def from_base(g: int, bases: np.ndarray) -> np.ndarray:
        """Sum of |p - b| over the terms of group g, for each b."""
        own = np.sort(p[by_row[row[g]:row[g + 1]]])
        total = np.concatenate([[0], np.cumsum(own)])
        below = np.searchsorted(own, bases)
        return bases * below - total[below] + (total[-1] - total[below]) - bases * (len(own) - below)

    rows = np.flatnonzero(mine)
    theirs = np.stack([from_base(h, base[rows]) for h in range(peers)], axis=1)
    out = []
    for k, g in enumerate(rows):
        acc = from_base(g, base) + theirs[k] + (len(names) - used[g] - used) * np.abs(base[g] - base)
        own = by_row[row[g]:row[g + 1]]
        start, length = first[term[own]], first[term[own] + 1] - first[term[own]]
        place = np.repeat(start - np.concatenate([[0], np.cumsum(length)])[:-1], length) + np.arange(length.sum())
        h, q, mine_p = post_at[place], post_p[place], np.repeat(p[own], length)
        np.add.at(acc, h, np.abs(mine_p - q) - np.abs(mine_p - base[h]) - np.abs(q - base[g]) + np.abs(base[g] - base[h]))
        out.append(acc.tolist())
    return {"lang": [t.column("lang")[0].as_py()] * len(rows), "at": rows.tolist(), "sums": out} if len(rows) else None


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, range_size: int = RANGE, cells: int = CELLS) -> DataFrame:
    """``docs(text, lang, source)`` -> lang, source, part, item, value, rank."""
    counts = cut_lineage(counted(docs), "counts")
    of_lang = cut_lineage(counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least_docs).select("lang", "term", "lang_n"), "terms")
    kept = cut_lineage(counts.join(of_lang, ["lang", "term"]).where("n > 0").select("lang", "source", "term", "n", "lang_n"), "kept")

    langs = of_lang.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("used"))
    by_name, whole = Window.partitionBy("lang").orderBy("source"), Window.partitionBy("lang")
    groups = (counts.where("term is null").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
              .na.fill(0, ["total", "used", "v", "lang_total"]).withColumn("at", F.row_number().over(by_name) - 1).withColumn("peers", F.count("*").over(whole)))
    groups = groups.withColumn("ranges", F.ceil(F.greatest(F.sum("used").over(whole), F.lit(1)) / F.greatest(F.lit(range_size), F.col("peers") * F.col("peers"))).cast("int"))
    groups = groups.withColumn("row_blocks", F.ceil(F.col("peers") * F.col("peers") / cells).cast("int"))
    groups = cut_lineage(groups.withColumn("base", F.when(F.col("v") > 0, share("0", "total", "greatest(v, 1)")).otherwise(0)), "groups")

    small = broadcast_if_light(groups)
    cut = F.pmod(F.xxhash64("term"), F.col("ranges")).cast("int")
    p = kept.join(small, ["lang", "source"]).withColumn("p", share("n", "total", "v"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    entries = p.select("lang", cut.alias("cut"), "row_blocks", "at", "p", F.col("term"), F.lit(False).alias("is_group")).withColumn("block", every("row_blocks")).drop("row_blocks").withColumn("mine", F.lit(False))
    heads = (groups.where("peers > 1 and v > 0").withColumn("cut", every("ranges")).withColumn("block", every("row_blocks"))
             .select("lang", "cut", "at", F.col("base").alias("p"), F.lit("").alias("term"), F.lit(True).alias("is_group"), "block", (F.col("at") % F.col("row_blocks") == F.col("block")).alias("mine")))
    dealt = heads.unionByName(entries.join(groups.where("peers > 1").select("lang").distinct(), "lang", "left_semi"))
    sums = map_sorted_groups(dealt, ["lang", "cut", "block"], accumulate, "lang string, at int, sums array<long>")
    added = (sums.select("lang", "at", F.posexplode("sums").alias("peer", "value")).groupBy("lang", "at", "peer").agg(F.sum("value").alias("value")))
    name = groups.select("lang", "at", "source")
    none = groups.where("v = 0").select("lang", "at", "peers").withColumn("peer", every("peers")).select("lang", "at", "peer", F.lit(0).cast("long").alias("value"))
    pairs = (added.unionByName(none).where("at <> peer").join(broadcast_if_light(name), ["lang", "at"])
             .join(broadcast_if_light(name.select("lang", F.col("at").alias("peer"), F.col("source").alias("item"))), ["lang", "peer"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    over = (p.withColumn("q", share("lang_n", "lang_total", "v")).where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = pairs.withColumn("rank", F.row_number().over(order)).unionByName(over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return out.select("lang", "source", "part", "item", "value", "rank")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(pick(table(spark, sf_dir, "documents"), lang="string", source="string", text="string"))


ORACLE_SQL = rf"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
w as (select r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*) as lang_n from w group by lang, term having count(distinct r) >= {LEAST_DOCS}),
langs as (select lang, count(*) as v, sum(lang_n) as total from kept group by lang),
groups as (
  select g.lang, g.source, coalesce(v, 0) as v, coalesce(l.total, 0) as lang_total,
    (select count(*) from w join kept k using (lang, term) where w.lang = g.lang and w.source = g.source) as total
  from (select distinct lang, source from d) g left join langs l on l.lang = g.lang),
n as (select lang, source, term, count(*) as n from w group by all),
p as (
  select g.lang, g.source, k.term, coalesce(n.n, 0) as n,
    1 + ({ONE}::hugeint * (coalesce(n.n, 0) + {ALPHA})) // (g.total + {ALPHA} * g.v) as p,
    1 + ({ONE}::hugeint * (k.lang_n + {ALPHA})) // (g.lang_total + {ALPHA} * g.v) as q
  from groups g join kept k using (lang) left join n using (lang, source, term)),
pair as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all) s
    on s.lang = a.lang and s.source = a.source and s.item = b.source),
term as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value from p where n > 0 and p > q)
select lang, source, part, item, value, rank from (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from (from pair union all from term))
where part = 'pair' or rank <= {TOP}
"""
