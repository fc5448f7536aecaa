"""Operator 9: URL filter by a path-template tree.

Method: per host, URL paths form a tree of segments. A segment becomes a wildcard where it is
variable by its form (numbers, dates, hex or long identifiers; a suffix such as ``.html`` stays) or
by its statistics (a node with many children that are mostly seen once). Sibling branches
whose labelled bad rates do not differ from their common rate (two-proportion z below ``Z``) are
merged into one. Each branch's purity is its bad rate, smoothed towards the mean of its host's rate
and of the rate that rules and words give equal templates on other hosts (both towards ``PRIOR``);
a URL is blocked if its branch's purity reaches ``REJECT``. Explicit rules are decided first, the
longest that fits wins.

Labels, per URL (host and path): one that a block rule fits, or that has a word of ``BAD_WORDS`` in its
host or path, is bad; one that an allow rule fits is good. Any other votes with weight ``VOTE`` by its
pages, for bad as far as they are without substance: their text is less than ``TEXT_SHARE`` of the html, most
of it is link text or they have a link per ``LINK_CHARS`` characters of text, or the same html stands
under a smaller URL already. A table without html votes for good.

Everything is a DataFrame aggregate per (host, template, segment): rows are first summed per
(host, path), so a host or path that holds a third of all rows meets in partial sums, and
decisions come back by joins that AQE can split. Levels are built until no node has ``MANY`` paths left
below it: from there on no segment could be widened by its number of siblings.

Defined results: a NULL url or one without ``://`` has an empty host and path and is judged by
the method (its own host ``''``); a NULL page_id stays NULL; repeated rows get a row each; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm.common import broadcast_if_light, cut_lineage, pick, table

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Words of a host that mark it as bad.
BAD_WORDS = ("adult", "bet", "bets", "casino", "malware", "phishing", "pills", "poker", "porn", "sex", "slots", "spam", "viagra", "warez", "xxx")
MANY, SINGLES = 16, 0.5
TEXT_SHARE, LINK_CHARS = 0.1, 40
VOTE, PRIOR, STRENGTH, REJECT, Z = 0.25, 0.1, 4.0, 0.5, 1.96
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; NULL if none does."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _form(seg: Column) -> Column:
    """The segment with its variable part as ``*``, or as it is."""
    stem, suffix = F.regexp_extract(seg, r"(?s)^(.*?)(\.[A-Za-z]{1,5})?$", 1), F.regexp_extract(seg, r"(?s)^(.*?)(\.[A-Za-z]{1,5})?$", 2)
    variable = stem.rlike(r"^(?:[0-9]+|[0-9]{2,4}(?:[-_][0-9]{1,2}){1,2}|(?=.*[0-9])[0-9a-fA-F-]{8,}|(?=.*[0-9]).{16,})$")
    return F.when(variable, F.concat(F.lit("*"), suffix)).otherwise(seg)


def _words(text: Column, words) -> Column:
    return F.coalesce(text.rlike(r"(?:^|[^a-z0-9])(?:" + "|".join(words) + r")(?:$|[^a-z0-9])"), F.lit(False))


def without_substance(html: Column) -> Column:
    """Whether a page's html has hardly any text, or is mostly links. NULL and empty html: yes. One pass over
    the pieces between ``<`` and the next, so the cost is linear in the html, whatever its tags."""
    html = F.coalesce(html, F.lit(""))

    def piece(p, i):
        body = F.when(i == 0, p).when(F.instr(p, ">") > 0, F.substr(p, F.instr(p, ">") + 1)).otherwise(F.lit(""))
        name = F.when(i == 0, F.lit("")).otherwise(F.lower(F.regexp_extract(p, r"^/?[A-Za-z]{1,8}(?![A-Za-z0-9-])", 0)))
        return F.struct(name.alias("name"), F.length(F.regexp_replace(body, r"\s++", "")).alias("n"))

    def step(was, p):
        hidden = F.when(p["name"].isin("script", "style"), F.lit(True)).when(p["name"].isin("/script", "/style"), F.lit(False)).otherwise(was["hidden"])
        link = F.when(hidden, was["link"]).when(p["name"] == "a", F.lit(True)).when(p["name"] == "/a", F.lit(False)).otherwise(was["link"])
        n = F.when(hidden, F.lit(0)).otherwise(p["n"])
        return F.struct(hidden.alias("hidden"), link.alias("link"), (was["text"] + n).alias("text"), (was["linked"] + F.when(link, n).otherwise(F.lit(0))).alias("linked"),
                        (was["links"] + F.when(~hidden & (p["name"] == "a"), F.lit(1)).otherwise(F.lit(0))).alias("links"))

    start = F.struct(F.lit(False).alias("hidden"), F.lit(False).alias("link"), F.lit(0).alias("text"), F.lit(0).alias("linked"), F.lit(0).alias("links"))
    judged = lambda t: (t["text"] == 0) | (t["text"] < TEXT_SHARE * F.length(html)) | (2 * t["linked"] > t["text"]) | (t["links"].cast("long") * LINK_CHARS > t["text"])
    return F.aggregate(F.transform(F.split(html, "<"), piece), start, step, judged)


def templates(urls: DataFrame) -> DataFrame:
    """``urls(host, path, ...)``, one row per host and path -> the same with ``template``
    (an array of segments, wildcards as ``*``) built level by level."""
    names = [c for c in urls.columns]
    segs = F.filter(F.split("path", "/"), lambda s: s != "")
    paths = cut_lineage(urls.withColumn("segs", F.transform(segs, _form)).withColumn("template", F.array().cast("array<string>")), "paths")
    level = 0
    while True:
        # a segment seen once has one path, so its mark joins it exactly, and common segments are dealt by path
        paths = paths.withColumn("seg", F.get("segs", F.lit(level))).withColumn("mark", F.xxhash64("path"))
        child = paths.where("seg IS NOT NULL").groupBy("host", "template", "seg").agg(F.count("*").alias("n"), F.min("mark").alias("mark"))
        node = child.groupBy("host", "template").agg(F.sum("n").alias("below"), F.count("*").alias("children"), F.count_if(F.col("n") == 1).alias("once"))
        node = cut_lineage(node.where(F.col("below") >= MANY).select(F.col("host").alias("_h"), F.col("template").alias("_t"), ((F.col("children") >= MANY) & (F.col("once") >= SINGLES * F.col("children"))).alias("wide")), "nodes")
        if node.isEmpty():
            break
        many = child.join(node.where("wide"), (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t"))).where("n = 1").select("_h", "_t", F.col("seg").alias("_s"), F.col("mark").alias("_m"), "wide")
        paths = (paths.join(many, (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")) & (F.col("seg") == F.col("_s")) & (F.col("mark") == F.col("_m")), "left")
                 .withColumn("seg", F.when(F.col("seg").isNotNull() & F.col("wide").isNotNull(), F.lit("*")).otherwise(F.col("seg")))
                 .withColumn("template", F.when(F.col("seg").isNotNull(), F.concat("template", F.array("seg"))).otherwise(F.col("template")))
                 .select(*names, "segs", "template"))
        paths = cut_lineage(paths, "templates")
        level += 1
    deeper = F.slice("segs", F.lit(level + 1), F.greatest(F.size("segs") - level, F.lit(0)))
    return paths.select(*names, F.concat("template", deeper).alias("template"))


def purities(paths: DataFrame) -> DataFrame:
    """``paths(host, template, bad, good, told)``, ``told``: labelled by a rule or a word -> host,
    template, branch (merged siblings share one), purity."""
    sure = lambda c: F.sum(F.when(F.col("told"), F.col(c)).otherwise(F.lit(0.0)))
    leaf = paths.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), sure("bad").alias("own_bad"), sure("good").alias("own_good"))
    leaf = cut_lineage(leaf.withColumn("parent", F.slice("template", F.lit(1), F.greatest(F.size("template") - 1, F.lit(0)))), "branches")
    family = leaf.groupBy("host", "parent").agg(F.sum("bad").alias("fb"), F.sum("good").alias("fg"))
    smooth = lambda b, g, prior: (b + STRENGTH * prior) / (b + g + STRENGTH)
    home = leaf.groupBy("host").agg(smooth(F.sum("bad"), F.sum("good"), PRIOR).alias("host_rate"))
    shapes = leaf.groupBy("template").agg(F.sum("own_bad").alias("all_bad"), F.sum("own_good").alias("all_good"), F.count("*").alias("hosts")).where("hosts > 1 AND all_bad + all_good > 0")
    shapes = broadcast_if_light(cut_lineage(shapes.select("template", "all_bad", "all_good"), "shapes"))
    n, fn = F.col("bad") + F.col("good"), F.col("fb") + F.col("fg")
    rate = F.col("fb") / fn
    spread = F.sqrt(rate * (1 - rate) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), fn)))
    alike = F.abs(F.col("bad") / n - rate) <= Z * spread
    branch = F.when(alike, F.concat("parent", F.array(F.lit("+")))).otherwise(F.col("template"))
    told = leaf.join(family, ["host", "parent"]).withColumn("branch", branch).join(shapes, "template", "left")
    elsewhere = [F.sum(F.coalesce(F.col(f"all_{c}") - F.col(f"own_{c}"), F.lit(0.0))).alias(f"other_{c}") for c in ("bad", "good")]
    merged = told.groupBy("host", "branch").agg(F.sum("bad").alias("b"), F.sum("good").alias("g"), *elsewhere).join(home, "host")
    prior = (F.col("host_rate") + smooth(F.col("other_bad"), F.col("other_good"), PRIOR)) / 2
    merged = merged.select("host", "branch", smooth(F.col("b"), F.col("g"), prior).alias("purity"))
    return told.select("host", "template", "branch").join(merged, ["host", "branch"])


def labelled(parsed: DataFrame, bad_words=BAD_WORDS) -> DataFrame:
    """``parsed(host, path, _rule, hollow)`` -> host, path, bad, good, told: one row per URL, so that a
    page listed a million times is one URL of its branch."""
    word = _words(F.col("host"), bad_words) | _words(F.translate("path", _UPPER, _LOWER), bad_words)
    urls = parsed.groupBy("host", "path").agg(F.max("_rule.verdict").alias("verdict"), F.avg(F.col("hollow").cast("double")).alias("hollow"))
    sure = F.when(F.col("verdict").isNotNull(), (F.col("verdict") == "block").cast("double")).when(word, 1.0)
    return urls.select("host", "path", F.coalesce(sure, VOTE * F.col("hollow")).alias("bad"), F.coalesce(1 - sure, VOTE * (1 - F.col("hollow"))).alias("good"), sure.isNotNull().alias("told"))


def judge(pages: DataFrame, keep: list[str], rules=RULES, bad_words=BAD_WORDS) -> DataFrame:
    """``pages(url, html, ...)`` -> ``keep`` columns, host, path, rule, verdict, template, purity."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(*keep, host.alias("host"), path.alias("path")).withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    seen = parsed.withColumn("hollow", F.lit(False))
    if "html" in pages.columns:
        # pages are written once as URL, digest and evidence; html itself is not shuffled
        html = F.coalesce("html", F.lit(""))
        seen = cut_lineage(pages.select(host.alias("host"), path.alias("path"), F.sha2(html, 256).alias("digest"), without_substance(html).alias("hollow"))
                           .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)), "page-evidence")
        first = seen.groupBy("digest").agg(F.min(F.struct("host", "path")).alias("first"), F.count("*").alias("n")).where("n > 1")
        seen = seen.join(first, "digest", "left").withColumn("hollow", F.col("hollow") | F.coalesce(F.struct("host", "path") != F.col("first"), F.lit(False)))
    paths = cut_lineage(templates(labelled(seen, bad_words)), "url-templates")
    told = cut_lineage(paths.select("host", "path", "template").join(purities(paths), ["host", "template"]), "url-purities")
    out = parsed.join(told, ["host", "path"], "left")
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return out.select(*keep, "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"), F.concat(F.lit("/"), F.array_join("branch", "/")).alias("template"), "purity")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(pick(table(spark, sf_dir, "pages"), page_id="long", url="string", html="string"), ["page_id"])
