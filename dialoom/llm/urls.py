"""URL filters: domain rules and learnt path templates, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dialoom.llm.common import discard, stored

#: (host, path, verdict) of the registered query. A rule fits its host and all subdomains.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Segments of a template; the last stands for all that lie below it in longer paths. Names of merged branches and of such tails.
DEPTH, MERGED, TAIL = 8, "**", "***"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substring(u, F.instr(u, "://") + 3, F.length(u))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def segments(path: Column) -> Column:
    """The path's segments with variable ones as wildcards: numbers, hashes, ids, dates; endings are kept."""
    def general(s: Column) -> Column:
        stem = F.regexp_extract(s, r"^(.*?)(\.[A-Za-z]{1,5})?$", 1)
        ending = F.regexp_extract(s, r"^(.*?)(\.[A-Za-z]{1,5})?$", 2)
        variable = stem.rlike(r"^[0-9]+$") | stem.rlike(r"^[0-9a-fA-F-]{8,}$") | (stem.rlike("[0-9]") & (F.length(stem) >= 12)) | stem.rlike(r"^[0-9]{2,4}[-_.][0-9]{1,2}([-_.][0-9]{1,4})?$")
        return F.when(variable, F.concat(F.lit("*"), ending)).otherwise(s)

    whole = F.filter(F.split(path, "/"), lambda s: s != "")
    some = F.transform(F.slice(whole, 1, DEPTH), general)
    return F.when(F.size(whole) > DEPTH, F.concat(F.slice(some, 1, DEPTH - 1), F.array(F.lit(TAIL)))).otherwise(some)


def branches(leaves: DataFrame, least: int, z: float) -> DataFrame:
    """Adds ``template``, ``n_near`` and ``b_near`` to ``leaves(host, segments, n, b)``, going down the tree of each host.

    At each level the branches of a node are compared with their siblings together: one stays by itself if it has no
    siblings, or has at least ``least`` labels and a share of bad ones that differs from theirs by more than ``z`` standard errors
    (or they have fewer labels, so that nothing tells them apart). All others are merged into one wildcard branch,
    whose templates meet at the next level. ``n_near`` and ``b_near`` are the labels of the nearest node, from
    the template itself up to the host, that has ``least`` of them.
    """
    enough = lambda n, b: (F.when(n >= least, n), F.when(n >= least, b))
    root = leaves.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("b").alias("hb"))
    n, b = enough(F.col("hn"), F.col("hb"))
    t = stored(leaves.join(root, "host").select("host", "segments", "n", "b", F.lit("").alias("template"), n.alias("n_near"), b.alias("b_near")), "tree")
    deepest = t.agg(F.max(F.size("segments"))).first()[0] or 0  # at most ``DEPTH``
    for k in range(deepest):
        there = t.withColumn("seg", F.get("segments", F.lit(k)))
        kids = there.where("seg IS NOT NULL").groupBy("host", "template", "seg").agg(F.sum("n").alias("kn"), F.sum("b").alias("kb"))
        all_ = kids.groupBy("host", "template").agg(F.count("*").alias("kids"), F.sum("kn").alias("an"), F.sum("kb").alias("ab"))
        rest_n, rest_b, pooled = F.col("an") - F.col("kn"), F.col("ab") - F.col("kb"), F.try_divide("ab", "an")
        error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), F.col("kn")) + F.try_divide(F.lit(1), rest_n)))
        apart = F.abs(F.try_divide("kb", "kn") - F.try_divide(rest_b, rest_n)) > z * error
        alone = (F.col("kids") == 1) | ((F.col("kn") >= least) & ((rest_n < least) | F.coalesce(apart, F.lit(False))))
        named = stored(kids.join(all_, ["host", "template"]).select("host", "template", "seg", "kn", "kb", F.when(alone, F.col("seg")).otherwise(F.lit(MERGED)).alias("name")), "named")
        nodes = named.groupBy("host", "template", "name").agg(F.sum("kn").alias("nn"), F.sum("kb").alias("nb"))
        named = named.join(nodes, ["host", "template", "name"]).select("host", "template", "seg", "name", "nn", "nb")
        n, b = enough(F.col("nn"), F.col("nb"))
        down = there.join(named, ["host", "template", "seg"], "left").select(
            "host", "segments", "n", "b", F.concat_ws("/", F.nullif("template", F.lit("")), "name").alias("template"), F.coalesce(n, "n_near").alias("n_near"), F.coalesce(b, "b_near").alias("b_near")
        )
        t, before = stored(down, "tree"), t
        discard(before)
    return t


def judge_urls(pages: DataFrame, rules=RULES, labels: DataFrame | None = None, prior_weight: float = 4.0, purity: float = 0.8, least: int = 5, z: float = 1.96) -> DataFrame:
    """page_id, host, path, rule, verdict, template, template_purity.

    The longest fitting rule decides. Other urls are judged by the path templates of their
    host: variable segments become wildcards (what lies below ``DEPTH`` segments is one), and
    branches that the labels don't tell apart are merged, at all levels (``branches``). A template takes the
    labels of its nearest node that has ``least`` of them, up to the host; it is rejected if the
    share of bad ones, smoothed by ``prior_weight`` pages at the overall share, reaches ``purity``. Without
    such a node it is allowed and its purity is the overall share.

    ``labels(page_id, bad boolean)`` are the labelled pages; without it those that a
    rule decides are (bad: blocked). Null urls and urls without ``://`` have an empty host and path and are
    judged alike; repeated rows stay; an empty table gives an empty one. Statistics are summed by
    template before anything else is shuffled, so a host with most of the pages is no single task.
    """
    host, path = parts(F.col("url"))
    d = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("found", rule_for(F.col("host"), F.col("path"), rules)).withColumn("segments", segments(F.col("path")))
    d = d.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("said"), "segments")
    if labels is None:
        known = d.withColumn("bad", F.when(F.col("said").isNotNull(), F.col("said") == "block"))
    else:
        known = d.join(labels.groupBy("page_id").agg(F.max("bad").alias("bad")), "page_id", "left")
    leaves = stored(known.groupBy("host", "segments").agg(F.count("bad").alias("n"), F.count_if("bad").alias("b")), "leaves")
    total = leaves.agg(F.sum("n").alias("tn"), F.sum("b").alias("tb")).first()
    prior = total.tb / total.tn if total.tn else 0.0
    share = F.coalesce((F.col("b_near") + prior_weight * F.lit(prior)) / (F.col("n_near") + prior_weight), F.lit(prior))
    of = branches(leaves, least, z).select("host", "segments", "template", share.alias("template_purity"), F.coalesce((F.col("n_near") >= least) & (share >= purity), F.lit(False)).alias("reject"))
    verdict = F.coalesce("said", F.when(F.col("reject"), "block").otherwise("allow"))
    return d.join(of, ["host", "segments"], "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "template_purity")
