"""URL filters: rules, then a path-template tree per host (operator 2).

Rules (host, path, verdict) come first: one fits its host and all subdomains when the URL's path
starts with the rule's path; the longest wins.  Every other URL is judged by its template.

The tree is built level by level from counts until no path has a further segment; a leaf alone in
its node takes its remaining levels at once.  Under each node a segment stays literal when it has
a non-digit and ``min_count`` URLs, and either ``min_count`` labels, or as many URLs as the root
of the node's, or ``min_share`` of them; all others become the wildcard ``*``.  Siblings are then put in order of
smoothed label rates, and a sibling that a two-proportion test (2 sigma) cannot tell from the
labelled one before it (nor, with SURE labels, from the branch so far) joins its branch, so thin branches borrow each other's labels; one without
labels joins the branch before its place and ties no two branches together.  A node's bad rate is
(bad + strength * parent rate) / (labelled + strength), from the corpus rate down; a template is
blocked when its rate of good labels, so smoothed, is under ``min_purity``.  A path ends with an
empty segment.  Nodes are told apart by their parent and the number of their branch; the template shown is made of
names, in which a literal ``|``, ``*`` or ``\\`` has a backslash, and a branch of more than NAMES segments shows its first and
their number.

Cases: null or no ``://`` gives empty host and path, which form a host like any other; null
labels are unlabelled; repeated rows each count; without any label everything is allowed;
empty tables give no rows; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import ascii_lower, let, small, stash

#: the contract's rules: (host, path, verdict) - fixed values
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
ANY = "*"
END = ""
#: labels from which a sibling and its branch so far are compared as a whole
SURE = 30
#: the most segments that a branch's name spells out
NAMES = 64


def parts(url: Column) -> Column:
    """struct(host, path) of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))

    def cut(r):
        host = F.regexp_extract(r, "^[^/?#]*", 0)
        return F.struct(ascii_lower(host).alias("host"),
                        F.regexp_extract(F.substr(r, F.length(host) + 1), "^[^?#]*", 0).alias("path"))

    return let(F.coalesce(rest, F.lit("")), cut)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null; rules are a short list."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda x: x != "")


def shown(segment: Column) -> Column:
    """A literal segment as part of a name: never the wildcard, never two segments."""
    return F.regexp_replace(segment, r"([\\|*])", r"\\$1")


def branch_starts(sib: DataFrame) -> DataFrame:
    """From labelled siblings (host, node, rate, l, b): (host, node, starts), where the second and
    later branches begin in order of rate.  Each sibling is held against the one before it and, when both
    have SURE labels, against its whole branch so far, so that no chain of thin siblings ties two
    known rates; siblings of equal counts are one entry, so a node's entries stay few."""
    entries = sib.groupBy("host", "node", "rate", "l", "b").agg(F.count("*").cast("double").alias("c"))
    lists = entries.groupBy("host", "node").agg(F.sort_array(F.collect_list(F.struct("rate", "l", "b", "c"))).alias("e"))

    def differ(pl, pb, ln, bn):
        d = bn * pl - pb * ln
        return d * d * (pl + ln) > 4.0 * (pb + bn) * (pl + ln - pb - bn) * pl * ln

    def step(a, x):
        ln, bn = x["l"].cast("double"), x["b"].cast("double")
        known = (ln >= SURE) & (a["l"] >= SURE)
        apart = differ(a["pl"], a["pb"], ln, bn) | (known & differ(a["l"], a["b"], ln, bn))
        key = F.struct(x["rate"].alias("rate"), x["l"].alias("l"), x["b"].alias("b"))
        return F.struct(ln.alias("pl"), bn.alias("pb"), (F.when(apart, 0.0).otherwise(a["l"]) + ln * x["c"]).alias("l"),
                        (F.when(apart, 0.0).otherwise(a["b"]) + bn * x["c"]).alias("b"),
                        F.when(apart, F.concat(a["starts"], F.array(key))).otherwise(a["starts"]).alias("starts"))

    first = F.struct(*[F.lit(0.0).alias(c) for c in ("pl", "pb", "l", "b")],
                     F.array().cast("array<struct<rate:double,l:bigint,b:bigint>>").alias("starts"))
    return lists.select("host", "node", F.aggregate("e", first, step)["starts"].alias("starts"))


def template_verdicts(urls: DataFrame, min_share: float = 0.05, min_count: int = 3,
                      strength: float = 5.0, min_purity: float = 0.5) -> DataFrame:
    """From (host, segs, bad) rows: (host, segs, template, bad_rate, verdict) for each distinct path."""
    leaf = stash(urls.groupBy("host", "segs").agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    total = leaf.agg(F.sum("labelled"), F.sum("bad")).first()
    labelled, bad = int(total[0] or 0), int(total[1] or 0)
    hosts = stash(leaf.groupBy("host").agg(F.sum("labelled").alias("hl"), F.sum("bad").alias("hb"), F.sum("n").alias("up_n"),
                                           F.count("*").alias("up_k")))
    top = bad / labelled if labelled else 0.0
    tree = stash(leaf.join(small(hosts, hosts.count()), "host").withColumns({"node": F.lit(""), "name": F.lit("")})
                 .withColumn("up_rate", (F.col("hb") + strength * F.lit(top)) / (F.col("hl") + strength)).drop("hl", "hb"))
    out, level = None, 0
    while True:
        ended = F.size("segs") < level
        over = alone(tree.filter(ended | (F.col("up_k") == 1)), level, min_count, strength)
        out = over if out is None else out.unionByName(over)
        tree = tree.filter(~ended & (F.col("up_k") > 1))
        if tree.isEmpty():
            break
        tree, level = grown(tree, level, min_share, min_count, strength), level + 1
    verdict = F.when(1.0 - F.col("bad_rate") < min_purity, "block").otherwise("allow")
    return out.withColumn("verdict", verdict)


def alone(tree: DataFrame, level: int, min_count: int, strength: float) -> DataFrame:
    """Leaves with no other in their node, or that ended: the remaining levels of each in one fold."""
    left = F.when(F.size("segs") < level, F.array().cast("array<string>")).otherwise(
        F.concat(F.slice("segs", level + 1, F.greatest(F.size("segs") - level, F.lit(0))), F.array(F.lit(END))))

    def step(a, x):
        literal = (x == END) | ((F.col("n") >= min_count) & x.rlike("[^0-9]"))
        return F.struct(F.concat(a["name"], F.lit("/"), F.when(literal, shown(x)).otherwise(ANY)).alias("name"),
                        ((F.col("bad") + strength * a["rate"]) / (F.col("labelled") + strength)).alias("rate"))

    end = F.aggregate(left, F.struct(F.col("name"), F.col("up_rate").alias("rate")), step)
    return tree.withColumn("end", end).select("host", "segs", F.col("end.name").alias("template"), F.col("end.rate").alias("bad_rate"))


def grown(tree: DataFrame, level: int, min_share: float, min_count: int, strength: float) -> DataFrame:
    """``tree`` with each leaf one level further down."""
    tree = tree.withColumn("seg", F.coalesce(F.get("segs", F.lit(level)), F.lit(END)))
    kids = tree.groupBy("host", "node", "seg").agg(
        F.sum("n").alias("kn"), F.sum("labelled").alias("kl"), F.sum("bad").alias("kb"), F.count("*").alias("kk"),
        F.first("up_n").alias("up_n"), F.first("up_rate").alias("up_rate"))
    own = (F.col("kn") >= F.col("up_n") * min_share) | (F.col("kl") >= min_count) | (F.col("kn") >= F.sqrt("up_n"))
    literal = (F.col("seg") == END) | ((F.col("kn") >= min_count) & own & F.col("seg").rlike("[^0-9]"))
    kids = stash(kids.withColumn("t", F.when(literal, shown(F.col("seg"))).otherwise(ANY)))
    sib = kids.groupBy("host", "node", "t").agg(
        F.sum("kn").alias("n"), F.sum("kl").alias("l"), F.sum("kb").alias("b"), F.sum("kk").alias("k"), F.first("up_rate").alias("up_rate"))
    sib = sib.withColumn("rate", (F.col("b") + strength * F.col("up_rate")) / (F.col("l") + strength))
    cuts = branch_starts(sib.filter("l > 0"))
    at = F.struct("rate", "l", "b")
    sib = stash(sib.join(cuts, ["host", "node"], "left").withColumn(
        "branch", F.coalesce(F.size(F.filter("starts", lambda x: x <= at)), F.lit(0))).drop("starts"))
    merged = sib.groupBy("host", "node", "branch").agg(
        F.sum("n").alias("m_n"), F.sum("l").alias("m_l"), F.sum("b").alias("m_b"), F.sum("k").alias("m_k"), F.first("up_rate").alias("m_up"),
        F.count("*").alias("m_t"), F.min("t").alias("m_first"))
    few = sib.join(merged.filter(F.col("m_t") <= NAMES).select("host", "node", "branch"), ["host", "node", "branch"])
    named = few.groupBy("host", "node", "branch").agg(F.concat_ws("|", F.sort_array(F.collect_list("t"))).alias("all"))
    names = F.coalesce("all", F.concat("m_first", F.lit("|+"), F.col("m_t") - 1))
    merged = (sib.select("host", "node", "branch", "t").join(merged.join(named, ["host", "node", "branch"], "left"), ["host", "node", "branch"])
              .withColumns({"to": F.concat("node", F.lit("/"), F.col("branch").cast("string")), "as": names})
              .withColumn("m_rate", (F.col("m_b") + strength * F.col("m_up")) / (F.col("m_l") + strength)))
    # every distinct segment's new node, joined back to the leaves below it
    step = (kids.select("host", "node", "seg", "t").join(merged, ["host", "node", "t"])
            .select("host", "node", "seg", "to", "as", "m_n", "m_k", "m_rate"))
    return stash(tree.drop("up_n", "up_k", "up_rate").join(step, ["host", "node", "seg"])
                 .withColumn("name", F.concat("name", F.lit("/"), "as")).drop("node", "seg", "as")
                 .withColumnsRenamed({"to": "node", "m_n": "up_n", "m_k": "up_k", "m_rate": "up_rate"}))


def judge_urls(pages: DataFrame, rules=RULES, **tree) -> DataFrame:
    """``pages``: page_id, url, bad (1, 0 or null).  Returns page_id, host, path, rule, verdict,
    template, bad_rate for every row."""
    rows = (pages.select("page_id", "bad", parts(F.col("url")).alias("u"))
            .select("page_id", "bad", "u.host", "u.path")
            .withColumn("segs", segments(F.col("path"))))
    rows = stash(rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)))
    by = template_verdicts(rows.select("host", "segs", "bad"), **tree).withColumnRenamed("verdict", "tv")
    return (rows.join(by, ["host", "segs"])
            .select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                    F.coalesce(F.col("r.verdict"), F.col("tv")).alias("verdict"), "template", "bad_rate"))


def shown_document(url: Column) -> Column:
    """The number that ends a URL's path: the id of the document that the page shows."""
    return F.regexp_extract(
        parts(url)["path"], r"([0-9]+)(\.html)?/?$", 1).try_cast("long")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, url, bad: 1 when the page's document is labelled toxic or of low quality."""
    worst = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)).alias("bad"))
    p = pages.select("page_id", "url", shown_document(F.col("url")).alias("shown"))
    return p.join(worst, p["shown"] == worst["doc_id"], "left").select("page_id", "url", "bad")
