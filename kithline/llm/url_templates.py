"""URL filtering by host rules and a tree of path templates.

Rules come first: a rule is a host suffix and a path prefix; the longest that
fits decides.  Other urls are judged by templates that are learnt per host from
the counts of distinct paths:

1. Level by level, a child of a place stays literal if ``SUPPORT`` pages have it,
   whatever its share of the place and however many siblings it has; the thin rest
   is generalised into wildcards of a few character classes.  A place of fewer
   pages has no literal child at any depth, so the depth follows the data.
2. Siblings - templates of a host that differ in one literal - are merged from the
   deepest place to the first.  Beginning with one group, children whose rate of
   bad labels differs significantly from that of the rest of their group
   (two-proportion test) leave it, those above for one group and those below for
   another, until no group falls into several.
3. A template is rejected if its share of bad labels, smoothed towards its
   host's and this towards the overall share, reaches ``REJECT``.

Counts are summed (with partial sums) and joined; no step gathers or sorts a
host's pages or a place's children.  In a template literals are marked with ``=``;
shown ones have the mark only where they could be taken for something else.

Defined results: a null url, or one without ``://``, has empty host and path and
is judged as the template of the empty host; a very long url is read whole, and so
is a path of any depth; equal counts are not ranked, so there are no ties; repeated
rows are judged alike; no labels mean that all are allowed; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, forget, stored

#: (action, host, path); a rule is shown as host + path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Pages that a literal segment has at least: enough for a share of its own beside the smoothing.
SUPPORT = 10
REJECT = 0.5
SMOOTHING = 10.0
Z = 1.96


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as shown, and its action; nulls where none does."""
    shown, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        shown, action = F.when(fits, F.lit(h + p)).otherwise(shown), F.when(fits, F.lit(act)).otherwise(action)
    return shown, action


def wildcard(segment: Column) -> Column:
    """One of a few classes of segments."""
    named = [("<n>", r"^[0-9]+$"), ("<n.ext>", r"^[0-9]+\.[A-Za-z0-9]{1,5}$"), ("<hex>", r"^[0-9a-fA-F-]{8,}$"), ("<word>", r"^\p{L}+$"), ("<slug>", r"^[\p{L}\p{N}]+([-_.][\p{L}\p{N}]+)+$")]
    out = F.lit("<any>")
    for name, pattern in reversed(named):
        out = F.when(segment.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def segments(path: Column) -> Column:
    return F.array_remove(F.split(path, "/"), "")


def templates(paths: DataFrame) -> DataFrame:
    """Distinct ``paths`` (host, path, n and other columns) with ``template``, an array of marked literals and wildcards."""
    none = F.array().cast("array<string>")
    live = stored(paths.select("*", segments(F.col("path")).alias("segs"), none.alias("template")), "url-level")
    columns, done, level = paths.columns, [], 0
    while True:
        node = F.concat_ws("/", "template")
        keyed = live.withColumns({"node": node, "seg": F.get("segs", F.lit(level))})
        places = stored(keyed.filter("seg IS NOT NULL").groupBy("host", "node").agg(F.sum("n").alias("total")).filter(F.col("total") >= SUPPORT).select("host", "node", F.lit(True).alias("grown")), "url-places")
        if places.isEmpty():
            break
        literal = keyed.filter("seg IS NOT NULL").groupBy("host", "node", "seg").agg(F.sum("n").alias("support")).filter(F.col("support") >= SUPPORT).select("host", "node", "seg", F.lit(True).alias("literal"))
        literal = stored(literal, "url-literals")
        open_rows = keyed.join(places, ["host", "node"], "left").withColumn("grown", F.coalesce("grown", F.lit(False)) & F.col("seg").isNotNull())
        shown = F.when(F.col("literal"), F.concat(F.lit("="), F.col("seg"))).otherwise(wildcard(F.col("seg")))
        grown = stored(open_rows.filter("grown").join(literal, ["host", "node", "seg"], "left").select(*columns, "segs", F.concat("template", F.array(shown)).alias("template")), "url-level")
        done.append(stored(_closed(open_rows.filter("NOT grown"), columns, level), "url-closed"))
        forget(live, places, literal)
        live, level = grown, level + 1
    out = _closed(live, columns, level)
    for part in done:
        out = out.unionByName(part)
    return out


def _closed(rows: DataFrame, columns: list[str], level: int) -> DataFrame:
    """Rows whose segments from ``level`` on are wildcards all."""
    rest = F.transform(F.slice("segs", level + 1, F.greatest(F.size("segs") - level, F.lit(0))), wildcard)
    return rows.select(*columns, F.concat("template", rest).alias("template"))


def shown_template(branch: Column) -> Column:
    """A template as text, where ``=`` marks a literal only if it looks like a wildcard, a merged branch or a mark."""
    element = lambda x: F.when(x.startswith("=") & ~F.substring(x, 2, 1).isin("<", "{", "="), F.substr(x, F.lit(2))).otherwise(x)
    return F.concat(F.lit("/"), F.array_join(F.transform(branch, element), "/"))


def similar_groups(children: DataFrame) -> DataFrame:
    """Of (host, place, own, labelled, bad): the same with ``part``, equal for the siblings whose rates do not differ."""
    now, groups = stored(children.withColumn("part", F.lit("")), "siblings"), 0
    while True:
        pooled = stored(now.groupBy("host", "place", "part").agg(F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad")), "pooled")
        before, groups = groups, pooled.count()
        if groups == before:
            forget(pooled)
            return now
        n, m = F.col("labelled") + 1.0, F.col("all_labelled") - F.col("labelled") + 1.0
        rate, others = (F.col("bad") + 0.5) / n, (F.col("all_bad") - F.col("bad") + 0.5) / m
        both = (rate * n + others * m) / (n + m)
        apart = F.abs(rate - others) > Z * F.sqrt(both * (1 - both) * (1 / n + 1 / m))
        side = F.when(~apart, "=").when(rate > others, "+").otherwise("-")
        moved = stored(now.join(pooled, ["host", "place", "part"]).select(*children.columns, F.concat("part", side).alias("part")), "siblings")
        forget(now, pooled)
        now = moved


def merged(counts: DataFrame) -> DataFrame:
    """Of template counts (host, template, n, labelled, bad): host, template, and the ``branch`` that it is merged into."""
    now = stored(counts.withColumn("branch", F.col("template")), "branches")
    last = F.array_max(F.transform("template", lambda x, i: F.when(x.startswith("="), i + 1).otherwise(0)))
    deepest = now.agg(F.max(last)).first()[0] or 0
    for level in reversed(range(deepest)):
        replaced = lambda own, level=level: F.concat(F.slice("branch", 1, level), F.array(own), F.slice("branch", level + 2, F.size("branch")))
        group = now.filter(F.get("branch", F.lit(level)).startswith("=")).groupBy("host", "branch").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
        children = group.select("host", replaced(F.lit("<?>")).alias("place"), F.get("branch", F.lit(level)).alias("own"), "labelled", "bad")
        parted = similar_groups(children)
        names = parted.groupBy("host", "place", "part").agg(F.min("own").alias("first"), F.count("*").alias("kinds"))
        name = F.when(F.col("kinds") > 1, F.concat(F.lit("{"), F.substr("first", F.lit(2)), F.lit("+"), (F.col("kinds") - 1).cast("string"), F.lit("}"))).otherwise(F.col("own"))
        named = stored(parted.join(stored(names, "names"), ["host", "place", "part"]).select("host", "place", "own", name.alias("turned")), "renamed")
        keyed = now.withColumns({"own": F.get("branch", F.lit(level)), "place": replaced(F.lit("<?>"))})
        turned = keyed.join(named, ["host", "place", "own"], "left").select("host", "template", "n", "labelled", "bad", F.when(F.col("turned").isNull(), F.col("branch")).otherwise(replaced(F.col("turned"))).alias("branch"))
        after = stored(turned, "branches")
        forget(now, parted, named)
        now = after
    return now


def verdicts(counts: DataFrame) -> DataFrame:
    """host, template, branch, share of bad (smoothed) and rejected, of template counts."""
    now = merged(counts)
    all_bad, all_labelled = now.agg(F.sum("bad"), F.sum("labelled")).first()
    overall = (all_bad or 0) / max(1, all_labelled or 0)
    hosts = now.groupBy("host").agg(F.sum("bad").alias("hb"), F.sum("labelled").alias("hl"))
    hosts = hosts.select("host", ((F.col("hb") + SMOOTHING * overall) / (F.col("hl") + SMOOTHING)).alias("prior"))
    branches = now.groupBy("host", "branch").agg(F.sum("bad").alias("bb"), F.sum("labelled").alias("bl"))
    share = (F.col("bb") + SMOOTHING * F.col("prior")) / (F.col("bl") + SMOOTHING)
    judged = branches.join(hosts, "host").select("host", "branch", share.alias("bad_share"))
    return now.join(judged, ["host", "branch"]).select("host", "template", "branch", "bad_share", (F.col("bad_share") >= REJECT).alias("rejected"))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, bad_share of every page.

    ``labels`` has page_id and bad (0 or 1) of some pages.
    """
    given = pages.select("page_id", F.col("url").cast("string").alias("url"))
    rows = given.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).drop("url")
    own = labels.groupBy("page_id").agg(F.max("bad").alias("bad"))
    paths = rows.join(own, "page_id", "left").groupBy("host", "path").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    known = stored(templates(paths), "templates")
    counts = known.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")])
    learnt = verdicts(counts)
    judged = stored(known.select("host", "path", "template").join(learnt, ["host", "template"]).select("host", "path", "branch", "bad_share", "rejected"), "judged")
    forget(known)
    shown, action = fitting_rule(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(action, F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow")))
    joined = rows.join(judged, ["host", "path"], "left")
    return joined.select("page_id", "host", "path", shown.alias("rule"), verdict.alias("verdict"), shown_template(F.col("branch")).alias("template"), F.round("bad_share", 6).alias("bad_share"))
