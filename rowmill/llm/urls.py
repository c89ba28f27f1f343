"""URL filters: listed rules first, then association rules mined from labelled URLs.

The features of a URL are all its tokens: scheme, top-level domain, domain, host labels above
it and the words in them, words of its path, depth, extension, keys and values of its query,
fragment. Features in too few URLs to block, and those of which no larger share is to block
than of all, are pruned. Features of just the same URLs count as one kind. FP-growth over the
rest finds the combinations in enough such URLs, and those of URLs with more kinds than it can
take are grown level by level; how many labelled URLs have a combination, and how many of
those are to be blocked, is then counted over all kinds, and the confident ones become
rules. They are matched by an inverted index: each rule is listed under its rarest kind
only, and distinct lists of features look their own ones up. All of it is DataFrame work.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.frames import written
from rowmill.operators.joins import spread_lookup

#: URLs to block that a rule must have. So few need a high confidence.
MIN_COUNT = 10
MIN_CONFIDENCE = 0.8
#: Kinds of features that a labelled URL gives to FP-growth, those with the largest share to block;
#: it finds 2**ITEMS sets of each URL at most. What URLs with more have besides is grown by
#: ``longer_sets``; counting and matching go by all features.
ITEMS = 10
_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _AZ, _AZ.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of the (verdict, rule) pairs that fits, and its verdict; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def features(url: Column, host: Column, path: Column) -> Column:
    """The features of a URL, none for a text that is not one."""
    labels = F.split(host, r"\.")
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    pairs = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda p: p != "")
    last = F.get(parts, F.size(parts) - 1)
    above = F.when(F.size(labels) > 2, F.slice(labels, F.lit(1), F.size(labels) - 2)).otherwise(F.array().cast("array<string>"))

    def named(kind: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(kind), v))

    alone = F.array(
        F.concat(F.lit("scheme="), F.regexp_extract(url, "^([A-Za-z]*)://", 1)),
        F.concat(F.lit("top="), F.element_at(labels, -1)),
        F.concat(F.lit("domain="), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")),
        F.concat(F.lit("depth="), F.size(parts).cast("string")),
        F.when(last.rlike(r"\.[A-Za-z0-9]{1,8}$"), F.concat(F.lit("ext="), F.substring_index(last, ".", -1))),
        F.when(url.rlike("#"), F.lit("fragment")),
    )
    found = F.concat(
        F.array_compact(alone),
        named("host=", above),
        named("name=", F.flatten(F.transform(F.filter(above, lambda x: x.rlike("[-_]")), lambda x: F.split(x, "[-_]+")))),
        named("word=", F.split(path, "[-/._~+,;=]+")),
        named("key=", F.transform(pairs, lambda p: F.substring_index(p, "=", 1))),
        named("query=", pairs),
    )
    return F.when(host != "", F.array_sort(F.array_distinct(found))).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, least: int = MIN_COUNT, confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """The rules "kinds, so block" of (features, bad), as (items, anchor, confidence, n_bad), and
    (item, kind) of the features in them.

    Features that just the same labelled rows have are one kind, named by its smallest text; a
    rule fits a URL with any feature of each kind. One kind that only rows to block have is a
    rule by itself, and longer ones with it could add nothing. FP-growth goes over the others
    of the rows to block, ITEMS a row; rows with more of them have the sets that it cannot see
    there found by ``longer_sets``. Ties of the rarest kind go to the smallest text. No labelled
    rows, or none to block, give no rules.
    """
    spark = labelled.sparkSession
    rows = written(labelled.select(F.monotonically_increasing_id().alias("row"), "features", "bad"), "labelled")
    each = rows.select("row", "bad", F.explode("features").alias("item"))
    total = rows.agg(F.count("*").alias("n"), F.count_if("bad").alias("b")).first()
    overall = total["b"] / max(1, total["n"])
    same = [F.bit_xor(F.xxhash64("row", F.lit(k))).alias(f"h{k}") for k in (0, 1)]
    counts = each.groupBy("item").agg(F.count("*").alias("n"), F.count_if("bad").alias("b"), *same)
    common = written(counts.where((F.col("b") >= least) & (F.col("b") / F.col("n") > overall)), "items")
    kinds = written(common.groupBy("n", "b", "h0", "h1").agg(F.min("item").alias("kind"), F.collect_list("item").alias("of")), "kinds")
    members = kinds.select(F.explode("of").alias("item"), "kind")
    mixed = kinds.where("b < n").select(F.col("kind").alias("item"), F.col("b").alias("kb"), F.col("n").alias("kn"))
    rank = F.struct((-F.col("kb") / F.col("kn")).alias("share"), (-F.col("kn")).alias("n"), "item")
    ranked = spread_lookup(each, mixed, ["item"]).groupBy("row", "bad").agg(F.array_sort(F.collect_list(rank))["item"].alias("items"))
    lists = written(ranked.groupBy("items").agg(F.count("*").alias("n"), F.count_if("bad").alias("b")), "lists")

    alone = kinds.where("b = n").select(F.array("kind").alias("items"), F.col("kind").alias("anchor"), F.lit(1.0).alias("confidence"), F.col("b").alias("n_bad"))
    repeated = lists.where("b > 0").select(F.slice("items", 1, ITEMS).alias("items"), F.explode(F.sequence(F.lit(1), "b"))).select("items")
    kept = written(repeated, "transactions")
    size = kept.count()
    if size < least:
        return alone, members
    # half a row less than asked for, so that no rounding of the share can raise it
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / size).fit(kept)
    sets = model.freqItemsets.select(F.array_sort("items").alias("items"))
    beyond = longer_sets(lists, least)
    sets = sets if beyond is None else sets.union(beyond).distinct()
    anchors = (
        sets.select("items", F.explode("items").alias("item"))
        .join(mixed, "item")
        .groupBy("items")
        .agg(F.min(F.struct("kn", "item"))["item"].alias("anchor"))
    )
    found = lists.select(F.col("items").alias("all"), "n", "b", F.explode("items").alias("anchor")).join(written(anchors, "sets"), "anchor")
    counted = (
        found.where(F.size(F.array_except("items", "all")) == 0)
        .groupBy("items", "anchor")
        .agg((F.sum("b") / F.sum("n")).alias("confidence"), F.sum("b").alias("n_bad"))
    )
    return alone.union(counted.where(F.col("confidence") >= confidence)), members


def longer_sets(lists: DataFrame, least: int) -> DataFrame | None:
    """The sets of items of lists longer than ITEMS that ``least`` rows to block have, of (items,
    n, b) with the rows and rows to block of each list; None if no list is so long.

    Sets grow by one item a round, within the lists that have them. A set whose rows are those of
    one with an item less, and one that only rows to block have, is not grown: what holds it
    matches less than the smaller set and is no surer. So sets of the first sort are left out.
    """
    longer = (F.size("items") > ITEMS) & (F.col("b") > 0)
    if lists.where(longer).isEmpty():
        return None
    numbered = lists.select(F.monotonically_increasing_id().alias("list"), "n", "b", longer.alias("longer"), "items")
    held = numbered.select("list", "n", "b", "longer", F.explode("items").alias("last"), F.array().cast("array<string>").alias("head"))
    grown, before = None, None
    while True:
        held = written(held, "held")
        sums = held.groupBy("head", "last").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.max("longer").alias("longer"))
        sets = sums.where(F.col("longer") & (F.col("b") >= least)).select(F.array_append("head", F.col("last")).alias("items"), "n", "b")
        if before is not None:
            without = F.transform("items", lambda x: F.array_remove("items", x))
            smaller = sets.select("items", "n", "b", F.explode(without).alias("part")).join(
                before.select(F.col("items").alias("part"), F.col("n").alias("pn")), "part"
            )
            free = smaller.groupBy("items", "n", "b").agg(F.count("*").alias("parts"), F.min("pn").alias("pn"))
            sets = free.where((F.col("parts") == F.size("items")) & (F.col("pn") > F.col("n"))).select("items", "n", "b")
        sets = written(sets, "grown")
        grown = sets.select("items") if grown is None else grown.union(sets.select("items"))
        before = sets.where("b < n")
        if before.isEmpty():
            return grown
        alive = held.withColumn("items", F.array_append("head", F.col("last"))).join(before.select("items"), "items", "left_semi")
        other = alive.select("list", "head", F.col("last").alias("next"))
        held = alive.join(other, ["list", "head"]).where("last < next").select(
            "list", "n", "b", "longer", F.col("next").alias("last"), F.col("items").alias("head")
        )


def match(shapes: DataFrame, rules: DataFrame, members: DataFrame) -> DataFrame:
    """(features, confidence): for each distinct feature list that a rule fits, the best rule's."""
    used = members.join(rules.select(F.explode("items").alias("kind")).distinct(), "kind", "left_semi")
    each = shapes.select("features", F.explode("features").alias("item"))
    named = spread_lookup(each, used, ["item"]).groupBy("features").agg(F.collect_set("kind").alias("kinds"))
    return (
        named.select("features", "kinds", F.explode("kinds").alias("anchor"))
        .join(rules, "anchor")
        .where(F.size(F.array_except("items", "kinds")) == 0)
        .groupBy("features")
        .agg(F.max("confidence").alias("confidence"))
    )


def judge(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
    label_id: str = "doc_id", least: int = MIN_COUNT, confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """(id, host, path, rule, verdict, confidence) of every URL.

    A listed rule decides where one fits, else the mined ones: ``block`` if one of them
    does, ``allow`` if none. ``labels`` has (``label_id``, quality, toxic); an id with
    quality 0 or toxic 1 in any row is to be blocked, one with neither known counts as not
    labelled. A null URL or one without ``://`` has no host, path or features and is
    allowed. Every input row gets one row; ids may be null or repeated. Other columns are
    left out whatever their names.
    """
    parsed = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select(
        "id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    featured = parsed.select("id", "host", "path", features(F.col("url"), F.col("host"), F.col("path")).alias("features"))
    known = (
        labels.select(F.col(label_id).alias("id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
        .where("id IS NOT NULL AND bad IS NOT NULL")
        .groupBy("id")
        .agg(F.max("bad").alias("bad"))
    )
    mined, members = mine(featured.join(known, "id").where(F.size("features") > 0), least, confidence)
    hit = match(featured.where(F.size("features") > 0).select("features").distinct(), written(mined, "rules"), members)
    rule, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    return spread_lookup(featured, hit, ["features"], "left").select(
        "id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "confidence",
    )
