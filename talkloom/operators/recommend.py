"""What to watch next: explicit links and shared tags, scored and ranked.

The relation of *all* talk pairs that share a tag is quadratic in a popular
tag. ``common_tag_pairs`` and ``candidates`` give it whole unless they are asked for
``k`` partners; see ``_all_partners``. A recommendation list needs only the best ``k`` partners of each
talk by (shared tags descending, id ascending), so the relation is not built for it:
these are found exactly from three bounded sources. ``k + 1`` ids are kept where
the reader could be one of them.

1. *Heads*: the ``k + 1`` smallest ids of each tag. A partner sharing one tag
   only and missing from that tag's head is beaten by ``k`` others that share
   the tag and have smaller ids.
2. *Tag subsets*: partners sharing two tags or more meet at a pair of tags. Tags
   are ordered by how often they are used, and a talk enters each of its pairs
   with the rest of its tags after them. Talks with equal rest are
   interchangeable there but for their id, so one group keeps ``k + 1`` of them.
   Up to ``CROWD`` groups are compared with each other. A more crowded pair
   gives the ``k + 1`` smallest ids that hold it, counted by their rests, and
   its talks go on to triples and larger subsets by one of the rest each, until
   few groups are left or none can matter: a partner found at a subset or
   beyond shares no more tags than the subset and the rest hold, so a talk that
   knows ``k`` partners with more stops there (ties go on). A talk that stopped
   still takes part where another talk may need it.
   A partner sharing exactly the tags C is found at the first subset along C
   that few groups hold, with its exact count, or else at C itself, where it is
   among the smallest ids or beaten by ``k`` of them. No count is too high, so
   the maximum over subsets is the true count.
3. *Wide talks*: talks with more than ``max_width`` tags would give too many
   pairs; equal tag sets are merged and counted directly against the others.

Tags with a single use join nothing and are left out of all three. Links are
counted from the tag sets of their two talks. The heads, the tag sets and the
rows that meet at a pair are read several times, so they are written to the scratch folder first: these functions run Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.sources.scratch import keep

MAX_RECOMMENDATIONS = 10
RELATED_WEIGHT = 5
TAG_WEIGHT = 3

# Widest talk that enters the tag pairs: at most 16 pair rows per tag row.
MAX_WIDTH = 32
# Groups of one tag subset that are compared with each other; beyond, the subset grows.
CROWD = 64
# Talks of one tag that are paired at once; a tag with more is dealt to blocks of so many.
BLOCK = 256
# Ids of a tag's head sent to a talk beyond the tag's share of the talk's k + 1.
SPARE = 3


def _smallest(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows per key; cut before the shuffle as well as after it."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def _best(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` best candidates per key: most shared tags, then smallest id."""
    return _smallest(df, keys, [F.desc("shared"), F.asc("candidate")], n)


def common_tag_pairs(
    tags: DataFrame, k: int | None = None, max_width: int = MAX_WIDTH
) -> DataFrame:
    """Every pair of talks that share a tag, both ways, with exact counts.

    With ``k``, the ``k`` best partners of every talk only. ``tags`` holds distinct
    (video_id, tag) rows. Gives source_video_id, candidate_video_id, common_tag_count.
    """
    if k is None:
        partners = _all_partners(_numbered_sets(tags), None, max_width)
    else:
        sets, heads = _tag_sets(tags, k + 1)
        partners = _partners(sets, heads, None, k, max_width)
    return partners.drop("is_related")


def _partners(
    sets: DataFrame, heads: DataFrame, linked: DataFrame | None, k: int, max_width: int
) -> DataFrame:
    """The best partners as rows; ``is_related`` is 1 where ``linked`` holds them too."""
    return (
        _best_lists(sets, heads, linked, k, 0, 1, max_width)
        .select("video_id", F.inline("best"))
        .select(
            F.col("video_id").alias("source_video_id"),
            F.col("candidate").alias("candidate_video_id"),
            "is_related",
            F.col("shared").alias("common_tag_count"),
        )
    )


def _best_lists(
    sets: DataFrame,
    heads: DataFrame,
    linked: DataFrame | None,
    k: int,
    related_weight: float,
    tag_weight: float,
    max_width: int,
) -> DataFrame:
    """One row per talk: its ``k`` best links and partners, best first.

    ``linked`` holds links with their exact counts. Gives video_id and best,
    an array of (loss, candidate, is_related, shared); loss is minus the score.
    """
    width = F.size("tagset")
    met = _two_tag_partners(sets.where(width <= max_width), k + 1)
    wide = sets.where(width > max_width)
    if not wide.isEmpty():
        shared = sets.select("video_id", F.explode("tagset").alias("tag"))
        met = met.unionByName(_wide_partners(shared, wide.select("video_id", "tagset"), k + 1))
    loss = (-(F.col("is_related") * related_weight + F.col("shared") * tag_weight)).cast("double")
    best_first = [F.asc("loss"), F.asc("candidate")]
    found = met.where(F.col("video_id") != F.col("candidate")).withColumn("is_related", F.lit(0))
    if linked is not None:
        # Links beyond a talk's best k cannot be in its list, so a hub of links
        # is cut before it meets the partners.
        links = linked.select(
            F.col("source_video_id").alias("video_id"),
            F.col("candidate_video_id").alias("candidate"),
            F.col("common_tag_count").alias("shared"),
            F.lit(1).alias("is_related"),
        )
        links = _smallest(links.withColumn("loss", loss), ["video_id"], best_first, k)
        found = found.unionByName(links.drop("loss"))
    # A talk has a bounded number of rows by now, so one shuffle on the talk
    # serves the maximum, the ranking and the list.
    rated = (
        found.repartition("video_id")
        .groupBy("video_id", "candidate")
        .agg(F.max("is_related").alias("is_related"), F.max("shared").alias("shared"))
        .withColumn("loss", loss)
    )
    known = (
        _smallest(rated, ["video_id"], best_first, k)
        .groupBy("video_id")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("loss", "candidate", "is_related", "shared"))
            ).alias("known")
        )
    )
    # Both lists are bounded per talk and keyed by it, so they merge as arrays:
    # a head not known yet shares one tag and is no link.
    known_ids = F.coalesce(F.col("known.candidate"), F.array())
    fresh = F.transform(
        F.slice(
            F.array_except("head", F.array_append(known_ids, F.col("video_id"))), 1, k
        ),
        lambda c: F.struct(
            F.lit(-float(tag_weight)).alias("loss"),
            c.alias("candidate"),
            F.lit(0).alias("is_related"),
            F.lit(1).cast("bigint").alias("shared"),
        ),
    )
    merged = (
        _whole_heads(sets, heads, k + 1)
        .join(known, "video_id", "full_outer")
        .withColumn("head", F.coalesce("head", F.array()))
        .select("video_id", "known", fresh.alias("fresh"))
    )
    best = (
        F.when(F.col("known").isNull(), F.col("fresh"))
        .when(F.size("fresh") == 0, F.col("known"))
        .otherwise(F.slice(F.sort_array(F.concat("known", "fresh")), 1, k))
    )
    return merged.select("video_id", best.alias("best"))


def _tag_heads(tags: DataFrame, n: int) -> DataFrame:
    """Stored: the uses of each tag that has two or more, and its ``n`` smallest ids."""
    uses = tags.groupBy("tag").agg(F.count("*").alias("uses")).where(F.col("uses") > 1)
    heads = (
        _smallest(tags, ["tag"], [F.asc("video_id")], n)
        .groupBy("tag")
        .agg(F.sort_array(F.collect_list("video_id")).alias("head"))
    )
    return keep(uses.join(heads, "tag"), "tag-heads")


def _tag_sets(tags: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Per talk its tags, rare first, and the ``n`` smallest ids of their heads; and the heads.

    A talk with many tags needs few ids of each, so every tag sends its share of ``n`` and
    ``SPARE`` more. ``lacking`` holds the tags whose unsent ids could be among the ``n``
    smallest: all they sent is below the last of them.
    """
    width = F.count("*").over(Window.partitionBy("video_id"))
    share = F.least(F.ceil(F.lit(n) / width) + SPARE, F.lit(n)).cast("int")
    tags = keep(tags.select("video_id", "tag", share.alias("share")), "talk-tags")
    heads = _tag_heads(tags, n)
    # arrays of ids are far larger than their files, so they are not broadcast by file size
    sent = (
        tags.join(heads.hint("merge"), "tag")
        .select(
            "video_id",
            F.struct(
                "uses",
                "tag",
                F.slice("head", F.lit(1), F.col("share")).alias("ids"),
                (F.size("head") > F.col("share")).alias("more"),
            ).alias("entry"),
        )
    )
    # merged after the shuffle only: a talk's tags come from all over
    entries = F.sort_array(F.collect_list("entry"))
    ids = F.sort_array(F.array_distinct(F.flatten("entries.ids")))
    last = F.try_element_at("head", F.lit(n))
    lacking = F.filter(
        "entries",
        lambda e: e["more"] & (F.col("last").isNull() | (F.element_at(e["ids"], -1) < F.col("last"))),
    )
    sets = keep(
        sent.repartition("video_id")
        .groupBy("video_id")
        .agg(entries.alias("entries"))
        .withColumn("head", F.slice(ids, 1, n))
        .withColumn("last", last)
        .select(
            "video_id",
            F.col("entries.tag").alias("tagset"),
            "head",
            F.transform(
                lacking, lambda e: F.struct(e["tag"].alias("tag"), F.size(e["ids"]).alias("sent"))
            ).alias("lacking"),
        ),
        "tag-sets",
    )
    return sets, heads


def _whole_heads(sets: DataFrame, heads: DataFrame, n: int) -> DataFrame:
    """Per talk the ``n`` smallest ids of all its tags' heads, unsent ids included."""
    late = (
        sets.where(F.size("lacking") > 0)
        .select("video_id", F.inline("lacking"))
        .join(heads.select("tag", F.col("head").alias("ids")).hint("merge"), "tag")
        .select("video_id", F.slice("ids", F.col("sent") + 1, F.lit(n)).alias("ids"))
        .groupBy("video_id")
        .agg(F.flatten(F.collect_list("ids")).alias("late"))
    )
    both = F.sort_array(F.array_distinct(F.concat("head", "late")))
    head = F.when(F.col("late").isNull(), F.col("head")).otherwise(F.slice(both, 1, n))
    return sets.select("video_id", "head").join(late, "video_id", "left").select(
        "video_id", head.alias("head")
    )


def _reach() -> Column:
    """The most tags a talk can share with a partner found at a subset or beyond."""
    return F.size("subset") + F.size("rest")


def _longer(rows: DataFrame) -> DataFrame:
    """Each row's ``subset`` with one more tag of its ``rest``, and the rest after that."""
    grown = rows.select("video_id", "least", "subset", "rest", F.posexplode("rest").alias("i", "tag"))
    return grown.select(
        "video_id",
        "least",
        F.array_append("subset", F.col("tag")).alias("subset"),
        F.slice("rest", F.col("i") + 2, F.size("rest")).alias("rest"),
    )


def _met(rows: DataFrame) -> DataFrame:
    """Stored rows whose subset is held by two talks or more and can still improve a list.

    ``least`` is what a partner must share to enter the talk's own list; a row stays where
    it reaches the least that any talk with this subset needs. The hash just thins rows out:
    a false match keeps a row that finds no partner.
    """
    rows = rows.withColumns({"h": F.xxhash64("subset"), "reach": _reach()})
    needed = F.min(F.when(F.col("reach") >= F.col("least"), F.col("least")))
    wanted = rows.groupBy("h").agg(F.count("*").alias("talks"), needed.alias("needed"))
    wanted = wanted.where((F.col("talks") > 1) & F.col("needed").isNotNull()).drop("talks")
    # stored, so that Spark knows its size: where few subsets are wanted no row is shuffled
    wanted = keep(wanted, "wanted-subsets")
    met = rows.join(wanted, "h").where(F.col("reach") >= F.col("needed"))
    return keep(met.drop("h", "reach", "needed"), "subset-rows")


def _two_tag_partners(sets: DataFrame, n: int) -> DataFrame:
    """The ``n - 1`` best partners of narrow talks that share two tags or more.

    One round for each length of subset; rounds end where no subset is crowded or none
    can hold a partner that enters a list.
    """
    none = F.array().cast("array<string>").alias("subset")
    least = F.lit(0).cast("bigint").alias("least")
    rows = _met(
        _longer(_longer(sets.select("video_id", least, none, F.col("tagset").alias("rest"))))
    )
    best, length = None, 2
    while best is None or not rows.isEmpty():
        groups = (
            _smallest(rows, ["subset", "rest"], [F.asc("video_id")], n)
            .groupBy("subset", "rest")
            .agg(F.collect_list("video_id").alias("ids"))
        )
        held = (
            groups.groupBy("subset")
            .agg(F.count("*").alias("groups"), F.sum(F.size("ids")).alias("talks"))
            .where(F.col("talks") > 1)
        )
        groups = keep(groups.join(held.drop("talks"), "subset"), "subset-groups")
        seeking = rows.where(_reach() >= F.col("least"))
        found = _met_directly(seeking, groups.where(F.col("groups") <= CROWD), n)

        members = groups.where(F.col("groups") > CROWD).select(
            "subset", F.explode("ids").alias("id"), F.col("rest").alias("rest")
        )
        heads = (
            _smallest(members, ["subset"], [F.asc("id")], n)
            .groupBy("subset")
            .agg(F.collect_list(F.struct("id", "rest")).alias("head"))
        )
        found = found.unionByName(_head_partners(seeking.join(heads, "subset"), length))
        best = _best_so_far(found if best is None else found.unionByName(best), n - 1)

        known = best.groupBy("video_id").agg(F.count("*").alias("n"), F.min("shared").alias("least"))
        known = known.where(F.col("n") >= n - 1).drop("n")
        rows = (
            rows.drop("least")
            .join(heads.select("subset"), "subset", "left_semi")
            .join(known, "video_id", "left")
            .withColumn("least", F.coalesce("least", F.lit(0)))
        )
        rows = _met(_longer(rows))
        length += 1
    return best


def _best_so_far(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best partners known of each talk, stored."""
    others = found.where(F.col("video_id") != F.col("candidate"))
    counted = others.groupBy("video_id", "candidate").agg(F.max("shared").alias("shared"))
    return keep(_best(counted, ["video_id"], k), "best-partners")


def _head_partners(rows: DataFrame, length: int) -> DataFrame:
    """The smallest ids at a crowded subset, with the tags shared along it."""
    shared = F.transform(
        "head",
        lambda e: F.struct(
            e["id"].alias("candidate"),
            (F.size(F.array_intersect("rest", e["rest"])) + length).cast("bigint").alias("shared"),
        ),
    )
    return rows.select("video_id", F.inline(shared))


def _met_directly(rows: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """Partners of the talks of ``rows`` at subsets with few groups, compared with each other."""
    left = groups.select("subset", "rest")
    right = groups.select("subset", F.col("rest").alias("other_rest"), "ids")
    shared = F.size(F.array_intersect("rest", "other_rest")) + F.size("subset")
    matches = left.join(right, "subset").select(
        "subset", "rest", shared.cast("bigint").alias("shared"), F.explode("ids").alias("candidate")
    )
    best = _best(matches, ["subset", "rest"], n)
    return rows.join(best, ["subset", "rest"]).select("video_id", "candidate", "shared")


def _wide_partners(shared: DataFrame, wide: DataFrame, n: int) -> DataFrame:
    """Partners of the wide talks, and wide talks as partners of the narrow ones."""
    copies = (
        _smallest(wide, ["tagset"], [F.asc("video_id")], n)
        .groupBy("tagset")
        .agg(F.sort_array(F.collect_list("video_id")).alias("ids"))
        .withColumn("lead", F.col("ids")[0])
    )
    members = wide.join(copies, "tagset").select("video_id", "lead")
    leads = copies.select(F.col("lead").alias("video_id"), "ids")

    # The smallest talk of each set is counted against every talk, and then
    # kept against narrow talks and the smallest talks of other sets.
    counted = (
        shared.join(leads, "video_id", "left_semi")
        .select(F.col("video_id").alias("lead"), "tag")
        .join(shared.select(F.col("video_id").alias("other"), "tag"), "tag")
        .groupBy("lead", "other")
        .agg(F.count("*").alias("shared"))
        .join(
            members.select(F.col("video_id").alias("other"), F.col("lead").alias("other_lead")),
            "other",
            "left",
        )
        .where(F.col("other_lead").isNull() | (F.col("other_lead") == F.col("other")))
    )
    counted = counted.join(
        leads.select(F.col("video_id").alias("other"), F.col("ids").alias("other_ids")),
        "other",
        "left",
    )
    of_leads = counted.select(
        "lead", "shared", F.explode(F.coalesce("other_ids", F.array("other"))).alias("candidate")
    )
    of_narrow = (
        counted.where(F.col("other_lead").isNull())
        .join(leads.withColumnRenamed("video_id", "lead"), "lead")
        .select(F.col("other").alias("video_id"), F.explode("ids").alias("candidate"), "shared")
    )
    return (
        members.join(_best(of_leads, ["lead"], n), "lead")
        .select("video_id", "candidate", "shared")
        .unionByName(_best(of_narrow, ["video_id"], n))
    )


def _numbered_sets(tags: DataFrame) -> DataFrame:
    """Stored: per talk the tags it shares, as (uses, number), rare first.

    Numbers are shorter than tags. They are stored, so every reader sees the same ones.
    """
    tags = keep(tags.select("video_id", "tag"), "talk-tags")
    uses = tags.groupBy("tag").agg(F.count("*").alias("uses")).where(F.col("uses") > 1)
    numbers = keep(uses.withColumn("number", F.monotonically_increasing_id()), "tag-numbers")
    return keep(
        tags.join(numbers, "tag")
        .select("video_id", F.struct("uses", "number").alias("entry"))
        .repartition("video_id")
        .groupBy("video_id")
        .agg(F.sort_array(F.collect_set("entry")).alias("tagset")),
        "numbered-sets",
    )


def _blocks() -> Column:
    """How many blocks the talks of a tag are dealt to."""
    return F.ceil(F.col("uses") / BLOCK)


def _block(video_id: str) -> Column:
    """The block of a talk among those of a tag."""
    return F.pmod(F.xxhash64(video_id), _blocks())


def _all_partners(sets: DataFrame, links: DataFrame | None, max_width: int) -> DataFrame:
    """Every pair of talks that share a tag, both ways, with exact counts.

    Talks meet at each tag, and a pair is given at the first tag it shares, counted from
    the two sets, so pairs are not shuffled. A popular tag is dealt to blocks, and each
    two blocks meet on their own. Talks with more than ``max_width`` tags do not carry
    their sets along: their pairs are counted tag by tag.

    ``links`` holds links with the tags ``common`` to both talks; ``is_related`` is 1 for them.
    """
    narrow = F.size("tagset") <= max_width
    members = (
        sets.select(
            "video_id",
            F.when(narrow, F.col("tagset.number")).alias("numbers"),
            F.inline("tagset"),
        )
        .withColumn("block", _block("video_id"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), _blocks() - 1)))
        .select(
            "number",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            F.struct("block", "video_id", "numbers").alias("member"),
        )
    )
    wide = sets.where(~narrow)
    wide = None if wide.isEmpty() else wide.select("video_id", F.explode("tagset.number").alias("number"))
    of_wide = None
    if links is not None:
        of_wide, links = links.where(F.col("width") > max_width), links.where(F.col("width") <= max_width)
    pairs = _narrow_pairs(members, links)
    if wide is not None:
        at_wide = members.join(wide.select("number").distinct(), "number", "left_semi")
        pairs = pairs.unionByName(_wide_pairs(at_wide, of_wide))
    # a pair once, so both ways of it are given here
    return pairs.select(
        F.inline(
            F.when(
                F.col("shared").isNotNull(),
                F.array(
                    *(
                        F.struct(
                            F.col(source).alias("source_video_id"),
                            F.col(candidate).alias("candidate_video_id"),
                            F.col(linked).alias("is_related"),
                            F.col("shared").alias("common_tag_count"),
                        )
                        for source, candidate, linked in (("a", "b", "there"), ("b", "a", "back"))
                    )
                ),
            )
        )
    )


def _meetings(rows: DataFrame, *more: Column) -> DataFrame:
    """The talks of two blocks of a tag, or of its only one, as arrays ``left`` and ``right``."""
    # pairs are far more than the rows, so adaptive execution must not merge small partitions
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = (
        rows.repartition(partitions, "number", "low", "high")
        .groupBy("number", "low", "high")
        .agg(F.collect_list("member").alias("members"), *more)
    )
    apart = F.col("low") < F.col("high")
    sides = [
        F.when(apart, F.filter("members", lambda m: m["block"] == F.col(side)))
        .otherwise(F.col("members"))
        .alias(name)
        for side, name in (("low", "left"), ("high", "right"))
    ]
    return groups.select("*", apart.alias("apart"), *sides).drop("members", "low", "high")


def _narrow_pairs(members: DataFrame, links: DataFrame | None) -> DataFrame:
    """Pairs (a, b) with ``shared`` where they meet first and null elsewhere.

    ``there`` is 1 where a is linked to b, ``back`` where b is linked to a.
    """
    none = F.array().cast("array<string>")
    if links is None:
        met = _meetings(members).withColumns({"there": none, "back": none})
        met = met.select("*", F.explode("left").alias("x")).drop("left")
    else:
        # Links lie beside the talks at the first tag they share, so a talk
        # has at most a block of them there.
        first = F.element_at("common", 1)
        linked = links.select(
            F.col("source_video_id").alias("source"),
            F.col("candidate_video_id").alias("candidate"),
            first["number"].alias("number"),
            first["uses"].alias("uses"),
        ).withColumns({"own": _block("source"), "other": _block("candidate")})
        turned = (F.col("own") > F.col("other")) | (
            (F.col("own") == F.col("other")) & (F.col("source") > F.col("candidate"))
        )
        linked = (
            linked.select(
                "number",
                F.least("own", "other").alias("low"),
                F.greatest("own", "other").alias("high"),
                F.when(turned, F.col("candidate")).otherwise(F.col("source")).alias("a"),
                F.when(~turned, F.col("candidate")).alias("there"),
                F.when(turned, F.col("source")).alias("back"),
            )
            .groupBy("number", "low", "high", "a")
            .agg(F.collect_list("there").alias("there"), F.collect_list("back").alias("back"))
            .select("number", "low", "high", F.struct("a", F.struct("there", "back")).alias("link"))
        )
        rows = members.unionByName(linked, allowMissingColumns=True)
        met = _meetings(rows, F.map_from_entries(F.collect_list("link")).alias("links"))
        met = met.select("*", F.explode("left").alias("x")).drop("left")
        met = met.withColumn("links", F.try_element_at("links", F.col("x.video_id")))
        met = met.select("*", "links.*").drop("links")
    met = met.select("*", F.explode("right").alias("y")).drop("right")
    common = F.array_intersect("x.numbers", "y.numbers")
    here = F.try_element_at(common, F.lit(1)) == F.col("number")
    return met.where(F.col("apart") | (F.col("x.video_id") < F.col("y.video_id"))).select(
        F.col("x.video_id").alias("a"),
        F.col("y.video_id").alias("b"),
        F.when(here, F.size(common).cast("bigint")).alias("shared"),
        *(
            F.when(F.array_contains(side, F.col("y.video_id")), 1).otherwise(0).alias(side)
            for side in ("there", "back")
        ),
    )


def _wide_pairs(members: DataFrame, links: DataFrame | None) -> DataFrame:
    """The same for pairs of a wide talk and another, a row for each tag summed by pair."""
    met = _meetings(members).select("*", F.explode("left").alias("x")).drop("left")
    met = met.select("*", F.explode("right").alias("y")).drop("right")
    met = met.where(F.col("apart") | (F.col("x.video_id") < F.col("y.video_id")))
    hits = met.where(F.col("x.numbers").isNull() | F.col("y.numbers").isNull()).select(
        F.least("x.video_id", "y.video_id").alias("a"),
        F.greatest("x.video_id", "y.video_id").alias("b"),
        F.lit(1).alias("hit"),
        F.lit(0).alias("there"),
        F.lit(0).alias("back"),
    )
    if links is not None:
        source, candidate = F.col("source_video_id"), F.col("candidate_video_id")
        hits = hits.unionByName(
            links.select(
                F.least(source, candidate).alias("a"),
                F.greatest(source, candidate).alias("b"),
                F.lit(0).alias("hit"),
                (source < candidate).cast("int").alias("there"),
                (source > candidate).cast("int").alias("back"),
            )
        )
    return hits.groupBy("a", "b").agg(
        F.sum("hit").alias("shared"), F.max("there").alias("there"), F.max("back").alias("back")
    )


def related_tag_counts(related: DataFrame, tags: DataFrame) -> DataFrame:
    """Every link with the exact number of tags its two talks share.

    A talk linked to itself counts none, as it is no partner of its own.
    """
    return _linked(related, tags)


def _linked(related: DataFrame, tags: DataFrame) -> DataFrame:
    tags = tags.select("video_id", "tag")
    tagged = related.where(F.col("source_video_id") != F.col("related_video_id")).join(
        tags.withColumnRenamed("video_id", "source_video_id"), "source_video_id"
    )
    hits = tagged.join(
        tags.withColumnRenamed("video_id", "related_video_id"), ["related_video_id", "tag"]
    ).select("source_video_id", "related_video_id", F.lit(1).alias("hit"))
    return (
        related.withColumn("hit", F.lit(0))
        .unionByName(hits)
        .groupBy("source_video_id", F.col("related_video_id").alias("candidate_video_id"))
        .agg(F.sum("hit").alias("common_tag_count"))
    )


def _links_of_sets(related: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct links with the same counts from stored tag sets: a row a link, not one a tag of it."""
    return _counted(_tags_of_links(related, sets)).drop("common", "width")


def _tags_of_links(related: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct links with the tags in ``common``; null for self-links and talks without a set.

    ``width`` is that of the wider talk.
    """
    links = related.select("source_video_id", F.col("related_video_id").alias("candidate_video_id"))
    for key, name in (("source_video_id", "own"), ("candidate_video_id", "other")):
        side = sets.select(F.col("video_id").alias(key), F.col("tagset").alias(name))
        links = links.join(side, key, "left")
    others = F.col("source_video_id") != F.col("candidate_video_id")
    return links.select(
        "source_video_id",
        "candidate_video_id",
        F.when(others, F.array_intersect("own", "other")).alias("common"),
        F.greatest(F.size("own"), F.size("other")).alias("width"),
    )


def _counted(links: DataFrame) -> DataFrame:
    same = F.when(F.col("common").isNotNull(), F.size("common")).otherwise(0)
    return links.withColumn("common_tag_count", same.cast("bigint"))


def candidates(
    related: DataFrame, tags: DataFrame, k: int | None = None, max_width: int = MAX_WIDTH
) -> DataFrame:
    """All linked talks and all tag partners, one row per pair, with exact counts.

    With ``k``, of the partners the ``k`` best only: the rows then still hold the best
    ``k`` under any positive tag weight and non-negative link weight.
    """
    if k is None:
        sets = _numbered_sets(tags)
        links = keep(_tags_of_links(related.distinct(), sets), "tags-of-links")
        linked = _counted(links)
        partners = _all_partners(sets, links.where(F.size("common") > 0), max_width)
    else:
        sets, heads = _tag_sets(tags, k + 1)
        linked = _links_of_sets(related.distinct(), sets)
        # The links among a talk's best partners are the first of its links in the same order,
        # so the partners know which of them are links and need not meet all links.
        partners = _partners(sets, heads, linked.where(F.col("common_tag_count") > 0), k, max_width)
    columns = ["source_video_id", "candidate_video_id", "is_related", "common_tag_count"]
    return (
        linked.withColumn("is_related", F.lit(1))
        .select(columns)
        .unionByName(partners.where(F.col("is_related") == 0))
    )


def _reasons(is_related: Column, shared: Column) -> Column:
    """The reasons that apply, links first."""
    return F.array_compact(
        F.array(
            F.when(is_related == 1, F.lit("related_video")),
            F.when(shared > 0, F.lit("common_tags")),
        )
    )


def _check_weights(related_weight: float, tag_weight: float) -> None:
    if tag_weight <= 0 or related_weight < 0:
        raise ValueError("tag_weight must be positive and related_weight not negative")


def score(
    pairs: DataFrame, related_weight: float = RELATED_WEIGHT, tag_weight: float = TAG_WEIGHT
) -> DataFrame:
    """Add the weighted score and the reasons."""
    _check_weights(related_weight, tag_weight)
    weighted = F.col("is_related") * related_weight + F.col("common_tag_count") * tag_weight
    reasons = _reasons(F.col("is_related"), F.col("common_tag_count"))
    return pairs.withColumns({"score": weighted.cast("double"), "reasons": reasons})


def top_k(scored: DataFrame, k: int = MAX_RECOMMENDATIONS) -> DataFrame:
    """The ``k`` best candidates per source with their rank, ties by id."""
    order = Window.partitionBy("source_video_id").orderBy(
        F.desc("score"), F.asc("candidate_video_id")
    )
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nest(ranked: DataFrame) -> DataFrame:
    """One row per source with its recommendations in rank order."""
    entry = F.struct(
        "rank", F.col("candidate_video_id").alias("video_id"), "score", "reasons"
    )
    in_order = F.sort_array(F.collect_list(entry))
    return ranked.groupBy(F.col("source_video_id").alias("_id")).agg(
        F.transform(
            in_order, lambda e: F.struct(e["video_id"], e["score"], e["reasons"])
        ).alias("recommendations")
    )


def watch_next(
    tags: DataFrame,
    related: DataFrame,
    k: int = MAX_RECOMMENDATIONS,
    related_weight: float = RELATED_WEIGHT,
    tag_weight: float = TAG_WEIGHT,
    max_width: int = MAX_WIDTH,
) -> DataFrame:
    """Cleaned tags and links to one recommendation list per talk.

    The same lists as ``nest(top_k(score(candidates(...))))``, with links and
    partners merged as short arrays instead of shuffled rows.
    """
    _check_weights(related_weight, tag_weight)
    sets, heads = _tag_sets(tags, k + 1)
    linked = _links_of_sets(related, sets)
    lists = _best_lists(sets, heads, linked, k, related_weight, tag_weight, max_width)
    return lists.select(
        F.col("video_id").alias("_id"),
        F.transform(
            "best",
            lambda e: F.struct(
                e["candidate"].alias("video_id"),
                (-e["loss"]).alias("score"),
                _reasons(e["is_related"], e["shared"]).alias("reasons"),
            ),
        ).alias("recommendations"),
    )
