"""Personal data by bootstrapped contextual extraction, in DataFrame expressions only.

Seeds are what fixed patterns find: e-mail and IP addresses, card and phone numbers. The word left
of an entity and its shape make a lexical pattern, the word right of it and its shape another;
patterns and the tokens they match, over all documents, are a graph of two sides. Every token with a
neighbour is an instance, and so is every whole base match, whatever its tokens. Known instances
hold a digit or an at sign, and a pattern only matches tokens of its own shape, so tokens with
neither can neither be found nor count for or against a pattern that could be accepted: they are left
out without loss. In each round a pattern's score is the share of its instances that are known,
weighted by how many there are; patterns with a high score make their other instances known, and
those lend weight to further patterns, until a round finds nothing new. New instances become spans,
of the kind that their best pattern names.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._plan import Shared

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE, TOKEN = range(5)
#: The base patterns, possessive where no later part could take characters back.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A whole token that holds a digit or an at sign, as whatever shares the shape of a base match does.
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_LAST_WORD = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+$"
_NEXT_WORD = r"^[\"')>\]}.,;:!?#*]*+[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)"
_OPENERS = r"\"'(<\[{#*"
#: Worth a look for each kind: each pattern's cheaper necessary condition.
_NEEDS = {"ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "token": "[0-9@]"}
_OCTET = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"


def _hits(text: Column, kind: str, pattern: str) -> Column:
    need = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind)
    need = text.rlike(_NEEDS[kind]) if need is None else need
    return F.when(need, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _found(order: int, hits: Column, gaps: Column) -> Column:
    """Array of (order, i, gap, size, hit, left, right) from a kind's matches and what `split` leaves around them.

    gap and size are lengths in code points, so running sums tell where a match starts. `left` is the
    word left of the match, from the kind's match before on, and up to the match where they touch;
    `right` the word after it, up to the end of the kind's next match; empty if there is none.
    """

    def one(hit: Column, i: Column) -> Column:
        gap = F.get(gaps, i)
        before = F.regexp_replace(F.concat(F.coalesce(F.get(hits, i - 1), F.lit("")), gap), f"(?<![{_OPENERS}])[{_OPENERS}]++$", "")
        left = F.lower(F.regexp_extract(before, _LAST_WORD, 1))
        after = F.concat(F.get(gaps, i + 1), F.coalesce(F.get(hits, i + 1), F.lit("")))
        right = F.lower(F.regexp_extract(after, _NEXT_WORD, 1))
        return F.struct(F.lit(order).alias("order"), i.alias("i"), F.length(gap).alias("gap"), F.length(hit).alias("size"), hit.alias("hit"), left.alias("left"), right.alias("right"))

    return F.transform(hits, one)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    place = F.sequence(F.lit(1), n)

    def worth(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(place, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _valid(order: Column, hit: Column) -> Column:
    digits = _digits(hit)
    n = F.length(digits)
    ip = F.forall(F.split(hit, r"\."), lambda p: p.rlike(_OCTET))
    card = n.between(12, 19) & _luhn(F.when(n.between(12, 19), digits).otherwise(F.lit("0")))
    return F.when(order == EMAIL, F.lit(True)).when(order == IP, ip).when(order == CARD, card).when(order == PHONE, n.between(9, 15)).otherwise(F.lit(False))


def _scan(df: DataFrame, text: str, kept: list[str], shared: Shared) -> tuple[DataFrame, DataFrame]:
    """(the rows, as a number and a struct of the `kept` columns; what is in their texts), both written to the shared folder.

    What is in a text: (row, start, end, order, base, near, entity, pattern, after, kind), where `base`
    marks spans of the fixed patterns and `near` instances with a word on their left, whose pattern
    is `pattern`; `after` is the pattern of an instance's right word, or null, and begins with a blank
    as no left one does; `kind` is what an instance is known to be. Positions are running sums over a text's matches, and overlaps are found by running
    maxima, so a text costs in proportion to its matches.
    """
    every = [*PATTERNS.values(), _TOKEN]
    names = [*PATTERNS, "token"]
    body = F.coalesce(F.col("t"), F.lit(""))
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.struct(*([F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("none")])).alias("r"), F.col(f"`{text}`").alias("t"))
    rows = rows.select("row", "r", "t", *[_hits(body, k, p).alias(f"hits_{k}") for k, p in zip(names, every, strict=True)])
    rows = rows.select("row", "r", *[f"hits_{k}" for k in names], *[F.when(F.size(f"hits_{k}") > 0, F.split(body, p, -1)).alias(f"gaps_{k}") for k, p in zip(names, every, strict=True)])
    hits = F.concat(*[_found(i, F.col(f"hits_{k}"), F.col(f"gaps_{k}")) for i, k in enumerate(names)])
    rows = shared.table(rows.select("row", "r", hits.alias("hits")))

    found = rows.select("row", F.explode("hits").alias("h")).select("row", "h.*").repartition("row")  # all that follows goes by row
    until = F.sum(F.col("gap") + F.col("size")).over(W.partitionBy("row", "order").orderBy("i").rowsBetween(W.unboundedPreceding, 0)).cast("int")
    base = _valid(F.col("order"), F.col("hit"))
    # a card's number is one thing even if its checksum fails
    whole = F.when(F.col("order") == CARD, F.length(_digits(F.col("hit"))).between(12, 19)).otherwise(F.col("base"))
    found = found.select("row", "order", "hit", "left", "right", (until - F.col("size")).alias("start"), until.alias("end"), base.alias("base"))
    found = found.withColumn("whole", whole).withColumn("token", F.col("order") == TOKEN).filter("whole or token")
    inner = F.regexp_replace("hit", f"^[{_OPENERS}]+", "")
    entity = F.when(F.col("token"), F.regexp_replace(inner, r"[\"')>\]}.,;:!?#*]+$", "")).otherwise(F.col("hit"))
    from_ = F.when(F.col("token"), F.col("end") - F.length(inner)).otherwise(F.col("start"))
    found = found.withColumn("entity", entity).withColumn("from", from_).withColumn("to", F.col("from") + F.length("entity"))

    by_start = W.partitionBy("row").orderBy("start")
    earlier, so_far = by_start.rangeBetween(W.unboundedPreceding, -1), by_start.rangeBetween(W.unboundedPreceding, 0)
    later = W.partitionBy("row").orderBy(F.col("start").desc()).rangeBetween(W.unboundedPreceding, -1)
    ends = lambda flag: F.max(F.when(F.col(flag), F.col("end")))
    found = found.select(
        "*",
        ends("whole").over(earlier).alias("reached"),
        ends("base").over(so_far).alias("taken"),
        F.max(F.when(F.col("token"), F.struct("start", "end"))).over(so_far).alias("last"),
        F.min(F.when(F.col("base"), F.col("start"))).over(later).alias("next"),
    )
    found = found.withColumn("in", F.when(F.col("last.end") > F.col("start"), F.col("last.start")))  # the token that it starts in
    mates = W.partitionBy("row", "in")
    found = found.select(
        "*",
        ends("whole").over(mates).alias("reach"),
        F.min(F.when(F.col("base"), F.struct("start", "order"))).over(mates).alias("first"),
        F.max(F.when(F.col("token"), F.struct("from", "to"))).over(mates).alias("mate"),
    )
    # a token isn't a piece of a match that goes beyond it, and a match that is a whole token counts once
    unbroken = (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (F.coalesce("reach", F.lit(0)) <= F.col("end"))
    same = F.col("in").isNotNull() & (F.col("mate.from") == F.col("start")) & (F.col("mate.to") == F.col("end"))
    alone = F.col("base") | ((F.coalesce("taken", F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("next"), F.col("end")) >= F.col("end")))
    own = F.when(F.col("token"), unbroken).otherwise(~same & alone)
    order = F.when(F.col("token"), F.col("first.order")).when(F.col("base"), F.col("order"))
    kind = F.get(F.array(*[F.lit(k) for k in KINDS]), order)
    shape = F.regexp_replace(F.regexp_replace("entity", "[0-9]+", "9"), "[A-Za-z]+", "a")
    after = F.when(own & (F.col("right") != ""), F.concat_ws(" ", F.lit(""), "right", shape))
    near = (own & (F.col("left") != "")).alias("near")
    found = found.select("row", F.col("from").alias("start"), F.col("to").alias("end"), "order", "base", near, "entity", F.concat_ws(" ", "left", shape).alias("pattern"), after.alias("after"), kind.alias("kind"))
    return rows.drop("hits"), shared.table(found.filter("base or near or after is not null"))


def induce(edges: DataFrame, rounds: int | None = None, least_known: int = 3, least_share: float = 0.8, shared: Shared | None = None) -> DataFrame:
    """(pattern, kind, score) of the accepted patterns, from distinct (pattern, entity, kind or null).

    A pattern's instances that are known count for it, all of its instances against it:
    score = share * log2(1 + known). A pattern needs `least_known` known instances and
    `least_share` of all. What an accepted pattern matches is known to the next round. Rounds go on
    until one makes nothing new known, or as many as are given; each round's patterns and what is
    known after it are written to the shared folder.
    """
    shared = shared or Shared(edges.sparkSession)
    total = shared.table(edges.groupBy("pattern").agg(F.count("*").alias("_all")))
    known = shared.table(edges.filter("kind is not null").select("entity", "kind").distinct())
    n_known = known.count()
    for done in itertools.count(1):
        hits = edges.select("pattern", "entity").join(known, "entity").groupBy("pattern", "kind").agg(F.count("*").alias("_known"))
        share = F.col("_known") / F.col("_all")
        accepted = hits.join(total, "pattern").filter((F.col("_known") >= least_known) & (share >= least_share))
        accepted = accepted.select("pattern", "kind", (share * F.log2(F.col("_known") + 1)).alias("score"))
        best = accepted.groupBy("pattern").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"), F.max("score").alias("score"))
        accepted = shared.table(best.select("pattern", "kind", "score"))
        if done == rounds:
            return accepted
        more = edges.join(accepted.select("pattern", F.col("kind").alias("_k")), "pattern").select("entity", F.col("_k").alias("kind"))
        grown = shared.table(known.unionByName(more).distinct())
        n_grown = grown.count()
        if n_grown == n_known:  # known only grows, so the next round would be this one again
            return accepted
        shared.drop(known)
        shared.drop(accepted)
        known, n_known = grown, n_grown


def _spans(found: DataFrame, rounds: int | None, shared: Shared) -> DataFrame:
    """(row, base, s): spans as (start, order, end, kind), those of the fixed patterns and those that accepted contexts add."""
    sides = F.array_compact(F.array(F.when(F.col("near"), F.col("pattern")), F.col("after")))
    near = found.select("row", "start", "end", "entity", "kind", F.explode(sides).alias("pattern"))
    edges = shared.table(near.groupBy("pattern", "entity").agg(F.max("kind").alias("kind")))
    accepted = induce(edges, rounds, shared=shared).withColumnRenamed("kind", "found")
    more = near.filter("kind is null and entity != ''").join(accepted, "pattern")
    more = more.groupBy("row", "start", "end").agg(F.max_by("found", F.struct("score", "found")).alias("found"))
    order = F.array_position(F.lit(list(KINDS)), F.col("found")).cast("int") - 1
    more = more.select("row", F.lit(False).alias("base"), F.struct("start", order.alias("order"), "end", F.col("found").alias("kind")).alias("s"))
    kind = F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("order"))
    return found.filter("base").select("row", "base", F.struct("start", "order", "end", kind.alias("kind")).alias("s")).unionByName(more)


def extract(df: DataFrame, text: str = "text", rounds: int | None = None, keep_text: bool = True) -> DataFrame:
    """`df` with base_spans and spans, arrays of (start, order, end, kind), ascending; ends are exclusive.

    Positions are code points. base_spans holds what the fixed patterns find (leftmost, not
    overlapping within a kind, failing matches dropped); spans holds these and what accepted
    contexts add, which never overlaps them. A null text has none, of any length one costs in
    proportion to its matches. Repeated rows are told apart by a row number of their own; null keys
    pass through; an empty table gives none; columns of `df` named base_spans or spans give way,
    any other name is free, and the text goes unless it is kept. It is scanned once and what is
    found is written to the shared folder; patterns are aggregated before any join, so none meets
    in one task.
    """
    shared = Shared(df.sparkSession)
    kept = [c for c in df.columns if c.lower() not in ("base_spans", "spans") and (keep_text or c != text)]
    rows, found = _scan(df, text, kept, shared)
    lists = _spans(found, rounds, shared).groupBy("row").agg(F.array_sort(F.collect_list(F.when(F.col("base"), F.col("s")))).alias("base_spans"), F.array_sort(F.collect_list("s")).alias("spans"))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    out = rows.join(lists, "row", "left")
    return out.select(*[F.col("r").getField(c).alias(c) for c in kept], *[F.coalesce(c, none).alias(c) for c in ("base_spans", "spans")])


def count(spans: Column, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def spell(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text: str = "text", rounds: int | None = None) -> DataFrame:
    """`df` with each found span replaced by its kind in brackets; spans that overlap are one, of the first one's kind.

    A null text stays null. Other columns, whatever their names, repeated rows and null keys stay as
    they are; an empty table gives none. A text with k spans is cut into some root of k parts first,
    so that long texts with many spans don't cost the square.
    """
    shared = Shared(df.sparkSession)
    rows, found = _scan(df, text, df.columns, shared)
    spans = _spans(found, rounds, shared).select("row", "s.*")
    before = W.partitionBy("row").orderBy("start", "order", "end", "kind").rowsBetween(W.unboundedPreceding, -1)
    cuts = spans.withColumn("at", F.coalesce(F.max("end").over(before), F.lit(0)))
    cut = F.when(F.col("start") >= F.col("at"), F.struct("at", "start", F.upper("kind").alias("kind")))
    cuts = cuts.groupBy("row").agg(F.array_sort(F.collect_list(cut)).alias("cuts"), F.max("end").alias("tail"))
    out = rows.join(cuts, "row", "left").withColumn("t", F.col("r").getField(text))
    each = F.ceil(F.sqrt(F.size("cuts"))).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("cuts") - 1) / each).cast("int")), lambda b: F.slice("cuts", b * each + 1, each))
    out = out.withColumn("parts", F.when(F.size("cuts") > 0, parts))

    def body(cuts: Column) -> Column:
        first, last = F.get(cuts, F.lit(0))["at"], F.element_at(cuts, -1)["start"]
        return F.struct(cuts.alias("cuts"), first.alias("first"), F.substring("t", first + 1, last - first).alias("body"))

    def hide(part: Column) -> Column:
        return F.array_join(F.transform(part["cuts"], lambda c: F.concat(F.substring(part["body"], c["at"] - part["first"] + 1, c["start"] - c["at"]), F.lit("["), c["kind"], F.lit("]"))), "")

    out = out.withColumn("parts", F.transform("parts", body))
    done = F.concat(F.array_join(F.transform("parts", hide), ""), F.substring("t", F.col("tail") + 1, F.length("t")))
    return out.select(*[F.when(F.col("parts").isNotNull(), done).otherwise(F.col("t")).alias(c) if c == text else F.col("r").getField(c).alias(c) for c in df.columns])
