"""Near-duplicate lines across a corpus by deletion neighbourhoods; DataFrame functions only.

Lines are compared word by word: two lines are near if one word changed, added or removed
turns one into the other. A line goes if an earlier line equals it or, from `near_words`
words on, is near it; earlier means smaller document id, then smaller place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

# Lines with fewer words have no near-copies, only equal ones: one of five words is 0.8 alike.
NEAR_WORDS = 5
# Lines whose text may be fetched by a broadcast of their places (some 60 bytes each).
BROADCAST_LINES = 500_000
_OTHER_SPACE = "\t\x0b\f\r"
_PRIME = (1 << 31) - 1


def spaced(text: Column) -> Column:
    """White space inside lines as blanks; most texts have no other and are only looked at."""
    blanks = F.translate(text, _OTHER_SPACE, " " * len(_OTHER_SPACE))
    return F.when(text.rlike(f"[{_OTHER_SPACE}]"), blanks).otherwise(text)


def words_of(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def within_one_edit(a: Column, b: Column) -> Column:
    """True if at most one word changed, added or removed turns one list of words into the other."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    apart = F.array_position(same, False)  # first difference, from 1; 0 if there is none
    size_a, size_b = F.size(a), F.size(b)

    def after(words: Column, size: Column, skip: int) -> Column:
        start = (apart + skip).cast("int")
        return F.slice(words, start, F.greatest(size - start + 1, F.lit(0)))

    rest = (
        F.when(size_a == size_b, after(a, size_a, 1) == after(b, size_b, 1))
        .when(size_a == size_b + 1, after(a, size_a, 1) == after(b, size_b, 0))
        .when(size_a + 1 == size_b, after(a, size_a, 0) == after(b, size_b, 1))
        .otherwise(False)
    )
    return (apart == 0) | rest


def line_facts(rows: DataFrame) -> DataFrame:
    """One row per line with words: where it stands, its hash (`k1`, `k2`), size and half hashes.

    The first and the last floor(n / 2) words, and floor((n - 1) / 2) words, are hashed:
    of two near lines one such half is equal in both.
    """
    lines = rows.select("id", "h1", "h2", F.posexplode(F.split(spaced(F.col("text")), "\n", -1)).alias("pos", "line"))
    cut = lines.select("id", "h1", "h2", "pos", words_of(F.col("line")).alias("w")).withColumn("n", F.size("w"))

    def half(side: int, m: Column) -> Column:
        part = F.slice("w", F.lit(1) if side == 0 else F.col("n") - m + 1, m)
        return F.struct(F.lit(side).alias("side"), m.alias("m"), F.xxhash64(part).alias("hash"))

    own, less = F.floor(F.col("n") / 2).cast("int"), F.floor((F.col("n") - 1) / 2).cast("int")
    hashed = cut.where("n > 0").select(
        "id", "h1", "h2", "pos", "n",
        F.xxhash64("w").alias("k1"),
        F.array(half(0, own), half(1, own)).alias("own"),
        F.when((F.col("n") % 2) == 0, F.array(half(0, less), half(1, less))).alias("less"),
    )
    # The halves leave out at most the middle word, which the first hash has too: 128 bits for the line.
    k2 = F.xxhash64("n", F.col("own")[0]["hash"], F.col("own")[1]["hash"]).alias("k2")
    halves = F.when(F.col("less").isNull(), F.col("own")).otherwise(F.concat("own", "less")).alias("halves")
    return hashed.select("id", "h1", "h2", "pos", "n", "k1", k2, halves)


def _order(*rest: str) -> Column:
    """Earlier rows sort first; rows without an id last."""
    return F.struct(F.col("id").isNull().alias("none"), "id", "pos", *rest)


def line_words(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """`k1`, `k2`, `words` of the wanted lines, fetched from the texts where they first stand."""
    places = wanted.groupBy("id", "h1", "h2").agg(F.collect_list(F.struct("pos", "k1", "k2")).alias("places"))
    if wanted.count() <= BROADCAST_LINES:
        places = F.broadcast(places)
    places = places.withColumnsRenamed({"id": "_id", "h1": "_h1", "h2": "_h2"})
    there = F.col("id").eqNullSafe(F.col("_id")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    texts = rows.join(places, there).select(F.split("text", "\n", -1).alias("lines"), "places")
    lines = texts.select(
        F.explode(F.transform("places", lambda p: F.struct(p.k1.alias("k1"), p.k2.alias("k2"), F.get("lines", p.pos).alias("line")))).alias("x")
    ).select("x.*")
    return lines.select("k1", "k2", words_of(spaced(F.col("line"))).alias("words")).dropDuplicates(["k1", "k2"])


def variants(lines: DataFrame, halves: DataFrame) -> DataFrame:
    """`key`, `full`, `k1`, `k2`: hashed keys of each line's variants with up to one word left out.

    Two lines with a key in common are near: both without the word at one place (a word
    changed), or one whole and one without a word. Words are left out of the half that
    the line does not share. Sums over the words, plain and by place, give the hash of
    every variant in turn, so a line costs as much as it has words.
    """
    each = lines.select("k1", "k2", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    each = each.select(
        "k1", "k2", "n", (F.col("at") + 1).cast("long").alias("i"),
        F.xxhash64("word").bitwiseAND(F.lit((1 << 44) - 1)).alias("g"),
        F.xxhash64(F.lit(2), "word").bitwiseAND(F.lit((1 << 30) - 1)).alias("t"),
    )
    line = Window.partitionBy("k1", "k2")
    placed = (F.col("i") * F.col("t")) % _PRIME
    sums = each.withColumns(
        {
            "s": F.sum("g").over(line),
            "p": F.sum(placed).over(line),
            "after": F.sum("t").over(line.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, -1)),
        }
    ).select(
        "k1", "k2", "n", "i", "s",
        F.pmod(F.col("p"), F.lit(_PRIME)).alias("p"),
        (F.col("s") - F.col("g")).alias("s_without"),
        F.pmod(F.col("p") - placed - F.coalesce("after", F.lit(0)), F.lit(_PRIME)).alias("p_without"),
    )
    open_half = F.when(F.col("side") == 0, F.col("i") > F.col("m")).otherwise(F.col("i") <= F.col("n") - F.col("m"))
    own, less = F.col("m") == F.floor(F.col("n") / 2), F.col("m") == F.floor((F.col("n") - 1) / 2)

    def key(kind: int, size: Column, *parts: str) -> Column:
        return F.xxhash64(F.lit(kind), "side", "m", "hash", size, *parts)

    def entry(when: Column, full: bool, value: Column) -> Column:
        return F.when(when, F.struct(F.lit(full).alias("full"), value.alias("key")))

    keyed = sums.join(halves, ["k1", "k2"]).select(
        "k1", "k2",
        F.explode(
            F.array_compact(
                F.array(
                    entry(own & open_half, False, key(0, F.col("n"), "i", "s_without", "p_without")),
                    entry(less & open_half, False, key(1, F.col("n") - 1, "s_without", "p_without")),
                    entry(own & (F.col("i") == 1), True, key(1, F.col("n"), "s", "p")),
                )
            )
        ).alias("v"),
    )
    return keyed.select("v.key", "v.full", "k1", "k2")


def near_copies(rows: DataFrame, firsts: DataFrame, near_words: int) -> DataFrame:
    """`k1`, `k2` of the lines that are near an earlier line.

    Lines that share no half with another one go first; this loses no pair. Of the lines
    with a common variant only the earliest can be the reason for the others, so each is
    paired with that one, never with all, and the edit distance of the pair is verified.
    """
    halves = firsts.where(F.col("n") >= near_words).select("k1", "k2", F.explode("halves").alias("x"))
    halves = halves.select("k1", "k2", "x.side", "x.m", "x.hash")
    shared = (
        halves.groupBy("side", "m", "hash")
        .agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"))
        .where("lo <> hi")
        .select("side", "m", "hash")
    )
    halves = materialize(halves.join(shared, ["side", "m", "hash"], "left_semi"), "line-halves")
    wanted = materialize(
        firsts.join(halves.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").select(
            "k1", "k2", "first.id", "first.pos", "first.h1", "first.h2"
        ),
        "line-survivors",
    )
    lines = materialize(line_words(rows, wanted), "line-words")
    keys = variants(lines, halves)
    groups = keys.groupBy("key").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).where("lo <> hi").select("key")
    keys = materialize(keys.join(groups, "key", "left_semi"), "line-variants")
    members = keys.join(wanted.select("k1", "k2", "id", "pos"), ["k1", "k2"]).select(
        "key", "full", "k1", "k2", _order("k1", "k2").alias("place")
    )
    # Variants of a changed word reach all of their group; a whole line and shortened ones reach each other.
    changed = ~F.col("has_full")
    best = members.groupBy("key").agg(
        F.max("full").alias("has_full"),
        F.min(F.when(F.col("full"), F.col("place"))).alias("whole"),
        F.min(F.when(~F.col("full"), F.col("place"))).alias("shortened"),
    )
    reason = F.when(changed | F.col("full"), F.col("shortened")).otherwise(F.col("whole"))
    pairs = (
        members.join(best, "key")
        .withColumn("reason", reason)
        .where("reason < place")
        .select("k1", "k2", F.col("reason.k1").alias("r1"), F.col("reason.k2").alias("r2"))
        .distinct()
    )
    reasons = lines.select(F.col("k1").alias("r1"), F.col("k2").alias("r2"), F.col("words").alias("other"))
    verified = pairs.join(lines, ["k1", "k2"]).join(reasons, ["r1", "r2"])
    return verified.where(within_one_edit(F.col("words"), F.col("other"))).select("k1", "k2").distinct()


def dropped_lines(rows: DataFrame, near_words: int) -> DataFrame:
    """`id`, `h1`, `h2`, `drops`: the places, in order, of the lines that a text loses."""
    facts = materialize(line_facts(rows), "lines")
    seen = facts.select("id", "h1", "h2", "pos", "k1", "k2")
    firsts = materialize(
        facts.groupBy("k1", "k2").agg(
            F.count("*").alias("copies"),
            F.min(_order("h1", "h2")).alias("first"),
            F.first("n").alias("n"),
            F.first("halves").alias("halves"),
        ),
        "first-lines",
    )
    near = near_copies(rows, firsts.drop("copies"), near_words).withColumn("near", F.lit(True))
    gone = (
        firsts.select("k1", "k2", "copies", "first")
        .join(near, ["k1", "k2"], "left")
        .where("copies > 1 or near")
        .select("k1", "k2", F.struct("first.none", "first.id", "first.pos").alias("first"), "near")
    )
    drops = seen.join(gone, ["k1", "k2"]).where(F.coalesce("near", F.lit(False)) | (_order() != F.col("first")))
    return drops.groupBy("id", "h1", "h2").agg(F.sort_array(F.collect_set("pos")).alias("drops"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_words: int = NEAR_WORDS
) -> DataFrame:
    """`docs` with the lines left out that repeat an earlier line of the corpus, and `n_dropped`.

    Lines end at \\n and are equal if their words are, whatever white space parts them;
    lines without words stay. What is left of a text is joined by \\n again; a text that loses all lines
    is empty. A null text stays null and an empty one empty. Rows with a null id count as the latest.
    Repeated rows, and lines that tie in id and place, keep the same lines. All rows and
    columns stay (a column `n_dropped` is replaced); an empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashes = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    rows = docs.select(F.col(id_col).alias("id"), hashes[0].alias("h1"), hashes[1].alias("h2"), text.alias("text"))
    drops = materialize(dropped_lines(rows, near_words), "dropped-lines")
    drops = drops.select(*(F.col(c).alias(f"_cut_{c}") for c in ("id", "h1", "h2", "drops")))
    docs = docs.drop("n_dropped")
    there = F.col(id_col).eqNullSafe(F.col("_cut_id")) & (hashes[0] == F.col("_cut_h1")) & (hashes[1] == F.col("_cut_h2"))
    found = docs.join(drops, there, "left")
    lines, count = F.split(text_col, "\n", -1), F.size("_cut_drops")

    def stretch(j: Column) -> Column:
        """The lines between two dropped ones."""
        start = F.when(j == 0, 0).otherwise(F.get("_cut_drops", j - 1) + 1)
        end = F.when(j == count, F.size("_cut_lines")).otherwise(F.get("_cut_drops", j))
        return F.slice("_cut_lines", start + 1, end - start)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), count), stretch)), "\n")
    cut = found.withColumn("_cut_lines", F.when(F.col("_cut_drops").isNotNull(), lines))
    return cut.select(
        *(
            F.when(F.col("_cut_drops").isNull(), F.col(c)).otherwise(kept).alias(c) if c == text_col else F.col(c)
            for c in docs.columns
        ),
        F.when(F.col("_cut_drops").isNull(), 0).otherwise(count).alias("n_dropped"),
    )
