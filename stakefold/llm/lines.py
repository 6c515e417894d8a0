"""Near-duplicate lines across documents by an exact set-similarity join, in DataFrame functions only.

A line is its set of distinct words (lower case, between white space).  The words of a line are ordered by rarity:
word counts over all texts are kept in a table of fixed size by word hash, so what every task needs to know of the
corpus has a fixed size too; any total order keeps the join exact, a good one keeps it cheap.  Lines of equal sets (by
a digest of 64 bits) are one class from the start.

Rare words, and pairs of them, are shared by many lines that have nothing else in common, and by more of them the
larger the corpus is, so the prefix filter is applied to grams: q words that are neighbours in the order.  A word that only one of two lines has takes away at most q grams of its own line and q - 1 of the other.
So of the grams of a set of n words a matching set of m words lacks at most q(n - k) + (q - 1)(m - k), k being
their intersection, which is at most q(1 - t)n as long as that is less than n.  The first gram, in the order of rarity, that both have
is therefore among the first q(1 - t)n + 1 of either.  tiers() finds for which sizes there is such a gram: three words
from six words on, two words below (at 80 %); sets too small for any match but their own copies give no gram.

What shares a gram and has a fitting size is verified on the words themselves: first against the earliest class of each gram,
then, where that fails, against all earlier ones.  A gram that many classes have belongs to a family of lines that are
nearly alike; there the join itself compares the words and gives each class once, however many match it.  Two classes that share a
crowded gram are found by it, all others share a gram of few classes.  A line goes if an earlier line (by doc_id, then place in the document) matches it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stakefold.llm import common

SPACE = "[ \\t\\x0B\\f\\r]+"
ANY_SPACE = "[ \\t\\n\\x0B\\f\\r]+"
SIZE_SHIFT, MOST = 53, 1023  # a digest: the size, up to this one, above 53 bits of hash
RANK_SHIFT = 56  # a word's key: 7 bits of rarity above 56 bits of hash


@dataclass(frozen=True)
class Settings:
    """Lines with 100 * intersection >= percent * union match; longest is the most words of a gram, slots the size of the
    table of word counts.  Classes and grams are dealt out in so many rounds, one after the other, so that the disks hold the shuffle of one.
    In grams of more than crowd classes, hashes of all words (mark_bits each) are compared before the words."""

    percent: int = 80
    longest: int = 3
    rounds: int = 4
    crowd: int = 64
    mark_bits: int = 32
    slots: int = 1 << 18
    id_slots: int = 1 << 20


def ceil_ratio(a: Column, over: int, under: int) -> Column:
    """The least integer not below a * over / under, for integers from 0 on."""
    return F.floor((a * over + (under - 1)) / F.lit(under)).cast("int") if under != 1 else a * over


def slot_of(h: Column, slots: int) -> Column:
    """The slot of a word hash: its leading bits."""
    return F.shiftrightunsigned(h, 64 - (slots.bit_length() - 1)).cast("int")


def ranks(docs: DataFrame, settings: Settings) -> Column:
    """A constant array with a number for every slot: the rarity of its words, rising with the logarithm of their count.
    Words are counted between single spaces here; what other white space holds together only shifts the order a little."""
    text = F.replace(F.lower("text"), F.lit("\n"), F.lit(" "))
    words = docs.select(F.explode(F.split(text, " ")).alias("word"))
    counts = words.groupBy(slot_of(F.xxhash64("word"), settings.slots).alias("slot")).agg(F.count("*").alias("n"))
    rank = F.least(F.lit(126), 1 + F.floor(F.log2(F.col("n") + 1) * 4)).cast("int")
    every = docs.sparkSession.range(settings.slots).withColumnRenamed("id", "slot").join(counts, "slot", "left")
    in_order = F.sort_array(F.collect_list(F.struct("slot", F.coalesce(rank, F.lit(0)).alias("rank"))))
    shown = every.agg(F.concat_ws(",", F.transform(in_order, lambda s: s["rank"].cast("string"))).alias("r")).first()["r"]
    return F.split(F.lit(shown), ",").cast("array<bigint>")  # of fixed size


def split_lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def words_of(line: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(line), SPACE)), "")


def sketch_half(hashes: str, odd: int) -> Column:
    """64 bits of the sketch, for the words whose hash is even or odd."""
    none = F.lit(0).cast("long")
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 1).bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(hashes, none, lambda seen, h: seen.bitwiseOR(F.when(h.bitwiseAND(F.lit(1)) == odd, bit(h)).otherwise(none)))


def line_table(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, line_no, h1, n, s0, s1, prefix) of the lines with words: a digest of the set, its size, a sketch of 128 bits,
    each set if a word has that place, and its rarest words, as 31 bits of rarity and hash each, which tell apart what
    is a candidate, not what matches.  The digest begins with the size, so digests are in the order of sizes."""
    table = ranks(docs, settings)
    # this filter, not one on the set's size, or the set would be made once more below it
    lines = split_lines(docs).where(F.col("line").rlike("[^ \\t\\x0B\\f\\r]"))
    # a pattern of one character is split several times as fast
    words = F.when(F.col("line").rlike("[\\t\\x0B\\f\\r]"), F.split(F.lower("line"), SPACE)).otherwise(F.split(F.lower("line"), " "))
    lines = lines.select("doc_id", "line_no", words.alias("words"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))

    def key(h: Column) -> Column:
        rank = F.get(table, slot_of(h, settings.slots))
        return F.shiftleft(rank, RANK_SHIFT).bitwiseOR(F.shiftrightunsigned(h, 64 - RANK_SHIFT))

    empty = F.xxhash64(F.lit(""))  # what two white spaces, or a line's first or last one, leave
    lines = lines.select("doc_id", "line_no", F.array_remove(F.array_distinct(hashes), empty).alias("hashes"))
    lines = lines.select("doc_id", "line_no", F.sort_array(F.transform("hashes", key)).alias("keys"),
                         *[sketch_half("hashes", odd).alias(f"s{odd}") for odd in (0, 1)])
    n = F.size("keys")
    digest = F.shiftleft(F.least(n, F.lit(MOST)).cast("long"), SIZE_SHIFT).bitwiseOR(F.shiftrightunsigned(F.xxhash64("keys"), 64 - SIZE_SHIFT))
    rarest = F.slice("keys", F.lit(1), grams_lost(n, settings.longest, settings.percent) + settings.longest)
    return lines.select("doc_id", "line_no", digest.alias("h1"), n.alias("n"), "s0", "s1",
                        F.transform(rarest, lambda k: F.shiftrightunsigned(k, 32).cast("int")).alias("prefix"))


def grams_lost(n: Column, words: int, percent: int) -> Column:
    """How many grams of so many words a set of this size may have that a matching set has not."""
    return F.floor(n * (words * (100 - percent)) / 100).cast("int")


def tiers(percent: int, longest: int = 3) -> list[tuple[int, int, int | None]]:
    """(words, low, high): how many words a gram may have, so that any two matching sets share one, if the larger set has low to
    high words.  Sets that match only their equals are in none."""

    def holds(words: int, n: int) -> bool | None:
        found = None
        for m in range(-(-percent * n // 100), n + 1):
            k = -(-percent * (n + m) // (100 + percent))
            if k <= min(m, n - 1):
                if n - words + 1 - words * (n - k) - (words - 1) * (m - k) < 1:
                    return False
                found = True
        return found

    out: list[tuple[int, int, int | None]] = []
    high = None
    for words in range(longest, 0, -1):
        spare = 100 - words * (100 - percent)
        if spare <= 0:
            continue
        # from this size on q(1 - t)n < n - q + 1 holds for every n
        fails = [n for n in range(1, high or -(-100 * words // spare) + 1) if holds(words, n) is False]
        low = fails[-1] + 1 if fails else 1
        sizes = [n for n in range(low, high) if holds(words, n)] if high else [low]
        if sizes:
            out.append((words, sizes[0], sizes[-1] if high else None))
        if low == 1 or not fails:
            break
        high = low
    return out


def overlap_needed(na: Column, nb: Column, percent: int) -> Column:
    """The least intersection with which sets of these sizes reach the threshold."""
    return ceil_ratio(na + nb, percent, 100 + percent)


def sizes_fit(na: Column, nb: Column, percent: int) -> Column:
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * percent


def may_match(a: str, b: str, percent: int) -> Column:
    """Whether two sets (n, s0, s1) can reach the threshold: the sizes allow it, and not so many places of one sketch are
    empty in the other that too few words are left to share."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    alone = [sum((F.bit_count(F.col(f"{x}.{c}").bitwiseAND(F.bitwise_not(F.col(f"{y}.{c}")))) for c in ("s0", "s1")), F.lit(0))
             for x, y in ((a, b), (b, a))]
    return sizes_fit(na, nb, percent) & (F.least(na - alone[0], nb - alone[1]) >= overlap_needed(na, nb, percent))


def words_match(a: str, b: str, percent: int) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return 100 * shared >= percent * (F.size(a) + F.size(b) - shared)


def classes(lines: DataFrame) -> DataFrame:
    """(h1, n, s0, s1, prefix, d, l, copies): the sets of words, size, sketch and rarest words, first line and number of lines."""
    place = F.struct(F.col("doc_id").alias("d"), F.col("line_no").alias("l"))
    found = lines.groupBy("h1").agg(*[F.min(c).alias(c) for c in ("n", "s0", "s1", "prefix")], F.min(place).alias("first"),
                                    F.count("*").alias("copies"))
    return found.select("h1", "n", "s0", "s1", "prefix", "first.d", "first.l", "copies")


def shared_grams(sets: DataFrame, settings: Settings = Settings(), turn: int = 0) -> DataFrame:
    """(gram, h1, crowded): digests of neighbouring words that the prefixes of several classes of fitting sizes have, with these
    classes, and whether the gram has more than crowd of them; those of one round.  A class has a gram once, but for hashes that are equal."""
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = None
    for words, low, high in tiers(settings.percent, settings.longest):
        fits = F.floor(F.col("n") * 100 / settings.percent) >= low
        own = sets.where(fits if high is None else fits & (F.col("n") <= high))
        own = own.select("h1", "n", "prefix", F.posexplode("prefix").alias("at", "w0"))
        gram = F.xxhash64(F.lit(words), "w0", *[F.get("prefix", F.col("at") + i) for i in range(1, words)])
        own = own.where((F.col("at") <= grams_lost(F.col("n"), words, settings.percent)) & (F.col("at") + words <= F.size("prefix")))
        own = own.select(gram.alias("gram"), "h1")
        every = own if every is None else every.unionAll(own)
    rows = every.where(F.pmod("gram", F.lit(settings.rounds)) == turn).repartition(parts, "gram")
    # digests are in the order of sizes, so of the sizes that fit one of the nearest two does, if any does
    near = Window.partitionBy("gram").orderBy("h1")
    size = F.shiftrightunsigned("h1", SIZE_SHIFT)
    rows = rows.select("gram", "h1", F.lag("h1").over(near).alias("below"), F.lead("h1").over(near).alias("above"))
    lower, upper = F.shiftrightunsigned("below", SIZE_SHIFT), F.shiftrightunsigned("above", SIZE_SHIFT)
    fits = (lower * 100 >= size * settings.percent) | (size * 100 >= upper * settings.percent)
    several = rows.where(fits).select("gram", "h1")
    return several.withColumn("crowded", F.count("*").over(Window.partitionBy("gram")) > settings.crowd)


def earliest_pairs(rows: DataFrame, settings: Settings) -> DataFrame:
    """(d, l, ed, el): classes and a class that is the earliest of one of their grams."""
    first = F.min(F.struct("d", "l", "n", "s0", "s1")).over(Window.partitionBy("gram"))
    both = rows.select(F.struct("d", "l", "n", "s0", "s1").alias("x"), first.alias("e"))
    later = (F.col("e.d") != F.col("x.d")) | (F.col("e.l") != F.col("x.l"))
    both = both.where(later & may_match("x", "e", settings.percent))
    return both.select("x.d", "x.l", F.col("e.d").alias("ed"), F.col("e.l").alias("el")).distinct()


def earlier_in_gram() -> Column:
    """Whether y is an earlier class of the same gram as x."""
    earlier = (F.col("y.d") < F.col("x.d")) | ((F.col("y.d") == F.col("x.d")) & (F.col("y.l") < F.col("x.l")))
    return (F.col("x.gram") == F.col("y.gram")) & earlier


def other_pairs(rows: DataFrame, settled: DataFrame, settings: Settings) -> DataFrame:
    """(d, l, ed, el): classes not settled yet and all earlier classes of their grams that are not crowded."""
    few = rows.where(~F.col("crowded")).drop("crowded")
    x, y = few.join(settled, ["d", "l"], "left_anti").alias("x"), few.alias("y")
    pairs = x.join(y, earlier_in_gram() & may_match("x", "y", settings.percent))
    return pairs.select("x.d", "x.l", F.col("y.d").alias("ed"), F.col("y.l").alias("el")).distinct()


def open_crowds(rows: DataFrame, settled: DataFrame) -> DataFrame:
    """The rows of crowded grams that have a class not settled yet, and whether the row's own is."""
    crowded = rows.where("crowded").drop("crowded").join(settled.withColumn("known", F.lit(True)), ["d", "l"], "left")
    left_over = F.max(F.col("known").isNull()).over(Window.partitionBy("gram"))
    return crowded.withColumn("left_over", left_over).where("left_over").select("gram", "d", "l", "n", "s0", "s1", F.col("known").isNotNull().alias("settled"))


def crowd_matches(crowd: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """(d, l): classes not settled yet that an earlier class of their crowded grams matches.  Nearly alike lines of a large family,
    which no shared gram tells apart, are told apart inside the join, by short hashes of their words (marks) and then by the words.
    It ends with a class's first match, so it gives no more rows than it is given.  What hashes that two words of a line share make the
    marks fall short of is made up for."""
    marks = F.array_distinct(F.transform("words", lambda w: F.xxhash64(w).bitwiseAND(F.lit((1 << settings.mark_bits) - 1))))
    own = crowd.join(texts.withColumn("marks", marks), ["d", "l"]).withColumn("short", F.col("n") - F.size("marks"))
    x, y = own.where("not settled").alias("x"), own.alias("y")
    common_marks = F.size(F.array_intersect("x.marks", "y.marks")) + F.least("x.short", "y.short")
    enough = common_marks >= overlap_needed(F.col("x.n"), F.col("y.n"), settings.percent)
    fits = earlier_in_gram() & may_match("x", "y", settings.percent) & enough
    found = x.join(y, fits & words_match("x.words", "y.words", settings.percent), "left_semi")
    return found.select("d", "l").distinct()


def may_be_in(ids: DataFrame, names: list[str], slots: int) -> Column:
    """Whether the slot of a key holds one of the ids; a table of bits of fixed size, without false negatives."""
    slot = F.pmod(F.xxhash64(*names), F.lit(slots))
    bits = ids.select(slot.alias("s")).groupBy(F.floor(F.col("s") / 64).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("b"))
    every = ids.sparkSession.range(slots // 64).withColumnRenamed("id", "w").join(bits, "w", "left")
    filled = F.sort_array(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))))
    table = every.groupBy().agg(F.transform(filled, lambda s: s["b"]).alias("t")).scalar()
    return F.call_function("getbit", F.get(table, F.floor(slot / 64).cast("int")), (slot % 64).cast("int")) == 1


def words_by_line(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """(d, l, words) of the lines (d, l) that are wanted."""
    lines = split_lines(docs).withColumnsRenamed({"doc_id": "d", "line_no": "l"})
    found = lines.where(may_be_in(wanted, ["d", "l"], settings.id_slots)).join(wanted, ["d", "l"])
    return found.select("d", "l", words_of(F.col("line")).alias("words"))


def sides(pairs: DataFrame) -> DataFrame:
    """(d, l) of the lines in pairs (d, l, ed, el), each once."""
    return pairs.select("d", "l").unionAll(pairs.select(F.col("ed").alias("d"), F.col("el").alias("l"))).distinct()


def matching(texts: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    """(d, l) of the pairs whose lines, compared word by word, reach the threshold."""
    other = texts.select(F.col("d").alias("ed"), F.col("l").alias("el"), F.col("words").alias("earlier"))
    both = pairs.join(texts, ["d", "l"]).join(other, ["ed", "el"])
    return both.where(words_match("words", "earlier", settings.percent)).select("d", "l").distinct()


def removed_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, removed): the sorted numbers, from 0, of the lines that an earlier line matches."""
    common.drop_used_shuffles(docs.sparkSession)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = known.where("doc_id is not null and text is not null")
    # Stored, not checkpointed: the shuffles of a stored step go when it ends.
    lines = common.stored(line_table(known, settings), "lines")
    turns = range(settings.rounds)
    own = [common.stored(classes(lines.where(F.pmod("h1", F.lit(settings.rounds)) == turn)), "line-sets") for turn in turns]
    sets = reduce(DataFrame.unionAll, own)
    places = common.stored(lines.select("doc_id", "line_no", "h1"), "line-places")
    common.drop_stored(lines)
    shared = [common.stored(shared_grams(sets, settings, turn), "shared-grams") for turn in turns]
    rows = reduce(DataFrame.unionAll, shared).join(sets.select("h1", "n", "s0", "s1", "d", "l"), "h1").drop("h1")
    rows = common.stored(rows, "candidates")
    firsts = common.stored(sets.select("h1", "d", "l", "copies"), "line-firsts")
    common.drop_stored(*shared, *own)
    # A class that matches a class which is the earliest of some of its grams is settled; only the others meet all earlier ones.
    earliest = common.stored(earliest_pairs(rows, settings), "earliest-pairs")
    near_first = common.stored(matching(words_by_line(known, sides(earliest), settings), earliest, settings), "settled-lines")
    others = common.stored(other_pairs(rows, near_first, settings), "other-pairs")
    crowd = common.stored(open_crowds(rows, near_first), "crowds")
    common.drop_stored(rows, earliest)
    wanted = common.stored(sides(others).unionAll(crowd.select("d", "l").distinct()).distinct(), "candidate-lines")
    texts = common.stored(words_by_line(known, wanted, settings), "candidate-words")
    family = common.stored(crowd_matches(crowd, texts, settings), "crowd-matches")
    common.drop_stored(crowd, wanted)
    later = common.stored(near_first.unionAll(family).unionAll(matching(texts, others, settings)).distinct(), "later-lines")
    common.drop_stored(texts, near_first, others, family)
    marked = firsts.join(later.withColumn("later", F.lit(True)), ["d", "l"], "left").where("later or copies > 1")
    gone = places.join(marked.select("h1", "d", "l", "later"), "h1")
    place = F.struct(F.col("doc_id").alias("d"), F.col("line_no").alias("l"))
    gone = gone.where(F.col("later") | (place > F.struct("d", "l")))
    gone = gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))
    gone = common.stored(gone, "removed-lines")
    common.drop_stored(places, firsts, later)
    return gone


def counted(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) of every document; removed lists line numbers, joined by commas.

    Null texts have no line.  Lines without a word are never removed.  Rows with a null doc_id keep their lines and
    remove none.  Rows that share a doc_id share their places: a line at the first place of its set stays in each.  Only
    doc_id and text are read; an empty table gives no rows."""
    gone = removed_lines(docs, settings)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.size(F.split(F.col("text").cast("string"), "\n")), F.lit(0)).alias("n_lines"))
    out = rows.join(gone, "doc_id", "left")
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                      F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce(F.array_join(F.transform("removed", lambda i: i.cast("string")), ","), F.lit("")).alias("removed"))


def deduplicate(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents without the removed lines, n_chars set anew if there is such a column, other columns as they are.
    Documents all of whose lines with words went are dropped: every line of theirs stands in an earlier document."""
    gone_id, removed = common.unused_name(docs, "gone_id"), common.unused_name(docs, "removed")
    gone = removed_lines(docs, settings).select(F.col("doc_id").alias(gone_id), F.col("removed").alias(removed))
    rows = docs.join(gone, docs["doc_id"].cast("long") == F.col(gone_id), "left")
    rest = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(removed, i))
    text = F.when(F.col(removed).isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    columns = [text.alias(c) if c == "text" else F.length(text).cast("long").alias(c) if c == "n_chars" else docs[c] for c in docs.columns]
    emptied = F.col(removed).isNotNull() & F.trim(F.regexp_replace(text, ANY_SPACE, " ")).eqNullSafe("")
    return rows.where(~emptied).select(*columns)
