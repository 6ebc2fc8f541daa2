"""Removal of repeated lines by an exact set-similarity join; DataFrame functions only."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluicegate.llm.common import Passing, column, landed

#: Frequencies are kept for so many buckets of words, one small number each, whatever the corpus holds.
BUCKETS = 1 << 16
#: Earliest lines of a prefix word that the others are compared with first.
LEADERS = 4
#: Bits of a word's key below its frequency class.
KEY_BITS = 55
#: The lines meet in so many rounds, one for some of the sizes each, which bounds what is shuffled at a time.
ROUNDS = 2
#: Lines of more words have a bitmap of two longs, others of one.
WIDE = 96
#: What parts words.
GAP = "[ \\t\\r\\n\\x0B\\f]"


def _words(text: Column) -> Column:
    """Lower-cased words, which spaces, tabs and line ends part; the empty words between two of these are left in."""
    return F.split(F.lower(text), GAP)


def _rarity(docs: DataFrame, text: str, buckets: int) -> tuple[list[int], int]:
    """How frequent the words of each bucket are together, in steps of a quarter of a doubling; and the least class
    below which half of all words lie."""
    words = docs.select(F.explode(_words(F.col(text))).alias("word"))
    bucket = F.xxhash64("word").bitwiseAND(F.lit(buckets - 1))
    classes, sizes = [0] * buckets, [0] * 128
    for bucket, n in words.groupBy(bucket.alias("bucket")).count().collect():
        classes[bucket] = min(127, int(4 * math.log2(1 + n)))
        sizes[classes[bucket]] += n
    below, half = 0, 0
    while half < 127 and 2 * below < sum(sizes):
        below, half = below + sizes[half], half + 1
    return classes, half


def _literal(classes: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, classes))), ",").cast("array<tinyint>")


def rarity_classes(docs: DataFrame, text: str, buckets: int = BUCKETS) -> Column:
    """How frequent the words of each bucket are together, as a literal array."""
    return _literal(_rarity(docs, text, buckets)[0])


def line_words(line: Column, classes: Column, buckets: int = BUCKETS) -> Column:
    """Distinct words of a line as numbers, the rarest first: the frequency class, then a hash."""

    def number(key: Column) -> Column:
        rarity = F.get(classes, key.bitwiseAND(F.lit(buckets - 1)).cast("int")).cast("long")
        rarity = F.coalesce(rarity, F.lit(0).cast("long"))  # never NULL, which sorts faster
        return F.shiftleft(rarity, KEY_BITS).bitwiseOR(F.shiftrightunsigned(key, 64 - KEY_BITS))

    numbered = F.transform(F.transform(_words(line), lambda w: F.xxhash64(w)), number)
    return F.array_remove(F.array_distinct(F.sort_array(numbered)), number(F.xxhash64(F.lit(""))))


def _flips(keys: Column) -> Column:
    """A long in which each key flips the bit that its lowest six bits name: two sets differ in as many keys
    at least as their longs do in bits."""
    zero, one = (F.lit(x).cast("long") for x in (0, 1))
    bit = lambda key: F.call_function("shiftleft", one, key.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(keys, zero, lambda bits, key: bits.bitwiseXOR(bit(key)))


def _differ(a: str, b: str) -> Column:
    """In how many words at least the lines of these two sides differ, by their bitmaps. That of a wide line is in two
    halves, which make the one of a narrower line together."""
    (an, bn), (x, y), (u, v) = ([F.col(f"{side}{c}") for side in (a, b)] for c in ("n", "bits", "more"))
    low, high = x.bitwiseXOR(y), u.bitwiseXOR(v)
    return F.when((an > WIDE) & (bn > WIDE), F.bit_count(low) + F.bit_count(high)).otherwise(F.bit_count(low.bitwiseXOR(high)))


def _line_classes(base: DataFrame, least: float, buckets: int = BUCKETS) -> DataFrame:
    """Each distinct line (by a hash of its lower-cased text): where it stands first, how many words it has, the
    bitmap of its rarer words and its prefix. Repeats of a line are reduced in the task that reads them, before any
    shuffle; the words of each are looked at once."""
    classes, half = _rarity(base, "text", buckets)
    lines = base.select("doc_id", "doc", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    lines = lines.where(F.btrim("text", F.lit(" \t\r\n\v\f")) != "").select(
        F.xxhash64(F.lower("text")).alias("line"), F.struct("doc_id", "doc", "pos").alias("first"), "text"
    )
    lines = lines.groupBy("line").agg(F.min("first").alias("first"), F.first("text").alias("text"))
    # A column of its own, as several refer to it; a condition on it would work it out twice.
    lines = lines.select("line", "first", line_words(F.col("text"), _literal(classes), buckets).alias("words"))
    n, words = F.size("words"), F.col("words")
    rare = lambda w: w < F.lit(half << KEY_BITS)
    low, high = (_flips(F.filter(words, lambda w: rare(w) & (w.bitwiseAND(F.lit(64)) == part))) for part in (0, 64))
    return lines.select(
        "line", "first.*", n.alias("n"),
        F.when(n > WIDE, low).otherwise(_flips(F.filter(words, rare))).alias("bits"),
        F.when(n > WIDE, high).otherwise(F.lit(0).cast("long")).alias("more"),
        F.slice(words, 1, n - _at_least(n * least) + 1).alias("prefix"),
    )


def _at_least(x: Column) -> Column:
    return F.ceil(x - 1e-9).cast("int")


def _shared(a: Column, b: Column, least: float) -> Column:
    """How many words two sets of these sizes have to share."""
    return _at_least((a + b) * (least / (1 + least)))


def _short(least: float) -> Column:
    """How many words of a line's prefix are enough against lines of as many words or more, which have to share more."""
    n = F.col("n")
    return n - _shared(n, n, least) + 1


def _step(least: float) -> float:
    return math.log(1 / least) or 1e-3


def _about(n: Column, least: float) -> Column:
    """Sizes in steps by ``least``: similar lines are at most one step apart."""
    return F.floor(F.log(n) / _step(least)).cast("int")


def _led(lines: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of a line and one of the ``LEADERS`` earliest lines of about its length that have one of the words
    that its prefix starts with, where length and bitmap allow them to be similar. Each line has a few such pairs,
    however many share its words."""
    own = ("line", "n", "bits", "more")
    start = F.slice("prefix", 1, _short(least))
    rows = lines.select(*own, "doc_id", "pos", _about(F.col("n"), least).alias("about"), F.explode(start).alias("word"))
    before = W.partitionBy("word", "about").orderBy("doc_id", "pos", "line").rowsBetween(W.unboundedPreceding, -1)
    leaders = F.array(*(F.nth_value(F.struct(*own), k + 1).over(before) for k in range(LEADERS)))
    rows = rows.select(*own, leaders.alias("leaders"))
    rows = rows.select(*own, F.inline("leaders").alias(*(f"a_{c}" for c in own)))
    n, an = F.col("n"), F.col("a_n")
    able = n + an - _differ("", "a_") >= 2 * _shared(n, an, least)
    return rows.where(able).select(F.col("a_line").alias("a"), F.col("line").alias("b")).distinct()


def _matches(lines: DataFrame, least: float, part: int = 0, rounds: int = 1) -> DataFrame:
    """Pairs (a, b) of line classes that the filters leave, ``b`` no longer than ``a``, one of them still ``open``; of
    several rounds those whose ``a`` is of this one's sizes.

    The longer line holds in its prefix a word of the shorter prefix that is enough for ``b``; they meet by this word and
    the size of the longer one. The first such word of a similar pair has enough words left behind it on both sides
    (positional filter); the sizes are close (length filter); and the bitmaps, in which each word flips a bit, differ in
    no more bits than the sets may in words.
    """
    n = F.col("n")

    def side(name: str, sizes: Column, length: Column) -> DataFrame:
        # Size, place and openness travel as one number, as do word and size step.
        own = ["line", "bits", "more", "n", "open"]
        rows = lines.select(*own, "prefix", F.explode(sizes).alias("about"))
        rows = rows.where(F.col("about") % rounds == part)
        rows = rows.select(*own, "about", F.posexplode(F.slice("prefix", 1, length)).alias("i", "word"))
        shape = F.shiftleft(n.cast("long"), 32) + F.col("i") * 2 + F.col("open").cast("int")
        rows = rows.select(F.xxhash64("word", "about").alias("met"), "line", "bits", "more", shape.alias("shape"))
        return rows.toDF(*(f"{name}_{c}" for c in rows.columns))

    def parts(name: str) -> list[Column]:
        shape = F.col(f"{name}_shape")
        n = F.shiftright(shape, 32).cast("int")
        left = n - F.shiftright(shape.bitwiseAND(F.lit(2**32 - 1)), 1).cast("int")
        return [n.alias(f"{name}_n"), left.alias(f"{name}_left"), (shape.bitwiseAND(F.lit(1).cast("long")) == 1).alias(f"{name}_open")]

    an, bn = F.col("a_n"), F.col("b_n")
    shared = _shared(an, bn, least)
    most = F.floor(n / least + 1e-6).cast("int")
    longer = side("a", F.array(_about(n, least)), F.size("prefix"))
    # Lines of a further step have so many words at least, and share as many more.
    size = F.greatest(n, F.ceil(F.exp(F.col("about") * _step(least)) - 1e-6).cast("int"))
    enough = F.greatest(n - _shared(n, size, least) + 1, F.lit(1))
    shorter = side("b", F.sequence(_about(n, least), _about(most, least)), enough)
    met = longer.join(shorter.hint("shuffle_hash"), F.col("a_met") == F.col("b_met"))
    met = met.select("*", *parts("a"), *parts("b")).where(
        (F.col("a_open") | F.col("b_open"))
        & ((an > bn) | ((an == bn) & (F.col("a_line") < F.col("b_line"))))
        & (bn >= an * least - 1e-9)
        & (F.least("a_left", "b_left") >= shared)
        & (an + bn - _differ("a_", "b_") >= 2 * shared)
    )
    return met.select(F.col("a_line").alias("a"), F.col("b_line").alias("b")).distinct()


def _lines_at(texts: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of ``places`` (line, doc, pos and others), each once, with the text of that place in its document, which is split once."""
    place = F.struct(*places.columns)
    per_doc = places.groupBy("doc").agg(F.collect_list(place).alias("places"))
    both = texts.join(per_doc.hint("shuffle_hash"), "doc")

    def found(lines: Column) -> Column:
        return F.transform("places", lambda p: F.struct(p.alias("place"), F.get(lines, p["pos"]).alias("text")))

    rows = both.select(F.inline(F.transform(F.array(F.split("text", "\n")), found)[0]))
    return rows.select("place.*", "text").dropDuplicates(["line"])  # equal documents have the same lines


def _verified(pairs: DataFrame, lines: DataFrame, texts: DataFrame, least: float, passing: Passing) -> DataFrame:
    """The later line (line, doc, pos) of each pair whose sets of words are similar, by the words themselves."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct()
    wanted = lines.select("line", "doc_id", "doc", "pos").join(named.hint("shuffle_hash"), "line", "left_semi")
    words = F.array_remove(F.array_distinct(_words(F.col("text"))), "")
    place = F.struct("doc_id", "doc", "pos").alias("place")
    sets = passing.land(_lines_at(texts, wanted).select("line", place, words.alias("set")), "line-sets")
    x, y = (sets.toDF(side, f"{side}_place", f"{side}_set").hint("shuffle_hash") for side in ("a", "b"))
    both = pairs.join(x, "a").join(y, "b")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    similar = both.where(shared * (1 + least) >= (F.size("a_set") + F.size("b_set")) * least - 1e-9)
    a, b = (F.struct(F.col(c).alias("line"), f"{c}_place.doc", f"{c}_place.pos") for c in ("a", "b"))
    later = F.when(F.col("a_place") > F.col("b_place"), a).otherwise(b)
    return similar.select(later.alias("later")).select("later.*").distinct()


def remove_later_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: float = 0.8,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The columns of ``keep``, then ``text`` without later matches, ``n_lines`` and ``n_removed`` of each row.

    Lines are what newlines part; two match when the Jaccard similarity of their sets of words (lower-cased,
    parted by white space) is ``least`` or more; a line without words matches none. In the order of document key and
    place a line goes when any earlier line matches it, whether that one stays or not. Lines that stay are unchanged.

    Words are ordered by rarity, from counts over all documents in a table of fixed size. Lines of equal
    lower-cased text are one class (a 64-bit hash). Each class sends the words of its prefix, of which two similar
    ones share at least one; what position, length and bitmap filters leave is verified on the words themselves.
    Each class is first compared with the few earliest ones that share a word of its prefix: one match decides, so
    a large group of lines that are all alike is settled by its first ones. Only classes left open then
    meet all others.
    A line that a third of all lines repeat is one class: its repeats are found by a join on the class
    with its first place, and go without being compared.

    A row is known by its key and text: equal rows are one document and come out alike, each as often as it
    came. NULL texts come out NULL with no lines, empty ones empty with one. A NULL key sorts before all others.
    """
    base = docs.select(
        column(key).alias("doc_id"), F.xxhash64(column(key), column(text)).alias("doc"), column(text).alias("text")
    ).where("text is not null")
    lines = landed(_line_classes(base, least), "line-classes")

    texts = base.select("doc", "text")

    def later_of(label: str, *rounds: DataFrame) -> DataFrame:
        """The later line of each pair that is similar."""
        with Passing() as passing:
            pairs = reduce(DataFrame.unionByName, [passing.land(pairs, "line-pairs") for pairs in rounds])
            return landed(_verified(pairs, lines, texts, least, passing), label)

    led = later_of("led-lines", _led(lines, least))
    with Passing() as passing:
        closed = led.select("line", F.lit(True).alias("led"))
        left = lines.select("line", "n", "bits", "more", "prefix").join(closed.hint("shuffle_hash"), "line", "left")
        left = passing.land(left.withColumn("open", F.col("led").isNull()).drop("led"), "open-lines")
        found = later_of("later-lines", *(_matches(left, least, part, ROUNDS) for part in range(ROUNDS)))
    place = F.struct("doc_id", "doc", "pos")
    every = base.select("doc_id", "doc", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    every = every.select("doc_id", "doc", "pos", F.xxhash64(F.lower("line")).alias("line"))
    firsts = lines.select("line", place.alias("place")).hint("shuffle_hash")
    repeats = every.join(firsts, "line").where(place != F.col("place")).select("doc", "pos")
    gone = led.unionByName(found).select("doc", "pos").unionByName(repeats)
    gone = gone.groupBy("doc").agg(F.collect_set("pos").alias("gone"))

    kept = [f"keep_{i}" for i in range(len(keep))]
    rows = docs.select(
        F.xxhash64(column(key), column(text)).alias("doc"),
        column(text).alias("text"),
        *(column(c).alias(k) for c, k in zip(keep, kept)),
    )

    def without(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
        left = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
        clean = F.when(F.col("gone").isNull(), F.col("text")).otherwise(left)
        return F.struct(clean.alias("clean"), F.size(lines).alias("n_lines"), F.size("gone").alias("n_removed"))

    # In an array of one, so that a text is split once.
    given = F.when(F.col("text").isNotNull(), F.transform(F.array(F.split("text", "\n")), without)[0])
    out = rows.join(gone.hint("shuffle_hash"), "doc", "left").select(*kept, given.alias("given")).select(*kept, "given.*")
    return out.select(
        *(F.col(k).alias(c) for k, c in zip(kept, keep)),
        F.col("clean").alias(text),
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.greatest("n_removed", F.lit(0)).alias("n_removed"),
    )
