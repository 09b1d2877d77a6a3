"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts become lists of words. Every run of ``GRAM`` words has a hash; of each ``SPAN - GRAM + 1``
hashes in a row (those of one window of ``SPAN`` words) the smallest is kept, the rightmost of
equal ones. Document and item choose alike in equal windows, so every shared window holds a
fingerprint that both have kept: joining the fingerprints finds all shared windows. Each hit is
then extended word by word, at most ``SPAN - GRAM`` words to either side, which is as far as a
window through it can reach; a hit stays if its run holds a whole window. Words are compared, so
a hash collision is no hit.

Items shorter than ``SPAN`` words are one window each; for every such length that the items
have, all runs of that many words are joined too.

A fingerprint with equal words around it is one row, whatever the number of items that have it:
hits carry a digest of that set of items (a bundle). Rows of a document with the same bundles share
one list of items, which is made once for all such documents.

The fingerprints are broadcast if they take at most ``BROADCAST_BYTES``: then the documents are read
once, and their words never cross a shuffle. Otherwise a first pass sends a hash and a place for each
fingerprint of a document to where the items' hashes are, and a second sends, for those that
met, the few words that a window around them can reach: so what is shuffled grows with a
document's length, and only with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.llm.common import written

SPAN = 13
GRAM = 7
#: A fingerprint is one long: a hash above, and below it how far the place is from the end of
#: all places, so that the least of equal hashes is the rightmost. No list has more places than these bits count.
PLACE_BITS = 31
LAST_PLACE = (1 << PLACE_BITS) - 1
#: Bytes of the fingerprints' words, and of 64 more for each.
BROADCAST_BYTES = 64 << 20

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; an empty list for null."""
    lowered = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(lowered, SEPARATORS), ""), F.array().cast("array<string>"))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row: later lambdas use the value, not the expression."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _packed(words: Column, at: Column, n: int) -> Column:
    """Fingerprint of the ``n`` words from place ``at`` (0 is the first)."""
    h = F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.slice(words, at + 1, n)), PLACE_BITS), PLACE_BITS)
    return h.bitwiseOR((F.lit(LAST_PLACE) - at).cast("long"))


def _runs(words: Column, n: int) -> Column:
    return F.when(
        F.size(words) >= n, F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda at: _packed(words, at, n))
    ).otherwise(F.array().cast("array<bigint>"))


def _with_fingerprints(df: DataFrame, short: list[int]) -> DataFrame:
    """``df`` (with ``words``) and ``kept``: the winnowed fingerprints and those of all runs of the short lengths."""
    wide = SPAN - GRAM + 1
    df = _once(df, "grams", _runs(F.col("words"), GRAM))
    least = F.when(
        F.size("grams") >= wide,
        F.transform(F.sequence(F.lit(1), F.size("grams") - (wide - 1)), lambda at: F.array_min(F.slice(F.col("grams"), at, wide))),
    ).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn("kept", F.concat(F.array_distinct(least), *(_runs(F.col("words"), n) for n in short))).drop("grams")


def _hash_and_place(kept: Column) -> tuple[Column, Column]:
    return F.shiftright(kept, PLACE_BITS), (F.lit(LAST_PLACE) - kept.bitwiseAND(F.lit(LAST_PLACE))).cast("int")


def _around(words: Column, place: Column, n: Column) -> tuple[Column, Column, Column]:
    """The run of ``n`` words at ``place``, the words before it (nearest first) and after it."""
    reach = SPAN - GRAM
    before = F.reverse(F.slice(words, F.greatest(place - (reach - 1), F.lit(1)), F.least(place, F.lit(reach))))
    return F.slice(words, place + 1, n), before, F.slice(words, place + n + 1, reach)


def _equal_start(a: Column, b: Column) -> Column:
    """How many leading elements two lists share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(same, False)
    return F.when(differs == 0, F.size(same)).otherwise(differs - 1).cast("int")


def item_fingerprints(items: DataFrame, item_id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, list[int]]:
    """One row per fingerprint and the words around it, with the digest ``bundle`` of the items that have
    it; (bundle, items); and the lengths below ``SPAN`` that items have. Items without an id are in no
    bundle (their windows are hit all the same)."""
    base = _once(
        items.select(F.col(item_id_col).cast("string").alias("item"), F.col(text_col).alias("t")), "words", words_of(F.col("t"))
    ).drop("t")
    short = sorted(r[0] for r in base.select(F.size("words").alias("n")).where(f"n between 1 and {SPAN - 1}").distinct().collect())
    own = F.least(F.size("words"), F.lit(SPAN))
    n = F.when(own < SPAN, own).otherwise(F.lit(GRAM))
    kept = _with_fingerprints(base.where(own == SPAN), []).select("item", "words", "kept")
    for length in short:
        whole = base.where(own == length).select("item", "words", F.array(_packed(F.col("words"), F.lit(0), length)).alias("kept"))
        kept = kept.unionAll(whole)
    rows = kept.select("item", "words", own.alias("need"), n.alias("run"), F.explode("kept").alias("k"))
    h, place = _hash_and_place(F.col("k"))
    rows = _once(rows, "place", place).withColumn("hash", h)
    core, before, after = _around(F.col("words"), F.col("place"), F.col("run"))
    whole = F.col("need") < SPAN
    nothing = F.array().cast("array<string>")
    own_columns = ["hash", "need", "run", "core", "before", "after"]
    each = written(
        rows.select(
            "hash",
            "item",
            "need",
            "run",
            core.alias("core"),
            F.when(whole, nothing).otherwise(before).alias("before"),
            F.when(whole, nothing).otherwise(after).alias("after"),
        ).distinct()
    )
    # The sum of the items' digests names their set, so no fingerprint holds a list of them.
    sums = [F.sum(F.conv(F.substring(F.sha2("item", 256), 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")).cast("string") for k in range(3)]
    prints = written(each.groupBy(*own_columns).agg(F.concat_ws(" ", F.count("item").cast("string"), *sums).alias("bundle")))
    named = each.where("item is not null")
    same = [named[c] == prints[c] for c in own_columns]
    bundles = written(named.join(prints, same).select("bundle", "item").distinct())
    return prints, bundles, short


def _looked_up(docs: DataFrame, prints: DataFrame, short: list[int], kept: list[str]) -> DataFrame:
    """Rows of ``docs`` (id, row, kept columns, t) for each fingerprint of theirs that items have, and one without: n_words,
    k, the words before its place (nearest first) and from there on, and the columns of ``prints``."""
    reach = SPAN - GRAM
    h, place = _hash_and_place(F.col("k"))
    nothing = F.array(F.lit(None).cast("bigint"))
    # The null that each row begins with matches nothing and keeps rows without hits.
    if _broadcast_bytes(prints) <= BROADCAST_BYTES:
        base = _with_fingerprints(_once(docs, "words", words_of(F.col("t"))).drop("t"), short)
        sides = F.broadcast(prints)
    else:
        docs = written(docs)
        all_places = _with_fingerprints(_once(docs.select("row", "t"), "words", words_of(F.col("t"))).drop("t"), short).select("row", F.explode("kept").alias("k"))
        met = all_places.withColumn("hash", h).join(prints.select("hash").distinct(), "hash", "left_semi")
        places = written(met.groupBy(F.col("row").alias("row_")).agg(F.collect_list("k").alias("kept")))  # of one document
        base = docs.join(places, F.col("row") == F.col("row_"), "left").withColumn("kept", F.coalesce("kept", F.array().cast("array<bigint>")))
        base = _once(base, "words", words_of(F.col("t"))).drop("t")
        sides = prints
    rows = base.select("id", "row", *kept, "words", F.explode(F.concat(nothing, F.col("kept"))).alias("k")).select(
        "id", "row", *kept, F.size("words").cast("long").alias("n_words"), "k", h.alias("hash_"), place.alias("place"), "words"
    )
    if sides is prints:
        rows = rows.select("*", *(x.alias(c) for x, c in zip(_near(F.col("words"), F.col("place"), max([GRAM, *short]) + reach), ("left_words", "right_words"), strict=True))).drop("words")
    found = rows.join(sides, F.col("hash_") == F.col("hash"), "left").where("k is null or hash is not null")
    if sides is not prints:
        found = found.select("*", *(x.alias(c) for x, c in zip(_near(F.col("words"), F.col("place"), F.col("run") + reach), ("left_words", "right_words"), strict=True))).drop("words")
    return found


def _near(words: Column, place: Column, ahead: Column | int) -> tuple[Column, Column]:
    """The words before a place, nearest first, and ``ahead`` words from there on."""
    reach = SPAN - GRAM
    before = F.reverse(F.slice(words, F.greatest(place - (reach - 1), F.lit(1)), F.least(place, F.lit(reach))))
    return before, F.slice(words, place + 1, ahead)


def _broadcast_bytes(prints: DataFrame) -> int:
    return prints.agg(F.sum(64 + F.octet_length(F.concat_ws(" ", "core", "before", "after")))).first()[0] or 0


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """For each row of ``docs``: ``id_col``, n_words, n_hit, items (sorted array of item ids as
    strings), hits (array of struct<first, last>: runs of words that hold windows, by place),
    contaminated, and the columns named in ``keep``.

    A word is hit if it lies in any occurrence of an item's window of ``SPAN`` words (of all its
    words, if it has fewer). A row counts as contaminated if it has hits and 20 * n_hit >=
    n_words. Null and wordless texts have no words and no hits; null and wordless items match
    nothing; windows of items with a null id are hit but not listed. Repeated ids stay repeated
    rows. Without items, nothing is hit; without rows, nothing is returned.
    """
    prints, bundles, short = item_fingerprints(items, item_id_col, item_text_col)
    own = [F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep or [])]
    base = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), *own, F.col(text_col).cast("string").alias("t"))
    kept = [f"keep_{k}" for k in range(len(own))]
    found = _looked_up(base, prints, short, kept)
    after = F.slice("right_words", F.col("run") + 1, SPAN - GRAM)
    found = found.select(
        "id", "row", *kept, "n_words", "bundle", "need", "run", "place",
        (F.slice("right_words", 1, F.col("run")) == F.col("core")).alias("same"), F.struct(F.col("left_words").alias("x"), F.col("before").alias("y")).alias("left"),
        F.struct(after.alias("x"), F.col("after").alias("y")).alias("right"),
    )
    left, right = _equal_start(F.col("left.x"), F.col("left.y")), _equal_start(F.col("right.x"), F.col("right.y"))
    # A row's own columns stay beside each hit until here; only places go on.
    hit = F.when(F.col("same"), F.struct((F.col("place") - left).alias("first"), (F.col("place") + F.col("run") + right - 1).alias("last")))
    found = found.select("id", "row", *kept, "n_words", "bundle", "need", hit.alias("hit"))
    long_enough = (F.col("hit.last") - F.col("hit.first") + 1) >= F.col("need")
    found = found.select(
        "id", "row", *kept, "n_words", F.when(long_enough, F.col("bundle")).alias("bundle"), F.when(long_enough, F.col("hit")).alias("hit")
    )
    per_row = found.groupBy("id", "row", *kept).agg(
        F.max("n_words").alias("n_words"), F.collect_set("bundle").alias("bundles"), F.sort_array(F.collect_set("hit")).alias("hits")
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("n"), F.lit(-1).alias("last")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(acc["last"], x["first"] - 1))).alias("n"),
            F.greatest(acc["last"], x["last"]).alias("last"),
        ),
        lambda acc: acc["n"].cast("long"),
    )
    per_row = written(per_row.withColumn("n_hit", covered))
    # One list of items for all rows that have the same bundles.
    sets = per_row.where(F.size("bundles") > 0).select(F.array_sort("bundles").alias("bundles")).distinct()
    listed = (
        sets.select(F.sha2(F.concat_ws(",", "bundles"), 256).alias("set_"), F.explode("bundles").alias("bundle"))
        .join(bundles, "bundle")
        .select("set_", "item")
        .distinct()
        .groupBy("set_")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    # Rows without a bundle are of no set, and each of its own, so that they aren't dealt to one task.
    set_of = F.when(F.size("bundles") > 0, F.sha2(F.concat_ws(",", F.array_sort("bundles")), 256)).otherwise(F.col("row").cast("string"))
    per_row = per_row.withColumn("set", set_of).join(listed, F.col("set") == F.col("set_"), "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return per_row.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_hit",
        "items",
        "hits",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        *(F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep or [])),
    )
