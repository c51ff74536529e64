"""Repeated runs of lines, found by winnowing; DataFrame functions only.

A document is the sequence of its lines' hashes. In every window of ``window`` successive k-grams of lines the least k-gram is
selected (the rightmost of equals), so any two documents that share window + k - 1 successive lines have a selected
k-gram in common. Shorter runs are fingerprints of their own where they have ``LONG`` words, and so is the line of a document that has
only one. Every fingerprint is joined to its first occurrence; later ones go, and each match is extended line by line.

No document's lines travel to another's. Past its k-gram a match needs to be followed for window - 1 lines only: beyond them the run
holds the next selected k-gram, which both documents selected and which is extended in turn. So a lengthened k-gram is a key
like any other, and the line that it adds goes where the same lengthened k-gram occurs earlier. A document of n lines makes a number
of rows proportional to n, however often its lines repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.common import HEAVY
from tidelake.session import checkpointed

K = 2
WINDOW = 2
LONG = 50
BLANK = " \t\r"
WORD = r"[^\x20\x09-\x0D]+"


def line_hash(line: Column) -> Column:
    """60 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("long")


def identity(doc_id: str, text: str) -> Column:
    """A document is its id and its text; rows that repeat both are one document."""
    return F.unhex(F.md5(F.concat_ws("|", F.col(doc_id).cast("string"), F.md5(F.col(text).cast("binary"))).cast("binary")))


def selected(hashes: Column, k: int, window: int) -> Column:
    """Places of the selected k-grams; a document with fewer than ``window`` of them has one window."""
    grams = F.size(hashes) - k + 1

    def least(start: Column) -> Column:
        inside = F.sequence(start, F.least(start + window, grams) - 1)
        return -F.array_min(F.transform(inside, lambda i: F.struct(F.slice(hashes, i + 1, k).alias("gram"), (-i).alias("back"))))["back"]

    starts = F.sequence(F.lit(0), F.greatest(grams - window, F.lit(0)))
    return F.when(grams > 0, F.array_distinct(F.transform(starts, least))).otherwise(F.array().cast("array<int>"))


def wordy(words: Column, size: int, long: int) -> Column:
    """Places of ``size`` successive lines that have ``long`` words; also that of a document's only line."""
    def enough(i: Column) -> Column:
        return F.aggregate(F.slice(words, i + 1, size), F.lit(0), lambda a, x: a + x) >= long

    places = F.filter(F.sequence(F.lit(0), F.size(words) - size), enough)
    if size == 1:
        places = F.when(F.size(words) == 1, F.array(F.lit(0))).otherwise(places)
    return F.when(F.size(words) >= size, places).otherwise(F.array().cast("array<int>"))


def sequences(docs: DataFrame) -> DataFrame:
    """(me, doc_id, hashes, words, at): the lines that are not blank, and their places among all lines. Stored once."""
    lines = F.transform(F.split(F.col("text"), "\n", -1), lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(BLANK)).alias("line")))
    rows = docs.select(identity("doc_id", "text").alias("me"), "doc_id", F.filter(lines, lambda x: x["line"] != "").alias("lines"))
    rows = rows.where(F.size("lines") > 0).select(
        "me", "doc_id", F.transform("lines", lambda x: line_hash(x["line"])).alias("hashes"),
        F.transform("lines", lambda x: F.regexp_count(x["line"], F.lit(WORD))).alias("words"), F.col("lines.at").alias("at"))
    return checkpointed(rows.dropDuplicates(["me"]))


def keyed(rows: DataFrame, kind: Column, lines: Column, *kept: str | Column) -> DataFrame:
    """Rows by two hashes of some lines and of the kind of fingerprint that they are."""
    return checkpointed(rows.select("me", "doc_id", "place", *kept, F.xxhash64(kind, lines).alias("a"), F.xxhash64(lines, kind).alias("b")))


def repeated(rows: DataFrame) -> DataFrame:
    """Rows whose key occurs more than once, with ``later``: whether the key occurs before. ``rows`` are stored.

    Keys of over a thousandth of all rows, fewer than a thousand, meet their first occurrence by broadcast, so that a hot line
    gathers nowhere.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "me", "place")
    firsts = checkpointed(rows.groupBy(F.col("a").alias("x"), F.col("b").alias("y")).agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1"))
    hot, same = F.col("times") * HEAVY > rows.count(), (F.col("a") == F.col("x")) & (F.col("b") == F.col("y"))
    few, rest = F.broadcast(firsts.where(hot)), firsts.where(~hot)
    both = rows.join(few, same).unionByName(rows.join(few, same, "left_anti").join(rest, same))
    return both.select(*rows.columns, (order > F.col("first")).alias("later")).drop("a", "b")


def fingerprints(docs: DataFrame, k: int, window: int, long: int) -> DataFrame:
    """(me, doc_id, place, size, winnowed, a, b): selected k-grams, and shorter runs of ``long`` words."""
    def marks(places: Column, size: int, winnowed: bool) -> Column:
        return F.transform(places, lambda p: F.struct(p.alias("place"), F.lit(size).alias("size"), F.lit(winnowed).alias("winnowed")))

    every = [marks(selected(F.col("hashes"), k, window), k, True)]
    every += [marks(wordy(F.col("words"), size, long), size, False) for size in range(1, k + window - 1)]
    rows = docs.select("me", "doc_id", "hashes", F.explode(F.concat(*every)).alias("m")).select("me", "doc_id", "hashes", "m.*")
    return keyed(rows, F.col("winnowed"), F.slice("hashes", F.col("place") + 1, F.col("size")), "size", "winnowed")


def lengthened(docs: DataFrame, seeds: DataFrame, k: int, window: int) -> DataFrame:
    """(me, doc_id, place, line, a, b): each seed with 1 to window - 1 more lines before or after it, and the outermost of these."""
    places = seeds.where("winnowed").groupBy(F.col("me").alias("of")).agg(F.collect_set("place").alias("places"))
    near = F.explode(F.array(*[F.lit(j) for j in range(1 - window, window) if j])).alias("more")
    rows = docs.join(places, F.col("me") == F.col("of")).select("me", "doc_id", "hashes", F.explode("places").alias("place"))
    rows = rows.select("*", near).select("*", F.when(F.col("more") < 0, F.col("place") + F.col("more")).otherwise(
        F.col("place") + k - 1 + F.col("more")).alias("line")).where((F.col("line") >= 0) & (F.col("line") < F.size("hashes")))
    lines = F.slice("hashes", F.least("place", "line") + 1, F.abs("more") + k)
    return keyed(rows, F.col("more"), lines, "line")


def repeated_lines(docs: DataFrame, k: int = K, window: int = WINDOW, long: int = LONG) -> DataFrame:
    """(me, dead): places among all lines of each document's repeated runs; only documents that have some."""
    lines = sequences(docs)
    seeds = checkpointed(repeated(fingerprints(lines, k, window, long)))
    dead = seeds.where("later").select("me", F.explode(F.sequence("place", F.col("place") + F.col("size") - 1)).alias("line"))
    if window > 1:
        dead = dead.unionByName(repeated(lengthened(lines, seeds, k, window)).where("later").select("me", "line"))
    gone = dead.groupBy(F.col("me").alias("of")).agg(F.collect_set("line").alias("dead"))
    return lines.join(gone, F.col("me") == F.col("of")).select("me", F.transform("dead", lambda i: F.get("at", i)).alias("dead"))


def deduplicated(docs: DataFrame, k: int = K, window: int = WINDOW, long: int = LONG) -> DataFrame:
    """(doc_id, n_lines, n_deleted, text) of every row, its repeated runs deleted.

    A run of lines goes where it occurs before, with all lines by which the match can be extended, if it is window + k - 1 lines long, or
    has ``long`` words, or holds a k-gram that both places selected, or is the only line of both documents. So a shorter run of fewer
    words may stay. Documents are ordered by doc_id, null last; every line that goes is equal to one that stays.

    Lines compare without surrounding blanks; blank lines neither match nor go. Runs may
    repeat within one document. A null text stays null with no lines, an empty
    one has one blank line. Rows that repeat id and text are one document and come back alike. An empty table gives no rows.
    Long documents are arrays of one row each; no two lists of documents ever meet.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dead = repeated_lines(plain, k, window, long).withColumnRenamed("me", "of").hint("shuffle_hash")
    rows = plain.withColumn("me", identity("doc_id", "text")).join(dead, F.col("me") == F.col("of"), "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dead"))
    text = F.when(F.col("dead").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    return rows.select("doc_id", F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
                       F.coalesce(F.size("dead"), F.lit(0)).cast("long").alias("n_deleted"), text.alias("text"))
