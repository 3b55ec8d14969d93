"""Fingerprints of documents as Merkle trees, by DataFrame functions alone.

A text is cut at blank lines into sections and at line ends into paragraphs; joining
them again gives the text, so nothing is lost. A paragraph's hash is that of its
text, a section's that of its paragraphs' hashes, the root that of the sections'
hashes. Below a paragraph stand the hashes of its runs, so that an edit inside a long
paragraph can be told from another paragraph. Runs end where the content says so, at one
word in ``WORDS``, so a word put in changes one run or two and the later ones stay; a paragraph
without blanks is cut so at one character in ``SIGNS``. A run that nothing ends for long (one
word, over and over) is cut by length from its start.
A fingerprint is the tree as text:

    root ':' section ';' section ...
    section   = hash '=' paragraph ',' paragraph ...
    paragraph = hash '.' run '.' run ...

The root has all 32 hex digits of an MD5, so equal roots mean equal texts. The other
hashes are cut to eight; they locate and count what differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rategrid.llm.store import stash

#: Words, and characters of a paragraph without blanks, in a run on average.
WORDS, SIGNS = 4, 16
#: Words or characters of the longest run that is not cut by length.
LONGEST = 64
_MARK = "\x01"


def _short(hashed: Column) -> Column:
    return F.substring(hashed, 1, 8)


def _runs(paragraph: Column) -> Column:
    """The runs of a paragraph, one at least."""

    def ended(parts: Column, between: str, size: int, length: bool) -> Column:
        ends = lambda w: F.pmod(F.ascii(w) + (F.length(w) if length else F.lit(0)), F.lit(size)) == 0
        marked = F.transform(parts, lambda w: F.when(ends(w), F.concat(w, F.lit(_MARK))).otherwise(w))
        return F.split(F.regexp_replace(F.array_join(marked, between), f"{_MARK}$", ""), _MARK + between, -1)

    def bounded(runs: Column, long: Callable[[Column], Column], pieces: Callable[[Column], Column]) -> Column:
        return F.flatten(F.transform(runs, lambda r: F.when(long(r), pieces(r)).otherwise(F.array(r))))

    def of_words(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - 1, F.lit(WORDS))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, F.lit(WORDS)), " "))

    def of_signs(run: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(run), F.lit(SIGNS))
        return F.transform(starts, lambda i: F.substring(run, i, F.lit(SIGNS)))

    # So many words have at least twice as many characters, but for one.
    many_words = lambda r: (F.length(r) >= 2 * LONGEST) & (F.size(F.split(r, " ", -1)) > LONGEST)
    in_words = bounded(
        ended(F.split(paragraph, " ", -1), " ", WORDS, True), many_words,
        lambda r: F.transform(F.array(F.split(r, " ", -1)), of_words)[0],
    )
    in_signs = bounded(
        ended(F.regexp_extract_all(paragraph, F.lit("(?s)."), 0), "", SIGNS, False),
        lambda r: F.length(r) > LONGEST, of_signs,
    )
    return F.when(paragraph.contains(" "), in_words).otherwise(in_signs)


def fingerprint(text: Column) -> Column:
    """The tree of a text; NULL counts as empty.

    What several parts of a step need is bound as the element of a list, as it would
    be worked out for each of them otherwise.
    """

    def paragraph(text: Column) -> Column:
        return F.struct(
            F.md5(text).alias("hash"),
            F.array_join(F.transform(_runs(text), lambda r: _short(F.md5(r))), ".").alias("runs"),
        )

    def section(paragraphs: Column) -> Column:
        return F.struct(
            F.md5(F.array_join(F.transform(paragraphs, lambda p: p["hash"]), "")).alias("hash"),
            F.array_join(
                F.transform(paragraphs, lambda p: F.concat(_short(p["hash"]), F.lit("."), p["runs"])), ","
            ).alias("below"),
        )

    sections = F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n", -1), lambda s: F.split(s, "\n", -1))
    trees = F.transform(F.transform(sections, lambda s: F.transform(s, paragraph)), section)
    whole = F.transform(F.array(trees), lambda t: F.concat(
        F.md5(F.array_join(F.transform(t, lambda s: s["hash"]), "")), F.lit(":"),
        F.array_join(F.transform(t, lambda s: F.concat(_short(s["hash"]), F.lit("="), s["below"])), ";"),
    ))
    return whole[0]


def root(tree: Column) -> Column:
    return F.substring(tree, 1, 32)


def runs_of(tree: Column) -> Column:
    """Hashes of all runs, in order."""
    return F.regexp_extract_all(tree, F.lit(r"\.([0-9a-f]{8})"), 1)


def likeness(one: Column, other: Column, runs: Column, other_runs: Column) -> Column:
    """How much of two trees is the same, from 0 to 1; 1 exactly where the roots agree.

    The larger of two shares of runs: those both have anywhere, so that what moved
    still counts, and those equal in place, so that repeats count as often as they occur.
    """
    both = F.size(F.array_intersect(runs, other_runs))
    shared = 2.0 * both / (F.size(F.array_distinct(runs)) + F.size(F.array_distinct(other_runs)))
    placed = F.size(F.filter(F.zip_with(runs, other_runs, lambda x, y: x == y), lambda x: x)).cast("double")
    placed = placed / F.greatest(F.size(runs), F.size(other_runs))
    some = F.least(F.greatest(shared, placed), F.lit(0.9999))
    return F.when(root(one) == root(other), F.lit(1.0)).otherwise(some)


def differing(one: Column, other: Column) -> Column:
    """Where two trees differ: array of (section, paragraph), from 1, of paragraphs unlike in place.

    Below sections with equal hashes nothing is compared.
    """

    def sections(tree: Column) -> Column:
        return F.split(F.substring_index(tree, ":", -1), ";")

    def paragraphs(section: Column) -> Column:
        return F.transform(F.split(F.substring_index(section, "=", -1), ","), lambda p: F.substring(p, 1, 8))

    def unlike(x: Column, y: Column) -> Column:
        return F.filter(
            F.transform(
                F.zip_with(paragraphs(F.coalesce(x, F.lit(""))), paragraphs(F.coalesce(y, F.lit(""))),
                           lambda a, b: ~a.eqNullSafe(b)),
                lambda differs, i: F.when(differs, i + 1),
            ), lambda i: i.isNotNull(),
        )

    found = F.zip_with(sections(one), sections(other), lambda x, y: F.when(
        F.substring_index(x, "=", 1).eqNullSafe(F.substring_index(y, "=", 1)), F.array().cast("array<int>")
    ).otherwise(unlike(x, y)))
    return F.flatten(F.transform(found, lambda ps, s: F.transform(
        ps, lambda p: F.struct((s + 1).alias("section"), p.alias("paragraph"))
    )))


def successors(ids: DataFrame, key: str, needs: str) -> DataFrame:
    """(key, needs, next): every distinct key with the next larger one, the largest with the smallest.

    Keys are dealt out by ranges; each range looks no further than its own, and one
    row per range says where the next begins.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stash(
        ids.repartitionByRange(parts, key).select(key, needs, F.spark_partition_id().alias("range")), "ranges"
    )
    inside = Window.partitionBy("range").orderBy(key)
    # One row per range.
    starts = ranged.groupBy("range").agg(F.min(key).alias("first"))
    across = Window.orderBy("range")
    starts = starts.select(
        "range",
        F.coalesce(F.lead("first").over(across), F.min("first").over(Window.partitionBy())).alias("after"),
    )
    return ranged.withColumn("own", F.lead(key).over(inside)).join(starts, "range").select(
        key, needs, F.coalesce("own", "after").alias("next")
    )


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) per row.

    ``edited`` is the text with its last quarter replaced by the beginning of the next
    document, in order of keys. NULL texts are empty. Of rows that repeat a key the
    smallest text is the next one of the key before; a row without a key has no next
    document, so its edited text ends early and its ``near_next`` is 0. An empty table
    gives an empty one; other columns are not read.

    Texts are shuffled by key once, for both joins, and trees are built after that: a
    tree takes two thirds of its text's room in a shuffle. Of the next document only the
    tree and as much text as is needed travel on.
    """
    # A struct is never NULL, so no filter is pushed below the shuffle of one use only.
    rows = docs.select(F.struct(F.col(key).alias("id")).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = rows.select(F.col("key.id").alias("id"), F.length("text").alias("n")).filter(F.col("id").isNotNull())
    ids = ids.groupBy("id").agg(F.max(F.floor(F.col("n") / 4)).alias("needs"))
    after = successors(ids, "id", "needs").select(
        F.struct("id").alias("for"), F.col("needs").cast("int").alias("needs"), F.struct(F.col("next").alias("id")).alias("key")
    )
    held = rows.repartition("key")
    first = Window.partitionBy("key").orderBy("text")
    ahead = (
        held.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") == 1)
        .join(after, "key")
        .select(
            F.col("for").alias("key"), F.expr("substring(text, 1, needs)").alias("ahead"),
            fingerprint(F.col("text")).alias("next_tree"),
        )
    )
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - quarter),
        F.substring(F.coalesce("ahead", F.lit("")), F.lit(1), quarter),
    )
    joined = held.join(ahead, "key", "left").withColumn("edited", edited)
    joined = joined.withColumns({
        "tree": fingerprint(F.col("text")), "edited_tree": fingerprint(F.col("edited")),
    })
    joined = joined.select(
        "key", F.length("text").alias("n"), "edited", "tree", "edited_tree", "next_tree", runs_of(F.col("tree")).alias("runs"),
        runs_of(F.col("edited_tree")).alias("edited_runs"), runs_of(F.col("next_tree")).alias("next_runs"),
    )
    near_next = likeness(F.col("tree"), F.col("next_tree"), F.col("runs"), F.col("next_runs"))
    return joined.select(
        F.col("key.id").alias(key), F.col("n").cast("bigint").alias("n_chars"), "edited",
        F.col("tree").alias("fingerprint"), F.col("edited_tree").alias("edited_fingerprint"),
        likeness(F.col("tree"), F.col("edited_tree"), F.col("runs"), F.col("edited_runs")).alias("near_edited"),
        F.when(F.col("next_tree").isNull(), F.lit(0.0)).otherwise(near_next).alias("near_next"),
    )
