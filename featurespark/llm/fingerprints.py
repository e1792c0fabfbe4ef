"""Merkle-tree fingerprints: equal roots mean equal texts, and differing branches locate an edit.

A text's paragraphs are its lines.  A paragraph's pieces (runs of ``LEAF_WORDS`` words) are the leaves; leaf hashes make
the paragraph's, eight paragraphs make a section, and the sections make the root.  The fingerprint spells the tree out,
level by level::

    root ':' sections joined by '.' ':' paragraphs joined by '.' ':' leaves joined by '.', and by ',' between paragraphs

Root and sections are cut SHA-256, paragraphs and leaves XXH64; leaves are written in short form, since
only their likeness is read from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rank import lookup, repeated
from .support import NO_ID, block_count, keyed, public_id, saved

#: Paragraphs in a section, and words in a leaf.
SECTION, LEAF_WORDS = 8, 4
#: Rows of one bucket of neighbours, the coarse buckets of the id range, and how often a full bucket is parted again.
BUCKET_ROWS, COARSE, DEPTH = 2_000, 4_096, 8


def _hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _leaves(text: Column) -> Column:
    piece = F.lit(f"(?:[^ ]+ *| +){{1,{LEAF_WORDS}}}")
    pieces = lambda p: F.transform(F.regexp_extract_all(p, piece, F.lit(0)), lambda q: _hex(F.xxhash64(q)))
    return F.transform(F.split(text, "\n", -1), pieces)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the fingerprint of a text column; a null text counts as empty."""
    df = df.withColumn("_leaves", _leaves(F.coalesce(F.col(text), F.lit(""))))
    df = df.withColumn("_paragraphs", F.transform("_leaves", lambda x: _hex(F.xxhash64(F.concat_ws(".", x)))))
    last = F.floor((F.size("_paragraphs") - 1) / SECTION).cast("int")
    section = lambda i: F.concat_ws(".", F.slice("_paragraphs", i * SECTION + 1, F.lit(SECTION)))
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.sha2(section(i), 256), 1, 16))
    df = df.withColumn("_sections", F.concat_ws(".", cut))
    leaves = F.transform("_leaves", lambda p: F.concat_ws(".", F.transform(p, lambda x: F.substring(x, 1, 8))))
    spelled = F.concat_ws(
        ":",
        F.substring(F.sha2(F.col("_sections"), 256), 1, 32),
        F.col("_sections"),
        F.concat_ws(".", "_paragraphs"),
        F.concat_ws(",", leaves),
    )
    return df.withColumn(out, spelled).drop("_leaves", "_paragraphs", "_sections")


def _part(fingerprint: Column, level: int) -> Column:
    return F.split_part(fingerprint, F.lit(":"), F.lit(level))


def likeness(one: Column, other: Column) -> Column:
    """Share of the distinct leaves that both trees hold, of the larger tree's; 1 for equal roots."""
    a, b = (F.array_distinct(F.split(_part(x, 4), "[.,]")) for x in (one, other))
    same = _part(one, 1) == _part(other, 1)
    return F.when(same, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b)))


def _first_difference(a: Column, b: Column) -> Column:
    """Index from 0 of the first place where two arrays differ or one of them ends; null if they are equal."""
    differs = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: ~p["a"].eqNullSafe(p["b"]))
    at = F.array_position(differs, True)
    return F.when(at > 0, at - 1).cast("int")


def with_first_edit(df: DataFrame, one: str, other: str) -> DataFrame:
    """Add ``first_edit`` and ``first_leaf``: the first paragraph, and in it the first leaf, from 0, that the trees don't share.

    The trees are gone down branch by branch: where the roots differ, the first differing section is found, then the first
    differing paragraph inside it, then the first differing leaf of that.  Both are null for equal roots.
    """
    one, other = F.col(one), F.col(other)
    section = F.when(_part(one, 1) != _part(other, 1), _first_difference(F.split(_part(one, 2), "\\."), F.split(_part(other, 2), "\\.")))
    df = df.withColumn("_section", section)
    inside = lambda x: F.slice(F.split(_part(x, 3), "\\."), F.col("_section") * SECTION + 1, F.lit(SECTION))
    df = df.withColumn("first_edit", F.col("_section") * SECTION + _first_difference(inside(one), inside(other)))
    leaves = lambda x: F.split(F.coalesce(F.get(F.split(_part(x, 4), ","), F.col("first_edit")), F.lit("")), "\\.")
    at = F.when(F.col("first_edit").isNotNull(), F.coalesce(_first_difference(leaves(one), leaves(other)), F.lit(0)))
    return df.withColumn("first_leaf", at).drop("_section")


class _Buckets:
    """Buckets of about ``BUCKET_ROWS`` keys ``doc, tag`` in order: arrays of numbers, which compare as the keys do.

    The id range is cut evenly, with a cell of its own for null ids.  A cell that holds too many is cut again, evenly between its
    least and largest id, or if these are the same between its least and largest hash of a text; and so on.
    """

    def __init__(self, ids: DataFrame, coarse: int) -> None:
        real = F.col("doc") != NO_ID
        low, high, count = ids.filter(real).agg(F.min("doc"), F.max("doc"), F.count("*")).first()
        self.low, self.span, self.coarse = (low, high - low + 1, coarse) if count else (0, 1, coarse)
        self.levels: list[DataFrame] = []
        at = self._first(ids)
        for level in range(DEPTH):
            full = at.groupBy("_b").agg(
                F.count("*").alias("_n"), *[f(c).alias(f"_{name}_{c}") for c in ("doc", "tag") for name, f in (("low", F.min), ("high", F.max))]
            )
            most = BUCKET_ROWS * (4 if level else 1)
            full = saved(full.filter((F.col("_n") > most) & ((F.col("_low_doc") < F.col("_high_doc")) | (F.col("_low_tag") < F.col("_high_tag")))))
            if full.isEmpty():
                break
            self.levels.append(full)
            at = self._next(at, full)

    def _first(self, df: DataFrame) -> DataFrame:
        # ids may span more than a long holds
        share = (F.col("doc").cast("decimal(20,0)") - F.lit(str(self.low)).cast("decimal(38,0)")).cast("double") * self.coarse / float(self.span)
        cell = F.when(F.col("doc") == NO_ID, F.lit(self.coarse)).otherwise(F.least(F.lit(self.coarse - 1), F.floor(share)))
        return df.withColumn("_b", F.array(cell.cast("int")))

    @staticmethod
    def _next(df: DataFrame, full: DataFrame) -> DataFrame:
        exact = lambda c: F.col(c).cast("decimal(20,0)")
        parts = F.ceil(F.col("_n") / BUCKET_ROWS)

        def cell(c: str) -> Column:
            wide = (exact(f"_high_{c}") - exact(f"_low_{c}")).cast("double") + 1
            return F.least(parts - 1, F.floor((exact(c) - exact(f"_low_{c}")).cast("double") * parts / wide))

        at = F.when(F.col("_n").isNull(), F.lit(0)).when(F.col("_low_doc") < F.col("_high_doc"), cell("doc")).otherwise(cell("tag"))
        wanted = [c for c in full.columns if c != "_b"]
        return lookup(df, full, ["_b"]).withColumn("_b", F.array_append("_b", at.cast("int"))).drop(*wanted)

    def place(self, df: DataFrame) -> DataFrame:
        """Add the bucket ``_b`` to rows with ``doc, tag``."""
        df = self._first(df)
        for full in self.levels:
            df = self._next(df, full)
        return df


def _neighbours(rows: DataFrame, ids: DataFrame, coarse: int) -> DataFrame:
    """Add ``_next`` and ``next_fingerprint`` of the row before in the order of (doc, tag) to rows that are distinct in these.

    Each bucket also receives the last row of the bucket before it, so no task sorts more than a bucket.
    """
    buckets = _Buckets(ids, coarse)
    lasts = saved(buckets.place(ids).groupBy("_b").agg(F.max(F.struct("doc", "tag")).alias("_last")))
    lasts = lasts.withColumn("_a", F.get("_b", F.lit(0)))
    inside = Window.partitionBy("_a").orderBy("_b")
    heads = lasts.groupBy("_a").agg(F.min("_b").alias("_head"))
    after = heads.select("_a", F.lead("_head").over(Window.orderBy("_a")).alias("_after"))
    first = heads.agg(F.min("_head").alias("f")).first()["f"]
    wrap = F.array(*[F.lit(x) for x in (first or [0])])
    to = F.coalesce(F.lead("_b").over(inside), F.col("_after"), wrap)
    guests = lasts.join(after, "_a", "left").select(F.col("_last.doc").alias("doc"), F.col("_last.tag").alias("tag"), to.alias("_to"))
    extra = lookup(buckets.place(rows), guests, ["doc", "tag"])
    place = lambda c, guest: F.struct(F.col(c).alias("at"), F.lit(guest).alias("guest"))
    places = F.array_compact(F.array(place("_b", 0), F.when(F.col("_to").isNotNull(), place("_to", 1))))
    dealt = extra.withColumn("_p", F.explode(places)).select(*rows.columns, F.col("_p.at").alias("_b"), F.col("_p.guest").alias("_guest"))
    order = Window.partitionBy("_b").orderBy(F.desc("_guest"), "doc", "tag")
    paired = dealt.withColumns({"_next": F.lag("text").over(order), "next_fingerprint": F.lag("fingerprint").over(order)})
    return paired.filter("_guest = 0").drop("_b", "_guest")


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint each text, and that text with its last third replaced from the next document.

    The next document is the one before in the order of (doc_id, hash of the text), and that of the first
    is the last.  Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    first_edit, first_leaf``.  Null texts count as empty; a null doc_id stands after all others and is returned as null; repeated
    rows are neighbours of each other, and only one of them, with its number, is compared; a single row is its own
    next; an empty table gives no rows.
    """
    rows = keyed(docs).withColumn("text", F.coalesce("text", F.lit("")))
    ids = saved(rows.groupBy("doc", "tag").agg(F.count("*").alias("_times")))
    copies = lookup(rows, ids.filter("_times > 1"), ["doc", "tag"])
    single = copies.filter("_times is null").withColumn("_times", F.lit(1).cast("long"))
    multiple = copies.filter("_times > 1").groupBy("doc", "tag").agg(F.first("text").alias("text"), F.first("_times").alias("_times"))
    rows = single.unionByName(multiple.select(*single.columns))
    coarse = min(COARSE, block_count(docs, 1 << 20, 1))
    paired = _neighbours(with_fingerprint(rows, "text", "fingerprint"), ids.drop("_times"), coarse)
    more = paired.filter("_times > 1").withColumns({"_next": F.col("text"), "next_fingerprint": F.col("fingerprint")})
    return _compared(paired.withColumn("_times", F.lit(1).cast("long")), False).unionByName(
        _compared(more.withColumn("_times", F.col("_times") - 1), True)
    )


def _compared(paired: DataFrame, again: bool) -> DataFrame:
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    kept, taken = F.substr("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substr("_next", F.lit(1), cut)
    paired = paired.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("_edited", F.concat(kept, taken))
    paired = with_first_edit(with_fingerprint(paired, "_edited", "edited_fingerprint"), "fingerprint", "edited_fingerprint")
    mine = F.col("fingerprint")
    found = paired.select(
        public_id(),
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(mine, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(mine, F.col("next_fingerprint")).alias("near_next"),
        "first_edit",
        "first_leaf",
        "_times",
    )
    return (repeated(found, "_times", "_copy").drop("_copy") if again else found).drop("_times")
