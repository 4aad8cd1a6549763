"""I-Match fingerprints over several random lexicons, in DataFrame operations.

The lexicon is the terms whose inverse document frequency lies in a band:
neither in over ``MOST_SHARE`` of the documents nor in fewer than
``LEAST_DOCS``.  A text's terms in the band are sorted and hashed once for each of
several random subsets of the lexicon; a slot of the fingerprint holds the hash of
the terms that fall into its subset.  A subset that keeps the share 2**-level
of the lexicon suits texts of about 2**level terms (about one of them a
slot, so that an edit changes some slots and leaves others); texts of any
size are served by a ladder of levels, of which each text uses the two that
fit its number of distinct terms.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import Scratch

#: The band: in at least so many documents, and at most in this share of all.
LEAST_DOCS, MOST_SHARE = 2, 0.05
SLOTS = 32
EMPTY = "------"
#: A window holds about so many characters of text.
BUCKET_CHARS, MOST_BUCKETS = 4 << 20, 4096


def terms(text: Column) -> Column:
    """Distinct lower-cased runs of letters and digits."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), "")


def _level(n: Column) -> Column:
    return F.greatest(F.lit(0), F.floor(F.log2(F.greatest(n, F.lit(1)) / 2.0))).cast("int")


def _class(h: Column, level: Column) -> Column:
    """The subset of the lexicon, of 2**level, that a term is in."""
    return h.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), level) - 1)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rid, next_rid, doc_id, text, next_text``: every row with the text that
    follows it by ascending id (a null id last, then by text), after the last
    the first.  Ids are cut at their quantiles into buckets of bounded size;
    each bucket is ordered by itself and sees a copy of the next one's first row."""
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chars = d.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    n = max(1, min(MOST_BUCKETS, ceil(chars / BUCKET_CHARS)))
    cuts = sorted(set(d.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.25 / n))) if n > 1 else []
    at = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: F.col("doc_id") > c)) if cuts else F.lit(0)
    d = d.withColumn("bucket", F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(at).cast("bigint"))
    # a row for each bucket: its first id, and the bucket before it (before the first, the last)
    one = Window.orderBy("bucket")
    firsts = d.groupBy("bucket").agg(F.min("doc_id").alias("first"))
    firsts = firsts.select("bucket", "first", F.coalesce(F.lag("bucket").over(one), F.max("bucket").over(Window.partitionBy())).alias("to"))
    copies = d.join(F.broadcast(firsts), "bucket").where(F.col("doc_id").eqNullSafe(F.col("first")))
    copies = copies.select("doc_id", "text", F.col("to").alias("bucket"), F.col("bucket").alias("home"))
    # repeated ids: only the one that comes first is the next
    both = d.withColumn("home", F.lit(None).cast("bigint")).unionByName(copies)
    w = Window.partitionBy("bucket").orderBy(F.col("home").isNotNull(), "doc_id", "text")
    rid = lambda b, i: F.shiftleft(b, 32) + i
    k = F.row_number().over(w).cast("bigint")
    home = F.lead("home").over(w)
    return (both.select("doc_id", "text", "home", rid(F.col("bucket"), k).alias("rid"), F.lead("text").over(w).alias("next_text"),
                        F.coalesce(rid(home, F.lit(1)), rid(F.col("bucket"), k + 1)).alias("next_rid"))
            .where("home is null").drop("home"))


def lexicon(docs: DataFrame, text_col: str) -> DataFrame:
    """Document frequencies ``h, df`` of all terms in LEAST_DOCS documents or more."""
    words = docs.select(F.explode(terms(F.col(text_col))).alias("term"))
    return words.groupBy(F.xxhash64("term").alias("h")).agg(F.count("*").alias("df")).where(F.col("df") >= LEAST_DOCS)


def _in_slots(h: Column, level: Column) -> Column:
    return F.filter(h, lambda x: _class(x, level) < SLOTS)


def _slots(h: Column, level: Column) -> Column:
    def slot(own: Column) -> Column:
        return F.when(F.size(own) > 0, F.lower(F.right(F.lpad(F.hex(F.xxhash64(own)), 16, "0"), F.lit(6)))).otherwise(F.lit(EMPTY))
    # the lambda over one array makes the filter run once for each slot
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)),
                                 lambda j: F.transform(F.array(F.filter(h, lambda x: _class(x, level) == j)), slot)))


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints: the share of equal slots among those that either
    fills, over the levels both have; 1 if equal, 0 without a common level."""
    def compare(x: Column, y: Column) -> Column:
        pairs = F.zip_with(x, y, lambda p, q: F.when((p == EMPTY) & (q == EMPTY), F.lit(None)).otherwise(p == q))
        return F.struct(F.size(F.filter(pairs, lambda v: v)).alias("same"), F.size(F.filter(pairs, lambda v: v.isNotNull())).alias("all"))
    lo, hi = compare(a.lo, b.lo), compare(a.hi, b.hi)
    share = lambda n, m: F.when(m > 0, n / m).otherwise(F.lit(0.0))
    up, down = compare(a.lo, b.hi), compare(a.hi, b.lo)
    return (F.when(a.text == b.text, F.lit(1.0)).when(a.level == b.level, share(lo.same + hi.same, lo.all + hi.all))
            .when(a.level == b.level + 1, share(up.same, up.all)).when(a.level == b.level - 1, share(down.same, down.all)).otherwise(F.lit(0.0)))


def _fingerprint(h: Column, lo: Column, hi: Column, level: Column, whole: Column) -> Column:
    text = F.concat(F.lit("b"), level.cast("string"), F.lit(":"), F.array_join(lo, ""), F.lit("|"), F.array_join(hi, ""))
    return F.struct(lo.alias("lo"), hi.alias("hi"), level.alias("level"),
                    F.when(F.size(h) > 0, text).otherwise(F.concat(F.lit("w:"), F.lower(F.hex(whole)))).alias("text"))


def fingerprints(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text is the text with its last quarter of code points replaced
    by the first as many of the next row's; the likenesses compare a row's
    fingerprint with its edited text's and with the next row's.  A text
    without filled slots (empty, or no term in the band) has the hash of all
    its terms instead, so equal texts still have equal fingerprints.  A null
    text counts as empty; a null id comes last; repeated rows are rows of
    their own; an empty table gives an empty result; other columns are not
    looked at.  The band's upper edge keeps the set of too common terms within
    (mean distinct terms of a document) / MOST_SHARE, however many documents.
    """
    known = scratch.table(lexicon(docs, text_col), "lexicon")
    most = max(LEAST_DOCS, int(MOST_SHARE * docs.count()))
    common = [r.h for r in known.where(F.col("df") > most).select("h").collect()]
    d = with_next(docs, id_col, text_col)
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    d = d.select("rid", "next_rid", "doc_id", n.cast("bigint").alias("n_chars"), "text",
                 F.concat(F.left("text", n - cut), F.left("next_text", cut)).alias("edited"))
    d = d.withColumn("a", terms(F.col("text"))).withColumn("b", terms(F.col("edited")))
    used = lambda c: _in_slots(F.transform(c, lambda x: F.xxhash64(x)), _level(F.size(c)))
    rare = (lambda c: F.array_except(c, F.array(*map(F.lit, common)))) if common else (lambda c: c)
    d = d.select("rid", "next_rid", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                 *(e.alias(f"{s}_{k}") for s in "ab" for k, e in (("h", rare(used(F.col(s)))), ("level", _level(F.size(s))), ("all", F.xxhash64(F.sort_array(s))))))
    d = scratch.table(d, "texts")
    sides = F.array(*(F.struct(F.lit(f).alias("f"), x.alias("x")) for f, x in (
        (3, F.array_intersect("a_h", "b_h")), (1, F.array_except("a_h", "b_h")), (2, F.array_except("b_h", "a_h")))))
    rows = d.select("rid", F.explode(sides).alias("s")).select("rid", "s.f", F.explode("s.x").alias("h"))
    kept = rows.join(known.where(F.col("df") <= most).select("h"), "h")
    of = lambda bit: F.sort_array(F.collect_list(F.when(F.col("f").bitwiseAND(F.lit(bit)) > 0, F.col("h"))))
    kept = kept.groupBy("rid").agg(of(1).alias("a"), of(2).alias("b"))
    none = F.array().cast("array<bigint>")
    d = d.drop("a_h", "b_h").join(kept, "rid", "left").withColumns({s: F.coalesce(s, none) for s in "ab"})
    # of the sparser level's subsets, the slots hold about half of the terms
    d = d.withColumns({f"{s}_half": _in_slots(F.col(s), F.col(f"{s}_level") + 1) for s in "ab"})
    d = d.withColumns({f"{s}_lo": _slots(F.col(s), F.col(f"{s}_level")) for s in "ab"} | {
        f"{s}_hi": _slots(F.col(f"{s}_half"), F.col(f"{s}_level") + 1) for s in "ab"})
    f = d.select("rid", "next_rid", "doc_id", "n_chars", "edited_sha256", *(
        _fingerprint(*(F.col(f"{s}{x}") for x in ("", "_lo", "_hi", "_level", "_all"))).alias(s) for s in "ab"))
    f = scratch.table(f, "fingerprints")
    nxt = f.select(F.col("rid").alias("next_rid"), F.col("a").alias("c"))
    return f.join(nxt, "next_rid").select(
        "doc_id", "n_chars", "edited_sha256", F.col("a.text").alias("fingerprint"), F.col("b.text").alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next"))
