"""Order MinHash fingerprints, with DataFrame functions only.

The k-mers of a text are pairs of neighbouring tokens; each carries the number of its occurrence, so a repeated k-mer is a
new element. A hash of (k-mer, occurrence) throws every element into one of ``BINS`` bins and orders it there. Of each bin
the ``CHOSEN`` smallest elements are kept, put back into text order and hashed as a tuple: one entry of the signature.
Likeness is the share of bins with equal tuples among the bins filled on either side. Because a tuple needs the same
elements in the same order, it follows edit distance rather than set overlap.

A token is one ideographic, kana, hangul or Thai character, or up to 16 other characters without white space. A text with
one token has that token as its only k-mer; a text without tokens has an empty signature.

Everything of one text happens in its own row: tokens, hashes and positions are packed into long arrays that are sorted
natively, so occurrence numbers and minima need neither exploded rows nor a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BINS_LOG2 = 6
CHOSEN = 2
POSITION_BITS = 26  # later positions tie
ORDER_BITS = 63 - POSITION_BITS
SINGLE = r"฀-๿぀-ヿ㐀-鿿가-힯"
TOKEN = rf"[{SINGLE}]|[^\s{SINGLE}]{{1,16}}"
BOUNDS = 512


def _let(value: str, name: str, body: str) -> str:
    """Binds a value to a name, so that it is computed once however often the body uses it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def signature(text: str, bins_log2: int = BINS_LOG2, chosen: int = CHOSEN) -> Column:
    """Ascending longs ``bin * 2**32 + hash of the bin's tuple`` of a text column; null counts as empty."""
    position, order, top = (1 << POSITION_BITS) - 1, (1 << ORDER_BITS) - 1, 63 - bins_log2
    token = TOKEN.replace("\\", "\\\\")
    packed = (f"sort_array(transform(slice(h, 1, greatest(size(h) - 1, least(size(h), 1))), (x, i) -> "
              f"shiftleft(xxhash64(x, coalesce(get(h, i + 1), 0L)) & {order}L, {POSITION_BITS}) | least(i, {position})))")
    starts = (f"if(size(s) = 0, cast(array() as array<int>), filter(sequence(0, size(s) - 1), i -> "
              f"i = 0 OR shiftright(s[i], {POSITION_BITS}) <> shiftright(s[i - 1], {POSITION_BITS})))")
    numbered = (f"sort_array(flatten(transform(starts, (a, j) -> transform(sequence(a, coalesce(get(starts, j + 1), size(s)) - 1), i -> "
                f"shiftleft(xxhash64(shiftright(s[i], {POSITION_BITS}), i - a) & {order}L, {POSITION_BITS}) | (s[i] & {position}L)))))")
    smallest = f"filter(q, (x, i) -> i < {chosen} OR shiftright(x, {top}) <> shiftright(q[i - {chosen}], {top}))"
    in_order = (f"sort_array(transform(filter(slice(m, i + 1, {chosen}), y -> shiftright(y, {top}) = shiftright(x, {top})), y -> "
                f"shiftleft(y & {position}L, {ORDER_BITS - bins_log2}) | shiftright(y & {(1 << top) - 1}L, {POSITION_BITS})))")
    tuples = (f"transform(filter(transform(m, (x, i) -> if(i = 0 OR shiftright(m[i - 1], {top}) <> shiftright(x, {top}), "
              f"struct(x AS x, {in_order} AS t), null)), z -> z IS NOT NULL), z -> shiftleft(shiftright(z.x, {top}), 32) | "
              f"(xxhash64(transform(z.t, y -> y & {(1 << (ORDER_BITS - bins_log2)) - 1}L)) & 4294967295L))")
    body = _let(numbered, "q", _let(smallest, "m", tuples))
    body = _let(packed, "s", _let(starts, "starts", body))
    hashes = f"transform(regexp_extract_all(coalesce({text}, ''), '{token}', 0), w -> xxhash64(w))"
    return F.expr(_let(hashes, "h", body))


def fingerprint_text(sig: Column) -> Column:
    """The signature as text: ten hexadecimal digits for each filled bin, bins in order."""
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of bins with equal tuples among the bins filled on either side; 1 for two empty signatures."""
    filled = F.size(F.array_distinct(F.transform(F.concat(a, b), lambda x: F.shiftright(x, 32))))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled).cast("double")


def with_next(docs: DataFrame, column: str, derived: dict[str, Column], order: str, bounds: int = BOUNDS) -> DataFrame:
    """Adds the derived columns, and ``next``: a struct of ``column`` and these of the row that follows in descending
    ``order``; after the last, the first.

    Rows are cut into ranges of ``order`` at quantiles, so each range is one window of its own. A copy of the first row of
    the following range stands at the end of each range. Only the quantiles, at most ``bounds``, reach the driver. Nulls
    in ``order`` come last; equal values are put in order by the column. What is derived is computed once for each row.
    """
    columns = [column, *derived]
    cuts = docs.agg(F.percentile_approx(order, [i / bounds for i in range(1, bounds)], 20 * bounds).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    # a value equal to a cut belongs above it: all rows of one value share a range
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(order))) if cuts else F.lit(0)
    placed = docs.select(order, column, place.alias("range_no"), F.lit(False).alias("is_copy"))
    # structs compare field by field with nulls first, so the largest one is the first in descending order
    heads = placed.groupBy("range_no").agg(F.max(F.struct(F.col(order).alias("order"), F.col(column).alias("v"))).alias("head"))
    one = Window.partitionBy(F.lit(0)).orderBy(F.desc("range_no"))  # at most `bounds` rows
    everything = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    copies = heads.select("range_no", F.coalesce(F.lead("head").over(one), F.first("head").over(everything)).alias("head")).select(
        F.col("head.order").alias(order), F.col("head.v").alias(column), "range_no", F.lit(True).alias("is_copy"))
    within = Window.partitionBy("range_no").orderBy("is_copy", F.desc(order), F.desc(column))
    return placed.unionByName(copies).withColumns(derived).withColumn("next", F.lead(F.struct(*columns)).over(within)).where(~F.col("is_copy")).drop(
        "is_copy", "range_no")


def fingerprint_documents(docs: DataFrame, bins_log2: int = BINS_LOG2, chosen: int = CHOSEN) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next document.

    The edited text replaces the last half (rounded down) of the code points by the first as many, or all, of the next
    document in descending ``doc_id``. Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``, one row per input row. A null text counts as empty; rows with a null ``doc_id`` stand at the
    end of the order; rows with equal ``doc_id`` are ordered by text. A single row is its own next document.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(own, "text", {"sig": signature("text", bins_log2, chosen)}, "doc_id")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = paired.select("doc_id", "sig", n.cast("long").alias("n_chars"), F.col("next.sig").alias("next_sig"),
                           F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half)).alias("edited"))
    signed = edited.withColumn("edited_sig", signature("edited", bins_log2, chosen))
    return signed.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint_text(F.col("sig")).alias("fingerprint"),
        fingerprint_text(F.col("edited_sig")).alias("edited_fingerprint"), likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
