"""Fingerprints of documents as sums of wide vectors hashed from their paragraphs, with SQL functions only.

A paragraph ends at a line break or a mark of any script, and within longer sentences after words in d
or t. What is still longer than LONG characters ends wherever the hash of the last WINDOW characters is
a multiple of SPACING, and after LONGEST characters at the latest, so that a long text has many
paragraphs whatever its language. These are rules of the text alone, so that an edit changes few
paragraphs. Its hash gives a vector: four full 32-bit words, and LANES words with a zero or one in each half.
A fingerprint is the number of paragraphs and the sum of their vectors, modulo 2**32 by word. Sums do not depend on the order, and
adding or taking away a paragraph is adding or subtracting its vector; the full words tell multisets of
paragraphs apart, and the small counts estimate how many paragraphs two documents have in common. So that a line
that occurs r times on one side only counts r times and not r * r times, the counts of its second, third, ...
copy come from a hash of the paragraph and the copy's number; the full words are those of the paragraph each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions.storage import cut

FULL, LANES = 4, 64  # full 32-bit words; words of two 32-bit counts each
_WORD, _HALVES = (1 << 32) - 1, (1 << 32) | 1
# Line breaks and marks beyond ASCII: of Latin, Greek, Armenian, Hebrew, Arabic, Indic, Thai, Tibetan, Burmese, Ethiopic, Khmer, Mongolian, Chinese and Japanese.
MARKS = (r"\u0085\u2028\u2029\u2026\u203c\u203d\u2047-\u2049\u037e\u0387\u0589\u055c-\u055e\u05c3\u060c\u061b\u061e\u061f\u06d4\u0700-\u070a"
         r"\u0964\u0965\u0e2f\u0e5a\u0e5b\u0f0d\u0f0e\u104a\u104b\u1362-\u1368\u17d4-\u17d6\u1802-\u1805\u1808\u1809"
         r"\u3001\u3002\uff01\uff0c\uff0e\uff1a\uff1b\uff1f\uff61\uff64")
PARAGRAPH = rf"(?<=[\n.,;:!?])|(?<=[dt] )|(?<=[\u0085-\uffff&&[{MARKS}]])"  # the range rules most characters out at once
LONG, WINDOW, SPACING, LONGEST = 96, 4, 24, 128
PART = 4096  # characters that are taken apart at a time
SLICE = 2048  # neighbouring ids that are put in order in one task


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text with the marks that end them; none of an empty text."""
    parts = F.array_remove(F.split(text, PARAGRAPH), "")
    return F.flatten(F.transform(parts, lambda p: F.when(F.char_length(p) <= LONG, F.array(p)).otherwise(_pieces(p))))


def _runs(text: Column, longest: int) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{longest}}}"), F.lit(0))


def _pieces(text: Column) -> Column:
    """A long text in pieces that end by their last characters, of at most LONGEST characters."""
    def ends(chars: Column) -> Column:
        def is_end(i: Column) -> Column:
            last = [F.get(chars, i - k) for k in range(WINDOW, 0, -1)]
            return (F.pmod(F.xxhash64(*last), F.lit(SPACING)) == 0) | (i == F.size(chars))

        return F.filter(F.sequence(F.lit(1), F.size(chars)), is_end)

    def between(chars: Column, ends: Column) -> Column:
        start = lambda k: F.coalesce(F.get(ends, k - 1), F.lit(0))
        return F.transform(ends, lambda end, k: F.array_join(F.slice(chars, start(k) + 1, end - start(k)), ""))

    # Arrays of one entry give what is used for every character a name, so that it is made once.
    named = lambda value, use: F.transform(F.array(value), use)[0]
    split = F.transform(_runs(text, PART), lambda p: named(F.split(p, ""), lambda chars: named(ends(chars), lambda at: between(chars, at))))
    return F.flatten(F.transform(F.flatten(split), lambda p: _runs(p, LONGEST)))


def hashed(paragraph: Column) -> list[Column]:
    """The two 64-bit hashes that make a paragraph's vector, null for null."""
    return [F.when(paragraph.isNotNull(), F.xxhash64(paragraph, F.lit(seed))) for seed in (0, 1)]


def of_copy(hashes: list[Column], copy: Column) -> list[Column]:
    """The hashes for the counts of the paragraph's first, second, ... copy in its text: those of the first are its own."""
    return [F.when(copy == 1, h).otherwise(F.when(h.isNotNull(), F.xxhash64(h, copy))) for h in hashes]


def vector_sums(first: Column, second: Column, lanes: list[Column] | None = None) -> Column:
    """Aggregate over both hashes: array of the number of paragraphs, the full words and the words of counts; nulls add nothing.

    ``lanes`` are the hashes that the counts are made of, where these are not the same.
    """
    low, high = lanes or (first, second)
    full = [F.sum(part.bitwiseAND(F.lit(_WORD))) for h in (first, second) for part in (h, F.shiftrightunsigned(h, 32))]
    bits = [F.sum(F.shiftrightunsigned(low if i < 32 else high, i % 32).bitwiseAND(F.lit(_HALVES))) for i in range(LANES)]
    words = [F.coalesce(w, F.lit(0).cast("long")) for w in (*full, *bits)]
    return F.array(F.count(first), *[w.bitwiseAND(F.lit(_WORD)) for w in words[:FULL]], *words[FULL:])


def plus(a: Column, b: Column) -> Column:
    """Fingerprint (as an array) of the paragraphs of both; the small counts are right where they share none."""
    return _per_word(a, b, lambda x, y: x + y)


def minus(a: Column, b: Column) -> Column:
    """Fingerprint (as an array) of the paragraphs of ``a`` without those of ``b``, which it must hold; for the small counts, all copies."""
    return _per_word(a, b, lambda x, y: x - y)


def _per_word(a: Column, b: Column, step) -> Column:
    full = F.zip_with(F.slice(a, 2, FULL), F.slice(b, 2, FULL), lambda x, y: step(x, y).bitwiseAND(F.lit(_WORD)))
    counts = F.zip_with(F.slice(a, FULL + 2, LANES), F.slice(b, FULL + 2, LANES), step)
    return F.concat(F.array(step(a[0], b[0])), full, counts)


def as_text(words: Column) -> Column:
    """The words in hexadecimal."""
    return F.array_join(F.transform(words, lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common paragraphs, 0 to 1, of two fingerprints as arrays; 1 exactly for equal ones.

    The standard error is about an eighth of the share that is not common (128 counts).
    A count over n paragraphs is binomial: the squared difference of two counts, less what the numbers of
    paragraphs explain, is on average a quarter of the number of paragraphs that only one of both has.
    """
    shift, total = (a[0] - b[0]) / F.lit(2.0), a[0] + b[0]

    def square(x: Column, y: Column) -> Column:
        return (x - y - shift) * (x - y - shift)

    def both(x: Column, y: Column) -> Column:
        low = square(x.bitwiseAND(F.lit(_WORD)), y.bitwiseAND(F.lit(_WORD)))
        return low + square(F.shiftrightunsigned(x, 32), F.shiftrightunsigned(y, 32))

    squares = F.zip_with(F.slice(a, FULL + 2, LANES), F.slice(b, FULL + 2, LANES), both)
    apart = F.aggregate(squares, F.lit(0.0), lambda s, x: s + x) * F.lit(2.0 / LANES)
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - apart / F.greatest(total, F.lit(1))))
    return F.when(a == b, F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise(share)


def next_heads(ids: DataFrame) -> DataFrame:
    """(slice, next_head) of every slice of neighbouring ids: the largest id of the next smaller slice.

    Null for the smallest slice. Slices are ordered like ids, in slices of slices, until one task holds all.
    """
    heads = cut(ids.groupBy(_slice("id").alias("slice")).agg(F.max("id").alias("head")))
    if heads.count() <= SLICE:
        return heads.select("slice", F.lead("head").over(Window.orderBy(F.desc("slice"))).alias("next_head"))
    above = next_heads(heads.select(F.col("slice").alias("id"))).select(F.col("slice").alias("above"), F.col("next_head").alias("next_slice"))
    within = Window.partitionBy("above").orderBy(F.desc("slice"))
    paired = heads.withColumn("above", _slice("slice")).withColumn("following", F.lead("slice").over(within)).join(above, "above")
    paired = paired.select("slice", F.coalesce("following", "next_slice").alias("next_slice"))
    return paired.join(heads.select(F.col("slice").alias("next_slice"), F.col("head").alias("next_head")), "next_slice", "left").select("slice", "next_head")


def _slice(id: str) -> Column:
    return F.shiftright(F.col(id), SLICE.bit_length() - 1)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    The edited text replaces the last third of the code points, rounded down, by the first as many (or all)
    of the next document by falling id; the smallest id is followed by the largest. ``near_edited`` and
    ``near_next`` are the likeness of the document's fingerprint to those of the edited text and of the next
    document. A null text counts as empty; rows of one id follow each other in order of their text; a row
    with a null id has an empty next document; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(docs[id].cast("long").alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    ids = rows.select(F.col("doc_id").alias("id")).where("id is not null")
    largest = ids.agg(F.max("id")).first()[0]
    order = cut(next_heads(ids))
    # The first document of the next slice also comes last in this one, as a guest.
    guests = order.select(F.coalesce("next_head", F.lit(largest)).cast("long").alias("doc_id"), "slice")
    guests = rows.join(guests, "doc_id").select("doc_id", "text", "slice", F.lit(1).alias("guest"))
    whole = rows.select("doc_id", "text", _slice("doc_id").alias("slice"), F.lit(0).alias("guest")).union(guests)
    within = Window.partitionBy("slice").orderBy("guest", F.desc("doc_id"), "text")
    paired = whole.select("slice", "doc_id", "guest", "text", F.row_number().over(within).alias("place"),
                          F.when(F.col("doc_id").isNotNull(), F.lead("text").over(within)).alias("next_text")).where("guest = 0")
    n = F.char_length("text")
    kept = n - (n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), kept), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), n - kept))
    tagged = lambda which, t: F.transform(paragraphs(t), lambda p: F.struct(F.lit(which).alias("which"), p.alias("p")))
    none = lambda which: F.array(F.struct(F.lit(which).alias("which"), F.lit(None).cast("string").alias("p")))
    # Every text leaves one empty entry, so that texts without paragraphs have a fingerprint too.
    entries = F.concat(*[none(i) for i in range(3)], tagged(0, F.col("text")), tagged(1, F.col("edited")), tagged(2, F.coalesce("next_text", F.lit(""))))
    by = ["slice", "place", "doc_id", "n_chars", "edited_sha256"]
    texts = paired.withColumn("edited", edited).withColumn("n_chars", n.cast("long")).withColumn("edited_sha256", F.sha2("edited", 256))
    # Grouped by the slice the rows are dealt out by already, so that no further shuffle is needed.
    first, second = hashed(F.col("p"))
    vectors = texts.select(*by, F.inline(entries)).select(*by, "which", first.alias("first"), second.alias("second"))
    copies = vectors.groupBy(*by, "which", "first", "second").agg(F.count("*").cast("int").alias("n"))
    copies = copies.select(*by, "which", "first", "second", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    hashes = [F.col("first"), F.col("second")]
    sums = copies.groupBy(*by, "which").agg(vector_sums(*hashes, of_copy(hashes, F.col("copy"))).alias("words"))
    found = sums.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("which", "words"))).alias("found"))
    own, changed, following = (F.col("found")[i]["words"] for i in range(3))
    return found.select("doc_id", "n_chars", "edited_sha256", as_text(own).alias("fingerprint"), as_text(changed).alias("edited_fingerprint"),
                        likeness(own, changed).alias("near_edited"), likeness(own, following).alias("near_next"))
