"""Fingerprints of documents: one-permutation MinHash with optimal densification and low-order bits.

Each shingle is hashed once; the top bits of the hash choose its bin, the least hash of a bin stands for it.
A bin without shingles borrows from another that is chosen by a walk of its own over all bins, the same for every
document. Of each bin only BITS low-order bits are kept. Two unrelated bins agree with probability
2 ** -BITS, which the likeness takes off again. All of it is one expression on the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Production parameters. BINS is a power of two; the fingerprint takes BINS * BITS bits in words of 64.
BINS, BITS, SIZE = 256, 4, 5
_BIN_BITS = BINS.bit_length() - 1
_SHIFT = 64 - _BIN_BITS
_EMPTY = (1 << _SHIFT) - 1
_PER_WORD = 64 // BITS
WORDS = BINS // _PER_WORD
#: The lowest bit of each cell of a word.
_LOW = sum(1 << (BITS * i) for i in range(_PER_WORD))
_LOW = _LOW - (1 << 64) if _LOW >= 1 << 63 else _LOW


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often lambdas inside refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingles(text: Column, size: int = SIZE) -> Column:
    """Hashes of the word shingles of a text; the whole sequence if it is shorter, none without words."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        many = F.transform(
            F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(size))))
        one = F.array(F.aggregate(h, F.lit(0).cast("bigint"), lambda total, x: F.xxhash64(total, x)))
        return F.when(F.size(h) >= size, many).when(F.size(h) > 0, one).otherwise(F.array().cast("array<bigint>"))

    return _bound(hashes, windows)


def fingerprint(text: Column) -> Column:
    """WORDS words of 64 bits, or null for a text without words."""
    # an upper end per bin, sorted in with the hashes, makes every bin appear
    ends = F.array(*(F.lit(_signed(b << _SHIFT | _EMPTY)) for b in range(BINS)))

    def least(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (
            F.shiftright(x, _SHIFT) != F.shiftright(F.get(s, i - 1), _SHIFT)))

    def cells(hashes: Column) -> Column:
        firsts = _bound(F.sort_array(F.concat(hashes, ends)), least)
        return F.transform(firsts, lambda x: F.when(
            x.bitwiseAND(F.lit(_EMPTY)) == _EMPTY, F.lit(-1)).otherwise(x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")))

    def filled(found: Column) -> Column:
        # bin j looks at start(j) + step * stride(j); an odd stride visits every bin of a power of two
        def look(now: Column, step: Column) -> Column:
            return F.when(F.array_contains(now, -1), F.transform(now, lambda v, j: F.when(v >= 0, v).otherwise(
                F.get(found, (_small(F.xxhash64(j)) + step * (_small(F.xxhash64(j, F.lit(1))) * 2 + 1)).bitwiseAND(F.lit(BINS - 1))))
            )).otherwise(now)

        return F.when(F.array_contains(found, -1), F.aggregate(
            F.sequence(F.lit(0), F.lit(BINS - 1)), found, look)).otherwise(found)

    def packed(values: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.aggregate(
            F.slice(values, w * _PER_WORD + 1, F.lit(_PER_WORD)), F.lit(0).cast("bigint"),
            lambda total, v: F.shiftleft(total, BITS).bitwiseOR(v.cast("bigint"))))

    return _bound(shingles(text), lambda h: F.when(
        F.size(h) > 0, _bound(cells(h), lambda c: _bound(filled(c), packed))))


def _small(x: Column) -> Column:
    return x.bitwiseAND(F.lit(BINS - 1)).cast("int")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def as_text(packed: Column) -> Column:
    """Lower-case hex digits; empty for no fingerprint."""
    return F.coalesce(F.lower(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), "")), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1; two texts without words are alike."""
    def differing(i: int) -> Column:
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        any_bit = x
        for k in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, k))
        return F.bit_count(any_bit.bitwiseAND(F.lit(_LOW)))

    total = differing(0)
    for i in range(1, WORDS):
        total = total + differing(i)
    chance = 2.0 ** -BITS
    share = (1 - total / F.lit(float(BINS)) - chance) / (1 - chance)
    return (
        F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0)
        .otherwise(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))))


def next_documents(docs: DataFrame, chunks: int) -> DataFrame:
    """Rows (doc_id, text, fp) with next_text and next_fp of the row that follows by descending doc_id.

    Ids are cut at quantiles into chunks, one shuffle brings a chunk together, and the first rows of
    each chunk are sent to the chunk before as well, where they come last. Rows of one id follow each
    other by text; null ids come last.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    keyed = docs.withColumn("key", key)
    cuts = docs.select(key.alias("key")).agg(
        F.percentile_approx("key", [i / chunks for i in range(1, chunks)] or [0.5]).alias("q"), F.max("key").alias("m")).first()
    bounds = sorted({*(cuts["q"] or []), *([] if cuts["m"] is None else [cuts["m"]])}, reverse=True)
    steps = F.lit([1 << s for s in range(max(1, len(bounds)).bit_length() - 1, -1, -1)])
    table = F.lit(bounds or [0])
    # number of bounds that are not below the key, by halving
    reach = F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        F.get(table, at + s - 1) >= F.col("key"), at + s).otherwise(at))
    keyed = keyed.withColumn("chunk", reach - 1)
    first = F.get(table, F.col("chunk")) == F.col("key")
    placed = keyed.withColumn("put", F.explode(F.when(first, F.array(
        F.struct(F.col("chunk").alias("chunk"), F.lit(False).alias("guest")),
        F.struct(F.pmod(F.col("chunk") - 1, F.lit(max(1, len(bounds)))).alias("chunk"), F.lit(True).alias("guest")))
    ).otherwise(F.array(F.struct(F.col("chunk").alias("chunk"), F.lit(False).alias("guest"))))))
    placed = placed.select("doc_id", "text", "fp", "key", F.col("put.chunk").alias("at"), F.col("put.guest").alias("guest"))
    order = Window.partitionBy("at").orderBy("guest", F.desc("key"), "text")
    return placed.select(
        "doc_id", "text", "fp", "guest", F.lead("text").over(order).alias("next_text"), F.lead("fp").over(order).alias("next_fp")
    ).where("not guest").drop("guest")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprint of every row of ``docs``, and of its text with the second half replaced from the next document.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null texts count
    as empty. A text without words has an empty fingerprint, like only to another such. Repeated rows follow
    each other, so one's next document is its copy. The only row of a table is its own next document.
    """
    chunks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = next_documents(rows.withColumn("fp", fingerprint(F.col("text"))), chunks)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), "fp", "next_fp", edited.alias("edited"))
    rows = rows.withColumn("edited_fp", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
