"""I-Match fingerprints from DataFrame functions alone.

Terms are lower-cased runs of letters and digits. The lexicon keeps the terms whose inverse document
frequency lies in a band. Each term has a random level (level ``s`` or more with probability ``4 ** -s``)
and one of 32 random subsets of the lexicon. A text's level is the lowest at which at most 32 of its terms
remain; its fingerprint hashes the sorted distinct terms of every subset, at that level and the next. Two
fingerprints are as alike as the share of equal hashes among the subsets that either has terms in, over the
levels both have.

Frequencies are counted over all documents, per hash bucket of terms: 2^20 buckets whatever the corpus, so
the lexicon is a bitmap of fixed size (128 KiB) that every task can hold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.llm.tables import partitions_for, text_or_empty

NOT_A_TERM = r"[^\p{L}\p{N}]+"
BUCKET_BITS = 20
WORDS = 1 << BUCKET_BITS - 6  # 64-bit words of the bitmap
SUBSETS = 32
MOST_TERMS = 32  # of a fingerprint's lower level
LEVELS = 12
EMPTY = 0  # the hash of a subset without terms


@dataclass(frozen=True)
class Band:
    """Kept terms have ``low <= ln(documents / documents with the term) <= high``."""

    low: float = 3.0
    high: float = 9.0


def terms(text: Column) -> Column:
    """Distinct hashes of the terms of ``text``. Bits from 0 on give the bucket, the subset and the level."""
    words = F.filter(F.split(F.lower(text), NOT_A_TERM), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, band: Band = Band(), text_col: str = "text") -> DataFrame:
    """One row, ``bitmap array<bigint>``: bit ``b`` is set if the terms of bucket ``b`` are kept."""
    buckets = F.array_distinct(F.transform(terms(text_or_empty(text_col)), lambda h: h.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))))
    counts = docs.select(F.explode(buckets).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    idf = F.log(n_docs / F.col("df"))
    kept = counts.filter((idf >= band.low) & (idf <= band.high))
    words = kept.select(F.expr("bucket >> 6").alias("at"), F.expr("shiftleft(1L, cast(bucket & 63 as int))").alias("word"))
    zeros = docs.sparkSession.range(WORDS).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word"))
    full = words.unionByName(zeros).groupBy("at").agg(F.bit_or("word").alias("word"))
    in_order = F.array_sort(F.collect_list(F.struct("at", "word")))  # always WORDS entries
    return full.agg(F.transform(in_order, lambda x: x["word"]).alias("bitmap"))


def with_fingerprint(df: DataFrame, text: str, bitmap: Column, name: str) -> DataFrame:
    """Adds the struct ``name``: level, ``own`` and ``next`` (subset hashes at the level and the one above), and ``rest``.

    ``rest`` is a hash of the whole text where no term of it is in the lexicon, else null.
    """
    bit = f"shiftright(get(_bitmap, cast((h & {(1 << BUCKET_BITS) - 1}) >> 6 as int)), cast(h & 63 as int)) & 1"
    above = "shiftrightunsigned(h, 25)"  # the bits that decide the level, two for each

    def kept(level: str) -> str:
        return f"filter(_kept, h -> {above} & (shiftleft(1L, 2 * ({level})) - 1) = 0)"

    def hashes(source: str) -> str:
        one = f"filter({source}, h -> shiftrightunsigned(h, {BUCKET_BITS}) & {SUBSETS - 1} = j)"
        return f"transform(sequence(0, {SUBSETS - 1}), j -> if(size({one}) = 0, {EMPTY}L, xxhash64({one})))"

    fitting = f"coalesce(get(filter(sequence(0, {LEVELS - 1}), s -> size({kept('s')}) <= {MOST_TERMS}), 0), {LEVELS})"
    out = df.withColumn("_bitmap", bitmap).withColumn("_terms", terms(F.col(text)))
    out = out.withColumn("_kept", F.expr(f"array_sort(filter(_terms, h -> ({bit}) = 1))")).drop("_bitmap", "_terms")
    out = out.withColumn("_level", F.expr(fitting))
    out = out.withColumn("_low", F.expr(kept("_level"))).withColumn("_high", F.expr(kept("_level + 1")))
    rest = F.when(F.size("_kept") == 0, F.xxhash64(F.col(text)))
    out = out.withColumn(name, F.struct(F.col("_level").alias("level"), F.expr(hashes("_low")).alias("own"), F.expr(hashes("_high")).alias("next"), rest.alias("rest")))
    return out.drop("_kept", "_level", "_low", "_high")


def fingerprint_text(name: str) -> Column:
    """The fingerprint as text: its level, then one hash for each subset that has terms."""
    both = F.transform(F.concat(F.col(f"{name}.own"), F.col(f"{name}.next")), lambda h: F.when(h == EMPTY, "-").otherwise(F.lower(F.hex(h))))
    terms_of = F.concat_ws(":", F.col(f"{name}.level").cast("string"), F.array_join(both, "."))
    return F.when(F.col(f"{name}.rest").isNotNull(), F.concat(F.lit("text:"), F.lower(F.hex(f"{name}.rest")))).otherwise(terms_of)


def likeness(a: str, b: str) -> Column:
    """0 to 1: equal hashes among the subsets that either has terms in; 0 if the levels are more than one apart."""

    def shares(x: str, y: str) -> tuple[Column, Column]:
        pairs = F.arrays_zip(F.col(x).alias("x"), F.col(y).alias("y"))
        used = F.filter(pairs, lambda p: (p["x"] != EMPTY) | (p["y"] != EMPTY))
        return F.size(F.filter(used, lambda p: p["x"] == p["y"])), F.size(used)

    def ratio(*parts: tuple[Column, Column]) -> Column:
        same, used = sum((p[0] for p in parts), F.lit(0)), sum((p[1] for p in parts), F.lit(0))
        return F.when(used > 0, same / used).otherwise(0.0)

    gap = F.col(f"{a}.level") - F.col(f"{b}.level")
    either_rest = F.col(f"{a}.rest").isNotNull() | F.col(f"{b}.rest").isNotNull()
    return (
        F.when(either_rest, F.when(F.col(f"{a}.rest").eqNullSafe(F.col(f"{b}.rest")), 1.0).otherwise(0.0))
        .when(gap == 0, ratio(shares(f"{a}.own", f"{b}.own"), shares(f"{a}.next", f"{b}.next")))
        .when(gap == 1, ratio(shares(f"{a}.own", f"{b}.next")))
        .when(gap == -1, ratio(shares(f"{a}.next", f"{b}.own")))
        .otherwise(0.0)
    )


def with_successor(df: DataFrame, key: str, columns: list[str], ties: str, parts: int | None = None) -> DataFrame:
    """Adds ``next_<c>``: the values of the following row by ``key`` (then ``ties``); after the last row, the first's.

    Rows are cut into ranges at keys that occur. The row at a cut is also dealt to the range before it, and the
    first row of all to the last range, so every range finds its successors without its neighbours.
    """
    parts = parts or 4 * partitions_for(df.sparkSession)
    lowest = -(1 << 63)
    order = F.coalesce(F.col(key), F.lit(lowest))
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)]) if parts > 1 else F.array(F.lit(0.5))
    bounds = df.select(order.alias("k")).agg(F.array_distinct(F.percentile_approx("k", shares, 10_000)).alias("cuts"), F.min("k").alias("first")).first()
    cuts = sorted(bounds["cuts"] or []) if parts > 1 else []
    first = bounds["first"] if bounds["first"] is not None else lowest
    cuts_col = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.expr("array(cast(null as bigint))")
    part = F.size(F.filter(cuts_col, lambda c: c <= F.col("_key")))
    here = F.struct(F.col("_part").alias("part"), F.lit(0).alias("copy"))
    before = F.when(F.array_contains(cuts_col, F.col("_key")) & (F.col("_key") > first), F.struct((F.col("_part") - 1).alias("part"), F.lit(1).alias("copy")))
    around = F.when(F.col("_key") == first, F.struct(F.lit(len(cuts)).alias("part"), F.lit(2).alias("copy")))
    dealt = df.withColumn("_key", order).withColumn("_part", part).withColumn("_to", F.explode(F.array_compact(F.array(here, before, around))))
    dealt = dealt.select(*df.columns, "_key", F.col("_to.part").alias("_range"), F.col("_to.copy").alias("_copy"), (F.col("_to.copy") == 2).alias("_last"))
    window = Window.partitionBy("_range").orderBy("_last", "_key", ties)
    dealt = dealt.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in columns])
    return dealt.filter(F.col("_copy") == 0).drop("_key", "_range", "_copy", "_last")


def edit_report(docs: DataFrame, band: Band = Band(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness.

    The edited text replaces the last quarter of a text (floor of its code points) by as much of the start of
    the next text in id order, or all of that. Null texts count as empty; a null id sorts before all others;
    rows with equal ids are ordered by text. An empty text has the fingerprint of a text without known terms,
    and two texts without such terms are alike (1.0) only if they are equal. A table of one row is its own
    successor. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    bitmap = lexicon(docs.select(F.col(text_col).alias("text")), band).scalar()
    rows = with_successor(with_fingerprint(rows, "text", bitmap, "fp"), "doc_id", ["text", "fp"], "text")
    quarter = F.expr("char_length(text) div 4").cast("int")
    n_chars = F.char_length("text")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n_chars - quarter), F.substring(F.col("next_text"), F.lit(1), quarter)))
    rows = with_fingerprint(rows.drop("next_text"), "edited", bitmap, "edited_fp")
    return rows.select("doc_id", "text", "edited", "fp", "edited_fp", likeness("fp", "edited_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"))
