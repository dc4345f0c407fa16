r"""Document fingerprints by winnowing, as DataFrame operations only.

A text is cut into tokens. A word, which is a run of at most ``LONGEST`` letters or digits of
scripts that set blanks, is cut into pieces of four from its start. Every other visible character
is a token by itself, also in longer runs and in scripts without blanks (``UNSPACED``), so that
no token there depends on where its run began. Each run of ``GRAM`` tokens has a hash. In every
window of ``WINDOW`` neighbouring hashes the smallest is chosen, the rightmost of equal ones, and
its place is kept. Two texts that share GRAM + WINDOW - 1 tokens in a row therefore share a chosen
hash, and the places say where. A shared passage has these tokens in common but for those of words
that it begins or ends within: some 40 letters of words, 12 characters of a script without
blanks, and LONGEST + 1 characters inside an unbroken run.

A chosen hash and its place are packed into one long, hash first and the place counted down, so
that the smaller of two longs is also the rightmost of equal hashes. Places are modulo 2**23; of
equal hashes in a window around a multiple of that, the leftmost is chosen.

A text with fewer tokens than a gram has one gram of all its tokens; with fewer grams than a
window, one window. Null text is empty; a text without visible characters has no fingerprint,
and two such are alike (1.0), as are any two equal texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Thai, Lao, Myanmar, Khmer, Tai, Balinese, Javanese, CJK, kana: scripts without blanks.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u1b00-\u1b7f\u2e80-\u312f\u3190-\u9fff\ua980-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
#: A letter, mark or digit of another script: what is no blank, sign or control. Plain ones are looked up first.
LETTER = r"[a-zA-Z0-9[[\p{L}\p{M}\p{N}]&&[^" + UNSPACED + "]]]"
LONGEST = 16
#: A run that is longer, and each of its letters: the first, and those that follow one found.
LONG = rf"{LETTER}{{{LONGEST + 1}}}"
EACH = rf"(?:\G(?!^)|(?<!{LETTER})(?={LONG}))({LETTER})"
#: Pieces of words; otherwise a character.
TOKEN = rf"{LETTER}{{1,4}}+|\S"
GRAM, WINDOW = 5, 8
PLACE_BITS = 23
PLACES = (1 << PLACE_BITS) - 1
#: Documents of a block in which neighbours are found, about, and the most blocks.
BLOCK_ROWS, MOST_BLOCKS = 128, 1 << 15


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """The rows with the packed fingerprint of a text column, an array of longs in order of place."""
    hashes, packed = f"__hashes_{name}", f"__packed_{name}"
    spaced = F.when(F.col(text).rlike(LONG), F.regexp_replace(text, EACH, "$1 ")).otherwise(F.col(text))
    tokens = F.regexp_extract_all(spaced, F.lit(TOKEN), F.lit(0))
    df = df.withColumn(hashes, F.transform(tokens, lambda x: F.xxhash64(x)))

    def gram(x: Column, i: Column) -> Column:
        value = F.xxhash64(x, *[F.get(F.col(hashes), i + j) for j in range(1, GRAM)])
        return value.bitwiseAND(F.lit(~PLACES)).bitwiseOR(F.lit(PLACES).bitwiseXOR(i.cast("long").bitwiseAND(F.lit(PLACES))))

    def smallest(x: Column, i: Column) -> Column:
        return F.least(x, *[F.get(F.col(packed), i + j) for j in range(1, WINDOW)])

    def first(column: str, but: int) -> Column:
        size = F.size(column)
        return F.slice(F.col(column), F.lit(1), F.greatest(size - but, F.least(size, F.lit(1))))

    df = df.withColumn(packed, F.transform(first(hashes, GRAM - 1), gram))
    df = df.withColumn(name, F.array_distinct(F.transform(first(packed, WINDOW - 1), smallest)))
    return df.drop(hashes, packed)


def hash_set(fingerprint: Column) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftrightunsigned(x, PLACE_BITS)))


def written(fingerprint: Column) -> Column:
    """``hash:place`` of each choice, in order of place."""

    def one(x: Column) -> Column:
        place = F.lit(PLACES).bitwiseXOR(x.bitwiseAND(F.lit(PLACES)))
        return F.concat(F.lower(F.hex(F.shiftrightunsigned(x, PLACE_BITS))), F.lit(":"), place.cast("string"))

    return F.array_join(F.transform(fingerprint, one), " ")


def likeness(left: str, right: str) -> Column:
    """Jaccard similarity of two hash sets; of two empty ones, 1."""
    both = F.size(F.array_intersect(left, right))
    every = F.size(left) + F.size(right) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both.cast("double") / every)


def block_bounds(docs: DataFrame) -> list[int]:
    """Ids that begin blocks of about BLOCK_ROWS rows; the smallest id is the first.

    They are drawn from a bounded number of ids. Where they lie changes no result.
    """
    ids = docs.select(id_key().alias("id"))
    rows, least = ids.agg(F.count("*"), F.min("id")).first()
    blocks = min(max(rows // BLOCK_ROWS, 1), MOST_BLOCKS)
    share = min(1.0, 4 * blocks / max(rows, 1))
    drawn = F.pmod(F.xxhash64(F.lit("bounds"), "id"), F.lit(1 << 30)) < int(share * (1 << 30))
    found = sorted(x["id"] for x in ids.filter(drawn).distinct().toLocalIterator())
    return sorted({least if least is not None else 0, *found[:: max(len(found) // blocks, 1)]})


def id_key() -> Column:
    """Null ids come first."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))


def block_of(bounds: list[int]) -> Column:
    """The number of the last bound that is not above the id, by bisection."""
    listed = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    below = lambda at: F.coalesce(F.get(listed, at) <= id_key(), F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(below(at + step), at + step).otherwise(at))


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The rows with ``next_<name>`` of the following row by ascending id; the first follows the last.

    Rows are dealt to blocks of neighbouring ids. The first of a block also goes to the block
    before it, as a guest that sorts last. Equal ids are ordered by text.
    """
    bounds = block_bounds(docs)
    rows = docs.withColumn("block", block_of(bounds))
    begins = F.array_contains(F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>"), id_key())
    own = F.struct(F.col("block").alias("block"), F.lit(0).alias("guest"))
    also = F.struct(F.pmod(F.col("block") - 1, F.lit(len(bounds))).alias("block"), F.lit(1).alias("guest"))
    rows = rows.select("*", F.explode(F.when(begins, F.array(own, also)).otherwise(F.array(own))).alias("place"))
    rows = rows.select(*docs.columns, F.col("place.block").alias("block"), F.col("place.guest").alias("guest"), id_key().alias("key"))
    order = Window.partitionBy("block").orderBy("guest", "key", "text")
    following = [F.lead(name).over(order).alias(f"next_{name}") for name in carried]
    return rows.select(*docs.columns, "guest", *following).filter("guest = 0").drop("guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: the fingerprints of its text and of its edited text, and how alike they are.

    The edited text has its last quarter of code points replaced by the first as many of the
    next document.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(with_fingerprint(rows, "text", "chosen"), ["text", "chosen"])
    size = F.length("text")
    quarter = F.floor(size / 4).cast("int")
    edited = F.concat(F.left("text", size - quarter), F.left("next_text", quarter))
    rows = rows.select("doc_id", "chosen", "next_chosen", size.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = with_fingerprint(rows, "edited", "edited_chosen")
    sets = {"own": "chosen", "changed": "edited_chosen", "following": "next_chosen"}
    rows = rows.select("*", *[hash_set(F.col(c)).alias(name) for name, c in sets.items()])
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("chosen")).alias("fingerprint"),
        written(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "following").alias("near_next"),
    )


def op1_winnowing(spark, sf_dir):
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
