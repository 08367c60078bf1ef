"""Line dedup by content-defined chunks of lines, with DataFrame functions only.

The lines of a text that are not blank are hashed; a rolling hash over `ROLL` line hashes puts a chunk boundary wherever
it is 0 mod `DIVISOR`, so boundaries follow content and an inserted line shifts none behind it. A passage that repeats in
other surroundings starts and ends inside such chunks, so for each line the shortest run of two or more lines from it
that has `MIN_WORDS` words is a chunk too, and the shortest such run up to it: every repeat of two or more lines and
`MIN_WORDS` words is then covered to its edges, however short its lines. A line of `LONG_LINE` words or more is a chunk
by itself. Chunks of fewer than `MIN_WORDS` words are too common to mean anything and never go.

Steps: count chunk hashes over all documents; for repeated hashes cut the chunks' bytes out of the documents; group by
the bytes themselves (the byte comparison: equal hashes of different bytes part here); the first occurrence by (doc_id,
position) stays, and the lines of every later one go. Each line that goes therefore has an earlier equal one that stays.
A place of three or more lines that overlaps the first one of its document is no repeat: the lines are periodic.

Defined cases: null and empty texts stay as they are; documents without repeats keep their bytes; blank lines never go;
rows that are equal in id and text are one document (both keep or lose the same lines); null ids sort first; all columns
stay, and n_chars, if there, follows the new text. Line ends are "\\n"; a "\\r" belongs to its line. Words are what blanks,
tabs and the like part, so indentation and alignment weigh nothing; each character of a script that is written without
blanks is a word. A line without words is blank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.llm.common import stored, table
from brook.session import shared_dir

ROLL, DIVISOR = 2, 4
MIN_WORDS, LONG_LINE = 8, 50
#: Characters of scripts that do not part words: Thai and Lao, Myanmar, Khmer, kana, Han.
_UNPARTED = (r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3041-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF"
             r"\uF900-\uFAFF\uFF66-\uFF9F\x{20000}-\x{3FFFF}")

_ID, _HASH, _AT = "_brook_id", "_brook_hash", "_brook_at"


def _keyed(docs: DataFrame) -> DataFrame:
    """A row's identity: its id (null allowed) and the hash of its text."""
    return docs.withColumns({_ID: F.col("doc_id"), _HASH: F.xxhash64("text")})


def _lines(text: Column) -> Column:
    """The lines that are not blank: index and text."""
    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.named_struct(F.lit("i"), i, F.lit("x"), x))
    return F.filter(numbered, lambda s: s["x"].rlike(r"\S"))


def _words(line: Column) -> Column:
    """Words of a line, at least 1 in a line that is not blank; most lines have single blanks only."""
    blank = F.lit(" ")
    odd = F.contains(line, F.lit("  ")) | F.startswith(line, blank) | F.endswith(line, blank) | line.rlike(
        r"[\t\r\f\x0B]") | ((F.octet_length(line) > F.length(line)) & line.rlike(r"[\u0E00-\x{10FFFF}]"))
    return F.when(odd, F.regexp_count(line, F.lit(rf"[{_UNPARTED}]|[^\s{_UNPARTED}]+"))).otherwise(
        F.length(line) - F.length(F.replace(line, blank)) + 1)


def chunks(docs: DataFrame, divisor: int = DIVISOR, min_words: int = MIN_WORDS, long_line: int = LONG_LINE) -> DataFrame:
    """One row for each chunk: row identity, hash, and first place and number of lines among those not blank."""
    # This filter reads up to the first word; one on the lines would be pushed below them and make them twice.
    hashed = docs.filter(F.col("text").rlike(r"\S")).select(_ID, _HASH, F.transform(_lines(F.col("text")), lambda s: F.struct(
        F.xxhash64(s["x"]).alias("h"), _words(s["x"]).alias("w"))).alias("s"))
    hashed = hashed.select(
        _ID, _HASH, F.transform("s", lambda x: x["h"]).alias("h"), F.transform("s", lambda x: x["w"]).alias("w"))

    rolled = F.transform("h", lambda h, i: F.when(i + 1 >= ROLL, F.xxhash64(F.slice("h", i - ROLL + 2, F.lit(ROLL)))))
    hashed = hashed.select(_ID, _HASH, "w", "h", rolled.alias("r"))
    place = F.sequence(F.lit(0), F.size("h") - 1)
    starts = F.filter(place, lambda i: (i == 0) | F.coalesce(F.pmod(F.element_at("r", i), F.lit(divisor)) == 0,
                                                            F.lit(False)))
    hashed = hashed.select("*", F.concat(starts, F.array(F.size("h"))).alias("b"))

    def chunk(first: Column, n: Column, h: Column) -> Column:
        return F.struct(first.cast("int").alias("first"), n.cast("int").alias("n"), h.alias("h"))

    defined = F.transform(F.slice("b", 1, F.size("b") - 1), lambda a, j: chunk(
        a, F.element_at("b", j + 2) - a, F.xxhash64(F.slice("h", a + 1, F.element_at("b", j + 2) - a))))
    rolling = F.transform(F.slice("r", ROLL, F.greatest(F.size("r") - ROLL + 1, F.lit(0))),
                          lambda r, j: chunk(j, F.lit(ROLL), r))
    single = F.transform("h", lambda h, i: chunk(i, F.lit(1), h))
    word = lambda i: F.element_at("w", i + 1)
    pair = lambda i: word(i) + word(i + 1)

    def reach(ws: Column) -> Column:
        """How many of the first lines reach min_words, and their words."""
        none = F.struct(F.lit(0).alias("t"), F.lit(0).alias("n"))
        return F.aggregate(ws, none, lambda a, x: F.when(a["t"] >= min_words, a).otherwise(
            F.struct((a["t"] + x).alias("t"), (a["n"] + 1).alias("n"))))

    # A line has a word at least, so a run that reaches min_words has at most min_words lines. The four kinds of chunks
    # have no place in common: a run up to a line is left out if it is the run from its first line.
    short = F.filter(F.slice(place, 1, F.size("h") - 1), lambda i: pair(i) < min_words)
    ahead = F.filter(F.transform(short, lambda i: F.struct(
        i.alias("i"), reach(F.slice("w", i + 1, F.lit(min_words))).alias("c"))), lambda x: x["c"]["t"] >= min_words)
    back = F.filter(F.transform(short, lambda i: F.struct((i + 1).alias("i"), reach(F.reverse(F.slice(
        "w", F.greatest(i + 3 - min_words, F.lit(1)), F.least(i + 2, F.lit(min_words))))).alias("c"))),
        lambda x: x["c"]["t"] - word(x["i"]) >= min_words)
    run = lambda first, n: chunk(first, n, F.xxhash64(F.slice("h", first + 1, n)))

    def longer(c: Column) -> Column:
        """Whether a chunk is longer than the run from its first line and the run up to its last."""
        ends = F.greatest(word(c["first"]), word(c["first"] + c["n"] - 1))
        return F.aggregate(F.slice("w", c["first"] + 1, c["n"]), F.lit(0), lambda t, x: t + x) - ends >= min_words

    kept = F.concat(
        F.filter(defined, lambda c: (c["n"] > ROLL) & longer(c)),
        F.filter(rolling, lambda c: pair(c["first"]) >= min_words),
        F.transform(ahead, lambda x: run(x["i"], x["c"]["n"])),
        F.transform(back, lambda x: run(x["i"] - x["c"]["n"] + 1, x["c"]["n"])),
        F.filter(single, lambda c: word(c["first"]) >= long_line))
    return hashed.select(_ID, _HASH, F.explode(kept).alias("c")).select(
        _ID, _HASH, F.col("c.h").alias("h"), F.col("c.first").alias("first"), F.col("c.n").alias("n"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a[_ID].eqNullSafe(b[_ID]) & (a[_HASH] == b[_HASH])


def repeats(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Row identity and indexes of the lines that go."""
    keyed = _keyed(docs.select("doc_id", "text"))
    found = chunks(keyed, **options)
    often = found.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1").select("h")
    marked = (found.join(often, "h").groupBy(_ID, _HASH)
              .agg(F.collect_list(F.struct("first", "n")).alias("c")))  # as many as the document has chunks
    a, b = keyed.select(_ID, _HASH, "text"), marked
    cut = a.join(b, _same(a, b)).select(a[_ID], a[_HASH], _lines(F.col("text")).alias("s"), F.explode("c").alias("c"))
    piece = F.slice("s", F.col("c.first") + 1, F.col("c.n"))
    cut = cut.select(
        _ID, _HASH, F.col("c.first").alias("first"), F.transform(piece, lambda x: x["i"]).alias("lines"),
        F.array_join(F.transform(piece, lambda x: x["x"]), "\n").alias("bytes"))
    cut = stored(spark, cut, shared_dir(spark, "line-chunks"))
    # Rows that are equal in id and text have equal places, so they stay or go together.
    first = cut.groupBy("bytes").agg(F.min(F.struct(_ID, _HASH, "first")).alias("stays"), F.count("*").alias("k"))
    stays, n = F.col("stays"), F.size("lines")
    periodic = (n > ROLL) & F.col(_ID).eqNullSafe(stays[_ID]) & (F.col(_HASH) == stays[_HASH]) & (
        F.col("first") < stays["first"] + n)
    later = cut.join(first.filter("k > 1").select("bytes", "stays"), "bytes").filter(
        (F.struct(_ID, _HASH, "first") != stays) & ~periodic)
    return later.select(_ID, _HASH, F.explode("lines").alias("line")).groupBy(_ID, _HASH).agg(
        F.collect_set("line").alias(_AT))


def drop_repeats(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The documents without their repeated chunks; columns as before."""
    a, b = _keyed(docs), repeats(spark, docs, **options)
    joined = a.join(b, _same(a, b), "left").select(*[a[c] for c in a.columns], b[_AT])
    text = F.when(F.col(_AT).isNull(), F.col("text")).otherwise(F.array_join(F.filter(
        F.split("text", "\n"), lambda x, i: ~F.array_contains(_AT, i)), "\n"))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(_AT).isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(kind)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its remaining text, and how many characters went."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    before = docs.withColumn("n_chars", F.length("text").cast("long")).withColumn("n_before", F.col("n_chars"))
    out = drop_repeats(spark, before)
    return out.select("doc_id", "text", "n_chars", (F.col("n_before") - F.col("n_chars")).alias("n_removed"))
