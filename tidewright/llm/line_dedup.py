"""Line deduplication: an exact set-similarity join over line tokens, in DataFrame functions only."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import written

#: Token frequencies are counted in so many buckets of token hashes; a bucket's count decides how rare its tokens are.
BUCKETS = 1 << 19
THRESHOLD = 80
#: Documents with places of wanted lines are broadcast up to so many (some 100 bytes in memory each); more are joined by shuffle.
BROADCAST_DOCS = 250_000
#: Lines meet on tokens in so many passes, each over its share of the tokens; the shuffle files of a pass go before the next.
PASSES = 2
#: A pass verifies about so many pairs for each line that has one, and so many at least: pairs carry tokens, and their number grows with the square of a group of near-equal lines.
PAIRS_A_LINE, PAIRS_A_PASS = 1.5, 250_000
#: Lines whose tokens are in one bucket, about (some 10 MB).
LINES_A_BUCKET = 20_000


def _spaced(text: Column) -> Column:
    """Lower case, with a space for each other white-space character but the line feed."""
    out = F.lower(text)
    for c in "\t\x0b\x0c\r":
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def _lines(docs: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, pos, h1, h2, bits, n, t): every line with a token; h1 and h2 are a 96-bit digest of the spaced line, n is how many tokens its set has.

    Tokens of a line are ordered from rare to common; t is its prefix, 32 bits of each: so many of the rarest that lines without a common one there cannot be similar.
    A token turns one of 64 bits, so in bits tokens of both sets leave no trace: similar sets differ in no more bits than in tokens.
    """
    table = rarity(docs)
    # Rarity above, hash below: one number that orders tokens and tells them apart.
    order = lambda h: F.shiftleft(F.get(table, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), 55).bitwiseOR(F.shiftrightunsigned(h, 9))
    lines = docs.select("doc_id", F.posexplode(F.split(_spaced(F.col("text")), "\n")).alias("pos", "line")).filter("trim(line) <> ''")
    sets = lines.select("doc_id", "pos", *_digest(), F.sort_array(F.transform(_hashes(), order)).alias("s"))
    bits = F.aggregate("s", F.lit(0).cast("bigint"), lambda acc, h: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int"))))
    n = F.size("s")
    prefix = F.transform(F.slice("s", F.lit(1), n - F.ceil(n * F.lit(threshold) / 100).cast("int") + 1), lambda t: F.hash(t))
    return sets.select("doc_id", "pos", "h1", "h2", bits.alias("bits"), n.alias("n"), prefix.alias("t"))


def _digest() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.hash(F.lit(7), "line").alias("h2")]


def _hashes() -> Column:
    """Hashes of the different tokens of a spaced line."""
    return F.array_distinct(F.array_remove(F.transform(F.split("line", " "), lambda t: F.xxhash64(t)), F.xxhash64(F.lit(""))))


def _place(doc: str = "doc_id", pos: str = "pos") -> Column:
    """Document and line as one number, in order of both: fits a hash aggregate."""
    return F.col(doc).cast("decimal(28,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col(pos)


def rarity(docs: DataFrame) -> Column:
    """How common each bucket of token hashes is, from 0 (rarest) to 127, over all tokens of all documents (text): a literal array of BUCKETS numbers."""
    tokens = docs.select(F.explode(F.split(F.replace(_spaced(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("t")).filter("t <> ''")
    h = tokens.select(F.xxhash64("t").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("h"))
    # A row counts 16 neighbouring buckets, so the keys are few enough for a small hash table.
    row = h.select(F.shiftright("h", 4).alias("b"), F.col("h").bitwiseAND(F.lit(15)).alias("c"))
    counts = row.groupBy("b").agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in range(16)])
    step = lambda n: F.when(F.col(n) == 0, 0).otherwise(F.least(F.lit(127), F.floor(3 * F.log2(n)))).cast("string")
    listed = F.array_join(F.collect_list(F.concat_ws(":", F.col("b").cast("string"), *[step(f"n{i}") for i in range(16)])), ",")
    table = ["0"] * BUCKETS
    for r in counts.groupBy(F.shiftright("b", 6)).agg(listed.alias("x")).collect():
        for row in r["x"].split(","):
            b, *steps = row.split(":")
            table[16 * int(b) : 16 * int(b) + 16] = steps
    return F.split(F.lit(",".join(table)), ",").cast("array<bigint>")


def _candidates(classes: DataFrame, threshold: int) -> DataFrame:
    """(a, b): pairs of h1 of different lines that their prefixes, places, lengths and bits allow; each pair once.

    Lines meet on a token of their prefixes. Where they met on the token before it already, they say nothing. Every different line takes part once, however
    often it occurs; its text is not moved for that.
    """
    met = [written(_met(classes, threshold, F.pmod("t", F.lit(PASSES)) == k), "line-met", free=True) for k in range(PASSES)]
    return reduce(DataFrame.unionByName, met).distinct()


def _met(classes: DataFrame, threshold: int, some: Column) -> DataFrame:
    """(a, b) of ``_candidates`` that ``some`` of the tokens (t) give; a pair may come twice."""
    placed = classes.select("h1", "bits", "n", F.col("t").alias("ts"), F.posexplode("t").alias("p", "t")).filter(some).withColumn("before", F.get("ts", F.col("p") - 1))
    x, y = (placed.select("t", *[F.col(c).alias(f"{s}_{c}") for c in ("h1", "bits", "n", "p", "before")]) for s in "xy")
    after, both = F.least(F.col("x_n") - F.col("x_p"), F.col("y_n") - F.col("y_p")), F.col("x_n") + F.col("y_n")
    fits = (
        ((F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_h1") < F.col("y_h1"))))
        & (100 * F.col("x_n") >= threshold * F.col("y_n"))
        & (F.col("x_before").isNull() | F.col("y_before").isNull() | (F.col("x_before") != F.col("y_before")))
        & ((100 + threshold) * after >= threshold * both)
        & ((100 + threshold) * F.bit_count(F.col("x_bits").bitwiseXOR(F.col("y_bits"))) <= (100 - threshold) * both)
    )
    return x.join(y, "t").filter(fits).select(F.col("x_h1").alias("a"), F.col("y_h1").alias("b"))


def similar_lines(docs: DataFrame, classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a1, a2, b1, b2) between different lines of docs (doc_id, text) with 100 * intersection >= threshold * union of tokens.

    Candidates by prefix, place, length and bits; only lines with a candidate bring their tokens, from their first place (``classes``: h1, h2, first, bits, n, t),
    and pairs are verified on all of them, in passes: what a pass moves grows with the lines, not with the pairs.
    """
    pairs = written(_candidates(classes, threshold), "line-pairs", free=True)
    wanted = classes.join(pairs.select(F.explode(F.array("a", "b")).alias("h1")).distinct(), "h1", "left_semi")
    size = F.lit(1 << 31).cast("decimal(10,0)")
    pos = F.pmod("first", size)
    wanted = wanted.select(((F.col("first") - pos) / size).cast("bigint").alias("doc_id"), pos.cast("int").alias("pos")).distinct()
    wanted = written(wanted.groupBy("doc_id").agg(F.collect_list("pos").alias("places")), "line-wanted", free=True)
    n_docs, n_lines = wanted.agg(F.count("*"), F.coalesce(F.sum(F.size("places")), F.lit(0))).first()
    few = n_docs <= BROADCAST_DOCS
    texts = docs.join(F.broadcast(wanted) if few else wanted, "doc_id").select("places", F.posexplode(F.split(_spaced(F.col("text")), "\n")).alias("pos", "line"))
    # Rows that repeat an id have other lines there, too: those that no pair asks for find none.
    once = texts.filter(F.array_contains("places", F.col("pos"))).select(*_digest(), _hashes().alias("s"))
    sets = written(once, "line-sets", free=True, by="h1", buckets=math.ceil(n_lines / LINES_A_BUCKET) or 1)
    passes = math.ceil(pairs.count() / max(PAIRS_A_PASS, PAIRS_A_LINE * n_lines)) or 1
    a, b = (sets.select(F.col("h1").alias(s), F.col("h2").alias(f"{s}2"), F.col("s").alias(f"t{s}")) for s in "ab")
    verified = []
    for k in range(passes):
        both = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(passes)) == k).join(a.hint("merge"), "a").join(b.hint("merge"), "b")
        links = both.filter((100 + threshold) * F.size(F.array_intersect("ta", "tb")) >= threshold * (F.size("ta") + F.size("tb")))
        verified.append(written(links.select(F.col("a").alias("a1"), "a2", F.col("b").alias("b1"), "b2").distinct(), "line-links", free=True))
    return reduce(DataFrame.unionByName, verified)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, n_lines, removed_lines (positions from 0), n_links, text (the lines that stay).

    Lines are in order of id, then position. A line goes if an earlier one is equal, or similar to it: tokens are what spaces and other
    white space separate, in lower case, and 100 * intersection >= threshold * union of the token sets. Every earlier line of the input
    counts, also one that goes itself. n_links is the number of links of the row's lines to different lines, near or far.
    If ``text`` isn't asked for, texts are not joined.

    Lines without tokens stay and have no links; a null text has no lines and stays null. Rows with a null id stay whole and take nothing from others.
    Rows that repeat an id are one document, line by line: position and id decide which is earlier, and of equal places both stay or go.
    Other columns are not read. Ids are whole numbers.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    known = rows.filter("doc_id is not null")
    lines = written(_lines(known, threshold), "line-places", free=True)
    firsts = written(lines.groupBy("h1", "h2").agg(F.min(_place()).alias("first"), *[F.first(c).alias(c) for c in ("bits", "n", "t")]), "line-firsts", free=True)
    links = similar_lines(known, firsts, threshold)
    ends = links.select(F.explode(F.array(F.struct(*[F.col(c).alias(n) for c, n in (("a1", "h1"), ("a2", "h2"), ("b1", "o1"), ("b2", "o2"))]), F.struct(*[F.col(c).alias(n) for c, n in (("b1", "h1"), ("b2", "h2"), ("a1", "o1"), ("a2", "o2"))]))).alias("e")).select("e.*")
    other = firsts.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("first").alias("_other"))
    linked = ends.join(other, ["o1", "o2"]).groupBy("h1", "h2").agg(F.min("_other").alias("_earliest"), F.count("*").alias("_links"))
    classes = firsts.select("h1", "h2", "first").join(linked, ["h1", "h2"], "left")
    judged = lines.select("doc_id", "pos", "h1", "h2").join(classes, ["h1", "h2"])
    gone = (_place() > F.col("first")) | (_place() > F.col("_earliest"))
    by_doc = judged.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.when(gone, F.col("pos")))).alias("_gone"), F.sum(F.coalesce("_links", F.lit(0))).alias("_links"))
    out = rows.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))).join(by_doc, "doc_id", "left")
    removed = F.coalesce("_gone", F.array().cast("array<int>"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(removed, i)), "\n")
    return out.select(F.col("doc_id").alias(id_col), "n_lines", removed.alias("removed_lines"), F.coalesce("_links", F.lit(0)).alias("n_links"), kept.alias("text"))
