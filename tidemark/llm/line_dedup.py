"""Near-duplicate lines: exact set-similarity join, keeping the first of each match.

A line's tokens are its distinct word shingles (five words; a shorter line is one
shingle). A line goes when an earlier line, in order of (doc_id, text hash, line
number), has Jaccard similarity 0.8 or more with it.

* Lines with the same set are one key; its first place is an aggregate.
* Tokens are ordered by rarity: counts over all lines, in 65,536 buckets, put tokens of
  busy buckets last. Any fixed order gives the same result; this one keeps groups small.
* Prefix filter: only the first ``n - ceil(0.8 n) + 1`` tokens are posted, once per key (so
  copies of a line weigh nothing), and only tokens that two keys post go on. Length and positional filters cut the candidates.
* Each key is first compared with the earliest key at its tokens, which settles groups of
  near copies with as many comparisons as keys. Only keys without a match there are
  compared with all earlier keys that share a token.
* Of those, pairs go that share too few posted tokens: up to the smaller of the last tokens
  that two keys post, both post all they share, so the overlap is at most the tokens they
  share there and what one of them has beyond its prefix.
* Candidates whose 16-bit sketches rule out the overlap go: a value that only one sketch has
  stands for a token that the other set lacks. Both bounds are exact and lose no match.
* The others are verified on the whole sets of 64-bit shingle hashes of their lines.

Built-in functions only. Hash sets of lines go through the shared folder and are
deleted when the result's small table of removed lines is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.rows import evaluated_once
from tidemark.llm.text import let, shield, words
from tidemark.session import discard, swept

WIDTH = 5
BUCKETS = 1 << 16
BUSY = 4096
SMALL_ROWS = 500_000
_NO_ID = -(1 << 63)


def _hashed(ws: Column) -> Column:
    """Distinct 64-bit hashes of the shingles of a word array, sorted."""
    n = F.size(ws)

    def of(hs: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(n - WIDTH, F.lit(0)))
        grams = F.transform(starts, lambda i: F.xxhash64(*[F.get(hs, i + j) for j in range(WIDTH)]))
        return F.when(n < WIDTH, F.array(F.xxhash64(hs))).otherwise(grams)

    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(
        F.sort_array(F.array_distinct(let(F.transform(ws, lambda w: F.xxhash64(w)), of)))
    )


def _named(docs: DataFrame) -> DataFrame:
    """Rows with the two columns that name a document, ``_d`` and ``_h``."""
    return docs.withColumn("_d", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))).withColumn(
        "_h", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    )


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_sets(docs: DataFrame) -> DataFrame:
    """(_d, _h, line, n, key, ids): every line with words, its set size, set name and 32-bit token ids."""
    lines = _named(docs.select("doc_id", "text")).select("_d", "_h", F.posexplode(_lines(F.col("text"))).alias("line", "t"))
    sets = lines.where(F.col("t").rlike(r"[^\x20\x09-\x0D]")).select(
        "_d", "_h", "line", let(words(F.lower("t")), _hashed).alias("hs")
    )
    return sets.select(
        "_d", "_h", "line", F.size("hs").alias("n"), F.xxhash64("hs").alias("key"),
        F.transform("hs", lambda h: F.shiftright(h, 32).cast("int")).alias("ids"),
    )


def _busy_buckets(sets: DataFrame) -> tuple[list[int], list[int]]:
    """The buckets that hold most tokens, in two grades; BUSY at most, so literals stay bounded."""
    counts = (
        sets.select(F.explode("ids").alias("id")).groupBy(F.pmod("id", F.lit(BUCKETS)).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n")).collect()
    )
    ranked = sorted(((r["n"], r["bucket"]) for r in counts), reverse=True)
    if not ranked:
        return [], []
    usual = ranked[len(ranked) // 2][0]
    busy = [(n, b) for n, b in ranked[:BUSY] if n > 1.25 * usual + 8]
    return [b for n, b in busy if n <= 4 * usual + 32], [b for n, b in busy if n > 4 * usual + 32]


def _ordered(ids: Column, busy: list[int], busiest: list[int]) -> Column:
    """Token ids as longs whose numeric order is the global order."""

    levels = [(level << 33, some) for level, some in ((1, busy), (2, busiest)) if some]

    def token(i: Column) -> Column:
        bucket = F.pmod(i, F.lit(BUCKETS))
        ahead = F.lit(0).cast("long")
        for added, some in levels:
            ahead = F.when(bucket.isin(some), F.lit(added).cast("long")).otherwise(ahead)
        if len(levels) > 1:  # most tokens are in no list and ask once
            ahead = F.when(bucket.isin(busy + busiest), ahead).otherwise(F.lit(0).cast("long"))
        return ahead + i.cast("long")

    return F.sort_array(F.transform(ids, lambda i: token(F.coalesce(i, F.lit(0)))))  # never null, which sorts faster


def _possible(a: Column, i: Column, b: Column, j: Column) -> Column:
    """Length and positional filters for sets of sizes a, b that meet at positions i, j."""
    need = F.ceil(4 * (a + b) / F.lit(9))
    return (5 * F.least(a, b) >= 4 * F.greatest(a, b)) & (1 + F.least(a - i - 1, b - j - 1) >= need)


def _beyond(n: Column) -> Column:
    """How many tokens a set of n does not post."""
    return F.floor((4 * n + 4) / F.lit(5)).cast("int") - 1


def _if_small(df: DataFrame) -> DataFrame:
    """Broadcast a written table of at most SMALL_ROWS rows; larger ones are shuffled."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def _likely(sets: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """The pairs (key, other) whose sketches leave the similarity in reach."""
    names = swept(
        pairs.select("key").unionByName(pairs.select(F.col("other").alias("key"))).distinct(), f"{label}-names"
    )
    sketches = swept(
        sets.join(_if_small(names), "key", "left_semi")
        .select("key", "n", F.array_distinct(F.transform("ids", lambda i: F.shiftright(i, 16).cast("smallint"))).alias("s"))
        .dropDuplicates(["key"]),
        f"{label}-sketches",
    )
    others = sketches.select(F.col("key").alias("other"), F.col("n").alias("m"), F.col("s").alias("t"))
    most = F.least(F.col("n") - F.size(F.array_except("s", "t")), F.col("m") - F.size(F.array_except("t", "s")))
    near = swept(
        pairs.select("key", "other").join(sketches, "key").join(others, "other")
        .where(9 * most >= 4 * (F.col("n") + F.col("m"))).select("key", "other"),
        f"{label}-likely",
    )
    discard(names, sketches)
    return near


def _in_reach(later: DataFrame, earlier: DataFrame) -> DataFrame:
    """The pairs (key, other) of a key and an earlier one whose shared posted tokens leave the similarity in reach.

    ``later`` (token, key, place, n, pos) and ``earlier`` (token, other, other_place, m, at) have all tokens that two
    keys post. Tokens that a pair shares at places too far apart are not counted; such a pair is out of reach anyway.
    """
    n, m, i, j = (F.col(c) for c in ("n", "m", "pos", "at"))
    need = F.ceil(4 * (n + m) / F.lit(9)).cast("int")
    met = later.join(
        earlier,
        (later["token"] == earlier["token"]) & (F.col("other_place") < F.col("place")) & (F.col("key") != F.col("other"))
        & (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1) >= need),
    ).select("key", "other", (need - F.greatest(_beyond(n), _beyond(m))).alias("short"))
    return met.groupBy("key", "other").agg(F.count(F.lit(1)).alias("c"), F.max("short").alias("short")).where("c >= short").select("key", "other")


def _verified(docs: DataFrame, starts: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """The keys of the pairs (key, other) whose lines reach the similarity, by their words."""
    names = swept(
        pairs.select("key").unionByName(pairs.select(F.col("other").alias("key"))).distinct(), f"{label}-names"
    )
    places = swept(
        starts.join(_if_small(names), "key", "left_semi").select("key", "place._d", "place._h", "place.line"), f"{label}-places"
    )
    homes = swept(places.select("_d", "_h").distinct(), f"{label}-homes")
    found = _named(docs.select("doc_id", "text")).join(_if_small(homes), ["_d", "_h"], "left_semi").select(
        "_d", "_h", F.posexplode(_lines(F.col("text"))).alias("line", "t")
    )
    texts = found.join(_if_small(places), ["_d", "_h", "line"]).select("key", "t").dropDuplicates(["key"])
    grams = swept(texts.select("key", let(words(F.lower("t")), _hashed).alias("a")), f"{label}-grams")
    discard(names, places, homes)
    both = evaluated_once(
        pairs.join(grams, "key").join(grams.select(F.col("key").alias("other"), F.col("a").alias("b")), "other"),
        same=F.size(F.array_intersect("a", "b")),
    )
    matched = swept(
        both.where(5 * F.col("same") >= 4 * (F.size("a") + F.size("b") - F.col("same"))).select("key").distinct(), f"{label}-matched"
    )
    discard(grams)
    return matched


def removed_lines(docs: DataFrame) -> DataFrame:
    """(_d, _h, lines): the numbers of the lines to remove, per document that loses any."""
    sets = swept(line_sets(docs), "line-sets")
    place = F.struct("_d", "_h", "line")
    where = swept(sets.select("key", place.alias("place")), "line-places")
    busy, busiest = _busy_buckets(sets)
    # Different sets of fewer than four tokens cannot reach 0.8.
    prefix = F.col("n") - _beyond(F.col("n"))
    firsts = swept(
        where.groupBy("key").agg(F.min("place").alias("place"), F.max("place").alias("last"))
        .select("key", "place", (F.col("place") < F.col("last")).alias("again")),
        "line-firsts",
    )
    starts = firsts.drop("again")  # as many rows as lines, so never broadcast
    repeated = firsts.where("again").select("key", F.col("place").alias("first"))
    once = sets.where("n >= 4").join(_if_small(repeated), "key", "left").where("first IS NULL OR first = struct(_d, _h, line)")
    posted = once.select(
        "key", "n", F.posexplode(F.slice(_ordered(F.col("ids"), busy, busiest), 1, prefix)).alias("pos", "token")
    )
    alike = Window.partitionBy("token")
    shared = swept(
        posted.select("*", F.min("key").over(alike).alias("low"), F.max("key").over(alike).alias("high"))
        .where("low < high").select("token", "key", "n", "pos").distinct(),
        "line-shared",
    )
    groups = swept(shared.join(starts, "key"), "line-groups")
    discard(shared)
    first = groups.groupBy("token").agg(F.min(F.struct("place", "key", "n", "pos")).alias("f"))
    near = swept(
        groups.join(first, "token")
        .where((F.col("key") != F.col("f.key")) & _possible(F.col("n"), F.col("pos"), F.col("f.n"), F.col("f.pos")))
        .select("key", F.col("f.key").alias("other")).distinct(),
        "line-pairs",
    )
    likely = _likely(sets, near, "line-first")
    settled = _verified(docs, starts, likely, "line-first")
    open_keys = groups.join(settled, "key", "left_anti")
    earlier = groups.select("token", F.col("key").alias("other"), F.col("place").alias("other_place"), F.col("n").alias("m"), F.col("pos").alias("at"))
    rest = swept(_in_reach(open_keys, earlier).join(near, ["key", "other"], "left_anti"), "line-pairs")
    discard(groups, near)
    likely_rest = _likely(sets, rest, "line-rest")
    matched = settled.unionByName(_verified(docs, starts, likely_rest, "line-rest")).distinct().withColumn("matched", F.lit(True))
    verdict = swept(
        repeated.join(matched, "key", "full_outer").select("key", "first", F.coalesce("matched", F.lit(False)).alias("matched")),
        "line-verdicts",
    )
    gone = where.join(_if_small(verdict), "key").where(
        "matched OR (first IS NOT NULL AND place <> first)"
    )
    out = swept(
        gone.groupBy("place._d", "place._h").agg(F.collect_set("place.line").alias("lines")), "removed-lines"
    )
    discard(sets, where, firsts, likely, settled, rest, likely_rest, verdict)
    return out


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Add ``n_lines``, ``n_removed`` and ``emptied``, and take the removed lines out of ``text``.

    Lines without words stay and never match. ``emptied`` says that a document had lines
    with words and lost them all. Rows equal in doc_id and text are one document and get
    the same result; equal ids with different texts are ordered by the text's hash; a null
    id comes first. A null text stays null and has no lines. Other columns pass through, whatever
    their names, but the three named above are replaced. Tokens are five-word shingles.
    """
    docs, named = shield(docs, ["doc_id", "text"], ["n_lines", "n_removed", "emptied"])
    gone = removed_lines(docs)
    base = _named(docs).join(_if_small(gone), ["_d", "_h"], "left")

    def rebuilt(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce("lines", F.array().cast("array<int>")))
        return let(
            F.transform(kept, lambda i: F.get(lines, i)),
            lambda ks: F.struct(F.size(lines).alias("n"), F.size(ks).alias("k"), F.array_join(ks, "\n").alias("text")),
        )

    whole = base.withColumn("_r", F.when(F.col("text").isNotNull(), let(_lines(F.col("text")), rebuilt)))
    return named(whole.select(
        *[F.when(F.col("text").isNotNull(), F.col("_r.text")).alias("text") if c == "text" else c for c in docs.columns],
        F.coalesce("_r.n", F.lit(0)).cast("long").alias("n_lines"),
        (F.coalesce("_r.n", F.lit(0)) - F.coalesce("_r.k", F.lit(0))).cast("long").alias("n_removed"),
        (F.col("lines").isNotNull() & ~F.coalesce(F.col("_r.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).alias("emptied"),
    ))
