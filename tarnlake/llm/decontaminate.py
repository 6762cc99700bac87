"""Benchmark decontamination: a prefix-filtered join of shingles with exact verification.

A window is ``window`` consecutive words of an item; an item of fewer words is one window of its own length.
For a window to occur in a document, all its shingles must, so one shingle is a sufficient prefix:
the one that is rarest in the corpus. Only that is joined with the documents. A match at place p of a shingle
that lies j words into its window puts the window at p - j; it must begin and end inside the document
(position and length bounds), and then its words are compared one by one.

Nothing but DataFrame functions is used. The benchmark side is broadcast after its rows are counted, and
joined by shuffle beyond the bound. Documents are never shuffled, only hits and one small row for each.

Null, empty and wordless texts have no words and no hits; items without words or id never occur. Items with
equal text are all reported, equal ids once. Every input row gives one row, repeated ones as often as they come.
Columns of the inputs other than ids and texts are ignored. Empty tables give no hits or no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import lower_ascii, need, small, stored

# Rows of the benchmark side that may be broadcast.
BROADCAST_ROWS = 2_000_000


def item_words(text: Column) -> Column:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, in lower case."""
    t = lower_ascii(F.coalesce(text.cast("string"), F.lit("")))
    return F.array_remove(F.split(t, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def shingle(words: Column, start: Column, size: int) -> Column:
    """Hash of ``size`` words from ``start`` (0-based) on; null where the words end before."""
    return F.when(F.get(words, start + (size - 1)).isNotNull(), F.xxhash64(*(F.get(words, start + k) for k in range(size))))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, key) with one row per distinct window of each item; key: its words, space-parted."""
    w = items.select(F.col("item_id").cast("string").alias("item_id"), item_words(F.col("text")).alias("w"))
    w = w.filter(F.col("item_id").isNotNull() & (F.size("w") > 0))
    length = F.least(F.size("w"), F.lit(window))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - length + 1))
    return w.select("item_id", "w", length.alias("len"), starts.alias("s")).select(
        "item_id", F.array_join(F.slice("w", F.col("s"), F.col("len")), " ").alias("key")).distinct()


def stream(docs: DataFrame, size: int, last: bool) -> DataFrame:
    """(row identity, n_words, w, pos, h) for every shingle; with ``last`` one more row, without h, that ends each document."""
    words = F.concat(F.col("w"), F.array(F.lit(""))) if last else F.col("w")
    out = docs.select("doc_id", "th", "w", F.posexplode(words).alias("pos", "word"))
    return out.select("doc_id", "th", "w", "pos", shingle(F.col("w"), F.col("pos"), size).alias("h"), F.lit(size).alias("k"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, size: int = 5) -> DataFrame:
    """Per document row: doc_id, th (hash of the text), n_words, spans (of matched windows, sorted, [s, e)), item_ids (sorted)."""
    need(docs, "doc_id", "text")
    need(items, "item_id", "text")
    item_keys = stored(item_windows(items, window), "item-windows")
    windows = item_keys.select("key").distinct().select("key", F.split("key", " ").alias("v"))
    windows = windows.withColumn("len", F.size("v")).withColumn("k", F.least("len", F.lit(size)))
    kinds = sorted(r.k for r in windows.select("k").distinct().collect()) or [size]  # at most ``size`` numbers
    tokens = stored(reduce(DataFrame.unionByName, [
        windows.filter(F.col("k") == k).select("key", "len", "k", "v", F.explode(F.sequence(F.lit(0), F.col("len") - k)).alias("j"))
        .select("key", "len", "k", "j", shingle(F.col("v"), F.col("j"), k).alias("h")) for k in kinds]), "item-shingles")

    parted = docs.select(
        "doc_id", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th"), item_words(F.col("text")).alias("w"))

    # Rarity in the corpus; sums are partial before they move.
    vocabulary = small(stored(tokens.select("k", "h").distinct(), "vocabulary"), BROADCAST_ROWS)
    counts = reduce(DataFrame.unionByName, [
        stream(parted, k, False).select("k", "h").join(vocabulary, ["k", "h"]).groupBy("k", "h").agg(F.count("*").alias("seen"))
        for k in kinds])
    # An inner join and a full count: a window with a shingle that the corpus lacks cannot occur.
    prefix = tokens.join(counts, ["k", "h"]).groupBy("key", "len", "k").agg(
        F.count("*").alias("n"), F.min_by(F.struct("j", "h"), F.struct("seen", "h", "j")).alias("p"))
    prefix = small(stored(prefix.filter(F.col("n") == F.col("len") - F.col("k") + 1).select(
        "key", "len", "k", "p.j", "p.h"), "prefix"), BROADCAST_ROWS)

    def hits(k: int, last: bool) -> DataFrame:
        found = stream(parted, k, last).join(prefix, ["k", "h"], "left" if last else "inner")
        start = F.col("pos") - F.col("j")
        n = F.size("w")
        inside = (start >= 0) & (start + F.col("len") <= n)
        same = F.array_join(F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("len")), " ") == F.col("key")
        match = F.coalesce(inside & F.when(inside, same), F.lit(False))
        end = F.col("pos") == n if last else F.lit(False)
        return found.filter(match | end).select(
            "doc_id", "th", F.when(end, n.cast("long")).alias("n"), F.when(match, F.struct(start.alias("s"), (start + F.col("len")).alias("e"))).alias("span"),
            F.when(match, F.col("key")).alias("key"))

    found = reduce(DataFrame.unionByName, [hits(k, i == 0) for i, k in enumerate(kinds)])
    # A document's hits are no more than its words times the windows that share one prefix.
    per_doc = stored(found.groupBy("doc_id", "th").agg(
        F.count("n").alias("copies"), F.max("n").alias("n_words"), F.collect_set("span").alias("spans"),
        F.collect_set("key").alias("keys")), "contamination")
    named = per_doc.filter(F.size("keys") > 0).select("doc_id", "th", F.explode("keys").alias("key")).join(
        item_keys, "key").groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    left, right = per_doc.alias("d"), named.alias("i")
    return left.join(right, F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("d.th") == F.col("i.th")), "left").select(
        "d.doc_id", "d.th", "d.n_words", F.sort_array("spans").alias("spans"), F.coalesce("i.item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.explode(F.sequence(F.lit(1), F.col("d.copies").cast("int"))).alias("copy")).drop("copy")


def digest(found: DataFrame) -> DataFrame:
    # Words under any span: each adds what lies beyond the furthest end so far.
    swept = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["e"]).alias("end"),
            (a["hit"] + F.greatest(x["e"] - F.greatest(a["end"], x["s"]), F.lit(0))).alias("hit")))
    return found.select(
        "doc_id", "n_words", swept["hit"].alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The documents in which no window occurs, with all their columns."""
    bad = contamination(docs, items, window).filter(F.size("spans") > 0).select(F.col("doc_id").alias("_d"), F.col("th").alias("_h")).distinct()
    bad = small(stored(bad, "contaminated"), BROADCAST_ROWS)
    th = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("_d")) & (th == F.col("_h")), "left_anti")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark) WHERE len(w) > 0),
k AS (SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS key
  FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM b)),
lens AS (SELECT DISTINCT n FROM k),
p AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens)),
h AS (SELECT doc_id, s, n, item_id FROM p JOIN k USING (n, key)),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN i ON d.doc_id = i.doc_id"""
