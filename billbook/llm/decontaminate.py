"""Benchmark decontamination over a positional inverted index of the training documents.

The index holds postings (term, document, position, context). Test windows are looked
up from their rarest terms: the posting lists of the two rarest terms of a window are
shifted by the terms' offsets in it and intersected on (document, start), and what is
left is compared word by word with the context kept in the posting. Frequencies are
exact counts over all documents. Only lists that some window looks up are stored, so
the index is small beside the documents and a very frequent term is stored only if a
window consists of nothing else.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billbook.llm.common import ascii_lower, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
LISTS = 2
# No word: stands for the end of a document in the index.
END = ""
# Test terms of more bytes than this are joined by a shuffle instead of a broadcast.
BROADCAST_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    """A-Z in lower case, then runs of ASCII letters, digits and everything beyond ASCII."""
    found = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def windows_of(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """(item_id, window): `length` consecutive words; an item of fewer, but not none, is one window.

    `window` is the array of its words.
    """
    words = items.select("item_id", words_of(F.col("text")).alias("words"))
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - length + 1, F.lit(1)))
    return words.where(n > 0).select(
        "item_id",
        F.explode(F.transform(starts, lambda i: F.slice("words", i, length))).alias("window"),
    ).distinct()


def _documents(docs: DataFrame) -> DataFrame:
    """(doc, words); rows equal in doc_id and text are one document here."""
    key = F.struct("doc_id", F.xxhash64("text").alias("h"))
    return docs.select(key.alias("doc"), words_of(F.col("text")).alias("words"))


def _small(terms: DataFrame) -> bool:
    """Whether the test terms are to be broadcast, whatever Spark estimates."""
    return (terms.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0) <= BROADCAST_BYTES


def lookups_of(docs: DataFrame, windows: DataFrame, lists: int = LISTS) -> DataFrame:
    """(wid, window, seeds): the windows numbered, with their rarest terms (n, offset, term), rarest first.

    n counts the term in all documents. Windows with a term that no document has are left out.
    """
    terms = written(windows.select(F.explode("window").alias("term")).distinct(), "terms")
    words, n = _documents(docs).select(F.explode("words").alias("term")), F.count(F.lit(1)).alias("n")
    if _small(terms):
        counts = words.join(F.broadcast(terms), "term").groupBy("term").agg(n)
    else:
        counts = words.groupBy("term").agg(n).join(terms, "term")
    found = (
        windows.select("window").distinct()
        .select("window", F.posexplode("window").alias("offset", "term"))
        .join(counts, "term")
        .groupBy("window")
        .agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("seeds"))
        .where(F.size("seeds") == F.size("window"))
        .select("window", F.slice("seeds", 1, lists).alias("seeds"))
    )
    return written(found.withColumn("wid", F.monotonically_increasing_id()), "windows")


def build_index(docs: DataFrame, lookups: DataFrame, reach: int = WINDOW - 1) -> DataFrame:
    """Postings (term, doc, pos, context, at) of the terms that are looked up, as a written table.

    `pos` counts words from 0. `context` holds the words up to `reach` before and after, and `at` is
    the term's place in it, from 0. Every row of docs also has a posting of the term END at its end.
    """
    looked_up = lookups.select(F.explode("seeds.term").alias("term")).distinct()
    end = docs.sparkSession.range(1).select(F.lit(END).alias("term"))
    terms = written(looked_up.unionByName(end), "lookups")
    return written(_postings(docs, terms, _small(terms), reach), "postings")


def _postings(docs: DataFrame, terms: DataFrame, small: bool, reach: int) -> DataFrame:
    """The postings of `terms`. No row that is shuffled carries more of its text than the context.

    Beside a broadcast nothing is shuffled, and contexts are cut for the postings only; else they are cut before the join.
    """
    each = _documents(docs).select(
        "doc", "words", F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("pos", "term")
    )
    before = F.least(F.col("pos"), F.lit(reach))
    context = F.slice("words", F.col("pos") - before + 1, before + reach + 1).alias("context")
    cut = ["term", "doc", "pos", context, before.alias("at")]
    if small:
        return each.join(F.broadcast(terms), "term").select(*cut)
    return each.select(*cut).join(terms, "term")


def _list(index: DataFrame, lookups: DataFrame, i: int) -> DataFrame:
    """Occurrences of each window's i-th seed, shifted to where the window would start."""
    seed = F.col("seeds")[i]
    own = lookups.where(F.size("seeds") > i).select(
        "wid", "window", F.size("seeds").alias("lists"),
        seed["term"].alias("term"), seed["offset"].alias("offset"),
    )
    return index.join(own, "term").withColumn("start", F.col("pos") - F.col("offset"))


def phrase_matches(index: DataFrame, lookups: DataFrame, lists: int = LISTS) -> DataFrame:
    """(doc, start, wid) for every exact occurrence; start counts words from 0.

    The rarest list is compared with its contexts while it is read, so that only what can match is
    intersected with the other lists.
    """
    first = F.col("at") - F.col("offset")
    there = F.slice("context", F.greatest(first, F.lit(0)) + 1, F.size("window"))
    key = ["doc", "start", "wid"]
    found = _list(index, lookups, 0).where((first >= 0) & (there == F.col("window"))).select(*key, "lists")
    for i in range(1, lists):
        other = _list(index, lookups, i).where("start >= 0").select(*key)
        found = found.where(F.col("lists") > i).join(other, key, "leftsemi").unionByName(
            found.where(F.col("lists") <= i)
        )
    return found.select(*key).distinct()


def proximity_matches(index: DataFrame, lookups: DataFrame, slop: int) -> DataFrame:
    """(doc, pos, wid): the window's rarest term at `pos`, and all its words within len + slop words.

    Any order counts. The index needs a reach of the window's length + slop - 1 at least.
    """
    span = F.size("window") + slop
    found = _list(index, lookups, 0)
    starts = F.sequence(
        F.greatest(F.col("at") - span + 2, F.lit(1)), F.col("at") + 1
    )
    near = F.exists(
        starts,
        lambda s: F.size(F.array_except("window", F.slice("context", s, span))) == 0,
    )
    return found.where(near).select("doc", "pos", "wid").distinct()


def _covered(spans: Column) -> Column:
    """Number of words in the union of (start, end) spans sorted by start."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        spans,
        zero,
        lambda s, x: F.struct(
            F.greatest(s["end"], x["end"]).alias("end"),
            (s["n"] + F.greatest(x["end"] - F.greatest(s["end"], x["start"]), F.lit(0))).alias("n"),
        ),
    )["n"]


def contamination(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids) for every row of docs (doc_id, text).

    `n_hit` words lie inside an occurrence of a window of items (item_id, text); `item_ids` are the
    items with occurring windows, as sorted strings, each once. NULL and empty texts have no words.
    Rows equal in doc_id and text get equal results, NULL doc_ids included; an item without id
    counts for n_hit only. Without documents or items nothing is hit. Other columns are left out.
    """
    windows = written(windows_of(items, length), "windows")
    lookups = lookups_of(docs, windows)
    index = build_index(docs, lookups, length - 1)
    matches = phrase_matches(index, lookups).join(lookups.select("wid", "window"), "wid")
    matches = written(matches.select("doc", "start", "window"), "matches")
    spans = matches.groupBy("doc").agg(
        F.array_sort(
            F.collect_set(F.struct("start", (F.col("start") + F.size("window")).alias("end")))
        ).alias("spans")
    )
    hit_items = (
        matches.join(windows, "window")
        .groupBy("doc")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    hits = spans.join(hit_items, "doc").select("doc", _covered(F.col("spans")).alias("n_hit"), "item_ids")
    own = index.where(F.col("term") == END).select("doc", F.col("pos").cast("long").alias("n_words"))
    return own.join(hits, "doc", "left").select(
        "doc.doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """The rows of docs, columns as they are, in which no test window occurs."""
    windows = written(windows_of(items, length), "windows")
    lookups = lookups_of(docs, windows)
    index = build_index(docs, lookups, length - 1)
    hit = written(phrase_matches(index, lookups).select("doc").distinct(), "hit")
    key = F.struct(docs["doc_id"], F.xxhash64(docs["text"]).alias("h"))
    return docs.join(hit, key == hit["doc"], "leftanti")
