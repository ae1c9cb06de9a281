"""Benchmark decontamination with a distributed positional inverted index.

The index is a stored table of postings (term, row, position). Each task that reads documents writes a
segment of its own, sorted by term, so building it shuffles nothing, equal terms compress to runs, and a
search reads the row groups that hold its terms. The position after the last word of a document holds the
end mark, an empty term; the end marks list all documents with their ids and lengths.

A phrase search ranks the words of every phrase by their number of postings. The list of the rarest word,
moved back by its offset in the phrase, gives the starts that are possible; the list of the second rarest,
moved back by its own offset, is intersected with them; and the starts that are left are intersected with
the lists of all other words at once. A start whose every word is there is an exact match. Intersections are
equi-joins on (row, position, term), which spread a frequent word, or a document of a great many matches,
over all tasks. The rarest words are joined by term: broadcast if they are at most ``MAX_BROADCAST_ROWS``,
which phrases of bounded length bound in bytes too, else salted by the postings. A proximity search asks
that every word of a phrase lies within a number of words of an occurrence of its rarest word, by equi-joins
on bins of positions.

Equal windows of several items are searched once, and documents with equal sets of windows share the list
of their items, so a passage that many items or documents hold is not multiplied out.

A word is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. Null and empty texts and texts
without words have no postings but their end mark, and no match. Rows with a null id and repeated rows are
documents of their own. Items without words have no window; the text of an item without an id still hits
words, but is not in the list of items; rows that repeat an item id make one item. Empty tables give an
empty index, or rows without hits. Other columns are ignored. Everything is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnsieve.llm.common import full_text
from txnsieve.operators.lookups import lookup_join
from txnsieve.session import staged

WINDOW = 10
END = ""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: all ASCII signs but digits and (lower-case) letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, lower-cased."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), BETWEEN, -1), lambda w: w != F.lit(END))


def positional_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored postings ``term, row, position, doc_id``; only end marks carry the id."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.concat(words_of(full_text(text_col)), F.array(F.lit(END))).alias("words"),
    )
    postings = rows.select("row", "doc_id", F.posexplode("words").alias("position", "term")).select(
        "term", "row", "position", F.when(F.col("term") == END, F.col("doc_id")).alias("doc_id")
    )
    return staged(postings.sortWithinPartitions("term", "row", "position"), "positional-index")


def indexed_documents(index: DataFrame) -> DataFrame:
    """``row, doc_id, n_words`` of every document, from its end mark."""
    return index.where(F.col("term") == END).select("row", "doc_id", F.col("position").cast("long").alias("n_words"))


def ranked_terms(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``phrase, offset, term, rank`` with the rarest word first; phrases with a word that is not indexed are left out.

    ``phrases`` has ``phrase`` and ``words``.
    """
    placed = phrases.select("phrase", F.size("words").alias("size"), F.posexplode("words").alias("offset", "term"))
    asked = placed.select("term").distinct()
    known = lookup_join(index.select("term"), asked, ["term"], "left_semi").groupBy("term").agg(F.count("*").alias("postings"))
    found = placed.join(known, "term")
    rarest = Window.partitionBy("phrase").orderBy("postings", "offset")
    whole = F.count("*").over(Window.partitionBy("phrase")) == F.col("size")
    return found.withColumn("rank", F.row_number().over(rarest)).withColumn("_whole", whole).where("_whole").select(
        "phrase", "offset", "term", "rank"
    )


def _intersect(index: DataFrame, starts: DataFrame, terms: DataFrame) -> DataFrame:
    """The starts (``row, start, phrase``) at which all ``terms`` of their phrase stand at their offset."""
    needed = terms.groupBy("phrase").agg(F.count("*").alias("needed"))
    places = lookup_join(starts, terms.select("phrase", "offset", "term"), ["phrase"], "inner", spread_by=["row", "start"])
    places = places.select("row", (F.col("start") + F.col("offset")).alias("position"), "term", "phrase", "start")
    lists = lookup_join(index.select("row", "position", "term"), terms.select("term").distinct(), ["term"], "left_semi", spread_by=["row", "position"])
    lists = lookup_join(lists, starts.select("row").distinct(), ["row"], "left_semi")
    there = places.join(lists, ["row", "position", "term"]).groupBy("row", "start", "phrase").agg(F.count("*").alias("there"))
    return lookup_join(there, needed, ["phrase"], "inner", spread_by=["row", "start"]).where("there = needed").select("row", "start", "phrase")


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``row, start, phrase`` of every place where the words of a phrase follow one another."""
    terms = staged(ranked_terms(index, phrases), "phrase-terms")
    first = terms.where("rank = 1").select("term", "phrase", "offset")
    starts = lookup_join(index.select("term", "row", "position"), first, ["term"], "inner", spread_by=["row", "position"])
    starts = starts.select("row", (F.col("position") - F.col("offset")).alias("start"), "phrase").where("start >= 0")
    starts = staged(starts, "phrase-starts")
    alone = terms.groupBy("phrase").agg(F.max("rank").alias("words"))
    found = []
    for fewer, more in ((1, 2), (2, 1 << 30)):
        ended = alone.where(F.col("words") <= fewer).select("phrase")
        found.append(lookup_join(starts, ended, ["phrase"], "left_semi", spread_by=["row", "start"]))
        starts = staged(_intersect(index, starts, terms.where((F.col("rank") > fewer) & (F.col("rank") <= more))), "phrase-starts")
    return found[0].unionByName(found[1]).unionByName(starts).select("row", "start", "phrase")


def near_matches(index: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """``row, position, phrase`` of every occurrence of the rarest word of a phrase with all its other words at most ``within`` words away."""
    single = phrases.select("phrase", F.array_distinct("words").alias("words"))
    terms = staged(ranked_terms(index, single), "near-terms")
    first = terms.where("rank = 1").select("term", "phrase")
    anchors = lookup_join(index.select("term", "row", "position"), first, ["term"], "inner", spread_by=["row", "position"])
    anchors = staged(anchors.select("row", F.col("position").alias("anchor"), "phrase"), "near-anchors")
    others = terms.where("rank > 1").select("phrase", "term")
    width = within + 1
    bin_ = F.floor(F.col("anchor") / width).cast("int")
    asked = lookup_join(anchors, others, ["phrase"], "inner", spread_by=["row", "anchor"])
    asked = asked.withColumn("bin", F.explode(F.array(bin_ - 1, bin_, bin_ + 1)))
    lists = lookup_join(index.select("row", "position", "term"), others.select("term").distinct(), ["term"], "left_semi")
    lists = lists.withColumn("bin", F.floor(F.col("position") / width).cast("int"))
    near = asked.join(lists, ["row", "term", "bin"]).where(F.abs(F.col("position") - F.col("anchor")) <= within)
    there = near.groupBy("row", "anchor", "phrase").agg(F.count_distinct("term").alias("there"))
    needed = terms.groupBy("phrase").agg((F.count("*") - 1).alias("needed"))
    wanted = lookup_join(anchors, needed, ["phrase"], "inner").join(there, ["row", "anchor", "phrase"], "left")
    return wanted.where(F.coalesce("there", F.lit(0)) == F.col("needed")).select("row", F.col("anchor").alias("position"), "phrase")


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The distinct windows (``phrase, words``) of all items, and the items (``phrase, item``) of each.

    An item of fewer words than a window is one window. ``phrase`` is the window's place among the
    stored distinct windows.
    """
    words = items.select(F.col(id_col).cast("string").alias("item"), words_of(full_text(text_col)).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    each = staged(words.select("item", F.explode(F.transform(starts, lambda i: F.slice("all", i, window))).alias("words")), "item-windows")
    phrases = staged(each.select("words").distinct().withColumn("phrase", F.monotonically_increasing_id()), "windows")
    owners = each.where("item IS NOT NULL").join(phrases, "words").select("phrase", "item").distinct()
    return phrases, staged(owners, "window-items")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` per document.

    ``n_hit`` counts the words inside some occurrence of a window of an item; ``items`` has the ids (as
    text, sorted) of all items with such a window.
    """
    index = positional_index(docs, id_col, text_col)
    phrases, owners = item_windows(items, window, item_col, item_text_col)
    matches = phrase_matches(index, phrases)
    sizes = phrases.select("phrase", F.size("words").alias("size"))
    matches = staged(lookup_join(matches, sizes, ["phrase"], "inner", spread_by=["row", "start"]), "matches")
    covered = matches.select("row", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("position"))
    hits = covered.distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    sets = matches.groupBy("row").agg(F.array_sort(F.collect_set("phrase")).alias("phrases"))
    found = staged(hits.join(sets, "row"), "hits")
    kinds = found.select("phrases").distinct()
    lists = (
        kinds.withColumn("phrase", F.explode("phrases"))
        .join(owners, "phrase")
        .groupBy("phrases")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    found = found.join(lists, "phrases", "left").select("row", "n_hit", "items")
    none = F.array().cast("array<string>")
    return lookup_join(indexed_documents(index), staged(found, "found"), ["row"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items")
    )
